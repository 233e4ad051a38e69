"""Line-first quality rules: judge every line, remove failing lines, reject documents that lose too much text.

Base figures per document (words are runs of anything but ASCII white space): words, code points in words, symbols,
repeated lines, and words inside 3-word windows found at least twice. A document with too few words or too much
repetition fails outright. For the others each line with a word is tried against

* punctuation: too many words that hold one of ``#*$%&|<>`` or end in ``!!``, or a short line without an end mark;
* navigation: several separators (``|``, ``>``, ``»``, ``·``) between short items, or a menu phrase alone;
* boilerplate: licence and rights notices, cookie and script notices;
* shouting, one word over and over, and a line equal to an earlier one.

Failing lines are removed, and a document that loses more than ``most_lost`` of its word characters is rejected.

Cases: a null or empty text has no words and fails. Lines without a word are kept as they are and count for
nothing. Repeated rows are judged alike, each on its own. Texts and lines have no length limit. Other columns
of the input pass through unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SYMBOLS = b"#*$%&|<>"
END_MARKS = (".", "!", "?", ":", ";", '"', "'", ")", "]", "…", "”", "’", "»", "。", "！", "？")
BOILERPLATE = re.compile(
    r"all rights reserved|licensed under|released under the|is licensed|copyright (?:\(c\)|©|\d{4})|©\s*\d{4}"
    r"|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)|we use cookies|enable javascript"
    r"|javascript is (?:disabled|required)|subscribe to our newsletter",
    re.IGNORECASE,
)
MENU = re.compile(
    r"(?:home|menu|log ?in|sign (?:in|up)|register|contact(?: us)?|about(?: us)?|search|next|previous|back to top"
    r"|read more|click here|share|sitemap|skip to content)",
    re.IGNORECASE,
)
MARKED = re.compile(r"[#*$%&|<>]|!!(?!\S)")
SEPARATORS = {"|", ">", "»", "·", "•", "/"}


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    most_repeated_percent: int = 50
    most_marked: float = 0.3
    most_upper: float = 0.6
    least_variety: float = 0.3
    short_line: int = 4
    most_lost: float = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    size = len(index)
    pairs = ids[:-2] * size + ids[1:-1]
    if size > 2_000_000:  # the product of three would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, where, counts = np.unique(pairs * size + ids[2:], return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def line_fails(line: str, rules: Rules) -> str:
    """The rule that a line with at least one word breaks; empty if none."""
    words = line.split()
    n = len(words)
    if BOILERPLATE.search(line):
        return "boilerplate"
    separators = sum(w in SEPARATORS for w in words)
    if separators >= 2 and separators * 6 >= n or MENU.fullmatch(line.strip()):
        return "navigation"
    if n > 2 and MARKED.search(line) and sum(map(bool, map(MARKED.search, words))) > rules.most_marked * n:
        return "punctuation"
    if n < rules.short_line and not line.rstrip().endswith(END_MARKS):
        return "punctuation"
    if n >= 3 and sum(map(str.isupper, words)) > rules.most_upper * n:
        return "shouting"
    if n >= 10 and len(set(words)) < rules.least_variety * min(n, 100):
        return "repetition"
    return ""


def assess_text(text: str | None, rules: Rules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_share, kept, cleaned)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n_words, word_bytes = len(words), sum(map(len, words))
    word_chars = len(text) - (len(raw) - word_bytes)
    n_symbols = sum(map(raw.count, (bytes([c]) for c in SYMBOLS)))
    n_repeat = repeated_words(words)
    seen: set[str] = set()
    n_dup, lost, kept_lines = 0, 0, []
    base_failed = n_words < rules.least_words or 100 * n_repeat > rules.most_repeated_percent * n_words
    for line in text.split("\n"):
        inked = line.encode().split()
        if not inked:
            kept_lines.append(line)
            continue
        duplicate = line in seen
        seen.add(line)
        n_dup += duplicate
        if not base_failed:
            if duplicate or line_fails(line, rules):
                lost += sum(map(len, inked))
            else:
                kept_lines.append(line)
    share = lost / word_bytes if word_bytes else 0.0
    kept = not base_failed and share <= rules.most_lost
    return n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, share, kept, "\n".join(kept_lines)


FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "lost_share double, kept boolean"
)


def assess(docs: DataFrame, rules: Rules = Rules(), with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, the figures, the verdict and, if asked for, the cleaned text."""
    names = [part.split()[0] for part in FIGURES.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(assess_text(t.as_py(), rules) for t in batch.column("text")))) or [[]] * 9
            columns = [batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(found, kinds))]
            if with_text:
                columns.append(pa.array(found[8], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, *["cleaned"] * with_text])

    schema = f"doc_id long, {FIGURES}" + ", cleaned string" * with_text
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` without rejected documents, the others without their failing lines; all columns stay."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [assess_text(t.as_py(), rules) for t in batch.column(at)]
            kept = pa.array([f[7] for f in found], pa.bool_())
            texts = pa.array([f[8] for f in found], pa.string()).cast(batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts).filter(kept)

    return docs.mapInArrow(run, docs.schema)
