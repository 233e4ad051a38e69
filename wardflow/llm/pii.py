"""Personal data: base patterns, and further spans chosen by gradient boosting over overlapping candidates.

Base spans are the leftmost non-overlapping matches of one pattern per kind, checked (address parts, digit sums and
counts) and dropped, never retried, where the check fails. Generators with high recall then propose more spans:
disguised addresses (``name at site dot org``), addresses of the newer protocol, cards with other separators or
lengths, phone numbers without a country code. Boosted trees score each candidate by its format and its context;
a candidate is taken if its kind's calibrated threshold is met and it meets no base span and no better candidate.

Training: contexts cut from at most ``2 * sample_rows`` documents, chosen by a hash, each with one span of personal
data or one look-alike (dates, versions, order numbers, prices, failing digit sums) put in. A quarter of them is
kept from training, and isotonic regression on it sets, per kind, the score from which at least ``precision`` of
candidates are personal data.

Cases: a null or empty text has no spans. Repeated rows get the same spans each. Texts have no length limit and
matching takes time in proportion to it. Without any text nothing is trained and only base spans are found.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import bounded_sample, stored

Span = tuple[str, int, int]
KINDS = ("email", "ip", "card", "phone")
DIGITS = "0123456789"

# The base patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        # The local part is the whole run before the sign, back to the last match.
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append(("email", start, match.end()))
        # A failed run holds no other sign, so nothing before this one can match again.
        free = match.end() if match else at + 1
        at = text.find("@", free)
    if any(c in text for c in DIGITS):
        for m in IP.finditer(text):
            if all(map(_small, m.group().split("."))):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = _digits(m.group()) if m.end() - m.start() < 40 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c in DIGITS for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return found


# The generators. Each proposes more than it should; the trees choose.
AT = r"(?:\s?@\s?|\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)"
DOT = r"(?:\.|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s)"
WIDE_DOMAIN = re.compile(rf"{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.IGNORECASE)
WIDE_LOCAL = re.compile(rf"[\w%+-]{{1,40}}(?:{DOT}[\w%+-]{{1,40}}){{0,2}}\Z")
IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
WIDE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\sdot\s|\s\.\s)[0-9]{1,3}){3}(?![0-9])")
WIDE_CARD = re.compile(r"(?<![0-9])[0-9](?:[ .\-/_]?[0-9]){12,18}(?![0-9])")
WIDE_PHONE = re.compile(r"(?<![0-9.+])(?:\(0?[0-9]{2,5}\)[ .-]?|00?[0-9]{1,4}[ ./-]|[0-9]{2,5}[ ./-])[0-9]{2,5}(?:[ ./-]?[0-9]{2,5}){0,4}(?![0-9])")


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data."""
    found: list[Span] = []
    low = text if text.islower() else text.lower()
    if "@" in text or " dot " in low or "at]" in low or "at)" in low or "at}" in low or WIDE_DOMAIN.search(text):
        for m in WIDE_DOMAIN.finditer(text):
            local = WIDE_LOCAL.search(text, max(0, m.start() - 90), m.start())
            if local:
                found.append(("email", local.start(), m.end()))
    if any(c in text for c in DIGITS):
        if text.count(":") > 1:
            found += [("ip", *m.span()) for m in IP6.finditer(text)]
        found += [("ip", *m.span()) for m in WIDE_IP.finditer(text)]
        found += [("card", *m.span()) for m in WIDE_CARD.finditer(text)]
        found += [("phone", *m.span()) for m in WIDE_PHONE.finditer(text)]
    return found


# Words that speak for or against a kind.
CUES = {
    "email": re.compile(r"mail|contact|write to|reach me|courriel|correo", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|address|host|server|router|login from", re.IGNORECASE),
    "card": re.compile(r"card|visa|credit|amex|payment|carte|tarjeta|karte", re.IGNORECASE),
    "phone": re.compile(r"\btel|phone|call|fax|mobile|whatsapp|téléphone|teléfono|anruf", re.IGNORECASE),
}
AGAINST = re.compile(
    r"isbn|order|invoice|version|\bv\.?$|page|section|§|\bref|serial|\bid\b|number of|€|\$|£|score|ratio|\bat$|doi|since|until",
    re.IGNORECASE,
)
ENDINGS = {"com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "eu", "us", "ch", "at", "it"}
DATE = re.compile(r"(?:(?:19|20)\d\d([./ -])\d{1,2}\1\d{1,2}|\d{1,2}([./ -])\d{1,2}\2(?:19|20)?\d\d)\Z")
TIME = re.compile(r"\d{1,2}:\d\d(?::\d\d)?\Z")


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    kind, start, end = span
    own, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 20]
    digits, groups = _digits(own), re.split(r"[^0-9A-Za-z]+", own.strip("()+[] "))
    sizes = [len(g) for g in groups if g] or [0]
    last = groups[-1].lower() if groups else ""
    separators = {c for c in own if not c.isalnum()}
    return [
        *(float(kind == k) for k in KINDS),
        float(len(own)),
        float(len(digits)),
        float(sum(map(str.isalpha, own))),
        float(len(sizes)),
        float(max(sizes)),
        float(min(sizes)),
        float(len(separators)),
        float(bool(digits) and luhn(digits)),
        float(int(digits[0])) if digits else -1.0,
        float(own[:1] == "("),
        float(digits[:1] == "0"),
        float("@" in own),
        float(bool(re.search(r"\bat\b", own, re.IGNORECASE))),
        float(bool(re.search(r"[\[({]\s?at\s?[\])}]", own, re.IGNORECASE))),
        float(bool(re.search(r"\bdot\b", own, re.IGNORECASE))),
        float(last in ENDINGS),
        float(own.count(":")),
        float(bool(DATE.match(own))),
        float(bool(TIME.match(own))),
        float(all(len(g) < 4 and g.isdigit() and int(g) <= 255 for g in groups if g)),
        float(bool(CUES[kind].search(before))),
        float(bool(AGAINST.search(before.rstrip(" :#.")[-14:]))),
        float(before[-1:].isalnum() or before[-1:] in {"$", "€", "£", "#", "/"}),
        float(after[:1].isalnum() or after[:1] in {"%", "€", "/"}),
        float(bool(re.match(r"[.,:-]?[0-9]", after))),
        float(bool(re.search(r"[0-9][.,:-]?\Z", before))),
    ]


def _planted(draw: np.random.Generator) -> tuple[str, str, bool]:
    """(kind, text, whether it is personal data): one span to put into a context."""
    n = lambda k: "".join(draw.choice(list(DIGITS), k))
    word = lambda: "".join(draw.choice(list("abcdefghiklmnoprstuw"), draw.integers(3, 9)))
    pick = lambda *options: options[draw.integers(len(options))]

    def card(length: int, good: bool) -> str:
        body = pick("4", "5", "37", "6") + n(length - 3)
        body = body[: length - 1]
        check = next(d for d in DIGITS if luhn(body + d))
        return body + (check if good else DIGITS[(int(check) + int(draw.integers(1, 10))) % 10])

    def cut(digits: str, mark: str) -> str:
        return mark.join(digits[k : k + 4] for k in range(0, len(digits), 4))

    kind = KINDS[draw.integers(4)]
    good = bool(draw.random() < 0.5)
    site, ending = word(), pick("com", "org", "net", "de", "fr", "es", "io")
    if kind == "email":
        name = word() + pick("", "." + word(), n(2))
        if good:
            at = pick(" at ", " [at] ", "[at]", " (at) ", " @ ")
            return kind, name + at + site + pick(" dot ", " [dot] ", ".") + ending, True
        return kind, pick(f"{word()} at {word()}.{word().title()}", f"{word()} at {word()} dot {word()}", f"{name} @ {n(2)}.{n(2)}"), False
    if kind == "ip":
        if good:
            four = [str(draw.integers(1, 256)) for _ in range(4)]
            six = ":".join(f"{draw.integers(0, 65536):x}" for _ in range(8))
            return kind, pick("[.]".join(four), "(.)".join(four), " dot ".join(four), six, six), True
        clock = f"{draw.integers(0, 24):02d}:{draw.integers(0, 60):02d}:{draw.integers(0, 60):02d}"
        return kind, pick(clock, f"{draw.integers(1, 9)}:{draw.integers(1, 9)}:{draw.integers(1, 9)}", f"{n(1)} . {n(1)} . {n(1)} . {n(3)}"), False
    if kind == "card":
        if good:
            return kind, pick(cut(card(16, True), "."), cut(card(16, True), "/"), cut(card(16, True), "_"), card(15, True)), True
        bad = card(int(pick(13, 15, 16, 16)), False)
        return kind, pick(bad, cut(bad, "-"), cut(bad, " "), cut(bad, "."), "20" + n(12), n(13)), False
    if good:
        return kind, pick(f"({n(3)}) {n(3)}-{n(4)}", f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)}.{n(3)}.{n(4)}", f"0{n(3)} {n(3)} {n(4)}", f"00{n(2)} {n(3)} {n(3)} {n(3)}"), True
    date = f"20{n(2)}-{draw.integers(1, 13):02d}-{draw.integers(1, 29):02d}"
    day = f"{draw.integers(1, 29)}.{draw.integers(1, 13)}.20{n(2)}"
    return kind, pick(date, day, f"19{n(2)}-19{n(2)}", f"{n(2)} {n(3)}", f"{n(2)}/{n(2)}", f"{n(3)} {n(3)} {n(3)}", f"{n(5)}-{n(5)}-{n(5)}"), False


# Words put before some of the spans, by kind and truth.
LEADS = {
    True: {"email": ["mail me:", "contact"], "ip": ["ip", "host"], "card": ["card", "visa"], "phone": ["tel.", "call"]},
    False: {"email": ["look"], "ip": ["since", "ratio"], "card": ["order", "serial", "isbn"], "phone": ["order", "page", "ref."]},
}


def examples(context: str, seed: int) -> list[tuple[str, bool, list[float]]]:
    """(kind, label, features) of every candidate in a context with one planted span."""
    draw = np.random.default_rng(seed % (1 << 63))
    kind, planted, good = _planted(draw)
    at = context.find(" ", len(context) // 2)
    at = at if at >= 0 else len(context)
    lead = ""
    if draw.random() < 0.5:
        options = LEADS[good][kind]
        lead = " " + options[draw.integers(len(options))]
    head = context[:at] + lead + " "
    start, end = len(head), len(head) + len(planted)
    text = head + planted + (context[at:] or ".")
    rows = []
    base = Covered(base_spans(text))
    for span in candidates(text):
        if base.meets(span):
            continue
        own = abs(span[1] - start) <= 1 and abs(span[2] - end) <= 1 and span[0] == kind
        rows.append((span[0], good and own, features(text, span)))
    return rows


class Covered:
    """Disjoint stretches of a text in order, so that a span is compared with its neighbours only."""

    def __init__(self, spans: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, span: Span) -> bool:
        at = bisect_left(self.starts, span[2])
        return at > 0 and self.ends[at - 1] > span[1]

    def add(self, span: Span) -> None:
        """``span`` meets nothing so far."""
        at = bisect_left(self.starts, span[1])
        self.starts.insert(at, span[1])
        self.ends.insert(at, span[2])


@dataclass
class PiiModel:
    """Boosted trees as nested (feature, threshold, left, right) or leaf values, and a least score per kind."""

    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)

    def score(self, row: list[float]) -> float:
        total = 0.0
        for weight, node in zip(self.weights, self.trees):
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            total += weight * node
        return total

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates that meet their threshold, best first, without overlap.

        Equal scores are settled by length, the longest first, then by kind and place.
        """
        scored, taken = [], Covered(base)
        for span in candidates(text) if self.trees else []:
            if not taken.meets(span):
                score = self.score(features(text, span))
                if score >= self.thresholds.get(span[0], np.inf):
                    scored.append((-score, span[1] - span[2], span))
        chosen: list[Span] = []
        taken = Covered([])
        for _, _, span in sorted(scored):
            if not taken.meets(span):
                taken.add(span)
                chosen.append(span)
        return chosen


def _tree(debug: str):
    """The nested form of one tree's printed form."""
    lines = iter(line.strip() for line in debug.splitlines()[1:])

    def node():
        line = next(lines)
        if line.startswith("Predict:"):
            return float(line.split()[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        left = node()
        next(lines)  # the Else of this If
        return int(feature), float(threshold), left, node()

    return node()


def threshold(scores: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The least score whose isotonic probability of a true label reaches ``precision``; infinite if none does."""
    if not len(scores):
        return float("inf")
    order = np.argsort(scores, kind="stable")
    values, starts = np.unique(scores[order], return_index=True)
    sums = np.add.reduceat(labels[order].astype(float), starts)
    counts = np.diff([*starts, len(order)]).astype(float)
    blocks: list[list[float]] = []  # value, sum, count; pooled while they fall
    for v, s, c in zip(values, sums, counts):
        blocks.append([v, s, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, s2, c2 = blocks.pop()
            blocks[-1][1] += s2
            blocks[-1][2] += c2
    return next((v for v, s, c in blocks if s >= precision * c), float("inf"))


def train(docs: DataFrame, sample_rows: int = 3000, precision: float = 0.98, trees: int = 20, depth: int = 4) -> PiiModel:
    """Fit and calibrate on contexts from a bounded sample of ``docs``."""
    text = F.col("text").cast("string")
    key = F.xxhash64("doc_id", text)
    place = F.pmod(F.xxhash64(key), F.greatest(F.length(text), F.lit(1))).cast("int")
    seed = F.xxhash64(F.lit("plant"), key)
    cut = docs.select(key.alias("key"), F.substring(text, place, F.lit(300)).alias("context"), seed.alias("seed"))
    sample = bounded_sample(cut.where("context <> ''"), F.col("key"), sample_rows, docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for context, seed in zip(batch.column("context").to_pylist(), batch.column("seed").to_pylist()):
                for turn in range(2):
                    rows += [(*r, abs(seed) % 4 == 0) for r in examples(context, abs(seed) + turn)]
            kinds = [pa.string(), pa.bool_(), pa.list_(pa.float64()), pa.bool_()]
            columns = list(zip(*rows)) or [[]] * 4
            arrays = [pa.array(v, k) for v, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "label", "features", "held_out"])

    rows = sample.select("context", "seed").mapInArrow(run, "kind string, label boolean, features array<double>, held_out boolean")
    rows = stored(rows, "pii-examples")
    fit = rows.where("not held_out").select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    if fit.select("label").distinct().count() < 2:
        return PiiModel()
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(fit.coalesce(2))
    model = PiiModel([_tree(t.toDebugString) for t in fitted.trees], list(fitted.treeWeights))
    held = rows.where("held_out").toPandas()
    held["score"] = [model.score(list(f)) for f in held["features"]]
    for kind in KINDS:
        own = held[held["kind"] == kind]
        model.thresholds[kind] = threshold(own["score"].to_numpy(), own["label"].to_numpy(), precision)
    return model


def written(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find(docs: DataFrame, model: PiiModel) -> DataFrame:
    """Per row: doc_id, base spans per kind, their digest, all spans, and the number that the model added.

    Offsets count code points, the end is exclusive; spans are ``kind:start:end`` by kind, then start.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                added = shared.value.added(text, base)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written(base + added), len(added)))
            columns = list(zip(*rows)) or [[]] * 7
            arrays = [batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with every span in ``text`` masked; all columns stay."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                if text:
                    base = base_spans(text)
                    text = masked(text, base + shared.value.added(text, base))
                texts.append(text)
            kind = batch.schema.field(at)
            yield batch.set_column(at, kind, pa.array(texts, pa.string()).cast(kind.type))

    return docs.mapInArrow(run, docs.schema)
