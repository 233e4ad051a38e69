"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q that is at least 4 q long (and at least ``min_length``) and that
no neighbouring word extends. Texts are dealt to batches of some 100,000 words; in each, per batch:

1. Suffixes are sorted by prefix doubling. After each round the groups of suffixes that agree on 1, 2, 4, ... words
   are marked, so the occurrences of any dyadic block of m words are an interval of the suffix array. Only groups of
   two and more are sorted further.
2. The suffix array is put into a wavelet tree (one bitmap per bit of a position, with counts per 64 bits).
3. For every m a block starts at every max(1, m / 4)-th word. Its next occurrence within the following m words is
   the range successor of its place in its interval; the distance d, if above m / 2, is a candidate period. A run of
   period q holds, with m / 2 < q <= m, a block and the copy of it q words later, and a whole period of it occurs
   nowhere between: so no run is missed, and a candidate is the smallest period of the stretch that it starts.
4. Blocks of one progression (equal distances, overlapping) are joined, and the stretch is extended by comparing words.

Words are numbered per text, so nothing matches across texts. A text longer than a batch is a batch of its own; memory
is some 100 bytes per word.

Cases: a null text has no words; texts with fewer than ``min_length`` words have no run. Repeated rows are answered
each. A null ``doc_id`` stays null. White space is that of ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BATCH_WORDS = 100_000
QUERIES_AT_ONCE = 1 << 16
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class WaveletTree:
    """Positions in suffix order, level by level of their bits, for range successors."""

    def __init__(self, values: np.ndarray) -> None:
        self.n, self.levels = len(values), max(1, int(len(values) - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            ones = (values >> level) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(self.n // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.bitwise_count(words).astype(np.int32)
            self.bits.append(words)
            self.before.append(np.cumsum(counts, dtype=np.int32) - counts)
            self.zeros.append(self.n - int(counts.sum()))
            values = np.concatenate([values[~ones], values[ones]])

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits of level ``k`` are set."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[k][word] + np.bitwise_count(self.bits[k][word] & low)

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Per query the smallest value of at least ``least`` among places lo..hi-1; ``n`` where there is none."""
        a, b, smaller = lo, hi, np.zeros(len(lo), np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one_a, one_b = self._ones(k, a), self._ones(k, b)
            right = (least >> level) & 1 == 1
            smaller += np.where(right, (b - one_b) - (a - one_a), 0)
            a = np.where(right, self.zeros[k] + one_a, a - one_a)
            b = np.where(right, self.zeros[k] + one_b, b - one_b)
        found = np.full(len(lo), self.n, np.int64)
        some = np.flatnonzero((smaller < hi - lo) & (least < self.n))
        a, b, skip, value = lo[some], hi[some], smaller[some], np.zeros(len(some), np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one_a, one_b = self._ones(k, a), self._ones(k, b)
            zeros = (b - one_b) - (a - one_a)
            right = skip >= zeros
            skip = np.where(right, skip - zeros, skip)
            value |= right.astype(np.int64) << level
            a = np.where(right, self.zeros[k] + one_a, a - one_a)
            b = np.where(right, self.zeros[k] + one_b, b - one_b)
        found[some] = value
        return found


def sorted_suffixes(ids: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, marks): ``marks[k]`` has, packed, where groups that agree on 2 ** k words begin.

    Rounds end when all suffixes differ, or agree on ``longest`` words.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    new = np.ones(n, bool)
    new[1:] = ids[order][1:] != ids[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    marks, step = [np.packbits(new)], 1
    while 2 * step <= longest:
        ends = np.ones(n, bool)
        ends[:-1] = new[1:]
        open_ = np.flatnonzero(~(new & ends))
        if not len(open_):
            break
        suffixes = order[open_]
        later = np.zeros(len(suffixes), np.int64)
        inside = suffixes + step < n
        later[inside] = rank[suffixes[inside] + step] + 1
        key = rank[suffixes] * (n + 1) + later
        turn = np.argsort(key, kind="stable")
        suffixes, key = suffixes[turn], key[turn]
        order[open_] = suffixes
        new[open_[1:]] |= key[1:] != key[:-1]
        rank[suffixes] = np.maximum.accumulate(np.where(new, np.arange(n), 0))[open_]
        marks.append(np.packbits(new))
        step *= 2
    return order, marks


def _stretches(ids: np.ndarray, starts: np.ndarray, periods: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, end, period) of the maximal stretches around the blocks ``starts`` of ``width`` words and their copies."""
    turn = np.lexsort((starts, periods))
    starts, periods = starts[turn], periods[turn]
    first = np.ones(len(starts), bool)
    first[1:] = (periods[1:] != periods[:-1]) | (starts[1:] > starts[:-1] + width)
    last = np.append(first[1:], True)
    begin, q = starts[first].copy(), periods[first]
    end = starts[last] + q + width
    growing = np.arange(len(begin))
    while len(growing):
        growing = growing[begin[growing] > 0]
        growing = growing[ids[begin[growing] - 1] == ids[begin[growing] - 1 + q[growing]]]
        begin[growing] -= 1
    growing = np.arange(len(begin))
    while len(growing):
        growing = growing[end[growing] < len(ids)]
        growing = growing[ids[end[growing]] == ids[end[growing] - q[growing]]]
        end[growing] += 1
    return begin, end, q


def find_runs(ids: np.ndarray, longest: int, exponent: int, min_length: int) -> np.ndarray:
    """(start, end, period) of all runs in ``ids``, by start and period; no run is longer than ``longest``."""
    n = len(ids)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    order, marks = sorted_suffixes(ids, max(1, 2 * (longest // exponent)))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    tree, found = WaveletTree(order), []
    for k, packed in enumerate(marks):
        width = 1 << k
        groups = np.flatnonzero(np.unpackbits(packed, count=n))
        number = np.searchsorted(groups, place[:: max(1, width // 4)], side="right") - 1
        bounds = np.append(groups, n)
        lo, hi = bounds[number], bounds[number + 1]
        many = np.flatnonzero(hi - lo > 1)
        starts, periods = [], []
        for at in range(0, len(many), QUERIES_AT_ONCE):
            some = many[at : at + QUERIES_AT_ONCE]
            x = some * max(1, width // 4)
            distance = tree.successor(lo[some], hi[some], x + 1) - x
            near = (distance <= width) & (2 * distance > width) & (x + distance < n)
            starts.append(x[near])
            periods.append(distance[near])
        if sum(map(len, starts)):
            begin, end, q = _stretches(ids, np.concatenate(starts), np.concatenate(periods), width)
            long = end - begin >= np.maximum(min_length, exponent * q)
            found.append(np.column_stack([begin, end, q])[long])
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = np.unique(runs, axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _answer(held: list[tuple], exponent: int, min_length: int) -> pa.RecordBatch:
    """The rows of a batch of (doc_id, words) with words as bytes."""
    sizes = np.array([len(words) for _, words in held])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = pa.array([w for _, words in held for w in words], pa.binary()).dictionary_encode()
    ids = flat.indices.to_numpy().astype(np.int64) + (np.repeat(np.arange(len(held)), sizes) << 32)
    runs = find_runs(ids, int(sizes.max(initial=0)), exponent, min_length)
    cuts = np.searchsorted(runs[:, 0], bounds)
    rows, texts = [], []
    for k, (_, words) in enumerate(held):
        own = runs[cuts[k] : cuts[k + 1]]
        start, end, q = own[:, 0] - bounds[k], own[:, 1] - bounds[k], own[:, 2]
        rows.append([{"start": int(s), "length": int(e - s), "period": int(p)} for s, e, p in zip(start, end, q)])
        if len(own):
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, start + q, 1)
            np.add.at(gone, end, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
        texts.append(b" ".join(words).decode())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    arrays = [pa.array([d for d, _ in held], pa.int64()), pa.array(sizes, pa.int64()), pa.array(rows, kind), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, exponent: int = 4, min_length: int = 6) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``.

    ``runs`` has (start, length, period) in words, by start and period. ``collapsed`` is the text with every run cut
    to its first period, words joined by one space.
    """
    if exponent < 4:
        raise ValueError("blocks at every quarter find runs of at least four periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                # bytes.split() takes exactly the white space of ASCII.
                words = (text.as_py() or b"").split()
                if held and size + len(words) > BATCH_WORDS:
                    yield _answer(held, exponent, min_length)
                    held, size = [], 0
                held.append((doc_id, words))
                size += len(words)
        if held:
            yield _answer(held, exponent, min_length)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact exponent, the earliest and then shortest period among equals; null without any."""

    def better(best: Column, run: Column) -> Column:
        old, new = best["length"].cast("decimal(19,0)") * run["period"], run["length"].cast("decimal(19,0)") * best["period"]
        return F.when(best.isNull() | (new > old), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a repetition planted into the text of every document whose id's crc32 ends in 0, as the query wants it.

    With h = crc32(decimal id), g = floor(h / 10) and n words: from word a = g % n on, word i becomes word
    a + (i - a) % p of the original, p = 1 + floor((n - a) / (3 + g % 8)). Rows without an id or a word stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("words").cast("long"), F.floor(h / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    rotate = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    planted = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"))
    planted = planted.select("doc_id", "text", "words", F.when(n > 0, a).alias("a"), F.when(n > 0, p).alias("p"))
    return planted.select("doc_id", F.when(F.size("words") > 0, F.array_join(rotate, " ")).otherwise(F.col("text")).alias("text"))
