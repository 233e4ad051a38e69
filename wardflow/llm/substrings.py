"""Removal of long repeated substrings by fingerprints of windows, filtered by a difference-cover sample.

Every byte inside a ``width``-byte string that starts at two places of the corpus goes. Only the first ``width``
bytes of a suffix matter, so equal prefixes are found by their fingerprints. This is not blockwise suffix sorting as
dealt: no suffix is sorted by its letters, the cover samples get no ranks, and no bytes of a match are compared. A
match rests on two independent fingerprints being equal, so the result is right but for a small probability.

1. The cover sample: starts whose place in their document lies, modulo 73, in a difference cover (the nine powers
   of two modulo 73). Any two places have a shift below 73 that takes both into the cover, so two equal strings
   contain two sampled suffixes that agree on at least ``width - 72`` bytes. The sample is dealt to buckets by the
   fingerprint of that prefix and sorted bucket by bucket; a sampled suffix with an equal is tied.
2. A suffix can only be repeated if one of the sampled suffixes at the next 73 places is tied. Those that have one
   are dealt to buckets by the fingerprint of their first ``width`` bytes and sorted bucket by bucket.

Buckets are ranges of fingerprints; their number follows the corpus, so one bucket fits into a task's memory
whatever the size: texts are first ranged by likeness, so that near copies share blocks, and a fingerprint enters
once per block, however many of the block's starts have it (a mark says that there are several). The second step compares the bucket and 10 to 14 bytes
of two fingerprints with bases and byte values of their own: 32 bits more than would do for one false match in 1,000
corpora if all bits were random, since fingerprints modulo 2 ** 64 have some weak low bits. False ties of the first
step (32 bits and the bucket) only cost work.

Cases: a null text is empty. Texts shorter than ``width`` keep everything. Copies of a text of at least ``width``
bytes lose everything. Matches never cross documents. Long texts are fingerprinted in slices.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import stored

PERIOD = 73
COVER = tuple(sorted(pow(2, k, PERIOD) for k in range(9)))
BLOCK_BYTES, SLICE = 3 << 20, 1 << 20
BUCKET_ITEMS = 1 << 21
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@lru_cache(maxsize=2)
def _tables(n: int, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, and powers of the base and of its inverse, modulo 2 ** 64."""
    values = np.random.default_rng(73 + which).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    power = np.full(n, BASES[which], np.uint64)
    inverse = np.full(n, pow(BASES[which], -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    return values, np.cumprod(power), np.cumprod(inverse)


def fingerprints(data: np.ndarray, width: int, which: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(first start, mixed 64-bit fingerprints of the ``width`` bytes from each start), slice by slice.

    There are two independent kinds, told apart by ``which``.
    """
    values, power, inverse = _tables(SLICE + 4096, which)
    for at in range(0, len(data) - width + 1, SLICE):
        x = values[data[at : at + SLICE + width - 1]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * power[: len(x)])])
        h = (sums[width:] - sums[:-width]) * inverse[: len(x) - width + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        yield at, h ^ (h >> np.uint64(32))


def _buckets(items: int) -> int:
    """Bits of the bucket number; at least a few buckets per core of a small cluster."""
    return max(6, math.ceil(math.log2(max(1, items / BUCKET_ITEMS))))


def _chosen(data: np.ndarray, ends: np.ndarray, width: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """(starts, fingerprints) of those starts that leave ``width`` bytes in their text and are ``wanted``.

    ``wanted`` is asked with starts and their places in their texts.
    """
    begins = np.concatenate([[0], ends[:-1]])
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at, h in fingerprints(data, width):
        starts = np.arange(at, at + len(h))
        text = np.searchsorted(ends, starts, side="right")
        starts_in = starts - begins[text]
        take = (starts + width <= ends[text]) & wanted(starts, starts_in)
        places.append(starts[take])
        hashes.append(h[take])
    return np.concatenate(places), np.concatenate(hashes)


def _in_cover(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    return cover[places % PERIOD]


def _packed(texts: list[bytes]) -> tuple[bytes, bytes]:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(texts)), np.cumsum([len(t) for t in texts]).astype("<i8").tobytes()


def _unpacked(data: bytes, ends: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), np.frombuffer(ends, "<i8")


BLOCK = "block long, data binary, ends binary, shas binary, size long"


GRAM = 32


def _likeness(text: bytes) -> int:
    """The least fingerprint of the text's ``GRAM``-byte strings: texts that share most of them mostly share this one."""
    return int(np.min([h.min() for _, h in fingerprints(np.frombuffer(text, np.uint8), GRAM)])) - (1 << 63)


def _blocks(docs: DataFrame, width: int) -> DataFrame:
    """Texts of at least ``width`` bytes packed into blocks, near copies next to each other, equal texts mostly once.

    What a block has several times it sends once, so near copies cost little where they share a block. They are
    ranged by likeness and then by their own hash, so a group of any size is spread over as many tasks as it fills.
    """

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, zstd = set(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            held: list[tuple] = []
            for text in batch.column("text").cast(pa.binary()):
                text = text.as_py() or b""
                sha = hashlib.sha256(text).digest()
                if len(text) >= width and sha not in seen:
                    seen.add(sha)
                    held.append((_likeness(text), sha, zstd.compress(text)))
            if held:
                kinds = [pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*held), kinds)], ["likeness", "sha", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held, shas, size = TaskContext.get().partitionId() << 32, b"", [], [], 0

        def done() -> pa.RecordBatch:
            row = (number, *_packed(held), b"".join(shas), size)
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            names = [part.split()[0] for part in BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for sha, packed in zip(batch.column("sha").to_pylist(), batch.column("packed")):
                if sha == before:
                    continue
                before, text = sha, zstandard.ZstdDecompressor().decompress(packed.as_py())
                held.append(text)
                shas.append(sha)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield done()
                    number, held, shas, size = number + 1, [], [], 0
        if held:
            yield done()

    texts = docs.select(F.col("text").cast("string")).mapInArrow(prepare, "likeness long, sha binary, packed binary")
    return texts.repartitionByRange("likeness", "sha").sortWithinPartitions("likeness", "sha").mapInArrow(run, BLOCK)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows in order, how often each occurs, where each start has its own); a row is one or two fingerprints."""
    hashes = hashes.reshape(len(hashes), -1) if len(hashes) else hashes.reshape(0, 1)
    order = np.lexsort(hashes.T[::-1])
    ordered = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    where = np.empty(len(hashes), np.int64)
    where[order] = np.cumsum(new) - 1
    return ordered[new], np.bincount(where, minlength=int(new.sum())), where


def _dealt(block: int, hashes: np.ndarray, bits: int, wide: int) -> Iterator[pa.RecordBatch]:
    """The distinct fingerprints of a block as one row per bucket, in order, with a bit for those that occur twice."""
    keys, counts, _ = _distinct(hashes)
    twice = counts > 1
    numbers, firsts = np.unique((keys[:, 0] >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
    # The bucket is the top of the first fingerprint, so of two the second goes first.
    raw = np.ascontiguousarray(keys[:, ::-1]).astype("<u8").view(np.uint8).reshape(len(keys), -1)[:, :wide]
    cuts = list(zip(firsts, [*firsts[1:], len(keys)]))
    blobs = [raw[a:b].tobytes() for a, b in cuts]
    again = [np.packbits(twice[a:b]).tobytes() for a, b in cuts]
    arrays = [pa.array(numbers), pa.array([block] * len(blobs), pa.int64()), pa.array(blobs, pa.binary()), pa.array(again, pa.binary())]
    yield pa.RecordBatch.from_arrays(arrays, ["bucket", "block", "hashes", "twice"])


def _ties(dealt: DataFrame, wide: int) -> DataFrame:
    """(block, flags): per block, the buckets with a tied fingerprint and which of their fingerprints are tied."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("hashes").to_pylist()
        sizes = np.array([len(b) // wide for b in blobs])
        values = np.zeros((sizes.sum(), 8 if wide <= 8 else 16), np.uint8)
        values[:, :wide] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, wide)
        bits = zip(table.column("twice").to_pylist(), sizes)
        twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in bits]).astype(bool)
        _, counts, where = _distinct(values.view("<u8"))
        again = counts > 1
        again[where[twice]] = True
        tied = again[where]
        parts = np.split(tied, np.cumsum(sizes)[:-1])
        met = [k for k, part in enumerate(parts) if part.any()]
        packed = pa.array([np.packbits(parts[k]).tobytes() for k in met], pa.binary())
        return table.select(["block", "bucket"]).take(pa.array(met, pa.int64())).append_column("tied", packed)

    found = dealt.groupBy("bucket").applyInArrow(run, "block long, bucket long, tied binary")
    return found.groupBy("block").agg(F.collect_list(F.struct("bucket", "tied")).alias("flags"))


def _flagged(hashes: np.ndarray, bits: int, flags: list[dict] | None) -> np.ndarray:
    """Which of a block's fingerprints are tied, from the flags of its buckets."""
    keys, _, where = _distinct(hashes)
    firsts = np.searchsorted((keys[:, 0] >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
    tied = np.zeros(len(keys), bool)
    for flag in flags or []:
        a, b = firsts[flag["bucket"]], firsts[flag["bucket"] + 1]
        tied[a:b] = np.unpackbits(np.frombuffer(flag["tied"], np.uint8), count=b - a).astype(bool)
    return tied[where]


def _marked(n: int, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the ranges."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, firsts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def _candidates(blocks: DataFrame, width: int) -> DataFrame:
    """Blocks of the texts that may hold a repeated string, with a bit per start that has a tied sample near."""
    short = width - PERIOD + 1
    total = blocks.agg(F.sum("size")).first()[0] or 0
    bits = _buckets(total * len(COVER) // PERIOD)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _dealt(row["block"], _chosen(*_unpacked(row["data"], row["ends"]), short, _in_cover)[1], bits, 4)

    dealt = blocks.select("block", "data", "ends").mapInArrow(sample, "bucket long, block long, hashes binary, twice binary")
    flags = stored(_ties(dealt, 4), "sample-ties")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, ends = _unpacked(row["data"], row["ends"])
                starts, hashes = _chosen(data, ends, short, _in_cover)
                starts = starts[_flagged(hashes, bits, row["flags"])]
                begins = np.concatenate([[0], ends[:-1]])
                text = np.searchsorted(ends, starts, side="right")
                near = _marked(len(data), np.maximum(starts - PERIOD + 1, begins[text]), starts + 1)
                texts, marks, shas, count = [], [], [], 0
                for k, (a, b) in enumerate(zip(begins, ends)):
                    own = near[a:b]
                    own[b - a - width + 1 :] = False
                    if own.any():
                        texts.append(data[a:b].tobytes())
                        marks.append(own)
                        shas.append(row["shas"][32 * k : 32 * k + 32])
                        count += int(own.sum())
                if texts:
                    bitmap = zstandard.ZstdCompressor().compress(np.packbits(np.concatenate(marks)).tobytes())
                    values = (row["block"], *_packed(texts), b"".join(shas), bitmap, count)
                    kinds = [pa.int64(), *[pa.binary()] * 4, pa.int64()]
                    names = ["block", "data", "ends", "shas", "marks", "size"]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    joined = blocks.join(flags, "block").select("block", "data", "ends", "shas", "flags")
    schema = "block long, data binary, ends binary, shas binary, marks binary, size long"
    return joined.mapInArrow(choose, schema)


def _windows(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, ends, starts, both fingerprints) of a candidate block's marked starts."""
    data, ends = _unpacked(row["data"], row["ends"])
    raw = zstandard.ZstdDecompressor().decompress(row["marks"])
    marks = np.unpackbits(np.frombuffer(raw, np.uint8), count=len(data)).astype(bool)
    starts, first = _chosen(data, ends, width, lambda starts, _: marks[starts])
    second = [np.zeros(0, np.uint64)]
    for at, h in fingerprints(data, width, 1):
        a, b = np.searchsorted(starts, [at, at + len(h)])
        second.append(h[starts[a:b] - at])
    return data, ends, starts, np.column_stack([first, np.concatenate(second)])


def _removals(candidates: DataFrame, width: int) -> DataFrame:
    """(sha, n_removed, n_spans, kept_sha256) per candidate text."""
    total = candidates.agg(F.sum("size")).first()[0] or 0
    bits = _buckets(total)
    wide = min(14, max(10, math.ceil((2 * math.log2(max(2, total)) + 9 + 32 - bits) / 8)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _dealt(row["block"], _windows(row, width)[3], bits, wide)

    dealt = candidates.mapInArrow(deal, "bucket long, block long, hashes binary, twice binary")
    flags = stored(_ties(dealt, wide), "window-ties")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                data, ends, starts, hashes = _windows(row, width)
                starts = starts[_flagged(hashes, bits, row["flags"])]
                gone = _marked(len(data), starts, starts + width)
                for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                    own = gone[a:b]
                    if own.any():
                        spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum())
                        kept = hashlib.sha256(data[a:b][~own].tobytes()).hexdigest()
                        rows.append((row["shas"][32 * k : 32 * k + 32].hex(), int(own.sum()), spans, kept))
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
                arrays = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["sha", "n_removed", "n_spans", "kept_sha256"])

    joined = candidates.join(flags, "block").select("block", "data", "ends", "shas", "marks", "flags")
    return joined.mapInArrow(remove, "sha string, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    if width < 2 * PERIOD:
        raise ValueError(f"the difference cover needs strings of at least {2 * PERIOD} bytes")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    rows = stored(rows, "texts")
    blocks = stored(_blocks(docs, width), "blocks")
    candidates = stored(_candidates(blocks, width), "candidates")
    # A text with a copy is found once per task; all of it is repeated, so what was found is not needed.
    found = _removals(candidates, width).dropDuplicates(["sha"])
    classes = rows.groupBy("sha").agg(F.count("*").alias("copies"), F.first("n_bytes").alias("bytes"))
    whole = (F.col("copies") > 1) & (F.col("bytes") >= width)
    known = classes.join(found, "sha", "left").select(
        "sha",
        F.when(whole, F.col("bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
    known = stored(known, "known")
    return rows.join(known, "sha").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
