"""Cross-entropy difference: bigram models of a target and of the whole corpus score every document.

Words are white-space runs in lower case, known by 64-bit hashes; pairs of neighbours have 64-bit keys of their own.
Both models have the same form: pairs smoothed towards single words, those towards equal shares of the words of the
corpus. The models are matched in size: the corpus counts are scaled to as many words as the target has, which is
what a sample of that size would hold on average. A document's score is its mean loss per word under the target less
that under the corpus; low scores are most like the target.

Counts cover every word and pair of every document, and grow with the corpus. Documents are packed into blocks of
about ``BLOCK_WORDS`` words. A block sends each of its distinct keys once, with its counts, to the key's bucket;
there the counts of all blocks are added up, and the sums go back to the blocks that hold the key, which score their
documents with them. A key in every document is one entry per block. The number of buckets follows the number of
words, and no model is ever held in one place. ``word_bits`` and ``pair_bits`` below 64 fold keys together.

Cases: a null or empty text has no words and null scores. Repeated rows count each time. Documents without a label
count for the corpus only; of several labels of a document all must call it good. Without target documents all
scores are null. Texts have no length limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import stored

BLOCK_WORDS, BLOCK_DOCS = 1 << 21, 1 << 16
BLOCK_CELLS = 1 << 20  # entries that a bucket adds up, on average
FAN_IN = 32  # buckets at least


@dataclass(frozen=True)
class Shape:
    word_bits: int = 64
    pair_bits: int = 64
    pull: float = 4.0  # words that the smoothing towards single words weighs


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text.cast("string")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<long>"))


def cells(h: np.ndarray, lengths: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, pair keys, first words of a document) for the word hashes of several documents."""
    firsts = np.zeros(len(h), bool)
    firsts[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    before = np.concatenate([np.zeros(min(1, len(h)), np.uint64), h[:-1]])
    before[firsts] = np.uint64(0)
    pair = (before * np.uint64(0x9E3779B97F4A7C15)) ^ h
    pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    top = lambda x, bits: x & np.uint64((1 << 64) - (1 << (64 - bits)))
    return top(h, shape.word_bits), top(pair, shape.pair_bits), firsts


BLOCK = "block long, ids array<long>, lengths array<long>, hashes binary, codes binary, words long, starts long"
WORDS, PAIRS = 0, 1
ENTRIES = "kind int, bucket long, block long, keys binary, counts binary"
SUMS = "kind int, bucket long, block long, distinct long, sums binary"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _pack(values: np.ndarray) -> bytes:
    """Compressed, byte by byte of all values: the high bytes of small numbers are runs."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _blocks(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` in blocks."""
    rows = docs.select(F.col("doc_id").cast("long"), word_hashes(F.col("text")).alias("words"))
    most_words, most_docs = BLOCK_WORDS, BLOCK_DOCS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, docs = TaskContext.get().partitionId() << 32, [], 0, 0

        def done() -> pa.RecordBatch:
            ids, lengths, flat = ([h[k] for h in held] for k in range(3))
            lengths, flat = np.concatenate(lengths), np.concatenate(flat)
            hashes, codes = np.unique(flat, return_inverse=True)
            ids = [x for part in ids for x in part.to_pylist()]
            row = (number, ids, lengths.tolist(), _pack(hashes.astype("<u8")), _pack(codes.astype("<i4")), len(flat), int((lengths > 0).sum()))
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 2, *[pa.int64()] * 2]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], _names(BLOCK))

        for batch in batches:
            column = batch.column("words")
            offsets = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).view(np.uint64)
            offsets -= offsets[0]
            a = 0
            while a < batch.num_rows:
                fit = np.searchsorted(offsets, offsets[a] + most_words - size, side="left")
                b = int(min(batch.num_rows, a + most_docs - docs, max(a + 1, fit)))
                held.append((batch.column("doc_id").slice(a, b - a), np.diff(offsets[a : b + 1]), flat[offsets[a] : offsets[b]]))
                size, docs, a = size + int(offsets[b] - offsets[a]), docs + b - a, b
                if size >= most_words or docs >= most_docs:
                    yield done()
                    number, held, size, docs = number + 1, [], 0, 0
        if held:
            yield done()

    return stored(rows.mapInArrow(run, BLOCK), "word-blocks")


def _targets(blocks: DataFrame, good: DataFrame) -> DataFrame:
    """(block, good, good_words, good_starts): the places of a block's documents whose id is in ``good`` (doc_id)."""
    each = blocks.select("block", F.posexplode(F.arrays_zip("ids", "lengths")).alias("place", "doc"))
    # There may be as many labels as documents, so both sides are shuffled, few labels or many.
    met = each.join(good.hint("merge"), F.col("doc.ids") == F.col("doc_id"))
    words = F.col("doc.lengths")
    return stored(met.groupBy("block").agg(F.collect_list("place").alias("good"), F.sum(words).alias("good_words"), F.count_if(words > 0).alias("good_starts")), "targets")


def _keys(row: dict, shape: Shape) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(lengths, first words, distinct keys in order and where each word has them, for words and pairs) of a block."""
    lengths = np.array(row["lengths"], np.int64)
    word, pair, firsts = cells(_unpack(row["hashes"], "<u8")[_unpack(row["codes"], "<i4")], lengths, shape)
    return lengths, firsts, [np.unique(k, return_inverse=True) for k in (word, pair)]


def _sums(blocks: DataFrame, targets: DataFrame, words: int, shape: Shape) -> DataFrame:
    """Per kind, bucket and block: the counts in corpus and target of the block's keys in that bucket, in their order.

    ``distinct`` has the number of keys of the bucket once, and 0 elsewhere.
    """
    bits = max(math.ceil(math.log2(FAN_IN)), math.ceil(math.log2(max(1, words / BLOCK_CELLS))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths, _, both = _keys(row, shape)
                good = np.zeros(len(lengths), bool)
                good[row["good"] or []] = True
                of_good = np.repeat(good, lengths)
                for kind, (keys, where) in enumerate(both):
                    counts = [np.bincount(w, minlength=len(keys)).astype("<u4") for w in (where, where[of_good])]
                    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    numbers, firsts = np.unique(bucket, return_index=True)
                    cuts = list(zip(firsts, [*firsts[1:], len(keys)]))
                    columns = [
                        pa.array([kind] * len(cuts), pa.int32()), pa.array(numbers), pa.array([row["block"]] * len(cuts), pa.int64()),
                        pa.array([_pack(np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8")) for a, b in cuts], pa.binary()),
                        pa.array([_pack(np.concatenate([c[a:b] for c in counts])) for a, b in cuts], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, _names(ENTRIES))

    def add(table: pa.Table) -> pa.Table:
        held = [np.cumsum(_unpack(k, "<u8"), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        keys, where = np.unique(np.concatenate(held), return_inverse=True)
        counts = [_unpack(c, "<u4").reshape(2, -1) for c in table.column("counts").to_pylist()]
        sums = [np.bincount(where, weights=c, minlength=len(keys)).astype("<i8")[where] for c in np.concatenate(counts, axis=1)]
        ends = np.cumsum([len(k) for k in held])
        packed = [_pack(np.concatenate([s[b - len(k) : b] for s in sums])) for k, b in zip(held, ends)]
        distinct = pa.array([len(keys)] + [0] * (len(held) - 1), pa.int64())
        return table.select(["kind", "bucket", "block"]).append_column("distinct", distinct).append_column("sums", pa.array(packed, pa.binary()))

    held = blocks.select("block", "lengths", "hashes", "codes").join(targets.select("block", "good").hint("merge"), "block", "left")
    dealt = held.mapInArrow(deal, ENTRIES)
    return stored(dealt.groupBy("kind", "bucket").applyInArrow(add, SUMS), "ngram-sums")


SCORES = "doc_id long, n_tokens long, ce_target double, ce_background double, ce_difference double"


def _losses(row: dict, shape: Shape, total: int, target: int, starts: list[int], in_use: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per document of a block, and -ln P(word | previous) of its words under the target and the corpus."""
    lengths, firsts, both = _keys(row, shape)
    back = {(s["kind"], s["bucket"]): _unpack(s["sums"], "<i8").reshape(2, -1) for s in row["sums"] or []}
    counts = [np.concatenate([back[k] for k in sorted(back) if k[0] == kind] or [np.zeros((2, 0), np.int64)], axis=1) for kind in (WORDS, PAIRS)]
    out = []
    for which, by in ((1, 1.0), (0, target / total)):
        single, together = ((c[which] * by)[where] for c, (_, where) in zip(counts, both))
        seen = np.concatenate([np.zeros(min(1, len(single))), single[:-1]])
        seen[firsts] = starts[which] * by
        p_word = (single + 1.0) / (target + in_use)
        # Folded pairs can count more than their first word.
        out.append(-np.log((np.minimum(together, seen) + shape.pull * p_word) / (seen + shape.pull)))
    return lengths, out


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids of the documents that every one of their labels calls of good quality and not toxic."""
    grouped = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = F.coalesce(F.col("quality") == 1, F.lit(False)) & F.coalesce(F.col("toxic") == 0, F.lit(False))
    return grouped.agg(F.min(good).alias("good")).where("good").select("doc_id")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Per row: doc_id, n_tokens, mean loss per word under both models, and the difference."""
    blocks = _blocks(docs)
    targets = _targets(blocks, good_documents(labels))
    total, start_all = (x or 0 for x in blocks.agg(F.sum("words"), F.sum("starts")).first())
    target, start_good = (x or 0 for x in targets.agg(F.sum("good_words"), F.sum("good_starts")).first())
    starts = [start_all, start_good]
    sums = _sums(blocks, targets, total, shape)
    in_use = sums.where(F.col("kind") == WORDS).agg(F.sum("distinct")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths, losses = np.array(row["lengths"], np.int64), []
                if target:
                    lengths, losses = _losses(row, shape, total, target, starts, in_use)
                ends, means = np.cumsum(lengths), []
                for loss in losses:
                    run = np.concatenate([[0.0], np.cumsum(loss)])
                    with np.errstate(invalid="ignore"):
                        means.append((run[ends] - run[ends - lengths]) / lengths)
                means = means or [np.full(len(lengths), np.nan)] * 2
                columns = [pa.array(m, from_pandas=True) for m in (*means, means[0] - means[1])]
                arrays = [pa.array(row["ids"], pa.int64()), pa.array(lengths), *columns]
                yield pa.RecordBatch.from_arrays(arrays, _names(SCORES))

    back = sums.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "sums")).alias("sums")).hint("merge")
    held = blocks.select("block", "ids", "lengths", "hashes", "codes").join(back, "block", "left")
    return held.mapInArrow(run, SCORES)
