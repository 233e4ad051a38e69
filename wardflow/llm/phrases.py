"""Phrases of two and three words that stand together more often than their parts, counted in quotient filters.

Everything holds per language. Only words that occur ``min_count`` times can be in a phrase that does, so:

1. Texts are cut into blocks of some megabytes: local word numbers in order, and the distinct words with counts.
2. The counts of all blocks are summed. Frequent words get dense ids of b bits and are joined back to the blocks that
   hold them, one row per block and word.
3. Every block packs its pairs and triples of frequent words into 3 b bits (the third id of a pair is 0), permutes
   them by an invertible Feistel network and counts them in quotient filters: the top bits of the permuted number
   select the shard, the next ones are the quotient, and the remainder is kept whole, so counts are exact and the
   n-gram comes back out of its place in the filter.
4. The filters of a shard are sorted, so they merge into one; counts of at least ``min_count`` are unpacked. With
   many shards they are merged on the way in levels of 2 ** ``LEVEL_BITS`` ranges, so that a block's row never gets
   down to a few n-grams.
5. Scores, containment and ranks are DataFrame operations on the counts, in decimal arithmetic.

An n-gram costs a block one entry however often it occurs there, and shards are ranges of permuted numbers, so
neither a very common word nor pair makes a large group. Texts longer than a block are cut between words, the last two
words going along as context that is not counted again. At most 2 ** 32 - 1 frequent words have ids; more are an error.

Cases: a null text is empty, a null language is ``und``. Repeated rows count each. Words are compared by their bytes
after A-Z are lower-cased. Equal scores are ordered by count, then by phrase. An empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.llm.common import stored

BLOCK_BYTES = 8 << 20
SHARD_ENTRIES = 1 << 21
LEVEL_BITS, LEAST_BITS = 10, 6
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
BLOCKS = "block long, lang string, context int, size int, ids binary, words array<string>, counts array<long>"
GRAMS = "w1 long, w2 long, w3 long, n long"
# Capital letters of ASCII, tabulators as blanks, and every mark that ends a piece as a line end.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b" " + b"\n" * 9)


# ---- blocks -------------------------------------------------------------------------------------------------


def _slices(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(slice, words of context it begins with) of a folded text, cut between words into slices of a block's size."""
    at, context = 0, b""
    while at < len(text):
        end = at + BLOCK_BYTES
        if end >= len(text):
            end = len(text)
        else:
            cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            if cut <= at:
                cut = min((k for k in (text.find(b" ", end), text.find(b"\n", end)) if k >= 0), default=len(text))
            end = cut
        piece = context + text[at:end]
        yield piece, context.count(b" ")
        last = piece[piece.rfind(b"\n") + 1 :].split()[-2:]
        context = b"".join(word + b" " for word in last)
        at = end


def _words(data: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(the words of folded text, which of them begin a piece)."""
    raw = np.frombuffer(data, np.uint8)
    gap = (raw == 32) | (raw == 10)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = pa.py_buffer(raw[~gap].tobytes())
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.tobytes()), letters])
    lines = np.searchsorted(np.flatnonzero(raw == 10), starts)
    begins = np.ones(len(starts), bool)
    begins[1:] = lines[1:] != lines[:-1]
    return words.dictionary_encode(), begins


def _block(number: int, lang: str, data: bytes, context: int) -> pa.RecordBatch | None:
    words, begins = _words(data)
    if len(words) <= context:
        return None
    local = words.indices.to_numpy().astype(np.uint32)
    counts = np.bincount(local[context:], minlength=len(words.dictionary))
    ids = zstandard.ZstdCompressor(level=1).compress((local << np.uint32(1) | begins).astype("<u4").tobytes())
    arrays = [
        pa.array([number], pa.int64()), pa.array([lang]), pa.array([context], pa.int32()), pa.array([len(counts)], pa.int32()),
        pa.array([ids], pa.binary()),
        pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), words.dictionary.cast(pa.string())),
        pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in BLOCKS.split(", ")])


def _blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                text = (text.as_py() or b"").translate(FOLD)
                if len(text) > BLOCK_BYTES:
                    ready = [(lang, *piece) for piece in _slices(text)]
                else:
                    held.setdefault(lang, []).append(text)
                    size += len(text)
                    ready = []
                    if size >= BLOCK_BYTES:
                        ready, held, size = [(k, b"\n".join(v), 0) for k, v in held.items()], {}, 0
                for row in ready:
                    if (made := _block(number, *row)) is not None:
                        yield made
                        number += 1
        for k, v in held.items():
            if (made := _block(number, k, b"\n".join(v), 0)) is not None:
                yield made
                number += 1

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, BLOCKS)


# ---- packing and filters ------------------------------------------------------------------------------------


def _mix(values: np.ndarray, key: int, bits: int) -> np.ndarray:
    """A pseudo-random function into ``bits`` bits."""
    values = (values + np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    return (values ^ (values >> np.uint64(32))) & np.uint64((1 << bits) - 1)


def permuted(high: np.ndarray, low: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """An n-gram, its first two ids in the 2 b bits of ``high`` and its third in the b bits of ``low``, permuted."""
    for k, key in enumerate(ROUNDS):
        high, low = (high, low ^ _mix(high, key, b)) if k % 2 else (high ^ _mix(low, key, 2 * b), low)
    return high, low


def restored(high: np.ndarray, low: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of :func:`permuted`."""
    for k, key in reversed(list(enumerate(ROUNDS))):
        high, low = (high, low ^ _mix(high, key, b)) if k % 2 else (high ^ _mix(low, key, 2 * b), low)
    return high, low


def _counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (high, low) in order with their summed counts; each counts once without ``counts``."""
    if 3 * b <= 64:
        key = high << np.uint64(b) | low
        if counts is None:
            key = np.sort(key)
            turn = None
        else:
            turn = np.argsort(key, kind="stable")
            key = key[turn]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        high, low = key[new] >> np.uint64(b), key[new] & np.uint64((1 << b) - 1)
    else:
        turn = np.lexsort((low, high))
        high, low = high[turn], low[turn]
        new = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(high) else np.zeros(0, np.int64)
        n, high, low = len(high), high[new], low[new]
    if counts is None:
        return high, low, np.diff(np.append(new, len(key) if 3 * b <= 64 else n))
    return high, low, np.add.reduceat(counts[turn], new) if len(new) else np.zeros(0, np.int64)


def _narrow(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each value, in whole bytes."""
    wide = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]).tobytes()


def _widen(data: memoryview, n: int, bits: int) -> np.ndarray:
    wide = -(-bits // 8)
    full = np.zeros((n, 8), np.uint8)
    full[:, :wide] = np.frombuffer(data, np.uint8, n * wide).reshape(n, wide)
    return full.view("<u8").reshape(n).astype(np.uint64)


class CountingQuotientFilter:
    """Exact counts of permuted n-grams whose top ``prefix`` bits are ``shard``, in the places their quotients give.

    The quotient is the next ``quotient_bits`` bits. One bit per quotient says whether it occurs, one bit per entry
    whether it ends the run of its quotient; entries are whole remainders in order, with a byte per count and the
    counts of 255 and more apart.
    """

    def __init__(self, shard: int, prefix: int, b: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> None:
        self.shard, self.prefix, self.b, self.n = shard, prefix, b, len(high)
        self.quotient_bits = max(0, min(2 * b - prefix, int(self.n).bit_length()))
        self.rest = 2 * b - prefix - self.quotient_bits
        quotients = (high >> np.uint64(self.rest)).astype(np.int64) & ((1 << self.quotient_bits) - 1)
        occupied = np.zeros(1 << self.quotient_bits, bool)
        occupied[quotients] = True
        run_ends = np.append(quotients[1:] != quotients[:-1], True)[: self.n]
        large = counts[counts >= 255]
        head = struct.pack("<qBBBqq", shard, prefix, b, self.quotient_bits, self.n, len(large))
        self.data = b"".join([
            head, np.packbits(occupied).tobytes(), np.packbits(run_ends).tobytes(), _narrow(high, self.rest), _narrow(low, b),
            np.minimum(counts, 255).astype(np.uint8).tobytes(), large.astype("<i8").tobytes(),
        ])

    @staticmethod
    def entries(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(high, low, counts) of a filter's bytes, in order."""
        shard, prefix, b, quotient_bits, n, n_large = struct.unpack_from("<qBBBqq", data)
        rest = 2 * b - prefix - quotient_bits
        view, at = memoryview(data), struct.calcsize("<qBBBqq")

        def part(size: int) -> memoryview:
            nonlocal at
            at += size
            return view[at - size : at]

        slots = 1 << quotient_bits
        occupied = np.flatnonzero(np.unpackbits(np.frombuffer(part(-(-slots // 8)), np.uint8), count=slots))
        run_ends = np.unpackbits(np.frombuffer(part(-(-n // 8)), np.uint8), count=n).astype(np.int64)
        quotients = occupied[np.cumsum(run_ends) - run_ends] if n else np.zeros(0, np.int64)
        high = _widen(part(n * -(-rest // 8)), n, rest) & np.uint64((1 << rest) - 1)
        high |= ((shard << quotient_bits) + quotients).astype(np.uint64) << np.uint64(rest) if rest < 64 else np.uint64(0)
        low = _widen(part(n * -(-b // 8)), n, b)
        counts = np.frombuffer(part(n), np.uint8).astype(np.int64)
        counts[counts == 255] = np.frombuffer(part(8 * n_large), "<i8")
        return high, low, counts

    @classmethod
    def merged(cls, filters: list[bytes], b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sum of sorted filters, in order."""
        parts = [cls.entries(data) for data in filters]
        return _counted(*(np.concatenate(column) for column in zip(*parts)), b)


def _dealt(block: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray, prefix: int, b: int) -> pa.RecordBatch:
    """A row (shard, block, data) per shard that ordered entries fall into."""
    shards = (high >> np.uint64(2 * b - prefix)).astype(np.int64)
    numbers, firsts = np.unique(shards, return_index=True)
    cuts = list(zip(firsts, [*firsts[1:], len(shards)]))
    data = [CountingQuotientFilter(int(s), prefix, b, high[i:j], low[i:j], counts[i:j]).data for s, (i, j) in zip(numbers, cuts)]
    arrays = [pa.array(numbers, pa.int64()), pa.array([block] * len(data), pa.int64()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "block", "data"])


def _ngrams(ids: np.ndarray, begins: np.ndarray, context: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and triples of frequent words (id above 0) in one piece that end behind the context, packed."""
    frequent, wide = ids > 0, np.uint64(b)
    joined = frequent[1:] & frequent[:-1] & ~begins[1:]
    own = np.arange(1, len(ids)) >= context
    first, second = ids[:-1], ids[1:]
    pair = np.flatnonzero(joined & own)
    triple = np.flatnonzero(joined[1:] & joined[:-1] & own[1:])
    high = first << wide | second
    return np.concatenate([high[pair], high[triple]]), np.concatenate([np.zeros(len(pair), np.uint64), ids[triple + 2]])


def _levels(bits: int) -> list[int]:
    return [*range(LEVEL_BITS, bits, LEVEL_BITS), bits]


def _numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """``words`` with ids 1, 2, ..., and the number of bits of the largest; ids are dense, by partition and row."""
    kept = stored(words.withColumn("_row", F.monotonically_increasing_id()), "frequent-words")
    part = F.shiftright("_row", 33)
    # One row per task of the write.
    sizes = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", before.alias("_before"))
    total = kept.count()
    if total >= 1 << 32:
        raise ValueError("more frequent words than ids")
    place = F.col("_row") - F.shiftleft(part, 33)
    kept = kept.join(sizes, part == F.col("_part")).withColumn("id", F.col("_before") + place + 1)
    return stored(kept.drop("_row", "_part", "_before"), "word-ids"), max(1, total.bit_length())


def _counts(blocks: DataFrame, words: DataFrame, b: int, min_count: int) -> DataFrame:
    """(w1, w2, w3, n) of the pairs (w3 is 0) and triples of word ids that occur ``min_count`` times."""
    total = 2 * (words.agg(F.sum("f")).first()[0] or 0)
    bits = min(2 * b, max(LEAST_BITS, (total // SHARD_ENTRIES).bit_length()))
    levels = _levels(bits)

    met = blocks.select("block", "lang", F.posexplode("words").alias("place", "word")).join(words, ["lang", "word"])
    ids = met.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("known"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, context, size = (batch.column(c)[k].as_py() for c in ("block", "context", "size"))
                raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("ids")[k].as_py()), "<u4")
                known = batch.column("known")[k].values
                table = np.zeros(size, np.uint64)
                table[known.field("place").to_numpy()] = known.field("id").to_numpy().astype(np.uint64)
                high, low = _ngrams(table[raw >> 1], (raw & 1).astype(bool), context, b)
                yield _dealt(block, *_counted(*permuted(high, low, b), None, b), levels[0], b)

    def regroup(prefix: int):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            merged = CountingQuotientFilter.merged(table.column("data").to_pylist(), b)
            return pa.Table.from_batches([_dealt(key[1].as_py(), *merged, prefix, b)])

        return run

    def unpack(table: pa.Table) -> pa.Table:
        high, low, counts = CountingQuotientFilter.merged(table.column("data").to_pylist(), b)
        often = counts >= min_count
        high, low = restored(high[often], low[often], b)
        columns = [high >> np.uint64(b), high & np.uint64((1 << b) - 1), low, counts[often]]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["w1", "w2", "w3", "n"])

    rows = blocks.join(ids, "block").select("block", "context", "size", "ids", "known")
    filters = rows.mapInArrow(count, "shard long, block long, data binary")
    for here, further in zip(levels, levels[1:]):
        # The entries of a range of this level, dealt to groups that hold as many as a shard in the end.
        group = F.pmod(F.xxhash64("block"), F.lit(1 << (bits - here))).alias("part")
        filters = filters.groupBy("shard", group).applyInArrow(regroup(further), "shard long, block long, data binary")
    return filters.groupBy("shard").applyInArrow(unpack, GRAMS)


# ---- scores -------------------------------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) exactly; a <= l and a <= r, so it is at most 1000000."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    top = F.lit(1_000_000).cast("decimal(7,0)") * wide[0] * wide[0]
    return F.call_function("div", top, wide[1] * wide[2])


def collocations(docs: DataFrame, min_count: int = 10, contained_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts at its weakest cut, ``n`` all words of the language. Phrases
    inside a longer one that makes up ``contained_percent`` of their occurrences go.
    """
    blocks = stored(_blocks(docs), "word-blocks")
    counted = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    counted = counted.groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("f")).where("f > 0")
    counted = stored(counted, "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words, b = _numbered(counted.where(F.col("f") >= min_count))
    grams = stored(_counts(blocks, words, b, min_count), "ngrams")

    def word(k: int) -> DataFrame:
        lang = [F.col("lang")] if k == 1 else []
        return words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"), *lang)

    pairs = grams.where("w3 = 0").select("w1", "w2", F.col("n").alias("a"))
    triples = grams.where("w3 > 0").withColumnRenamed("n", "a")
    inside = triples.select(F.explode(F.array(F.struct("w1", "w2", "a"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))).alias("p"))
    inside = inside.groupBy("p.w1", "p.w2").agg(F.max("p.a").alias("longer"))
    free = F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("a"))
    two = pairs.join(inside, ["w1", "w2"], "left").where(free).join(word(1), "w1").join(word(2), "w2")
    two = two.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))

    left = pairs.select("w1", "w2", F.col("a").alias("f12"))
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = triples.join(left, ["w1", "w2"]).join(right, ["w2", "w3"])
    three = three.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    cut = lambda l, r: F.struct(_score(F.col("a"), F.col(l), F.col(r)).alias("score"), F.col(l).alias("l"), F.col(r).alias("r"))
    one, other = cut("f1", "f23"), cut("f12", "f3")
    three = three.withColumn("cut", F.when(one["score"] <= other["score"], one).otherwise(other))
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
