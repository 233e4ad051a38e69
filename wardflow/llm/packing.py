"""Best-fit packing of documents into sequences, improved by swap-based local search.

Documents become token pieces; a document longer than a sequence is cut into whole sequences with the remainder
first. Pieces are dealt into shards at random, so each shard holds the same mixture of lengths. A shard is packed
best fit first, then by local search between underfull bins: a piece moves, one piece is exchanged for one, or two
for one, whenever that increases the sum of squared fills; the least filled bin empties and goes. Then every shard
opens bins that hold half of its pieces again, the least filled and those of small pieces only; two shards'
worth of them are dealt to one shard of the next level and packed together, level by level down to one shard. So the
rows of a level are half of those before, a shard never grows, and room that one shard has left meets the small
pieces that another has to spare.

Cases: a null or empty text is a document of its end token only. Very long texts become many pieces, in order.
Repeated rows and rows with equal or null ids are packed each on its own. Pieces of equal length are alike, so which
of them goes where is not defined; their number of sequences is. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import spread, stored
from wardflow.llm.tokens import encoder

SHARD_PIECES, MERGED = 40_000, 2
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, limit: int, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds its token ids."""
    end = np.array([end_id], "<u4").tobytes()
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    wanted = 5 + with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for doc_id, ids in zip(doc_ids, encoder(vocabulary).encode(batch.column("text"))):
                ids += end
                total = len(ids) // 4
                start, length = 0, (total - 1) % limit + 1
                for piece in range(-(-total // limit)):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(part))
                    rows.append(row + (np.frombuffer(part, "<i4"),) if with_ids else row)
                    start, length = start + length, limit
                if len(rows) >= 4096:
                    yield _batch(rows, names[:wanted], kinds[:wanted])
                    rows = []
            if rows:
                yield _batch(rows, names[:wanted], kinds[:wanted])

    schema = PIECE + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)


def best_fit(lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the fullest bin that has room."""
    open_bins: list[list[list[int]]] = [[] for _ in range(limit + 1)]  # by room left
    rooms: list[int] = []  # the rooms that some open bin has, ascending
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                del rooms[at]
        else:
            room, chosen = limit, []
            bins.append(chosen)
        chosen.append(i)
        left = room - size
        if left:
            if not open_bins[left]:
                insort(rooms, left)
            open_bins[left].append(chosen)
    return bins


class _Stock:
    """What open bins can give: pieces by their size, and pairs of pieces of one bin by their joint size.

    Pieces of one size in one bin are alike, so an entry names bin and sizes; a bin has at most some 40 distinct ones.
    A bit per size says whether there is an entry, so the largest size up to a bound is one operation.
    """

    def __init__(self) -> None:
        self.at: tuple[dict[int, set], dict[int, set]] = ({}, {})  # single pieces, pairs
        self.bits = [0, 0]

    @staticmethod
    def entries(b: int, sizes: list[int]) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        distinct = sorted(set(sizes))
        for k, s in enumerate(distinct):
            yield 0, s, (b, s)
            for t in distinct[:k]:
                yield 1, s + t, (b, s, t)
            if sizes.count(s) > 1:
                yield 1, 2 * s, (b, s, s)

    def put(self, b: int, sizes: list[int]) -> None:
        for kind, size, entry in self.entries(b, sizes):
            self.at[kind].setdefault(size, set()).add(entry)
            self.bits[kind] |= 1 << size

    def take(self, b: int, sizes: list[int]) -> None:
        for kind, size, entry in self.entries(b, sizes):
            held = self.at[kind][size]
            held.discard(entry)
            if not held:
                del self.at[kind][size]
                self.bits[kind] &= ~(1 << size)

    def largest(self, upto: int, pairs: bool) -> int:
        """The largest size of an entry up to ``upto``; 0 without any."""
        bits = self.bits[0] | self.bits[1] if pairs else self.bits[0]
        return max(0, (bits & ((1 << (upto + 1)) - 1)).bit_length() - 1)

    def pick(self, size: int, pairs: bool) -> tuple[int, ...]:
        found = self.at[0].get(size) or (self.at[1][size] if pairs else ())
        return min(found)


def _best_step(sizes: list[int], room: int, stock: _Stock) -> tuple[tuple[int, ...], tuple[int, ...], int] | None:
    """(sizes given back, entry taken, gain) with the largest gain up to ``room``; None if nothing gains.

    Nothing is given for a piece or two, one piece for one or two, or two for one.
    """
    best, gain = None, 0
    distinct = sorted(set(sizes))
    for back in [(), *((s,) for s in distinct)]:
        given = sum(back)
        size = stock.largest(given + room, pairs=True)
        if size - given > gain:
            best, gain = (back, size, True), size - given
            if gain == room:
                break
    if gain < room:
        for k, s in enumerate(distinct):
            for t in distinct[: k + 1]:
                if s != t or sizes.count(s) > 1:
                    size = stock.largest(s + t + room, pairs=False)
                    if size - s - t > gain:
                        best, gain = ((s, t), size, False), size - s - t
    return None if best is None else (best[0], stock.pick(best[1], best[2]), gain)


def local_search(bins: list[list[int]], lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Fewer bins by moves and exchanges that each increase the sum of squared fills.

    From the fullest underfull bin on, each takes from a less filled one a piece or two and gives back nothing, a
    piece or two (not two for two), so that it gains as much as it has room for. The least filled bins empty. Rounds
    go on until one finds no step or there are no more bins than the total, or the pieces over half a bin, must take.
    """
    bins = [list(b) for b in bins]
    every = [i for b in bins for i in b]
    inside = lengths[every] if every else lengths[:0]
    least = max(-(-int(inside.sum()) // limit), int((2 * inside > limit).sum()))
    size_of = lengths.tolist()
    while len(bins) > least:
        sizes = [[size_of[i] for i in b] for b in bins]
        fills = [sum(s) for s in sizes]
        order = [b for b in np.argsort([-f for f in fills], kind="stable").tolist() if fills[b] < limit]
        stock = _Stock()
        for b in order:
            stock.put(b, sizes[b])
        steps = 0
        for b in order:
            stock.take(b, sizes[b])  # it no longer gives, so all that do are filled less
            while bins[b] and fills[b] < limit:
                step = _best_step(sizes[b], limit - fills[b], stock)
                if step is None:
                    break
                back, (other, *out), gain = step
                stock.take(other, sizes[other])
                for size in out:
                    _move(size, other, b, bins, sizes)
                for size in back:
                    _move(size, b, other, bins, sizes)
                fills[b] += gain
                fills[other] -= gain
                stock.put(other, sizes[other])
                steps += 1
        bins = [b for b in bins if b]
        if not steps:
            break
    # What the open bins hold may fit better when dealt anew.
    full = [b for b in bins if sum(size_of[i] for i in b) == limit]
    loose = [i for b in bins if sum(size_of[i] for i in b) < limit for i in b]
    again = full + [[loose[i] for i in b] for b in best_fit(lengths[loose], limit)] if loose else bins
    return min(bins, again, key=len)


def _move(size: int, source: int, target: int, bins: list[list[int]], sizes: list[list[int]]) -> None:
    """One piece of that size goes from one bin to another."""
    k = sizes[source].index(size)
    bins[target].append(bins[source].pop(k))
    sizes[target].append(sizes[source].pop(k))


def pack(found: DataFrame, limit: int) -> DataFrame:
    """``found`` (with a ``length`` of at most ``limit``) plus sequence_id and offset."""
    columns = found.columns
    rows = stored(found.withColumn("row_id", F.monotonically_increasing_id()), "pieces")
    # A piece as long as a sequence is one by itself.
    whole = F.col("length") >= limit
    places = rows.where(whole).select("row_id", (-1 - F.col("row_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    waiting = rows.where(~whole).select("row_id", F.col("length").cast("int").alias("size"))
    shards, level = spread(waiting.count(), SHARD_PIECES), 0
    while True:
        dealt = waiting.withColumn("shard", F.pmod(F.xxhash64("row_id", F.lit(level)), F.lit(shards)).cast("int"))
        packed = dealt.groupBy("shard").applyInPandas(
            _packer(limit, SHARD_PIECES // MERGED if shards > 1 else 0),
            "row_id long, size int, shard int, bin int, offset long, done boolean",
        )
        packed = stored(packed, "packed")
        number = F.lit(level << 56).cast("long") + F.col("shard").cast("long") * F.lit(1 << 24) + F.col("bin")
        places = places.unionByName(packed.where("done").select("row_id", number.alias("sequence_id"), "offset"))
        if shards == 1:
            return rows.join(places, "row_id").select(*columns, "sequence_id", "offset")
        waiting = packed.where("not done").select("row_id", "size")
        shards, level = spread(shards, MERGED), level + 1


def open_again(bins: list[list[int]], lengths: np.ndarray, limit: int, most: int) -> set[int]:
    """Bins that hold at most ``most`` pieces together: the least filled ones, and those whose largest piece is smallest.

    The first have room, but their shard had too few small pieces to use it; the second, filled or not, are where
    another shard has its small pieces to spare.
    """
    fills = [int(lengths[b].sum()) for b in bins]
    tops = [int(lengths[b].max()) for b in bins]
    chosen: set[int] = set()
    for keys, budget in ((fills, most // 2), (tops, most)):
        held = sum(len(bins[b]) for b in chosen)
        for b in np.argsort(keys, kind="stable").tolist():
            if b in chosen:
                continue
            held += len(bins[b])
            if held > budget or (keys is fills and fills[b] == limit):
                break
            chosen.add(b)
    return chosen


def _packer(limit: int, loose: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_id", ignore_index=True)
        lengths = group["size"].to_numpy(np.int64)
        bins = local_search(best_fit(lengths, limit), lengths, limit)
        again = open_again(bins, lengths, limit, loose)
        number, offset, done = np.zeros(len(group), np.int32), np.zeros(len(group), np.int64), np.ones(len(group), bool)
        for k, members in enumerate(bins):
            sizes = lengths[members]
            number[members] = k
            offset[members] = np.cumsum(sizes) - sizes
            done[members] = k not in again
        return group.assign(bin=number, offset=offset, done=done)[["row_id", "size", "shard", "bin", "offset", "done"]]

    return run


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, limit: int = 1024, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: sequence_id and the offset in it."""
    return pack(pieces(docs, vocabulary, end_id, limit, with_ids), limit)
