"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table-lookup distances, rerank.

Unit vectors are turned to their principal axes. Every other axis belongs to one of two halves with a coarse quantiser
each, and a list is a pair of their cells. The residual from a list's centre is coded subspace by subspace. Lists are
put on shelves of bounded size, one folder each, and every two shelves that may hold a link are compared by one task.

Two linked vectors are at most the reach ``sqrt(2 - 2 cosine)`` apart. Where their cells in a half differ, the
distances of both to the boundary between those cells add up to no more than their distance in that half, so the
squares of these sums, over both halves, add up to the square of the reach at most. Lists that are further apart are
skipped, and of the others only rows near enough to the boundary meet. Those are compared by their first axes and the
lengths of what lies along the others, whose product is never less than the cosine; then by the distance from the query
to the coded vector, which for a link is no more than the reach plus the coding error; what remains by exact
cosine in double precision. None of these steps loses a link. In a tile where many pairs pass the first
comparison, cosines in single precision decide, but for those that rounding leaves open.

Equal vectors are one class and are compared once. The quantisers are fitted on at most ``2 * sample_rows`` classes;
every class is indexed. Links are counted for each pair of shelves, and a pair hands on, for its components, only
links to their smallest member.

Cases: a vector that is null, empty, zero or holds null or non-finite parts links with nothing. Vectors link only
with vectors of the same length, scale does not matter. Rows with a repeated ``vec_id`` are vectors of their own.
A null ``vec_id`` is never the smallest of its component; where a component has no other, its id is null and the
row is kept. Rows find their class by two 64-bit hashes of the vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as parquet
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import bounded_sample, connected, local_stars, stored
from wardflow.session import new_work_dir

# Rows of a shelf at most, rows of a tile, columns of a tile.
DB_BLOCK, QUERY_BLOCK, TILE = 32768, 512, 1024
MOST_LISTS = 4096
LIST_ROWS = 2048
# Parts of vectors held at once: on a shelf, and in the comparison in double precision. Rows for which a shelf is not divided.
SHELF_PARTS, EXACT_PARTS, SHELF_LEAST = 1 << 21, 1 << 22, 2048
# Rounding of boundary and coding distances.
ROUNDING = 1e-4


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares, step = (centres**2).sum(axis=1), max(1, (1 << 22) // len(centres))
    parts = [np.argmin(squares - 2 * x[at : at + step] @ centres.T, axis=1) for at in range(0, len(x), step)]
    return np.concatenate(parts or [np.zeros(0, np.int64)])


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` centres of ``x`` by Lloyd's rounds from evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        counts = np.bincount(near, minlength=k)[:, None]
        sums = np.array([np.bincount(near, part, k) for part in x.T]).reshape(x.shape[1], k).T
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres).astype(x.dtype)
    return centres


def _scaled(x: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision."""
    x = (x / np.abs(x).max(axis=1, keepdims=True)).astype(np.float32)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


@dataclass
class Index:
    """Principal axes, coarse centres of both halves and code words of residuals, for vectors of one length."""

    axes: np.ndarray
    first: int
    sides: list[np.ndarray]
    words: list[np.ndarray]
    cuts: list[int]
    apart: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        self.apart = [np.sqrt(((c[:, None] - c) ** 2).sum(axis=2)).astype(np.float32) for c in self.sides]

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, reach: float, subspaces: int = 8, codes: int = 256) -> Index:
        size = x.shape[1]
        spread, axes = np.linalg.eigh(np.cov(x.T.astype(float), bias=True).reshape(size, size))
        axes = np.ascontiguousarray(axes[:, ::-1], np.float32)
        # Along the first axes, vectors that are not linked should be well over the reach apart.
        first = int(np.searchsorted(np.cumsum(spread[::-1]), 2.25 * reach**2)) + 1
        first = max(first, 16)
        z = x @ axes
        k = min(max(1, round(math.sqrt(lists))), len(x))
        sides = [_means(z[:, 0::2], k), _means(z[:, 1::2], k if size > 1 else 1)]
        index = cls(axes, size if first + 8 > size else first, sides, [], [])
        residual = z - index.centres(index.home(z))
        index.cuts = np.linspace(0, size, min(subspaces, size) + 1).astype(int).tolist()
        index.words = [_means(residual[:, a:b], min(codes, len(x))) for a, b in zip(index.cuts, index.cuts[1:])]
        return index

    @property
    def lists(self) -> int:
        return len(self.sides[0]) * len(self.sides[1])

    def cells(self, home: np.ndarray) -> list[np.ndarray]:
        """The cell in each half of lists."""
        return [home // len(self.sides[1]), home % len(self.sides[1])]

    def home(self, z: np.ndarray) -> np.ndarray:
        return _nearest(z[:, 0::2], self.sides[0]) * len(self.sides[1]) + _nearest(z[:, 1::2], self.sides[1])

    def centres(self, home: np.ndarray) -> np.ndarray:
        out = np.empty((len(home), len(self.axes)), np.float32)
        for k, (side, cell) in enumerate(zip(self.sides, self.cells(home))):
            out[:, k::2] = side[cell]
        return out

    def encode(self, z: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, coding error) of vectors in their own lists."""
        residual = z - self.centres(home)
        codes, error = np.zeros((len(z), len(self.words)), np.uint8), np.zeros(len(z))
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            codes[:, m] = _nearest(residual[:, a:b], self.words[m])
            error += ((residual[:, a:b] - self.words[m][codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distance of each query to the coded vector beside it, from the code words of its parts."""
        residual, total = queries - self.centres(home), np.zeros(len(queries), np.float32)
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            total += ((residual[:, a:b] - self.words[m][codes[:, m]]) ** 2).sum(axis=1)
        return np.sqrt(total)

    def reduced(self, z: np.ndarray) -> np.ndarray:
        """The parts along the first axes and the lengths of four groups of the others; products bound those of ``z``."""
        rest = [np.sqrt((p**2).sum(axis=1, keepdims=True)) for p in np.array_split(z[:, self.first :], 4, axis=1) if p.size]
        return np.ascontiguousarray(np.concatenate([z[:, : self.first], *rest], axis=1))

    def gaps(self, z: np.ndarray, home: np.ndarray) -> list[np.ndarray]:
        """For each half, cell by vector: the distance to the boundary with the vector's own cell, 0 for that itself."""
        out = []
        for k, (side, cell) in enumerate(zip(self.sides, self.cells(home))):
            squares = (side**2).sum(axis=1)[:, None] - 2 * side @ z[:, k::2].T
            lead, apart = squares - squares[cell, np.arange(len(z))], self.apart[k][:, cell]
            # Centres that are next to each other leave too much to rounding.
            out.append(np.where(apart > 0.01, np.maximum(lead, 0) / np.maximum(2 * apart, 0.02), 0).astype(np.float32))
        return out


def fit_indexes(classes: DataFrame, kind: str, cosine: float, sample_rows: int) -> dict[int, Index]:
    """One index per length of vector; ``classes`` has ``raw``, the parts of a vector of type ``kind``."""
    size = F.length("raw").alias("size")
    sizes = {r["size"]: r["count"] for r in classes.groupBy(size).count().collect()}
    total, out = sum(sizes.values()), {}
    for size, count in sorted(sizes.items()):
        own = classes.where(F.length("raw") == size).select("raw")
        wanted = max(1, sample_rows * count // total)
        raw = bounded_sample(own, F.col("raw"), wanted, count).toPandas()["raw"].tolist() or [np.ones(size, "u1").tobytes()]
        x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)
        lists = max(1, min(MOST_LISTS, count // LIST_ROWS))
        out[x.shape[1]] = Index.fit(_scaled(x), lists, math.sqrt(max(0.0, 2 - 2 * cosine)))
    return out


@dataclass
class Layout:
    """Which shelf the rows of a list are on; a list larger than a shelf has several, ``first`` and those behind it."""

    first: np.ndarray
    shelves: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, rows: int, number: int) -> tuple[Layout, int]:
        """The layout of lists with ``counts`` rows, and the next free number of a shelf; ``number`` is the first."""
        first, shelves, filled = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0
        for k, count in enumerate(counts.tolist()):
            if filled and filled + count > rows:
                number, filled = number + 1, 0
            first[k], shelves[k], filled = number, max(1, -(-count // rows)), filled + count
            if shelves[k] > 1:
                number, filled = number + int(shelves[k]), 0
        return cls(first, shelves), number + (filled > 0)

    def shelf(self, home: np.ndarray, cls: np.ndarray) -> np.ndarray:
        mixed = cls.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        return self.first[home] + (mixed % self.shelves[home].astype(np.uint64)).astype(np.int64)


class Shelf:
    """The rows of a shelf in the order of their lists."""

    def __init__(self, store: fs.FileSystem, path: str, kind: str, indexes: dict[int, Index]) -> None:
        table = parquet.read_table(path, filesystem=store, partitioning=None).combine_chunks()
        home = table.column("list").to_numpy()
        order = np.argsort(home, kind="stable")
        column = lambda name: table.column(name).to_numpy()[order]
        parts = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(len(order), -1)[order]
        self.raw, self.codes = parts("raw", kind), parts("code", np.uint8)
        self.index = indexes[self.raw.shape[1]]
        self.cls, self.copies, self.error, self.home = column("cls"), column("copies"), column("error"), home[order]
        self.z = _scaled(self.raw) @ self.index.axes
        self.reduced = self.index.reduced(self.z)
        self.lists, starts, counts = np.unique(self.home, return_index=True, return_counts=True)
        self.cells = self.index.cells(self.lists)
        self.bounds = [*starts.tolist(), len(order)]
        self.gaps = self.index.gaps(self.z, self.home)
        #: For each half, list by cell.
        self.low = [np.minimum.reduceat(g, starts, axis=1).T for g in self.gaps]
        self.mean = [(np.add.reduceat(g, starts, axis=1) / counts).T for g in self.gaps]


def lists_apart(low_a: list[np.ndarray], cells_a: list[np.ndarray], low_b: list[np.ndarray], cells_b: list[np.ndarray]) -> np.ndarray:
    """List by list: the distance that rows of these have at least."""
    return np.sqrt(sum((la[:, b] + lb[:, a].T) ** 2 for la, a, lb, b in zip(low_a, cells_a, low_b, cells_b)))


class Links:
    """The links between rows of two shelves, or of one with itself."""

    def __init__(self, a: Shelf, b: Shelf, cosine: float) -> None:
        self.a, self.b, self.cosine = a, b, cosine
        self.reach = math.sqrt(max(0.0, 2 - 2 * cosine))
        self.slack = 1e-5 + 1e-7 * a.raw.shape[1]
        self.offset = 0 if a is b else len(a.cls)
        self.counts = np.zeros(self.offset + len(b.cls), np.int64)
        self.stars: list[tuple[np.ndarray, np.ndarray]] = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        near = lists_apart(a.low, a.cells, b.low, b.cells) <= self.reach + ROUNDING
        for x, y in zip(*(k.tolist() for k in np.nonzero(near))):
            if a is b and x == y:
                self._within(*a.bounds[x : x + 2])
            elif a is not b or x < y:
                self._between(x, y)
        self._settle()

    def _within(self, start: int, end: int) -> None:
        for at in range(start, end, QUERY_BLOCK):
            rows = np.arange(at, min(end, at + QUERY_BLOCK))
            here = self.a.reduced[rows]
            for low in range(at, end, TILE):
                cols = np.arange(low, min(end, low + TILE))
                self._tile(rows, cols, here, self.b.reduced[cols], rows[:, None] < cols if low <= rows[-1] else None)

    def _between(self, x: int, y: int) -> None:
        """Rows of list ``x`` with those of list ``y`` that are not too far from the boundary between both."""
        a, b = self.a, self.b
        rows, cols = slice(*a.bounds[x : x + 2]), slice(*b.bounds[y : y + 2])
        # Along the line through the middles of both lists, both distances add up to the reach at most.
        line = np.array([a.mean[k][x, b.cells[k][y]] + b.mean[k][y, a.cells[k][x]] for k in (0, 1)], np.float32)
        line /= max(float(np.sqrt((line**2).sum())), 1e-9)
        left = sum(w * a.gaps[k][b.cells[k][y], rows] for k, w in enumerate(line))
        right = sum(w * b.gaps[k][a.cells[k][x], cols] for k, w in enumerate(line))
        limit = np.float32(self.reach + ROUNDING)
        near = np.flatnonzero(left <= limit - right.min())
        rows = near[np.argsort(left[near])]
        near = np.flatnonzero(right <= limit - left.min())
        cols = near[np.argsort(right[near])]
        left, right = left[rows], right[cols]
        rows, cols = rows + a.bounds[x], cols + b.bounds[y]
        there = b.reduced[cols]
        for at in range(0, len(rows), QUERY_BLOCK):
            most = int(np.searchsorted(right, limit - left[at], side="right"))
            own = rows[at : at + QUERY_BLOCK]
            here = a.reduced[own]
            for low in range(0, most, TILE):
                part = slice(low, min(most, low + TILE))
                self._tile(own, cols[part], here, there[part])

    def _tile(self, rows: np.ndarray, cols: np.ndarray, here: np.ndarray, there: np.ndarray, wanted: np.ndarray | None = None) -> None:
        """``here`` and ``there``: the reduced vectors of ``rows`` and ``cols``."""
        near = here @ there.T >= np.float32(self.cosine - self.slack)
        if wanted is not None:
            near &= wanted
        if not near.any():
            return
        some = np.flatnonzero(near.any(axis=1))
        near = near[some]
        rows, pairs = rows[some], len(rows) * len(cols)
        if np.count_nonzero(near) * 16 > pairs:
            dots = self.a.z[rows] @ self.b.z[cols].T
            sure = near & (dots > self.cosine + self.slack)
            near &= ~sure & (dots >= self.cosine - self.slack)
            self.counts[rows] += sure @ self.b.copies[cols]
            self.counts[cols + self.offset] += self.a.copies[rows] @ sure
            x, y = np.nonzero(sure)
            self._join(np.concatenate([rows, cols + self.offset]), x, len(rows) + y)
        x, y = np.nonzero(near)
        self.held.append((rows[x], cols[y]))
        self.waiting += len(x)
        if self.waiting >= 1 << 16:
            self._settle()

    def _settle(self) -> None:
        """Decide on the pairs that are held."""
        rows, cols = (np.concatenate([np.zeros(0, np.int64), *k]) for k in (zip(*self.held) if self.held else ((), ())))
        self.held, self.waiting = [], 0
        a, b, step = self.a, self.b, max(256, EXACT_PARTS // self.a.raw.shape[1])
        for at in range(0, len(rows), step):
            x, y = rows[at : at + step], cols[at : at + step]
            near = a.index.distances(a.z[x], b.home[y], b.codes[y]) <= self.reach + b.error[y] + ROUNDING
            x, y = x[near], y[near]
            (ones, i), (others, j) = np.unique(x, return_inverse=True), np.unique(y, return_inverse=True)
            linked = np.einsum("ij,ij->i", _unit(a.raw[ones])[i], _unit(b.raw[others])[j]) >= self.cosine
            self._add(x[linked], y[linked])

    def _add(self, rows: np.ndarray, cols: np.ndarray) -> None:
        if not len(rows):
            return
        i, j = rows, cols + self.offset
        np.add.at(self.counts, i, self.b.copies[cols])
        np.add.at(self.counts, j, self.a.copies[rows])
        nodes, where = np.unique(np.concatenate([i, j]), return_inverse=True)
        self._join(nodes, where[: len(i)], where[len(i) :])

    def _join(self, nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        """Keep a link from each of ``nodes`` to the first it reaches over the pairs of places ``(i, j)``."""
        root = local_stars(len(nodes), i, j)
        moved = root != np.arange(len(nodes))
        self.stars.append((nodes[moved], nodes[root[moved]]))

    def rows(self) -> pa.RecordBatch:
        cls = self.a.cls if self.a is self.b else np.concatenate([self.a.cls, self.b.cls])
        i, j = (np.concatenate([np.zeros(0, np.int64), *k]) for k in (zip(*self.stars) if self.stars else ((), ())))
        root, met = local_stars(len(cls), i, j), np.flatnonzero(self.counts)
        return pa.RecordBatch.from_arrays([pa.array(k) for k in (cls[met], self.counts[met], cls[root[met]])], ["cls", "n", "root"])


ROUTED = "shelf long, list long, cls long, copies long, code binary, error double, raw binary"
LOWS = "shelf long, size long, lists binary, low binary, other binary"


def shelf_pairs(lows: list, indexes: dict[int, Index], reach: float) -> np.ndarray:
    """(a, b), a <= b, of the shelves that may hold links; ``lows`` has the rows of ``LOWS``."""
    held = []
    for r in sorted(lows, key=lambda r: r["shelf"]):
        lists, sides = np.frombuffer(r["lists"], np.int64), indexes[r["size"]].sides
        low = [np.frombuffer(v, "<f4").reshape(len(lists), len(side)) for v, side in zip((r["low"], r["other"]), sides)]
        held.append((r["shelf"], r["size"], low, indexes[r["size"]].cells(lists)))
    return np.array([
        (a[0], b[0])
        for k, a in enumerate(held) for b in held[k:]
        if a[1] == b[1] and lists_apart(*a[2:], *b[2:]).min() <= reach + ROUNDING
    ], np.int64).reshape(-1, 2)


def linked_classes(classes: DataFrame, kind: str, cosine: float, sample_rows: int) -> DataFrame:
    """(cls, n, root): links counted from class ``cls`` to vectors of other classes, and a member to be joined with.

    ``classes`` has ``cls``, ``copies`` and ``raw``, the parts of a vector of type ``kind``. A class has a row for every
    pair of shelves it has links in.
    """
    spark, width = classes.sparkSession, np.dtype(kind).itemsize
    fitted = fit_indexes(classes, kind, cosine, sample_rows)
    indexes = spark.sparkContext.broadcast(fitted)
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes = pc.binary_length(batch.column("raw")).to_numpy() // width
                for size in np.unique(sizes).tolist():
                    own = batch.filter(pa.array(sizes == size))
                    x = np.frombuffer(b"".join(own.column("raw").to_pylist()), kind).reshape(-1, size)
                    z = _scaled(x) @ indexes.value[size].axes
                    yield own, size, z, indexes.value[size].home(z)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, size, _, home in turned(batches):
            lists, n = np.unique(home, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), size)), pa.array(lists), pa.array(n)], ["size", "list", "n"])

    counts = {size: np.zeros(index.lists, np.int64) for size, index in fitted.items()}
    counted = classes.select("raw").mapInArrow(count, "size long, list long, n long")
    for r in counted.groupBy("size", "list").agg(F.sum("n").alias("n")).collect():
        counts[r["size"]][r["list"]] = r["n"]
    layouts, shelves = {}, 0
    for size, own in counts.items():
        rows = max(1, min(DB_BLOCK, SHELF_PARTS // size, max(SHELF_LEAST, int(own.sum()) // 12)))
        layouts[size], shelves = Layout.of(own, rows, shelves)
    laid = spark.sparkContext.broadcast(layouts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, size, z, home in turned(batches):
            codes, error = indexes.value[size].encode(z, home)
            shelf = laid.value[size].shelf(home, own.column("cls").to_numpy())
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            columns = [pa.array(shelf), pa.array(home), own.column("cls"), own.column("copies"), code, pa.array(error), own.column("raw")]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in ROUTED.split(", ")])

    folder = new_work_dir(spark, "shelves")
    routed = classes.select("cls", "copies", "raw").mapInArrow(route, ROUTED)
    routed.repartition("shelf").sortWithinPartitions("shelf").write.partitionBy("shelf").parquet(folder)

    def opened(shelf: int) -> Shelf:
        store, path = fs.FileSystem.from_uri(folder)
        return Shelf(store, f"{path}/shelf={shelf}", kind, indexes.value)

    def lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shelf in (k for batch in batches for k in batch.column("shelf").to_pylist()):
            own = opened(shelf)
            low = [np.ascontiguousarray(k, "<f4").tobytes() for k in own.low]
            row = [[shelf], [own.raw.shape[1]], [own.lists.tobytes()], *([k] for k in low)]
            yield pa.RecordBatch.from_arrays([pa.array(k) for k in row], [part.split()[0] for part in LOWS.split(", ")])

    known = spark.read.parquet(folder).select(F.col("shelf").cast("long")).distinct() if shelves else spark.range(0).toDF("shelf")
    pairs = shelf_pairs(known.mapInArrow(lows, LOWS).collect(), fitted, reach)
    paired = spark.sparkContext.broadcast(pairs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Shelf] = {}
        for pair in (k for batch in batches for k in batch.column("id").to_pylist()):
            here = paired.value[pair].tolist()
            if sum(shelf.raw.size for shelf in held.values()) >= SHELF_PARTS:
                held = {k: shelf for k, shelf in held.items() if k in here}
            held |= {k: opened(k) for k in dict.fromkeys(here) if k not in held}
            yield Links(held[here[0]], held[here[1]], cosine).rows()

    tasks = max(1, min(len(pairs), max(3 * spark.sparkContext.defaultParallelism, len(pairs) // 16)))
    return spark.range(0, len(pairs), 1, tasks).mapInArrow(compare, "cls long, n long, root long")


def _raw_vectors(kind: str):
    """Arrow function from (vec_id, vector) to (vec_id, raw): the parts as bytes, null where the vector is not usable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                vectors = batch.column("vector")
                # A zero has one form, so that equal vectors have equal bytes.
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)
                ends = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(vectors), 0).to_numpy()]))
                odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])[ends]
                some = np.concatenate([[0], np.cumsum(flat != 0)])[ends]
                usable = pa.array((np.diff(odd) == 0) & (np.diff(some) > 0))
                offsets = (ends * flat.itemsize).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(batch), [usable.buffers()[1], pa.py_buffer(offsets), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), raw], ["vec_id", "raw"])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, sample_rows: int = 20_000) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding).

    There is a list for each ``LIST_ROWS`` vectors, ``MOST_LISTS`` at most.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"
    vector = F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector")
    rows = vectors.select(F.col("vec_id").cast("long"), vector).mapInArrow(_raw_vectors(kind), "vec_id long, raw binary")
    key = [F.when(F.col("raw").isNotNull(), F.xxhash64(F.lit(k), "raw")).alias(f"h{k}") for k in (1, 2)]
    keys = stored(rows.select("vec_id", *key), "keys")
    grouped = rows.where("raw is not null").groupBy("raw").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = stored(grouped.withColumn("cls", F.monotonically_increasing_id()), "classes")
    found = stored(linked_classes(classes, kind, cosine, sample_rows), "links")
    roots = connected(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    roots = stored(roots.withColumnRenamed("node", "cls"), "roots")
    counts = stored(found.groupBy("cls").agg(F.sum("n").alias("n")), "counts")
    placed = classes.select("cls", "first_id", "copies", *key).join(counts, "cls", "left").join(roots, "cls", "left")
    placed = placed.select(
        "h1", "h2", "first_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "cls").alias("root"),
    )
    placed = stored(placed, "placed")
    lowest = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest")
    placed = stored(placed.join(lowest, "root").select("h1", "h2", "n_links", "component_id"), "components")
    linked = keys.join(placed, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = keys.where("h1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", kept)
