"""SimHash near-duplicates: fingerprints, and their exact neighbours found with vantage-point trees.

Two fingerprints within ``distance`` bits differ in at most ``distance // 2`` bits of one of their 32-bit halves.
Each half has a vantage-point tree: a node splits its values at the median Hamming distance from a vantage value.
A fingerprint rests in one shard (leaf) and, by the triangle bound, also queries every shard that its ball of
``distance // 2`` bits overlaps; branches outside the ball are pruned. In a shard, all 64 bits are compared.

Cases: a null or wordless text has fingerprint zero and links like any other. Copies and repeated rows have one
fingerprint and are compared once. A null ``doc_id`` is never the smallest of its component; if a component has
no other, its id is null. Words and texts have no length limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import block_pairs, bounded_sample, connected, free_name, local_stars, stored

SLICE = 1 << 16
DB_BLOCK, QUERY_BLOCK = 1024, 2048


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), SLICE):
        pairs = zip(starts[at : at + SLICE], ends[at : at + SLICE])
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fp) per row; ``text_key`` is a hash of the text, ``fp`` the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(values)], ["doc_id", "text_key", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


@dataclass
class VantageTree:
    """A complete binary tree; node ``i`` has the children ``2i + 1`` (near) and ``2i + 2`` (far)."""

    vantage: np.ndarray
    median: np.ndarray
    depth: int

    @classmethod
    def build(cls, values: np.ndarray, depth: int) -> VantageTree:
        nodes = (1 << depth) - 1
        vantage, median = np.zeros(nodes, np.uint32), np.full(nodes, 16, np.int16)
        held = {0: np.sort(values.astype(np.uint32))}
        for node in range(nodes):
            own = held.pop(node, values[:0])
            if len(own):
                # The candidate whose distances spread most separates best.
                tried = own[:: max(1, len(own) // 8)][:8]
                probe = own[:: max(1, len(own) // 512)]
                spreads = np.bitwise_count(tried[:, None] ^ probe[None, :]).astype(float).var(axis=1)
                vantage[node] = tried[int(np.argmax(spreads))]
                distances = np.bitwise_count(own ^ vantage[node])
                median[node] = int(np.median(distances))
                near = distances <= median[node]
                held[2 * node + 1], held[2 * node + 2] = own[near], own[~near]
        return cls(vantage, median, depth)

    def route(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, home): every leaf that a value's ball overlaps, and whether the value itself rests there."""
        row, node, home = np.arange(len(values)), np.zeros(len(values), np.int64), np.ones(len(values), bool)
        for _ in range(self.depth):
            distance = np.bitwise_count(values[row] ^ self.vantage[node]).astype(np.int16)
            edge = self.median[node]
            near, far = distance - radius <= edge, distance + radius > edge
            row, node, home = (
                np.concatenate([row[near], row[far]]),
                np.concatenate([2 * node[near] + 1, 2 * node[far] + 2]),
                np.concatenate([home[near] & (distance <= edge)[near], home[far] & (distance > edge)[far]]),
            )
        return row, node, home


def linked_pairs(classes: DataFrame, distance: int = 3, leaf_rows: int = 512, sample_rows: int = 1 << 16) -> DataFrame:
    """(a, b): links whose components are those of all pairs of distinct ``fp`` within ``distance`` bits.

    ``sample_rows`` bounds the fingerprints that the trees are built from. The trees only decide where work is done:
    every fingerprint is routed and every pair within ``distance`` is compared in some shard.
    """
    spark, total = classes.sparkSession, classes.count()
    depth = min(20, max(0, int(np.ceil(np.log2(max(1, total / leaf_rows))))))
    sample = bounded_sample(classes.select("fp"), F.col("fp"), sample_rows, total).toPandas()
    sample = sample["fp"].to_numpy(np.int64).view(np.uint64)
    halves = [(sample & np.uint64(0xFFFFFFFF)).astype(np.uint32), (sample >> np.uint64(32)).astype(np.uint32)]
    trees = spark.sparkContext.broadcast([VantageTree.build(half, depth) for half in halves])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for start in range(0, len(fps), 4096):
                part = fps[start : start + 4096]
                bits = part.view(np.uint64)
                for side, tree in enumerate(trees.value):
                    half = ((bits >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    row, leaf, home = tree.route(half, distance // 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(2 * leaf + side), pa.array(home), pa.array(part[row])], ["leaf", "home", "fp"]
                    )

    routed = stored(classes.select("fp").mapInArrow(route, "leaf long, home boolean, fp long"), "shards")
    def compare(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        resting = table.column("role").to_numpy().astype(bool)
        nodes, index = np.unique(fps, return_inverse=True)
        left, right = np.flatnonzero(resting), np.flatnonzero(~resting)
        i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(left), 256):
            rows = left[start : start + 256]
            near = np.bitwise_count(fps[rows][:, None] ^ fps[right][None, :]) <= distance
            x, y = np.nonzero(near)
            i.append(index[rows[x]])
            j.append(index[right[y]])
        label = local_stars(len(nodes), np.concatenate(i), np.concatenate(j))
        bound = np.flatnonzero(label != np.arange(len(nodes)))
        signed = nodes.view(np.int64)
        return pa.table({"a": signed[bound], "b": signed[label[bound]]})

    # A shard with very many rows is compared block by block, each pair of blocks in a group of its own.
    grouped = block_pairs(routed, "leaf", "fp", DB_BLOCK, QUERY_BLOCK).groupBy("leaf", "db", "q")
    return grouped.applyInArrow(compare, "a long, b long")


def fingerprint_components(prints: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, root, component_id): the component of each fingerprint and the smallest doc_id in it."""
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = stored(connected(linked_pairs(classes, distance)), "roots").withColumnRenamed("node", "fp")
    placed = stored(
        classes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "placed"
    )
    lowest = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest")
    return stored(placed.join(lowest, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) per row of ``docs``."""
    prints = stored(fingerprints(docs, shingle), "prints")
    return prints.join(fingerprint_components(prints, distance), "fp")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; of its rows with that id, any one."""
    found = near_duplicates(docs, shingle, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    winners = found.groupBy("root").agg(F.min("component_id").alias("doc_id"), F.min("text_key").alias("text_key"))
    row_id, row_key = free_name(docs, "row_id"), free_name(docs, "row_key")
    winners = stored(winners.select(_id_or_least("doc_id").alias(row_id), F.col("text_key").alias(row_key)), "winners")
    keyed = docs.withColumns({row_id: _id_or_least("doc_id"), row_key: F.xxhash64(F.col("text").cast("string"))})
    kept = keyed.join(winners, [row_id, row_key], "left_semi")
    return kept.dropDuplicates([row_id, row_key]).select(docs.columns)


def _id_or_least(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(-(1 << 63)))
