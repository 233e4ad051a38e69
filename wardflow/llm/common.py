"""What several operators share: stored intermediate tables and grouping of linked items."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.session import new_work_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends, lost executors recompute nothing."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread(rows: int, per_block: int) -> int:
    """Blocks of at most ``per_block`` rows on average that ``rows`` are dealt into."""
    return max(1, -(-rows // per_block))


def bounded_sample(df: DataFrame, key: Column, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of ``key``; at most twice ``rows``, the same ones in every run.

    Rows with equal keys come all or not at all, so the key should tell rows apart.
    """
    share = min(1.0, rows / max(1, total))
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30))
    return df.where(place < int(share * (1 << 30)) + 1).orderBy(place, key).limit(2 * rows)


def local_stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index each of ``n`` items reaches over the pairs ``(i, j)``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node of its connected component.

    Large-star and small-star rounds on stored tables. Minima have a partial step, and each join meets two
    stored tables, so adaptive execution can split the rows of a node with very many neighbours.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(pairs.where("a <> b").distinct(), "links")
    before = _checksum(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.distinct(), "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        current = stored(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        after = _checksum(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def block_pairs(routed: DataFrame, key: str, row_id: str, db_rows: int, query_rows: int) -> DataFrame:
    """Rows of ``routed`` dealt to groups (``key``, ``db``, ``q``) in which each key's rows can be compared.

    Every row queries its key; those with ``home`` also rest there. In a group, rows with ``role`` true are a block
    of resting rows and the others a block of queries, and every pair of blocks of a key has its group. So a key
    with very many rows is compared in many groups of bounded size.
    """
    sizes = routed.groupBy(key).agg(F.count_if("home").alias("resting"), F.count("*").alias("queries"))
    db_blocks = F.ceil(F.col("resting") / db_rows).cast("int").alias("db_blocks")
    query_blocks = F.ceil(F.col("queries") / query_rows).cast("int").alias("query_blocks")
    sizes = stored(sizes.where("resting > 0").select(key, db_blocks, query_blocks), "sizes")
    placed = routed.join(sizes, key)
    db = F.pmod(F.xxhash64(row_id, F.lit(1)), F.col("db_blocks")).cast("int")
    q = F.pmod(F.xxhash64(row_id, F.lit(2)), F.col("query_blocks")).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    resting = placed.where("home").withColumn("role", F.lit(True)).withColumn("db", db).withColumn("q", every("query_blocks"))
    queries = placed.withColumn("role", F.lit(False)).withColumn("db", every("db_blocks")).withColumn("q", q)
    return resting.unionByName(queries).drop("db_blocks", "query_blocks")
