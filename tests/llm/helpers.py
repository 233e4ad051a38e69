"""Small tables with the awkward cases that every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)
# Columns whose names operators use inside themselves.
CLASHING = [
    "fp", "root", "component_id", "row_id", "row_key", "text_key", "block", "epoch", "kept", "n_tokens", "spans",
    "words", "cells", "toxic", "weight", "shard", "bin", "sha", "lengths", "size", "known", "counts", "place", "likeness",
    "packed", "runs", "collapsed", "word", "f", "key", "context", "seed",
]


def docs_of(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit("own").alias(c) for c in CLASHING))


def awkward(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000)) + "."
    return docs_of(
        spark,
        [(1, None), (2, ""), (3, long), (4, "same text here"), (4, "same text here"), (5, "same text here"),
         (None, "no id"), (None, None), (6, " \t\n "), (7, "one"), (8, long, None), (9, "ÉTÉ été x\x1c y", "b")],
    )


def empty(spark):
    return spark.createDataFrame([], DOCS)
