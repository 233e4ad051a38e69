"""One query per operator of this package, over the whole table it is meant for, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from wardflow.llm import lm, mixing, oracle, packing, phrases, pii, product_quantization, quality, runs, simhash
from wardflow.llm import substrings, token_files, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)


@query
def op1_pii(spark, sf):
    docs = documents(spark, sf)
    return pii.find(docs, pii.train(docs))


@query
def op2_toxicity_chain(spark, sf):
    docs = documents(spark, sf)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet")))


@query
def op3_cross_entropy_difference(spark, sf):
    return lm.cross_entropy_difference(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query
def op4_product_quantization(spark, sf):
    return product_quantization.near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"), cosine=0.9)


@query
def op5_token_files(spark, sf):
    back = token_files.tokens_round_trip(
        documents(spark, sf), vocabulary=public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_mixing(spark, sf):
    return mixing.mixed(documents(spark, sf), mixing.Mixture())


ORACLE["op6_mixing"] = oracle.mixing_sql(mixing.Mixture())


@query
def op7_repeated_substrings(spark, sf):
    return substrings.remove_repeats(documents(spark, sf), width=200)


@query
def op8_packing(spark, sf):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(documents(spark, sf), vocabulary, end_id=2, limit=1024)


@query
def op9_quality(spark, sf):
    return quality.assess(documents(spark, sf))


@query
def op10_simhash(spark, sf):
    found = simhash.near_duplicates(documents(spark, sf), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_periodic_runs(spark, sf):
    found = runs.periodic_runs(runs.with_planted_runs(documents(spark, sf)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE["op11_periodic_runs"] = oracle.runs_sql()


@query
def op12_warc(spark, sf):
    back = warc.archives_round_trip(spark.read.parquet(f"{sf}/pages.parquet"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op12_warc"] = oracle.warc_sql()


@query
def op13_phrases(spark, sf):
    return phrases.collocations(documents(spark, sf), min_count=10, contained_percent=50, top=2000)


ORACLE["op13_phrases"] = oracle.phrases_sql(min_count=10, contained_percent=50, top=2000)
