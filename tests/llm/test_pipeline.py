"""The pipeline's stages, each against what it was given."""

import math
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty, with_clashes
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_simhash import brute_components, brute_print
from tests.llm.test_tokens import BYTES, check_places, plain
from wardflow.llm import quality
from wardflow.llm.common import stored
from wardflow.llm.queries import documents

SF = "/root/testdata/sf0.01"
QUALITY, SIMHASH, PII, MIXING, PACKING = (stage for _, stage in corpus_pipeline.STAGES)


def test_every_stage_on_all_its_predecessor_kept(spark):
    docs = documents(spark, SF)
    columns = docs.columns

    clean = stored(QUALITY(spark, docs, SF), "test")
    assert clean.columns == columns
    want = {}
    for r in docs.collect():
        verdict = quality.assess_text(r["text"], quality.Rules())
        if verdict[7]:
            want[r["doc_id"]] = verdict[8]
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == want

    unique = stored(SIMHASH(spark, clean, SF), "test")
    assert unique.columns == columns
    rows = clean.select("doc_id", "text").collect()
    roots = brute_components([r["doc_id"] for r in rows], [brute_print(r["text"]) for r in rows])
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(set(roots))

    masked = stored(PII(spark, unique, SF), "test")
    assert masked.columns == columns
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    after = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert after.keys() == before.keys()
    assert not any(brute_spans(t) for t in after.values())
    untouched = [d for d, t in before.items() if not brute_spans(t)]
    assert sum(after[d] == before[d] for d in untouched) >= 0.99 * len(untouched)

    mixed = stored(MIXING(spark, masked, SF), "test")
    assert mixed.columns == columns
    texts = Counter(r["doc_id"] for r in mixed.collect())
    assert set(texts) <= set(after) and max(texts.values()) <= 4

    packed = PACKING(spark, mixed, SF).collect()
    ids = [r["text"] for r in mixed.collect()]
    total = sum(len(i) + 1 for i in plain(BYTES, ids))
    assert sum(r["length"] for r in packed) == total
    assert check_places(packed, 1024) >= math.ceil(total / 1024)
    assert sum(r["piece"] == 0 for r in packed) == sum(texts.values())


def test_stages_take_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.collect()
    nothing = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_run_is_registered(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
