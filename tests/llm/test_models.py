"""Language-model scores against plain counts; the toxicity chain on documents it has not seen."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of, empty, with_clashes
from wardflow.llm import lm, toxicity
from wardflow.llm.queries import documents

SHAPE = lm.Shape(word_bits=12, pair_bits=14, pull=4.0)
LABELS = "doc_id long, quality int, toxic int"


def brute_scores(rows, good, shape):
    """Losses from dictionaries of counts over all words of all texts."""
    mask = (1 << 64) - 1

    def words(text):
        found = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
        return [xxhash.xxh64_intdigest(w.encode(), 42) for w in found]

    def events(text):
        before, last = 0, None
        for h in words(text):
            x = (before * 0x9E3779B97F4A7C15 & mask) ^ h
            x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & mask
            word = h >> (64 - shape.word_bits)
            yield word, last, x >> (64 - shape.pair_bits)
            before, last = h, word

    counts = [Counter(), Counter()]
    for doc_id, text in rows:
        for which in (0, 1) if doc_id in good else (0,):
            for word, last, pair in events(text):
                counts[which].update([("w", word), ("p", pair), "all", *["start"] * (last is None)])
    scale = counts[1]["all"] / counts[0]["all"]
    in_use = sum(1 for k in counts[0] if k[0] == "w")
    out = []
    for doc_id, text in rows:
        means = []
        for which, by in ((1, 1.0), (0, scale)):
            c, losses = counts[which], []
            for word, last, pair in events(text):
                single = (c["w", word] * by + 1) / (counts[1]["all"] + in_use)
                seen = by * (c["start"] if last is None else c["w", last])
                losses.append(-math.log((min(by * c["p", pair], seen) + shape.pull * single) / (seen + shape.pull)))
            means.append(sum(losses) / len(losses) if losses else None)
        out.append((doc_id, len(words(text)), *means))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for g, w in zip(got, want):
        for a, b in zip(g[2:], w[2:]):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-5)


def scored(df):
    return [(r["doc_id"], r["n_tokens"], r["ce_target"], r["ce_background"]) for r in df.collect()]


def test_scores_of_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)
    monkeypatch.setattr(lm, "BLOCK_CELLS", 1 << 10)
    docs = documents(spark, "/root/testdata/sf0.001").repartition(5)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = lm.cross_entropy_difference(docs, labels, SHAPE)
    same(scored(got), brute_scores(rows, good, SHAPE))
    assert all(math.isclose(r["ce_difference"], r["ce_target"] - r["ce_background"], abs_tol=1e-9) for r in got.collect() if r["n_tokens"])


def test_scores_keep_every_word_apart(spark, monkeypatch):
    """More words and pairs than any small table has cells, in many blocks, against counts of the words themselves."""
    monkeypatch.setattr(lm, "BLOCK_WORDS", 40_000)
    monkeypatch.setattr(lm, "BLOCK_CELLS", 1 << 14)
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 400_000, 1500)) + " the end" * (k % 3)) for k in range(300)]
    good = set(range(0, 300, 4))
    labels = spark.createDataFrame([(k, 1, 0) for k in good], LABELS)
    got = lm.cross_entropy_difference(docs_of(spark, rows).repartition(3), labels)
    same(scored(got), brute_scores(rows, good, lm.Shape(word_bits=64, pair_bits=64)))


def test_scores_tell_quality(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = lm.cross_entropy_difference(documents(spark, "/root/testdata/sf0.01"), labels).join(labels, "doc_id").collect()
    low = [r["ce_difference"] for r in rows if r["quality"] == 0 and r["n_tokens"]]
    high = [r["ce_difference"] for r in rows if r["quality"] == 1 and r["toxic"] == 0 and r["n_tokens"]]
    assert np.median(low) > np.percentile(high, 90)


def test_scores_of_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    labels = spark.createDataFrame([(4, 1, 0), (3, 1, 0), (3, 0, 0), (7, 1, None), (None, 1, 0), (4, 1, 0), (99, 1, 0)], LABELS)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same(scored(lm.cross_entropy_difference(docs, labels, SHAPE)), brute_scores(rows, {4}, SHAPE))
    none = lm.cross_entropy_difference(docs, labels.limit(0), SHAPE).collect()
    assert len(none) == 12 and all(r["ce_difference"] is None for r in none)
    assert lm.cross_entropy_difference(empty(spark), labels, SHAPE).count() == 0


@pytest.fixture(scope="module")
def split(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0
    return docs, labels.where(half), labels.where(~half)


def test_chain_on_unseen_documents(spark, split):
    docs, learned, held = split
    chain = toxicity.train(docs, learned, sample_rows=600)
    assert len(chain.models) == 3 and [len(m.earlier) for m in chain.models] == [0, 1, 2]
    rows = toxicity.score(docs.join(held.select("doc_id"), "doc_id", "left_semi"), chain).join(held.select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    hits = sum(r["toxic"] and r["label"] == 1 for r in rows)
    assert hits >= 0.8 * sum(r["label"] == 1 for r in rows)  # about 200 toxic documents were learned from
    assert hits >= 0.8 * sum(r["toxic"] for r in rows)
    assert any(r["severe"] for r in rows) and sum(r["persistent"] for r in rows) >= sum(r["severe"] for r in rows)


def test_linear_model_reaches_its_optimum():
    rng = np.random.default_rng(0)
    cells = [np.unique(rng.integers(0, 16, 5)) for _ in range(400)]
    offsets, flat = np.concatenate([[0], np.cumsum([len(c) for c in cells])]), np.concatenate(cells)
    label = np.array([float((3 in c) + rng.random() > 0.8) for c in cells])
    earlier = rng.random((400, 1))
    model = toxicity.fit_linear(flat, offsets, earlier, label, 4, rounds=4000, rate=0.02, penalty=1e-3)
    error = (model.probability(flat, offsets, earlier) - label) / 400
    x = np.zeros((400, 16))
    for k, c in enumerate(cells):
        x[k, c] = 1 / np.sqrt(len(c))
    bad, rest = (x[label == v] > 0 for v in (1, 0))
    ratio = np.log((bad.sum(axis=0) + 1) / (len(bad) + 2)) - np.log((rest.sum(axis=0) + 1) / (len(rest) + 2))
    assert np.abs(x.T @ error * ratio + 1e-3 * model.cells / ratio).max() < 1e-3
    assert np.abs(error @ earlier + 1e-3 * model.earlier).max() < 1e-3 and abs(error.sum()) < 1e-3


def test_best_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])) == pytest.approx(0.55)
    assert toxicity.best_threshold(np.array([0.5, 0.5]), np.array([1, 0])) == 0.5


def test_best_threshold_at_the_true_class_ratio():
    """Clean documents of a sample count for those left out: the same threshold as over all of them."""
    rng = np.random.default_rng(8)
    p = np.concatenate([rng.beta(4, 2, 300), rng.beta(2, 4, 600)])
    label = np.repeat([1.0, 0.0], [300, 600])
    times = np.where(label > 0, 1, 9)
    whole = toxicity.best_threshold(np.repeat(p, times), np.repeat(label, times))
    assert toxicity.best_threshold(p, label, times.astype(float)) == pytest.approx(whole)
    assert toxicity.best_threshold(p, label) < whole


def test_toxicity_of_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 1, 0), (4, 1, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)], LABELS)
    chain = toxicity.train(docs, labels)
    assert toxicity.score(docs, chain).count() == 12
    assert toxicity.score(empty(spark), chain).count() == 0
    none = toxicity.train(docs, labels.where("toxic = 1"))
    assert none.models == [] and not any(r["toxic"] for r in toxicity.score(docs, none).collect())
    assert toxicity.train(empty(spark), labels).models == []
