"""Base spans against the patterns themselves; the boosted candidates on planted data of another seed."""

import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import awkward, docs_of, empty, with_clashes
from wardflow.llm import pii
from wardflow.llm.queries import documents

SF = "/root/testdata/sf0.01"


def plain_luhn(d):
    doubled = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(d[::-1])]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [
        ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))
    ]
    found += [
        ("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 16 <= len(digits(m.group())) <= 19 and plain_luhn(digits(m.group()))
    ]
    found += [
        ("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m.group())) <= 15
    ]
    return found


PARTS = st.sampled_from(
    ["a", "b.c", "@", "@x.de", ".", "..", "-", "_", "+", "1", "255", "256", "0001", ".1", ".2.3", " ", "4207051279108084",
     "4207 0512-7910 8084", "79927398713", "(", ")", "555", "+1 (375) 555-4393", "é", "😀", "\n", "%", "00000000000000000"]
)


@given(st.lists(PARTS, max_size=25).map("".join))
@settings(max_examples=800, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_time_is_in_proportion_to_length():
    for unit in ("a", "1", "1.", "+1", "a@", "1 ", ".", "1:", "a dot ", "at "):
        pii.base_spans(unit * 100_000)
        pii.candidates(unit * 20_000)


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(documents(spark, SF))


def test_all_documents(spark, model):
    got = {r["doc_id"]: r for r in pii.find(documents(spark, SF), model).collect()}
    for r in documents(spark, SF).collect():
        g, base = got[r["doc_id"]], brute(r["text"] or "")
        assert [g[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert g["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(g["spans"].split(","))
        assert len(list(filter(None, g["spans"].split(",")))) == len(base) + g["n_added"]


def test_candidates_are_chosen_well(spark, model):
    assert len(model.trees) == 20 and len(model.thresholds) == 4
    right = wrong = missed = 0
    contexts = [r["text"][50:350] for r in documents(spark, SF).collect() if r["text"] and len(r["text"]) > 400]
    for k, context in enumerate(contexts):
        for kind, label, row in pii.examples(context, 10**12 + k):
            taken = model.score(row) >= model.thresholds[kind]
            right, wrong, missed = right + (taken and label), wrong + (taken and not label), missed + (label and not taken)
    assert right / (right + wrong) > 0.93
    assert right / (right + missed) > 0.75


def test_trees_score_as_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(0)
    x = rng.random((300, 5))
    rows = [(Vectors.dense(v), float(v[0] + v[2] * v[3] > 0.9)) for v in x]
    data = spark.createDataFrame(rows, ["features", "label"])
    fitted = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(data)
    ours = pii.PiiModel([pii._tree(t.toDebugString) for t in fitted.trees], list(fitted.treeWeights))
    for r in fitted.transform(data).collect():
        assert (ours.score(list(r["features"])) > 0) == (r["prediction"] == 1.0)
        assert abs(1 / (1 + np.exp(-2 * ours.score(list(r["features"])))) - r["probability"][1]) < 1e-9


def test_threshold_pools_falling_scores():
    scores = np.array([1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    assert pii.threshold(scores, np.array([0, 1, 0, 1, 1, 1]), 0.9) == 4.0
    assert pii.threshold(scores, np.array([0, 0, 0, 0, 0, 0]), 0.9) == float("inf")
    assert pii.threshold(np.array([]), np.array([]), 0.9) == float("inf")


def test_disguised_data_and_look_alikes(model):
    def taken(text):
        return sorted(text[s[1] : s[2]] for s in model.added(text, pii.base_spans(text)))

    assert taken("write to bob at example dot com now") == ["bob at example dot com"]
    assert taken("call (375) 555-4393 today") == ["(375) 555-4393"]
    assert taken("on 2024-01-02 at 12:30:45 he was at home.Then he left, ISBN 978-3-16-148410-0") == []


def test_awkward_rows(spark, model):
    docs = with_clashes(awkward(spark))
    assert pii.find(docs, model).count() == 12
    assert pii.find(empty(spark), pii.train(empty(spark))).count() == 0
    kept = pii.redact(docs, model)
    assert kept.schema == docs.schema and kept.count() == 12
    plain = docs_of(spark, [(1, "a@b.de and +1 (375) 555-4393."), (2, None), (3, "")])
    got = {r["doc_id"]: r["text"] for r in pii.redact(plain, model).collect()}
    assert got == {1: "[EMAIL] and [PHONE].", 2: None, 3: ""}


def test_overlapping_spans_are_masked_once():
    text = "0123456789"
    assert pii.masked(text, [("card", 1, 5), ("phone", 3, 7), ("ip", 7, 8)]) == "0[CARD][IP]89"
    assert pii.masked(text, []) == text


def test_dense_texts_take_time_in_proportion(model):
    """Thousands of base spans and as many candidates, in one text."""
    times = []
    for n in (4000, 16000):
        text = " ".join(f"user{i}@mail{i}.example.org wrote 20{i % 90 + 10}-11-{i % 28 + 1} call 555-{i % 900 + 100}-{i % 9000 + 1000};" for i in range(n))
        started = time.process_time()
        base = pii.base_spans(text)
        added = model.added(text, base)
        times.append(time.process_time() - started)
        assert len(base) >= n
        taken = sorted((s, e) for _, s, e in added)
        assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:]))
    assert times[1] < 8 * times[0]
