"""Fingerprints against their definition, components against all pairs."""

import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of, empty, with_clashes
from wardflow.llm import simhash
from wardflow.llm.common import connected
from wardflow.llm.queries import QUERIES, documents

SF = "/root/testdata/sf0.01"


def brute_print(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    """The smallest id each row reaches."""
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                if a != b:
                    label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for x, d in zip(label, ids):
        low[x] = min((v for v in (low.get(x), d) if v is not None), default=None)
    return [low[x] for x in label]


@given(st.lists(st.sampled_from(["a", "B", "É", " ", "\n", "\x0b", "\x1c", " ", "漢", "cd "]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_long_text_in_slices(monkeypatch):
    text = " ".join(f"w{k % 701}" for k in range(5000))
    want = brute_print(text)
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.fingerprint(text.encode()) == want


def test_all_documents(spark):
    rows = documents(spark, SF).select("doc_id", "text").collect()
    prints = [brute_print(r["text"]) for r in rows]
    want = brute_components([r["doc_id"] for r in rows], prints)
    got = {r["doc_id"]: r for r in QUERIES["op10_simhash"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, p, c in zip(rows, prints, want):
        assert (got[r["doc_id"]]["fingerprint"], got[r["doc_id"]]["component_id"]) == (f"{p:016x}", c)


def planted_prints(seed=3):
    """Random fingerprints, each with some neighbours 1 to 6 bits away, and one chain of many near ones."""
    rng = np.random.default_rng(seed)
    out = []
    for value in rng.integers(0, 1 << 63, 700, dtype=np.uint64).tolist():
        out.append(value)
        for _ in range(rng.integers(0, 3)):
            for bit in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                value ^= 1 << bit
            out.append(value)
    chain = 12345
    for _ in range(300):
        for bit in rng.choice(64, 2, replace=False).tolist():
            chain ^= 1 << bit
        out.append(chain)
    return out + [0, 7, (1 << 64) - 1]


def test_trees_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DB_BLOCK", 16)
    monkeypatch.setattr(simhash, "QUERY_BLOCK", 32)
    prints = sorted(set(planted_prints()))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = simhash.linked_pairs(classes, 3, leaf_rows=20, sample_rows=500)
    got = {r["node"]: r["root"] for r in connected(links).collect()}
    f = np.array(prints, np.uint64)
    i, j = np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 3)
    label = simhash.local_stars(len(f), i, j)
    groups = {}
    for k, s in enumerate(signed):
        groups.setdefault(label[k], []).append(s)
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_route_covers_the_ball():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 32, 2000, dtype=np.uint64).astype(np.uint32)
    tree = simhash.VantageTree.build(values, 6)
    row, leaf, home = tree.route(values, 1)
    assert sorted(row[home]) == list(range(2000))
    homes = dict(zip(row[home].tolist(), leaf[home].tolist()))
    near = values ^ (np.uint32(1) << rng.integers(0, 32, 2000).astype(np.uint32))
    r2, l2, h2 = tree.route(near, 1)
    visited = set(zip(r2.tolist(), l2.tolist()))
    assert all((k, homes[k]) in visited for k in range(2000))


def test_components_of_links(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (102, 101), (7, 7), (200, 300), (300, 250)]
    star = [(1000, k) for k in range(1001, 1400)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert {got[k] for k in range(61)} == {0}
    assert {got[k] for k in (100, 101, 102)} == {100} and {got[k] for k in (200, 250, 300)} == {200}
    assert {got[k] for k in range(1000, 1400)} == {1000} and len(got) == 61 + 3 + 3 + 400
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    rows = awkward(spark).select("doc_id", "text").collect()
    want = brute_components([r["doc_id"] for r in rows], [brute_print(r["text"]) for r in rows])
    got = simhash.near_duplicates(with_clashes(awkward(spark))).collect()
    key = lambda x: (str(x[0]), x[1], str(x[2]))
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=key) == sorted(
        ((r["doc_id"], brute_print(r["text"]), c) for r, c in zip(rows, want)), key=key
    )
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    docs = with_clashes(awkward(spark))
    kept = simhash.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    # 1, 2, 6 and one null id have no words; 3 and 8 are copies, as are 4, 4 and 5.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "7", "9", "None"]
    assert simhash.keep_one(empty(spark)).count() == 0
    same_id = docs_of(spark, [(1, "first text of its own"), (1, "another one, quite different"), (None, "x y z w"), (None, "p q r s")])
    assert simhash.keep_one(same_id).count() == 4
