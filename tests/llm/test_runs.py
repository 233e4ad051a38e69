"""Periodic runs against their definition, the wavelet tree against a plain search, and the query against its SQL."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import awkward, docs_of, empty, with_clashes
from wardflow.llm import queries, runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, exponent=4, least=6):
    """All (start, end, smallest period) by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(rows):
    out = []
    for doc_id, text in rows:
        words = planted(WORDS.findall(text or ""), doc_id)
        found = brute(words)
        gone = {i for s, e, q in found for i in range(s + q, e)}
        best = max(found, key=lambda r: ((r[1] - r[0]) / r[2], -r[0], -r[2]), default=None)
        told = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(found), *told, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept))))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def answered(spark, monkeypatch, docs):
    monkeypatch.setattr(queries, "documents", lambda *_: docs)
    return sorted((tuple(r) for r in queries.op11_periodic_runs(spark, "").select(COLUMNS).collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 8)), max_size=5), st.integers(1, 3))
def test_runs_of_repeated_pieces(pieces, times):
    words = [w for piece, n in pieces for w in piece * n] * times
    got = runs.find_runs(np.array(words, np.int64), len(words), 4, 6)
    assert [tuple(map(int, r)) for r in got] == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200), st.randoms(use_true_random=False))
def test_range_successor(n, rng):
    values = list(range(n))
    rng.shuffle(values)
    tree = runs.WaveletTree(np.array(values))
    asked = [(*sorted((rng.randrange(n + 1), rng.randrange(n + 1))), rng.randrange(n + 2)) for _ in range(50)]
    lo, hi, least = (np.array(c) for c in zip(*asked))
    assert list(tree.successor(lo, hi, least)) == [min((v for v in values[a:b] if v >= x), default=n) for a, b, x in asked]


def test_query_equals_brute_force_and_sql(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for doc_id in range(400):
        words = [f"w{rng.randrange(rng.choice([2, 30]))}" for _ in range(rng.randrange(90))]
        if doc_id % 3 == 0:
            words[5:5] = [f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 9))] * rng.randrange(3, 8)
        rows.append((doc_id, rng.choice([" ", "\t", "\n ", "\x0b"]).join(words)))
    rows += [(10, "again again again again again again"), (10, "again again again again again again"), (None, "a b " * 9), (7, None)]
    docs = docs_of(spark, rows)
    got = answered(spark, monkeypatch, docs)
    assert got == expected(rows)
    assert sum(1 for r in got if r[1]) > 60
    con = duckdb.connect()
    con.register("documents", docs.where("doc_id is not null").select("doc_id", "text").toArrow())
    done = con.execute(queries.ORACLE["op11_periodic_runs"])
    names = [d[0] for d in done.description]
    from_sql = sorted((tuple(r[names.index(c)] for c in COLUMNS) for r in done.fetchall()), key=str)
    assert from_sql == [r for r in got if r[0] is not None]


def test_batches_do_not_show(spark, monkeypatch):
    rows = [(i, "x y " * (i % 9) + "z " * (i % 7)) for i in range(200)]
    whole = answered(spark, monkeypatch, docs_of(spark, rows))
    monkeypatch.setattr(runs, "BATCH_WORDS", 10)
    assert answered(spark, monkeypatch, docs_of(spark, rows)) == whole == expected(rows)


def test_awkward_rows(spark, monkeypatch):
    docs = awkward(spark)
    plain = runs.periodic_runs(docs).collect()
    assert len(plain) == docs.count()
    assert sorted(map(str, plain)) == sorted(map(str, runs.periodic_runs(with_clashes(docs)).collect()))
    by_id = {r["doc_id"]: r for r in plain}
    # 60,000 words with period 977, the last with a full stop.
    assert [tuple(x) for x in by_id[3]["runs"]] == [(0, 59_999, 977)]
    assert by_id[1]["n_words"] == 0 and by_id[1]["collapsed"] == "" and by_id[6]["runs"] == []
    assert runs.periodic_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, exponent=3)


@pytest.mark.parametrize("words", [["a"] * 400_000, ["a", "b", "a", "c"] * 100_000, [f"w{i % 99991}" for i in range(400_000)]])
def test_long_texts_take_time_in_proportion(words):
    started = time.monotonic()
    ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
    found = runs.find_runs(ids, len(ids), 4, 6)
    assert len(found) == 1 and time.monotonic() - started < 60
