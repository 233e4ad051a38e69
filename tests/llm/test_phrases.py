"""Phrases against a plain count and their SQL; filters against dictionaries."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import DOCS, awkward, empty, with_clashes
from wardflow.llm import phrases
from wardflow.llm.oracle import phrases_sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, percent=50, top=2000):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    count[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in count.items():
        scored = []
        for gram, a in f.items():
            if len(gram) < 2 or a < least:
                continue
            if any(len(t) == 3 and gram in (t[:2], t[1:]) and n >= least and 100 * n >= percent * a for t, n in f.items() if len(gram) == 2):
                continue
            score, k = min((1_000_000 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram)))
            scored.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, text, lang, "s", 0) for i, (text, lang) in enumerate(rows)], DOCS)


def found(docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).select(COLUMNS).collect())


def sample(seed, documents=150):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "GAMMA", "δ", "e e", "ZÉ", "zé", *(f"w{i}" for i in range(25))]
    rows = []
    for i in range(documents):
        words = [rng.choice(vocabulary[: rng.choice([3, 8, 32])]) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice([["new", "york", "city"], ["Los", "Angeles"], ["new", "york"]])
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \r\n", "!?"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), (" .,\n", "it"), ("a " * 50, "xx"), ("a b " * 11, "yy")]


@pytest.mark.parametrize("options", [{}, {"least": 3, "percent": 90}, {"least": 4, "top": 7}])
def test_equal_to_a_plain_count_and_sql(spark, options):
    rows = sample(5)
    docs = docs_of(spark, rows).repartition(5)
    named = {"min_count": options.get("least", 10), "contained_percent": options.get("percent", 50), "top": options.get("top", 2000)}
    got = found(docs, **named)
    assert got == brute(rows, **options) and len(got) > 20
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang").toArrow())
    done = con.execute(phrases_sql(**named))
    names = [d[0] for d in done.description]
    assert got == sorted(tuple(r[names.index(c)] for c in COLUMNS) for r in done.fetchall())


def test_blocks_shards_and_levels_do_not_show(spark, monkeypatch):
    rows = sample(6)
    rows.append((" ".join(random.Random(1).choices(["new", "york", "w1", "w2,", "x" * 90], k=3000)), "en"))
    docs = docs_of(spark, rows).repartition(3)
    whole = found(docs, min_count=3)
    assert whole == brute(rows, least=3)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 60)
    monkeypatch.setattr(phrases, "LEVEL_BITS", 2)
    monkeypatch.setattr(phrases, "LEAST_BITS", 5)
    assert found(docs, min_count=3) == whole


def test_awkward_rows(spark):
    docs = awkward(spark)
    plain = found(docs, min_count=2)
    assert plain == found(with_clashes(docs), min_count=2)
    assert plain == brute([(r["text"], r["lang"]) for r in docs.collect()], least=2)
    assert found(empty(spark)) == []


def test_no_frequent_word(spark):
    assert found(docs_of(spark, [("only rare words here", "en")])) == []


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(3_000_000_000, 3_000_000_001, 3_000_000_002)], "a long, l long, r long")
    got = rows.select(phrases._score(rows.a, rows.l, rows.r)).first()[0]
    assert got == 1_000_000 * 3_000_000_000**2 // (3_000_000_001 * 3_000_000_002)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_permutation_and_filters_lose_nothing(b, data):
    number = st.integers(0, (1 << b) - 1)
    grams = data.draw(st.lists(st.tuples(number, number, number), max_size=60))
    counts = data.draw(st.lists(st.one_of(st.integers(1, 300), st.integers(1, 1 << 40)), min_size=len(grams), max_size=len(grams)))
    prefix = data.draw(st.integers(0, min(2 * b, 12)))
    w = np.array(grams, np.uint64).reshape(-1, 3)
    high, low = w[:, 0] << np.uint64(b) | w[:, 1], w[:, 2]
    mixed = phrases.permuted(high, low, b)
    back = phrases.restored(*mixed, b)
    assert (back[0] == high).all() and (back[1] == low).all()
    total = Counter()
    for gram, n in zip(zip(*(c.tolist() for c in mixed)), counts):
        total[gram] += n
    rows = []
    halves = len(grams) // 2
    for part in (slice(0, halves), slice(halves, None)):
        entries = phrases._counted(mixed[0][part], mixed[1][part], np.array(counts[part], np.int64), b)
        rows += phrases._dealt(0, *entries, prefix, b).to_pylist() if len(entries[0]) else []
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row["shard"]].append(row["data"])
    merged = Counter()
    for shard, filters in by_shard.items():
        high, low, n = phrases.CountingQuotientFilter.merged(filters, b)
        assert (high >> np.uint64(2 * b - prefix) == shard).all() if prefix else True
        merged.update(dict(zip(zip(high.tolist(), low.tolist()), n.tolist())))
    assert merged == total
