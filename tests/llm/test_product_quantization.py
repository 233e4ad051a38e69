"""Links, counts and components against all pairs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow import session
from wardflow.llm import product_quantization as pq
from wardflow.llm.common import local_stars
from wardflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, cosine=0.9):
    """{row number: (n_links, component_id)} over all pairs of usable vectors of one length."""
    usable = [
        k for k, (_, v) in enumerate(rows)
        if v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    i, j = [], []
    for size in {len(rows[k][1]) for k in usable}:
        own = np.array([k for k in usable if len(rows[k][1]) == size])
        x = np.array([rows[k][1] for k in own], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(x @ x.T >= cosine - 1e-12)
        i.append(own[a[a != b]])
        j.append(own[b[a != b]])
    i, j = np.concatenate(i or [np.zeros(0, int)]), np.concatenate(j or [np.zeros(0, int)])
    label = local_stars(len(rows), i, j)
    low = {}
    for x, (vec_id, _) in zip(label, rows):
        low[x] = min((v for v in (low.get(x), vec_id) if v is not None), default=None)
    counts = np.bincount(i, minlength=len(rows))
    return [(rows[k][0], int(counts[k]), low[label[k]]) for k in range(len(rows))]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_all_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op4_product_quantization"](spark, SF).collect()
    assert in_order((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == in_order(brute(rows))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_recall_of_pairs_at_the_limit(spark, monkeypatch):
    """Pairs planted between cosines 0.9 and 1, with many more lists than the query would choose."""
    monkeypatch.setattr(pq, "DB_BLOCK", 64)
    monkeypatch.setattr(pq, "QUERY_BLOCK", 100)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    step = rng.normal(size=base.shape)
    step -= (step * base).sum(axis=1, keepdims=True) * base
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    cos = rng.uniform(0.9, 1, size=(3000, 1))
    both = np.concatenate([base, cos * base + np.sqrt(1 - cos**2) * step])
    rows = [(k, v.tolist()) for k, v in enumerate(both)]
    want = {r[0]: r[1] for r in brute(rows)}
    got = {r["vec_id"]: r["n_links"] for r in pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == want


@pytest.mark.parametrize("dimension", [2, 3, 5])
def test_no_link_is_lost_in_few_dimensions(spark, dimension):
    """Where a step goes along few directions, most of it can carry a vector over a boundary."""
    rng = np.random.default_rng(dimension)
    base = rng.normal(size=(1500, dimension)) @ rng.normal(size=(dimension, 48))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    got = pq.near_duplicates(frame).collect()
    assert in_order((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == in_order(brute(rows))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]),
        (8, [2.0, 4.0]), (8, [2.0, 4.0]), (9, [-1.0, -2.0]), (10, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (None, [5.0, -5.0]),
        (11, [1e300, 2e300]), (12, [0.0, -0.0]), (13, [1e-300, 2e-300]), (14, [3.0]), (15, [-3.0]), (16, [8.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.select("*", *(F.lit("own").alias(c) for c in ("cls", "vector", "kept", "root")))
    got = pq.near_duplicates(frame).collect()
    assert in_order((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == in_order(brute(rows))
    assert pq.near_duplicates(frame.limit(0)).count() == 0


def test_large_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32)
    near = centre + 0.02 * rng.normal(size=(400, 32))
    far = rng.normal(size=(300, 32))
    rows = [(k, v.tolist()) for k, v in enumerate([*near, *far, *[centre] * 500])]
    got = pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert in_order((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == in_order(brute(rows))


def test_a_vector_is_kept_once_however_many_lists_it_is_near(spark, tmp_path, monkeypatch):
    """Vectors without clusters are near most lists; copies of them for each would grow faster than the input."""
    x = np.random.default_rng(3).normal(size=(12_000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    frame.write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/work")
    got = pq.near_duplicates(spark.read.parquet(f"{tmp_path}/in")).agg(F.sum("n_links"), F.count("*")).first()
    assert tuple(got) == (0, 12_000)
    stored = sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(f"{tmp_path}/work") for f in names)
    assert stored < 4 * x.nbytes


@pytest.mark.parametrize("dimension", [1, 3, 40])
def test_many_lists_on_many_shelves(spark, monkeypatch, dimension):
    """Most lists are out of reach of each other, some are larger than a shelf."""
    monkeypatch.setattr(pq, "LIST_ROWS", 8)
    monkeypatch.setattr(pq, "SHELF_PARTS", 150 * 48)
    monkeypatch.setattr(pq, "SHELF_LEAST", 1)
    rng = np.random.default_rng(dimension)
    base = rng.normal(size=(900, dimension)) @ rng.normal(size=(dimension, 48))
    near = base[0] + 0.1 * rng.normal(size=(300, 48))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near]).astype(np.float32))]
    rows = [(k, [float(p) for p in v]) for k, v in rows] + [(5000 + k, v[:47]) for k, v in rows[::3]]
    got = pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert in_order((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == in_order(brute(rows))


def test_a_dense_group_around_the_limit(spark):
    """Cosines of one group lie on both sides of the limit, and copies of its members count."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=32) + 0.33 * rng.normal(size=(1200, 32))
    rows = [(k, v.tolist()) for k, v in enumerate([*x, *x[:50], *x[:20]])]
    links = [r[1] for r in brute(rows)]
    assert 0.1 < np.mean(links) / len(rows) < 0.9
    got = pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert in_order((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == in_order(brute(rows))


@pytest.mark.parametrize("dimension", [2, 7, 64])
def test_bounds_hold(dimension):
    """What skips lists and rows is never more than the distance, and reduced products never less than the cosine."""
    rng = np.random.default_rng(dimension)
    x = pq._scaled(rng.normal(size=(400, dimension)) @ rng.normal(size=(dimension, 64)))
    index = pq.Index.fit(x, 100, 0.2**0.5)
    z = x @ index.axes
    home, reduced = index.home(z), index.reduced(z)
    apart = np.sqrt(((x[:, None].astype(float) - x) ** 2).sum(axis=2))
    gaps = [g[cell].T for g, cell in zip(index.gaps(z, home), index.cells(home))]
    assert (np.sqrt(sum((g + g.T) ** 2 for g in gaps)) <= apart + pq.ROUNDING).all()
    assert (reduced @ reduced.T >= x @ x.T - 1e-5).all()
    codes, error = index.encode(z, home)
    i, j = (k.ravel() for k in np.indices(apart.shape))
    assert (index.distances(z[i], home[j], codes[j]) <= apart.ravel() + error[j] + pq.ROUNDING).all()


def test_lists_on_shelves():
    layout, free = pq.Layout.of(np.array([3, 0, 4, 25, 2, 9]), 10, 5)
    assert layout.first.tolist() == [5, 5, 5, 6, 9, 10]
    assert layout.shelves.tolist() == [1, 1, 1, 3, 1, 1]
    assert free == 11
    assert set(layout.shelf(np.full(100, 3), np.arange(100))) == {6, 7, 8}
