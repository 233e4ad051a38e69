"""Toxicity by a classifier chain: one linear model per category, each fed the probabilities of those before it.

Features are the words of a document and the beginnings of its words, hashed, each counted as present or not. The
first category is ``toxic`` as labelled. Two more are told apart among toxic documents by the terms that speak most
for the label in the training sample: ``persistent`` (several of them) and ``severe`` (many for the length). For a
later model's training, the earlier probabilities come from models that have not seen the document (out of fold);
for scoring they come from models fitted on the whole sample. Thresholds are those of the best F1 out of fold,
with each document of the sample standing for all of its class, so that they do not follow the sample's class ratio.

Training takes at most ``2 * sample_rows`` toxic documents and three times as many others, chosen by a hash; every
document is scored, over its whole text.

Cases: a null or empty text has no features and gets the models' base rates. Repeated rows are scored alike.
Labels that contradict each other count as toxic, null labels as missing. Without labels of both classes nothing can
be learned: all probabilities are 0 and nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import bounded_sample, stored

CATEGORIES = ("toxic", "persistent", "severe")
FOLDS = 3
CLEAN = 3  # documents that are not toxic, for each toxic one
STEMS = (4, 5)  # letters of the beginnings of words


def tokens(docs: DataFrame, bits: int, with_words: bool = False) -> DataFrame:
    """(doc_id, cells) per row: the cells of its words in lower case and of the beginnings of its words."""
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = F.array_distinct(F.split(F.regexp_replace(text, r"[^\p{L}\p{M}]+", " "), " "))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.filter(words, lambda w: w != "").alias("words"))
    stems = [F.array_distinct(F.transform("words", _beginning(n))) for n in STEMS]
    cells = F.transform(F.concat("words", *stems), lambda t: F.pmod(F.xxhash64(t), F.lit(1 << bits)).cast("int"))
    return rows.select("doc_id", *["words"] * with_words, F.array_distinct(cells).alias("cells"))


def _beginning(n: int):
    return lambda w: F.concat(F.lit(f"{n}^"), F.substring(w, 1, n))


@dataclass
class Linear:
    """A logistic model: a weight per cell, weights of earlier probabilities, and an intercept."""

    cells: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probability(self, flat: np.ndarray, offsets: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.cells[flat])])
        z = (sums[offsets[1:]] - sums[offsets[:-1]]) * _scale(offsets) + earlier @ self.earlier + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scale(offsets: np.ndarray) -> np.ndarray:
    """What a cell counts in each document: less, the more cells it has."""
    return 1 / np.sqrt(np.maximum(1, np.diff(offsets)))


def fit_linear(flat, offsets, earlier, label, bits: int, rounds: int = 100, penalty: float = 1e-5, rate: float = 0.2) -> Linear:
    """Penalised logistic loss by full-batch steps with a rate per weight (Adam).

    A cell enters with its log ratio of document frequencies between the classes, so the penalty spares what tells
    them apart in many documents and holds back what occurs in one.
    """
    cells, n = 1 << bits, len(label)
    row, scale = np.repeat(np.arange(n), np.diff(offsets)), _scale(offsets)
    bad = np.bincount(flat, weights=label[row], minlength=cells)
    rest = np.bincount(flat, minlength=cells) - bad
    ratio = np.log((bad + 1) / (label.sum() + 2)) - np.log((rest + 1) / (n - label.sum() + 2))
    ratio[bad + rest == 0] = 0
    k = earlier.shape[1]
    w, m, v = (np.zeros(cells + k + 1) for _ in range(3))
    base = min(max(label.mean(), 1e-3), 1 - 1e-3)
    w[-1] = np.log(base / (1 - base))
    model = lambda: Linear(w[:cells] * ratio, w[cells:-1], float(w[-1]))
    for step in range(1, rounds + 1):
        error = (model().probability(flat, offsets, earlier) - label) / n
        pull = np.bincount(flat, weights=(error * scale)[row], minlength=cells) * ratio
        grad = np.concatenate([pull, error @ earlier, [error.sum()]])
        grad[:-1] += penalty * w[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model()


@dataclass
class Chain:
    """The fitted models in order, and the least probability per category."""

    bits: int
    models: list[Linear] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)


def best_threshold(probability: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The probability from which taking documents gives the best F1; half way to the next one below it.

    A document counts ``weight`` times.
    """
    weight = np.ones(len(label)) if weight is None else weight
    order = np.argsort(-probability, kind="stable")
    p, hits = probability[order], np.cumsum((label * weight)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + max(1, (label * weight).sum()))
    f1[:-1][p[:-1] == p[1:]] = -1  # equal probabilities are taken together
    at = int(np.argmax(f1))
    return float((p[at] + p[at + 1]) / 2) if at + 1 < len(p) else float(p[at])


def labelled(docs: DataFrame, labels: DataFrame, sample_rows: int, bits: int) -> DataFrame:
    """A bounded sample of labelled documents of both classes: (doc_id, words, cells, toxic, weight).

    ``weight`` is how many labelled documents of its class a sampled one stands for.
    """
    seen = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    seen = seen.agg((F.max("toxic") > 0).cast("double").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in seen.groupBy("toxic").count().collect()}
    wanted = {v: sample_rows * (1 if v else CLEAN) for v in totals}
    parts = [
        bounded_sample(seen.where(F.col("toxic") == v), F.col("doc_id"), wanted[v], n).withColumn("weight", F.lit(max(1.0, n / wanted[v])))
        for v, n in sorted(totals.items())
    ]
    if len(parts) < 2:
        return tokens(docs.limit(0), bits, with_words=True).withColumns({"toxic": F.lit(0.0), "weight": F.lit(1.0)})
    # At most 8 * sample_rows rows of two numbers, so the sample goes to the documents. Of repeated ids one counts.
    few = F.broadcast(parts[0].unionByName(parts[1]))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few, "doc_id").dropDuplicates(["doc_id"])
    words = tokens(found, bits, with_words=True)
    return words.join(few, "doc_id")


def _with_categories(rows: DataFrame, terms: int = 200) -> DataFrame:
    """The later categories, from how many of the most telling words of the sample a document has."""
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    telling = counts.where("bad >= 3 and bad >= 0.9 * n").orderBy(F.desc("bad"), "word").limit(terms)
    found = F.broadcast(telling.agg(F.collect_set("word").alias("telling")))  # at most ``terms`` words
    hits = F.size(F.array_intersect("words", "telling"))
    rows = rows.join(found).withColumn("hits", hits)
    persistent = (F.col("toxic") > 0) & (F.col("hits") >= 3)
    severe = persistent & (F.col("hits") * 40 >= F.size("words"))
    return rows.select("doc_id", "cells", "weight", "toxic", persistent.cast("double").alias("persistent"), severe.cast("double").alias("severe"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 800, bits: int = 16) -> Chain:
    """Fit the chain; it has no models where the labels have fewer than two classes."""
    rows = stored(labelled(docs, labels, sample_rows, bits), "labelled")
    data = _with_categories(rows).toPandas().sort_values("doc_id", ignore_index=True)
    chain = Chain(bits)
    if data["toxic"].nunique() < 2:
        return chain
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in data["cells"]])]).astype(np.int64)
    flat = np.concatenate(data["cells"].tolist()).astype(np.int64)
    fold = data.index.to_numpy() % FOLDS

    def some(take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.diff(offsets)
        return flat[np.repeat(take, lengths)], np.concatenate([[0], np.cumsum(lengths[take])])

    earlier = np.zeros((len(data), 0))
    for category in CATEGORIES:
        label, unseen = data[category].to_numpy(), np.zeros(len(data))
        for k in range(FOLDS):
            learned, held = fold != k, fold == k
            model = fit_linear(*some(learned), earlier[learned], label[learned], bits)
            unseen[held] = model.probability(*some(held), earlier[held])
        chain.models.append(fit_linear(flat, offsets, earlier, label, bits))
        chain.thresholds.append(best_threshold(unseen, label, data["weight"].to_numpy()))
        earlier = np.column_stack([earlier, unseen])
    return chain


SCORES = "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", " + ", ".join(f"{c} boolean" for c in CATEGORIES)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """Per row: doc_id, a probability and a verdict per category; the verdict ``toxic`` is the first category's."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [part.split()[0] for part in SCORES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            column = batch.column("cells")
            offsets = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
            found = np.zeros((batch.num_rows, 0))
            for model in chain.models:
                found = np.column_stack([found, model.probability(flat, offsets - offsets[0], found)])
            if not chain.models:
                found = np.zeros((batch.num_rows, len(CATEGORIES)))
            verdicts = found >= np.array(chain.thresholds or [np.inf] * len(CATEGORIES))
            arrays = [batch.column("doc_id"), *map(pa.array, found.T.copy()), *map(pa.array, verdicts.T.copy())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return tokens(docs, chain.bits).mapInArrow(run, SCORES)
