"""Mixing sources to target weights by temperature, in DataFrame operations only.

Source shares of all tokens are raised to an exponent and normalised: 1 keeps the shares, 0 makes all sources
equal. Bisection finds the largest exponent whose weights reach ``target_entropy`` (as a fraction of the entropy of
equal weights) and the smallest that reads no source more than ``most_repeats`` times; the larger of the two holds,
so the repetition limit wins. If not even exponent 1 meets the limit, exponent 1 is taken and its repeats are cut
to the limit.

A source's weight times the token budget is what is read of it: whole epochs, then part of one. In each epoch the
blocks of a source (documents with the same first hex digits of a hash of their id) stand in an order of that
epoch's own, and so do the documents of a block. A part epoch takes whole blocks in that order while they fit and
of the next block the documents that still fit in order. Hashes are MD5 of text, so any SQL engine can repeat them.

Cases: a null source is a source of its own. A null or empty text has no tokens; it is read with its block.
Repeated rows count and are read each on their own. Sources without tokens have weight zero and are read in no
epoch. An empty table gives an empty mixture.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.llm.common import free_name, stored

STEPS, STEPS_PER_JOB = 32, 4
PLAN_ROWS = 500_000


@dataclass(frozen=True)
class Mixture:
    target_entropy: float = 0.97
    most_repeats: float = 4.0
    budget_share: float = 1.0  # of all tokens
    block_digits: int = 3  # 16 ** digits blocks per source
    seed: str = "mix"


def n_tokens(text: Column) -> Column:
    """Words: runs of anything but ASCII white space."""
    counted = F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(counted, F.lit(0)).cast("long")


def _bisect(shares: DataFrame, too_low: Callable[[dict, float], bool]) -> float:
    """The exponent between 0 and 1 below which ``too_low`` holds.

    ``shares`` has ``tokens`` and ``p`` > 0 per source. One job evaluates every exponent that the next few steps may
    come to, so the steps are those of plain bisection in fewer passes.
    """
    low, width = 0.0, 1.0
    for _ in range(STEPS // STEPS_PER_JOB):
        parts = 1 << STEPS_PER_JOB
        tried = [low + width * k / parts for k in range(1, parts)]
        sums = []
        for k, a in enumerate(tried):
            power = F.pow(F.col("p"), F.lit(a))
            sums += [F.sum(power).alias(f"z{k}"), F.sum(power * F.ln("p")).alias(f"s{k}")]
            sums.append(F.max(power / F.col("tokens")).alias(f"r{k}"))
        row = shares.agg(*sums).first().asDict()
        at, step = 0, parts // 2
        while step:
            k = at + step - 1
            if too_low({"z": row[f"z{k}"], "s": row[f"s{k}"], "r": row[f"r{k}"]}, tried[k]):
                at += step
            step //= 2
        low, width = low + width * at / parts, width / parts
    return low + width


def solve_exponent(per_source: DataFrame, mixture: Mixture) -> float:
    """The exponent for a table (source, tokens); 1 if no source has tokens."""
    live = per_source.where("tokens > 0")
    total, sources = live.agg(F.sum("tokens"), F.count("*")).first()
    if not sources:
        return 1.0
    shares = live.withColumn("p", F.col("tokens") / F.lit(float(total)))
    goal, budget = mixture.target_entropy * math.log(sources), total * mixture.budget_share
    # Entropy and repeats both fall as the exponent rises; at 1 every source repeats budget_share times.
    entropy = shares.agg(-F.sum(F.col("p") * F.ln("p"))).first()[0]
    by_entropy = 1.0
    if entropy < goal:
        by_entropy = _bisect(shares, lambda x, a: math.log(x["z"]) - a * x["s"] / x["z"] >= goal)
    by_repeats = _bisect(shares, lambda x, a: x["r"] / x["z"] * budget > mixture.most_repeats)
    return max(by_entropy, by_repeats)


def source_plan(per_source: DataFrame, mixture: Mixture) -> DataFrame:
    """Per source: tokens, weight, and how it is read: ``epochs`` whole ones and ``rest`` tokens of one more."""
    exponent = solve_exponent(per_source, mixture)
    live = per_source.where("tokens > 0")
    total = live.agg(F.sum("tokens")).first()[0] or 0
    powered = live.withColumn("power", F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent)))
    whole = powered.agg(F.sum("power")).first()[0] or 1.0
    weighted = powered.withColumn("weight", F.col("power") / F.lit(whole))
    wanted = F.round(F.col("weight") * F.lit(float(total)) * F.lit(mixture.budget_share))
    most = F.floor(F.col("tokens") * F.lit(mixture.most_repeats))
    planned = weighted.withColumn("budget", F.least(wanted, most))
    epochs = F.floor(F.col("budget") / F.col("tokens"))
    return planned.select(
        "source", "tokens", "weight", epochs.alias("epochs"), (F.col("budget") - epochs * F.col("tokens")).alias("rest")
    )


def _hashed(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def _place(mixture: Mixture, epoch: Column, doc_id: Column) -> Column:
    return _hashed(F.lit(mixture.seed), epoch, doc_id)


def block_plan(counted: DataFrame, mixture: Mixture) -> DataFrame:
    """(source, block, epoch, block_rank, last_place): the blocks read in each epoch, in order.

    ``counted`` has doc_id, source, block and n_tokens. ``last_place`` is null for a block read whole; in the one
    block that no longer fits, documents up to it are read.
    """
    blocks = stored(counted.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks")
    per_source = stored(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    plan = stored(source_plan(per_source, mixture), "plan").drop("tokens", "weight")
    same = blocks["source"].eqNullSafe(plan["source"])
    read = blocks.join(plan, same).select(blocks["source"], "block", "tokens", "epochs", "rest")
    read = read.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs"))))
    # At most 16 ** block_digits rows per source and epoch.
    order = Window.partitionBy("source", "epoch").orderBy("turn", "block")
    read = (
        read.withColumn("turn", _hashed(F.lit(mixture.seed), F.col("source"), F.col("epoch"), F.col("block")))
        .withColumn("block_rank", F.row_number().over(order))
        .withColumn("done", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    whole = (F.col("epoch") < F.col("epochs")) | (F.col("done") <= F.col("rest"))
    started = F.col("done") - F.col("tokens") < F.col("rest")
    read = read.where(whole | started).withColumn("whole", whole).withColumn("room", F.col("rest") - F.col("done") + F.col("tokens"))
    read = stored(read.select("source", "block", "epoch", "block_rank", "whole", "room"), "block-plan")

    cut = read.where("not whole").select(F.col("source").alias("cut_source"), F.col("block").alias("cut_block"), "epoch", "room")
    inside = counted.join(cut, counted["source"].eqNullSafe(cut["cut_source"]) & (counted["block"] == cut["cut_block"]))
    inside = inside.withColumn("place", _place(mixture, F.col("epoch"), F.col("doc_id")))
    # Rows with one id are read together, so they are summed first.
    inside = inside.groupBy("source", "epoch", "place").agg(F.sum("n_tokens").alias("tokens"), F.max("room").alias("room"))
    upto = Window.partitionBy("source", "epoch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    fits = inside.withColumn("done", F.sum("tokens").over(upto)).where("done <= room")
    last = fits.groupBy("source", "epoch").agg(F.max("place").alias("last_place"))
    last = stored(last.select(F.col("source").alias("last_source"), F.col("epoch").alias("last_epoch"), "last_place"), "cuts")
    same = read["source"].eqNullSafe(last["last_source"]) & (read["epoch"] == last["last_epoch"]) & ~read["whole"]
    joined = read.join(last, same, "left").where("whole or last_place is not null")
    return stored(joined.select("source", "block", "epoch", "block_rank", "last_place"), "block-epochs")


def _joinable(plan: DataFrame) -> DataFrame:
    """The plan has a row per source, block and epoch, whatever the number of documents, so it is sent to them.

    With so many sources that it has more than ``PLAN_ROWS`` rows, the join is left to Spark, which shuffles both.
    """
    return F.broadcast(plan) if plan.count() <= PLAN_ROWS else plan


def _keyed(docs: DataFrame, mixture: Mixture, block: str) -> DataFrame:
    turned = _hashed(F.lit(mixture.seed), F.col("doc_id"))
    return docs.withColumn(block, F.substring(turned, 1, mixture.block_digits))


def mixed(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, block, block_rank, place): one row per reading of a document.

    The mixture is read by epoch, each source's blocks by ``block_rank``, documents in a block by ``place``.
    """
    rows = docs.select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens"))
    counted = stored(_keyed(rows, mixture, "block"), "counted")
    return _readings(counted, _joinable(block_plan(counted, mixture)), mixture, "block", ["n_tokens"])


def _readings(docs: DataFrame, plan: DataFrame, mixture: Mixture, block: str, also: list[str]) -> DataFrame:
    plan = plan.withColumnsRenamed({"source": "plan_source", "block": "plan_block"})
    same = docs["source"].eqNullSafe(plan["plan_source"]) & (docs[block] == plan["plan_block"])
    place = _place(mixture, plan["epoch"], docs["doc_id"])
    met = docs.join(plan, same).where(plan["last_place"].isNull() | (place <= plan["last_place"]))
    return met.select(
        docs["doc_id"], docs["source"], *(docs[c] for c in also), plan["epoch"].cast("int").alias("epoch"),
        docs[block].alias("block"), plan["block_rank"], place.alias("place"),
    )


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """``docs`` as the mixture reads them: a document has as many rows as it is read times."""
    slim = docs.select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens"))
    plan = block_plan(stored(_keyed(slim, mixture, "block"), "counted"), mixture)
    block = free_name(docs, "mixing_block")
    keyed = _keyed(docs, mixture, block)
    plan = _joinable(plan.withColumnsRenamed({c: f"{block}_{c}" for c in plan.columns}))
    same = keyed["source"].eqNullSafe(plan[f"{block}_source"]) & (keyed[block] == plan[f"{block}_block"])
    last = plan[f"{block}_last_place"]
    place = _place(mixture, plan[f"{block}_epoch"], keyed["doc_id"])
    return keyed.join(plan, same).where(last.isNull() | (place <= last)).select(*(keyed[c] for c in docs.columns))
