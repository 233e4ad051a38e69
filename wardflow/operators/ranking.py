"""Newest-N per key and exact order statistics, built to survive a key that holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"
_SPLIT = "_split"
DEFAULT_SPLITS = 32


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, first: int = 1) -> DataFrame:
    """Rows ranked ``first`` .. ``n`` within each key, with the rank in ``_rank``.

    Spark limits each key to its best ``n`` rows in every map task before the exchange
    (WindowGroupLimit), so a key contributes at most n rows per map task to its reducer.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n)
    return out if first <= 1 else out.filter(F.col(_RANK) >= first)


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    first: int = 1,
    splits: int = 1,
    rank_as: str | None = None,
) -> DataFrame:
    """Rows ranked ``first`` .. ``n`` per key.

    ``splits`` > 1 is for reads without a lower time bound: every key is first ranked in ``splits``
    independent parts, so the rows of a hot key, n per map task, meet in ``splits`` reducers rather
    than one, and only n * splits of them go on to the final ranking. The part is the map
    partition's number: that keeps all rows a map task holds of a key together, so the limit before
    the exchange stays n. Any way of splitting gives the same final rows, so a retried task is safe.
    """
    if splits > 1:
        parted = df.withColumn(_SPLIT, F.pmod(F.spark_partition_id(), F.lit(splits)))
        df = ranked(parted, [*keys, _SPLIT], order, n).drop(_RANK, _SPLIT)
    out = ranked(df, keys, order, n, first)
    return out.withColumnRenamed(_RANK, rank_as) if rank_as else out.drop(_RANK)


def _narrowed(
    df: DataFrame, column: str, first: Column, last: Column, accuracy: int, rounds: int, most: int
) -> DataFrame:
    """The values around the ranks ``first`` to ``last`` with exact counts: (x, rows, n, upto).

    ``first`` and ``last`` are written on ``n``, the number of values. Each round counts the values below the bracket
    so far and sketches those in it at equal steps, so the ranks lie within a step and a margin of one step on
    either side, ten times the sketch's error: a bracket keeps some three steps of what it was. Values below the last
    bracket are only counted (x is null); those inside are collapsed to (value, count) before one task ranks them.
    At most ``most`` + 1 distinct ones are sent there, and more than ``most`` is an error (see :func:`_checked`).
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    steps = max(2, accuracy // 10)
    # As one expression: a literal per share would take longer to build than the query to run.
    shares = ", ".join(f"{i / steps}D" for i in range(steps + 1))
    # NaN is above all.
    bracket = F.struct(F.lit(float("-inf")).alias("low"), F.lit(float("nan")).alias("high"))
    for _ in range(rounds):
        inside = (F.col("x") >= F.col("b.low")) & (F.col("x") <= F.col("b.high"))
        met = values.select("x", bracket.alias("b")).withColumn("kept", F.when(inside, F.col("x")))
        met = met.agg(
            F.count("*").alias("n"),
            F.max("b").alias("b"),
            F.count_if(F.col("x") < F.col("b.low")).alias("below"),
            F.count_if(inside).alias("held"),
            F.expr(f"percentile_approx(kept, array({shares}), {accuracy})").alias("q"),
        )
        step = lambda rank: F.try_divide((rank - F.col("below")) * steps, F.col("held"))
        low = (F.floor(step(first)) - 1).cast("int")
        high = (F.ceil(step(last)) + 1).cast("int")
        bracket = met.select(
            F.struct(
                F.when(low >= 0, F.get("q", low)).otherwise(F.col("b.low")).alias("low"),
                F.when(high <= steps, F.get("q", high)).otherwise(F.col("b.high")).alias("high"),
                "n",
            )
        ).scalar()
    kept = values.select("x", bracket.alias("b")).filter(F.col("x") <= F.col("b.high"))
    counted = kept.groupBy(F.when(F.col("x") >= F.col("b.low"), F.col("x")).alias("x")).agg(
        F.count("*").alias("rows"), F.max("b.n").alias("n")
    )
    upto = F.sum("rows").over(Window.orderBy(F.col("x").asc_nulls_first()))
    return counted.limit(most + 2).select("x", "rows", "n", upto.alias("upto"))


def _value_at(rank: Column) -> Column:
    here = (F.col("upto") >= rank) & (F.col("upto") - F.col("rows") < rank)
    return F.max(F.when(here, F.col("x")))


def _checked(value: Column, wanted: Column, most: int) -> Column:
    """``value``, or an error if the bracket kept too much or no value where one is ``wanted``."""
    crowded = F.raise_error(F.lit(f"more than {most} distinct values are left around the rank: allow more rounds"))
    lost = F.raise_error(F.lit("no value holds the rank"))
    return F.when(F.count("x") > most, crowded).when(wanted & value.isNull(), lost).otherwise(value)


def exact_median(
    df: DataFrame, column: str, accuracy: int = 10_000, *, rounds: int = 2, most: int = 10_000
) -> DataFrame:
    """The exact median of a numeric column as one row, without gathering the column in one task.

    Two rounds take some 10 ** 9 distinct values to ``most``, a third three hundred times as many; more are an error, and
    ask for another round. Equal values are counted as one, so however many there are they take none.
    """
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
    middle = (_value_at(lower) + _value_at(upper)) / 2.0
    around = _narrowed(df, column, lower, upper, accuracy, rounds, most)
    return around.agg(_checked(middle, F.max("n") > 0, most).alias("median"))


def exact_cut(
    df: DataFrame, column: str, share: float, accuracy: int = 10_000, *, rounds: int = 2, most: int = 10_000
) -> DataFrame:
    """The largest of the floor(share * n) smallest values as one row; null when that is none."""
    rank = F.floor(F.col("n") * share + 1e-9)
    around = _narrowed(df, column, rank, rank, accuracy, rounds, most)
    return around.agg(_checked(_value_at(rank), F.floor(F.max("n") * share + 1e-9) > 0, most).alias("cut"))
