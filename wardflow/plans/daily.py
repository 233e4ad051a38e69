"""The daily batch job."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow import schemas
from wardflow.operators.ingest import current_rows
from wardflow.operators.summary import daily_summary, merged_state, summary_of_state, summary_state
from wardflow.operators.vitals import for_day
from wardflow.sources import log, tables


def run_daily_summary(
    spark: SparkSession, source: str, target: str, stat_date: date | str, fmt: str = "parquet"
) -> bool:
    """Summarise one day into ``target``; False, and nothing written, when the day has no vitals."""
    vitals = for_day(tables.load_vitals(spark, source, fmt), stat_date)
    if vitals.isEmpty():
        return False
    vitals = current_rows(vitals)  # a reading that was sent again counts once
    tables.write_daily_summary(daily_summary(vitals, stat_date), target)
    return True


def run_incremental_summary(spark: SparkSession, vitals: str, state: str) -> int:
    """Bring the summary state up to date with the stream's new batches; the number of days they touched.

    ``vitals`` is the table that the stream appends to. Only folders with batches that the state does not hold yet are
    read, and only the days in them, late ones too, are written again. State and last batch change in one commit, so a
    job that dies is repeated without counting twice. A stream with another checkpoint starts the state anew.

    A sum does not tell what it holds: a reading that comes again in a later batch counts again. Let the stream drop
    such readings (``dedup_delay``), or use :func:`run_daily_summary` on days that get corrections.
    """
    source, held = log.state(spark, vitals), log.state(spark, state)
    if held.version == 0 or held.stream != source.stream:
        held = replace(held, parts=(), stream=source.stream, batch=-1)
    if source.batch <= held.batch:
        return 0
    parts = tuple(part for part in source.parts if part.last > held.batch)
    new = log.load_parts(spark, vitals, schemas.RAW_VITALS, parts).filter(F.col("batch_id") > held.batch)
    delta = summary_state(current_rows(new))
    # One name per day that the batches touched.
    days = {f"day={r['day']}" for r in delta.select("day").distinct().collect()}
    day_of = lambda part: part.folder.split("/")[1]
    old = tuple(part for part in held.parts if day_of(part) in days)
    merged = merged_state(delta, log.load_parts(spark, state, schemas.SUMMARY_STATE, old))
    folder = log.write_folder(merged.hint("rebalance", "day"), state, "day") if days else None
    written = tuple(log.Part(f"{folder}/{day}") for day in sorted(days))
    rest = tuple(part for part in held.parts if part not in old)
    log.commit(spark, state, replace(held, parts=rest + written, batch=source.batch))
    return len(days)


def load_incremental_summary(spark: SparkSession, state: str) -> DataFrame:
    """The daily summary of all batches that the state holds."""
    return summary_of_state(tables.load_table(spark, state, schemas.SUMMARY_STATE))
