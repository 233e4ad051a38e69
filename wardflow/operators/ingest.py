"""From message envelopes to clean, unique vitals rows. Batch and streaming share these."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions import columns as col
from wardflow.operators.ranking import top_n
from wardflow.schemas import MESSAGE, VITALS_KEY


def decode_vitals(envelopes: DataFrame, *, keep: Sequence[str] = (), raw_as: str | None = None) -> DataFrame:
    """Decode the JSON in ``value`` against the declared message schema.

    A message that is no JSON gives a row of nulls, a bad timestamp gives a null timestamp; neither
    fails the job. ``keep`` passes envelope columns through (an offset, say); ``raw_as`` adds the
    message text, for the quarantine.
    """
    text = F.col("value").cast("string")
    rejects = [text.alias(raw_as)] if raw_as else []
    # inline rather than data.*: filters on decoded columns stay above a generator, whereas pushed
    # below a projection each of them would parse the message again.
    parsed = F.inline(F.array(F.from_json(text, MESSAGE)))
    return envelopes.select(*keep, *rejects, parsed).withColumn("timestamp", col.event_time(F.col("timestamp")))


def has_key() -> Column:
    """True when the three columns of the storage key are set. A null value is legal."""
    parts = [F.col(k).isNotNull() for k in VITALS_KEY]
    return parts[0] & parts[1] & parts[2]


def split_bad_records(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored, and rows for the quarantine."""
    return decoded.filter(has_key()), decoded.filter(~has_key())


def dedup_latest(
    vitals: DataFrame, arrival: str | Sequence[str], keys: Sequence[str] = VITALS_KEY
) -> DataFrame:
    """Keep the last arrival per key, as the upserts of the storage would.

    Equal arrivals are settled on the remaining columns, so the result does not depend on row order.
    """
    arrivals = [arrival] if isinstance(arrival, str) else list(arrival)
    rest = [k for k in vitals.columns if k not in keys and k not in arrivals]
    order = [F.col(a).desc() for a in arrivals] + [F.col(r).desc_nulls_last() for r in rest]
    return top_n(vitals, list(keys), order, 1)


def current_rows(raw: DataFrame, keys: Sequence[str] = VITALS_KEY) -> DataFrame:
    """One row per key of a table that the stream appends to: the last batch, and in it the last arrival.

    ``arrival`` is the key of :func:`wardflow.sources.stream.arrival_key` or any value that compares like it.

    A table without batches holds one row per key already. Filter by time first; what is filtered on is part of
    the key, so the result is the same and fewer rows are compared.
    """
    arrivals = [a for a in ("batch_id", "arrival") if a in raw.columns]
    return dedup_latest(raw, arrivals, keys).drop(*arrivals) if arrivals else raw


def dedup_stream(vitals: DataFrame, delay: str, keys: Sequence[str] = VITALS_KEY) -> DataFrame:
    """Keep the first arrival per key on a stream, holding state for ``delay`` of event time.

    Rows later than the watermark are dropped, which is why this is opt-in. Corrections of a reading
    need :func:`dedup_latest` on the stored table instead.
    """
    return vitals.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_messages(decoded: DataFrame, delay: str, keys: Sequence[str] = VITALS_KEY) -> DataFrame:
    """:func:`dedup_stream` for readings and rejects together, in one pass over the source.

    A message without a key cannot be a copy of anything, so it takes part under a number of its own. Its event time
    is set to null: that is never late, moves no watermark, and its state goes with the next one.
    """
    alone = F.when(~has_key(), F.uuid()).alias("_alone")
    timed = F.when(has_key(), F.col("timestamp")).alias("_event_time")
    marked = decoded.select("*", alone, timed).withWatermark("_event_time", delay)
    return marked.dropDuplicatesWithinWatermark([*keys, "_alone"]).drop("_alone", "_event_time")
