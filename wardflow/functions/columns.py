"""Column expressions. All are JVM built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, functions as F

from wardflow.functions import constants as c


def clamp(value, low: int, high: int) -> int:
    """Bring a size argument into its allowed span; text such as ``"20"`` is accepted."""
    return max(low, min(int(value), high))


def instant(moment: datetime | str) -> Column:
    """A point in time given by the caller as a literal; text and naive values mean UTC."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            return F.lit(moment)
        moment = moment.isoformat(sep=" ")
    return F.to_timestamp(F.lit(moment))


def event_time(text: Column) -> Column:
    """Parse an event time; text that is no time gives null instead of failing the job."""
    return F.try_to_timestamp(text)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, c.TIME_TEXT)


def alert_type(metric: Column, value: Column, rules: Sequence[c.AlertRule] = c.ALERT_RULES) -> Column:
    """The first rule that matches, else null."""
    if not rules:
        return F.lit(None).cast("string")
    case = F
    for rule in rules:
        limit = F.lit(rule.threshold)
        beyond = value > limit if rule.comparator == ">" else value < limit
        case = case.when((metric == rule.metric) & beyond, rule.alert_type)
    return case


def alert_id(patient: Column, metric: Column, ts: Column, kind: Column) -> Column:
    """An id that depends on the reading only, so a replayed batch yields the same alerts."""
    return F.sha2(F.concat_ws("|", patient, metric, time_text(ts), kind), 256)


def is_active(status: Column) -> Column:
    return F.upper(F.coalesce(status, F.lit(""))) == c.ACTIVE


def metric_risk(value: Column, min_ok: Column, max_ok: Column) -> Column:
    """0 at mid-range, 0.2 at the ends of the range, 1 from half a range width beyond them."""
    one = F.lit(1.0)
    half = F.greatest(F.lit(c.SMALLEST_HALF_RANGE), (max_ok - min_ok) / 2.0)
    within = F.least(one, F.abs(value - (min_ok + max_ok) / 2.0) / half)
    beyond = F.when(value < min_ok, min_ok - value).otherwise(value - max_ok) / half
    return F.when(value.isNull(), F.lit(None).cast("double")).when(
        value.between(min_ok, max_ok), c.IN_RANGE_SHARE * within
    ).otherwise(F.least(one, c.IN_RANGE_SHARE + c.OUT_OF_RANGE_SHARE * F.least(one, beyond)))


def range_status(value: Column, min_ok: Column, max_ok: Column) -> Column:
    """low / high / normal; a metric without a range is normal, a null value has no status."""
    return F.when(value.isNotNull(), F.when(value < min_ok, "low").when(value > max_ok, "high").otherwise("normal"))


def plain_number(value: Column) -> Column:
    """60.0 as ``60``, 36.5 as ``36.5``."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def range_text(min_ok: Column, max_ok: Column) -> Column:
    low, high = plain_number(min_ok), plain_number(max_ok)
    return (
        F.when(min_ok.isNotNull() & max_ok.isNotNull(), F.concat(low, F.lit(" - "), high))
        .when(min_ok.isNotNull(), F.concat(F.lit("≥ "), low))
        .when(max_ok.isNotNull(), F.concat(F.lit("≤ "), high))
        .otherwise(c.RANGE_NOT_SET)
    )


def metric_label(metric: Column) -> Column:
    """``bp_systolic`` as ``Bp Systolic``: only the first letter of each word changes."""
    words = F.split(F.replace(metric, F.lit("_"), F.lit(" ")), " ")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " "
    )


def strip_text(text: Column) -> Column:
    """A form field as it is stored: null is empty, white space around it is dropped."""
    blank = r"[\s\x1c-\x1f]"
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U)^{blank}+|{blank}+$", "")


def two_decimals(x: Column) -> Column:
    """``%.2f`` of a double, rounded on its exact binary value with ties to even; null is empty.

    Rounding the shortest decimal text instead (as the JVM formatter does) turns 2.675, which is
    stored slightly below that, into 2.68. The product with 100 is therefore split into its rounded
    value and its rounding error, and the error decides apparent ties.
    """
    spread = x * 134217729.0  # 2^27 + 1 splits a double into two halves of 26 bits
    upper = spread - (spread - x)
    scaled = x * 100.0
    error = (upper * 100.0 - scaled) + (x - upper) * 100.0
    tie = F.abs(scaled - F.floor(scaled)) == 0.5
    cents = (
        F.when(tie & (error > 0), F.ceil(scaled))
        .when(tie & (error < 0), F.floor(scaled))
        .otherwise(F.rint(scaled))
    )
    return F.when(x.isNull(), "").otherwise(F.format_string("%.2f", cents / 100.0))
