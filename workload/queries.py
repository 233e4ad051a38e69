"""One query per operator, over the whole tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow import schemas
from wardflow.functions import columns as col
from wardflow.operators import alerts as al, features as ft, ingest, model as ml, profiles as pr
from wardflow.operators import risk as rk, summary as sm, vitals as vt
from wardflow.operators.ranking import exact_median
from wardflow.plans.daily import load_incremental_summary, run_incremental_summary
from wardflow.plans.risk_model import RiskModel, fit_risk_model, labelled_features
from wardflow.plans.risk_refresh import refreshed_profiles
from wardflow.session import new_work_dir
from wardflow.sources import tables
from wardflow.sources.stream import ARRIVAL
from wardflow.streaming.ingest import RAW, compact_batches, compact_vitals, start_vitals_stream, write_micro_batch
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Wider than the live feed's defaults, so that every limit binds on the sparse fixture.
WIDE = {"minutes": 240, "cap": 40, "alert_minutes": 1440, "alert_cap": 2}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame, *places: str, digits: int = 6) -> DataFrame:
    """Times as text and the named doubles rounded, so two engines can be compared."""
    out = df
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp":
            out = out.withColumn(field.name, col.time_text(F.col(field.name)))
        elif field.name in places:
            out = out.withColumn(field.name, F.round(field.name, digits))
    return out


def flat(profiles: DataFrame) -> DataFrame:
    return profiles.withColumns(
        {"email": F.col("contact_info.email"), "phone": F.col("contact_info.phone")}
    ).drop("contact_info")


# Messages to rows


@query
def decode_roundtrip(spark, sf):
    good, _ = ingest.split_bad_records(ingest.decode_vitals(fx.messages(spark, sf), keep=("event_id",)))
    return shown(vt.format_vitals(good, keep=("event_id", "patient_id")), "value")


@query
def quarantined_messages(spark, sf):
    decoded = ingest.decode_vitals(fx.messages(spark, sf), keep=("event_id",))
    _, bad = ingest.split_bad_records(decoded)
    return shown(bad, "value")


@query
def dedup_latest(spark, sf):
    return shown(ingest.dedup_latest(fx.vitals_resent(spark, sf), "event_id"), "value")


# Alerts


def _found(spark, sf):
    return al.classify_alerts(fx.vitals(spark, sf))


@query
def alerts_base(spark, sf):
    return shown(al.alerts_base(_found(spark, sf)), "observed_value")


@query
def alerts_by_day(spark, sf):
    return shown(al.alerts_by_day(_found(spark, sf)), "observed_value")


@query
def alerts_by_patient(spark, sf):
    return shown(al.alerts_by_patient(_found(spark, sf)), "observed_value")


@query
def active_alerts(spark, sf):
    return shown(al.format_alerts(al.active_alerts(fx.alerts(spark, sf))), "observed_value")


@query
def recent_alerts(spark, sf):
    rows = al.recent_alerts(fx.alerts(spark, sf), fx.AS_OF, limit=20, since_minutes=1440, scan_limit=24)
    return shown(rows, "observed_value")


@query
def recent_alerts_limited(spark, sf):
    rows = al.recent_alerts(fx.alerts(spark, sf), fx.AS_OF, limit=5, since_minutes=1440)
    return shown(rows, "observed_value")


@query
def recent_alerts_unbounded(spark, sf):
    rows = al.recent_alerts(
        fx.alerts(spark, sf), fx.AS_OF, limit=200, since_minutes=1440, scan_limit=2000, day_bounded=False
    )
    return shown(rows, "observed_value")


@query
def patient_alerts(spark, sf):
    rows = al.patient_alerts(fx.alerts(spark, sf), fx.AS_OF, limit=2, since_minutes=1440)
    return shown(rows, "observed_value")


@query
def patient_alerts_active(spark, sf):
    rows = al.patient_alerts(fx.alerts(spark, sf), fx.AS_OF, limit=2, since_minutes=1440, active_only=True)
    return shown(rows, "observed_value")


@query
def active_alert_counts(spark, sf):
    return al.active_alert_counts(fx.alerts(spark, sf), fx.AS_OF, minutes=1440)


@query
def active_alert_counts_capped(spark, sf):
    return al.active_alert_counts(fx.alerts(spark, sf), fx.AS_OF, minutes=1440, cap=2)


# Daily summary

MEASURES = ("avg_value", "min_value", "max_value")


@query
def daily_summary(spark, sf):
    return shown(sm.daily_summary(fx.vitals(spark, sf)), *MEASURES)


@query
def daily_summary_one_day(spark, sf):
    return shown(sm.daily_summary(fx.vitals(spark, sf), fx.DAY), *MEASURES)


@query
def daily_summary_read(spark, sf):
    """Stored by day, one day run twice, then one day read back."""
    path = new_work_dir(spark, "summary")
    rows = fx.vitals(spark, sf)
    tables.write_daily_summary(sm.daily_summary(rows), path)
    tables.write_daily_summary(sm.daily_summary(rows, fx.DAY), path)
    return shown(sm.read_daily_summary(tables.load_daily_summary(spark, path), fx.DAY), *MEASURES)


@query
def daily_summary_display(spark, sf):
    return sm.format_daily_summary(sm.daily_summary(fx.vitals(spark, sf)))


# Vitals reads


@query
def vitals_of_day(spark, sf):
    return shown(vt.format_vitals(vt.for_day(fx.vitals(spark, sf), fx.DAY)), "value")


@query
def vitals_in_lookback(spark, sf):
    return shown(vt.format_vitals(vt.since(fx.vitals(spark, sf), fx.AS_OF, 30)), "value")


@query
def newest_vitals(spark, sf):
    return shown(vt.format_vitals(vt.newest_vitals(fx.vitals(spark, sf), 20)), "value")


ONE_PATIENT = "P-000007"


@query
def patient_vitals_one(spark, sf):
    return shown(vt.format_vitals(vt.newest_vitals(fx.vitals(spark, sf), 30, patient_id=ONE_PATIENT)), "value")


@query
def metric_history_one(spark, sf):
    one = {"patient_id": ONE_PATIENT, "metric_name": "spo2"}
    return shown(vt.format_vitals(vt.metric_history(fx.vitals(spark, sf), 4, offset=2, **one)), "value")


@query
def profile_one(spark, sf):
    return shown(flat(pr.profile_of(fx.profiles(spark, sf), ONE_PATIENT)), "risk_score", digits=9)


@query
def metric_history(spark, sf):
    return shown(vt.format_vitals(vt.metric_history(fx.vitals(spark, sf), 5)), "value")


@query
def metric_history_page2(spark, sf):
    return shown(vt.format_vitals(vt.metric_history(fx.vitals(spark, sf), 5, offset=5)), "value")


@query
def metric_history_next(spark, sf):
    """The second page again, by cursors rather than by an offset."""
    vitals = fx.vitals(spark, sf)
    return shown(vt.format_vitals(vt.next_pages(vitals, vt.metric_history(vitals, 5), 5)), "value")


@query
def patient_vitals_next(spark, sf):
    """One patient's second page, after the last reading of the first."""
    vitals = fx.vitals(spark, sf)
    last = vt.newest_vitals(vitals, 10, patient_id=ONE_PATIENT).collect()[-1:]
    after = (last[0]["timestamp"], last[0]["metric_name"]) if last else None
    return shown(vt.format_vitals(vt.newest_vitals(vitals, 10, patient_id=ONE_PATIENT, after=after)), "value")


@query
def latest_readings(spark, sf):
    return shown(vt.latest_readings(fx.vitals(spark, sf), fx.AS_OF, minutes=240, cap=40), "value")


@query
def range_status(spark, sf):
    return shown(vt.with_range_status(fx.vitals(spark, sf)), "value")


@query
def metric_cards(spark, sf):
    return shown(vt.metric_cards(fx.vitals(spark, sf).drop("event_id"), cap=40), "value")


@query
def patient_overview(spark, sf):
    pages = vt.patient_overview(fx.profiles(spark, sf), fx.vitals(spark, sf), cap=40)
    cards = pages.select("patient_id", "name", F.explode_outer("cards").alias("card")).select("patient_id", "name", "card.*")
    # As text: the position is null for a patient without readings.
    return shown(cards.withColumn("position", F.col("position").cast("string")), "value")


@query
def patient_overview_one(spark, sf):
    page = vt.patient_overview(fx.profiles(spark, sf), fx.vitals(spark, sf), cap=40, patient_id=ONE_PATIENT)
    cards = page.select("patient_id", "name", F.explode_outer("cards").alias("card")).select("patient_id", "name", "card.*")
    return shown(cards.withColumn("position", F.col("position").cast("string")), "value")


@query
def known_patient_vitals(spark, sf):
    return shown(vt.format_vitals(pr.known_patients(fx.vitals(spark, sf), fx.profiles(spark, sf))), "value")


# Risk


@query
def metric_risk(spark, sf):
    rows = rk.with_metric_risk(fx.vitals(spark, sf))
    return shown(rows.select("event_id", "patient_id", "metric_name", "value", "weight", "risk"), "value", "risk")


def _scores(spark, sf, **sizes):
    return rk.risk_scores(fx.profiles(spark, sf), fx.vitals(spark, sf), fx.alerts(spark, sf), fx.AS_OF, **sizes)


@query
def risk_scores(spark, sf):
    return shown(_scores(spark, sf), "metric_score", "risk_score", digits=9)


@query
def risk_scores_wide(spark, sf):
    return shown(_scores(spark, sf, **WIDE), "metric_score", "risk_score", digits=9)


@query
def changed_risk(spark, sf):
    changed = rk.changed_risk(_scores(spark, sf, **WIDE), fx.profiles(spark, sf))
    return shown(changed, "risk_score", "previous_score", digits=9)


@query
def changed_risk_count(spark, sf):
    return rk.update_count(rk.changed_risk(_scores(spark, sf, **WIDE), fx.profiles(spark, sf)))


def _refreshed(spark, sf):
    return refreshed_profiles(
        fx.profiles(spark, sf), fx.vitals(spark, sf), fx.alerts(spark, sf), fx.AS_OF, **WIDE
    )


@query
def refreshed_risk_profiles(spark, sf):
    return shown(flat(_refreshed(spark, sf)), "risk_score", digits=9)


@query
def risk_list(spark, sf):
    return shown(rk.risk_list(_refreshed(spark, sf)), "risk_score", digits=9)


@query
def ward_ranking(spark, sf):
    return shown(rk.ward_ranking(fx.profiles(spark, sf)), "risk_score", digits=9)


@query
def risk_bands(spark, sf):
    # Rounded first: a percentage would turn a difference in the last bit into a whole point.
    scored = _scores(spark, sf, **WIDE).select("patient_id", F.round("risk_score", 9).alias("risk_score"))
    return rk.with_risk_band(scored)


# Profiles


@query
def profile_list(spark, sf):
    return shown(flat(pr.profile_list(fx.profiles(spark, sf))), "risk_score", digits=9)


@query
def patched_profiles(spark, sf):
    edits = pr.edit_patches(fx.profile_patches(spark, sf), fx.AS_OF)
    return shown(flat(pr.apply_patches(fx.profiles(spark, sf), edits)), "risk_score", digits=9)


# Streams: the same operators on a streaming frame, run until the input is used up


def _ingested(spark, sf, resend: bool = False, **options) -> str:
    root = new_work_dir(spark, "ingest")
    events = fx.event_stream(spark, sf)
    if resend:
        events = events.unionByName(events.filter(F.col("event_id") % 50 == 0))
    query_ = start_vitals_stream(fx.messages_of(events), root, trigger={"availableNow": True}, **options)
    query_.awaitTermination()
    return root


@query
def stream_vitals(spark, sf):
    stored = tables.load_vitals(spark, f"{_ingested(spark, sf)}/{tables.VITALS}")
    return shown(vt.format_vitals(stored), "value")


@query
def stream_alerts(spark, sf):
    stored = tables.load_alerts_by_day(spark, _ingested(spark, sf)).select(*schemas.HEALTH_ALERTS_BY_DAY.names)
    return shown(stored, "observed_value")


@query
def stream_alerts_base(spark, sf):
    stored = tables.load_alerts(spark, _ingested(spark, sf))
    return shown(stored.select(*schemas.HEALTH_ALERTS.names), "observed_value")


@query
def stream_alerts_by_patient(spark, sf):
    stored = tables.load_alerts_by_patient(spark, _ingested(spark, sf))
    return shown(stored.select(*schemas.HEALTH_ALERTS_BY_PATIENT.names), "observed_value")


@query
def stream_quarantine(spark, sf):
    rejects = tables.load_quarantine(spark, _ingested(spark, sf))
    # The text of a number differs between engines, so whole messages are compared by their fields.
    fields = F.from_json(RAW, schemas.MESSAGE)
    whole = F.endswith(RAW, F.lit("}"))
    named = [F.when(whole, fields[name]).alias(name) for name in schemas.MESSAGE.names]
    return shown(rejects.select(F.when(~whole, F.col(RAW)).alias("cut_text"), *named), "value")


@query
def stream_dedup(spark, sf):
    """Readings sent twice; the stream keeps one of each and the rejects pass beside the state."""
    root = _ingested(spark, sf, resend=True, dedup_delay="2 days")
    return shown(vt.format_vitals(tables.load_vitals(spark, f"{root}/{tables.VITALS}")), "value")


@query
def compacted_vitals(spark, sf):
    """Readings sent twice, stored twice, folded to one row each."""
    root = _ingested(spark, sf, resend=True)
    compact_vitals(spark, root)
    return shown(vt.format_vitals(tables.load_vitals(spark, f"{root}/{tables.VITALS_CLEAN}")), "value")


def _corrected(spark, sf) -> str:
    """Every 50th reading is sent again in the same batch, later and with a smaller value."""
    root = new_work_dir(spark, "corrected")
    events = fx.event_stream(spark, sf)
    again = events.filter(F.col("event_id") % 50 == 0).withColumn("value", F.col("value") - 100.0)
    # Later by its time, though Spark reads it first.
    again = again.withColumn(ARRIVAL, F.col(ARRIVAL).withField("sent_at", F.expr(f"{ARRIVAL}.sent_at + interval 1 second")))
    messages = fx.messages_of(again.unionByName(events))
    start_vitals_stream(messages, root, trigger={"availableNow": True}).awaitTermination()
    return root


@query
def compacted_vitals_corrected(spark, sf):
    root = _corrected(spark, sf)
    compact_vitals(spark, root)
    return shown(vt.format_vitals(tables.load_vitals(spark, f"{root}/{tables.VITALS_CLEAN}")), "value")


@query
def compacted_batches(spark, sf):
    """Readings stored in two batches, half of them a second time, then folded into one folder a table."""
    root = new_work_dir(spark, "batches")
    decoded = ingest.decode_vitals(fx.messages(spark, sf), keep=("event_id",), raw_as=RAW)
    for batch in range(3):
        write_micro_batch(decoded.filter(F.col("event_id") % 2 == batch % 2), batch, root)
    compact_batches(spark, root, fan=3)
    alerts = tables.load_alerts_by_patient(spark, root).select(*schemas.HEALTH_ALERTS_BY_PATIENT.names)
    return shown(alerts, "observed_value")


@query
def live_daily_summary(spark, sf):
    """Summary of the table the stream appends to, where corrected readings stand twice."""
    raw = tables.load_vitals(spark, f"{_corrected(spark, sf)}/{tables.VITALS}")
    return shown(sm.daily_summary(ingest.current_rows(raw)), *MEASURES)


@query
def incremental_daily_summary(spark, sf):
    """Three batches that all bring late readings for both days, each merged into the state as it comes."""
    root = new_work_dir(spark, "incremental")
    decoded = ingest.decode_vitals(fx.messages(spark, sf), keep=("event_id",), raw_as=RAW)
    for batch in range(3):
        write_micro_batch(decoded.filter(F.col("event_id") % 3 == batch), batch, root)
        run_incremental_summary(spark, f"{root}/{tables.VITALS}", f"{root}/summary_state")
    return shown(load_incremental_summary(spark, f"{root}/summary_state"), *MEASURES)


# Features and the risk model


def _features(spark, sf):
    return ft.patient_features(fx.vitals(spark, sf), fx.AS_OF, profiles=fx.profiles(spark, sf))


@query
def patient_features(spark, sf):
    return shown(_features(spark, sf), *ml.FEATURES, digits=8)


@query
def high_risk_labels(spark, sf):
    labelled = ft.label_high_risk(_features(spark, sf)).select("patient_id", "heart_rate", ft.LABEL)
    return shown(labelled, "heart_rate", digits=8)


@query
def patient_features_72h(spark, sf):
    found = ft.patient_features(fx.vitals(spark, sf), fx.AS_OF, profiles=fx.profiles(spark, sf), hours=72)
    return shown(found, *ml.FEATURES, digits=10)


@query
def high_risk_labels_fallback(spark, sf):
    """No heart rates were sent, so the first other metric decides."""
    sent = fx.vitals(spark, sf).filter("metric_name <> 'heart_rate'")
    features = ft.patient_features(sent, fx.AS_OF, profiles=fx.profiles(spark, sf))
    return shown(ft.label_high_risk(features).select("patient_id", "bp_diastolic", ft.LABEL), "bp_diastolic", digits=8)


@query
def roc_points_of_feature(spark, sf):
    labelled = ft.label_high_risk(_features(spark, sf))
    return shown(ml.roc_curve(labelled, "spo2"), "threshold", "fpr", "tpr", digits=8)


@query
def median_of_readings(spark, sf):
    """A coarse sketch and a small last step, so that the bracket is narrowed more than once."""
    return shown(exact_median(fx.vitals(spark, sf), "value", accuracy=400, rounds=3, most=500), "median", digits=8)


@query
def label_distribution(spark, sf):
    return ft.label_distribution(ft.label_high_risk(_features(spark, sf)))


@query
def load_counts(spark, sf):
    return ft.load_counts(fx.vitals(spark, sf), fx.alerts(spark, sf), fx.profiles(spark, sf), fx.AS_OF)


@query
def train_test_split(spark, sf):
    train, test = ft.split(_features(spark, sf).select("patient_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def feature_auc(spark, sf):
    """The model's AUC evaluation on scores that SQL can compute too: two features as they are."""
    labelled = labelled_features(fx.vitals(spark, sf), fx.profiles(spark, sf), fx.AS_OF)
    rows = [(name, ml.roc_auc(labelled, name)) for name in ("heart_rate", "bp_systolic")]
    return shown(spark.createDataFrame(rows, "feature string, auc double"), "auc")


@query
def train_test_split_exact(spark, sf):
    train, test = ft.split(_features(spark, sf).select("patient_id"), exact=True)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _model(spark, sf) -> RiskModel:
    return fit_risk_model(fx.vitals(spark, sf), fx.profiles(spark, sf), fx.AS_OF)


@query
def risk_ranking(spark, sf):
    return shown(_model(spark, sf).ranking(), "predicted_risk")


@query
def top_risk(spark, sf):
    return shown(ml.top_risk(_model(spark, sf).ranking(), 10), "predicted_risk")


@query
def model_metrics(spark, sf):
    return shown(_model(spark, sf).metrics(), "auc", "train_accuracy", "test_accuracy")


@query
def roc_points(spark, sf):
    return shown(_model(spark, sf).roc(digits=9), "fpr", "tpr", digits=8)


@query
def model_coefficients(spark, sf):
    return shown(_model(spark, sf).coefficients(), "coefficient")
