"""What the optimiser makes of the operators: pushed filters, pruned columns, exchanges, no Python."""

import re

import pytest

import __spark_entry__ as entry_module
from wardflow.operators import alerts as al, features as ft, ingest, profiles as pr, risk as rk, summary as sm
from wardflow.operators import vitals as vt
from wardflow.operators.ranking import exact_median
from wardflow.sources import tables
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"
# Queries that write tables, train a model or ask for a first page when they are called.
EAGER = {n for n in entry_module.QUERIES if n.startswith(("stream_", "compacted_", "live_", "incremental_"))} | {
    "risk_ranking", "top_risk", "model_metrics", "roc_points", "model_coefficients", "daily_summary_read", "feature_auc",
    "patient_vitals_next",
}


def plan(df):
    """The physical plan before adaptive changes, one operator per line."""
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return len(re.findall(rf"(?m)[-+:* ]{operator}\b", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables as files, and joins planned as they are for tables too large to broadcast."""
    root = str(tmp_path_factory.mktemp("stored"))
    fx.vitals(spark, SF).drop("event_id").write.parquet(f"{root}/vitals")
    fx.alerts(spark, SF).write.partitionBy("day").parquet(f"{root}/alerts")
    fx.profiles(spark, SF).write.parquet(f"{root}/profiles")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield (
        tables.load_vitals(spark, f"{root}/vitals"),
        tables.load_table(spark, f"{root}/alerts", fx.alerts(spark, SF).schema),
        tables.load_profiles(spark, f"{root}/profiles"),
    )
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(set(entry_module.QUERIES) - EAGER))
def test_no_vitals_query_uses_python_or_a_cross_join(spark, name):
    text = plan(entry_module.QUERIES[name](spark, SF))
    for operator in (
        "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow",
        "FlatMapGroupsInArrow", "FlatMapGroupsInPandas", "Scan ExistingRDD",
    ):
        assert operator not in text


def test_risk_scores_shuffle_each_input_once(stored):
    vitals, alerts, profiles = stored
    text = plan(rk.risk_scores(profiles, vitals, alerts, fx.AS_OF))
    assert count(text, "Exchange hashpartitioning") == 3
    assert count(text, "BroadcastExchange") == 1  # the six metrics
    assert "LocalTableScan" in text
    assert text.count("GreaterThanOrEqual(timestamp,2024-01-02 11:30:00.0)") == 2
    assert "ReadSchema: struct<patient_id:string,timestamp:timestamp,metric_name:string,value:double>" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ >= 2024-01-02\)\]", text)


def test_ranks_are_limited_before_the_exchange(stored):
    vitals, alerts, _ = stored
    one = plan(vt.latest_readings(vitals, fx.AS_OF))
    assert count(one, "Exchange") == 1 and "row_number(), 200, Partial" in one
    split = plan(vt.newest_vitals(vitals, 20))
    assert count(split, "Exchange") == 2 and split.count("row_number(), 20, Partial") == 2
    assert "row_number(), 1, Partial" in plan(ingest.dedup_latest(vitals, "value"))
    assert "row_number(), 50, Partial" in plan(al.active_alert_counts(alerts, fx.AS_OF))


def test_reads_of_the_newest_rows_keep_a_heap_per_task(stored):
    vitals, alerts, _ = stored
    assert "TakeOrderedAndProject(limit=20" in plan(al.recent_alerts(alerts, fx.AS_OF))
    one = plan(vt.newest_vitals(vitals, 20, patient_id="P-000001"))
    assert "TakeOrderedAndProject(limit=20" in one and "EqualTo(patient_id,P-000001)" in one
    assert "Exchange" not in one


def test_one_day_reaches_the_scan(stored):
    text = plan(sm.daily_summary(stored[0], "2024-01-02"))
    assert "GreaterThanOrEqual(timestamp,2024-01-02 00:00:00.0), LessThan(timestamp,2024-01-03 00:00:00.0)" in text


def test_summary_aggregates_before_both_exchanges(stored):
    text = plan(sm.daily_summary(stored[0]))
    assert count(text, "Exchange hashpartitioning") == 2
    assert "partial_avg" in text and "partial_count(distinct patient_id" in text


def test_features_restrict_patients_after_aggregating(stored):
    vitals, _, profiles = stored
    text = plan(ft.patient_features(vitals, fx.AS_OF, profiles=profiles))
    assert text.index("LeftSemi") < text.index("partial_avg")
    assert count(text, "Exchange hashpartitioning") == 2


def test_median_gathers_only_the_bracket(stored):
    text = plan(exact_median(stored[0], "value"))
    assert "percentile_approx" in text and "median(" not in text
    # rows are grouped by value before the single-partition ranking
    assert text.index("Exchange SinglePartition") < text.index("partial_count(1)")


def test_overview_and_cards_reuse_the_ranking_s_partitioning(stored):
    vitals, _, profiles = stored
    assert count(plan(vt.metric_cards(vitals)), "Exchange hashpartitioning") == 2
    assert count(plan(vt.patient_overview(profiles, vitals)), "Exchange hashpartitioning") == 3


def test_patches_are_aggregated_before_their_exchange(spark, stored):
    profiles = stored[2]
    edits = pr.edit_patches(fx.profile_patches(spark, SF), fx.AS_OF)
    text = plan(pr.apply_patches(profiles, edits))
    assert "partial_max_by" in text and count(text, "Exchange hashpartitioning") == 2


def test_messages_are_parsed_once(spark):
    good, _ = ingest.split_bad_records(ingest.decode_vitals(fx.messages(spark, SF)))
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_a_hot_patient_s_partition_is_split_in_the_join(spark):
    settings = {
        "spark.sql.shuffle.partitions": "32",  # with few partitions a third of the rows is no outlier
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 5000) END AS patient_id", "cast(id AS double) AS value"
    )
    people = spark.range(5000).selectExpr("concat('p', id) AS patient_id").union(spark.sql("SELECT 'hot'"))
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        known = pr.known_patients(rows, people)
        assert len(known.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in plan(known)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_a_page_by_cursor_ranks_only_its_own_rows(stored):
    vitals = stored[0]
    text = plan(vt.next_pages(vitals, vt.metric_history(vitals, 5), 5))
    assert "row_number(), 5, Partial" in text and "row_number(), 10, Partial" not in text
    one = plan(vt.newest_vitals(vitals, 20, patient_id="P-000001", after=("2024-01-01 05:00:00", "spo2")))
    assert "TakeOrderedAndProject(limit=20" in one and "LessThanOrEqual(timestamp,2024-01-01 05:00:00.0)" in one


def test_the_median_s_last_step_is_bounded(stored):
    text = plan(exact_median(stored[0], "value", most=77))
    assert "LocalLimit 79" in text or "GlobalLimit 79" in text
    assert text.count("percentile_approx") >= 2
