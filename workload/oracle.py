"""ANSI SQL for the registered queries, for DuckDB on the same parquet tables.

Each statement inlines the derived tables it needs. Doubles are rounded to six places (means of few
readings to eight, risk scores to nine, where six would give ties) and times are text, as in the
queries. The fitted model's queries repeat its optimum by Newton's method.
"""

VITALS = """vitals AS (
  SELECT event_id,
    'P-' || lpad(CAST(user_id + CASE event_id % 101 WHEN 100 THEN 900000 ELSE 0 END AS varchar), 6, '0') AS patient_id,
    TIMESTAMP '2024-01-01 00:00:00'
      + to_seconds(CAST(floor((floor(epoch(ts)) - 1704067200) / 20) AS bigint)) AS t,
    CASE event_id % 6 WHEN 0 THEN 'heart_rate' WHEN 1 THEN 'bp_systolic' WHEN 2 THEN 'bp_diastolic'
      WHEN 3 THEN 'spo2' WHEN 4 THEN 'temperature' ELSE 'respiratory_rate' END AS metric_name,
    CASE event_id % 6 WHEN 0 THEN 60.0::DOUBLE + 40.0::DOUBLE * k WHEN 1 THEN 110.0::DOUBLE + 20.0::DOUBLE * k
      WHEN 2 THEN 70.0::DOUBLE + 15.0::DOUBLE * k WHEN 3 THEN 100.0::DOUBLE - 5.0::DOUBLE * k
      WHEN 4 THEN 36.5::DOUBLE + 1.5::DOUBLE * k ELSE 12.0::DOUBLE + 6.0::DOUBLE * k END AS value,
    CASE event_id % 6 WHEN 1 THEN 'mmHg' WHEN 2 THEN 'mmHg' WHEN 3 THEN '%' WHEN 4 THEN 'C' ELSE 'bpm' END AS unit
  FROM (SELECT *, value / 100.0::DOUBLE - 0.1::DOUBLE AS k FROM events) e
)"""

CLASSIFIED = """classified AS (
  SELECT *, CAST(t AS date) AS day,
    sha256(concat_ws('|', patient_id, metric_name, strftime(t, '%Y-%m-%d %H:%M:%S'), alert_type)) AS alert_id
  FROM (SELECT *, CASE WHEN metric_name = 'heart_rate' AND value > 120 THEN 'TACHYCARDIA'
                       WHEN metric_name = 'spo2' AND value < 92 THEN 'HYPOXIA'
                       WHEN metric_name = 'temperature' AND value > 39 THEN 'FEVER' END AS alert_type
        FROM vitals) c
  WHERE alert_type IS NOT NULL
)"""

ALERTS = """alerts AS (
  SELECT alert_id, patient_id, metric_name, value AS observed_value, alert_type, t, day,
    CASE (event_id // 6) % 10 WHEN 0 THEN 'RESOLVED' WHEN 1 THEN 'active' WHEN 2 THEN NULL ELSE 'ACTIVE' END AS status
  FROM classified
)"""

PROFILES = """profiles AS (
  SELECT c_custkey AS k, 'P-' || lpad(CAST(c_custkey AS varchar), 6, '0') AS patient_id, c_name AS name,
    'c' || CAST(c_custkey AS varchar) || '@example.com' AS email, lpad(CAST(c_custkey AS varchar), 10, '0') AS phone,
    'segment ' || c_mktsegment AS medical_notes,
    CASE WHEN c_custkey % 11 = 10 THEN NULL ELSE (c_custkey % 11) / 10.0::DOUBLE END AS risk_score,
    '2024-01-01 00:00:00' AS last_updated,
    CAST(NULL AS varchar) AS risk_score_updated_at, CAST(NULL AS varchar) AS risk_score_source
  FROM customer
)"""

REFERENCE = """reference(metric_name, min_ok, max_ok, weight, description, range_text, metric_label) AS (
  VALUES ('heart_rate', 60.0::DOUBLE, 100.0::DOUBLE, 0.20::DOUBLE, 'Heart rate', '60 - 100', 'Heart Rate'),
    ('bp_systolic', 110.0, 130.0, 0.15, 'Systolic blood pressure', '110 - 130', 'Bp Systolic'),
    ('bp_diastolic', 70.0, 85.0, 0.10, 'Diastolic blood pressure', '70 - 85', 'Bp Diastolic'),
    ('spo2', 95.0, 100.0, 0.25, 'Oxygen level', '95 - 100', 'Spo2'),
    ('temperature', 36.5, 37.5, 0.15, 'Body temperature', '36.5 - 37.5', 'Temperature'),
    ('respiratory_rate', 12.0, 18.0, 0.15, 'Breathing rate', '12 - 18', 'Respiratory Rate')
)"""

# A message is damaged for three of every 97 events: no patient, no time, or cut off.
READABLE = """readable AS (
  SELECT *, event_id % 97 AS turn FROM vitals
)"""

# Every 50th reading was sent again with a smaller value; damaged messages are not stored.
CORRECTED = VITALS.replace(
    "value / 100.0::DOUBLE - 0.1::DOUBLE AS k FROM events",
    "(value - CASE event_id % 50 WHEN 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) / 100.0::DOUBLE - 0.1::DOUBLE AS k"
    " FROM events WHERE event_id % 97 NOT IN (1, 2, 3)",
)

AS_OF = "TIMESTAMP '2024-01-02 12:00:00'"
TEXT_T = "strftime(t, '%Y-%m-%d %H:%M:%S')"

STATUS = """CASE WHEN value < min_ok THEN 'low' WHEN value > max_ok THEN 'high' ELSE 'normal' END AS range_status,
  CASE WHEN value < min_ok THEN 'Below normal range' WHEN value > max_ok THEN 'Above normal range' END AS range_warning"""

VITALS_OUT = f"patient_id, metric_name, round(value, 6) AS value, unit, {TEXT_T} AS \"timestamp\""

ALERTS_OUT = f"""alert_id, patient_id, metric_name, round(coalesce(observed_value, 0.0), 6) AS observed_value,
  alert_type, {TEXT_T} AS "timestamp", upper(coalesce(status, '')) AS status"""

IS_ACTIVE = "upper(coalesce(status, '')) = 'ACTIVE'"


def with_tables(*parts_then_select: str) -> str:
    *parts, select = parts_then_select
    return "WITH " + ",\n".join(parts) + "\n" + select


def newest(source: str, keys: str, order: str, where: str = "true") -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source} WHERE {where})"


def cards_cte(cap: int) -> str:
    capped = newest("vitals", "patient_id", "t DESC, metric_name")
    return f"""capped AS (SELECT * EXCLUDE (rn) FROM {capped} WHERE rn <= {cap}),
cards AS (
  SELECT patient_id, metric_name, rn AS position, unit, value, t, first_value(unit) OVER
    (PARTITION BY patient_id, metric_name ORDER BY t DESC) AS card_unit
  FROM {newest("capped", "patient_id, metric_name", "t DESC")} WHERE rn <= 3
),
shown AS (
  SELECT c.*, r.min_ok, r.max_ok, r.description, r.range_text, r.metric_label, {STATUS}
  FROM cards c LEFT JOIN reference r USING (metric_name)
)"""


METRIC_RISK = """CASE WHEN value BETWEEN min_ok AND max_ok
    THEN 0.2 * least(1.0, abs(value - (min_ok + max_ok) / 2) / ((max_ok - min_ok) / 2))
    ELSE least(1.0, 0.2 + 0.8 * least(1.0,
      CASE WHEN value < min_ok THEN min_ok - value ELSE value - max_ok END / ((max_ok - min_ok) / 2))) END"""


def latest_cte(minutes: int, cap: int) -> str:
    capped = newest("vitals", "patient_id", "t DESC, metric_name")
    return f"""recent AS (
  SELECT * EXCLUDE (rn) FROM {capped} WHERE rn <= {cap} AND t >= {AS_OF} - INTERVAL {minutes} MINUTE AND value IS NOT NULL
),
latest AS (
  SELECT * FROM {newest("recent", "patient_id, metric_name", "t DESC")} WHERE rn = 1
)"""


def counts_cte(minutes: int, cap: int) -> str:
    capped = newest("alerts", "patient_id", "t DESC, alert_id")
    return f"""counts AS (
  SELECT patient_id, count(*) AS active_alerts FROM {capped}
  WHERE rn <= {cap} AND t >= {AS_OF} - INTERVAL {minutes} MINUTE AND {IS_ACTIVE} GROUP BY patient_id
)"""


def scores_ctes(minutes: int, cap: int, alert_minutes: int, alert_cap: int) -> tuple[str, ...]:
    return (
        VITALS,
        CLASSIFIED,
        ALERTS,
        PROFILES,
        REFERENCE,
        latest_cte(minutes, cap),
        counts_cte(alert_minutes, alert_cap),
        f"""metric_scores AS (
  SELECT patient_id, sum(weight * risk) / sum(weight) AS metric_score
  FROM (SELECT l.patient_id, r.weight, {METRIC_RISK} AS risk FROM latest l JOIN reference r USING (metric_name)) x
  GROUP BY patient_id
)""",
        """scores AS (
  SELECT p.patient_id, m.metric_score, coalesce(n.active_alerts, 0) AS active_alerts,
    CASE WHEN m.metric_score IS NOT NULL OR n.active_alerts > 0 THEN greatest(0.0, least(1.0,
      coalesce(m.metric_score, 0.0) + least(0.30, 0.10::DOUBLE * coalesce(n.active_alerts, 0)))) END AS risk_score
  FROM profiles p LEFT JOIN metric_scores m USING (patient_id) LEFT JOIN counts n USING (patient_id)
)""",
    )


WIDE = scores_ctes(240, 40, 1440, 2)

CHANGED = """changed AS (
  SELECT s.patient_id, s.risk_score, p.risk_score AS previous_score
  FROM scores s JOIN profiles p USING (patient_id)
  WHERE s.risk_score IS NOT NULL AND (p.risk_score IS NULL OR abs(p.risk_score - s.risk_score) >= 0.001)
)"""

REFRESHED = """refreshed AS (
  SELECT p.patient_id, p.name, p.email, p.phone, p.medical_notes, coalesce(c.risk_score, p.risk_score) AS risk_score,
    p.last_updated, CASE WHEN c.patient_id IS NOT NULL THEN '2024-01-02 12:00:00' END AS risk_score_updated_at,
    CASE WHEN c.patient_id IS NOT NULL THEN 'auto_vitals_v1' END AS risk_score_source
  FROM profiles p LEFT JOIN changed c USING (patient_id)
)"""

PROFILE_OUT = """patient_id, name, email, phone, medical_notes, round(risk_score, 9) AS risk_score, last_updated,
  risk_score_updated_at, risk_score_source"""

BANDS = """CASE WHEN coalesce(risk_score, 0.0) > 0.5 THEN 'red' ELSE 'green' END AS risk_band,
  CAST(round(coalesce(risk_score, 0.0) * 100) AS int) AS risk_pct,
  CAST(floor(coalesce(risk_score, 0.0) * 100) AS int) AS risk_pct_floor"""

FEATURES = """features AS (
  SELECT patient_id,
    coalesce(avg(value) FILTER (WHERE metric_name = 'bp_diastolic'), 0.0) AS bp_diastolic,
    coalesce(avg(value) FILTER (WHERE metric_name = 'bp_systolic'), 0.0) AS bp_systolic,
    coalesce(avg(value) FILTER (WHERE metric_name = 'heart_rate'), 0.0) AS heart_rate,
    coalesce(avg(value) FILTER (WHERE metric_name = 'respiratory_rate'), 0.0) AS respiratory_rate,
    coalesce(avg(value) FILTER (WHERE metric_name = 'spo2'), 0.0) AS spo2,
    coalesce(avg(value) FILTER (WHERE metric_name = 'temperature'), 0.0) AS temperature
  FROM vitals
  WHERE t >= TIMESTAMP '2024-01-01 12:00:00' AND patient_id IN (SELECT patient_id FROM profiles)
  GROUP BY patient_id
)"""

LABELLED = """labelled AS (
  SELECT *, CAST(heart_rate > (SELECT median(heart_rate) FROM features) AS int) AS high_risk FROM features
)"""

SUMMARY = """summary AS (
  SELECT CAST(t AS date) AS stat_date, metric_name, avg(value) AS avg_value, min(value) AS min_value,
    max(value) AS max_value, CAST(count(DISTINCT patient_id) AS int) AS patient_count
  FROM vitals GROUP BY ALL
)"""

SUMMARY_OUT = """stat_date, metric_name, round(avg_value, 6) AS avg_value, round(min_value, 6) AS min_value,
  round(max_value, 6) AS max_value, patient_count"""

ONE_DAY = f"SELECT {SUMMARY_OUT} FROM summary WHERE stat_date = DATE '2024-01-02'"

KEPT = with_tables(VITALS, READABLE, f"SELECT {VITALS_OUT} FROM readable WHERE turn NOT IN (1, 2, 3)")

KEPT_ALERTS = "kept AS (SELECT *, event_id % 97 AS turn FROM classified)"

ALERT_COLUMNS = f"""alert_id, patient_id, metric_name, round(value, 6) AS observed_value, alert_type,
  {TEXT_T} AS "timestamp", 'ACTIVE' AS status"""

FEATURE_NAMES = ("bp_diastolic", "bp_systolic", "heart_rate", "respiratory_rate", "spo2", "temperature")


def _newton(steps: int = 30) -> tuple[str, ...]:
    """Weights of the penalised logistic regression by Newton's method, the linear systems solved by elimination.

    ``w`` is the intercept and a weight per feature; half the squared weights are added to the summed loss, the intercept is
    free.
    """
    n = len(FEATURE_NAMES) + 1
    x = ["1.0::DOUBLE", *FEATURE_NAMES]
    margin = " + ".join(f"w[{i + 1}] * {c}" for i, c in enumerate(x))
    # Row i: second derivatives with the penalty, then the first derivative.
    cells = [
        [f"sum(p * (1 - p) * {x[i]} * {x[j]})" + (" + 1" if i == j and i else "") for j in range(n)]
        + [f"sum((p - high_risk) * {x[i]})" + (f" + any_value(w)[{i + 1}]" if i else "")]
        for i in range(n)
    ]
    rows = ", ".join(f"[{', '.join(row)}]" for row in cells)
    solved = f"""SELECT step, any_value(w) AS w, [{rows}] AS m
      FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM newton, trained WHERE step < {steps}) GROUP BY step"""
    for k in range(1, n + 1):
        lead = f"list_transform(m[{k}], lambda v: v / m[{k}][{k}])"
        other = f"list_transform(row, lambda v, j: v - row[{k}] * m[{k}][j] / m[{k}][{k}])"
        solved = f"""SELECT step, w, list_transform(m, lambda row, i: CASE WHEN i = {k} THEN {lead} ELSE {other} END) AS m
      FROM ({solved})"""
    return (
        "trained AS (SELECT * FROM divided WHERE train)",
        f"""newton AS (
  SELECT 0 AS step, [{", ".join(["0.0::DOUBLE"] * n)}] AS w
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, i: v - m[i][{n + 1}]) FROM ({solved}))""",
        f"weights AS (SELECT w FROM newton WHERE step = {steps})",
        f"scored AS (SELECT *, {margin} AS margin, 1 / (1 + exp(-({margin}))) AS risk FROM divided, weights)",
    )


DIVIDED = """divided AS (
  SELECT *, row_number() OVER (ORDER BY left(sha256('42|' || patient_id), 13)) <= floor(0.7 * count(*) OVER ()) AS train
  FROM labelled
)"""

MODEL = (VITALS, PROFILES, FEATURES, LABELLED, DIVIDED, *_newton())


def with_model(*parts_then_select: str) -> str:
    return with_tables(*MODEL, *parts_then_select).replace("WITH ", "WITH RECURSIVE ", 1)


RANKED = "SELECT patient_id, round(risk, 6) AS predicted_risk, high_risk AS actual_high_risk FROM scored"


ORACLE: dict[str, str] = {
    "risk_ranking": with_model(RANKED),
    "top_risk": with_model(f"{RANKED} ORDER BY risk DESC, patient_id LIMIT 10"),
    "model_metrics": with_model(
        """placed AS (
  SELECT high_risk, rank() OVER (ORDER BY margin) + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS place
  FROM scored WHERE NOT train
)""",
        """SELECT round((sum(place) FILTER (WHERE high_risk = 1) - sum(high_risk) * (sum(high_risk) + 1) / 2.0)
    / (sum(high_risk) * sum(1 - high_risk)), 6) AS auc,
  (SELECT round(avg(CAST((risk > 0.5) = (high_risk = 1) AS int)), 6) FROM scored WHERE train) AS train_accuracy,
  (SELECT round(avg(CAST((risk > 0.5) = (high_risk = 1) AS int)), 6) FROM scored WHERE NOT train) AS test_accuracy
FROM placed""",
    ),
    "roc_points": with_model(
        "tested AS (SELECT round(risk, 9) AS risk, high_risk FROM scored WHERE NOT train)",
        """SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL
SELECT fpr, tpr FROM (SELECT DISTINCT risk, round(sum(1 - high_risk) OVER w / sum(1 - high_risk) OVER (), 8) AS fpr,
  round(sum(high_risk) OVER w / sum(high_risk) OVER (), 8) AS tpr
FROM tested WINDOW w AS (ORDER BY risk DESC RANGE UNBOUNDED PRECEDING))""",
    ),
    "model_coefficients": with_model(
        f"""SELECT unnest([{", ".join(f"'{f}'" for f in FEATURE_NAMES)}]) AS feature,
  round(unnest(w[2:]), 6) AS coefficient FROM weights ORDER BY coefficient"""
    ),

    "decode_roundtrip": with_tables(
        VITALS, READABLE, f"SELECT event_id, {VITALS_OUT} FROM readable WHERE turn NOT IN (1, 2, 3)"
    ),
    "quarantined_messages": with_tables(
        VITALS,
        READABLE,
        f"""SELECT event_id, CASE WHEN turn = 2 THEN patient_id END AS patient_id,
  CASE WHEN turn <> 3 THEN metric_name END AS metric_name, CASE WHEN turn <> 3 THEN round(value, 6) END AS value,
  CASE WHEN turn <> 3 THEN unit END AS unit, CASE WHEN turn = 1 THEN {TEXT_T} END AS "timestamp"
FROM readable WHERE turn IN (1, 2, 3)""",
    ),
    "dedup_latest": with_tables(
        VITALS,
        """resent AS (SELECT event_id, patient_id, t, metric_name, value, unit FROM vitals UNION ALL
  SELECT event_id + 10000000, patient_id, t, metric_name, value + 1.0::DOUBLE, unit FROM vitals WHERE event_id % 50 = 0)""",
        f"""SELECT event_id, {VITALS_OUT}
FROM {newest("resent", "patient_id, t, metric_name", "event_id DESC")} WHERE rn = 1""",
    ),
    "alerts_base": with_tables(VITALS, CLASSIFIED, f"SELECT {ALERT_COLUMNS} FROM classified"),
    "alerts_by_day": with_tables(VITALS, CLASSIFIED, f"SELECT day, {ALERT_COLUMNS} FROM classified"),
    "alerts_by_patient": with_tables(VITALS, CLASSIFIED, f"SELECT {ALERT_COLUMNS}, day FROM classified"),
    "active_alerts": with_tables(
        VITALS, CLASSIFIED, ALERTS, f"SELECT {ALERTS_OUT} FROM alerts WHERE {IS_ACTIVE}"
    ),
    "recent_alerts": with_tables(
        VITALS,
        CLASSIFIED,
        ALERTS,
        "scanned AS (SELECT * FROM alerts WHERE day = DATE '2024-01-02' ORDER BY t DESC, alert_id LIMIT 24)",
        f"""SELECT {ALERTS_OUT} FROM scanned WHERE t >= {AS_OF} - INTERVAL 1440 MINUTE AND {IS_ACTIVE}
ORDER BY t DESC, alert_id LIMIT 20""",
    ),
    "recent_alerts_limited": with_tables(
        VITALS,
        CLASSIFIED,
        ALERTS,
        "scanned AS (SELECT * FROM alerts WHERE day = DATE '2024-01-02' ORDER BY t DESC, alert_id LIMIT 500)",
        f"""SELECT {ALERTS_OUT} FROM scanned WHERE t >= {AS_OF} - INTERVAL 1440 MINUTE AND {IS_ACTIVE}
ORDER BY t DESC, alert_id LIMIT 5""",
    ),
    "recent_alerts_unbounded": with_tables(
        VITALS,
        CLASSIFIED,
        ALERTS,
        "scanned AS (SELECT * FROM alerts ORDER BY t DESC, alert_id LIMIT 2000)",
        f"""SELECT {ALERTS_OUT} FROM scanned WHERE t >= {AS_OF} - INTERVAL 1440 MINUTE AND {IS_ACTIVE}
ORDER BY t DESC, alert_id LIMIT 100""",
    ),
    "patient_alerts": with_tables(
        VITALS,
        CLASSIFIED,
        ALERTS,
        f"""SELECT {ALERTS_OUT} FROM {newest("alerts", "patient_id", "t DESC, alert_id")}
WHERE rn <= 2 AND t >= {AS_OF} - INTERVAL 1440 MINUTE""",
    ),
    "patient_alerts_active": with_tables(
        VITALS,
        CLASSIFIED,
        ALERTS,
        f"""SELECT {ALERTS_OUT} FROM {newest("alerts", "patient_id", "t DESC, alert_id")}
WHERE rn <= 2 AND t >= {AS_OF} - INTERVAL 1440 MINUTE AND {IS_ACTIVE}""",
    ),
    "active_alert_counts": with_tables(
        VITALS, CLASSIFIED, ALERTS, counts_cte(1440, 50), "SELECT patient_id, active_alerts FROM counts"
    ),
    "active_alert_counts_capped": with_tables(
        VITALS, CLASSIFIED, ALERTS, counts_cte(1440, 2), "SELECT patient_id, active_alerts FROM counts"
    ),
    "daily_summary": with_tables(VITALS, SUMMARY, f"SELECT {SUMMARY_OUT} FROM summary"),
    "daily_summary_one_day": with_tables(VITALS, SUMMARY, ONE_DAY),
    "daily_summary_read": with_tables(VITALS, SUMMARY, f"{ONE_DAY} ORDER BY metric_name"),
    "daily_summary_display": with_tables(
        VITALS,
        SUMMARY,
        REFERENCE,
        """SELECT CAST(stat_date AS varchar) AS stat_date, metric_label, printf('%.2f', avg_value) AS avg_value,
  printf('%.2f', min_value) AS min_value, printf('%.2f', max_value) AS max_value, patient_count
FROM summary JOIN reference USING (metric_name)""",
    ),
    "vitals_of_day": with_tables(
        VITALS, f"SELECT {VITALS_OUT} FROM vitals WHERE CAST(t AS date) = DATE '2024-01-02'"
    ),
    "vitals_in_lookback": with_tables(
        VITALS, f"SELECT {VITALS_OUT} FROM vitals WHERE t >= {AS_OF} - INTERVAL 30 MINUTE"
    ),
    "newest_vitals": with_tables(
        VITALS, f"SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id', 't DESC, metric_name')} WHERE rn <= 20"
    ),
    "metric_history": with_tables(
        VITALS, f"SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id, metric_name', 't DESC')} WHERE rn <= 5"
    ),
    "metric_history_page2": with_tables(
        VITALS,
        f"SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id, metric_name', 't DESC')} WHERE rn BETWEEN 6 AND 10",
    ),
    "metric_history_next": with_tables(
        VITALS,
        f"SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id, metric_name', 't DESC')} WHERE rn BETWEEN 6 AND 10",
    ),
    "patient_vitals_next": with_tables(
        VITALS,
        f"""SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id', 't DESC, metric_name')}
WHERE rn BETWEEN 11 AND 20 AND patient_id = 'P-000007'""",
    ),
    "latest_readings": with_tables(
        VITALS,
        latest_cte(240, 40),
        f'SELECT patient_id, metric_name, round(value, 6) AS value, {TEXT_T} AS "timestamp" FROM latest',
    ),
    "range_status": with_tables(
        VITALS,
        REFERENCE,
        f"""SELECT metric_name, event_id, patient_id, {TEXT_T} AS "timestamp", round(value, 6) AS value, unit,
  min_ok, max_ok, description, metric_label, range_text, {STATUS} FROM vitals LEFT JOIN reference USING (metric_name)""",
    ),
    "metric_cards": with_tables(
        VITALS,
        REFERENCE,
        cards_cte(40),
        f"""SELECT metric_name, patient_id, {TEXT_T} AS "timestamp", round(value, 6) AS value, unit,
  CAST(position AS int) AS position, card_unit, min_ok, max_ok, description, metric_label, range_text, range_status,
  range_warning FROM shown""",
    ),
    "patient_overview": with_tables(
        VITALS,
        REFERENCE,
        PROFILES,
        cards_cte(40),
        f"""SELECT p.patient_id, p.name, s.metric_name, CAST(s.position AS varchar) AS position, s.metric_label, s.description,
  s.card_unit, s.range_text, round(s.value, 6) AS value, s.unit, strftime(s.t, '%Y-%m-%d %H:%M:%S') AS "timestamp",
  s.range_status, s.range_warning FROM profiles p LEFT JOIN shown s USING (patient_id)""",
    ),
    "patient_overview_one": with_tables(
        VITALS,
        REFERENCE,
        PROFILES,
        cards_cte(40),
        f"""SELECT p.patient_id, p.name, s.metric_name, CAST(s.position AS varchar) AS position, s.metric_label, s.description,
  s.card_unit, s.range_text, round(s.value, 6) AS value, s.unit, strftime(s.t, '%Y-%m-%d %H:%M:%S') AS "timestamp",
  s.range_status, s.range_warning FROM profiles p LEFT JOIN shown s USING (patient_id) WHERE p.patient_id = 'P-000007'""",
    ),
    "known_patient_vitals": with_tables(
        VITALS, PROFILES, f"SELECT {VITALS_OUT} FROM vitals WHERE patient_id IN (SELECT patient_id FROM profiles)"
    ),
    "metric_risk": with_tables(
        VITALS,
        REFERENCE,
        f"""SELECT event_id, patient_id, metric_name, round(value, 6) AS value, weight, round({METRIC_RISK}, 6) AS risk
FROM vitals JOIN reference USING (metric_name)""",
    ),
    "risk_scores": with_tables(
        *scores_ctes(30, 200, 30, 50),
        """SELECT patient_id, round(metric_score, 9) AS metric_score, active_alerts, round(risk_score, 9) AS risk_score
FROM scores""",
    ),
    "risk_scores_wide": with_tables(
        *WIDE,
        """SELECT patient_id, round(metric_score, 9) AS metric_score, active_alerts, round(risk_score, 9) AS risk_score
FROM scores""",
    ),
    "changed_risk": with_tables(
        *WIDE,
        CHANGED,
        """SELECT patient_id, round(risk_score, 9) AS risk_score, round(previous_score, 9) AS previous_score FROM changed""",
    ),
    "changed_risk_count": with_tables(*WIDE, CHANGED, "SELECT count(*) AS updated FROM changed"),
    "refreshed_risk_profiles": with_tables(*WIDE, CHANGED, REFRESHED, f"SELECT {PROFILE_OUT} FROM refreshed"),
    "risk_list": with_tables(
        *WIDE,
        CHANGED,
        REFRESHED,
        """SELECT patient_id, round(risk_score, 9) AS risk_score, risk_score_updated_at FROM refreshed ORDER BY patient_id""",
    ),
    "ward_ranking": with_tables(
        PROFILES,
        f"""SELECT patient_id, name, medical_notes, round(coalesce(risk_score, 0.0), 9) AS risk_score, {BANDS}
FROM profiles ORDER BY coalesce(risk_score, 0.0) DESC, patient_id""",
    ),
    "risk_bands": with_tables(
        *WIDE,
        f"""SELECT patient_id, risk_score, {BANDS}
FROM (SELECT patient_id, round(risk_score, 9) AS risk_score FROM scores) s""",
    ),
    "profile_list": with_tables(PROFILES, f"SELECT {PROFILE_OUT} FROM profiles ORDER BY patient_id"),
    "patched_profiles": with_tables(
        PROFILES,
        """patched AS (
  SELECT patient_id, CASE WHEN k % 28 = 0 OR k % 14 <> 0 THEN 1 ELSE 2 END AS seq FROM profiles WHERE k % 7 = 0
)""",
        """SELECT patient_id,
  CASE seq WHEN 1 THEN 'Patched ' || name WHEN 2 THEN 'Again ' || name ELSE name END AS name,
  CASE seq WHEN 2 THEN '' ELSE email END AS email,
  CASE seq WHEN 1 THEN '0' WHEN 2 THEN '1' ELSE phone END AS phone,
  CASE seq WHEN 2 THEN 'later note' ELSE medical_notes END AS medical_notes, round(risk_score, 9) AS risk_score,
  CASE WHEN seq IS NOT NULL THEN '2024-01-02 12:00:00' ELSE last_updated END AS last_updated,
  risk_score_updated_at, risk_score_source
FROM profiles LEFT JOIN patched USING (patient_id)""",
    ),
    "stream_vitals": KEPT,
    "stream_alerts": with_tables(
        VITALS, CLASSIFIED, KEPT_ALERTS, f"SELECT day, {ALERT_COLUMNS} FROM kept WHERE turn NOT IN (1, 2, 3)"
    ),
    "stream_alerts_by_patient": with_tables(
        VITALS, CLASSIFIED, KEPT_ALERTS, f"SELECT {ALERT_COLUMNS}, day FROM kept WHERE turn NOT IN (1, 2, 3)"
    ),
    "stream_alerts_base": with_tables(
        VITALS, CLASSIFIED, KEPT_ALERTS, f"SELECT {ALERT_COLUMNS} FROM kept WHERE turn NOT IN (1, 2, 3)"
    ),
    "compacted_batches": with_tables(
        VITALS, CLASSIFIED, KEPT_ALERTS, f"SELECT {ALERT_COLUMNS}, day FROM kept WHERE turn NOT IN (1, 2, 3)"
    ),
    "stream_quarantine": with_tables(
        VITALS,
        READABLE,
        """SELECT CASE turn WHEN 3 THEN left('{"patient_id":"' || patient_id, 20) END AS cut_text,
  CASE turn WHEN 2 THEN patient_id END AS patient_id, CASE WHEN turn < 3 THEN metric_name END AS metric_name,
  CASE WHEN turn < 3 THEN round(value, 6) END AS value, CASE WHEN turn < 3 THEN unit END AS unit,
  CASE turn WHEN 1 THEN strftime(t, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN 'not a time' END AS "timestamp"
FROM readable WHERE turn IN (1, 2, 3)""",
    ),
    "compacted_vitals_corrected": with_tables(CORRECTED, f"SELECT {VITALS_OUT} FROM vitals"),
    "incremental_daily_summary": with_tables(
        VITALS, SUMMARY.replace("FROM vitals", "FROM vitals WHERE event_id % 97 NOT IN (1, 2, 3)"),
        f"SELECT {SUMMARY_OUT} FROM summary",
    ),
    "live_daily_summary": with_tables(CORRECTED, SUMMARY, f"SELECT {SUMMARY_OUT} FROM summary"),
    "patient_vitals_one": with_tables(
        VITALS,
        f"""SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id', 't DESC, metric_name')}
WHERE rn <= 30 AND patient_id = 'P-000007'""",
    ),
    "metric_history_one": with_tables(
        VITALS,
        f"""SELECT {VITALS_OUT} FROM {newest('vitals', 'patient_id, metric_name', 't DESC')}
WHERE rn BETWEEN 3 AND 6 AND patient_id = 'P-000007' AND metric_name = 'spo2'""",
    ),
    "profile_one": with_tables(PROFILES, f"SELECT {PROFILE_OUT} FROM profiles WHERE patient_id = 'P-000007'"),
    "patient_features_72h": with_tables(
        VITALS,
        PROFILES,
        FEATURES.replace("t >= TIMESTAMP '2024-01-01 12:00:00' AND ", ""),
        """SELECT patient_id, round(bp_diastolic, 10) AS bp_diastolic, round(bp_systolic, 10) AS bp_systolic,
  round(heart_rate, 10) AS heart_rate, round(respiratory_rate, 10) AS respiratory_rate, round(spo2, 10) AS spo2,
  round(temperature, 10) AS temperature FROM features""",
    ),
    "high_risk_labels_fallback": with_tables(
        VITALS,
        PROFILES,
        FEATURES.replace("WHERE t >=", "WHERE metric_name <> 'heart_rate' AND t >="),
        LABELLED.replace("heart_rate", "bp_diastolic"),
        "SELECT patient_id, round(bp_diastolic, 8) AS bp_diastolic, high_risk FROM labelled",
    ),
    "roc_points_of_feature": with_tables(
        VITALS,
        PROFILES,
        FEATURES,
        LABELLED,
        """SELECT DISTINCT round(spo2, 8) AS threshold,
  round(sum(1 - high_risk) OVER w / sum(1 - high_risk) OVER (), 8) AS fpr,
  round(sum(high_risk) OVER w / sum(high_risk) OVER (), 8) AS tpr
FROM labelled WINDOW w AS (ORDER BY spo2 DESC RANGE UNBOUNDED PRECEDING)""",
    ),
    "stream_dedup": KEPT,
    "compacted_vitals": KEPT,
    "patient_features": with_tables(
        VITALS,
        PROFILES,
        FEATURES,
        """SELECT patient_id, round(bp_diastolic, 8) AS bp_diastolic, round(bp_systolic, 8) AS bp_systolic,
  round(heart_rate, 8) AS heart_rate, round(respiratory_rate, 8) AS respiratory_rate, round(spo2, 8) AS spo2,
  round(temperature, 8) AS temperature FROM features""",
    ),
    "high_risk_labels": with_tables(
        VITALS,
        PROFILES,
        FEATURES,
        LABELLED,
        "SELECT patient_id, round(heart_rate, 8) AS heart_rate, high_risk FROM labelled",
    ),
    "median_of_readings": with_tables(VITALS, "SELECT round(median(value), 8) AS median FROM vitals"),
    "label_distribution": with_tables(
        VITALS, PROFILES, FEATURES, LABELLED, "SELECT high_risk, count(*) AS patients FROM labelled GROUP BY high_risk"
    ),
    "feature_auc": with_tables(
        VITALS,
        PROFILES,
        FEATURES,
        LABELLED,
        """scored AS (
  SELECT 'heart_rate' AS feature, heart_rate AS score, high_risk FROM labelled
  UNION ALL SELECT 'bp_systolic', bp_systolic, high_risk FROM labelled
)""",
        """placed AS (
  SELECT feature, high_risk,
    rank() OVER (PARTITION BY feature ORDER BY score)
      + (count(*) OVER (PARTITION BY feature, score) - 1) / 2.0 AS place
  FROM scored
)""",
        """SELECT feature, round((sum(place) FILTER (WHERE high_risk = 1)
    - sum(high_risk) * (sum(high_risk) + 1) / 2.0) / (sum(high_risk) * sum(1 - high_risk)), 6) AS auc
FROM placed GROUP BY feature""",
    ),
    "load_counts": with_tables(
        VITALS,
        CLASSIFIED,
        ALERTS,
        PROFILES,
        f"""SELECT 'vitals' AS source, count(*) AS loaded FROM vitals
WHERE t >= TIMESTAMP '2024-01-01 12:00:00' AND patient_id IN (SELECT patient_id FROM profiles)
UNION ALL SELECT 'alerts', count(*) FROM alerts
WHERE t >= TIMESTAMP '2024-01-01 12:00:00' AND patient_id IN (SELECT patient_id FROM profiles) AND {IS_ACTIVE}""",
    ),
    "train_test_split": with_tables(
        VITALS,
        PROFILES,
        FEATURES,
        """SELECT patient_id,
  CASE WHEN left(sha256('42|' || patient_id), 13) < 'b333333333333' THEN 'train' ELSE 'test' END AS part FROM features""",
    ),
    "train_test_split_exact": with_tables(
        VITALS,
        PROFILES,
        FEATURES,
        """SELECT patient_id, CASE WHEN row_number() OVER (ORDER BY left(sha256('42|' || patient_id), 13))
    <= floor(0.7 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part FROM features""",
    ),
}
