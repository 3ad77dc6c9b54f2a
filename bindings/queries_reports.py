"""Customer features, business reports, profiles, drift and health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.queries_base import rnd, when
from bindings.registry import query
from bindings.tables import DELIVERED, FEATURE_COLUMNS, FEATURE_NUMERIC, WIDE_COLUMNS, WIDE_NUMERIC, Tables
from loyaltide.operators import asof, drift, features, health, profile, reports, rollups, sketches
from loyaltide.plans.pipelines import user_features as build_user_features
from loyaltide.plans.staging import stage

# --- customer features -------------------------------------------------------


@query(f"""
SELECT customer_unique_id, recency_days, frequency, {rnd('monetary')}, {rnd('avg_order_value')} FROM v_rfm""")
def rfm(t: Tables) -> DataFrame:
    return features.rfm(t.transformed)


@query(f"""
SELECT customer_unique_id, {rnd('avg_review_score')}, {rnd('std_review_score')}, min_review_score,
       {rnd('avg_payment_types')}, {rnd('avg_installments')}, primary_payment_type, {rnd('total_freight')},
       {rnd('avg_freight_ratio')}, {rnd('weekend_purchase_ratio')}, {rnd('avg_purchase_hour')},
       {rnd('avg_categories_per_order')}, total_category_count, {rnd('avg_delivery_delay')}, max_delivery_delay,
       {rnd('avg_items_per_order')}, total_items_purchased, customer_state
FROM v_behaviour""")
def behavioral_features(t: Tables) -> DataFrame:
    return features.behavioral_features(t.transformed)


@query(f"SELECT customer_unique_id, {rnd('spend_trend')} FROM v_trend")
def spend_trend(t: Tables) -> DataFrame:
    return features.spend_trend(t.transformed)


FEATURES_SQL = f"""
SELECT customer_unique_id, recency_days, frequency, {rnd('monetary')}, {rnd('avg_order_value')},
       {rnd('avg_review_score')}, {rnd('std_review_score')}, min_review_score,
       {rnd('avg_payment_types')}, {rnd('avg_installments')}, primary_payment_type, {rnd('total_freight')},
       {rnd('avg_freight_ratio')}, {rnd('weekend_purchase_ratio')}, {rnd('avg_purchase_hour')},
       {rnd('avg_categories_per_order')}, total_category_count, {rnd('avg_delivery_delay')}, max_delivery_delay,
       {rnd('avg_items_per_order')}, total_items_purchased, customer_state, {rnd('spend_trend')}, churn_label,
       high_value_customer, is_repeat_buyer
FROM v_features"""


@query(FEATURES_SQL)
def user_features(t: Tables) -> DataFrame:
    return build_user_features(t.build_transformed())


CUTS = ("1996-07-01", "1998-01-01", "1998-01-02", "1999-03-15", "2000-11-01")
FREIGHT_RATIO = "avg(CASE WHEN total_payment_value > 0 THEN total_freight / total_payment_value ELSE 0.0 END)"
TREND = ("CASE WHEN avg(total_payment_value) > 0 THEN (avg(total_payment_value) FILTER (rn <= 2) - avg(total_payment_value)) "
         "/ avg(total_payment_value) ELSE 0.0 END")


@query(f"""
SELECT strftime(as_of, '%Y-%m-%d %H:%M:%S') AS as_of, customer_unique_id,
  CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE), CAST(as_of AS DATE)) AS INTEGER) AS recency_days,
  count(*) AS frequency, {rnd('avg(total_payment_value)', 'avg_order_value')},
  {rnd('avg(review_score)', 'avg_review_score')}, {rnd('avg(num_payment_types)', 'avg_payment_types')},
  {rnd('avg(avg_installments)', 'avg_installments')}, {rnd(FREIGHT_RATIO, 'avg_freight_ratio')},
  {rnd('avg(CASE WHEN purchase_dow IN (1, 7) THEN 1 ELSE 0 END)', 'weekend_purchase_ratio')},
  {rnd('avg(purchase_hour)', 'avg_purchase_hour')}, {rnd('avg(num_categories)', 'avg_categories_per_order')},
  {rnd('avg(delivery_delay_days)', 'avg_delivery_delay')}, {rnd('avg(num_items)', 'avg_items_per_order')},
  {rnd('sum(total_payment_value)', 'monetary')}, {rnd('sum(total_freight)', 'total_freight')},
  CAST(coalesce(sum(len(string_split(categories, '|'))), 0) AS INTEGER) AS total_category_count,
  CAST(sum(num_items) AS BIGINT) AS total_items_purchased, min(review_score) AS min_review_score,
  max(delivery_delay_days) AS max_delivery_delay, {rnd('coalesce(stddev_samp(review_score), 0.0)', 'std_review_score')},
  arg_min(primary_payment_type, (order_purchase_timestamp, order_id)) AS primary_payment_type,
  arg_min(customer_state, (order_purchase_timestamp, order_id)) AS customer_state, {rnd(TREND, 'spend_trend')},
  CASE WHEN any_value(next_at) < as_of + INTERVAL 180 DAYS THEN 0
       WHEN (SELECT max(order_purchase_timestamp) FROM v_transformed) >= as_of + INTERVAL 180 DAYS THEN 1 END AS churn_label
FROM (
  SELECT t.*, as_of, row_number() OVER (PARTITION BY as_of, customer_unique_id
           ORDER BY order_purchase_timestamp DESC, order_id DESC) AS rn,
    (SELECT min(o.order_purchase_timestamp) FROM v_transformed o WHERE o.customer_unique_id = t.customer_unique_id
       AND o.order_purchase_timestamp >= as_of) AS next_at
  FROM v_transformed t JOIN (SELECT unnest([{", ".join(f"TIMESTAMP '{c}'" for c in CUTS)}]) AS as_of) c
    ON t.order_purchase_timestamp < as_of WHERE t.customer_unique_id IS NOT NULL)
GROUP BY as_of, customer_unique_id""")
def features_as_of(t: Tables) -> DataFrame:
    """Every customer's features at five dates, from the orders before, with labels from after."""
    return asof.features_as_of(t.transformed, CUTS)


# --- reports -----------------------------------------------------------------

@query(f"""
SELECT customer_state, count(*) AS num_customers, {rnd('avg(monetary)', 'avg_spend', 4)},
       {rnd('avg(avg_review_score)', 'avg_review', 4)}, {rnd('avg(churn_label)', 'churn_rate', 4)},
       {rnd('avg(frequency)', 'avg_orders', 4)}, {rnd('avg(recency_days)', 'avg_recency_days', 4)}
FROM v_features GROUP BY customer_state""", digits=4)
def state_stats(t: Tables) -> DataFrame:
    return reports.state_stats(t.features)


@query("""
SELECT customer_unique_id, recency_days, frequency, customer_state FROM v_features WHERE churn_label = 1
ORDER BY recency_days DESC, frequency, customer_unique_id LIMIT 1000""")
def top_churners(t: Tables) -> DataFrame:
    return reports.top_churners(t.features).select(
        "customer_unique_id", "recency_days", "frequency", "customer_state")


@query("""
SELECT c_custkey AS customer_unique_id, round(c_acctbal, 6) AS churn_score FROM customer
ORDER BY c_acctbal DESC, c_custkey LIMIT 100""")
def top_churners_by_score(t: Tables) -> DataFrame:
    scored = t.raw("customer").select(
        F.col("c_custkey").alias("customer_unique_id"), F.col("c_acctbal").alias("churn_score"))
    return reports.top_churners(scored, 100, score_col="churn_score")


@query(f"""
SELECT purchase_year, purchase_month, {rnd('sum(total_payment_value)', 'monthly_revenue', 2)},
       count(order_id) AS num_orders, {rnd('avg(review_score)', 'avg_review_score', 6)},
       {rnd('avg(total_freight)', 'avg_freight', 6)}
FROM v_transformed WHERE order_status = '{DELIVERED}' GROUP BY 1, 2""", digits={"monthly_revenue": 2})
def revenue_by_month(t: Tables) -> DataFrame:
    return reports.revenue_by_month(t.transformed, DELIVERED)


@query("""
SELECT CAST(year(f) AS INTEGER) AS cohort_year, CAST(month(f) AS INTEGER) AS cohort_month,
       CAST((purchase_year - year(f)) * 12 + purchase_month - month(f) AS INTEGER) AS months_since_cohort,
       count(DISTINCT customer_unique_id) AS active_customers
FROM (SELECT *, min(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id) AS f FROM v_transformed)
GROUP BY 1, 2, 3""")
def cohort_retention(t: Tables) -> DataFrame:
    return reports.cohort_retention(t.transformed)


@query("""
SELECT category, round(sum(total_price), 2) AS total_revenue, count(*) AS num_orders,
       round(avg(review_score), 6) AS avg_review
FROM (SELECT unnest(string_split(categories, '|')) AS category, total_price, review_score FROM v_transformed)
GROUP BY category""", digits={"total_revenue": 2})
def category_performance(t: Tables) -> DataFrame:
    return reports.category_performance(t.transformed)


# --- profiles of the feature store -------------------------------------------

@query("""
SELECT churn_label, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct,
       round(sum(count(*)) FILTER (WHERE churn_label = 0) OVER ()
             / sum(count(*)) FILTER (WHERE churn_label = 1) OVER (), 6) AS neg_pos_ratio,
       sum(count(*)) FILTER (WHERE churn_label = 0) OVER ()
             / sum(count(*)) FILTER (WHERE churn_label = 1) OVER () > 5 AS imbalanced
FROM v_features GROUP BY churn_label""")
def class_balance(t: Tables) -> DataFrame:
    return profile.class_balance(t.features)


SUMMARY_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max,
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(CAST(quantile_disc({c}, 0.25) AS DOUBLE), 4) AS p25,
       round(CAST(quantile_disc({c}, 0.5) AS DOUBLE), 4) AS p50,
       round(CAST(quantile_disc({c}, 0.75) AS DOUBLE), 4) AS p75, count(*) - count({c}) AS nulls
FROM v_wide""" for c in WIDE_NUMERIC)


@query(SUMMARY_SQL, digits=4)
def numeric_summary(t: Tables) -> DataFrame:
    return profile.numeric_summary(t.wide)


@query("""
SELECT p_brand, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM part), 2) AS pct
FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def categorical_distribution(t: Tables) -> DataFrame:
    return profile.categorical_distribution(t.raw("part"), "p_brand")


@query(f"SELECT churn_label, {', '.join(rnd(f'avg({c})', c, 4) for c in FEATURE_NUMERIC)} FROM v_features GROUP BY 1", digits=4)
def label_feature_means(t: Tables) -> DataFrame:
    return profile.label_feature_means(t.features)


CORRELATED = ("total_payment_value", "total_price", "num_items", "avg_installments", "review_score",
              "delivery_delay_days", "num_products")
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in CORRELATED)
PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM v_complete"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:])


@query(f"SELECT feature_a, feature_b, round(corr, 6) AS corr FROM ({PAIRS_SQL}) ORDER BY abs(corr) DESC LIMIT 20",
       views={"v_complete": f"SELECT * FROM v_transformed WHERE {COMPLETE}"})
def correlation_pairs(t: Tables) -> DataFrame:
    return profile.correlation_pairs(t.transformed, CORRELATED)


@query("""
SELECT quality, count(*) AS rows,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM labels GROUP BY quality""")
def class_weights(t: Tables) -> DataFrame:
    return profile.class_weights(t.raw("labels"), "quality")


@query("SELECT quality, toxic, count(*) AS count FROM labels GROUP BY 1, 2")
def confusion_matrix(t: Tables) -> DataFrame:
    return profile.confusion_matrix(t.raw("labels"), "quality", "toxic")


# --- drift -------------------------------------------------------------------
# Reference: events before 2024-01-21. Current: events from then on.

CUT = "2024-01-21"
NUMERIC = ("value", "visitorid", "itemid", "hour")
ACTIVITY = f"""
SELECT event, value, visitorid, itemid, CAST(hour(event_time) AS INTEGER) AS hour,
       CASE WHEN event = 'transaction' THEN 1 ELSE 0 END AS churn_label,
       CASE WHEN event_time < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side
FROM v_events"""


def _psi_sql(c: str) -> str:
    points = [i / 10 for i in range(1, 10)]
    return f"""
SELECT '{c}' AS feature, round(CASE WHEN edges < 2 THEN 0.0 ELSE psi END, 6) AS psi FROM (
  SELECT any_value(len(e)) AS edges,
         sum((greatest(c, 1e-6) - greatest(r, 1e-6)) * ln(greatest(c, 1e-6) / greatest(r, 1e-6))) AS psi
  FROM (
    SELECT bin, any_value(e) AS e,
           count(*) FILTER (WHERE side = 0 AND found = bin) / (SELECT count(*) FROM v_activity WHERE side = 0) AS r,
           count(*) FILTER (WHERE side = 1 AND found = bin) / (SELECT count(*) FROM v_activity WHERE side = 1) AS c
    FROM (SELECT side, e, len(list_filter(e, lambda x: {c} > x)) AS found FROM v_activity,
                 (SELECT list_sort(list_distinct(quantile_disc({c}, {points}))) AS e FROM v_activity WHERE side = 0)),
         (SELECT unnest(range(0, 10)) AS bin)
    WHERE bin <= len(e) GROUP BY bin))"""


PSI_SQL = " UNION ALL ".join(_psi_sql(c) for c in NUMERIC)
ACTIVITY_VIEW = {"v_activity": ACTIVITY}


def _activity(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = t.events.select(
        "event_time", "event", "value", "visitorid", "itemid", F.hour("event_time").alias("hour"),
        F.when(F.col("event") == "transaction", 1).otherwise(0).alias("churn_label"))
    sides = drift.reference_current_split(events, "event_time", F.lit(CUT).cast("timestamp_ntz"))
    return tuple(side.drop("event_time") for side in sides)


@query(PSI_SQL, views=ACTIVITY_VIEW)
def drift_psi(t: Tables) -> DataFrame:
    return drift.drift_psi(*_activity(t), NUMERIC)


GAP_POINTS = [i / 100 for i in range(5, 100, 5)]
GAP_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(max(abs(cur - ref) / spread), 6) AS quantile_gap FROM (
  SELECT unnest(ref) AS ref, unnest(cur) AS cur, list_max(ref) - list_min(ref) AS spread FROM (
    SELECT quantile_disc({c}, {GAP_POINTS}) FILTER (WHERE side = 0) AS ref,
           quantile_disc({c}, {GAP_POINTS}) FILTER (WHERE side = 1) AS cur FROM v_activity))""" for c in NUMERIC)


@query(GAP_SQL, views=ACTIVITY_VIEW)
def drift_quantile_gap(t: Tables) -> DataFrame:
    return drift.drift_quantile_gap(*_activity(t), NUMERIC)


KS_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(max(abs(r - u)), 6) AS ks FROM (
  SELECT sum(count(*) FILTER (WHERE side = 0)) OVER (ORDER BY {c})
           / (SELECT count(*) FROM v_activity WHERE side = 0) AS r,
         sum(count(*) FILTER (WHERE side = 1)) OVER (ORDER BY {c})
           / (SELECT count(*) FROM v_activity WHERE side = 1) AS u
  FROM v_activity GROUP BY {c})""" for c in NUMERIC)


@query(KS_SQL, views=ACTIVITY_VIEW)
def drift_ks(t: Tables) -> DataFrame:
    return drift.drift_ks(*_activity(t), NUMERIC)


CATEGORICAL_SQL = """
SELECT 'event' AS feature, round(sum(abs(coalesce(r, 0) - coalesce(c, 0))) / 2, 6) AS distance FROM (
  SELECT event, count(*) / (SELECT count(*) FROM v_activity WHERE side = 0) AS r FROM v_activity
  WHERE side = 0 GROUP BY event) a
FULL OUTER JOIN (
  SELECT event, count(*) / (SELECT count(*) FROM v_activity WHERE side = 1) AS c FROM v_activity
  WHERE side = 1 GROUP BY event) b ON a.event IS NOT DISTINCT FROM b.event"""


@query(CATEGORICAL_SQL, views=ACTIVITY_VIEW)
def drift_categorical(t: Tables) -> DataFrame:
    return drift.drift_categorical(*_activity(t), ["event"])


LABEL_SQL = """
SELECT round(r, 6) AS ref_rate, round(c, 6) AS cur_rate, round(c - r, 6) AS label_drift FROM (
  SELECT avg(churn_label) FILTER (WHERE side = 0) AS r, avg(churn_label) FILTER (WHERE side = 1) AS c
  FROM v_activity)"""


@query(LABEL_SQL, views=ACTIVITY_VIEW)
def drift_label(t: Tables) -> DataFrame:
    return drift.drift_label(*_activity(t))


MOMENTS_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, avg({c}) FILTER (WHERE side = 0) AS ref_mean, avg({c}) FILTER (WHERE side = 1) AS cur_mean,
       stddev_samp({c}) FILTER (WHERE side = 0) AS ref_std, stddev_samp({c}) FILTER (WHERE side = 1) AS cur_std
FROM v_activity""" for c in NUMERIC)


@query(f"""
SELECT feature, round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean,
       round(abs(cur_mean - ref_mean) / abs(ref_mean), 6) AS shift,
       abs(cur_mean - ref_mean) / abs(ref_mean) > 0.01 AS drifted
FROM ({MOMENTS_SQL})""", views=ACTIVITY_VIEW)
def drift_mean_shift(t: Tables) -> DataFrame:
    return drift.drift_mean_shift(*_activity(t), NUMERIC, threshold=0.01)


REPORT_VIEWS = {
    **ACTIVITY_VIEW,
    "v_psi": PSI_SQL,
    "v_moments": MOMENTS_SQL,
    "v_categorical": CATEGORICAL_SQL,
    "v_report": """
SELECT feature, method, score,
       CASE WHEN score >= 0.2 THEN 'DRIFT' WHEN score >= 0.1 THEN 'WARNING' ELSE 'SAFE' END AS status,
       ref_mean, cur_mean, ref_std, cur_std
FROM (SELECT p.feature, 'psi' AS method, psi AS score, ref_mean, cur_mean, ref_std, cur_std
      FROM v_psi p JOIN v_moments m ON m.feature = p.feature
      UNION ALL SELECT feature, 'cat', distance, NULL, NULL, NULL, NULL FROM v_categorical)""",
    "v_label_drift": LABEL_SQL,
}


@query(f"""
SELECT feature, method, {rnd('score')}, status, {rnd('ref_mean')}, {rnd('cur_mean')}, {rnd('ref_std')},
       {rnd('cur_std')} FROM v_report""", views=REPORT_VIEWS)
def drift_report(t: Tables) -> DataFrame:
    return drift.drift_report(*_activity(t))


# Trainings on record: the days of orders of the highest priority, in epoch of the events.
@query("""
SELECT features, drifted, drifted / features AS drift_rate, label_drift, model_age_days,
       coalesce(reason, 'none') AS reason, reason IS NOT NULL AS retrain
FROM (SELECT *, CASE WHEN drifted >= 3 THEN 'drifted features' WHEN drifted / features >= 0.2 THEN 'drift rate'
                     WHEN abs(label_drift) >= 0.05 THEN 'label drift'
                     WHEN model_age_days >= 30 THEN 'model age' END AS reason
      FROM (SELECT count(*) AS features, count(*) FILTER (WHERE status = 'DRIFT') AS drifted,
                   (SELECT label_drift FROM v_label_drift) AS label_drift,
                   (SELECT CAST(date_diff('day', (SELECT CAST(max(o_orderdate) AS DATE) FROM orders
                                                  WHERE o_orderpriority = '1-URGENT'), DATE '2024-02-01') AS INTEGER))
                     AS model_age_days
            FROM v_report))""", views=REPORT_VIEWS)
def retrain_decision(t: Tables) -> DataFrame:
    reference, current = _activity(t)
    trained = t.raw("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderdate").alias("recorded_at"))
    return drift.retrain_decision(
        stage(drift.drift_report(reference, current), "drift-report"), drift.drift_label(reference, current), trained,
        F.lit("2024-02-01").cast("date"))


@query(f"""
SELECT CASE WHEN order_purchase_timestamp < TIMESTAMP '2000-01-01' THEN 'reference' ELSE 'current' END AS side,
       count(*) AS n, min(order_id) AS first_order, max(order_id) AS last_order,
       strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS since
FROM v_orders GROUP BY 1""")
def reference_current_split(t: Tables) -> DataFrame:
    sides = drift.reference_current_split(
        t.orders, "order_purchase_timestamp", F.lit("2000-01-01").cast("timestamp_ntz"))
    named = [side.withColumn("side", F.lit(name)) for side, name in zip(sides, ("reference", "current"))]
    return named[0].unionByName(named[1]).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order"),
        F.min("order_purchase_timestamp").alias("since"))


# --- health ------------------------------------------------------------------

def _null_alert(view: str, stage_name: str, column: str, critical: bool) -> str:
    rate = f"(count(*) - count({column})) / count(*)"
    alerts = [("null rate", f"{rate} > 0.05")] + ([("critical null", f"{rate} > 0")] if critical else [])
    return " UNION ALL ".join(f"""
SELECT '{stage_name}' AS stage, '{column}' AS "column", '{kind}' AS anomaly, {rate} AS value
FROM {view} HAVING {test}""" for kind, test in alerts)


def _health_sql(view: str, stage_name: str, columns: dict[str, bool], previous: str | None) -> str:
    parts = [f"SELECT '{stage_name}' AS stage, NULL AS \"column\", 'few rows' AS anomaly, "
             f"CAST(count(*) AS DOUBLE) AS value FROM {view} HAVING count(*) < 100"]
    if previous:
        drop = f"((SELECT count(*) FROM {previous}) - count(*)) / (SELECT count(*) FROM {previous})"
        parts.append(f"SELECT '{stage_name}', NULL, 'row drop', {drop} FROM {view} HAVING {drop} > 0.2")
    parts += [_null_alert(view, stage_name, c, critical) for c, critical in columns.items()]
    return " UNION ALL ".join(parts)


HEALTH_VIEWS = {
    "v_paired": "SELECT o_orderkey, o_custkey, p_partkey, p_type FROM orders LEFT JOIN part ON p_partkey = o_orderkey",
}
PAIRED = {"o_orderkey": True, "o_custkey": False, "p_partkey": True, "p_type": False}


def _paired(t: Tables) -> DataFrame:
    return t.raw("orders").join(t.raw("part"), F.col("o_orderkey") == F.col("p_partkey"), "left").select(*PAIRED)


@query(f"SELECT stage, \"column\", anomaly, {rnd('value')} FROM ("
       f"{_health_sql('v_paired', 'paired', PAIRED, 'lineitem')})", views=HEALTH_VIEWS)
def table_health(t: Tables) -> DataFrame:
    return health.table_health(
        _paired(t), "paired", [c for c, critical in PAIRED.items() if critical],
        t.raw("lineitem").agg(F.count(F.lit(1))).scalar())


@query(f"""
SELECT 'batch_0' AS batch_id, count(*) AS total_predictions, {rnd('avg(p)', 'churn_rate', 4)},
       {rnd('avg(s)', 'avg_churn_prob', 4)}, count(*) FILTER (WHERE s >= 0.75) AS tier_high,
       count(*) FILTER (WHERE s >= 0.5 AND s < 0.75) AS tier_medium,
       count(*) FILTER (WHERE s >= 0.25 AND s < 0.5) AS tier_low,
       count(*) FILTER (WHERE s < 0.25) AS tier_safe,
       CASE WHEN avg(p) > 0.6 THEN 'churn rate too high' WHEN avg(p) < 0.01 THEN 'churn rate too low' END AS anomaly
FROM (SELECT l_discount * 10 AS s, CASE WHEN l_discount * 10 > 0.3 THEN 1.0 ELSE 0.0 END AS p FROM lineitem)""",
       digits=4)
def prediction_health(t: Tables) -> DataFrame:
    from loyaltide.streaming.score import risk_tier

    score = F.col("l_discount") * 10
    scored = t.raw("lineitem").select(
        score.alias("churn_probability"), F.when(score > 0.3, 1.0).otherwise(0.0).alias("prediction"))
    return health.prediction_health(risk_tier(scored))


@query("""
SELECT step, stage, rows, round((rows - lag(rows) OVER (ORDER BY step)) * 100.0
       / lag(rows) OVER (ORDER BY step), 6) AS change_pct
FROM (SELECT 0 AS step, 'lineitem' AS stage, count(*) AS rows FROM lineitem
      UNION ALL SELECT 1, 'orders', count(*) FROM v_orders
      UNION ALL SELECT 2, 'order_wide', count(*) FROM v_wide
      UNION ALL SELECT 3, 'user_features', count(*) FROM v_rfm)""")
def row_lineage(t: Tables) -> DataFrame:
    return health.row_lineage({
        "lineitem": t.raw("lineitem"), "orders": t.raw("orders"), "order_wide": t.wide, "user_features": t.features})


PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
WIDE_CHECKED = {c: False for c in WIDE_COLUMNS}
FEATURES_CHECKED = {c: c == "monetary" for c in FEATURE_COLUMNS}


@query(f"SELECT stage, \"column\", anomaly, {rnd('value')} FROM ("
       + " UNION ALL ".join([
           _health_sql("part", "part", {c: False for c in PART_COLUMNS}, None),
           _health_sql("v_paired", "paired", PAIRED, "part"),
           _health_sql("v_wide", "order_wide", WIDE_CHECKED, "v_paired"),
           _health_sql("v_features", "user_features", FEATURES_CHECKED, "v_wide")]) + ")", views=HEALTH_VIEWS)
def health_check(t: Tables) -> DataFrame:
    return health.health_check(
        {"part": t.raw("part"), "paired": _paired(t), "order_wide": t.wide, "user_features": t.features},
        {"paired": [c for c, critical in PAIRED.items() if critical], "user_features": ["monetary"]})


def _day(t: Tables) -> DataFrame:
    """Orders with their day, month and state."""
    day = F.to_date("o_orderdate")
    return t.raw("orders").select("o_custkey", "o_orderstatus", day.alias("day"))


@query("""
SELECT 'day' AS level, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period, o_orderstatus, count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY ALL
UNION ALL SELECT 'month', strftime(o_orderdate, '%Y-%m'), o_orderstatus, count(DISTINCT o_custkey) FROM orders GROUP BY ALL
UNION ALL SELECT 'year', strftime(o_orderdate, '%Y'), NULL, count(DISTINCT o_custkey) FROM orders GROUP BY ALL
UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT o_custkey) FROM orders""")
def distinct_rollup(t: Tables) -> DataFrame:
    """Distinct customers by day and state, by month and state, by year, and of all, from one stored table of bitmaps."""
    orders = _day(t)
    stored = stage(rollups.distinct_bitmaps(orders, ["day", "o_orderstatus"], "o_custkey",
                                            rollups.numbered_ids(orders, "o_custkey")), "customer-bitmaps")
    months = stored.withColumn("period", F.date_format("day", "yyyy-MM"))
    years = stored.withColumn("period", F.date_format("day", "yyyy"))
    none = F.lit(None).cast("string")
    levels = [
        rollups.distinct_counts(stored, ["day", "o_orderstatus"], "customers").withColumn("period", F.col("day").cast("string"))
        .withColumn("level", F.lit("day")),
        rollups.distinct_counts(months, ["period", "o_orderstatus"], "customers").withColumn("level", F.lit("month")),
        rollups.distinct_counts(years, ["period"], "customers").withColumns({"level": F.lit("year"), "o_orderstatus": none}),
        rollups.distinct_counts(stored, [], "customers").withColumns({"level": F.lit("all"), "period": none, "o_orderstatus": none}),
    ]
    parts = [p.select("level", "period", "o_orderstatus", "customers") for p in levels]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


SKETCHED = ("l_extendedprice", "l_quantity", "l_discount")
SKETCH_CUTS = ("1998-01-01", "2000-01-01")


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) FILTER (l_shipdate < TIMESTAMP '{SKETCH_CUTS[0]}') AS ref_rows,
       count(*) FILTER (l_shipdate >= TIMESTAMP '{SKETCH_CUTS[1]}') AS cur_rows, true AS within FROM lineitem""" for c in SKETCHED))
def sketched_drift(t: Tables) -> DataFrame:
    """Drift between two spans of days from stored sketches, and whether it is within their error of the exact one."""
    lines = t.raw("lineitem").withColumn("day", F.to_date("l_shipdate"))
    stored = stage(sketches.day_sketches(lines, F.trunc("day", "month"), SKETCHED), "sketches")
    low, high = (F.lit(c).cast("date") for c in SKETCH_CUTS)
    before, after = F.col("day") < low, F.col("day") >= high
    psi = sketches.sketched_psi(stored, before, after)
    sizes = [sketches.merged(stored.filter(side)).select("feature", F.col("rows").alias(name))
             for side, name in ((before, "ref_rows"), (after, "cur_rows"))]
    exact = drift.drift_psi(lines.filter(F.col("day") < low), lines.filter(F.col("day") >= high), SKETCHED)
    pair = psi.select("feature", "psi").join(F.broadcast(exact.withColumnRenamed("psi", "exact")), "feature")
    return pair.join(sizes[0], "feature").join(sizes[1], "feature").select(
        "feature", "ref_rows", "cur_rows", (F.abs(F.col("psi") - F.col("exact")) < 0.01).alias("within"))
