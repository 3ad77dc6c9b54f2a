"""Training, evaluating and applying churn models, in batch and as a stream."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import query
from bindings.tables import Tables
from loyaltide.ml import pipeline, train
from loyaltide.ml.areas import areas
from loyaltide.operators import drift
from loyaltide.operators.profile import confusion_matrix
from loyaltide.plans.pipelines import drift_cycle as run_drift_cycle
from loyaltide.plans.staging import scratch_path, stage
from loyaltide.sources import schemas
from loyaltide.streaming import score


# The training part of the customers, as the split's hash has it.
IN_TRAIN = "CAST('0x' || substr(md5(customer_unique_id || '|42'), 1, 8) AS BIGINT) % 10000 < 8000"
NUMERIC = pipeline.NUMERIC_FEATURES


def _slots_sql(rows: str) -> str:
    """slot, feature, column, value: the inputs of a model fitted to ``rows``, in the order of its vector."""
    numeric = [f"SELECT {i} AS slot, '{c}_imputed' AS feature, '{c}' AS source, NULL AS category" for i, c in enumerate(NUMERIC)]
    encoded = [f"""
SELECT {len(NUMERIC)} + {before} + row_number() OVER (ORDER BY count(*) DESC, {c}) - 1, '{c}_idx_ohe_' || {c}, '{c}', {c}
FROM {rows} GROUP BY {c}""" for c, before in zip(pipeline.CATEGORICAL_FEATURES, (
        "0", f"(SELECT count(DISTINCT {pipeline.CATEGORICAL_FEATURES[0]}) FROM {rows})"))]
    return " UNION ALL ".join(numeric + encoded)


SLOT_VIEWS = {
    "v_train": f"SELECT * FROM v_features WHERE {IN_TRAIN}",
    "v_test": f"SELECT * FROM v_features WHERE NOT ({IN_TRAIN})",
    "v_slots": _slots_sql("v_features"), "v_train_slots": _slots_sql("v_train"),
}
VALUE_SQL = "CASE " + " ".join(
    f"WHEN source = '{c}' AND category IS NULL THEN coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM v_features))::DOUBLE"
    for c in NUMERIC) + " " + " ".join(
    f"WHEN source = '{c}' THEN ({c} = category)::INT::DOUBLE" for c in pipeline.CATEGORICAL_FEATURES) + " END"


@query(f"""
SELECT customer_unique_id, CAST(slot AS INTEGER) AS slot, feature, round({VALUE_SQL}, 6) AS value, churn_label
FROM v_features, v_slots""", views=SLOT_VIEWS)
def ml_features(t: Tables) -> DataFrame:
    """The assembled inputs of every customer, slot by slot: medians, and categories by frequency."""
    fitted = Pipeline(stages=pipeline.preprocessing(median_error=0.0)).fit(t.features).transform(t.features)
    names = F.array(*map(F.lit, pipeline.feature_names(fitted)))
    return fitted.select("customer_unique_id", "churn_label", F.posexplode(vector_to_array("features")).alias("slot", "value")) \
        .withColumn("feature", F.get(names, "slot"))


HELD_SQL = """
SELECT '{}' AS classifier, (SELECT count(*) FROM v_train) AS trained, count(*) AS tested,
       CAST(sum(churn_label) AS BIGINT) AS churned, true AS in_range, true AS whole_hits FROM v_test"""


def _trained(t: Tables, kind: str, **options) -> DataFrame:
    """What must hold of a training: its rows, and measures that are shares of them."""
    _, metrics = train.run_training(t.features, kind, **options)
    sides = train.train_test_split(t.features)
    counts = sides[1].agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("churn_label").alias("churned"))).scalar()
    hits = F.col("accuracy") * counts["n"]
    return metrics.select(
        "classifier", sides[0].agg(F.count(F.lit(1))).scalar().alias("trained"), counts["n"].alias("tested"),
        counts["churned"].alias("churned"),
        F.forall(F.array("auc_roc", "auc_pr", "accuracy", "f1", "precision", "recall"), lambda m: m.between(0, 1)).alias("in_range"),
        # The accuracy is rounded to four digits.
        (F.abs(hits - F.round(hits)) <= 0.5e-4 * counts["n"] + 1e-6).alias("whole_hits"))


@query(HELD_SQL.format("gbt"), views=SLOT_VIEWS)
def train_gbt(t: Tables) -> DataFrame:
    return _trained(t, "gbt")


@query(HELD_SQL.format("rf"), views=SLOT_VIEWS)
def train_rf(t: Tables) -> DataFrame:
    return _trained(t, "rf", weighted=True)


@query(HELD_SQL.format("lr"), views=SLOT_VIEWS)
def train_lr(t: Tables) -> DataFrame:
    return _trained(t, "lr")


@query("""
SELECT reg_param, elastic_net_param, (SELECT count(*) FROM v_train) AS customers, true AS in_range, true AS best_is_largest
FROM (SELECT unnest([0.001, 0.01, 0.1])::DOUBLE AS reg_param), (SELECT unnest([0.0, 0.5, 1.0])::DOUBLE AS elastic_net_param)""",
       views=SLOT_VIEWS)
def train_cv(t: Tables) -> DataFrame:
    """The grid of a cross-validation by customer, with what must hold of its scores."""
    rows = train.train_test_split(t.features)[0]
    table = stage(train.search(rows, "lr")[1], "grid")
    most = table.agg(F.max("mean_auc_roc")).scalar()
    return table.select(
        F.col("parameters.regParam").alias("reg_param"), F.col("parameters.elasticNetParam").alias("elastic_net_param"),
        rows.agg(F.count(F.lit(1))).scalar().alias("customers"),
        (F.col("mean_auc_roc").between(0, 1) & F.col("std_auc_roc").between(0, 0.5)).alias("in_range"),
        (F.col("best") == (F.col("mean_auc_roc") == most)).alias("best_is_largest"))


@query("""
SELECT CAST(CAST('0x' || substr(md5(customer_unique_id || '|fold 42'), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold,
       count(*) AS customers, CAST(sum(churn_label) AS BIGINT) AS churned
FROM v_train GROUP BY 1""", views=SLOT_VIEWS)
def cv_folds(t: Tables) -> DataFrame:
    rows = train.with_fold(train.train_test_split(t.features)[0])
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("customers"), F.sum("churn_label").alias("churned"))


@query("""
SELECT round(sum(n * (tp - p / 2.0)) / (sum(p) * sum(n)), 6) AS auc_roc,
       round(sum(p * (tp / (tp + fp) + coalesce(before, tp / (tp + fp))) / 2) / sum(p), 6) AS auc_pr
FROM (SELECT *, lag(tp / (tp + fp)) OVER (ORDER BY score DESC) AS before FROM (
  SELECT *, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp FROM (
    SELECT n_chars % 500 AS score, sum(quality)::DOUBLE AS p, sum(1 - quality)::DOUBLE AS n
    FROM documents JOIN labels USING (doc_id) GROUP BY 1)))""")
def exact_areas(t: Tables) -> DataFrame:
    """Areas under both curves of a score with many ties."""
    scored = t.raw("documents").join(t.raw("labels"), "doc_id").withColumn("score", F.col("n_chars") % 500)
    return areas(scored, "score", "quality")


@query("""
SELECT customer_unique_id, CASE WHEN CAST('0x' || substr(md5(customer_unique_id || '|42'), 1, 8) AS BIGINT) % 10000 < 8000
  THEN 'train' ELSE 'test' END AS split
FROM v_features""")
def train_test_split(t: Tables) -> DataFrame:
    return train.with_split(t.features).select("customer_unique_id", "split")


@query("""
SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall
FROM (
  SELECT sum(tp) / sum(actual) AS accuracy, sum(actual * 2 * p * r / (p + r)) / sum(actual) AS f1,
         sum(actual * p) / sum(actual) AS precision, sum(actual * r) / sum(actual) AS recall
  FROM (SELECT actual, tp, tp / predicted AS p, tp / actual AS r FROM (
    SELECT count(*) FILTER (WHERE quality = c) AS actual, count(*) FILTER (WHERE toxic = c) AS predicted,
           count(*) FILTER (WHERE quality = c AND toxic = c) AS tp
    FROM labels, (SELECT unnest([0, 1]) AS c) GROUP BY c)))""")
def eval_metrics(t: Tables) -> DataFrame:
    return train.count_metrics(confusion_matrix(t.raw("labels"), "quality", "toxic"), "quality", "toxic")


@query("SELECT feature, true AS in_range, true AS add_up FROM v_train_slots", views=SLOT_VIEWS)
def feature_importance(t: Tables) -> DataFrame:
    """Every input of a forest, with what must hold of its importance."""
    model = train.fit(train.train_test_split(t.features)[0], "rf")
    ranked = stage(pipeline.feature_importance(model, model.transform(t.features), 10_000), "importances")
    return ranked.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                         (F.abs(ranked.agg(F.sum("importance")).scalar() - 1) < 1e-6).alias("add_up"))


def _model(t: Tables):
    return train.fit(train.train_test_split(t.features)[0], "lr")


def _fits() -> list:
    """Does a row's tier, and its prediction, follow from its probability?"""
    p = F.col("churn_probability")
    tier = F.when(p >= 0.75, "HIGH").when(p >= 0.5, "MEDIUM").when(p >= 0.25, "LOW").otherwise("SAFE")
    return [(F.col("risk_tier") == tier).alias("tier_fits"), ((F.col("prediction") == 1) == (p > 0.5)).alias("prediction_fits")]


@query("SELECT customer_unique_id, churn_label, true AS tier_fits, true AS prediction_fits FROM v_features")
def batch_score(t: Tables) -> DataFrame:
    return score.batch_score(t.features, _model(t)).select("customer_unique_id", "churn_label", *_fits())


@query("SELECT count(*) AS customers, CAST(0 AS DOUBLE) AS largest_gap FROM v_features")
def model_roundtrip(t: Tables) -> DataFrame:
    """Largest difference between the scores of a model and of its saved and loaded copy."""
    model, path = _model(t), scratch_path(t.spark, "model")
    pipeline.save_model(model, path)
    scores = [
        score.batch_score(t.features, m).select("customer_unique_id", F.col("churn_probability").alias(name))
        for m, name in ((model, "before"), (pipeline.load_model(path), "after"))]
    return scores[0].join(scores[1], "customer_unique_id").agg(
        F.count(F.lit(1)).alias("customers"), F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_gap"))


def _landing(t: Tables, files: int | None = None) -> str:
    """Every click event with its customer's features, as files of a landing folder; at most ``files`` if given."""
    events = t.events.select(
        F.col("visitorid").alias("customer_unique_id"), F.col("event_time").cast("timestamp").alias("event_timestamp"),
        F.col("event").alias("event_type"), F.col("itemid").alias("item_id"), F.col("value").alias("price"))
    rows = events.join(t.features, "customer_unique_id", "left")
    path = scratch_path(t.spark, "landing")
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STREAM_EVENT])
    (rows.coalesce(files) if files else rows).write.parquet(path)
    return path


def _scored_stream(t: Tables, files: int | None = None) -> str:
    """Score the landing folder to the end and give the path of the predictions."""
    scored = score.stream_score(score.event_source(t.spark, _landing(t, files)), _model(t))
    path = scratch_path(t.spark, "predictions")
    score.start_sink(scored, path, scratch_path(t.spark, "checkpoint"), available_now=True).awaitTermination()
    return path


STREAMED_SQL = """
SELECT CAST(user_id AS VARCHAR) AS customer_unique_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event_type,
       true AS tier_fits, true AS prediction_fits
FROM events"""
STREAMED = ("customer_unique_id", "event_timestamp", "event_type")


@query(STREAMED_SQL)
def stream_score(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_scored_stream(t)).select(*STREAMED, *_fits())


@query(f"{STREAMED_SQL} ORDER BY CAST(user_id AS VARCHAR), ts LIMIT 100")
def stream_recent_predictions(t: Tables) -> DataFrame:
    """The newest of one micro-batch: all its rows are of one moment, so customers and times decide."""
    return score.recent_predictions(t.spark, _scored_stream(t, files=4), 100).select(*STREAMED, *_fits())


@query("SELECT count(*) AS events, CAST(0 AS BIGINT) AS unmatched FROM events")
def stream_matches_batch(t: Tables) -> DataFrame:
    """Events scored by the stream, and those whose tier and prediction the batch scores otherwise."""
    landing, model, path = _landing(t), _model(t), scratch_path(t.spark, "predictions")
    streamed = score.stream_score(score.event_source(t.spark, landing), model)
    score.start_sink(
        streamed, path, scratch_path(t.spark, "checkpoint"), available_now=True).awaitTermination()
    columns = ["customer_unique_id", "event_timestamp", "event_type", "prediction", "risk_tier"]
    batch = score.batch_score(t.spark.read.parquet(landing), model).select(*columns)
    both = t.spark.read.parquet(path).select(*columns, F.lit(1).alias("n")).unionByName(
        batch.withColumn("n", F.lit(-1)))
    per_event = both.groupBy(*columns).agg(
        F.sum("n").alias("surplus"), F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("streamed"))
    return per_event.agg(
        F.sum("streamed").alias("events"), F.sum(F.abs("surplus")).alias("unmatched"))


@query("SELECT count(*) AS predictions FROM events")
def stream_health_total(t: Tables) -> DataFrame:
    """Predictions counted by the health records of all batches."""
    counted = stream_health(t).filter(F.col("metric") == "total_predictions")
    return counted.agg(F.sum("value").cast("bigint").alias("predictions"))


@query()
def stream_health(t: Tables) -> DataFrame:
    scored = score.stream_score(score.event_source(t.spark, _landing(t)), _model(t))
    path = scratch_path(t.spark, "stream-health")
    score.start_health(scored, path, scratch_path(t.spark, "checkpoint"), available_now=True).awaitTermination()
    return t.spark.read.parquet(path).select("batch", "metric", "value")


@query("""
SELECT CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2024-02-01') AS INTEGER) AS model_age_days,
       date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2024-02-01') >= 30 AS retrain,
       true AS reason_fits, true AS trained
FROM orders""")
def drift_cycle(t: Tables) -> DataFrame:
    """Drift between customers by a hash split, and a training on the current rows, as the model is old: what must hold."""
    rows = t.features.drop("customer_unique_id")
    reference, current = drift.hash_split(t.features, "customer_unique_id")
    outcome = run_drift_cycle(
        reference.select(*rows.columns), current.select(*rows.columns),
        lambda current_rows: train.run_training(current, "lr")[1],
        trained=stage(t.raw("orders").select(F.max("o_orderdate").alias("recorded_at")), "trainings"),
        as_of=F.lit("2024-02-01").cast("date"))
    reason = F.when(F.col("drifted") >= 3, "drifted features").when(F.col("drift_rate") >= 0.2, "drift rate").when(
        F.abs("label_drift") >= 0.05, "label drift").when(F.col("model_age_days") >= 30, "model age").otherwise("none")
    return outcome.select("model_age_days", "retrain", (F.col("reason") == reason).alias("reason_fits"),
                          F.coalesce(F.col("metrics.auc_roc").between(0, 1), F.lit(False)).alias("trained"))
