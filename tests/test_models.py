import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.queries_models import _landing
from loyaltide.ml import pipeline, train
from loyaltide.ml.pipeline import build_pipeline
from loyaltide.plans.staging import scratch_path
from loyaltide.streaming import score


@pytest.fixture(scope="module")
def model(tables):
    return train.fit(tables.features, "lr")


def test_recency_is_no_model_input():
    assert "recency_days" not in pipeline.NUMERIC_FEATURES
    assert len(pipeline.NUMERIC_FEATURES) == 19


def test_unknown_classifier():
    with pytest.raises(ValueError):
        pipeline.classifier("svm")


def test_grids(spark):
    assert {k: len(pipeline.param_grid(pipeline.classifier(k), k)) for k in pipeline.GRIDS} == {
        "gbt": 9, "rf": 6, "lr": 9}


def test_split_does_not_depend_on_partitions(tables, rows):
    df = tables.features.select("customer_unique_id")
    assert rows(train.train_test_split(df.repartition(1))[0]) == rows(train.train_test_split(df.repartition(7))[0])
    parts = train.train_test_split(df)
    assert sum(p.count() for p in parts) == df.count()


def test_importances_are_named_through_the_encoding(tables):
    forest = train.fit(tables.features, "rf")
    ranked = pipeline.feature_importance(forest, forest.transform(tables.features), 100).collect()
    names = [r.feature for r in ranked]
    assert "monetary_imputed" in names
    assert any(n.startswith("customer_state_idx_ohe_") for n in names)
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert abs(sum(r.importance for r in ranked) - 1) < 1e-6


def test_no_importances_for_regression(tables, model):
    assert pipeline.feature_importance(model, model.transform(tables.features)).isEmpty()


def test_weighted_training(tables):
    assert train.fit(tables.features, "lr", weighted=True).stages[-1].getWeightCol() == "sample_weight"


def test_count_metrics_of_a_class_never_predicted(spark):
    cm = spark.createDataFrame([(0, 0.0, 6), (1, 0.0, 4)], "churn_label int, prediction double, count long")
    row = train.count_metrics(cm).first()
    assert [round(v, 4) for v in row] == [0.6, 0.45, 0.36, 0.6]


def test_scoring_runs_without_python(tables, model, plan):
    text = plan(score.batch_score(tables.features, model))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_tiers_at_their_bounds(spark):
    df = spark.createDataFrame([(0.75,), (0.5,), (0.25,), (0.2499,), (None,)], "churn_probability double")
    assert [r.risk_tier for r in score.risk_tier(df).collect()] == ["HIGH", "MEDIUM", "LOW", "SAFE", "SAFE"]
    broken = spark.createDataFrame([(float("nan"),)], "churn_probability double")
    assert score.risk_tier(broken).first().risk_tier == "SAFE"


def test_stream_equals_batch_and_restart_adds_nothing(spark, tables, model, rows):
    landing, out, checkpoint = _landing(tables), scratch_path(spark, "out"), scratch_path(spark, "checkpoint")

    def run():
        scored = score.stream_score(score.event_source(spark, landing), model)
        score.start_sink(scored, out, checkpoint, available_now=True).awaitTermination()
        return spark.read.parquet(out).select("customer_unique_id", "event_timestamp", "prediction", "risk_tier")

    batch = score.batch_score(spark.read.parquet(landing), model).select(
        "customer_unique_id", "event_timestamp", "prediction", "risk_tier")
    expected = rows(batch)
    assert rows(run()) == expected
    assert rows(run()) == expected
    recent = score.recent_predictions(spark, out, 5).collect()
    assert len(recent) == 5


def test_described_sink_and_checks(spark, tables, model):
    scored = score.stream_score(score.event_source(spark, _landing(tables)), model)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    sink = score.Sink("json", {"compression": "gzip"}, ())
    score.start_sink(scored, out, checkpoint, sink, available_now=True).awaitTermination()
    assert spark.read.json(out).count() == tables.events.count()
    with pytest.raises(ValueError):
        score.stream_score(spark.readStream.format("rate").load(), model)


def test_vector_probability_is_the_positive_class(tables, model):
    scored = score.batch_score(tables.features, model)
    gap = scored.select(F.max(F.abs(F.col("churn_probability") + vector_to_array("probability")[0] - 1))).first()[0]
    assert gap < 1e-9


def test_grid_search_fits_the_preprocessing_once_a_fold(tables, monkeypatch):
    from pyspark.ml.feature import Imputer

    fitted, plain = [], Imputer._fit
    monkeypatch.setattr(Imputer, "_fit", lambda self, rows: fitted.append(1) or plain(self, rows))
    estimator = build_pipeline("lr").getStages()[-1]
    grid = [{estimator.maxIter: 1, estimator.regParam: r} for r in (0.01, 0.1)]
    model, table = train.search(tables.features, "lr", folds=2, grid=grid)
    assert len(fitted) == 3  # two folds, and all rows for the best model
    assert table.count() == 2 and model.transform(tables.features).count() == tables.features.count()
