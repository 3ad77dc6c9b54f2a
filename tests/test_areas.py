import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loyaltide.ml import train
from loyaltide.ml.areas import areas


def frame(spark, rows):
    return spark.createDataFrame(rows, "score double, label double")


@pytest.mark.parametrize("values", [3, 40, 10**9])
def test_areas_are_those_of_the_library_without_thinning(spark, values):
    rng = random.Random(values)
    rows = [(float(rng.randrange(values)), float(rng.random() < .3)) for _ in range(3_000)]
    df = frame(spark, [(s + (1 if label else 0) * values / 5, label) for s, label in rows])
    got = areas(df).first()
    for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
        wanted = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0).evaluate(df)
        assert abs(got[name] - wanted) < 1e-6


def test_ties_nulls_and_one_kind_of_label(spark):
    assert areas(frame(spark, [(1.0, 1.0), (1.0, 0.0)])).first().auc_roc == 0.5
    assert tuple(areas(frame(spark, [(2.0, 1.0), (1.0, 0.0), (None, 1.0), (3.0, None)])).first()) == (1.0, 1.0)
    assert tuple(areas(frame(spark, [(1.0, 0.0), (2.0, 0.0)])).first()) == (None, None)
    assert tuple(areas(frame(spark, [])).first()) == (None, None)
    assert areas(frame(spark, [(math.nan, 1.0), (5.0, 0.0)])).first().auc_roc == 1.0


def test_folds_keep_a_key_together_and_do_not_depend_on_partitions(spark, rows):
    df = spark.range(900).select((F.col("id") % 300).cast("string").alias("customer_unique_id"), "id")
    one, other = (rows(train.with_fold(d)) for d in (df.repartition(1), df.repartition(9)))
    assert one == other and {r[-1] for r in one} == {0, 1, 2}
    assert len({(r[0], r[-1]) for r in one}) == 300
    assert max(sum(r[-1] == f for r in one) for f in range(3)) < 450


def test_the_grid_is_given_back(tables):
    grid = train.param_grid(train.build_pipeline("lr").getStages()[-1], "lr")[:2]
    model, table = train.search(tables.features, "lr", folds=2, grid=grid)
    found = table.collect()
    assert len(found) == 2 and [r.best for r in found].count(True) >= 1
    assert max(found, key=lambda r: r.mean_auc_roc).best and all(set(r.parameters) == {"regParam", "elasticNetParam"} for r in found)
    assert model.stages
