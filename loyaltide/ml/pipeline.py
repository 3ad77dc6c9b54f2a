"""Preprocessing and classifier stages for churn prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame

LABEL = "churn_label"
FEATURES = "features"

# Model inputs. Recency is left out because it defines the label.
NUMERIC_FEATURES = (
    "frequency", "avg_items_per_order", "total_items_purchased", "monetary", "avg_order_value",
    "spend_trend", "avg_review_score", "std_review_score", "min_review_score", "avg_installments",
    "avg_freight_ratio", "weekend_purchase_ratio", "avg_purchase_hour", "avg_categories_per_order",
    "avg_delivery_delay", "max_delivery_delay", "total_freight", "high_value_customer",
    "is_repeat_buyer",
)
CATEGORICAL_FEATURES = ("customer_state", "primary_payment_type")

# Classifier parameters.
SEED = 42
GBT = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": SEED}
FOREST = {"numTrees": 100, "maxDepth": 8, "featureSubsetStrategy": "sqrt", "seed": SEED}
LOGISTIC = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5, "family": "binomial"}

# Parameters searched in cross-validation.
GRIDS = {
    "gbt": {"maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1, 0.2]},
    "rf": {"numTrees": [50, 100, 200], "maxDepth": [5, 8]},
    "lr": {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
}


def classifier(kind: str, weight_col: str | None = None):
    """A gradient-boosted tree, random forest or logistic regression classifier."""
    makers = {"gbt": (GBTClassifier, GBT), "rf": (RandomForestClassifier, FOREST),
              "lr": (LogisticRegression, LOGISTIC)}
    if kind not in makers:
        raise ValueError(f"unknown classifier {kind}: choose gbt, rf or lr")
    maker, params = makers[kind]
    weights = {"weightCol": weight_col} if weight_col else {}
    return maker(featuresCol=FEATURES, labelCol=LABEL, **params, **weights)


def preprocessing(numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
                  scaled: bool = False, median_error: float = 0.001) -> list:
    """Median imputation, one-hot encoding by frequency and assembly; scaling by deviation if asked for.

    ``median_error`` is the share of rows by which a median's rank may be off; 0 is exact.
    """
    imputed = [f"{c}_imputed" for c in numeric]
    indexed = [f"{c}_idx" for c in categorical]
    encoded = [f"{c}_ohe" for c in indexed]
    stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=imputed, relativeError=median_error)]
    if categorical:
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                          stringOrderType="frequencyDesc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
    assembled = "raw_features" if scaled else FEATURES
    stages.append(VectorAssembler(inputCols=imputed + encoded, outputCol=assembled, handleInvalid="skip"))
    if scaled:
        stages.append(StandardScaler(inputCol=assembled, outputCol=FEATURES, withStd=True, withMean=False))
    return stages


def build_pipeline(kind: str = "gbt", numeric: Sequence[str] = NUMERIC_FEATURES,
                   categorical: Sequence[str] = CATEGORICAL_FEATURES, weight_col: str | None = None) -> Pipeline:
    """Preprocessing and classifier; only logistic regression needs scaled inputs."""
    return Pipeline(stages=[*preprocessing(numeric, categorical, scaled=kind == "lr"),
                            classifier(kind, weight_col)])


def param_grid(estimator, kind: str):
    grid = ParamGridBuilder()
    for name, values in GRIDS[kind].items():
        grid = grid.addGrid(estimator.getParam(name), values)
    return grid.build()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(scored: DataFrame) -> list[str]:
    """Name of each slot of the feature vector, one-hot slots included, from the column's metadata."""
    groups = scored.schema["raw_features" if "raw_features" in scored.columns else FEATURES].metadata["ml_attr"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups["attrs"].values() for a in attrs)
    return [name for _, name in slots]


def feature_importance(model: PipelineModel, scored: DataFrame, top_n: int = 20) -> DataFrame:
    """The most important features by rank; no rows for a model that has no importances."""
    spark = scored.sparkSession
    weights = getattr(model.stages[-1], "featureImportances", None)
    # One entry per feature slot.
    named = [] if weights is None else list(zip(feature_names(scored), weights.toArray().tolist()))
    named.sort(key=lambda entry: (-entry[1], entry[0]))
    rows = [(rank, name, weight) for rank, (name, weight) in enumerate(named[:top_n], 1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")
