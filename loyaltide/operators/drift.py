"""Distribution drift between a reference and a current table, and the retrain decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loyaltide.functions.columns import as_list, numeric_columns, quoted, string_columns, total
from loyaltide.functions.quantiles import column_quantiles, with_bucket
from loyaltide.plans.staging import stage

# Status limits, smallest bin share, and the retrain thresholds.
WARNING_FROM = 0.10
DRIFT_FROM = 0.20
SMALLEST_SHARE = 1e-6
BINS = 10
MEAN_SHIFT = 0.1
MAX_DRIFTED_FEATURES = 3
MAX_DRIFT_RATE = 0.20
MAX_LABEL_DRIFT = 0.05
MAX_MODEL_AGE_DAYS = 30

# Buckets (a power of two) and sketch accuracy of the KS statistic: they set the work, not the result.
KS_BUCKETS = 1024
KS_ACCURACY = 5_000


def reference_current_split(df: DataFrame, time_col: str, cut: Column) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut and rows from the cut on."""
    return df.filter(F.col(time_col) < cut), df.filter(F.col(time_col) >= cut)


def hash_split(df: DataFrame, key: str | Sequence[str], share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same at every run, and keeps a key's rows together."""
    low = F.pmod(F.xxhash64(*as_list(key)), F.lit(10_000)) < round(share * 10_000)
    return df.filter(low), df.filter(~low)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def _both(reference: DataFrame, current: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    sides = [df.select(F.lit(i).alias("side"), *columns) for i, df in enumerate((reference, current))]
    return sides[0].unionByName(sides[1])


def _long(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(side, feature, value) of both tables; NaN stays, above all numbers."""
    both = _both(reference, current, [F.col(c).cast("double").alias(c) for c in columns])
    return both.unpivot(["side"], list(columns), "feature", "value")


def _side(number: int) -> Column:
    """Condition for rows of the reference (0) or the current table (1)."""
    return F.col("side") == number


def _rows(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _share(rows: Column, all_rows: Column) -> Column:
    return F.when(all_rows > 0, rows / all_rows).otherwise(0.0)


def drift_psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS,
              count_nulls: bool = False, accuracy: int | None = None) -> DataFrame:
    """Population stability index per column.

    Bin edges are the reference quantiles without repeats; a column with fewer
    than two edges scores 0. Shares are of all rows, so nulls lower every bin;
    ``count_nulls`` gives them a bin of their own. All bins of all columns are
    counted in one pass, and a bin without rows still counts with the smallest
    share.
    """
    points = [i / bins for i in range(1, bins)]
    edges = column_quantiles(reference, columns, points, accuracy).select(
        "feature", F.array_sort(F.array_distinct("quantiles")).alias("edges"))
    above = total([F.when(F.col("value") > F.get("edges", F.lit(i)), 1).otherwise(0) for i in range(bins - 1)])
    # The edges have one row per column, the counts one per column and bin.
    counted = (
        _long(reference, current, columns).join(F.broadcast(edges), "feature")
        .withColumn("bin", F.when(F.col("value").isNotNull(), above).otherwise(-1))
        .groupBy("feature", "bin").agg(_rows(_side(0)).alias("ref_rows"), _rows(_side(1)).alias("cur_rows"))
    )
    feature = Window.partitionBy("feature")
    first_bin = -1 if count_nulls else 0
    all_bins = edges.select(
        "feature", F.coalesce(F.size("edges"), F.lit(0)).alias("edge_count"),
        F.explode(F.sequence(F.lit(-1), F.coalesce(F.size("edges"), F.lit(0)))).alias("bin"))
    filled = (
        all_bins.join(F.broadcast(counted), ["feature", "bin"], "left").fillna(0, ["ref_rows", "cur_rows"])
        .withColumns({
            "ref_share": _share(F.col("ref_rows"), F.sum("ref_rows").over(feature)),
            "cur_share": _share(F.col("cur_rows"), F.sum("cur_rows").over(feature)),
        })
        .withColumns({s: F.greatest(s, F.lit(SMALLEST_SHARE)) for s in ("ref_share", "cur_share")})
    )
    term = (F.col("cur_share") - F.col("ref_share")) * F.ln(F.col("cur_share") / F.col("ref_share"))
    counts = (F.col("edge_count") > 1) & (F.col("bin") >= first_bin)
    return filled.groupBy("feature").agg(F.round(F.sum(F.when(counts, term).otherwise(0.0)), 6).alias("psi"))


def drift_quantile_gap(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                       accuracy: int | None = None) -> DataFrame:
    """Largest distance of the 5% .. 95% quantiles, in units of the reference's quantile range."""
    points = [i / 100 for i in range(5, 100, 5)]
    # Every column twice, with the other side's rows null: both sides are read, counted and ranked together.
    names = {side: [f"{side}:{c}" for c in columns] for side in ("ref", "cur")}
    both = None
    for side, df in (("ref", reference), ("cur", current)):
        own = [quoted(c).cast("double") for c in columns]
        none = [F.lit(None).cast("double")] * len(columns)
        rows = df.select(*[v.alias(n) for v, n in zip(own if side == "ref" else none, names["ref"])],
                         *[v.alias(n) for v, n in zip(own if side == "cur" else none, names["cur"])])
        both = rows if both is None else both.unionByName(rows)
    found = column_quantiles(both, [*names["ref"], *names["cur"]], points, accuracy)
    sides = found.groupBy(F.substring("feature", 5, 1 << 30).alias("feature")).agg(
        *[F.max(F.when(F.col("feature").startswith(f"{s}:"), F.col("quantiles"))).alias(s) for s in ("ref", "cur")])
    spread = F.array_max("ref") - F.array_min("ref")
    gaps = F.zip_with("ref", "cur", lambda r, c: F.abs(c - r))
    gap = F.array_max(gaps) / F.when(spread != 0, spread).otherwise(1.0)
    return sides.select("feature", F.round(F.coalesce(gap, F.lit(0.0)), 6).alias("quantile_gap"))


def drift_ks(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic: the largest distance of the two empirical CDFs.

    Rows are first only counted per bucket of values, which gives the distance at
    every bucket's end and a limit to what it can reach inside. Values are
    shuffled, grouped and accumulated only for buckets whose limit lies above the
    best distance known by then. The buckets are even shares of the rows of both
    tables, so no task sees a whole column; a value of many rows is one row
    after grouping.
    """
    edges = stage(column_quantiles(
        _both(reference, current, columns), columns, [i / KS_BUCKETS for i in range(1, KS_BUCKETS)], KS_ACCURACY,
    ).filter(F.col("quantiles").isNotNull()).withColumnRenamed("quantiles", "edges"), "ks-edges")
    known = _long(reference, current, columns).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    placed = with_bucket(known.join(F.broadcast(edges), "feature"), F.col("value"), KS_BUCKETS).drop("edges")

    # At most KS_BUCKETS rows per column from here to the contenders.
    before = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    feature = Window.partitionBy("feature")
    spans = placed.groupBy("feature", "bucket").agg(
        _rows(_side(0)).alias("ref_in"), _rows(_side(1)).alias("cur_in")
    ).select("feature", "bucket", *[
        column for s in ("ref", "cur") for column in (
            F.sum(f"{s}_in").over(feature).alias(f"{s}_all"),
            F.coalesce(F.sum(f"{s}_in").over(before), F.lit(0)).alias(f"{s}_before"),
            F.col(f"{s}_in"))
    ]).filter((F.col("ref_all") > 0) & (F.col("cur_all") > 0))
    start = F.col("ref_before") / F.col("ref_all") - F.col("cur_before") / F.col("cur_all")
    ref_step, cur_step = F.col("ref_in") / F.col("ref_all"), F.col("cur_in") / F.col("cur_all")
    spans = stage(
        spans.withColumns({
            "limit": F.greatest(F.abs(start + ref_step), F.abs(start - cur_step)),
            "at_end": F.abs(start + ref_step - cur_step)})
        .withColumn("best", F.max("at_end").over(feature)), "ks-buckets")

    contenders = F.broadcast(spans.filter(F.col("limit") > F.col("best")))
    values = placed.join(contenders, ["feature", "bucket"], "left_semi").groupBy("feature", "bucket", "value").agg(
        _rows(_side(0)).alias("ref_rows"), _rows(_side(1)).alias("cur_rows"))
    upto = Window.partitionBy("feature", "bucket").orderBy("value")
    reached = values.select("feature", "bucket", *[F.sum(f"{s}_rows").over(upto).alias(s) for s in ("ref", "cur")])
    cdf = {s: (F.col(f"{s}_before") + F.col(s)) / F.col(f"{s}_all") for s in ("ref", "cur")}
    inside = reached.join(contenders, ["feature", "bucket"]).select(
        "feature", F.abs(cdf["ref"] - cdf["cur"]).alias("gap"))
    ends = spans.select("feature", F.col("best").alias("gap"))
    # A column without values on one side has no distance, but a row.
    all_columns = reference.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return ends.unionByName(inside).unionByName(all_columns.withColumn("gap", F.lit(None).cast("double"))) \
        .groupBy("feature").agg(F.round(F.max("gap"), 6).alias("ks"))


def drift_categorical(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Half the summed difference of category shares, per column; null is a category.

    Grouping both sides together by (column, category) lines the shares up as a
    null-safe full outer join would, with one shuffle of counts and no join.
    """
    both = _both(reference, current, [F.col(c).cast("string").alias(c) for c in columns])
    long = both.unpivot(["side"], list(columns), "feature", "category")
    counted = long.groupBy("feature", "category").agg(
        _rows(_side(0)).alias("ref_rows"), _rows(_side(1)).alias("cur_rows"))
    sizes = both.agg(F.struct(_rows(_side(0)).alias("ref"), _rows(_side(1)).alias("cur"))).scalar()
    gap = F.abs(_share(F.col("ref_rows"), sizes["ref"]) - _share(F.col("cur_rows"), sizes["cur"]))
    return counted.groupBy("feature").agg(F.round(F.sum(gap) / 2, 6).alias("distance"))


def drift_label(reference: DataFrame, current: DataFrame, label_col: str = "churn_label") -> DataFrame:
    """Rate of positive labels on both sides and its shift; null for an empty side."""
    positive = F.when(F.col(label_col) == 1, 1.0).otherwise(0.0)
    both = _both(reference, current, [positive.alias("positive")])
    return both.agg(
        F.avg(F.when(_side(0), F.col("positive"))).alias("ref_rate"),
        F.avg(F.when(_side(1), F.col("positive"))).alias("cur_rate"),
    ).withColumn("label_drift", F.round(F.col("cur_rate") - F.col("ref_rate"), 6))


def drift_moments(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and standard deviation of both sides per column, in one aggregation."""
    return _long(reference, current, columns).groupBy("feature").agg(*[
        measure(F.when(side, F.col("value"))).alias(f"{name}_{label}")
        for name, side in (("ref", _side(0)), ("cur", _side(1)))
        for label, measure in (("mean", F.avg), ("std", F.stddev))
    ])


def drift_mean_shift(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                     threshold: float = MEAN_SHIFT) -> DataFrame:
    """Relative shift of the mean; a null or zero reference mean gives no verdict."""
    shift = F.when(F.col("ref_mean") != 0, F.abs(F.col("cur_mean") - F.col("ref_mean")) / F.abs("ref_mean"))
    return drift_moments(reference, current, columns).select(
        "feature", "ref_mean", "cur_mean", shift.alias("shift"),
        F.coalesce(shift > threshold, F.lit(False)).alias("drifted"))


def drift_status(score: Column) -> Column:
    return F.when(score >= DRIFT_FROM, "DRIFT").when(score >= WARNING_FROM, "WARNING").otherwise("SAFE")


def drift_report(reference: DataFrame, current: DataFrame, numeric: Sequence[str] | None = None,
                 categorical: Sequence[str] | None = None, label_col: str = "churn_label",
                 accuracy: int | None = None) -> DataFrame:
    """One row per column common to both tables: method, score, status and moments.

    Numeric columns are scored by PSI, strings by the categorical distance.
    """
    shared = [c for c in reference.columns if c in current.columns]
    numeric = [c for c in numeric_columns(reference, [label_col]) if c in shared] if numeric is None else numeric
    categorical = [c for c in string_columns(reference) if c in shared] if categorical is None else categorical
    if not numeric and not categorical:
        raise ValueError("the two tables share no numeric or string column")
    parts = []
    if numeric:
        # One row per column on both sides.
        parts.append(
            drift_psi(reference, current, numeric, accuracy=accuracy)
            .join(F.broadcast(drift_moments(reference, current, numeric)), "feature")
            .withColumnsRenamed({"psi": "score"}).withColumn("method", F.lit("psi")))
    if categorical:
        parts.append(
            drift_categorical(reference, current, categorical)
            .withColumnsRenamed({"distance": "score"}).withColumn("method", F.lit("cat")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part, allowMissingColumns=True)
    for moment in ("ref_mean", "ref_std", "cur_mean", "cur_std"):
        if moment not in report.columns:
            report = report.withColumn(moment, F.lit(None).cast("double"))
    return report.select(
        "feature", "method", "score", drift_status(F.col("score")).alias("status"),
        "ref_mean", "cur_mean", "ref_std", "cur_std")


def retrain_decision(report: DataFrame, label: DataFrame | None = None, trained: DataFrame | None = None,
                     as_of: Column | None = None, max_drifted: int = MAX_DRIFTED_FEATURES,
                     max_rate: float = MAX_DRIFT_RATE, max_label_drift: float = MAX_LABEL_DRIFT,
                     max_age_days: int = MAX_MODEL_AGE_DAYS) -> DataFrame:
    """Whether to retrain, and the first reason that applies.

    ``label`` is a :func:`drift_label` row. ``trained`` holds the times of past
    trainings in ``recorded_at``; the newest gives the model's age at ``as_of``.
    """
    facts = report.agg(
        F.count(F.lit(1)).alias("features"),
        _rows(F.col("status") == "DRIFT").alias("drifted"),
    ).withColumn("drift_rate", _share(F.col("drifted"), F.col("features")))
    shift = label.agg(F.max("label_drift")).scalar() if label is not None else F.lit(None)
    age = (
        F.datediff(as_of if as_of is not None else F.current_timestamp(),
                   trained.agg(F.max("recorded_at")).scalar())
        if trained is not None else F.lit(None))
    reason = (
        F.when(F.col("drifted") >= max_drifted, "drifted features")
        .when(F.col("drift_rate") >= max_rate, "drift rate")
        .when(F.abs("label_drift") >= max_label_drift, "label drift")
        .when(F.col("model_age_days") >= max_age_days, "model age")
    )
    return (
        facts.withColumns({"label_drift": shift.cast("double"), "model_age_days": age.cast("int")})
        .withColumn("reason", reason)
        .withColumn("retrain", F.col("reason").isNotNull())
        .withColumn("reason", F.coalesce("reason", F.lit("none")))
    )
