"""Column quantiles, as values that occur in the data (inverse of the empirical CDF).

Two methods share one result, ``(feature, quantiles array<double>)``:

* ``accuracy=None`` is exact at any size. A first pass brackets each quantile
  with a small sketch. A second pass counts the values inside the brackets, a
  fixed small share of the rows, and stores these counts. They are dealt over
  buckets, up to a thousand to a bracket by their number, and a task ranks one.
* ``accuracy=n`` reads the data once and answers from the sketch alone, with a
  rank error of at most ``rows / n``.

A column's sketches are merged in one task, so their accuracy is kept far below
the row count: asking them for exact answers would move the whole column there.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loyaltide.functions.columns import LONG_DIGITS, finite_double, quoted, total
from loyaltide.plans.staging import stage

BRACKET_ACCURACY = 5_000
RANK_BUCKETS = 1024  # a power of two: parts of a bracket, at most, of which only those with a wanted rank are ranked
BUCKET_VALUES = 1 << 16  # different values of a bracket for which it is cut in one more part


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int | None = None,
) -> DataFrame:
    """One row per column; ``quantiles`` follows the order of ``probabilities``.

    Nulls and NaN are left out. A column without values gets null.
    """
    found = _quantiles(df, columns, probabilities, accuracy)
    return found.withColumn("quantiles", F.transform("quantiles", lambda q: q["number"]))


def _quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
               accuracy: int | None) -> DataFrame:
    """Quantiles as structs: ``number`` is a double, ``whole`` the same value of a long column with all its digits, or
    of a decimal column the digits without the point.

    Structs are ordered field by field, and values that share a double by ``whole``.
    """
    values = df.select(*[F.struct(finite_double(c).alias("number"), _whole(df, c).alias("whole")).alias(c) for c in columns])
    if accuracy is not None:
        found = values.unpivot([], [quoted(c) for c in columns], "feature", "value").groupBy("feature").agg(
            F.percentile_approx("value.number", list(probabilities), accuracy).alias("quantiles"))
        return _for_each(columns, found.withColumn("quantiles", F.transform("quantiles", lambda q: F.struct(
            q.alias("number"), q.cast("bigint").alias("whole")))))
    return _exact_quantiles(values, list(columns), list(probabilities))


def _scale(df: DataFrame, name: str) -> int | None:
    """Digits behind the point of a decimal column that a long holds, 0 for a long, None for any other."""
    kind = df.schema[name].dataType if name in df.columns else None
    if isinstance(kind, T.LongType):
        return 0
    return kind.scale if isinstance(kind, T.DecimalType) and kind.precision <= LONG_DIGITS else None


def _whole(df: DataFrame, name: str) -> Column:
    scale = _scale(df, name)
    if scale is None:
        return F.lit(None).cast("bigint")
    return quoted(name).cast("bigint") if scale == 0 else (quoted(name) * F.lit(Decimal(10 ** scale))).cast("bigint")


def quantile_struct(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    accuracy: int | None = None) -> Column:
    """The same quantiles as one scalar subquery with an array field per column, of longs for a long column and of
    decimals for a decimal one.

    Operators use it to compare every row with a bound without a join. The few
    rows of quantiles are staged, so that a plan which refers to them often, or
    takes quantiles of its own on top, does not repeat the passes behind them.
    """
    table = stage(_quantiles(df, columns, probabilities, accuracy), "quantiles")

    def own(name: str) -> Column:
        scale = _scale(df, name)
        # A sketch's answer is a double; only the exact way knows the digits behind it.
        if scale is None or accuracy is not None and scale > 0:
            return F.transform("quantiles", lambda q: q["number"])
        if scale == 0:
            return F.transform("quantiles", lambda q: q["whole"])
        return F.transform("quantiles", lambda q: q["whole"].cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale)))

    picked = [F.max(F.when(F.col("feature") == c, own(c))).alias(c) for c in columns]
    return table.agg(F.struct(*picked).alias("bounds")).scalar()


def _exact_quantiles(values: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    order = sorted(range(len(probabilities)), key=probabilities.__getitem__)
    ps = [probabilities[i] for i in order]
    margin = 2 / BRACKET_ACCURACY
    around = [max(p - margin, 0.0) for p in ps] + [min(p + margin, 1.0) for p in ps]
    k = len(ps)

    long = values.unpivot([], [quoted(c) for c in columns], "feature", "value").filter(F.col("value.number").isNotNull())

    # One row per column: bounds around each quantile.
    # Grouping by column gives every column's sketches a task of their own to merge.
    brackets = long.groupBy("feature").agg(
        F.percentile_approx("value.number", around, BRACKET_ACCURACY).alias("at")).select(
        "feature", F.slice("at", 1, k).alias("low"), F.slice("at", k + 1, k).alias("high"))

    # A value is kept if it lies in a bracket; between brackets only the number
    # of rows matters, so those collapse into one null-keyed group per slot, and
    # so do the rows above the last bracket.
    # The broadcast side has one row per column of the input.
    in_slot = total([F.when(F.col("value.number") > F.col("high")[i], 1).otherwise(0) for i in range(k)])
    counts = stage(
        long.join(F.broadcast(brackets), "feature")
        .withColumn("slot", in_slot)
        .withColumn("candidate", F.when(F.col("value.number") >= F.get("low", F.col("slot")), F.col("value")))
        .groupBy("feature", "slot", "candidate")
        .agg(F.count(F.lit(1)).alias("rows")), "quantile-counts")

    # The values of a slot are dealt over buckets by a sketch of their own, and
    # only buckets that hold a rank asked for are ranked: no task ranks a slot.
    # The groups without a value lie in a slot's first bucket, before its values.
    # Edges and spans have at most RANK_BUCKETS entries per column and slot.
    # Their number sets the work, not the result: a few values are ranked as they are.
    most = counts.groupBy("feature", "slot").count().agg(F.max("count")).first()[0] or 0
    buckets = 1
    while buckets < RANK_BUCKETS and most > buckets * BUCKET_VALUES:
        buckets *= 2
    placed = counts.withColumn("bucket", F.lit(0))
    if buckets > 1:
        edges = counts.filter(F.col("candidate").isNotNull()).groupBy("feature", "slot").agg(F.percentile_approx(
            "candidate.number", [i / buckets for i in range(1, buckets)], BRACKET_ACCURACY).alias("edges"))
        placed = with_bucket(counts.join(F.broadcast(edges), ["feature", "slot"], "left"),
                             F.col("candidate.number"), buckets).drop("edges")
    before = Window.partitionBy("feature").orderBy("slot", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    n = F.sum("inside").over(Window.partitionBy("feature"))
    ranks = F.array(*[
        F.struct(F.greatest(F.ceil(F.lit(Decimal(str(p))) * F.col("n")).cast("long"), F.lit(1).cast("long")).alias("rank"),
                 F.lit(i).alias("at")) for i, p in enumerate(ps)])
    spans = (
        placed.groupBy("feature", "slot", "bucket").agg(F.sum("rows").alias("inside"))
        .withColumns({"n": n, "earlier": F.coalesce(F.sum("inside").over(before), F.lit(0))})
        .withColumn("asked", F.filter(ranks, lambda r: (
            r["rank"] > F.col("earlier")) & (r["rank"] <= F.col("earlier") + F.col("inside"))))
        .filter(F.size("asked") > 0).select("feature", "slot", "bucket", "earlier", "asked")
    )
    within = Window.partitionBy("feature", "slot", "bucket").orderBy(F.col("candidate").asc_nulls_first())
    ranked = (
        placed.join(F.broadcast(spans), ["feature", "slot", "bucket"])
        .withColumn("reached", F.col("earlier") + F.sum("rows").over(within))
        .withColumn("rank_asked", F.explode(F.filter("asked", lambda r: (
            r["rank"] <= F.col("reached")) & (r["rank"] > F.col("reached") - F.col("rows")))))
        .withColumn("found", F.coalesce(
            F.col("candidate"), F.raise_error(F.lit("quantile outside its bracket")).cast("struct<number:double,whole:bigint>")))
    )
    found = ranked.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("rank_asked.at"), F.col("found")))).alias("found"))
    position = {original: i for i, original in enumerate(order)}
    return _for_each(columns, found.select(
        "feature", F.array(*[F.col("found")[position[i]] for i in range(k)]).alias("quantiles")))


def with_bucket(df: DataFrame, value: Column, buckets: int) -> DataFrame:
    """Adds ``bucket``, the number of ``edges`` below the value, found by bisection in ``log2(buckets)`` projections."""
    df, step = df.withColumn("bucket", F.lit(0)), buckets // 2
    while step:
        beyond = value > F.get("edges", F.col("bucket") + (step - 1))
        df = df.withColumn("bucket", F.col("bucket") + F.when(beyond, step).otherwise(0))
        step //= 2
    return df


def _for_each(columns: Sequence[str], found: DataFrame) -> DataFrame:
    """A row for every column, null where none was found; both sides have one row per column."""
    names = found.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("feature"))
    return names.join(F.broadcast(found), "feature", "left")
