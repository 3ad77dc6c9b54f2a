"""Drift against stored sketches: a mergeable quantile sketch per day and column, in place of past rows.

A day's rows are read once, when its sketches are taken. A report merges the
sketches of the days on either side and reads no row. Ranks are off by at most
``rank_error`` of a side's rows and half of ``1 / POINTS``; with the defaults that
moves a share of a bin by under half a percent. The exact way, over rows, stays the default of
``drift``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.functions.columns import quoted
from loyaltide.operators.drift import BINS, SMALLEST_SHARE, drift_status

SIZE = 2_048
POINTS = 2_000  # of a side's distribution at which bins are cut


def rank_error(size: int = SIZE) -> float:
    """What a rank is off by, at most, as a share of the rows, in 99 of 100 cases: the sketch's published bound."""
    return 2.446 / size ** 0.9433


def day_sketches(df: DataFrame, day: Column, columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """day, feature, rows, filled and sketch, one row per day and column, to be appended to a table of them.

    NaN and null are in no sketch; ``rows`` counts them.
    """
    def finite(name: str) -> Column:
        return F.nullif(quoted(name).cast("double"), F.lit(float("nan")))

    values = df.select(day.alias("day"), *[finite(c).alias(c) for c in columns])
    per_day = values.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(F.count(quoted(c)).alias("filled"), F.kll_sketch_agg_double(quoted(c), F.lit(size)).alias("sketch")).alias(c)
        for c in columns])
    found = per_day.select("day", "rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), quoted(c)["filled"].alias("filled"), quoted(c)["sketch"].alias("sketch"))
        for c in columns])))
    return found.select("day", "feature", "rows", "filled", "sketch")


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column: the rows of all its days, and their sketch; null if no day has a value."""
    filled = F.when(F.col("filled") > 0, F.col("sketch"))
    return sketches.groupBy("feature").agg(F.sum("rows").alias("rows"), F.sum("filled").alias("filled"),
                                           F.kll_merge_agg_double(filled).alias("sketch"))


def sketched_psi(sketches: DataFrame, reference: Column, current: Column, bins: int = BINS) -> DataFrame:
    """Stability index per column between two sets of days, from their sketches; as ``drift_psi``, within the error.

    ``reference`` and ``current`` are conditions on ``day``. Shares are of all rows, so nulls lower every bin.
    """
    sides = [merged(sketches.filter(c)).withColumnsRenamed({n: f"{s}_{n}" for n in ("rows", "filled", "sketch")})
             for s, c in (("ref", reference), ("cur", current))]
    both = sides[0].join(sides[1], "feature")
    points = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = F.when(F.col("ref_filled") > 0, F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("ref_sketch", points))))
    both = both.withColumn("edges", F.coalesce(edges, F.array().cast("array<double>")))

    # Ranks are looked up among this many quantiles of a side, since a sketch gives those of constants alone.
    fine = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    for s in ("ref", "cur"):
        both = both.withColumn(f"{s}_at", F.when(F.col(f"{s}_filled") > 0, F.kll_sketch_get_quantile_double(f"{s}_sketch", fine)))

    def shares(side: str) -> Column:
        """Share of each bin, of all rows: differences of the ranks of the edges, which count equal values in."""
        ranks = F.transform("edges", lambda e: F.coalesce(
            F.size(F.filter(F.col(f"{side}_at"), lambda q: q <= e)) / F.lit(float(POINTS)), F.lit(0.0)))
        upto = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.when(F.col(f"{side}_filled") > 0, 1.0).otherwise(0.0)))
        of_rows = F.col(f"{side}_filled") / F.greatest(F.col(f"{side}_rows"), F.lit(1))
        return F.transform(F.slice(upto, 2, F.size("edges") + 1), lambda r, i: F.greatest(
            (r - F.get(upto, i)) * of_rows, F.lit(SMALLEST_SHARE)))

    terms = F.zip_with("ref_shares", "cur_shares", lambda r, c: (c - r) * F.ln(c / r))
    index = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return both.withColumns({"ref_shares": shares("ref"), "cur_shares": shares("cur")}).select(
        "feature", F.round(F.when(F.size("edges") > 1, index).otherwise(0.0), 6).alias("psi")) \
        .withColumn("status", drift_status(F.col("psi")))
