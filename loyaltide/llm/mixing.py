"""Mixing sources to target weights by temperature.

Token shares are raised to an exponent (0: all sources alike, 1: as in the corpus,
above 1: sharper than that) and normalised. Bisection finds the flattest exponent that meets
a repetition limit, or the one whose weights have a target entropy. The weights
are then realised: each source's rows are permuted anew in every epoch, laid
end to end, and cut into blocks; block k takes from source s the next
``weight * block_tokens`` tokens. Without a budget the mix is as long as it
must be for every row to occur once, so no row is lost.

Order within a source needs running sums over all its rows. They are computed
per bucket of the permutation's hash, with the totals of the buckets before it,
so a source with a third of all rows spreads over all tasks.

Defined cases: null sources form a source; a row weighs its tokens and one more
for its end, so empty and null texts count; rows that repeat are permuted as
rows of their own; targets that no mix meets raise ValueError; an empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltide.llm.common import ROW, numbered, plain_columns, quoted, text_of
from loyaltide.plans.staging import stage

BUCKET_DIGITS = 4  # hex digits of the hash: 65,536 buckets per source and epoch
SMALL = 100_000  # sources up to which their table is broadcast
SHARPER = tuple(2.0 ** i for i in range(1, 7))  # exponents above 1 that are tried
SHARPEST = SHARPER[-1]
STEPS = 6  # bisection steps answered by one job


def words_and_end(text_col: str) -> Column:
    """Tokens of a row: its words, and one for its end."""
    return F.regexp_count(text_of(text_col), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long") + 1


def _measures(sources: DataFrame, most: int, exponents: list[float],
              budget: int | None = None) -> dict[float, tuple[float, float]]:
    """For each exponent the entropy of the weights in bits, and the largest repetition: when the largest source
    occurs once, or of a mix of ``budget`` tokens."""
    tried = sources.select(F.explode(F.array(*map(F.lit, exponents))).alias("a"),
                           (F.col("tokens") / F.lit(most)).alias("share"))  # of the largest, so that nothing overflows
    power = F.pow("share", "a")
    rows = tried.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log2(power)).alias("e"),
                                  F.max(power / F.col("share")).alias("r")).collect()
    return {r.a: (math.log2(r.z) - r.e / r.z, r.r * (1 if budget is None else budget / (r.z * most))) for r in rows}


def exponent_for(sources: DataFrame, most: int, max_repetition: float | None = None,
                 target_entropy: float | None = None, steps: int = 48, budget: int | None = None) -> float:
    """The exponent that meets the target; bisected, six steps to a job.

    ``sources`` has ``tokens`` per source, ``most`` is the largest of them. Both
    entropy and repetition fall as the exponent grows. It is 0 to 1 for a mix
    flatter than the corpus, and above 1, up to ``SHARPEST``, for a lower entropy
    than the corpus has. A target out of reach raises ValueError: an entropy
    above that of equal sources or below that of the sharpest mix, or a
    repetition that even the corpus as it is exceeds.
    """
    if (max_repetition is None) == (target_entropy is None):
        raise ValueError("give either max_repetition or target_entropy")

    def too_flat(measured: tuple[float, float]) -> bool:
        return measured[1] > max_repetition if target_entropy is None else measured[0] > target_entropy

    low, high = 0.0, 1.0
    ends = _measures(sources, most, [low, high, *SHARPER], budget)
    if not ends:
        return low
    if not too_flat(ends[low]):
        if target_entropy is not None and target_entropy > ends[low][0] + 1e-9:
            raise ValueError(f"no mix of these sources has an entropy of {target_entropy}; the most is {ends[low][0]}")
        return low
    if too_flat(ends[high]):
        sharper = [a for a in SHARPER if not too_flat(ends[a])]
        if max_repetition is not None or not sharper:
            raise ValueError(f"out of reach: {max_repetition=}, {target_entropy=}; at exponent 1 repetition is "
                             f"{ends[high][1]}, at {SHARPEST} entropy is {ends[SHARPEST][0]}")
        high = sharper[0]
        low = high / 2
    for _ in range(0, steps, STEPS):
        grid = [low + (high - low) * i / 2 ** STEPS for i in range(1, 2 ** STEPS)]
        measured = _measures(sources, most, grid, budget)
        first, last = 0, 2 ** STEPS
        while last - first > 1:
            middle = (first + last) // 2
            first, last = (middle, last) if too_flat(measured[grid[middle - 1]]) else (first, middle)
        points = [low, *grid, high]
        low, high = points[first], points[last]
    return high


def weighted_sources(tokens: DataFrame, max_repetition: float | None, target_entropy: float | None,
                     budget: int | None) -> DataFrame:
    """A row per source: tokens, weight, and repetition, how often the mix goes through the source."""
    totals = stage(tokens.groupBy("src").agg(F.sum("tokens").alias("tokens")), "sources")
    most = totals.agg(F.max("tokens")).first()[0] or 1
    exponent = exponent_for(totals, most, max_repetition, target_entropy, budget=budget)
    power = F.pow(F.col("tokens") / F.lit(most), F.lit(exponent))
    norm = totals.agg(F.sum(power)).first()[0] or 1.0
    weight = power / F.lit(norm)
    # Without a budget the rarest source occurs exactly once: the largest up to exponent 1, beyond it the smallest.
    often = power * F.lit(most) / F.col("tokens") if budget is None else weight * F.lit(float(budget)) / F.col("tokens")
    if budget is None and exponent > 1:
        often = often / F.lit(totals.agg(F.min(often)).first()[0])
    return totals.select("src", "tokens", weight.alias("weight"), often.alias("repetition"))


def mixed(rows: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None,
          budget: int | None = None, block_tokens: int = 1_000_000, seed: int = 1) -> DataFrame:
    """``rows`` (ROW, id, src, tokens) as the mix: ROW, id, src, epoch, block, place.

    ``rows`` is read more than once, so it should be stored. Rows of a block are
    to be read in the order of ``place``.
    """
    sources = weighted_sources(rows, max_repetition, target_entropy, budget)
    side = F.broadcast(sources) if sources.limit(SMALL + 1).count() <= SMALL else sources
    epochs = F.floor(F.col("repetition") + 1 - 1e-9)  # started ones
    drawn = rows.join(side.withColumnRenamed("tokens", "total"), "src") \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(epochs, F.lit(1)) - 1)))
    shuffled = F.md5(F.concat_ws("|", F.lit(seed), "epoch", F.coalesce(F.col("id").cast("string"), F.lit(""))))
    drawn = drawn.withColumn("hash", shuffled).withColumn("bucket", F.substring("hash", 1, BUCKET_DIGITS))
    start = Window.partitionBy("src", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = drawn.groupBy("src", "epoch", "bucket").agg(F.sum("tokens").alias("tokens")) \
        .select("src", "epoch", "bucket", F.coalesce(F.sum("tokens").over(start), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("src", "epoch", "bucket").orderBy("hash", "id", ROW) \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0))) \
        .join(offsets, ["src", "epoch", "bucket"]) \
        .withColumn("position", F.col("epoch") * F.col("total") + F.col("offset") + F.col("inner"))
    whole = F.col("epoch") + 1 <= F.col("repetition") + 1e-9
    placed = placed.where(whole | (F.col("position") < F.col("repetition") * F.col("total"))) \
        .withColumn("block", F.floor(F.col("position") / (F.col("weight") * F.lit(float(block_tokens)))))
    order = Window.partitionBy("block").orderBy("hash", "src", "epoch", ROW)  # a block holds block_tokens at most
    return placed.select(ROW, "id", "src", "epoch", "block", F.row_number().over(order).cast("long").alias("place"))


def source_key(source_col: str) -> Column:
    """The source as a join key in which null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), quoted(source_col).cast("string")), F.lit(""))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        **targets) -> DataFrame:
    """The mix as ids: id, source, epoch, block, place, one row per occurrence."""
    rows = numbered(docs.select(quoted(id_col).alias("id"), source_key(source_col).alias("src"),
                                words_and_end(text_col).alias("tokens")), "tokens")
    source = F.when(F.col("src") != "", F.substring("src", 2, 1 << 30))
    return mixed(rows, **targets).select(F.col("id").alias(id_col), source.alias(source_col), "epoch", "block", "place")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               **targets) -> DataFrame:
    """The rows of the mix with all their columns; a row that occurs n times is there n times."""
    plain, at = plain_columns(docs)
    rows = numbered(plain, "rows")
    tokens = stage(rows.select(ROW, F.col(at(id_col)).alias("id"), source_key(at(source_col)).alias("src"),
                               words_and_end(at(text_col)).alias("tokens")), "tokens")
    counts = mixed(tokens, **targets).groupBy(ROW).agg(F.count(F.lit(1)).alias("times"))
    again = rows.join(counts, ROW)
    return again.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))) \
        .drop(ROW, "times", "copy").toDF(*docs.columns)
