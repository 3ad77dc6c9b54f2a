"""Quality rules by host: failures per domain, shrunk with an empirical beta prior, joined back to documents.

``figures`` measures whole texts in one scan, without a shuffle. Words that stand
in a three-word window found twice are counted by sorting the windows of a text
as numbers, 40 bits of their hash over 24 bits of their place; neighbours with
one hash are compared word by word, and a text where two different windows share
a hash (or of over 16 million words) is sorted by its words instead, so counts
are exact.

``hosts`` adds up, per host, the documents that fail each rule. The hosts' rates
give a beta prior per rule by the method of moments: its mean is the share of
all documents that fail, its strength follows from how much more the rates vary
than chance explains. A host's rate is then (failures + strength * mean) /
(documents + strength): hosts of few documents stay near the mean (a prior
weighs ``LEAST`` documents at least), and hosts that vary no more than by chance all get it. A host where some rule's rate is
over ``limit`` is rejected with all its documents.

Documents meet their host's verdict in two joins: hosts with 1/1024 of the rows
or more, at most 1,024, are broadcast, so a host with a third of all rows is
settled where its rows are; only rows of smaller hosts are shuffled.

Defined cases: null and empty texts have no words and fail ``short`` alone; null
hosts form one host of their own; rows that repeat count and are judged each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.llm.common import joined_back, text_of
from loyaltide.plans.staging import stage

BLANK = " \t\n\x0b\f\r"
LEAST = 10.0  # documents that a prior weighs at least, so that a few rows never condemn a host
PLACE = 24  # bits of a window's place in its sort key
# Each rule and the document that fails it.
RULES = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "lengths": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)",
}
BASE = ("short", "repeated")  # rules that reject a document by itself


def words_of(text: Column) -> Column:
    """The runs of characters that are not ASCII blanks."""
    body = F.btrim(text, F.lit(BLANK))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def _same(a: Column, b: Column) -> Column:
    """Do two sort keys hold one hash?"""
    return F.shiftrightunsigned(a.bitwiseXOR(b), PLACE) == 0


def _window(words: Column, at: Column) -> list[Column]:
    return [F.get(words, (at + i).cast("int")) for i in range(3)]


def _repeated_by_words(words: Column) -> Column:
    """Places of repeated windows, by sorting the words themselves."""
    def places(windows: Column) -> Column:
        def like(a: Column, b: Column) -> Column:
            return reduce(Column.__and__, (a[c] == b[c] for c in "abc"))
        return F.transform(
            F.filter(windows, lambda x, i: F.coalesce(like(x, F.get(windows, i - 1)), F.lit(False))
                     | F.coalesce(like(x, F.get(windows, i + 1)), F.lit(False))), lambda x: x["at"])

    windows = F.transform(F.sequence(F.lit(0).cast("long"), (F.size(words) - 3).cast("long")), lambda at: F.struct(
        *[w.alias(c) for w, c in zip(_window(words, at), "abc")], at.alias("at")))
    return F.flatten(F.transform(F.array(F.sort_array(windows)), places))  # bound once, not once per element


def figures(docs: DataFrame, text_col: str, *kept: Column) -> DataFrame:
    """``kept`` and, per row: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    text, words, keys, near = F.col("text"), F.col("words"), F.col("keys"), F.col("near")
    place = F.lit((1 << PLACE) - 1).cast("long")
    names = [f"k{i}" for i in range(len(kept))]
    df = docs.select(*[k.alias(n) for k, n in zip(kept, names)], text_of(text_col).alias("text"))
    df = df.withColumn("words", words_of(text)).withColumn(
        "lines", F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANK)) != ""))
    # One narrow step after the other: arrays that a later lambda reads must be columns, not expressions.
    df = df.select(*names, "words", F.size("words").cast("long").alias("n_words"),
                   F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                   F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                   F.size("lines").cast("long").alias("n_lines"),
                   (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   F.sort_array(F.slice(F.transform("words", lambda w, i: F.xxhash64(
                       w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long"))),
                       1, F.greatest(F.size("words") - 2, F.lit(0)))).alias("keys"))
    df = df.withColumn("near", F.filter(keys, lambda x, i: F.coalesce(_same(x, F.get(keys, i + 1)), F.lit(False))
                                        | F.coalesce(_same(x, F.get(keys, i - 1)), F.lit(False))))

    def collides(x: Column, i: Column) -> Column:
        follows = F.get(near, i + 1)
        alike = [a == b for a, b in zip(_window(words, x.bitwiseAND(place)), _window(words, follows.bitwiseAND(place)))]
        return F.coalesce(_same(x, follows) & ~reduce(Column.__and__, alike), F.lit(False))

    unsure = F.exists(F.transform(near, collides), lambda x: x) | (F.size(words) > 1 << PLACE)
    df = df.withColumn("places", F.when(unsure, F.sort_array(_repeated_by_words(words))).otherwise(
        F.sort_array(F.transform(near, lambda x: x.bitwiseAND(place)))))
    places = F.col("places")
    covered = F.transform(places, lambda p, i: F.least(F.lit(3).cast("long"),
                                                       F.coalesce(F.get(places, i + 1) - p, F.lit(3).cast("long"))))
    df = df.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return df.drop("words", "keys", "near", "places").select(
        *names, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def hosts(rows: DataFrame, limit: float) -> DataFrame:
    """Per host of ``rows`` (host, and a boolean per rule): documents, a rate per rule, rejected."""
    counts = stage(rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"), *[F.count_if(F.col(r)).alias(r) for r in RULES]), "hosts")
    n = F.col("documents").cast("double")
    total, number = F.sum(n), F.count(F.lit(1))
    priors = []
    for rule in RULES:
        k = F.col(rule).cast("double")
        mean = F.sum(k) / total
        chance = mean * (1 - mean)
        spread = (F.sum(k * k / n) - F.sum(k) * mean - (number - 1) * chance) / F.nullif(
            total - F.sum(n * n) / total, F.lit(0.0))
        priors += [mean.alias(f"{rule}_mean"), F.when(spread > 0, F.greatest(
            chance / F.when(spread > 0, spread) - 1, F.lit(LEAST))).alias(f"{rule}_strength")]
    prior = counts.agg(F.struct(*priors)).scalar()
    rated = counts.withColumn("prior", prior)
    for rule in RULES:
        mean, strength = F.col(f"prior.{rule}_mean"), F.col(f"prior.{rule}_strength")
        rated = rated.withColumn(f"{rule}_rate", F.when(strength.isNull(), mean).otherwise(
            (F.col(rule) + strength * mean) / (F.col("documents") + strength)))
    return rated.select("host", "documents", *[f"{r}_rate" for r in RULES], F.greatest(
        *[F.col(f"{r}_rate") for r in RULES]).__gt__(limit).alias("rejected"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str | Column = "source",
           limit: float = 0.5) -> DataFrame:
    """Per row of ``docs``: id, the figures, base_failed, host_rejected, kept."""
    own = F.col("`" + host + "`") if isinstance(host, str) else host
    measured = stage(figures(docs, text_col, F.col("`" + id_col + "`"), own).withColumnsRenamed(
        {"k0": "id", "k1": "host"}), "figures")
    flagged = measured.withColumns({rule: F.expr(fails) for rule, fails in RULES.items()})
    verdicts = hosts(flagged, limit).select("host", "documents", F.col("rejected").alias("host_rejected"))
    base = reduce(Column.__or__, map(F.col, BASE))
    return joined_back(flagged, verdicts, "host", "documents").select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "host_rejected", (~base & ~F.col("host_rejected")).alias("kept"))


def host_of(url: Column) -> Column:
    """The host of an address in lower case, to be given as ``host``; null if there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))
