"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

Sections are parted by an empty line, paragraphs by a line break, and a
paragraph is cut into sentences of at most 200 characters. Leaves are digests
of sentences, every other node is the digest of its children, so equal roots
mean equal texts, and two trees are compared by walking down only where
digests differ. All of it is built from SQL functions.

Defined cases: null text counts as empty and has a fingerprint of its own; rows
with equal ids follow each other in the order of their texts, null ids come
last; a table of one row is followed by that row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltide.llm.common import quoted, text_of

#: A sentence with the marks and blanks that end it, or 200 characters without such a mark.
SENTENCE = "[^.!?]{0,200}[.!?]+ *|[^.!?]{1,200}"
DIGITS = 32  # hex digits kept of the digests inside a tree; roots have all 64


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, DIGITS)


def _paragraph(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), _digest)


def sections_of(text: Column) -> Column:
    """The tree below the root: per section an array of paragraphs, each an array of leaf digests."""
    return F.transform(F.split(text, "\n\n", -1),
                       lambda section: F.transform(F.split(section, "\n", -1), _paragraph))


def _paragraph_digest(leaves: Column) -> Column:
    return _digest(F.concat(F.lit("p"), F.array_join(leaves, "")))


def _section_digest(paragraphs: Column) -> Column:
    return _digest(F.concat(F.lit("s"), F.array_join(F.transform(paragraphs, _paragraph_digest), "")))


def root(sections: Column) -> Column:
    """The fingerprint of a tree, 64 hex digits."""
    return F.sha2(F.concat(F.lit("d"), F.array_join(F.transform(sections, _section_digest), "")), 256)


def leaves(sections: Column) -> Column:
    """Distinct leaf digests of a tree."""
    return F.array_distinct(F.flatten(F.flatten(sections)))


def likeness(first: Column, second: Column) -> Column:
    """Share of sentences that two trees have in common, 0 to 1; equal trees have 1."""
    a, b = leaves(first), leaves(second)
    both = F.size(F.array_intersect(a, b)) * 2.0 / (F.size(a) + F.size(b))
    return F.when(root(first) == root(second), 1.0).otherwise(F.coalesce(both, F.lit(0.0)))


def changed(first: Column, second: Column) -> Column:
    """Where two trees differ: [section, paragraph] pairs, found by comparing the children of differing nodes only."""
    def positions(a: Column, b: Column) -> Column:
        return F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b), F.lit(1)) - 1)

    def differs(a: Column, b: Column):
        return lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i))

    def inside(i: Column) -> Column:
        a, b = F.coalesce(F.get(first, i), F.array()), F.coalesce(F.get(second, i), F.array())
        return F.transform(F.filter(positions(a, b), differs(a, b)), lambda j: F.array(i, j))

    return F.flatten(F.transform(F.filter(positions(first, second), differs(first, second)), inside))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, fingerprint, sections (the tree below it)."""
    return docs.select(quoted(id_col).alias(id_col), sections_of(text_of(text_col)).alias("sections")) \
        .select(id_col, root(F.col("sections")).alias("fingerprint"), "sections")


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, text, next_text: the text of the row with the next smaller id; the last is followed by the first.

    Ids are cut into ranges at approximate quantiles, one per shuffle partition,
    and each range also gets the row that follows it, so neighbours are found
    inside ranges and texts are shuffled once.
    """
    rows = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = rows.agg(F.percentile_approx("id", shares, 10 * ranges)).first()[0] or []
    # Range 0 has the largest ids, the last range the null ids; there are as many as shuffle partitions.
    number = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda cut: cut >= F.col("id"))) if cuts else F.lit(0)
    numbered = rows.withColumn("range", F.when(F.col("id").isNull(), ranges + 1).otherwise(number))
    heads = numbered.select("id", "range").groupBy("range").agg(F.max("id").alias("head")).orderBy("range").collect()
    placing = F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("late")))
    for before, at in zip([heads[-1], *heads[:-1]] if heads else [], heads):
        # The first row of a range closes the range before it; the very first closes the last range.
        leads = (F.col("range") == at["range"]) & F.col("id").eqNullSafe(F.lit(at["head"]))
        placing = F.when(leads, F.array(F.struct(F.col("range"), F.lit(0).alias("late")),
                                        F.struct(F.lit(before["range"]).alias("range"), F.lit(1).alias("late")))) \
            .otherwise(placing)
    order = Window.partitionBy("range").orderBy("late", F.col("id").desc_nulls_last(), "text")
    return numbered.withColumn("at", F.explode(placing)).select("id", "text", "at.range", "at.late") \
        .withColumn("next_text", F.lead("text").over(order)).where("late = 0") \
        .select(F.col("id").alias(id_col), "text", "next_text")
