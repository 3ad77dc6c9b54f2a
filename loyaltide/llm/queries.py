"""The operators of this folder bound to the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.llm import (bpe, chat, exact_dedup, hostrules, merkle, mixing, periods, pii, quality, sharding, simhash,
                           tokenfile, veccodes)
from loyaltide.llm.common import joined_back, read
from loyaltide.plans.staging import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


@query("""
WITH tree AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, coalesce(text, '') AS text,
         coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC), '') AS follows
  FROM documents
), edits AS (
  SELECT *, substr(text, 1, n - n // 2) || substr(follows, 1, n // 2) AS edited FROM tree
), trees AS (
  SELECT *, list_transform([text, edited, follows], lambda t: list_transform(string_split(t, chr(10) || chr(10)),
    lambda s: list_transform(string_split(s, chr(10)), lambda p: list_transform(
      regexp_extract_all(p, '[^.!?]{0,200}[.!?]+ *|[^.!?]{1,200}'), lambda l: substr(sha256(l), 1, 32))))) AS t
  FROM edits
), roots AS (
  SELECT *, list_transform(t, lambda d: sha256('d' || list_aggregate(list_transform(d, lambda s: substr(sha256('s' ||
    list_aggregate(list_transform(s, lambda p: substr(sha256('p' || coalesce(list_aggregate(p, 'string_agg', ''), '')),
      1, 32)), 'string_agg', '')), 1, 32)), 'string_agg', ''))) AS r,
    list_transform(t, lambda d: list_distinct(flatten(flatten(d)))) AS l
  FROM trees
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, r[1] AS fingerprint, r[2] AS edited_fingerprint,
  CASE WHEN r[1] = r[2] THEN 1.0::DOUBLE ELSE coalesce(len(list_intersect(l[1], l[2])) * 2.0::DOUBLE
    / nullif(len(l[1]) + len(l[2]), 0), 0) END AS near_edited,
  CASE WHEN r[1] = r[3] THEN 1.0::DOUBLE ELSE coalesce(len(list_intersect(l[1], l[3])) * 2.0::DOUBLE
    / nullif(len(l[1]) + len(l[3]), 0), 0) END AS near_next,
  list_sum(list_transform(range(1, greatest(len(t[1]), len(t[2])) + 1), lambda i: list_sum(list_transform(
    range(1, greatest(coalesce(len(t[1][i]), 0), coalesce(len(t[2][i]), 0)) + 1),
    lambda j: (t[1][i][j] IS DISTINCT FROM t[2][i][j])::INT))))::INTEGER AS changed_paragraphs
FROM roots
""")
def op2_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's Merkle root, and how far it is from an edited version and from the next document."""
    pairs = merkle.followed(read(spark, folder, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = pairs.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.expr("left(text, length(text) - length(text) div 2)"), F.left("next_text", half)))
    trees = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                          merkle.sections_of(F.col("text")).alias("t"), merkle.sections_of(F.col("edited")).alias("e"),
                          merkle.sections_of(F.col("next_text")).alias("n"))
    t, e, n = F.col("t"), F.col("e"), F.col("n")
    return trees.select("doc_id", "n_chars", "edited_sha256", merkle.root(t).alias("fingerprint"),
                        merkle.root(e).alias("edited_fingerprint"), merkle.likeness(t, e).alias("near_edited"),
                        merkle.likeness(t, n).alias("near_next"),
                        F.size(merkle.changed(t, e)).alias("changed_paragraphs"))


@query()
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard among 256, and its shard when one of them is taken out."""
    docs = read(spark, folder, "documents")
    shards = [f"shard-{i:03d}" for i in range(256)]
    full = sharding.placed(docs, "doc_id", shards)
    return full.join(F.broadcast(sharding.placement(spark, shards[1:]).withColumnRenamed("shard", "shard_without_first")),
                     "slot").select("doc_id", "slot", "shard", "shard_without_first")


@query(r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, 1 + len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS n FROM documents
), s AS (
  SELECT source, sum(n)::BIGINT AS tokens FROM d GROUP BY source
), ends AS (SELECT max(tokens) AS most, min(tokens) AS least FROM s
), bisect AS (
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, CASE WHEN pow(most / least, 1 - (low + high) / 2) > 4 THEN (low + high) / 2 ELSE low END,
    CASE WHEN pow(most / least, 1 - (low + high) / 2) > 4 THEN high ELSE (low + high) / 2 END
  FROM bisect, ends WHERE i < 48
), w AS (
  SELECT source, tokens, pow(tokens / most, a) / sum(pow(tokens / most, a)) OVER () AS weight,
    pow(tokens / most, a) * most / tokens AS often
  FROM s, ends, (SELECT CASE WHEN most / least > 4 THEN (SELECT high FROM bisect ORDER BY i DESC LIMIT 1) ELSE 0 END AS a
                 FROM ends)
), copies AS (
  SELECT doc_id, source, n, tokens, weight, often, e AS epoch, md5('1|' || e || '|' || doc_id) AS hash
  FROM d JOIN w USING (source), generate_series(0, greatest(floor(often + 1 - 1e-9), 1)::BIGINT - 1) g(e)
), placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n) OVER (PARTITION BY source, epoch ORDER BY hash
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position FROM copies
), kept AS (
  SELECT doc_id, source, epoch, hash, floor(position / (weight * 1000000.0::DOUBLE))::BIGINT AS block
  FROM placed WHERE epoch + 1 <= often + 1e-9 OR position < often * tokens
)
SELECT doc_id, source, epoch, block, row_number() OVER (PARTITION BY block ORDER BY hash) AS place FROM kept
""")
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The whole corpus mixed as flat as four repetitions allow, in blocks of a million tokens."""
    return mixing.mix(read(spark, folder, "documents"), max_repetition=4.0)


@query("""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)
""")
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays of its equals."""
    return exact_dedup.duplicates(read(spark, folder, "documents"))


@query()
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint and the group of near copies it is in."""
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query()
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded by a multilingual vocabulary, and decoded again."""
    return bpe_digests(read(spark, folder, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), said AS (
  SELECT *, regexp_replace(text, '([<\\[])(\\\\*)(/?(s>|INST\\]))', '\\1\\2\\\\\\3', 'g') AS escaped FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<s>[INST]' || role || '[/INST]' || escaped || '</s>'))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
""")
def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and what can be read back from the output."""
    probe = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                "conv_id long, turn long, role string, text string")
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.formatted(turns, public_tokenizers.path("byte_bpe_50k.json")))


@query()
def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written as directly addressable codes and read back."""
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(read(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.documents(tokenfile.segments(spark, path))


@query()
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality, learned from labels of four fifths of them."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, folder, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query()
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data, and the words that give it away."""
    found = pii.spans(read(spark, folder, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    return found.select(F.col("id").alias("doc_id"), *map(count, range(4)),
                        F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("all").alias("spans"))


@query(r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \t\n\x0B\f\r]')) AS lines FROM d
), windows AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS i,
    unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w
), again AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, s) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid
), f AS (
  SELECT w.*, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (rid)
), flags AS (
  SELECT *, [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines,
    n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)] AS fails FROM f
), hosts AS (
  SELECT source, rule, count(*)::DOUBLE AS n, (count(*) FILTER (fails[rule]))::DOUBLE AS k
  FROM flags, range(1, 6) r(rule) GROUP BY source, rule
), means AS (
  SELECT rule, sum(k) / sum(n) AS m, sum(k * k / n) AS q, sum(k) AS ks, sum(n) AS ns, sum(n * n) AS n2, count(*) AS h
  FROM hosts GROUP BY rule
), priors AS (
  SELECT rule, m, (q - ks * m - (h - 1) * m * (1 - m)) / nullif(ns - n2 / ns, 0) AS v FROM means
), rates AS (
  SELECT source, max(CASE WHEN v > 0 THEN (k + greatest(m * (1 - m) / v - 1, 10) * m)
    / (n + greatest(m * (1 - m) / v - 1, 10)) ELSE m END) > 0.5 AS rejected
  FROM hosts JOIN priors USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, fails[1] OR fails[2] AS base_failed,
  rejected AS host_rejected, NOT (fails[1] OR fails[2] OR rejected) AS kept
FROM flags f JOIN rates r ON f.source IS NOT DISTINCT FROM r.source
""")
def op11_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's figures and verdict, its source taken as its host."""
    return hostrules.judged(read(spark, folder, "documents"))


def _codes_sql(rounds: int = 6) -> str:
    """Rounds of assignment and update, written out one after the other."""
    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT rid, p, arg_min(e, d * 16 + e) AS e, min(d) AS d FROM (
    SELECT rid, s.p, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
    FROM parts s JOIN b{i} b ON s.p = b.p) GROUP BY rid, p
)"""

    def updated(i: int) -> str:
        return f"""sums{i} AS (
  SELECT p, e, i, sum(v) AS s, count(*) AS n FROM (
    SELECT s.p, e, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM parts s JOIN a{i} a ON s.rid = a.rid AND s.p = a.p
  ) GROUP BY p, e, i
), b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM b{i} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{i} GROUP BY p, e) n ON b.p = n.p AND b.e = n.e
)"""

    steps = ", ".join(f"{assigned(i)}, {updated(i)}" for i in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) r(p)
), b0 AS MATERIALIZED (
  SELECT p, rid - 1 AS e, x AS c FROM parts WHERE rid <= 16
), {steps}, {assigned(rounds)}, coded AS (
  SELECT rid, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid
), books AS (
  SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


@query(_codes_sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's code of eight parts, its error and that of all vectors of its label."""
    rows, books = veccodes.codes(read(spark, folder, "embeddings"))
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    largest = F.lit(veccodes.LARGEST)
    totals = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.least(
        F.sum(F.col("error").cast("decimal(38,0)")), largest.cast("decimal(38,0)")).cast("long").alias("label_error"))
    return joined_back(rows, totals, "label", "n").select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; of a tenth of the ids the words from some place on repeat with a period drawn from the id."""
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.size("words")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h")) \
        .withColumn("words", F.when(F.col("h") % 10 == 0, hostrules.words_of(F.col("text")))) \
        .withColumn("g", F.floor(F.col("h") / 10)) \
        .withColumn("a", F.when(n > 0, F.col("g") % n).cast("int")) \
        .withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    words, a, p = F.col("words"), F.col("a"), F.col("p")
    repeated = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))
    return rows.select("doc_id", F.when(a.isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op13_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs, the longest of them, and digests of all and of the text without repeats."""
    found = periods.with_runs(planted_periods(read(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        "", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    longest = found.withColumn("best", best)
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
