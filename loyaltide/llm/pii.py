"""Personal data by pattern, and by what words give away about it.

Four patterns find e-mail addresses, IP addresses, card and phone numbers. Each
distinct find is a protected entity, and words of the texts that hold it may
give it away to whom knows the corpus. How much is estimated from co-occurrence
over all documents: the pointwise mutual information of word and entity, as a
share of the entity's own information. A word that stands in the texts of one
entity and hardly elsewhere has a share near 1; from ``generalise`` on it is
masked as ``<word>``, from ``remove`` on it is taken out. Only masking and
removal are built: a mask says nothing about the kind of word.

A text holds a word or an entity or does not: places in the text do not matter,
and a disclosing word is marked wherever it occurs in a text with the entity.
A word is a run of letters and digits of any length, outside the finds. Counts
are smoothed by a half in each cell of the fourfold table (Haldane, Anscombe),
so a rare entity of a large corpus can be given away by one text, while in a
small corpus one text proves nothing.

Counts are exact, in whole texts, and need no pair of a word with an entity
that it cannot give away: that is known from how often each of them occurs.
Entities that occur in the same texts are counted as one, and so are words: what
is joined within a text are its groups of either, so a directory of many
addresses and names costs no product of them unless each has texts of its own.
Bitmaps of fixed size sort out most words in the scan, a join makes it exact.

Defined cases: null text counts as empty and has no spans; rows with equal ids
are rows of their own; copies of one text count once, and each is marked; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltide.llm.common import ROW, mapped, numbered, plain_columns, quoted, small_batches, text_of
from loyaltide.plans.staging import stage

KINDS = ("email", "ip", "card", "phone", "word")
BITMAP = 1 << 22  # bits of a bitmap of words or texts: half a megabyte, whatever the input
REMEMBERED = 1 << 18  # texts that a task knows to have counted

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_LONGEST = 4096  # characters looked at first for what stands before an @
# A match begins where a run of digits does: a later digit of the run has no better chance.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern. A local part holds no @, so it is found backwards from each one."""
    free = 0
    for match in _DOMAIN.finditer(text):
        low = max(free, match.start() - _LOCAL_LONGEST)
        local = _LOCAL.match(text[low:match.start()][::-1])
        if local and local.end() == match.start() - low and low > free:
            local = _LOCAL.match(text[free:match.start()][::-1])
        if local:
            free = match.end()
            yield match.start() - local.end(), free


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def finds(text: str) -> list[tuple[int, int, int]]:
    """Spans (begin, kind, end) of the four patterns, sorted."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def words_of(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The words outside the finds, in order."""
    end = 0
    for a, _, b in spans:
        if a > end:
            yield from _WORD.finditer(text, end, a)
        end = max(end, b)
    yield from _WORD.finditer(text, end)


def lowered(words: Iterable[str]) -> set[str]:
    return {w.lower() for w in set(words)}


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42) - (1 << 63)


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored: ROW, id, copy (digest of the text), spans, entities; texts without a find are left behind."""
    small_batches(docs.sparkSession)
    rows = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text"))
    span = pa.list_(pa.struct([("begin", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, spans, entities, texts = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                here = finds(text)
                copies.append(_digest(text))
                spans.append([dict(zip(("begin", "kind", "end"), s)) for s in here])
                entities.append(list({_digest(f"{kind}:{text[a:b].lower()}") for a, kind, b in here}))
                texts.append(text if here else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(copies, pa.int64()), pa.array(spans, span),
                 pa.array(entities, pa.list_(pa.int64())), pa.array(texts, pa.string())],
                ["id", "copy", "spans", "entities", "text"])

    kind = dict(rows.dtypes)["id"]
    return numbered(rows.mapInArrow(run, f"id {kind}, copy long, spans array<struct<begin:int,kind:int,end:int>>, "
                                         "entities array<long>, text string"), "finds")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """BITMAP bits, one of them set for each value of the only column, a long."""
    bit = F.pmod(F.col(hashes.columns[0]), F.lit(BITMAP)) + 1  # Spark numbers the values of a bitmap from 1
    chunks = hashes.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("chunk")) \
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect()  # BITMAP bits at most
    bits = np.zeros(BITMAP + (1 << 16), dtype=np.uint8)
    for row in chunks:
        at = (row.chunk - 1) * 32768  # bits of a chunk
        part = np.unpackbits(np.frombuffer(bytes(row.bits), dtype=np.uint8), bitorder="little")
        bits[at:at + len(part)] |= part
    return bits


def word_counts(docs: DataFrame, wanted: DataFrame, text_col: str = "text", repeated: DataFrame | None = None) -> DataFrame:
    """Columns word, documents: in how many rows each word of ``wanted`` occurs outside finds, over all rows.

    With ``repeated``, a column of the digests of texts that occur more than once, such a text counts once.
    """
    small_batches(docs.sparkSession)
    bits = [_bitmap(wanted.select(F.xxhash64("word")))] + ([] if repeated is None else [_bitmap(repeated)])
    shared = docs.sparkSession.sparkContext.broadcast([np.packbits(b).tobytes() for b in bits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, *again = (np.unpackbits(np.frombuffer(b, dtype=np.uint8)).tobytes() for b in shared.value)
        digest, seen, known = xxhash.xxh64_intdigest, Counter(), set()

        def counted(words: list[str], counts: list[int], copy: int | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64()),
                                               pa.array([copy] * len(words), pa.int64())], ["word", "n", "copy"])

        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                copy = _digest(text) if again else 0
                once = bool(again) and again[0][copy % BITMAP]
                if once and copy in known:
                    continue
                words = lowered(m.group() for m in words_of(text, finds(text)))
                words = [w for w in words if some[digest(w.encode("utf-8", "surrogatepass"), 42) % BITMAP]]
                if once:
                    known.add(copy)
                    yield counted(words, [1] * len(words), copy)
                else:
                    seen.update(words)
            if len(known) > REMEMBERED:
                known.clear()
            if len(seen) > 200_000:
                yield counted(list(seen), list(seen.values()), None)
                seen.clear()
        yield counted(list(seen), list(seen.values()), None)

    counts = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "word string, n long, copy long")
    texts = counts.groupBy("word", "copy").agg(F.sum("n").alias("n")) \
        .select("word", F.when(F.col("copy").isNull(), F.col("n")).otherwise(1).alias("n"))
    return texts.groupBy("word").agg(F.sum("n").alias("documents")).join(wanted, "word", "left_semi")


def text_words(rows: DataFrame) -> DataFrame:
    """Stored: copy, word, for the distinct words of each different text with a find, from the rows of ``found``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        for batch in batches:
            for copy, spans, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if copy not in known:
                    known.add(copy)
                    words = list(lowered(m.group() for m in words_of(text, [(s["begin"], 0, s["end"]) for s in spans])))
                    yield pa.RecordBatch.from_arrays([pa.array([copy] * len(words), pa.int64()),
                                                      pa.array(words, pa.string())], ["copy", "word"])
            if len(known) > REMEMBERED:
                known.clear()

    held = rows.where(F.size("spans") > 0).select("copy", "spans", "text")
    return stage(held.mapInArrow(run, "copy long, word string").distinct(), "words")


def disclosing(docs: DataFrame, rows: DataFrame, text_col: str = "text", generalise: float = 0.8) -> DataFrame:
    """Columns copy, word, disclosure: for each different text the words that give one of its entities away, from the
    rows of ``found``, and the largest share."""
    total = rows.select("copy").distinct().count()
    repeated = rows.groupBy("copy").count().where("count > 1").select("copy")
    words = text_words(rows)
    counted = word_counts(docs, words.select("word").distinct(), text_col, repeated)
    # Entities of the same texts are told by the number of these and two sums of hashes.
    held = rows.select("copy", F.explode("entities").alias("entity")).distinct()
    sums = [F.sum(F.xxhash64("copy", F.lit(i)).cast("decimal(20,0)")).cast("string") for i in range(2)]
    crowds = held.groupBy("entity").agg(F.count(F.lit(1)).alias("alone"), F.concat_ws(" ", *sums).alias("crowd"))
    # The most texts that may hold a word for it to reach the threshold even if it stands with the entity each time.
    most = F.lit(total + 2) * (F.col("alone") + 0.5) / (F.col("alone") + 1) / F.pow(F.lit(total) / F.col("alone"), generalise)
    crowds = crowds.where(F.col("alone") < total).withColumn("most", most - 1 + 1e-6)
    in_text = stage(held.join(crowds, "entity").select("copy", "crowd", "alone", "most").distinct(), "crowds")
    limit = in_text.agg(F.max("most")).first()[0] or 0.0
    # Words that stand in the same texts with finds, and in as many texts in all, tell alike: they are one bunch.
    found = stage(words.join(counted.where(F.col("documents") <= limit), "word"), "rare")
    alike = F.concat_ws(" ", F.first("documents"), F.count(F.lit(1)), *sums)
    rare = stage(found.join(found.groupBy("word").agg(alike.alias("bunch")), "word"), "bunches")
    near = stage(rare.select("copy", "bunch", "documents").distinct().join(in_text, "copy").where("documents <= most")
                 .drop("most"), "near")
    both = near.groupBy("crowd", "bunch").agg(F.count(F.lit(1)).alias("both"), F.first("alone").alias("alone"),
                                              F.first("documents").alias("documents"))
    mutual = F.log(F.lit(total + 2) * (F.col("both") + 0.5) / ((F.col("alone") + 1) * (F.col("documents") + 1)))
    shares = both.withColumn("disclosure", mutual / F.log(F.lit(total) / F.col("alone"))) \
        .where(F.col("disclosure") >= generalise).select("crowd", "bunch", "disclosure")
    told = near.select("copy", "crowd", "bunch").join(shares, ["crowd", "bunch"]) \
        .groupBy("copy", "bunch").agg(F.max("disclosure").alias("disclosure"))
    return rare.select("copy", "bunch", "word").join(told, ["copy", "bunch"]).select("copy", "word", "disclosure")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: ROW, id, base and all, both sorted arrays of (begin, kind, end), and disclosure,
    the share of each word span by its begin."""
    rows = found(docs, id_col, text_col)
    told = disclosing(docs, rows, text_col, **limits).groupBy("copy") \
        .agg(F.collect_list(F.struct("word", "disclosure")).alias("told"))
    place = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("disclosure", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for base, text, words in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                shares = {w["word"]: w["disclosure"] for w in words or []}
                matches = words_of(text, [(s["begin"], 0, s["end"]) for s in base]) if shares else ()
                places.append([{"begin": m.start(), "end": m.end(), "disclosure": shares[m.group().lower()]}
                               for m in matches if m.group().lower() in shares])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(places, place)], [ROW, "id", "base", "words"])

    held = rows.where(F.size("spans") > 0).join(told, "copy", "left").select(ROW, "id", F.col("spans").alias("base"), "text", "told")
    array = "array<struct<begin:int,kind:int,end:int>>"
    marked = held.mapInArrow(run, f"{ROW} long, id {dict(rows.dtypes)['id']}, base {array}, "
                                  "words array<struct<begin:int,end:int,disclosure:double>>")
    word = F.transform("words", lambda w: F.struct(w["begin"].alias("begin"), F.lit(KINDS.index("word")).alias("kind"),
                                                   w["end"].alias("end")))
    shares = F.map_from_entries(F.transform("words", lambda w: F.struct(w["begin"], w["disclosure"])))
    bare = rows.where(F.size("spans") == 0).select(ROW, "id", F.col("spans").alias("base"), F.col("spans").alias("all"),
                                                   F.expr("CAST(map() AS map<int,double>)").alias("disclosure"))
    return marked.select(ROW, "id", "base", F.array_sort(F.concat("base", word)).alias("all"), shares.alias("disclosure")) \
        .unionByName(bare)


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: float = 0.95,
              **limits) -> DataFrame:
    """``docs`` with every find replaced by its kind, and disclosing words by ``<word>`` or nothing; all columns stay."""
    plain, named = plain_columns(docs)
    rows = numbered(plain, "rows")
    marks = spans(rows.select(F.col(ROW).alias("id"), F.col(named(text_col)).alias("text")), "id", "text", **limits) \
        .select(F.col("id").alias(ROW), "all", "disclosure")
    at, columns = docs.columns.index(text_col), [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, marked, shares in zip(*(batch.column(i).to_pylist() for i in (at, len(columns), len(columns) + 1))):
                if text is not None:
                    parts, end, shares = [], 0, dict(shares or [])
                    for m in marked:
                        if m["begin"] < end:
                            continue
                        gone = m["kind"] == 4 and shares[m["begin"]] >= remove
                        parts += [text[end:m["begin"]], "" if gone else f"<{KINDS[m['kind']]}>"]
                        end = m["end"]
                    text = "".join([*parts, text[end:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i)
                                              for i in range(len(columns))], columns)

    return mapped(rows.join(marks, ROW).drop(ROW), run, dropped=2).toDF(*docs.columns)


def listed(column: str):
    """Spans as kind:begin:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["begin"], s["end"])), ",")
