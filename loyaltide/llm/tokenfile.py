"""Token ids as files of directly addressable codes.

An id is split into chunks of eight bits. Level 0 holds the low chunk of every
id and a bitmap of those that go on, level 1 the next chunk of those, and so on;
a rank directory counts the set bits before every 512, so the place of any
token's next chunk is one lookup and a few bits away. Any token can be read
without decoding its block: codes are written without compression.

Documents are dealt out by ranges of ids, so segments are in order by (part,
seq). They are written by Spark's own writer, one row a segment, in whatever
store the path names: part, seq, inside (ids of the part before it), doc_ids,
ends (of each document, in tokens of the segment) and payload (the codes).

Defined cases: the string of an added token in a text is that token, as in the
library; null text counts as empty and has the end id alone; ids are cast to long; null ids come
first, repeated ids in the order of their texts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loyaltide.llm.common import quoted, text_of
from loyaltide.llm.pieces import PieceEncoder

SEGMENT = 1 << 20  # ids of a segment, about; a document is never cut
RANK = 512  # bits between two entries of a rank directory
TOGETHER = 250  # pieces joined to one text for the tokenizer
ROWS = 500


def pack(ids: np.ndarray) -> bytes:
    """Directly addressable codes of unsigned ids."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = rest > 255
        levels.append(((rest & np.uint64(255)).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> np.uint64(8)
    out = [np.array([len(levels), *(len(chunk) for chunk, _ in levels)], dtype="<u8").tobytes()]
    for chunk, more in levels:
        bits = np.packbits(more, bitorder="little")
        words = np.zeros(-(-len(more) // RANK) * RANK // 8, dtype=np.uint8)
        words[:len(bits)] = bits
        ones = np.bitwise_count(words.reshape(-1, RANK // 8)).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones
        out += [chunk.tobytes(), words.tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join(out)


class Codes:
    """A view of packed ids; nothing is decoded until asked for."""

    def __init__(self, data: bytes):
        count = int(np.frombuffer(data, "<u8", 1)[0])
        sizes = np.frombuffer(data, "<u8", count, 8).astype(int)
        self.levels, at = [], 8 + 8 * count
        for size in sizes:
            blocks = -(-size // RANK)
            chunk = np.frombuffer(data, np.uint8, size, at)
            words = np.frombuffer(data, np.uint8, blocks * RANK // 8, at + size)
            ranks = np.frombuffer(data, "<u8", blocks, at + size + len(words))
            self.levels.append((chunk, words, ranks))
            at += size + len(words) + 8 * blocks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, position: int) -> int:
        """One id, by rank lookups alone."""
        if not 0 <= position < len(self):
            raise IndexError(position)
        value = 0
        for level, (chunk, words, ranks) in enumerate(self.levels):
            value |= int(chunk[position]) << (8 * level)
            if not words[position >> 3] >> (position & 7) & 1:
                break
            block = position // RANK
            inside = words[block * RANK // 8:(position >> 3) + 1].copy()
            inside[-1] &= (1 << (position & 7)) - 1
            position = int(ranks[block]) + int(np.bitwise_count(inside).sum())
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        value = np.empty(0, dtype=np.uint32)
        for chunk, words, _ in reversed(self.levels):
            more = np.unpackbits(words, bitorder="little", count=len(chunk)).astype(bool)
            low = chunk.astype(np.uint32)
            low[more] |= value << np.uint32(8)
            value = low
        return value


class LibraryEncoder:
    """Ids of texts by a tokenizer of the library, without the special tokens it would add around them.

    The strings of added tokens in a text are those tokens, as the library has it, or ordinary text if ``literal``.
    """

    def __init__(self, tokenizer_json: str, literal: bool = False):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = literal
        size = self.tokenizer.get_vocab_size()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                 if not (literal and t.special)]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.lengths = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)])
        self.by_pieces = PieceEncoder(self.pieces)

    def texts(self, texts: Sequence[str]) -> Iterator[bytes]:
        """The ids of texts; those with the string of an added token go to the library whole."""
        found = [bool(self.added and self.added.search(t)) for t in texts]
        plain = self.by_pieces([t for t, whole in zip(texts, found) if not whole])
        for text, whole in zip(texts, found):
            yield np.array(next(self._encoded([text])), dtype="<u4").tobytes() if whole else next(plain)

    def pieces(self, pieces: Sequence[str]) -> list[bytes]:
        """Pieces are joined for the library and told apart by their lengths: a token has a mark for each byte."""
        found: list[bytes] = [b""] * len(pieces)
        plain = [p[0] == " " and len(p) > 1 and p[1:] == p.strip() for p in pieces]
        some, others = ([i for i, ok in enumerate(plain) if ok is wanted] for wanted in (True, False))
        groups = [some[i:i + TOGETHER] for i in range(0, len(some), TOGETHER)]
        names = [[pieces[i] for i in g] for g in groups]
        for group, own, encoding in zip(groups, names, self._encoded(map("".join, names))):
            ids = np.array(encoding, dtype="<u4")
            sizes = np.fromiter(map(len, map(str.encode, own)), np.int64, len(own))
            ends = (np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes)) * 4 + 4).tolist()
            data = ids.tobytes()
            for i, a, b in zip(group, [0, *ends], ends):
                found[i] = data[a:b]
        for i, ids in zip(others, self._encoded([pieces[i] for i in others])):
            found[i] = np.array(ids, dtype="<u4").tobytes()
        return found

    def _encoded(self, texts: Iterable[str]) -> Iterator[list[int]]:
        for text in texts:
            yield self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids  # without offsets


_sources: dict[bytes, str] = {}


@lru_cache(maxsize=2)
def _encoder(digest: bytes, literal: bool) -> LibraryEncoder:
    return LibraryEncoder(_sources[digest], literal)


def kept_encoder(tokenizer_json: str, literal: bool = False) -> LibraryEncoder:
    """The encoder of this worker, which knows the pieces of its earlier tasks."""
    digest = hashlib.sha256(tokenizer_json.encode()).digest()
    _sources[digest] = tokenizer_json
    return _encoder(digest, literal)


def encoded_segments(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     end_id: int | None = 0) -> DataFrame:
    """Segments of the texts' ids in the order of the documents' ids: part, seq, doc_ids, ends, payload."""
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    ordered = docs.select(quoted(id_col).cast("long").alias("id"), text_of(text_col).alias("text")) \
        .repartitionByRange("id").sortWithinPartitions("id", "text")
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_encoder(shared.value).texts
        part, seq, inside, size, held, names = TaskContext.get().partitionId(), 0, 0, 0, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                for name, ids in zip(some.column("id").to_pylist(), encode(some.column("text").to_pylist())):
                    held.append(ids + end)
                    names.append(name)
                    size += len(held[-1]) // 4
                    if size >= SEGMENT:
                        yield _segment(part, seq, inside, names, held)
                        seq, inside, size, held, names = seq + 1, inside + size, 0, [], []
        if held:
            yield _segment(part, seq, inside, names, held)

    return ordered.mapInArrow(run, "part int, seq int, inside long, doc_ids array<long>, ends array<long>, tokens long, "
                                   "payload binary")


def _segment(part: int, seq: int, inside: int, names: list, held: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([len(x) // 4 for x in held])
    columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([inside], pa.int64()),
               pa.array([names], pa.list_(pa.int64())),
               pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([int(ends[-1])], pa.int64()),
               pa.array([pack(np.frombuffer(b"".join(held), dtype="<u4"))], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "seq", "inside", "doc_ids", "ends", "tokens", "payload"])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    """Write the ids of all texts under ``path``; codes are stored as they are, so that nothing need be inflated."""
    encoded_segments(docs, tokenizer_path, **options).write.option("compression", "none").parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The written segments with ``start``, the number of ids in all segments before each."""
    rows = spark.read.parquet(path)
    totals = rows.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    # A row per part, of which there are as many as shuffle partitions; payloads are not moved.
    parts = totals.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("before"))
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("inside")).drop("before")


def documents(rows: DataFrame, of: Callable[[np.ndarray], int] = lambda ids: zlib.crc32(ids.astype("<u4").tobytes()),
              name: str = "ids_crc32", id_col: str = "doc_id") -> DataFrame:
    """Columns id, start, n_tokens and what ``of`` makes of each document's ids, read from ``segments``.

    Every document's first and last id are also looked up by rank, and must be those of the decoded levels.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, ends = Codes(row["payload"]), row["ends"]
                ids, begins = codes.all(), [0, *ends[:-1]]
                for b, e in zip(begins, ends):
                    if b < e and (codes[b], codes[e - 1]) != (ids[b], ids[e - 1]):
                        raise ValueError(f"a segment's rank directory is damaged near its token {b}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["start"] + b for b in begins], pa.int64()),
                     pa.array([e - b for b, e in zip(begins, ends)], pa.int64()),
                     pa.array([of(ids[b:e]) for b, e in zip(begins, ends)], pa.int64())],
                    [id_col, "start", "n_tokens", name])

    return rows.select("doc_ids", "ends", "start", "payload") \
        .mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, `{name}` long")


def tokens_at(rows: DataFrame, positions: DataFrame) -> DataFrame:
    """Columns position, id for global token positions, without decoding the segments.

    Positions meet segments by the megabyte of tokens they lie in; a long
    document's segment covers several.
    """
    span = F.sequence(F.floor(F.col("start") / SEGMENT), F.floor((F.col("start") + F.col("tokens") - 1) / SEGMENT))
    covering = rows.where("tokens > 0").select("start", "tokens", "payload", F.explode(span).alias("cell"))
    asked = positions.select("position", F.floor(F.col("position") / SEGMENT).alias("cell"))
    hits = covering.join(asked, "cell").where("position >= start AND position < start + tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [Codes(r["payload"])[r["position"] - r["start"]] for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(ids, pa.int64())], ["position", "id"])

    return hits.select("position", "start", "payload").mapInArrow(run, "position long, id long")
