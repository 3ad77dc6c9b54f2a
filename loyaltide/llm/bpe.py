"""Byte-level BPE, encoded and decoded by DuckDB inside each task.

A worker keeps the merge table in an in-memory DuckDB: a row for every two
tokens whose bytes together are a token, with that token's rank. New words of a
task are encoded together by a recursive query: the positions of each word's
tokens join the merge table, the leftmost pair of least rank is contracted, and
so on until no word has a pair left. Decoding joins the token positions of whole
texts with the vocabulary and aggregates the bytes in order.

Spark spreads the texts; a task holds a block of them and the words it has met.

The query's work grows with the square of a word's length, so a word of over
``LONG`` bytes, such as a run of letters without a blank, is contracted in the
same order with its pairs in a heap: n * log(n) for n bytes. Words that are
tokens themselves need neither.

Defined cases: null text counts as empty and has no tokens; control strings of
special tokens are ordinary text; repeated rows are encoded alike; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltide.llm.common import mapped, quoted, text_of
from loyaltide.llm.pieces import PieceEncoder

LONG = 400  # bytes of a word that the query contracts
WORDS = 25_000  # new words encoded by one query
TOKENS = 500_000  # token positions decoded by one query
ROWS = 500  # texts of an Arrow batch handled at once
KEPT = 250_000  # pieces a worker keeps beside its DuckDB

ENCODE = """
WITH RECURSIVE state(word, ids) USING KEY (word) AS (
  SELECT word, ids FROM words
  UNION ALL
  SELECT word, ids[:best % 4294967296 - 1] || [(best // 4294967296)::UINTEGER] || ids[best % 4294967296 + 2:]
  FROM state JOIN (
    SELECT word, min(merged * 4294967296 + position) AS best
    FROM (SELECT word, unnest(ids) AS a, unnest(ids[2:]) AS b, generate_subscripts(ids, 1) AS position FROM state)
    JOIN merges ON merges.pair = a::UBIGINT * 4294967296 + b
    GROUP BY word
  ) USING (word)
)
SELECT word, ids FROM state ORDER BY word
"""
DECODE = """
SELECT text, list(bytes ORDER BY position) AS parts FROM positions JOIN vocabulary USING (id) GROUP BY text
"""


class Coder:
    """Vocabulary and merge table of one rank file in a private DuckDB."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines() or [])}
        self.pattern = regex.compile(pattern)
        self.single = [self.ids[bytes([b])] for b in range(256)]
        pairs, merged = [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self.merges = dict(zip(pairs, merged))
        # Without a folder to spill into: a worker's own disk is not shared.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": ""})
        self.db.register("m", pa.table({"pair": pa.array(pairs, pa.uint64()), "merged": pa.array(merged, pa.uint64())}))
        self.db.register("v", pa.table({"id": pa.array(self.ids.values(), pa.uint32()),
                                        "bytes": pa.array(self.ids, pa.binary())}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM m; CREATE TABLE vocabulary AS SELECT * FROM v")
        self.texts = PieceEncoder(self.pieces, KEPT)

    def words(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of words that are not tokens themselves, by the recursive query."""
        found: list[bytes] = []
        for start in range(0, len(words), WORDS):
            block = words[start:start + WORDS]
            ends = np.cumsum([0, *map(len, block)], dtype=np.int32)
            singles = np.array(self.single, dtype=np.uint32)[np.frombuffer(b"".join(block), dtype=np.uint8)]
            self.db.register("words", pa.table({"word": pa.array(np.arange(len(block))),
                                                "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(singles))}))
            lists = self.db.sql(ENCODE).to_arrow_table().column("ids").combine_chunks()
            data, cuts = lists.values.to_numpy().astype("<u4").tobytes(), (lists.offsets.to_numpy() * 4).tolist()
            found += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return found

    def long_word(self, word: bytes) -> bytes:
        """The same for one word of any length: the least pair next, the leftmost of equal ones."""
        ids = [self.single[b] for b in word]
        last = len(ids)
        before, after = list(range(-1, last - 1)), list(range(1, last + 1))
        merged = self.merges.get
        heap = [(rank, i) for i in range(last - 1) if (rank := merged(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j == last or merged(ids[i] << 32 | ids[j]) != rank:
                continue  # one of the two is gone
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < last:
                before[k] = i
                if (new := merged(rank << 32 | ids[k])) is not None:
                    heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := merged(ids[h] << 32 | rank)) is not None:
                heappush(heap, (new, h))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()

    def pieces(self, pieces: Sequence[str]) -> list[bytes]:
        """The ids of pieces of text, as little-endian unsigned 32-bit integers."""
        cut = [self.pattern.findall(p) for p in pieces]
        distinct = dict.fromkeys(w for words in cut for w in words)
        unknown = []
        for word in distinct:
            raw = word.encode()
            whole = self.ids.get(raw)
            if whole is not None:
                distinct[word] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                distinct[word] = self.long_word(raw)
            else:
                unknown.append(word)
        distinct.update(zip(unknown, self.words([w.encode() for w in unknown])))
        return [b"".join(map(distinct.__getitem__, words)) for words in cut]

    def decode(self, texts: Sequence[bytes]) -> list[bytes]:
        """The bytes behind ids."""
        found: list[bytes] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) // 4 <= TOKENS):
                size += len(texts[end]) // 4
                end += 1
            lengths = np.array([len(t) // 4 for t in texts[start:end]])
            ids = np.frombuffer(b"".join(texts[start:end]), dtype="<u4")
            self.db.register("positions", pa.table({"text": np.repeat(np.arange(end - start), lengths),
                                                    "position": np.arange(len(ids)), "id": ids}))
            parts = self.db.sql(DECODE).to_arrow_table()
            block = [b""] * (end - start)
            joined = pa.compute.binary_join(parts.column("parts"), b"")
            for text, data in zip(parts.column("text").to_pylist(), joined.to_pylist()):
                block[text] = data
            found += block
            start = end
        return found


_ranks: dict[bytes, bytes] = {}


@lru_cache(maxsize=2)
def _coder(digest: bytes, pattern: str) -> Coder:
    return Coder(_ranks[digest], pattern)


def kept_coder(ranks: bytes, pattern: str) -> Coder:
    """The coder of this worker, which knows the pieces of its earlier tasks."""
    digest = hashlib.sha256(ranks).digest()
    _ranks[digest] = ranks
    return _coder(digest, pattern)


def _mapped(df: DataFrame, ranks_path: str, pattern: str, source: str, added: str, step,
            kind: tuple[str, pa.DataType] = ("binary", pa.binary())) -> DataFrame:
    """``df`` and a column ``added`` that ``step`` makes from column ``source``, with the worker's coder."""
    with open(ranks_path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    at_source, columns = df.columns.index(source), [f"c{i}" for i in range(len(df.columns) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_coder(shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                values = step(coder, part.column(at_source).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, kind[1])], columns)

    return mapped(df, run, (added, kind[0]))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id and ids: the ids of every text as little-endian unsigned 32-bit integers."""
    texts = docs.select(quoted(id_col).alias(id_col), text_of(text_col).alias("__text"))
    return _mapped(texts, ranks_path, pattern, "__text", "ids", lambda coder, t: list(coder.texts(t))).drop("__text")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes behind column ``ids``."""
    return _mapped(encoded, ranks_path, pattern, "ids", "decoded", lambda coder, t: coder.decode(t))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Columns id, ids and decoded: what ``decode`` makes of ``encode``, in one pass.

    Two passes in a row keep two Python workers a core busy, each with a
    DuckDB, a vocabulary and pieces of its own; this needs one of them.
    """
    def step(coder: Coder, texts: Sequence[str]) -> list[dict[str, bytes]]:
        ids = list(coder.texts(texts))
        return [{"ids": i, "decoded": d} for i, d in zip(ids, coder.decode(ids))]

    texts = docs.select(quoted(id_col).alias(id_col), text_of(text_col).alias("__text"))
    both = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])
    found = _mapped(texts, ranks_path, pattern, "__text", "__both", step,
                    ("struct<ids:binary,decoded:binary>", both))
    return found.select(quoted(id_col), "__both.ids", "__both.decoded")
