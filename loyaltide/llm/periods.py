"""Runs: stretches of a text's words that repeat with a period, and the text without the repeats.

A run is a stretch of at least ``max(shortest, times * q)`` words where words q
apart are identical, q being the smallest such number, that no neighbouring word
extends. The words of a whole text become numbers, and two structures answer how
far the words from i and from j agree, forwards and backwards:

* A difference cover of 13 has four residues. Only suffixes that begin at a
  place with such a residue are sorted: first by 13 words, then by ranks of
  sampled suffixes 13, 26, 52, ... words on, until all ranks differ.
* For any i and j some shift below 13 takes both to sampled places. Up to 12
  words are compared one by one; beyond, the answer is the least of the common
  prefixes between the two suffixes in sorted order, from a sparse table.

A run of period q holds three neighbouring anchors of the grid 0, q, 2q, ...
whose words equal those q further on, so over all periods a text of n words has
n * (1 + 1/2 + 1/3 + ...) anchors to look at, and one of every three such
neighbours, that with a number divisible by three, asks both structures for the
whole stretch. Texts with no such anchors need no structures.

Several texts are looked at together, each ended by a number of its own that
nothing equals, up to ``TOGETHER`` words at a time; a longer text goes alone.

Defined cases: null and empty texts have no runs; texts may be of any length (a
text of one word repeated n times asks n * ln(n) / 3 questions, ``ASKED`` at a
time); every row is looked at by itself, so ids may be null or repeat; an empty
table gives no rows; extra columns are kept as they are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loyaltide.llm.common import small_batches, text_of

# A difference cover of 13; every difference mod 13 is one of two of its members.
MODULUS = 13
COVER = (0, 1, 3, 9)
TOGETHER = 1 << 18  # words looked at together
ASKED = 1 << 18  # questions answered together
RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                                 T.StructField("period", T.LongType())]))

# For the residues of i and j the least shift that takes both into the cover.
SHIFT = np.array([[next(d for d in range(MODULUS) if (i + d) % MODULUS in COVER and (j + d) % MODULUS in COVER)
                   for j in range(MODULUS)] for i in range(MODULUS)], dtype=np.int64)


class Agreement:
    """How many words from i on equal those from j on, for many i and j at once.

    The last word must occur once, so that no two suffixes are alike.
    """

    def __init__(self, words: np.ndarray):
        self.size = len(words)
        # Behind the end stand numbers that equal nothing.
        self.words = np.concatenate([words, words.max(initial=0) + 1 + np.arange(2 * MODULUS)]).astype(np.int64)
        sampled = np.isin(np.arange(self.size + MODULUS) % MODULUS, COVER)
        places = np.flatnonzero(sampled)
        number = np.full(len(self.words) + 1, -1, dtype=np.int64)
        number[places] = np.arange(len(places))
        ranks = [self._by_words(places)]
        step = MODULUS
        while ranks[-1].max(initial=-1) + 1 < len(places):
            following = places + step
            inside = following < self.size + MODULUS
            second = np.full(len(places), -1, dtype=np.int64)
            second[inside] = ranks[-1][number[following[inside]]]
            ranks.append(self._dense(ranks[-1] * (len(places) + 1) + second + 1))
            step *= 2
        order = np.argsort(ranks[-1], kind="stable")
        self.rank = np.full(len(self.words) + 1, -1, dtype=np.int64)
        self.rank[places] = ranks[-1]
        self.table = self._least(self._common(places, order, ranks, number))

    @staticmethod
    def _dense(keys: np.ndarray) -> np.ndarray:
        return np.unique(keys, return_inverse=True)[1].astype(np.int64)

    def _by_words(self, places: np.ndarray) -> np.ndarray:
        """Ranks of sampled places by their first 13 words."""
        columns = [self.words[places + i] for i in range(MODULUS)]
        order = np.lexsort(columns[::-1])
        fresh = np.zeros(len(places), dtype=bool)
        for column in columns:
            fresh[1:] |= column[order[1:]] != column[order[:-1]]
        ranks = np.empty(len(places), dtype=np.int64)
        ranks[order] = np.cumsum(fresh)
        return ranks

    def _common(self, places, order, ranks, number) -> np.ndarray:
        """Words in common of each sampled suffix and the next in order: the longest steps first, then single words."""
        a, b = places[order[:-1]].copy(), places[order[1:]].copy()
        start = a.copy()
        end = self.size + MODULUS
        for k in range(len(ranks) - 1, -1, -1):
            live = np.flatnonzero((a < end) & (b < end))
            alike = live[ranks[k][number[a[live]]] == ranks[k][number[b[live]]]]
            a[alike] += MODULUS << k
            b[alike] += MODULUS << k
        return a - start + self._by_one(a, b, np.full(len(a), MODULUS))

    def _by_one(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from a and b on, at most ``most`` (13 or fewer)."""
        equal = np.zeros(len(a), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        for i in range(MODULUS):
            live = live[(equal[live] == i) & (most[live] > i)]
            if not len(live):
                break
            inside = np.maximum(a[live], b[live]) + i < len(self.words)
            live = live[inside]
            live = live[self.words[a[live] + i] == self.words[b[live] + i]]
            equal[live] += 1
        return equal

    @staticmethod
    def _least(common: np.ndarray) -> list[np.ndarray]:
        """Level k: the least of the 2**k values from each place on."""
        table = [common]
        while len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def ask(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of words that agree from i and j on; i and j differ."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        equal = self._by_one(i, j, shift)
        reached = np.flatnonzero(equal == shift)
        low, high = (self.rank[v[reached] + shift[reached]] for v in (i, j))
        low, high = np.minimum(low, high), np.maximum(low, high)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = level == k
            row = self.table[k]
            equal[reached[of]] += np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
        return equal


def anchors(words: np.ndarray, ends: np.ndarray, lengths: np.ndarray, shortest: int, times: int):
    """Blocks of (places, periods) that a run may pass through. Texts lie behind one another, the longest first."""
    most = int(lengths.max(initial=0)) // times
    found, size = [], 0
    for q in range(1, most + 1):
        # Only texts that are long enough for a run of this period.
        texts = int(np.searchsorted(-lengths, -max(shortest, times * q), side="right"))
        if not texts:
            break
        grid = words[:ends[texts - 1]:q]
        equal = grid[:-1] == grid[1:]
        three = equal[:-2] & equal[1:-1] & equal[2:]
        if not three.any():
            continue
        triple = np.flatnonzero(three)
        at = np.unique(triple + -triple % 3)  # of an anchor and the next two, the one divisible by three
        found.append((at * q, np.full(len(at), q)))
        size += len(at)
        if size >= ASKED:
            yield tuple(map(np.concatenate, zip(*found)))
            found, size = [], 0
    if found:
        yield tuple(map(np.concatenate, zip(*found)))


def runs_of(texts: list[np.ndarray], shortest: int = 6, times: int = 4) -> list[np.ndarray]:
    """Per text of word numbers (0 and up) its runs as rows (start, length, period), by start, then period."""
    if times < 4 or shortest < 6:
        raise ValueError("three neighbouring anchors need runs of at least 4 periods and 6 words")
    order = sorted((i for i, t in enumerate(texts) if len(t) >= max(shortest, times)), key=lambda i: -len(texts[i]))
    out = [np.empty((0, 3), dtype=np.int64) for _ in texts]
    if not order:
        return out
    lengths = np.array([len(texts[i]) for i in order])
    stops = -1 - np.arange(len(order))  # a number of its own behind each text
    words = np.concatenate([part for i, stop in zip(order, stops) for part in (texts[i], [stop])]).astype(np.int64)
    words += len(order)
    ends = np.cumsum(lengths + 1)
    forwards = backwards = None
    found = []
    for at, q in anchors(words, ends, lengths, shortest, times):
        if forwards is None:
            forwards, backwards = Agreement(words), Agreement(np.append(words[::-1], words.max() + 1))
        for k in range(0, len(at), ASKED):
            i, p = at[k:k + ASKED], q[k:k + ASKED]
            after = forwards.ask(i, i + p)
            mirrored = len(words) - 1 - i
            before = backwards.ask(mirrored, mirrored - p)  # counts the anchor's own word too
            start, length = i - before + 1, before + after - 1 + p
            long = (after > 0) & (length >= np.maximum(shortest, times * p))
            found.append(np.unique(np.stack([start[long], length[long], p[long]], axis=1), axis=0))
    if found:
        every = np.unique(np.concatenate(found), axis=0)
        # A stretch found with several periods has the least of them: rows are ordered by start, length, period.
        first = np.ones(len(every), dtype=bool)
        first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
        every = every[first]
        every = every[np.lexsort((every[:, 2], every[:, 0]))]
        text = np.searchsorted(ends, every[:, 0], side="right")
        cuts = np.searchsorted(text, np.arange(len(order) + 1))
        for n, i in enumerate(order):
            mine = every[cuts[n]:cuts[n + 1]].copy()
            mine[:, 0] -= ends[n] - lengths[n] - 1
            out[i] = mine
    return out


def without_repeats(size: int, runs: np.ndarray) -> np.ndarray | None:
    """Which words stay: all that no run contains after its first period. None for all."""
    if not len(runs):
        return None
    depth = np.zeros(size + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def _answered(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs and the text without repeats, of each text."""
    # bytes.split() cuts at exactly the six ASCII blanks.
    split = [t.split() for t in texts]
    number = defaultdict(count().__next__)
    runs = runs_of([np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in split])
    for words, mine in zip(split, runs):
        stays = without_repeats(len(words), mine)
        if stays is not None:
            words = [words[i] for i in np.flatnonzero(stays)]
        yield mine, b" ".join(words)


def _groups(column: pa.Array) -> Iterator[list[bytes]]:
    """Texts by about ``TOGETHER`` words, a word taken as four bytes at least."""
    group, size = [], 0
    for text in column.cast(pa.large_binary()):
        text = text.as_py()
        if group and size + len(text) > 4 * TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        done = [answer for group in _groups(batch.column(0)) for answer in _answered(group)]
        sizes = np.cumsum([0, *[len(r) for r, _ in done]])
        rows = np.concatenate([r for r, _ in done]) if done else np.empty((0, 3), dtype=np.int64)
        runs = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], fields=list(fields)))
        texts = pa.array([t for _, t in done], pa.large_binary()).cast(pa.large_string())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], runs, texts.cast(pa.string())],
                                         [f"c{i}" for i in range(1, batch.num_columns + 2)])


def with_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs",
              collapsed_col: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of every text (start and length in words) and its words without the repeats."""
    clash = {runs_col, collapsed_col} & set(docs.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)}; name the new ones otherwise")
    small_batches(docs.sparkSession)
    kinds = T.StructType([T.StructField(f"c{i + 1}", f.dataType) for i, f in enumerate(docs.schema)] + [
        T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    plain = docs.select(text_of(text_col).alias("text"), "*").toDF(*[f"c{i}" for i in range(len(docs.columns) + 1)])
    return plain.mapInArrow(_mapped, kinds).toDF(*docs.columns, runs_col, collapsed_col)
