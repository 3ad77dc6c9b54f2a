"""Vector codes by integer k-means per part, with adaptive bounds that save distances.

A vector's components become integers and are cut into equal parts; every part
position has a codebook of ``entries`` vectors. A round assigns each part to its
nearest entry and moves the entries to their parts' means. All of that is exact
integer work; floating point only decides which distances need no computing.

With every part is kept, from round to round: its entry, the next b closest
entries with lower bounds of their distances in ascending order, and one bound
for all entries beyond. After a move the bounds fall by what their entries moved
(the outer one by the largest move) and are made ordered again. Entries whose
bound is above the exact distance to the part's own entry cannot be nearer or as
near; the others are computed as integers, ties going to the lower index. Only a
part whose outer bound fails too is compared with the whole codebook. b adapts
per position: it shrinks to what 95 of 100 parts needed, and doubles if a
quarter of them had to be compared with the whole codebook.

A round is one narrow pass that writes vectors and bounds for the next one; the
previous copy is then removed, so a lost executor costs no more than its tasks
and at most two copies are on disk. Each task adds one row with its sums, which
Spark adds up per entry and component: what reaches the driver has the size of
the codebooks. Sums travel in limbs of 30 bits, so none overflows.

Defined cases: rows are dropped whose vector is null or has null or non-finite
components, or a length other than the commonest one (of equally common ones the
longer); a length that the number of parts does not divide is filled up with
zeros; fewer vectors than entries make a smaller codebook; ids may be null
(after all others) and repeat (ordered by vector); an empty table has no codes;
components too large for 64 bits are computed in Python's integers, without
bounds; an error above 2^63-1 is given as that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyaltide.llm.common import quoted
from loyaltide.plans.staging import remove_path, scratch_path

SLACK = 1e-9  # relative; covers rounding in bounds many times over
LIMB = 30
LARGEST = 2 ** 63 - 1


def kept(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id, label, vec of the rows that take part."""
    vec = quoted(vec_col)
    kind = vectors.select(vec.alias("v")).schema[0].dataType
    if not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        vec = vec.cast("array<double>")
    rows = vectors.select(quoted(id_col).alias("id"), quoted(label_col).alias("label"), vec.alias("vec")).where(
        F.col("vec").isNotNull() & F.forall("vec", lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False))))
    length = rows.groupBy(F.size("vec").alias("length")).count().agg(F.max_by("length", F.struct("count", "length")))
    return rows.where(F.size("vec") == length.scalar())


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value), in 64 bits where squares of differences fit, else as Python's integers."""
    with np.errstate(over="ignore"):
        scaled = values.astype(np.float64) * scale
    # A scale that is a power of two loses no digit, so floor is exact.
    if not scaled.size or (scale & (scale - 1) == 0 and np.abs(scaled).max() < 2 ** 26):
        return np.floor(scaled).astype(np.int64)
    exact = np.frompyfunc(lambda x: x.as_integer_ratio()[0] * scale // x.as_integer_ratio()[1], 1, 1)
    return exact(values.astype(np.float64).astype(object))


def fitting(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in 64 bits if sums of squared differences surely fit, else both as Python's integers."""
    width = max(x.shape[1], 1)
    most = max((int(np.abs(v).max()) for v in (x, book) if v.size), default=0)
    kind = np.int64 if width * (2 * most) ** 2 < 2 ** 62 else object
    return x.astype(kind), book.astype(kind)


def _squares(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=-1)


def _low(squared: np.ndarray) -> np.ndarray:
    """Lower bounds of distances; none for Python's integers."""
    if squared.dtype == object:
        return np.full(squared.shape, -np.inf)
    return np.sqrt(squared.astype(np.float64)) * (1 - SLACK)


def _high(squared: np.ndarray) -> np.ndarray:
    if squared.dtype == object:
        return np.full(squared.shape, np.inf)
    return np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def compared(x: np.ndarray, book: np.ndarray, b: int):
    """Entry, b next entries, their bounds, outer bound, exact square, by the whole codebook."""
    squared = _squares(x[:, None, :] - book[None])
    order = np.argsort(squared, axis=1, kind="stable")[:, :b + 2]
    near = np.take_along_axis(squared, order, 1)
    low = _low(near)
    outer = low[:, b + 1] if order.shape[1] > b + 1 else np.full(len(x), np.inf)
    return order[:, 0], order[:, 1:b + 1], low[:, 1:b + 1], outer, near[:, 0]


def moved(x: np.ndarray, book: np.ndarray, moves: np.ndarray, own, ids, low, outer):
    """The same after the entries moved, and how many bounds each part had to open (all: len(book))."""
    with np.errstate(invalid="ignore"):
        fell = np.concatenate([moves[ids], np.full((len(x), 1), moves.max())], axis=1)
        low = np.concatenate([low, outer[:, None]], axis=1)
        low = low - fell - SLACK * (np.abs(low) + fell)
        low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].copy()
    own, ids = own.copy(), ids.copy()
    best = _squares(x - book[own])
    high = _high(best)
    need = (low[:, :-1] <= high[:, None]).sum(axis=1)
    far = low[:, -1] > high
    open_ = np.flatnonzero(far & (need > 0))
    if len(open_):
        m = need[open_].max()
        tried = np.concatenate([own[open_, None], ids[open_, :m]], axis=1)
        squared = _squares(x[open_, None, :] - book[tried])
        order = np.lexsort((tried, squared), axis=-1)
        tried, squared = np.take_along_axis(tried, order, 1), np.take_along_axis(squared, order, 1)
        own[open_], best[open_], ids[open_, :m] = tried[:, 0], squared[:, 0], tried[:, 1:]
        low[open_, :m] = _low(squared[:, 1:])
        low[open_] = np.minimum.accumulate(low[open_, ::-1], axis=1)[:, ::-1]
    lost = np.flatnonzero(~far)
    low, outer = low[:, :-1], low[:, -1].copy()
    if len(lost):
        own[lost], ids[lost], low[lost], outer[lost], best[lost] = compared(x[lost], book, ids.shape[1])
        need[lost] = len(book)
    return own, ids, low, outer, best, need


def _limbs(key: int, value: int) -> Iterator[tuple[int, int]]:
    sign, value, at = (1, value, 0) if value >= 0 else (-1, -value, 0)
    while value:
        yield key * 128 + at, sign * (value & ((1 << LIMB) - 1))
        value, at = value >> LIMB, at + 1


class Round:
    """One pass over the vectors, run in tasks: ``stored`` lists per part come in, ``kept`` go out."""

    def __init__(self, books: list[np.ndarray], moves: list[np.ndarray] | None, stored: list[int], kept: list[int],
                 scale: int, last: bool):
        self.books, self.moves, self.stored, self.kept = books, moves, stored, kept
        self.scale, self.last = scale, last

    def parts(self, batch: pa.RecordBatch) -> np.ndarray:
        """The batch's integers as rows x parts x width."""
        column, parts = batch.column(2), len(self.books)
        values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        values = np.pad(values, ((0, 0), (0, -values.shape[1] % parts)))
        return whole_numbers(values, self.scale).reshape(len(column), parts, -1)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, number = len(self.books), len(self.books[0])
        totals, opened, kinds = None, np.zeros((parts, number + 1), dtype=np.int64), None
        for batch in batches:
            if not len(batch):
                continue
            x = self.parts(batch)
            if totals is None:
                totals = [np.zeros((number, x.shape[2] + 1), dtype=object) for _ in range(parts)]
            near, bounds, errors = [], [], 0
            ids_at = bounds_at = 0
            if self.moves is not None:
                old_ids = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(batch), -1)
                old_low = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.float32).reshape(len(batch), -1)
            for p in range(parts):
                mine, book = fitting(x[:, p], self.books[p])
                b, have = self.kept[p], self.stored[p]
                if self.moves is None or b > have:
                    own, ids, low, outer, best = compared(mine, book, b)
                    need = np.full(len(batch), number)
                else:
                    ids = old_ids[:, ids_at:ids_at + have + 1].astype(np.int64)
                    low = old_low[:, bounds_at:bounds_at + have + 1].astype(np.float64)
                    # A shorter list: the first bound left out, the least of them, bounds all beyond.
                    own, ids, low, outer = ids[:, 0], ids[:, 1:b + 1], low[:, :b], low[:, b]
                    own, ids, low, outer, best, need = moved(mine, book, self.moves[p], own, ids, low, outer)
                ids_at, bounds_at = ids_at + have + 1, bounds_at + have + 1
                near.append(np.concatenate([own[:, None], ids], axis=1).astype(np.uint8))
                if self.last:
                    errors = errors + best.astype(object)
                    continue
                bounds.append(np.concatenate([low, outer[:, None]], axis=1))
                opened[p] += np.bincount(need, minlength=number + 1)
                chosen = (own[None] == np.arange(number)[:, None]).astype(mine.dtype)
                totals[p][:, :-1] += chosen @ mine
                totals[p][:, -1] += chosen.sum(axis=1)
            if self.last:
                code = [row.tobytes().hex() for row in np.concatenate(near, axis=1)[:, np.cumsum(
                    [0, *[b + 1 for b in self.kept[:-1]]])]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(code, pa.string()),
                     pa.array([min(int(e), LARGEST) for e in errors], pa.int64())], ["id", "label", "code", "error"])
                continue
            # Bounds are stored short, rounded down.
            with np.errstate(over="ignore"):
                short = np.nextafter(np.concatenate(bounds, axis=1).astype(np.float32), np.float32(-np.inf))
            kinds = batch.schema
            yield self.row(batch.column(0), batch.column(1), batch.column(2),
                           pa.array([r.tobytes() for r in np.concatenate(near, axis=1)], pa.binary()),
                           pa.array([r.tobytes() for r in short], pa.binary()), None, None)
        if totals is not None and not self.last:
            pairs = [pair for p in range(parts) for e in range(number) for i, v in enumerate(totals[p][e])
                     for pair in _limbs((p * number + e) * len(totals[p][e]) + i, int(v))]
            pairs += [(-1 - (p * (number + 1) + n), int(v)) for p in range(parts) for n, v in enumerate(opened[p]) if v]
            yield self.row(*[pa.nulls(1, kinds.field(i).type) for i in range(3)], pa.nulls(1, pa.binary()),
                           pa.nulls(1, pa.binary()), [[k for k, _ in pairs]], [[v for _, v in pairs]])

    @staticmethod
    def row(identity, label, vec, near, bounds, keys, sums) -> pa.RecordBatch:
        size, longs = len(identity), pa.list_(pa.int64())
        lists = [pa.nulls(size, longs) if v is None else pa.array(v, longs) for v in (keys, sums)]
        return pa.RecordBatch.from_arrays([identity, label, vec, near, bounds, *lists],
                                          ["id", "label", "vec", "near", "bounds", "keys", "sums"])


def _added_up(table: DataFrame, parts: int, number: int, width: int):
    """Sums and counts per part and entry, and per part how many parts opened how many bounds."""
    rows = table.where(F.col("keys").isNotNull()).select(F.explode(F.arrays_zip("keys", "sums")).alias("z")) \
        .groupBy(F.col("z.keys").alias("key")).agg(F.sum("z.sums").alias("value")).collect()
    totals = [[[0] * (width + 1) for _ in range(number)] for _ in range(parts)]
    opened = [[0] * (number + 1) for _ in range(parts)]
    for key, value in rows:
        if key < 0:
            opened[(-1 - key) // (number + 1)][(-1 - key) % (number + 1)] = value
        else:
            place, limb = divmod(key, 128)
            entry, i = divmod(place, width + 1)
            totals[entry // number][entry % number][i] += value << (LIMB * limb)
    return totals, opened


def adapted(b: int, opened: list[int]) -> int:
    """The length of the lists of the next round."""
    number, total = len(opened) - 1, sum(opened)
    if opened[number] * 4 > total:
        return max(b, min(2 * b, number // 2))
    settled, so_far = total - opened[number], 0
    for needed in range(b + 1):
        so_far += opened[needed]
        if so_far * 100 >= settled * 95:
            break
    return min(b, max(needed, number // 8))


def _distance(a: list[int], b: list[int]) -> float:
    squared = sum((int(x) - int(y)) ** 2 for x, y in zip(a, b))
    try:
        return (math.isqrt(squared) + 1) * (1 + SLACK) if squared else 0.0
    except OverflowError:
        return math.inf


def codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
          parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
          seen: Callable[[list[int], list[list[int]]], None] | None = None) -> tuple[DataFrame, list[list[list[int]]]]:
    """(id, label, code, error) of every row kept, and the codebooks: part, entry, components.

    Codebooks start as the vectors of the smallest ids. ``code`` has two hex
    digits per part, so at most 256 entries; ``error`` is the squared distance.
    ``seen`` is told every round's list lengths and how many parts opened how many bounds.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code's two hex digits name 1 to 256 entries")
    spark = vectors.sparkSession
    rows = kept(vectors, id_col, vec_col, label_col)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    fields = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])  # the rows with sums hold nulls
    result = T.StructType([fields["id"], fields["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    if not first:
        return spark.createDataFrame([], result), [[] for _ in range(parts)]
    start = np.array([r.vec for r in first], dtype=np.float64).reshape(len(first), -1)
    start = whole_numbers(np.pad(start, ((0, 0), (0, -start.shape[1] % parts))), scale)
    number, width = len(first), start.shape[1] // parts
    books = [start[:, p * width:(p + 1) * width].astype(object) for p in range(parts)]
    state = T.StructType([*fields, T.StructField("near", T.BinaryType()), T.StructField("bounds", T.BinaryType()),
                          T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sums", T.ArrayType(T.LongType()))])
    moves, path = None, None
    stored = lists = [min(max(number // 4, 1), number - 1)] * parts
    for i in range(rounds + 1):
        last = i == rounds
        step, before = Round(books, moves, stored, lists, scale, last), path
        path = scratch_path(spark, f"codes-{i}")
        rows.mapInArrow(step, result if last else state).write.parquet(path)
        if before:
            remove_path(spark, before)
        if last:
            break
        table = spark.read.schema(state).parquet(path)
        totals, opened = _added_up(table, parts, number, width)
        if seen:
            seen(lists, opened)
        fresh = [np.array([[v // t[-1] for v in t[:-1]] if t[-1] else list(old) for t, old in zip(total, book)],
                          dtype=object).reshape(number, width) for total, book in zip(totals, books)]
        moves = [np.array([_distance(a, b) for a, b in zip(old, new)]) for old, new in zip(books, fresh)]
        stored, books = lists, fresh
        lists = lists if i == 0 else [adapted(b, o) for b, o in zip(lists, opened)]
        rows = table.where(F.col("keys").isNull()).select("id", "label", "vec", "near", "bounds")
    return spark.read.schema(result).parquet(path), [[[int(v) for v in e] for e in book] for book in books]
