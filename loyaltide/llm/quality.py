"""Text quality by the votes of the nearest labelled texts.

A text is a bag of hashed terms: four-byte shapes (letters by case, digits and
foreign letters each as one), three-byte strings, and levels of how often words
repeat. Weighted by rarity and reduced by a truncated SVD of the labelled texts,
bags become latent-semantic vectors. The labelled vectors are broadcast, every
text is multiplied with all of them in blocks, and its nearest ones vote,
weighted by a power of their cosine.

Only the labels of at most ``most`` rows are learned from, a documented bound
that also bounds the broadcast; they are drawn by a hash of the id, and never
from the held-out fifth. All texts are scored whole.

Defined cases: texts without a term, null texts too, get the share of good
labels, as all texts do if nothing is near; without any labels scores are 0.5;
null labels are ignored, of contradicting ones the worse counts; an empty table
gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.llm.common import mapped, quoted, small_batches, text_of

SHAPES, STRINGS = 2048, 2048
SAME, DISTINCT = (0.02, 0.1, 0.3, 0.6), (0.5, 0.3, 0.1)  # levels of repeated neighbours, of distinct words
TERMS = SHAPES + STRINGS + len(SAME) + len(DISTINCT)
STRETCH = 1 << 20  # bytes whose terms are counted at once
ROWS = 256

_shape = np.arange(256, dtype=np.uint32)
_shape[97:123], _shape[65:91], _shape[48:58], _shape[128:] = 97, 65, 48, 98
_blank = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_place = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _grams(codes: np.ndarray, width: int, buckets: int) -> np.ndarray:
    """Counts of hashed runs of ``width`` codes."""
    count = len(codes) - width + 1
    if count < 1:
        return np.zeros(buckets)
    mixed = np.zeros(count, dtype=np.uint32)
    for i in range(width):
        mixed = mixed * np.uint32(0x01000193) + codes[i:i + count]
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.bincount((mixed ^ (mixed >> np.uint32(12))) & np.uint32(buckets - 1), minlength=buckets)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    blank = _blank[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    since = np.arange(len(data)) - np.repeat([0, *starts[1:]], np.diff([0, *starts[1:], len(data)]))
    values = np.where(blank, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * _place[since & 63])
    return np.add.reduceat(values, starts)


def terms(text: str) -> np.ndarray:
    """Counts of the terms of one text; where it is cut into stretches makes no difference."""
    counts = np.zeros(TERMS, dtype=np.float64)
    whole = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    same = words = begin = held = 0
    last, distinct, new = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64), []
    for at in range(0, len(whole), STRETCH):
        end = min(at + STRETCH, len(whole))
        counts[:SHAPES] += _grams(_shape[whole[max(at - 3, 0):end]], 4, SHAPES)
        counts[SHAPES:SHAPES + STRINGS] += _grams(whole[max(at - 2, 0):end].astype(np.uint32), 3, STRINGS)
        if end < len(whole):  # words are cut at blanks
            blanks = np.flatnonzero(_blank[whole[at:end]])
            if not len(blanks):
                continue
            end = at + int(blanks[-1]) + 1
        hashes, begin = _word_hashes(whole[begin:end]), end
        words += len(hashes)
        row = np.concatenate([last, hashes])
        same += int((row[1:] == row[:-1]).sum())
        last = row[-1:]
        new.append(hashes)
        held += len(hashes)
        if held > len(distinct) or end == len(whole):  # so that the set is merged a few times only
            distinct, new, held = np.unique(np.concatenate([distinct, *new])), [], 0
    if new:
        distinct = np.unique(np.concatenate([distinct, *new]))
    if words > 1:
        levels = [same / words > level for level in SAME] + [len(distinct) / words < level for level in DISTINCT]
        counts[SHAPES + STRINGS:] = np.array(levels) * words
    return counts


@dataclass
class Model:
    """Rarity of terms, their latent directions, and the labelled vectors with their labels."""

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    sharpness: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of rows of term counts; rows without terms stay zero."""
        latent = (np.log1p(counts).astype(np.float32) * self.rarity) @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of good labels among the nearest."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(counts), prior)
        cosine = self.project(counts) @ self.vectors.T
        near = min(self.neighbours, cosine.shape[1])
        best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
        weight = np.maximum(np.take_along_axis(cosine, best, axis=1), 0).astype(float) ** self.sharpness
        total = weight.sum(axis=1)
        voted = (weight * self.labels[best]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.round(np.where(total > 0, voted, prior), 6)


def held_out(id_column: Column) -> Column:
    """Whether a row is of the fifth that is never learned from."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        most: int = 4000, dimensions: int = 64, neighbours: int = 15, sharpness: float = 8.0) -> Model:
    """Learn from at most ``most`` labelled rows of ``docs``."""
    small_batches(docs.sparkSession)
    known = labels.select(quoted(id_col).alias("id"), quoted(label_col).alias("label")).where(
        F.col("label").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"))
    drawn = known.orderBy(F.xxhash64("id"), "id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text in batch.column("text"):
                counts = terms(text.as_py())
                used = np.flatnonzero(counts)
                packed.append(pickle.dumps((used.astype(np.uint16), counts[used].astype(np.float32))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label").cast(pa.int32()),
                                              pa.array(packed, pa.binary())], ["id", "label", "terms"])

    texts = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(drawn), "id")
    bags = texts.withColumn("id", F.col("id").cast("string")).mapInArrow(run, "id string, label int, terms binary")
    rows = bags.orderBy(F.xxhash64("id", "terms"), "terms").limit(most).collect()  # `most` rows of a few kB
    counts = np.zeros((len(rows), TERMS), dtype=np.float32)
    for row, found in zip(counts, rows):
        used, values = pickle.loads(found.terms)
        row[used] = values
    good = np.array([r.label for r in rows], dtype=float)
    rarity = np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32)
    if not len(rows):
        return Model(rarity, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), good, neighbours, sharpness)
    weighed = np.log1p(counts) * rarity
    weighed /= np.maximum(np.linalg.norm(weighed, axis=1, keepdims=True), 1e-12)
    directions = _truncated(weighed, min(dimensions, len(rows)))
    model = Model(rarity, directions, np.zeros((0, 1)), good, neighbours, sharpness)
    model.vectors = model.project(counts).astype(np.float32)
    return model


def _truncated(rows: np.ndarray, dimensions: int, extra: int = 16, rounds: int = 4) -> np.ndarray:
    """The first right singular vectors, by subspace iteration from a fixed start."""
    start = np.random.default_rng(0).normal(size=(rows.shape[1], dimensions + extra)).astype(np.float32)
    basis = np.linalg.qr(rows @ start)[0]
    for _ in range(rounds):
        basis = np.linalg.qr(rows @ (rows.T @ basis))[0]
    return np.ascontiguousarray(np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:dimensions].T)


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` and the score of each text, with all columns; raises if the input has one named ``score_col``."""
    if score_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column {score_col}; name the score otherwise")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, columns = docs.columns.index(text_col), [f"c{i}" for i in range(len(docs.columns) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts = np.stack([terms(t.as_py() or "") for t in part.column(text_at)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(counts))], columns)

    return mapped(docs, run, (score_col, "double"))
