"""SimHash near-duplicates, found by the generalised pigeonhole principle.

64-bit fingerprints that differ in at most ``radius`` bits are linked, and the
connected components of the links are the groups.

* Bits that go together are put in the same part, by their correlation over all
  distinct fingerprints. With thresholds t_1..t_m that add up to
  radius - m + 1, any two linked fingerprints are within t_i on some part i; a
  threshold of -1 leaves the part out. Dynamic programming picks the number of
  parts and the thresholds with the least probes and estimated candidates, so
  many fingerprints lead to fewer, longer parts and parts that tell little apart
  are left out.
* A probe is a bucket (mask, value): all fingerprints with these bits under the
  mask. Pairs are verified bucket by bucket with whole-array comparisons, and a
  bucket hands on a spanning forest of its links, never all its pairs.
* A bucket of more than ``LIMIT`` entries is refined: of radius + 1 blocks of
  its free bits, linked entries share one, so every entry moves to that many
  narrower buckets. No candidate is lost, and the work stays linear in the rows.
* Components are contracted round by round in stored tables.

Defined cases: a text without words has fingerprint 0, as has a null text; rows
with one fingerprint are always linked; an empty table gives no rows; of null
and repeated ids the smallest id that is not null names the component.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.llm.common import ROW, numbered, plain_columns, quoted, small_batches, text_of, without_rows
from loyaltide.plans.staging import stage

BITS = 64
LIMIT = 2048  # entries up to which a bucket is compared; larger ones are refined
FULL = (1 << BITS) - 1
PROBE_COST = 4.0  # of an entry that is moved and sorted, in comparisons
BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str, width: int = 3) -> int:
    """Unsigned fingerprint of one text: per bit the majority over the XXH64 values of its shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(width))))
        total = len(words) - width + 1
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, BLOCK):
        size = min(BLOCK, total - start)
        hashes = np.fromiter((digest(s, 42) for s in itertools.islice(shingles, size)), dtype="<u8", count=size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little")


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def fingerprints(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows`` and ``fp``, the fingerprint of column ``text`` as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), dtype=np.uint64,
                                count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), _signed(found)], [*keep, "fp"])

    small_batches(rows.sparkSession)
    kinds = ", ".join(f"`{k}` {dict(rows.dtypes)[k]}" for k in keep)
    return rows.select(*keep, "text").mapInArrow(run, f"{kinds}, fp long")


def pair_counts(values: DataFrame) -> tuple[np.ndarray, int]:
    """How often each two bits are both set, over all rows of ``fp``, and the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            for part in range(0, batch.num_rows, BLOCK):
                chunk = np.ascontiguousarray(batch.column(0).slice(part, BLOCK).to_numpy(zero_copy_only=False))
                bits = np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                rows += len(chunk)
        cell = np.append(np.arange(BITS * BITS), -1)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(both.ravel(), rows).astype(np.int64))],
                                         ["cell", "n"])

    sums = values.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = {r.cell: r.n for r in sums.collect()}  # 4,097 rows
    return np.array([table.get(i, 0) for i in range(BITS * BITS)], dtype=float).reshape(BITS, BITS), table.get(-1, 0)


def grouped_bits(both: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, each grown by the bit most correlated with it so far."""
    share = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs(both / max(rows, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free, groups = list(range(BITS)), []
    for part in range(parts):
        group = [free.pop(0)]
        for _ in range(BITS // parts + (part < BITS % parts) - 1):
            best = max(free, key=lambda b: (tie[b, group].mean(), -b))
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def long(value: int) -> Column:
    """An unsigned 64-bit value as Spark's signed long."""
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def bucket_sums(values: DataFrame, masks: list[int]) -> list[float]:
    """Per mask the sum of the squared bucket sizes: the pairs that agree under it."""
    keyed = values.select(F.explode(F.array(*map(long, masks))).alias("mask"), "fp") \
        .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    sizes = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = {r.mask % (1 << BITS): r.s for r in sizes.groupBy("mask").agg(F.sum(F.col("n") * F.col("n")).alias("s"))
            .collect()}  # a row per mask
    return [sums.get(m, 0.0) for m in masks]


def allocated(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up that add up to ``total`` at the least cost; costs[i][t + 1] is that of t on part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(part, start=-1):
                if done + t not in step or cost + more < step[done + t][0]:
                    step[done + t] = (cost + more, [*chosen, t])
        best = step
    return best[total]


def _within(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance that 0, 1, ..., most of independent bits differ, summed up."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for p in differ:
        chance[1:] = chance[1:] * (1 - p) + chance[:-1] * p
        chance[0] *= 1 - p
    return np.cumsum(chance)


def flips(bits: list[int], most: int) -> list[int]:
    """All masks of at most ``most`` of the bits."""
    return [mask_of(c) for n in range(most + 1) for c in itertools.combinations(bits, n)]


def plan(values: DataFrame, radius: int = 3) -> list[tuple[int, list[int]]]:
    """The parts to probe: (mask, flips), chosen over all distinct fingerprints."""
    both, rows = pair_counts(values)
    layouts = {m: grouped_bits(both, rows, m) for m in range(2, radius + 2)} if radius else {1: [list(range(BITS))]}
    masks = [mask_of(g) for groups in layouts.values() for g in groups]
    agree = dict(zip(masks, bucket_sums(values, masks)))
    share = np.diag(both) / max(rows, 1)
    differ = 2 * share * (1 - share)
    options = []
    for m, groups in layouts.items():
        costs = []
        for group in groups:
            near = _within(differ[group], radius)
            probes = np.cumsum([float(len(list(itertools.combinations(range(len(group)), n)))) for n in range(3)])
            same = agree[mask_of(group)]
            # Thresholds above 2 would need thousands of probes for each fingerprint.
            costs.append([0.0] + [PROBE_COST * rows * probes[t] + same * near[t] / max(near[0], 1e-30) / 2
                                  for t in range(min(radius, 2) + 1)])
        cost, chosen = allocated(costs, radius - m + 1)
        options.append((cost, [(mask_of(g), flips(g, t)) for g, t in zip(groups, chosen) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


def entries(values: DataFrame, probes: list[tuple[int, list[int]]]) -> DataFrame:
    """Rows (mask, value, fp, probe): every fingerprint in its bucket of each part, and as a probe in the near ones."""
    table = F.array(*[F.struct(long(mask).alias("mask"), F.array(*map(long, masks)).alias("flips"))
                      for mask, masks in probes])
    near = values.select("fp", F.explode(table).alias("part")) \
        .select("fp", "part.mask", F.explode("part.flips").alias("flip"))
    return near.select("mask", F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.col("mask")).alias("value"), "fp",
                       (F.col("flip") != 0).alias("probe"))


def refined(hot: DataFrame, radius: int) -> DataFrame:
    """Entries of buckets that are too large, in radius + 1 narrower buckets each."""
    def blocks(mask: int) -> list[int]:
        free = [b for b in range(BITS) if not mask >> b & 1]
        return [mask_of(free[i::radius + 1]) for i in range(radius + 1) if free[i::radius + 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, value, fp = (np.ascontiguousarray(batch.column(i).to_numpy(zero_copy_only=False)).view(np.uint64)
                               for i in range(3))
            probe = batch.column(3).to_numpy(zero_copy_only=False)
            for one in np.unique(mask):
                rows = mask == one
                for block in blocks(int(one)):
                    wide = np.full(int(rows.sum()), int(one) | block, dtype=np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(wide), _signed(value[rows] | (fp[rows] & np.uint64(block))), _signed(fp[rows]),
                         pa.array(probe[rows])], ["mask", "value", "fp", "probe"])

    return hot.mapInArrow(run, "mask long, value long, fp long, probe boolean")


def forest(size: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each of ``size`` nodes the smallest node of its component."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[first], label[second])
        before = label.copy()
        np.minimum.at(label, first, least)
        np.minimum.at(label, second, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def bucket_links(mask: np.ndarray, value: np.ndarray, fp: np.ndarray, probe: np.ndarray, radius: int) -> np.ndarray:
    """Spanning links (n x 2 fingerprints) within the buckets of sorted entries, by comparing rows 1, 2, ... apart."""
    size = len(fp)
    links: list[np.ndarray] = []
    held, step, at = 0, 1, np.arange(size - 1)
    while len(at):
        at = at[at + step < size]
        at = at[(value[at] == value[at + step]) & (mask[at] == mask[at + step])]
        other = at + step
        near = np.bitwise_count(fp[at] ^ fp[other]) <= radius
        near &= ~(probe[at] & probe[other]) & (fp[at] != fp[other])
        if near.any():
            links.append(np.stack([at[near], other[near]], axis=1))
            held += int(near.sum())
        if held > 4 * size + BLOCK:
            label = forest(size, *np.concatenate(links).T)
            nodes = np.flatnonzero(label != np.arange(size))
            links, held = [np.stack([nodes, label[nodes]], axis=1)], len(nodes)
        step += 1
    if not links:
        return np.empty((0, 2), dtype=np.uint64)
    label = forest(size, *np.concatenate(links).T)
    nodes = np.flatnonzero(label != np.arange(size))
    return np.unique(np.stack([fp[nodes], fp[label[nodes]]], axis=1), axis=0)


def links(values: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the radius that connect the same ones as all such pairs do."""
    if radius < 0 or radius > 3:
        raise ValueError("the radius must be 0 to 3")
    level = entries(values, plan(values, radius))
    cold = None
    while True:
        sizes = level.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        hot = stage(sizes.where(F.col("n") > LIMIT).select("mask", "value"), "hot")
        if hot.isEmpty():
            cold = level if cold is None else cold.unionByName(level)
            break
        fit = level.join(hot, ["mask", "value"], "left_anti")
        cold = fit if cold is None else cold.unionByName(fit)
        narrower = refined(level.join(hot, ["mask", "value"], "left_semi").select("mask", "value", "fp", "probe"), radius)
        level = stage(narrower.distinct(), "refined")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) < BLOCK:
                    continue
            if not held:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            mask, value, fp = (np.ascontiguousarray(table.column(i).to_numpy()).view(np.uint64) for i in range(3))
            probe = table.column(3).to_numpy()
            end = len(fp)
            if batch is not None:  # the last bucket may go on; it has LIMIT entries at most
                new = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
                end = int(new[-1]) + 1 if len(new) else 0
            found = bucket_links(mask[:end], value[:end], fp[:end], probe[:end], radius)
            held = table.slice(end).to_batches() if end < len(fp) else []
            if len(found):
                yield pa.RecordBatch.from_arrays([_signed(found[:, 0].copy()), _signed(found[:, 1].copy())], ["a", "b"])

    return cold.select("mask", "value", "fp", "probe").repartition("mask", "value") \
        .sortWithinPartitions("mask", "value", "fp").mapInArrow(run, "a long, b long")


def labels(edges: DataFrame) -> DataFrame:
    """Columns node, label for the nodes of the links (a, b): nodes of one component share a label.

    Each round puts the nodes in an order of its own, by a hash, maps every node
    to the first of itself and its neighbours, and contracts the links. A node
    stays only if it comes first for itself or a neighbour, so of a chain some
    half are left, whatever their numbers: rounds grow with the logarithm of the
    longest chain.
    """
    edges = stage(edges.distinct(), "edges")
    result, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def ranked(node: str):
            return F.struct(F.xxhash64(node, F.lit(turn)), F.col(node))

        first = F.least(ranked("a").cast("struct<h:long,n:long>"), F.min(ranked("b").cast("struct<h:long,n:long>")))
        step = stage(both.groupBy("a").agg(first.alias("first")).select("a", F.col("first.n").alias("to")), "step")
        if result is None:
            result = step.select(F.col("a").alias("node"), F.col("to").alias("label"))
        else:
            moved = step.select(F.col("a").alias("label"), "to")
            result = stage(result.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")),
                           "labels")
        left = step.select("a", F.col("to").alias("x"))
        right = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = stage(edges.join(left, "a").join(right, "b").where("x <> y")
                      .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if result is None else result


def grouped(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``prints`` (id, fp, ...) with component_id, the smallest id of the component. ``prints`` should be stored."""
    values = stage(prints.groupBy("fp").agg(F.min("id").alias("least")), "values")
    mapped = labels(links(values, radius))
    rooted = values.join(mapped.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("label", "fp").alias("label"))
    smallest = rooted.groupBy("label").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(smallest, "label").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id."""
    prints = stage(fingerprints(docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text")), ["id"]), "prints")
    return grouped(prints, radius).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0"))
                                          .alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay, the one with the smallest id of each group, with all their columns."""
    plain, at = plain_columns(docs)
    rows = numbered(plain, "rows")
    prints = stage(fingerprints(rows.select(ROW, F.col(at(id_col)).alias("id"), text_of(at(text_col)).alias("text")),
                                [ROW, "id"]), "prints")
    # Rows are numbered in the order of (id, row), so that the smallest number is one row even if ids repeat.
    order = prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", ROW)).alias("id"))
    kept = grouped(order, radius).groupBy("component_id").agg(F.min("id").alias("id")).select(f"id.{ROW}")
    return without_rows(rows, prints.select(ROW).join(kept, ROW, "left_anti")).toDF(*docs.columns)
