"""Vector codes against integer k-means in plain Python, and the bounds against whole comparisons."""

import math
import random

import numpy as np
import pytest

from loyaltide.llm import veccodes


def plain(rows, parts=8, entries=16, rounds=6):
    """{row number: (code, error)} and the codebooks of (id, vector) rows, all of one length."""
    live = [i for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    live.sort(key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    ints = {i: [math.floor(4096 * int(x)) if abs(x) > 2 ** 60 else math.floor(4096 * x) for x in rows[i][1]] for i in live}
    width = -(-len(ints[live[0]]) // parts)
    cut = {i: [(v + [0] * parts)[p * width:(p + 1) * width] for p in range(parts)] for i, v in ints.items()}
    for v in cut.values():
        for part in v:
            part += [0] * (width - len(part))
    books = [[cut[i][p] for i in live[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        own = {i: [nearest(cut[i][p], books[p])[1] for p in range(parts)] for i in live}
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in live if own[i][p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = {}
    for i in live:
        best = [nearest(cut[i][p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{e:02x}" for _, e in best), min(sum(d for d, _ in best), 2 ** 63 - 1))
    return out, books


def check(spark, rows, kind="float", **settings):
    df = spark.createDataFrame([(i, v, n, "x", 0) for n, (i, v) in enumerate(rows)],
                               f"vec_id long, embedding array<{kind}>, label int, near string, keys int")
    got, books = veccodes.codes(df, **settings)
    stored = [r.embedding for r in df.orderBy("label").collect()]
    wanted, wanted_books = plain([(i, v) for (i, _), v in zip(rows, stored)])
    assert books == wanted_books
    assert {r.label: (r.code, r.error) for r in got.collect()} == wanted


def vectors(seed, number, size=16):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, .3) for c in rng.choice(centres)]) for i in range(number)]


def test_clustered_vectors_use_the_bounds(spark):
    seen = []
    check(spark, vectors(1, 700), seen=lambda lists, opened: seen.append((lists, opened)))
    whole = [sum(o[-1] for o in opened) / sum(map(sum, opened)) for _, opened in seen]
    assert whole[0] == 1 and max(whole[2:]) < 0.5
    assert sum(opened[p][0] for _, opened in seen[1:] for p in range(8)) > 0


def test_ties_repeats_and_small_grids(spark):
    rng = random.Random(2)
    check(spark, [(rng.randrange(40), [rng.choice([0.0, 0.25, -0.25, 1e-5]) for _ in range(8)]) for _ in range(200)])


def test_rows_that_are_left_out(spark):
    rows = vectors(3, 60)
    rows += [(-5, None), (-4, [None] * 16), (-3, [float("nan")] * 16), (-2, [float("inf")] + [0.0] * 15), (None, [0.5] * 16)]
    check(spark, rows)


def test_few_vectors_and_a_length_that_parts_do_not_divide(spark):
    check(spark, vectors(4, 5, size=19))
    check(spark, vectors(5, 1, size=8))


def test_huge_components(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1, -1]) * 10.0 ** rng.randint(-3, 30) for _ in range(8)]) for i in range(50)]
    check(spark, rows)
    check(spark, rows, kind="double")


def test_another_length_is_left_out(spark):
    rows = vectors(7, 30) + [(900, [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS label")
    got, _ = veccodes.codes(df)
    assert sorted(r.id for r in got.collect()) == list(range(30))


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    got, books = veccodes.codes(df)
    assert got.collect() == [] and books == [[]] * 8


@pytest.mark.parametrize("b", [1, 3, 6])
def test_bounds_never_change_an_answer(b):
    """Many moves of a codebook, each answered with bounds and by whole comparison."""
    rng = np.random.default_rng(b)
    x = rng.integers(-50, 50, (500, 4))
    book = x[:16].copy()
    own, ids, low, outer, _ = veccodes.compared(x, book, b)
    for _ in range(12):
        fresh = book + rng.integers(-6, 7, book.shape)
        moves = np.array([veccodes._distance(m, n) for m, n in zip(book, fresh)])
        book = fresh
        own, ids, low, outer, best, _ = veccodes.moved(x, book, moves, own, ids, low, outer)
        squared = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (own == squared.argmin(axis=1)).all() and (best == squared.min(axis=1)).all()
        assert (low <= np.sqrt(np.take_along_axis(squared, ids, 1))).all()


def test_lists_adapt():
    assert veccodes.adapted(4, [960, 40, 0, 0, 0] + [0] * 12) == 2
    assert veccodes.adapted(4, [500, 100, 100, 300, 0] + [0] * 12) == 3
    assert veccodes.adapted(4, [500] + [0] * 15 + [500]) == 8
