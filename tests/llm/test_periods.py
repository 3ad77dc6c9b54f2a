"""Runs against every period and place in plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from loyaltide.llm import periods
from loyaltide.llm.queries import QUERIES


def plain_runs(words):
    n, least = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                least.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in least.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_query(spark, folder, duck):
    texts = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    got = {r.doc_id: r for r in QUERIES["op13_periods"](spark, folder).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        words = words_of(text)
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = plain_runs(words)
        assert got[i].n_runs == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (got[i].start, got[i].length, got[i].period) == best
        assert got[i].exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join("%d,%d,%d\n" % r for r in runs)
        assert got[i].runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert got[i].collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()


def made(rng):
    n = rng.choice([0, 1, 5, 6, 7, 20, 60, 200])
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    if n and rng.random() < .5:
        p, at = rng.randint(1, max(1, n // 4)), rng.randrange(n)
        for i in range(at + p, n):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_many_texts_together(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [made(rng) for _ in range(rng.randint(1, 12))]
        got = periods.runs_of([np.array(t, dtype=np.int64) for t in texts])
        assert [[tuple(r) for r in runs.tolist()] for runs in got] == [plain_runs(t) for t in texts]


def test_blocks_of_questions_and_texts_alter_nothing(monkeypatch):
    rng = random.Random(9)
    texts = [np.array(made(rng) + [1] * 30, dtype=np.int64) for _ in range(40)]
    whole = periods.runs_of(texts)
    monkeypatch.setattr(periods, "ASKED", 3)
    for a, b in zip(whole, periods.runs_of(texts)):
        assert a.tolist() == b.tolist()


def test_agreement():
    rng = np.random.default_rng(1)
    for size, letters in ((1, 1), (40, 1), (200, 2), (300, 30)):
        words = np.append(np.tile(rng.integers(0, letters, size), 3), letters)
        asks = periods.Agreement(words)
        i, j = rng.integers(0, len(words), (2, 500))
        i, j = i[i != j], j[i != j]
        plain = [next(k for k in range(len(words) + 1) if max(a, b) + k >= len(words) or words[a + k] != words[b + k])
                 for a, b in zip(i, j)]
        assert asks.ask(i, j).tolist() == plain


def test_long_texts():
    one = periods.runs_of([np.zeros(200_000, dtype=np.int64)])[0]
    assert one.tolist() == [[0, 200_000, 1]]
    block = np.random.default_rng(2).integers(0, 5_000, 20_000)
    many = periods.runs_of([np.concatenate([[7] * 5, np.tile(block, 6)])])[0]
    assert (many[:, 2] == 20_000).sum() == 1


def test_edges(spark, edges, none):
    names = set(edges.columns) | {"runs", "collapsed"}
    rows = periods.with_runs(edges).collect()
    assert set(rows[0].asDict()) == names and len(rows) == edges.count()
    for r in rows:
        words = words_of(r.text)
        if len(words) < 1_000:
            assert [tuple(x) for x in r.runs] == plain_runs(words) and r.collapsed == plain_collapsed(words, plain_runs(words))
        else:
            assert [tuple(x) for x in r.runs] == [(0, len(words), 1)] and r.collapsed == words[0]
    assert periods.with_runs(none).collect() == []
    with pytest.raises(ValueError, match="runs"):
        periods.with_runs(edges.withColumnRenamed("score", "runs"))
