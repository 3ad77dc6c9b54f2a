"""Rules by host against a plain version, on texts made to be awkward."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loyaltide.llm import hostrules

BLANK = "[\x20\x09-\x0d]+"


def plain(text):
    text = text or ""
    words = [w for w in re.split(BLANK, text) if w]
    lines = [line for line in text.split("\n") if re.sub(BLANK, "", line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered))


def plain_verdicts(rows):
    """{row: (base_failed, host_rejected, kept)} of (host, text) rows."""
    def fails(f):
        n, chars, symbols, lines, again, repeated = f
        return (n < 50, 100 * repeated > 50 * n, 10 * symbols > n, 10 * again > 3 * lines,
                n > 0 and (chars < 2 * n or chars > 12 * n))

    flags = [fails(plain(t)) for _, t in rows]
    hosts = Counter(h for h, _ in rows)
    bad = set()
    for rule in range(5):
        k = {h: sum(f[rule] for f, (own, _) in zip(flags, rows) if own == h) for h in hosts}
        total, failed = len(rows), sum(k.values())
        mean = failed / total
        below = total - sum(n * n for n in hosts.values()) / total
        spread = sum(n * (k[h] / n - mean) ** 2 for h, n in hosts.items()) - (len(hosts) - 1) * mean * (1 - mean)
        for h, n in hosts.items():
            rate = mean
            if below and spread / below > 1e-12:
                strength = max(mean * (1 - mean) * below / spread - 1, 10)
                rate = (k[h] + strength * mean) / (n + strength)
            if rate > 0.5:
                bad.add(h)
    return [(f[0] or f[1], h in bad, not (f[0] or f[1] or h in bad)) for f, (h, _) in zip(flags, rows)]


def judged(df):
    return {r.doc_id: tuple(r)[1:] for r in hostrules.judged(df).collect()}


def texts(seed, number):
    rng = random.Random(seed)
    alphabet = ["a", "b", "Ab", "é", "c#", "☃☃", "*", "long-word"]
    out = []
    for _ in range(number):
        size = rng.choice([0, 1, 2, 3, 4, 7, 49, 50, 51, 120])
        pool = alphabet[:rng.randint(1, 8)] if rng.random() < .5 else [f"w{i}" for i in range(400)]
        out.append("".join(rng.choice(pool) + rng.choice([" ", "  ", "\n", "\t", "\x0b", "\r\n", "\n\n"])
                           for _ in range(size)))
    return out + [None, "", " \n\t ", "\n\n", "a b c a b c", "x y x y x y", "a" * 5_000]


def test_figures_and_verdicts_match_a_plain_version(spark):
    rows = [(("bad" if i % 7 == 0 else "" if i % 7 == 1 else None if i % 7 == 2 else f"h{i % 3}"), t)
            for i, t in enumerate(texts(1, 300))]
    rows += [("bad", "$ % & " * 30 + " ".join(f"v{i}" for i in range(60)))] * 80 + [("one", "short")]
    df = spark.createDataFrame([(i, t, h, "x", 1) for i, (h, t) in enumerate(rows)],
                               "doc_id long, text string, source string, host string, documents int")
    got = judged(df)
    verdicts = plain_verdicts(rows)
    assert any(v[1] for v in verdicts)
    for i, (_, text) in enumerate(rows):
        assert got[i] == plain(text) + verdicts[i]


def test_a_small_host_is_judged_by_the_mean(spark):
    """One failing document of a host of its own is no reason to reject a host."""
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, f"h{i % 20}") for i in range(400)] + [(900, "$ " + good.replace(" ", " $ "), "tiny")]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert not any(v[-2] for v in got.values()) and all(v[-1] for v in got.values())


def test_windows_sorted_by_words_and_by_hash_agree(spark):
    """The way for texts where two windows share a hash gives the same places."""
    df = spark.createDataFrame([(t,) for t in texts(2, 60) if t and len(t.split()) > 3], "text string")
    words = df.select(hostrules.words_of(F.col("text")).alias("w"), "text")
    for r in words.select("text", F.sort_array(hostrules._repeated_by_words(F.col("w"))).alias("p")).collect():
        windows = [tuple(w) for w in zip(*[[w for w in re.split(BLANK, r.text) if w][i:] for i in range(3)])]
        assert r.p == [i for i, w in enumerate(windows) if windows.count(w) > 1]


@pytest.mark.parametrize("table", ["edges", "none"])
def test_edges(table, request):
    df = request.getfixturevalue(table)
    rows = hostrules.judged(df).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r.doc_id) for r in df.collect())
    wanted = sorted(plain(r.text) for r in df.collect())
    assert sorted(tuple(r)[1:7] for r in rows) == wanted


def test_a_long_text(spark):
    text = "ab " * 400_000 + "end"
    df = spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")
    assert judged(df)[1][:6] == (400_001, 800_003, 0, 1, 0, 400_000)


def test_hosts_of_addresses(spark):
    df = spark.createDataFrame([("https://WWW.Example.com/a?b",), ("no address",), (None,)], "u string")
    assert [r[0] for r in df.select(hostrules.host_of(F.col("u"))).collect()] == ["www.example.com", None, None]
