"""Placement and quality scores against plain versions that share no code with the operators."""

import hashlib

import numpy as np
import pytest

from loyaltide.llm import quality
from loyaltide.llm.common import read
from loyaltide.llm.queries import QUERIES


def plain_table(names, slots):
    """Every shard walks its own permutation and takes, when it is its turn, the first slot that nobody has."""
    def preference(name):
        digest = hashlib.sha256(name.encode()).hexdigest()
        offset, step = int(digest[:16], 16) % slots, int(digest[16:32], 16) % (slots - 1) + 1
        for j in range(slots):
            yield (offset + j * step) % slots

    walks, owner = [preference(n) for n in names], {}
    while len(owner) < slots:
        for name, walk in zip(names, walks):
            slot = next((s for s in walk if s not in owner), None)
            if slot is None:
                return owner
            owner[slot] = name
            if len(owner) == slots:
                break
    return owner


def test_sharding(spark, folder):
    names = [f"shard-{i:03d}" for i in range(256)]
    full, less = plain_table(names, 65537), plain_table(names[1:], 65537)
    rows = QUERIES["op3_sharding"](spark, folder).collect()
    assert rows
    for r in rows:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % 65537
        assert (r.slot, r.shard, r.shard_without_first) == (slot, full[slot], less[slot])


def mixed(codes):
    """The hash of a run of codes, in Python's integers."""
    value = 0
    for c in codes:
        value = (value * 0x01000193 + c) & 0xFFFFFFFF
    value = ((value ^ (value >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
    return value ^ (value >> 12)


def plain_terms(text):
    data = (text or "").encode()
    shapes = bytes(97 if 97 <= b < 123 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else 98 if b >= 128 else b for b in data)
    counts = [0.0] * quality.TERMS
    for i in range(len(data) - 3):
        counts[mixed(shapes[i:i + 4]) % quality.SHAPES] += 1
    for i in range(len(data) - 2):
        counts[quality.SHAPES + mixed(data[i:i + 3]) % quality.STRINGS] += 1
    words = data.split()
    if len(words) > 1:
        same = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        few = len(set(words)) / len(words)
        flags = [same > level for level in quality.SAME] + [few < level for level in quality.DISTINCT]
        counts[quality.SHAPES + quality.STRINGS:] = [len(words) * float(f) for f in flags]
    return counts


@pytest.fixture(scope="module")
def model(spark, folder):
    return quality.fit(read(spark, folder, "documents"), read(spark, folder, "labels"))


@pytest.fixture(scope="module")
def some(duck):
    return [t for (t,) in duck.sql("SELECT text FROM documents WHERE length(text) < 4000 ORDER BY doc_id").fetchall()][:60]


def test_terms(some):
    for text in [*some, "", "a", "ab", "ab cd ab cd", "É É É x"]:
        assert quality.terms(text).tolist() == plain_terms(text)


def test_votes_of_the_nearest(model, some):
    """All cosines in double precision, sorted; a neighbour at the edge may change places within its rounding."""
    counts = np.array([plain_terms(t) for t in some])
    scores = model.score(counts)
    for row, score in zip(counts, scores):
        latent = (np.log1p(row) * model.rarity.astype(float)) @ model.directions.astype(float)
        latent /= max(np.sqrt((latent ** 2).sum()), 1e-12)
        ranked = sorted(((float(latent @ v.astype(float)), float(label)) for v, label in zip(model.vectors, model.labels)),
                        key=lambda pair: -pair[0])[:model.neighbours]
        weights = [max(c, 0.0) ** model.sharpness for c, _ in ranked]
        assert sum(w * label for w, (_, label) in zip(weights, ranked)) / sum(weights) == pytest.approx(score, abs=2e-3)


def test_blocks_change_nothing(model, some):
    counts = np.array([quality.terms(t) for t in some])
    whole = model.score(counts)
    one_by_one = np.concatenate([model.score(counts[i:i + 1]) for i in range(len(counts))])
    assert np.isfinite(whole).all() and np.abs(whole - one_by_one).max() <= 2e-6


def test_held_out_labels_are_never_learned(spark, folder, duck):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality "
                                         "ELSE quality END AS quality")
    one, other = quality.fit(docs, labels), quality.fit(docs, turned)
    assert (one.vectors == other.vectors).all() and (one.labels == other.labels).all()
