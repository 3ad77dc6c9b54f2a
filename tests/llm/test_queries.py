"""Every registered query against its SQL, or against a plain version over the whole small tables."""

import base64
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from bindings.check import mismatch
from loyaltide.llm import bpe, pii, sharding, simhash
from loyaltide.llm.queries import ORACLES, QUERIES
from loyaltide.llm.tokenfile import LibraryEncoder


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck, folder):
    assert mismatch(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.fixture(scope="module")
def texts(duck):
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def plain_fingerprint(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(spark, folder, texts):
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, folder).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    parent = {i: i for i in prints}

    def top(i):
        return i if parent[i] == i else top(parent[i])

    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 3:
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    assert {i: r.component_id for i, r in got.items()} == {i: top(i) for i in prints}


def test_sharding(spark, folder):
    names = [f"shard-{i:03d}" for i in range(256)]
    rows = QUERIES["op3_sharding"](spark, folder).collect()
    full, less = sharding.lookup_table(names, 65537), sharding.lookup_table(names[1:], 65537)
    for r in rows:
        assert r.slot == int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % 65537
        assert (r.shard, r.shard_without_first) == (names[full[r.slot]], names[1 + less[r.slot]])


def test_bpe(spark, folder, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, folder).collect()}
    for i, text in texts:
        ids = np.array(library.encode_ordinary(text), dtype="<u4")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_file(spark, folder, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = {r.doc_id: r for r in QUERIES["op8_token_file"](spark, folder).collect()}, 0
    for i, text in texts:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def awkward_texts():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", " \n", "\t", "a", "b", "word", "É", "<|endoftext|>", "'s", "12", "☃", "\u3000", "\xa0", "\x1c",
             "Zq", "...", "x" * 30, " .", " <|endof"]
    return ["".join(rng.choices(parts, k=rng.choice([0, 1, 2, 3, 8, 30]))) for _ in range(3_000)] + ["a <|endoftext|> b"]


def test_token_file_as_the_library_with_its_defaults():
    source = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    library, ours = Tokenizer.from_str(source), LibraryEncoder(source)
    for text, ids in zip(awkward_texts(), ours.texts(awkward_texts())):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert ours.pieces(["a"]) != [] and 50256 in np.frombuffer(next(ours.texts(["a <|endoftext|> b"])), "<u4")


def test_pieces_forgotten_and_met_again_alter_nothing(texts):
    source = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    some = [t for _, t in texts[:40]] + awkward_texts()[:500]
    wanted = list(LibraryEncoder(source).texts(some))
    ours = LibraryEncoder(source)
    ours.by_pieces.known = 50
    assert [next(ours.texts([t])) for t in some] == wanted


@pytest.fixture(scope="module")
def multi():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return bpe.Coder(open(path, "rb").read(), public_tokenizers.PATTERN), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_words_as_the_library(multi):
    ours, library = multi
    rng = random.Random(2)
    long = ["".join(rng.choices("abcdeéth", k=n)) for n in (bpe.LONG - 1, bpe.LONG, bpe.LONG + 1, 3_000)] + ["x" * 3_000]
    for text, ids in zip(awkward_texts() + long, ours.texts(awkward_texts() + long)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_a_million_letters_without_a_blank(multi):
    ours, _ = multi
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    start = time.process_time()
    ids = next(ours.texts([text]))
    assert ours.decode([ids]) == [text.encode()] and time.process_time() - start < 60


def plain_finds(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_pii(spark, folder, texts):
    got = {r.doc_id: r for r in QUERIES["op10_pii"](spark, folder).collect()}
    for i, text in texts:
        base = plain_finds(text)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(filter(None, joined.split(","))) <= set(got[i].spans.split(","))


def test_quality_on_held_out_rows(spark, folder, duck):
    got = QUERIES["op6_quality"](spark, folder).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    known = duck.sql("SELECT doc_id, quality FROM labels").df().merge(got[got.held_out], on="doc_id")
    assert (known.quality == known.predicted).mean() >= 0.95


def test_pipeline(spark, folder, texts, duck):
    """Against a plain run: scores by the operator, the rest with dictionaries."""
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    scores = {r.doc_id: r.score for r in QUERIES["op6_quality"](spark, folder).collect()}
    last = {}
    for i, text in texts:
        if scores[i] >= 0.3:
            key = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            last[key] = max(i, last.get(key, i))
    left = {i: t for i, t in texts if i in set(last.values())}
    prints, kept = {i: simhash.fingerprint(t) for i, t in left.items()}, set()
    groups: list[set] = []
    for i in left:
        joined = [g for g in groups if any((prints[i] ^ prints[j]).bit_count() <= 3 for j in g)]
        groups = [g for g in groups if g not in joined] + [set().union({i}, *joined)]
    kept = {min(g) for g in groups}
    assert {r.doc_id for r in rows} == kept
    sources = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    tokens = {i: len(re.findall(r"[^ \t\n\x0b\f\r]+", left[i])) + 1 for i in kept}
    total, mixed = {}, {}
    for i in kept:
        total[sources[i]] = total.get(sources[i], 0) + tokens[i]
    for r in rows:
        mixed[sources[r.doc_id]] = mixed.get(sources[r.doc_id], 0) + tokens[r.doc_id]
        assert r.decoded_sha256 == hashlib.sha256(left[r.doc_id].encode()).hexdigest()
    often = {s: mixed[s] / total[s] for s in total}
    assert often[max(total, key=total.get)] == 1 and max(often.values()) <= 1.5 + 0.5  # one document over the limit
    assert often[min(total, key=total.get)] >= 1.5
