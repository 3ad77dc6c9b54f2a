"""Nulls, empty and long texts, repeated rows, clashing names and empty tables, for every operator and stage."""

import hashlib
import math
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from loyaltide.llm import bpe, chat, exact_dedup, merkle, mixing, periods, pii, quality, sharding, simhash, tokenfile
from loyaltide.llm.common import ROW
from loyaltide.llm.tokenfile import LibraryEncoder
from loyaltide.plans.staging import scratch_path, stage, staged_in
from tests.llm.conftest import EDGES
from tests.llm.test_queries import plain_fingerprint, plain_finds

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(alphabet="ab 1.@-+é\n\\<>[]/INSTs|", max_size=60)


def test_exact_dedup(edges, none):
    got = exact_dedup.duplicates(edges).collect()
    assert len(got) == len(EDGES) and exact_dedup.duplicates(none).count() == 0
    empty = [r for r in got if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in empty} == {(2, 3)} and [r.doc_id for r in empty if r.kept] == [2]
    same = [r for r in got if r.keep_id == 6]
    assert len(same) == 3 and sum(r.kept for r in same) == 1  # repeated rows: one stays
    assert {r.keep_id for r in got if r.doc_id in (7, 8)} == {7, 8}  # only A-Z is lowered
    kept = exact_dedup.without_duplicates(edges)
    assert kept.columns == edges.columns and kept.count() == len({r.text_sha256 for r in got})


def test_exact_dedup_with_a_hot_text(spark, frame, plan):
    docs = frame([(i, "hot" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)])
    got = {r.doc_id: r for r in exact_dedup.duplicates(docs, tracked=64).collect()}
    assert all(got[i].keep_id == 2997 and got[i].group_size == 1000 for i in range(0, 3000, 3))
    assert sum(r.kept for r in got.values()) == len({r.text_sha256 for r in got.values()})


def test_simhash_edges(edges, none):
    got = simhash.near_duplicates(edges).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in EDGES)
    zero = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {1} and simhash.near_duplicates(none).count() == 0
    kept = simhash.without_near_duplicates(edges)
    assert kept.columns == edges.columns and kept.count() == len({r.component_id for r in got})


@given(TEXT)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("limit,dense", [(2048, False), (4, False), (16, True)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, limit, dense):
    """Also with buckets so small that nearly all are refined, and a crowd of near copies."""
    monkeypatch.setattr(simhash, "LIMIT", limit)
    random = np.random.default_rng(limit)
    base = random.integers(0, 2 ** 63, 40, dtype=np.uint64)
    if dense:
        base[:] = base[0]
    prints = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << random.integers(0, 64, 40).astype(np.uint64))
                                                ^ (np.uint64(1) << random.integers(0, 20, 40).astype(np.uint64))
                                                for _ in range(6)]))
    values = stage(spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp long"), "v")
    first, second = np.nonzero(np.triu(np.bitwise_count(prints[:, None] ^ prints[None]) <= 3, 1))
    want = simhash.forest(len(prints), first, second)
    at = {int(v): i for i, v in enumerate(prints.view(np.int64))}
    found = [(at[r.a], at[r.b]) for r in simhash.links(values).collect()]
    assert all(np.bitwise_count(prints[a] ^ prints[b]) <= 64 for a, b in found)
    got = simhash.forest(len(prints), np.array([a for a, _ in found], int), np.array([b for _, b in found], int))
    assert (got == want).all()
    label = {r.node: r.label for r in simhash.labels(simhash.links(values)).collect()}
    groups = [label.get(int(v), int(v)) for v in prints.view(np.int64)]
    assert len(set(groups)) == len(set(want)) == len(set(zip(groups, want)))


def test_rounds_grow_with_the_logarithm_of_a_chain(spark):
    for order in (list(range(1_000)), list(np.random.default_rng(1).permutation(1_000))):
        chain = spark.createDataFrame([(int(a), int(b)) for a, b in zip(order, order[1:])], "a long, b long")
        with staged_in(spark) as scope:
            assert {r.label for r in simhash.labels(chain).collect()} == {simhash.labels(chain).first().label}
            assert sum("/edges-" in p for p in scope.paths) <= 2 * 16
        scope.remove()


def test_thresholds_are_allocated_at_the_least_cost():
    costs = [[0, 5, 50], [0, 1, 9], [0, 2, 7]]
    assert simhash.allocated(costs, 0) == min(
        ((a[t + 1] + b[u + 1] + c[v + 1]), [t, u, v]) for a, b, c in [costs] for t in (-1, 0, 1) for u in (-1, 0, 1)
        for v in (-1, 0, 1) if t + u + v == 0)


def test_merkle(edges, none, frame):
    got = merkle.fingerprints(edges).collect()
    by_text = {}
    for (_, text), row in zip(EDGES, got):
        by_text.setdefault(text or "", set()).add(row.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)
    assert merkle.fingerprints(none).count() == 0 and merkle.followed(none).count() == 0
    after = merkle.followed(edges)
    order = sorted(((i is None, -(i or 0), t or "") for i, t in EDGES))
    want = Counter((r[2], n[2]) for r, n in zip(order, order[1:] + order[:1]))
    assert Counter((r.text, r.next_text) for r in after.collect()) == want
    assert merkle.followed(frame([(5, "alone")])).first().next_text == "alone"


def test_merkle_locates_edits(spark):
    pair = spark.createDataFrame([("a. b.\nc\n\nd\ne", "a. b.\nC\n\nd\ne\nf")], "x string, y string") \
        .selectExpr("x", "y").select(merkle.sections_of("x").alias("x"), merkle.sections_of("y").alias("y"))
    row = pair.select(merkle.changed(pair.x, pair.y).alias("c"), merkle.likeness(pair.x, pair.y).alias("l")).first()
    assert row.c == [[0, 1], [1, 2]] and row.l == pytest.approx(2 * 4 / (5 + 6))


def test_sharding(edges, none):
    got = sharding.placed(edges, "doc_id", ["a", "b", "c"], 101).collect()
    assert len(got) == len(EDGES) and sharding.placed(none, "doc_id", ["a"], 101).count() == 0
    assert len({(r.doc_id, r.shard) for r in got}) == len({i for i, _ in EDGES})
    names = [f"n{i}" for i in range(50)]
    table = sharding.lookup_table(names, 5003)
    assert np.ptp(np.bincount(table)) <= 1
    less = sharding.lookup_table(names[1:], 5003)
    stay = table > 0
    assert (less[stay] + 1 == table[stay]).mean() > 0.9
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)


OWN = ["__row", "__times", "__copy", "__id", "__all", "__shares", "__score", "__text", "__both", "c0", "all", "copy", "times"]


def test_columns_with_names_of_the_operators_stay(spark, frame):
    docs = frame([(i, f"text {i % 7} mail a{i}@b.example", f"s{i % 2}") for i in range(30)])
    for i, name in enumerate(OWN):
        docs = docs.withColumn(name, F.lit(f"v{i}"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    for df in (exact_dedup.without_duplicates(docs), simhash.without_near_duplicates(docs),
               mixing.mixed_rows(docs, max_repetition=2.0), pii.sanitised(docs), periods.with_runs(docs).drop("runs", "collapsed"),
               quality.scored(docs, model, score_col="new").drop("new")):
        assert df.columns == docs.columns
        rows = df.collect()
        assert rows and all([r[n] for n in OWN] == [f"v{i}" for i in range(len(OWN))] for r in rows)
    with pytest.raises(ValueError, match="score"):
        quality.scored(docs, model)


def test_targets_beyond_the_corpus(frame):
    """A lower entropy than the corpus's takes an exponent above 1; what no mix meets raises."""
    docs = frame([(i, "w " * 9, f"s{min(i // 40, 2)}") for i in range(200)])  # 40, 40 and 120 rows
    got = mixing.mix(docs, target_entropy=0.5).collect()
    share = Counter(r.source for r in got)
    parts = [n / len(got) for n in share.values()]
    assert {r.doc_id for r in got} == set(range(200))
    assert abs(-sum(p * math.log2(p) for p in parts) - 0.5) < 0.05
    for targets in ({"max_repetition": 0.5}, {"target_entropy": 9}, {"target_entropy": -1},
                    {"max_repetition": 2, "budget": 1_000_000}):
        with pytest.raises(ValueError):
            mixing.mix(docs, **targets)
    small = mixing.mix(docs, max_repetition=1.0, budget=500, block_tokens=100).collect()
    assert max(Counter(r.doc_id for r in small).values()) == 1


def test_a_directory_makes_no_product_of_words_and_addresses(spark, frame):
    """400 addresses, each in a text of its own too, and 1,500 words that stand together."""
    addresses = [f"a{i}@mail.example" for i in range(400)]
    texts = [" ".join([*addresses, *(f"word{i}" for i in range(1_500))]), *(f"only {a}" for a in addresses)]
    docs = frame(list(enumerate(texts)))
    with staged_in(spark) as scope:
        found = pii.spans(docs).collect()
        near = next(p for p in scope.paths if "/near-" in p)
        assert spark.read.parquet(near).count() <= 5_000
    scope.remove()
    assert len(found) == 401 and sum(len(r.base) for r in found) == 800


def test_long_runs_of_digits_take_linear_time():
    start = time.process_time()
    assert pii.finds("1" * 1_000_000) == [] and pii.finds("1." * 500_000) != []
    assert pii.finds("a" * 500_000 + " " + "b" * 500_000 + "@c.example")[0][0] == 500_001
    assert pii.finds("1.2.3.4.5.6.7.8 01.2.3.4567.1.1.1") == plain_finds("1.2.3.4.5.6.7.8 01.2.3.4567.1.1.1")
    assert time.process_time() - start < 10


def test_mixing(edges, none, frame):
    for targets in ({"max_repetition": 2.0}, {"target_entropy": 1.5}):
        got = mixing.mix(edges, **targets).collect()
        assert {r.doc_id for r in got} == {i for i, _ in EDGES}
        assert mixing.mix(none, **targets).count() == 0
    again = mixing.mixed_rows(edges, max_repetition=2.0)
    assert again.columns == edges.columns
    docs = frame([(i, "w " * (i % 7 + 1), "big" if i < 900 else f"s{i % 3}") for i in range(1000)])
    got = mixing.mix(docs, target_entropy=1.2, block_tokens=300)
    tokens = {i: i % 7 + 2 for i in range(1000)}
    total, mixed, blocks = Counter(), Counter(), Counter()
    for i in range(1000):
        total["big" if i < 900 else f"s{i % 3}"] += tokens[i]
    for r in got.collect():
        mixed[r.source] += tokens[r.doc_id]
        blocks[r.block] += tokens[r.doc_id]
    weights = {s: n / sum(mixed.values()) for s, n in mixed.items()}
    assert -sum(w * math.log2(w) for w in weights.values()) == pytest.approx(1.2, abs=0.02)
    assert mixed["big"] == total["big"]  # the largest source once, nothing lost
    assert max(list(blocks.values())[:-1]) < 300 + 4 * 9
    short = mixing.mix(docs, max_repetition=3.0, budget=500).collect()
    assert 480 <= sum(tokens[r.doc_id] for r in short) <= 500 + 4 * 9
    with pytest.raises(ValueError):
        mixing.mix(docs)


def test_bpe(edges, none):
    encoded = bpe.encode(edges, RANKS, public_tokenizers.PATTERN)
    got = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in got) == Counter((i, (t or "").encode()) for i, t in EDGES)
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.round_trip(edges, RANKS, public_tokenizers.PATTERN).collect() == got
    assert bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.fixture(scope="module")
def coders():
    import base64

    import tiktoken
    raw = open(RANKS, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Coder(raw, public_tokenizers.PATTERN), library


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_bpe_as_the_library(coders, texts):
    own, library = coders
    ids = list(own.texts(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_library_ids_by_pieces(texts):
    encoder = tokenfile.kept_encoder(open(JSON, encoding="utf-8").read())
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(texts)] == want


def test_stretches_lose_nothing(monkeypatch):
    from loyaltide.llm import pieces
    monkeypatch.setattr(pieces, "LONG", 10)
    text = "some words, and  more \n words " * 5
    assert "".join(pieces.stretches(text)) == text and len(list(pieces.stretches(text))) > 3


@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=2000), st.integers(0, 40))
def test_codes(ids, bits):
    ids = np.array(ids, dtype=np.uint32) >> np.uint32(bits % 32)
    codes = tokenfile.Codes(tokenfile.pack(ids))
    assert (codes.all() == ids).all() and [codes[i] for i in range(0, len(ids), 7)] == ids[::7].tolist()


def test_token_file(spark, edges, none, monkeypatch):
    path, empty = scratch_path(spark, "t"), scratch_path(spark, "t")
    monkeypatch.setattr(tokenfile, "SEGMENT", 1 << 10)
    tokenfile.write_tokens(edges, path, JSON)
    tokenfile.write_tokens(none, empty, JSON)
    assert tokenfile.documents(tokenfile.segments(spark, empty)).count() == 0
    rows = tokenfile.segments(spark, path)
    got = sorted(tokenfile.documents(rows).collect(), key=lambda r: r.start)
    want = sorted((i is not None, i or 0, t or "") for i, t in EDGES)
    assert [r.doc_id for r in got] == [i if ok else None for ok, i, _ in want]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    ends = spark.createDataFrame([(r.start + r.n_tokens - 1,) for r in got], "position long")
    assert {r.id for r in tokenfile.tokens_at(rows, ends).collect()} == {0} and tokenfile.tokens_at(rows, ends).count() == len(got)


@given(TEXT, TEXT)
def test_chat_escapes(role, text):
    rendered, begins, ends = chat.render([(role, text), ("assistant", text)])
    assert chat.read_turns(rendered) == [(role, text), ("assistant", text)]
    assert chat.unescape(rendered[begins[-1]:ends[-1]]) == text


LIBRARY = LibraryEncoder(open(JSON, encoding="utf-8").read(), literal=True)


def test_chat_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "</s>"), (1, 2, "assistant", "é" * 9),
            (2, None, "assistant", "."), (None, 0, "assistant", "x"), (1, 2, "assistant", "é" * 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(turns, JSON)).collect()}
    assert got[1].n_turns == 5 and got[1].loss_chars == 18 and got[2].loss_chars == got[None].loss_chars == 1
    assert chat.digests(chat.formatted(turns.limit(0), JSON)).count() == 0


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>"]), TEXT), max_size=6))
def test_what_is_learned_is_read_back_from_the_mask(turns):
    rendered, begins, ends = chat.render(turns)
    encoding = LIBRARY.tokenizer.encode(rendered, add_special_tokens=False)
    offsets = np.array(encoding.offsets).reshape(-1, 2)
    mask = chat.aligned(offsets, begins, ends)
    touched = [any(a < e and b < c for b, e in zip(begins, ends)) for a, c in offsets.tolist()]
    assert mask.tolist() == [int(t) for t in touched]
    wanted = "".join(text for role, text in turns if role == "assistant")
    assert "".join(chat.learned_texts(rendered, mask, offsets)) == wanted
    if mask.any():  # a wrong mask shows
        mask[np.flatnonzero(mask)[0]] = 0
        assert "".join(chat.learned_texts(rendered, mask, offsets)) != wanted or not wanted


def test_a_conversation_of_any_length_is_one_row(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} [/INST](é") for i in range(10_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.formatted(turns, JSON).collect()
    assert len(rendered) == 1 and len(rendered[0].ids) == len(rendered[0].loss_mask) == len(rendered[0].offsets) / 8
    said = "".join(r[3] for r in rows if r[2] == "assistant")
    assert chat.digests(chat.formatted(turns, JSON)).first().loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_quality_edges(spark, edges, none):
    labels = spark.createDataFrame([(1, 1), (4, 1), (5, 0), (6, 1), (6, 0), (9, 0), (None, 1), (7, None)],
                                   "doc_id long, quality long")
    model = quality.fit(edges, labels)
    got = quality.scored(edges, model, score_col="__score")
    assert got.columns == [*edges.columns, "__score"] and all(0 <= r["__score"] <= 1 for r in got.collect())
    assert quality.scored(none, model, score_col="__score").count() == 0
    unlabelled = quality.fit(edges, labels.limit(0))
    assert {r["__score"] for r in quality.scored(edges, unlabelled, score_col="__score").collect()} == {0.5}


@pytest.mark.parametrize("stretch", [1, 7, 64, 1000])
def test_quality_terms_do_not_depend_on_stretches(monkeypatch, stretch):
    random = np.random.default_rng(stretch)
    texts = ["alpha beta gamma delta " * 100, "one one  one two\n" * 60, "x" * 300, "", " ", "é 12 Ab\t" * 50 + "end",
             " ".join(str(n) for n in random.integers(0, 40, 400)), "word " * 30 + "y" * 200 + " word"]
    want = [quality.terms(t) for t in texts]
    assert want[0][-1] == 400  # few distinct words
    monkeypatch.setattr(quality, "STRETCH", stretch)
    assert all((quality.terms(t) == w).all() for t, w in zip(texts, want))


@given(st.text(alphabet="ab.@-+%1\n", max_size=40))
def test_patterns(text):
    assert pii.finds(text) == plain_finds(text)


@given(st.text(alphabet="0123456789 -.+()x", max_size=60))
def test_number_patterns(text):
    assert pii.finds(text) == plain_finds(text)


def test_words_that_give_an_entity_away(frame):
    told = [(i, f"filler{'abcdefghij'[i]} text the zanzibar boss@x.example.com wrote the letter") for i in range(5)]
    other = [(100 + i, f"the letter wrote plain things number {i} without anyone") for i in range(60)]
    copies = [(200 + i, "the quibbling other@y.example.com") for i in range(5)]
    docs = frame(told + other + copies)
    rows = {r.id: r for r in pii.spans(docs).collect()}
    for i, text in told:
        words = {text[s.begin:s.end] for s in rows[i]["all"] if s.kind == 4}
        assert "zanzibar" in words and not words & {"wrote", "letter"}
    assert all(r["all"] == [] for i, r in rows.items() if 100 <= i < 200)
    assert all(len(rows[i]["all"]) == 1 for i, _ in copies)  # copies of one text prove nothing
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "zanzibar" not in clean[0] and "<email>" in clean[0] and clean[100] == other[0][1]


def plain_words(text):
    """(word, begin, end) outside the finds."""
    for a, _, b in plain_finds(text):
        text = text[:a] + " " * (b - a) + text[b:]
    return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]


def plain_word_spans(texts, generalise=0.8):
    """Per text {(begin, end): disclosure}, by brute force: every entity against every word."""
    different = sorted({t or "" for t in texts})
    words = {t: {w for w, _, _ in plain_words(t)} for t in different if plain_finds(t)}
    entities = {t: {(k, t[a:b].lower()) for a, k, b in plain_finds(t)} for t in words}
    holding = {e: [t for t in words if e in entities[t]] for e in set().union(*entities.values())}
    wanted, documents, n = set().union(*words.values()), Counter(), len(different)
    for t in different:
        documents.update(wanted & (words[t] if t in words else {w for w, _, _ in plain_words(t)}))
    shares = {t: {} for t in words}
    for e, held in holding.items():
        both = Counter(w for t in held for w in words[t])
        for w, k in both.items():
            mutual = math.log((n + 2) * (k + 0.5) / ((len(held) + 1) * (documents[w] + 1)))
            share = mutual / math.log(n / len(held)) if len(held) < n else 0.0
            if share >= generalise:
                for t in held:
                    if w in words[t]:
                        shares[t][w] = max(share, shares[t].get(w, 0.0))
    return {t: {(a, b): shares[t][w] for w, a, b in plain_words(t) if w in shares[t]} for t in words}


def test_word_spans_as_by_brute_force(spark, folder):
    """Over a whole table, where every entity stands in one text only."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = plain_word_spans(texts.values())
    assert sum(map(len, want.values())) > 0
    for r in pii.spans(docs).collect():
        got = {(s.begin, s.end) for s in r["all"] if s.kind == 4}
        shares = want.get(texts[r.id], {})
        assert got == shares.keys()
        assert dict(r.disclosure) == pytest.approx({a: x for (a, _), x in shares.items()})


def test_words_far_from_an_entity_are_marked_wherever_they_are(frame):
    """Short words, numbers, the heading of a long text, and copies, which count once."""
    long = "Ann Lee, house 4711. " + "some plain words of no weight " * 40 + "write to Lee, ann@x.example.com, or Ann"
    docs = frame([(1, long), (2, long), (3, long)] + [(10 + i, f"some plain words of no weight, to write or {i}") for i in range(300)])
    rows = {r.id: r for r in pii.spans(docs).collect()}
    texts = [long] + [f"some plain words of no weight, to write or {i}" for i in range(300)]
    want = plain_word_spans(texts)[long]
    for i in (1, 2, 3):
        assert {(s.begin, s.end) for s in rows[i]["all"] if s.kind == 4} == want.keys()
    assert [long[a:b] for a, b in sorted(want)] == ["Ann", "Lee", "house", "4711", "Lee", "Ann"]
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert not re.search("Ann|Lee|4711", clean[2]) and clean[10] == texts[1]


def test_pii_edges(edges, none):
    got = pii.spans(edges).collect()
    assert Counter(r.id for r in got) == Counter(i for i, _ in EDGES) and pii.spans(none).count() == 0
    clean = pii.sanitised(edges)
    assert clean.columns == edges.columns and clean.count() == len(EDGES)


def test_word_counts(spark, frame):
    docs = frame([(i, f"Common {'word' if i % 2 else 'other'} word{'s' if i == 3 else ''}") for i in range(10)])
    wanted = spark.createDataFrame([("common",), ("other",), ("absent",), ("words",)], "word string")
    assert {r.word: r.documents for r in pii.word_counts(docs, wanted).collect()} == {"common": 10, "other": 5, "words": 1}


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
def test_stages(name, step, spark, folder, edges, none):
    got = step(spark, edges, folder)
    assert got.count() > 0 and step(spark, none, folder).count() == 0
    if name != "bpe":
        assert got.columns == edges.columns and ROW not in got.columns
