"""Near-duplicate vectors, vector codes and periodic runs against their plain versions."""

import hashlib
import os
import random
import sys

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from ledgerloom.llm import codes, runs, tiles  # noqa: E402
from ledgerloom.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, _label string, node int, n_links int"


def same(got, want):
    assert sorted((tuple(x) for x in got), key=repr) == sorted((tuple(x) for x in want), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    out = []
    for label in range(3):
        for _ in range(60):
            centre = rng.normal(size=20)
            for _ in range(rng.integers(1, 5)):
                out.append((len(out), (centre + 0.06 * rng.normal(size=20)).tolist(), label))
    hot = rng.normal(size=20).tolist()
    out += [(1000 + k, hot, 1) for k in range(150)]  # a hot vector
    out += [(1200 + k, hot, 2) for k in range(3)] + [(1300, [2 * x for x in hot], 1), (1301, [1e-200 * x for x in hot], 1)]
    out += [(1400, None, 1), (1401, [None] * 20, 1), (1402, [float("nan")] * 20, 1), (1403, [0.0] * 20, 1), (1404, [float("inf")] * 20, 1)]
    out += [(1405, hot, None), (1406, hot[:7], 1), (1407, hot[:7] + [0.0] * 3, 1), (None, hot, 1), (None, rng.normal(size=20).tolist(), 0), (3, out[3][1], 0), (3, out[3][1], 0)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("numbers", [1 << 18, 20 * 64])
def test_near_vectors(spark, vectors, monkeypatch, numbers):
    monkeypatch.setattr(tiles, "STRIPE", numbers)
    monkeypatch.setattr(tiles, "TILE", 32 if numbers < 10_000 else 256)
    same(tiles.near_duplicates(frame(spark, vectors)).collect(), brute.near_vectors(vectors))
    assert tiles.near_duplicates(frame(spark, [])).collect() == []
    assert [r.kept for r in tiles.near_duplicates(frame(spark, [(1, None, 1), (None, [1.0], None)])).collect()] == [True, True]


def test_leading_coordinates_end_most_pairs():
    """Of vectors that share a few directions, almost no pair is open after the first coordinates."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(2000, 6)) @ rng.normal(size=(6, 64)) + 0.05 * rng.normal(size=(2000, 64))
    points[1000:1020] = points[:20] + 0.001
    turn = np.linalg.eigh(points.T @ points)[1][:, ::-1]
    ids = np.arange(len(points))
    stripe = tiles.Stripe(ids.tobytes(), np.ones(len(points), np.int64).tobytes(), points.tobytes(), turn)
    i, j, looked = tiles.compare(stripe, stripe, 0.98)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.98, 1)), strict=True)}
    assert {tuple(sorted(p)) for p in zip(stripe.nodes[i].tolist(), stripe.nodes[j].tolist(), strict=True)} == want
    assert looked < 2000 * 1999 / 2 / 20


def test_a_group_of_near_copies_returns_a_forest():
    rng = np.random.default_rng(6)
    points = np.ones(64) + 0.001 * rng.normal(size=(500, 64))
    stripe = tiles.Stripe(np.arange(500).tobytes(), np.ones(500, np.int64).tobytes(), points.tobytes(), np.eye(64))
    i, j, _ = tiles.compare(stripe, stripe, 0.98)
    assert len(i) == 500 * 499 // 2
    child, top = tiles._forest(i, j)
    assert len(child) == 499 and set(top) == {0}


def test_vector_codes(spark, vectors, monkeypatch):
    rows = [r for r in vectors if r[0] != 1301]
    for chunk in (4096, 100):
        monkeypatch.setattr(codes, "CHUNK", chunk)
        found = codes.fit(frame(spark, rows), parts=8)
        want, books = brute.vector_codes(rows, parts=8)
        assert found.codebooks.tolist() == books
        got = [(r.id, r.code.hex(), r.error, r.label_error) for r in found.with_label_error().collect()]
        same(got, want)
    assert codes.fit(frame(spark, [])).with_label_error().collect() == []
    few = [(1, [1.0, 2.0], 1), (2, [0.5], None), (2, [], 1), (3, None, 1)]
    found, (want, _) = codes.fit(frame(spark, few)), brute.vector_codes(few)
    same([(r.id, r.code.hex(), r.error, r.label_error) for r in found.with_label_error().collect()], want)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 300), st.integers(1, 6), st.integers(1, 5), st.integers(0, 99))
def test_trees_own_the_nearest(n, spread, dims, seed):
    rng = np.random.default_rng(seed)
    points, weight = np.unique(rng.integers(-(10**spread), 10**spread, (n, dims)), axis=0, return_counts=True)
    entries = rng.integers(-(10**spread), 10**spread, (min(n, 40), dims))
    entries[-1] = entries[0]
    tree = codes.Tree.load(codes.Tree(points, weight).dump())
    away = np.square(points[:, None] - entries).sum(2)
    best, least = tree.nearest(entries)
    assert (best == away.argmin(1)).all() and (least == away.min(1)).all()
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    tree.add(entries, sums, counts)
    assert counts.tolist() == np.bincount(best, weight, len(entries)).astype(int).tolist()
    assert all((sums[e] == (points * weight[:, None])[best == e].sum(0)).all() for e in range(len(entries)))


def test_whole_balls_are_owned():
    """Well apart groups are given to entries without a look at their points."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-100_000, 100_000, (20, 4))
    points, weight = np.unique((centres[:, None] + rng.integers(-50, 50, (20, 200, 4))).reshape(-1, 4), axis=0, return_counts=True)
    tree = codes.Tree(points, weight)
    looked = sum(len(what) for what, _ in tree.owners(centres) if len(what) and what[0] < 0)
    assert looked < len(points) / 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_lyndon_lengths(word):
    n = len(word)
    want = [next((j for j in range(i + 1, n) if word[j:] < word[i:]), n) - i for i in range(n)]
    assert runs.lyndon_lengths(word) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(0, 50), st.integers(1, 8))
def test_runs_of_words(words, a, p):
    words = [words[k] if k < a else words[a + (k - a) % p] if a + p <= len(words) else words[k] for k in range(len(words))]
    assert runs.runs(words) == brute.word_runs(words)
    assert runs.runs(words, 2, 2) == brute.word_runs(words, 2, 2)


def test_long_texts_stay_fast():
    rng = random.Random(1)
    for words in ([b"a"] * 300_000, [b"%d" % (k % 1000) for k in range(300_000)], [b"%d" % rng.randrange(2) for _ in range(300_000)]):
        found = runs.runs(words)
        assert all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in found[:5])


def test_find(spark):
    rows = [(1, "x " + "a b\tc\n" * 6 + "y"), (2, None), (3, ""), (4, " \n"), (None, "no " * 6), (5, "É " * 9), (5, "É " * 9), (6, "a b " * 3)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, id int")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find(docs).collect()]
    words = [brute.words(t) for _, t in rows]
    want = [(i, len(w), brute.word_runs(w)) for (i, _), w in zip(rows, words, strict=True)]
    same([r[:3] for r in got], want)
    assert {r[0]: r[3] for r in got} == {1: "x a b c y", 2: "", 3: "", 4: "", None: "no", 5: "É", 6: "a b a b a b"}
    assert runs.find(docs.limit(0)).collect() == []


def test_registered(spark):
    """Every registered query over the smallest tables, but for those held against SQL."""
    pages = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()]
    table = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op11_vector_duplicates"](spark, FOLDER).collect(), brute.near_vectors(table))
    want, books = brute.vector_codes(table)
    digest = hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()
    same(QUERIES["op13_vector_codes"](spark, FOLDER).collect(), [(*r, digest) for r in want])
    same(QUERIES["op12_periodic_runs"](spark, FOLDER).collect(), brute.periodic(docs))
    same([r[:5] for r in QUERIES["op1_warc"](spark, FOLDER).collect()], brute.pages(pages))
    same(QUERIES["op2_top_k"](spark, FOLDER).select("query_id", "rank", "vec_id", "score").collect(), brute.top([r[:2] for r in table]))
    same(QUERIES["op3_byte_bpe"](spark, FOLDER).collect(), brute.bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    same(QUERIES["op6_jaccard_join"](spark, FOLDER).collect(), brute.near(docs))
    words = public_tokenizers.path("word_bpe_49k.json")
    same(QUERIES["op7_token_files"](spark, FOLDER).collect(), brute.token_files(docs, words))
    assert brute.check_packing([r.asDict() for r in QUERIES["op8_packing"](spark, FOLDER).collect()], docs, words) == 0
    private = {r.doc_id: r for r in QUERIES["op9_personal_data"](spark, FOLDER).collect()}
    for i, t in docs:
        spans = brute.personal(t)
        assert [private[i][f"n_{k}"] for k in brute.KINDS] == [sum(s[0] == k for s in spans) for k in brute.KINDS]
        assert private[i].base_sha256 == brute.sha(brute.spans_text(spans))
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(private[i].spans.split(","))
    same(QUERIES["op10_repeats"](spark, FOLDER).collect(), brute.repeats(docs))
