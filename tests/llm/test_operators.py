"""Each operator against its plain version, on small frames with nulls, empty and long texts, ties, repeats and clashing columns."""

import os
import random
import sys
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerloom import session  # noqa: E402
from ledgerloom.llm import bpe, chat, frames, jaccard, packing, pii, pivots, quality, repeats, shared, tokens, warc  # noqa: E402
from ledgerloom.llm.queries import QUERIES  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SYLLABLES = "tion ing er an re the ou st ea ble ly ti ha wh or É ü ño 日本".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ",", ".", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base, passage = [prose(rng, 120) for _ in range(12)], prose(rng, 70)
    out = [(k, t) for k, t in enumerate(base)]
    out += [(20 + k, base[k]) for k in range(4)]  # exact copies
    for k in range(6):  # near copies of one text
        words = base[5].split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append((30 + k, " ".join(words)))
    out += [(40 + k, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for k in range(5)]
    out += [(50, None), (51, ""), (52, " \n\t "), (53, "one two"), (54, "One TWO"), (55, "a" * 700), (56, "ab" * 400 + "x"), (57, passage + passage)]
    out += [(58, "</s> 's <|endoftext|> \x01 x\x01y z w 'll 12345 ...!?"), (59, prose(rng, 3000))]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows with columns that operators use for themselves."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.select("doc_id", "text", F.lit("x").alias("_words"), F.lit(1).alias("n"), F.lit("y").alias("id"), F.lit(True).alias("kept"), F.lit(3).alias("_key"))


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def same(got, want):
    assert sorted((tuple(x) for x in got), key=repr) == sorted((tuple(x) for x in want), key=repr)


def test_quality(spark, docs, rows):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for id, text in rows:
        words = brute.words(text)
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        again = {g for g in grams if grams.count(g) > 1} if len(grams) < 500 else set()
        covered = {k + o for k, g in enumerate(grams) if g in again for o in range(3)}
        lines = [x for x in (text or "").split("\n") if brute.words(x)]
        r = got[id]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words)) and r.n_dup_lines == len(lines) - len(set(lines))
        if len(grams) < 500:
            assert r.n_repeat_words == len(covered)
            assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert quality.judge(empty(spark)).count() == 0
    kept = quality.clean(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_quality_lines(spark):
    good = "Plain words make up this line, and it ends as lines do."
    nav, junk, stock = "Home | About | Help | More", "a### b$$$ c%%% d&&& e***", "All rights reserved, see our terms of use."
    text = "\n".join([good, nav, junk, stock, good, "Another line of words."])
    row = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string"), min_words=5).first()
    assert row.clean_text == f"{good}\nAnother line of words." and row.n_dup_lines == 1


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "\\b \\\\ \\", "<s", "/s>", "[INST] x [/INST]", "", "日本 é"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(hard) + rng.choice(hard)) for c in range(30) for t in range(rng.randint(1, 6))]
    rows += [(90, 0, None, None), (90, 0, "user", "tie"), (90, 0, "user", "tie"), (91, None, "assistant", "</s>"), (None, 1, "[/INST]", "x"), (92, 1, "assistant", "long " * 20000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    got = {r.conv_id: r for r in chat.read_chats(chat.format_chats(frame)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = sorted(turns)
        assert [(x.role, x.text) for x in got[c].turns] == [x[1:] for x in turns]
        assert list(got[c].loss_texts) == [x[2] for x in turns if x[1] == "assistant"]
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_bpe(spark, docs, rows):
    coder = bpe.ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = coder.encode(docs)
    got = coded.select("doc_id", F.size("ids"), F.sha2(coder.as_bytes(F.col("ids")), 256), F.sha2(coder.decode(F.col("ids")), 256)).collect()
    same(got, brute.bpe(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    assert coder.encode(empty(spark)).count() == 0


def test_bpe_folds_every_word_by_the_packed_table(spark, rows, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = bpe.ByteBPE(path, public_tokenizers.PATTERN)
    monkeypatch.setattr(coder, "frequent", lambda *_: bpe.KNOWN.empty_table())
    odd = [(1, "!!\"!!?! !"), (2, "\x00a\x01\ud7ff\ue000\U0001f600é" * 3), (3, " cióntallcoja" + "xq" * 40), (4, None)]
    frame = spark.createDataFrame(odd + rows[:20], "doc_id long, text string")
    got = coder.encode(frame).select("doc_id", F.size("ids"), F.sha2(coder.as_bytes(F.col("ids")), 256), F.sha2(coder.decode(F.col("ids")), 256))
    same(got.collect(), brute.bpe(odd + rows[:20], path, public_tokenizers.PATTERN))
    pairs = {1: {5: 7, 0: 9}, 4: {k: k for k in range(40)}, 6: {39: 2}}
    offsets, slots = bpe._displaced(pairs, 50)
    assert {(r, k): slots[offsets[r] + k] for r in pairs for k in pairs[r]} == {(r, k): r << bpe.RANK_BITS | v for r in pairs for k, v in pairs[r].items()}
    assert bpe._displaced({}, 3)[0] == [0, 0, 0]


def test_token_files(spark, docs, rows):
    files = frames.write(docs, WORD_BPE, file_bytes=4000, special_as_text=False)
    assert files.count() > 2
    same(frames.read(files).collect(), brute.token_files(rows, WORD_BPE))
    assert frames.read(frames.write(empty(spark), WORD_BPE)).count() == 0
    odd = spark.createDataFrame([(None, "b"), (None, "a"), (1, None), (1, None)], "doc_id long, text string")
    got = sorted(frames.read(frames.write(odd, WORD_BPE)).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens) for r in got] == [(None, 2), (None, 2), (1, 1), (1, 1)]


def test_token_file_reads_only_the_frames_of_a_document(spark, docs, rows):
    listed = frames.write(docs, WORD_BPE, special_as_text=False).first()
    system, path = shared.place(listed["path"])
    want = dict(brute.word_ids(rows, WORD_BPE, 1))
    with system.open_input_file(path) as source:
        file = frames.TokenFile(source, source.size())
        for k in (len(rows) - 1, 0, 7):
            assert file.document(k) == want[file.entries[k][0]]
    with system.open_input_stream(path, compression=None) as source:
        data = bytearray(source.read())
    data[10] ^= 1
    import io

    import zstandard

    file = frames.TokenFile(io.BytesIO(bytes(data)), len(data))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        file.document(0)


def test_special_tokens_as_in_the_library(spark, path):
    """The queries' ids are those of the library, whose only setting is add_special_tokens=False."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    texts = ["hi <|endoftext|> there", "a<|endoftext|>b,<|startoftext|>\n<|ENDOFTEXT|>x <|EndOfText|>", "<|endoftext|>\u0301 É<|endoftext|>, <|endoftext", "plain text."]
    ids = [np.asarray(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert ids[0] == np.asarray([1883, 49407, 997], "<u4").tobytes()
    assert list(tokens.PieceEncoder(WORD_BPE, special_as_text=False).encode(texts)) == ids
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    of = lambda end: [zlib.crc32(x + np.asarray([end], "<u4").tobytes()) for x in ids]
    assert [r[3] for r in sorted(QUERIES["op7_token_files"](spark, path).collect(), key=lambda r: r.start)] == of(1)
    pieces = QUERIES["op8_packing"](spark, path).collect()
    assert {r.doc_id: r.doc_tokens for r in pieces} == {k: len(x) // 4 + 1 for k, x in enumerate(ids)}
    assert all(r.ids_crc32 == of(2)[r.doc_id] for r in pieces if r.length == r.doc_tokens)


def test_packing(spark, docs, rows):
    pieces = [r.asDict() for r in packing.pack(docs.repartition(3), WORD_BPE, block=5000, special_as_text=False).collect()]
    assert brute.check_packing(pieces, rows, WORD_BPE) == 0
    assert all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    assert packing.pack(empty(spark), WORD_BPE).count() == 0
    twice = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert sum(r.length for r in packing.pack(twice, WORD_BPE).collect()) == 2


def test_packer_balances_cost():
    packer = packing.Packer(100, 100.0, 1.0, 0)
    placed, left = packer.fill([(60, 0, 0), (60, 1, 0), (30, 2, 0), (30, 3, 0), (10, 4, 0), (10, 5, 0)])
    whole = {doc: seq for (_, doc, _), seq, _ in placed}
    assert not left and whole[0] != whole[1] and whole[2] != whole[3]


def test_jaccard(spark, docs, rows):
    same(jaccard.join(docs).collect(), brute.near(rows))
    assert jaccard.join(empty(spark)).count() == 0
    kept = {r.doc_id for r in jaccard.keep_one(docs).collect()}
    assert kept == {i for i, _, c in brute.near(rows, 5, 80) if i == c}


def test_jaccard_of_shared_ids(spark):
    """Rows with one id are one document for links and give a row each; of rows alike one stays, and unlike ones stay all."""
    rng = random.Random(9)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    near = f"{d} more"
    frame = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.join(frame((3, a), (4, b), (5, a), (5, b), (6, c), (6, d), (7, near), (8, c), (9, "one two"))).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (4, 3), (5, 3), (5, 3), (6, 6), (6, 6), (7, 6), (8, 6), (9, 9)]
    kept = jaccard.keep_one(frame((5, a), (5, b), (3, a), (6, c), (6, c), (6, None), (6, ""), (7, d), (8, near), (8, a), (None, b), (None, b), (None, ""), (9, "x"))).collect()
    same(kept, [(3, a), (6, c), (6, None), (6, ""), (7, d), (None, b), (None, ""), (9, "x")])


def test_jaccard_without_rounds_compares_all_blocks(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 3)
    same(jaccard.join(docs).collect(), brute.near(rows))


def test_jaccard_of_a_dense_group(spark, monkeypatch):
    """Copies that differ in many places, so that few pairs of a large group of one prefix are links, are verified where blocks meet."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(160):
        words = list(base)
        for _ in range(rng.randrange(5, 11)):
            words[rng.randrange(380)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for rounds, block, mass in ((2, 512, 1 << 18), (0, 32, 4000)):
        monkeypatch.setattr(jaccard, "ROUNDS", rounds)
        monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
        monkeypatch.setattr(jaccard, "MASS", mass)
        seen = []
        original = jaccard._Join._dense
        monkeypatch.setattr(jaccard._Join, "_dense", lambda self, dense, blocks, original=original, seen=seen: (seen.append(dense.count()), original(self, dense, blocks))[1])
        same(jaccard.join(frame).collect(), brute.near(rows))
        assert rounds or seen[0]
        monkeypatch.setattr(jaccard._Join, "_dense", original)


def test_jaccard_of_long_texts_that_fall_short(spark, monkeypatch):
    """Long texts that share many shingles, but not enough for a link, meet once by their bitmaps: no list sends whole sets, or the same groups again."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(1500)]
    rows = []
    for k in range(40):
        words = list(base)
        for _ in range(24):
            words[rng.randrange(1500)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    rows.append((40, rows[3][1] + " more"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    names, dense = [], []
    monkeypatch.setattr(jaccard, "stage", lambda df, name, original=jaccard.stage: (names.append(name), original(df, name))[1])
    monkeypatch.setattr(jaccard._Join, "_dense", lambda self, pairs, blocks, original=jaccard._Join._dense: (dense.append(pairs.count()), original(self, pairs, blocks))[1])
    same(jaccard.join(frame).collect(), brute.near(rows))
    assert dense[0] and not sum(dense[1:]) and "jaccard-sets" not in names


def test_groups_that_met_do_not_meet_again():
    first, none = pa.array([1, 2, 1], pa.int64()), pa.array([None, 1], pa.int64())
    assert jaccard._apart(first, first).tolist() == [[False, True, False], [True, False, True], [False, True, False]]
    assert jaccard._apart(first, none).tolist() == [[True, False], [True, True], [True, False]]


def test_pairs_by_whole_bitmaps():
    """Bitmaps of unlike lengths are folded; a place counts for nothing, components and homes that are shared leave a pair out."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1100, dtype=np.uint64)
    sets = [base[:1020], base[:1100], base[:700], base[:1021], rng.integers(0, 1 << 63, 1030, dtype=np.uint64)]
    member = lambda k, component, home: {"node": k, "component": component, "own_n": len(sets[k]), "home": home, "bitmap": jaccard._bitmap(sets[k])}
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("node", "component", "own_n", "home")] + [("bitmap", pa.binary())]))

    def found(left, right=None):
        columns = {"token": pa.array([7], pa.int64()), "x": pa.array([0], pa.int32()), "y": pa.array([0 if right is None else 1], pa.int32())}
        batch = pa.RecordBatch.from_pydict(columns | {"left": pa.array([left], kind), "right": pa.array([right], kind)})
        return [tuple(r.values()) for r in next(jaccard._map_pairs(85)(iter([batch]))).to_pylist()]

    assert len(jaccard._bitmap(sets[0])) < len(jaccard._bitmap(sets[1]))
    assert sorted(x[:2] for x in found([member(k, k, None) for k in range(5)])) == [(0, 1), (0, 3), (1, 3)]
    assert [x[:2] for x in found([member(0, 0, 5)], [member(1, 1, 5), member(3, 3, 6)])] == [(0, 3)]
    assert not found([member(0, 9, None)], [member(1, 9, None)])
    many = [member(k % 2, k, None) for k in range(8)]
    assert found(many) == [(None, None, 7, 0, 0)]


def test_shuffle_files_of_a_staged_table_go(spark):
    """They go when the table is written, and the session's own setting stays as it was."""
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, was = files(), spark.conf.get(session.CLEANUP, None)
    rows = session.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-cleaned")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and rows.count() == 7 and spark.conf.get(session.CLEANUP, None) == was


def test_links_of_a_piece_with_itself():
    """A piece that meets itself comes once, without a second copy of its sets."""
    base = np.arange(100, dtype=np.uint64)
    member = lambda node, x: {"n": len(x), "place": 0, "node": node, "component": node, "shingles": x.tobytes()}
    members = [member(1, base), member(2, base[:95]), member(3, base + np.uint64(1000))]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("n", "place", "node", "component")] + [("shingles", pa.binary())]))
    batch = pa.RecordBatch.from_pydict({"left": pa.array([members], kind), "right": pa.array([None], kind)})
    (links,) = jaccard._dense_links(85)(iter([batch]))
    assert links.to_pylist() == [{"a": 1, "b": 2}]


def test_texts_go_to_python_in_small_batches(spark, docs):
    """A batch of texts is bounded in rows, and the texts cut together in bytes."""
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for operator in (jaccard.join, repeats.remove):
        operator(docs)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    repeats._POWERS.clear()
    assert sum(x.nbytes for x in repeats._powers()) < 10_000_000


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)]
    got = {r.id: r.component for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert all(got.get(x, x) == label[x] for x in label)


def test_repeats(spark, docs, rows):
    got = repeats.remove(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    same(got, brute.repeats(rows))
    cleaned = repeats.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert repeats.remove(empty(spark)).count() == 0
    text = "x" * 60 + "".join(chr(97 + k % 26) for k in range(300))
    twice = spark.createDataFrame([(None, text), (None, text), (3, text)], "doc_id long, text string")
    assert sorted(r.n_removed for r in repeats.remove(twice).collect())[-1] == len(text)


def test_repeats_of_a_document_listed_twice(spark):
    """Rows equal in id and text lose the same bytes, and a passage they share with another keeps its first occurrence."""
    rng = random.Random(8)
    shared = prose(rng, 60)
    first, other, copy = f"{prose(rng, 40)} {shared} {prose(rng, 40)}", f"{prose(rng, 40)} {shared} {prose(rng, 40)}", f"{prose(rng, 50)} {shared}"
    table = [(1, first), (1, first), (2, other), (None, copy), (None, copy)]
    want = {(r[0], r[1]): r[1:] for r in brute.repeats([(None, copy), (1, first), (2, other)])}
    got = repeats.remove(spark.createDataFrame(table, "doc_id long, text string")).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    same(got, [(i, *want[i, len(t.encode())]) for i, t in table])
    assert sum(r.n_removed for r in got if r.doc_id is None) == 0 < min(r.n_removed for r in got if r.doc_id)


def test_column_index_orders_suffixes():
    rng = np.random.default_rng(5)
    strings = [bytes(rng.integers(97, 99, 20).astype(np.uint8)) for _ in range(40)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    index = repeats.ColumnIndex(data, np.arange(41) * 20, np.full(40, 6), 6, 20)
    for column, order, prefix in index.rounds():
        tails = [strings[k][column:] for k in order]
        assert tails == sorted(tails)
        for k in range(1, 40):
            assert prefix[k] == len(os.path.commonprefix([tails[k - 1], tails[k]]))
    index.close()


def test_warc(spark):
    rng = random.Random(2)
    body = prose(rng, 60)
    rows = [(k, f"http://a/{k}", body if k % 3 == 0 else prose(rng, 50)) for k in range(40)]
    rows += [(50, None, None), (51, "a\r\nb c", ""), (52, "u", "short"), (53, "u", "short"), (None, "n", body), (55, "big", "z" * 3_000_000), (56, "", body)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    archives = warc.write(frame)
    got = warc.read(archives)
    same(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(), brute.pages([(i, h) for i, _, h in rows]))
    held = {r.page_id: r.payload for r in got.filter("record_type = 'response'").collect()}
    assert held[55] == b"z" * 3_000_000
    assert warc.read(warc.write(frame.limit(0))).count() == 0


def test_pivots(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(0, 0.3, 16)]) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(120)]
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 16), (503, [float("inf")] * 16), (520, [0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("pivot", F.lit(1))
    want = brute.top([(i, None if v is None else list(v) + [0.0] * (16 - len(v)) if None not in v else v) for i, v in rows])
    same(pivots.top_k(frame, pivots=5).collect(), want)
    assert pivots.top_k(frame.limit(0)).count() == 0
    few = pivots.top_k(frame.filter("vec_id < 3"))
    assert [(r["rank"], r.vec_id) for r in few.orderBy("rank").collect()] and few.count() == 2


PERSONAL = [
    "mail a.b_c@d@e.fg or x@y.z.w_v@u.t, then 1.2.3.4.5.6.7.8 and 256.1.1.1 and 0255.001.0.9",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4111111111111111",
    "call +1 (017) 555-7713 or +49 30 1234567 190.137.223.204 now +1 +12345678",
    'é日 token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ü a@b.c',
    None, "", "no data here", "1" * 5000 + "@" + "a" * 5000 + ".b" * 3000, "+" + "1 " * 3000,
]


def test_personal(spark):
    rows = list(enumerate(PERSONAL * 3))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_base", F.lit(0)).withColumn("spans", F.lit(0))
    for r, (_, text) in zip(sorted(pii.find(frame).collect(), key=lambda r: r.doc_id), rows, strict=True):
        base = brute.spans_text(brute.personal(text))
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.base) == base
        assert set(filter(None, base.split(","))) <= {f"{s.kind}:{s.start}:{s.end}" for s in r.spans}
    clean = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert "a@b.c" not in clean[3] and clean[3].endswith("[EMAIL]") and clean[4] is None and clean[6] == "no data here"
    assert pii.find(empty(spark)).count() == 0


def test_labelers_are_weighed():
    """A labeler that agrees with the rest ends up more reliable than one that does not."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = []
    for truth in (1, -1):
        for wrong in (0, 1):
            votes = {"pattern": truth, "gazetteer": truth, "assigned": truth, "quoted": truth, "mixed": truth if wrong == 0 else -truth, "glued": 0}
            rows.append((*votes.values(), 30 if wrong else 40))
    prior, right = pii.estimate(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in pii.LABELERS) + ", n long"))
    assert 0.3 < prior < 0.7 and right["pattern"] > 0.9 and right["mixed"] < 0.7
