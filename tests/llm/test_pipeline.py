"""The registered queries over the smallest tables, and the pipeline's stages."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import brute  # noqa: E402
import public_tokenizers  # noqa: E402
from compare import connect, differences  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerloom.llm.checks import CHECKS  # noqa: E402
from ledgerloom.llm.queries import QUERIES  # noqa: E402
from ledgerloom.session import stage  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(CHECKS))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), CHECKS[name]) is None


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER), "test-stage")
        kept.append({tuple(r) for r in docs.select("doc_id", "text").collect()} if docs.columns == columns else docs)
    quality, near, repeats, private, pieces = kept
    assert {i for i, _ in near} == {i for i, _, c in brute.near(sorted(quality), 5, 80) if i == c}
    want = {r[0]: r[4] for r in brute.repeats(sorted(near))}
    assert {i: brute.sha(t) for i, t in repeats} == want
    assert not [1 for _, t in private if brute.personal(t)]
    rows = [r.asDict() for r in pieces.collect()]
    assert brute.check_packing(rows, sorted(private), public_tokenizers.path("word_bpe_49k.json")) == 0


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ta", "re", "mi", "so", "lu", "en"]) for _ in range(rng.randint(1, 4))) for _ in range(n)) + "."


def test_awkward_rows(spark, path):
    """Nulls, blanks, repeated rows, shared ids, a very long text and columns with the stages' own names."""
    a, b, c = prose(1, 120), prose(2, 120), prose(3, 30_000)
    rows = [(1, a), (1, a), (2, a + " more"), (3, b), (3, prose(4, 90)), (None, prose(5, 80)), (None, None), (4, None), (5, ""), (6, " \n "), (7, c), (8, b)]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, _row string, n long, component int")
    frame.write.parquet(f"{path}/documents.parquet")
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, path).collect()]
    kept = [(1, a), (3, b), (3, prose(4, 90)), (None, prose(5, 80)), (7, c)]
    assert sorted({p["doc_id"] for p in pieces}, key=repr) == sorted({i for i, _ in kept}, key=repr)
    library = brute_tokens([t for _, t in kept])
    assert sum(p["length"] for p in pieces) == sum(len(x) + 1 for x in library)


def brute_tokens(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_an_empty_table(spark, path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_run_is_the_stages_in_a_row(spark):
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, FOLDER).collect()]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, FOLDER), "test-stage")
    kept = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert brute.check_packing(pieces, kept, public_tokenizers.path("word_bpe_49k.json")) == 0
