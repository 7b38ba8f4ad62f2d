from collections import Counter

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


def test_strip_html(spark):
    def strip(v):
        return one(spark, v, tx.strip_html)

    assert strip(None) is None
    assert strip("") is None
    assert strip("plain") == "plain"
    assert strip("<p> one </p>\n<p>two\nlines</p>") == "one two\nlines"
    assert strip("a<!-- c -->b<script>x='<b>'</script>c<style>p{}</style>") == "a b c"
    assert strip('<a title="x > y">t</a>') == "t"
    assert strip("1 < 2 &amp;&lt;b&gt; &#8217;&#x41; &nbsp; <br> &unknown; AT&T") == "1 < 2 &<b> ’A &unknown; AT&T"
    assert strip("<!DOCTYPE html><b>&nbsp;</b><i>x</i>") == "x"


def test_strip_html_long_runs(spark):
    deep = "<td>" * 20_000 + "x" + " " * 50_000 + "y" + "</td>" * 20_000
    assert one(spark, deep, tx.strip_html) == "x" + " " * 50_000 + "y"


def test_clean_tokens(spark):
    value = "The foo-bar don't STOP, a I x Über  café\n2x dogs dogs"
    assert one(spark, value, tx.clean_tokens) == ["foobar", "dont", "stop", "ber", "caf", "dogs", "dogs"]
    assert one(spark, "", tx.clean_tokens) == []


def test_words_counted_in_arrow_are_those_of_the_expression(spark, monkeypatch):
    blanks = "".join(f"a{c}b{c} " for c in tx.SPACE_CHARS)
    texts = [blanks, None, "", "The foo-bar don't STOP, a I x Über  café\n2x dogs dogs", "end", "start", "é\u2003x\u200by 漢字ab\u3000cd\u00adef ", " ", "𝒳yz\x00zy İx KK"]
    df = spark.createDataFrame(list(enumerate(texts * 3)), "id long, t string").coalesce(1)
    monkeypatch.setattr(tx, "SLICE_BYTES", 40)
    want = {(r["id"], r["w"], r["n"]) for r in tx.unnest(df, ["id"], tx.clean_tokens("t"), "w").groupBy("id", "w").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = tx.with_clean_term_counts(df, "t")
    assert {(r["id"], x["term"], x["tf"]) for r in got.collect() for x in r["terms"] or []} == want
    assert [r["id"] for r in got.filter("terms IS NULL").collect()] == [1, 10, 19]
    batch = pa.RecordBatch.from_pydict({"id": list(range(9)), "t": texts})
    rows = [r for b in tx._count_clean_words([batch.slice(2), batch.slice(0, 0)]) for r in b.to_pylist()]
    assert {(r["id"], x["term"], x["tf"]) for r in rows for x in r["terms"]} == {w for w in want if 2 <= w[0] < 9}


def test_word_tokens(spark):
    assert one(spark, "The Größe of a_b x 42!", tx.word_tokens) == ["größe", "a_b", "42"]


def test_small_functions(spark):
    row = spark.createDataFrame([("", "x", None, "abcdef")], "a string, b string, c string, d string").select(
        tx.first_non_empty("a", "c", "b"), tx.truncate("d", 3), tx.truncate("c", 3),
        tx.join_non_empty(", ", "b", "a"), tx.join_non_empty(", ", "a", "c"), tx.full_text("c", "b"),
    ).first()
    assert tuple(row) == ("x", "abc", None, "x", None, " x")


def test_match_count(spark):
    def count(query, regex=False):
        return one(spark, "A.b a.B aXb É \\E", lambda c: tx.match_count(c, query, regex))

    assert count("a.b") == 2
    assert count("a.b", regex=True) == 3
    assert count("é") == 1
    assert count("\\E") == 1
    assert one(spark, None, lambda c: tx.match_count(c, "x")) == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "bb", "é"]), max_size=8), min_size=1, max_size=4))
def test_term_counts(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, w array<string>")
    got = {r["id"]: {x["term"]: x["tf"] for x in r["terms"]} for r in tx.with_term_counts(df, F.col("w")).collect()}
    assert got == {i: dict(Counter(w)) for i, w in enumerate(rows)}


def test_counting_leaves_the_text_behind(spark):
    """Words are counted in Arrow and the text goes no further; a row without words has no terms, one without a list no list."""
    rows = [(1, "b a b", ["b", "a", "b"]), (2, "", []), (3, None, None), (4, "é", ["é"])]
    df = spark.createDataFrame(rows, "id int, text string, w array<string>")
    counted = tx.with_term_counts(df, F.col("w"), without="text")
    assert counted.columns == ["id", "w", "terms"]
    got = {r["id"]: None if r["terms"] is None else {x["term"]: x["tf"] for x in r["terms"]} for r in counted.collect()}
    assert got == {1: {"b": 2, "a": 1}, 2: {}, 3: None, 4: {"é": 1}}
