import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import stem
from ledgerloom.functions.text import STOPWORDS
from ledgerloom.operators import entities, search, sentiment, summary, textindex

TEXTS = [
    "Steel and iron mills. Iron ore!", "iron bank of the north", "", None, "the and of", "Banking services, steel steel",
    "gold mine in the north north", "oil", "IRON Steel Gold oil",
] + [f"iron filler{i}" for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").cache()


def cosine(query):
    bags = [Counter(w for w in re.findall(r"\w\w+", (t or "").lower()) if w not in STOPWORDS) for t in TEXTS]
    df = Counter(w for b in bags for w in b)
    idf = {w: math.log((1 + len(bags)) / (1 + n)) + 1 for w, n in df.items()}
    q = {w: c * idf[w] for w, c in Counter(re.findall(r"\w\w+", query.lower())).items() if w in idf}
    qn = math.sqrt(sum(v * v for v in q.values())) or 1
    out = []
    for b in bags:
        n = math.sqrt(sum((c * idf[w]) ** 2 for w, c in b.items())) or 1
        out.append(sum(c * idf[w] * q.get(w, 0) for w, c in b.items()) / n / qn)
    return out


@pytest.mark.parametrize("limit", [200_000, 0])
def test_tfidf(docs, monkeypatch, limit):
    """Once with the broadcast statistics, once with the salted join."""
    monkeypatch.setattr(search, "BROADCAST_ROWS", limit)
    got = {r["doc_id"]: r["score"] for r in search.tfidf_scores(docs, "Iron steel unknownword").collect()}
    np.testing.assert_allclose([got[i] for i in range(len(TEXTS))], cosine("Iron steel unknownword"))


def test_tfidf_top_fills_with_zeros(docs):
    got = search.tfidf_search(docs, "gold", top=5).collect()
    assert len(got) == 5 and [r["doc_id"] for r in got][2:] == [0, 1, 2] and got[2]["score"] == 0
    assert all(r["score"] == 0 for r in search.tfidf_search(docs, "nothinghere", top=3).collect())


def test_keyword(docs):
    got = [(r["doc_id"], r["matches"]) for r in search.keyword_search(docs.filter("doc_id < 9"), "iron").collect()]
    assert got == [(0, 2), (1, 1), (8, 1)]
    assert search.keyword_search(docs, "").count() == 0
    assert search.keyword_search(docs, "st.el|gold", regex=True, top=1).first()["doc_id"] == 5
    assert search.keyword_search(docs, "st.el").count() == 0


def test_fulltext(docs):
    index = search.inverted_index(docs, F.col("text"))
    assert [tuple(r) for r in search.fulltext_search(index, ["Iron", "steel"]).orderBy("doc_id").collect()] == [(0, 3), (8, 2)]


def test_entities(spark):
    names = spark.createDataFrame(
        [("General Steel", "GS"), ("steel", "ST"), ("General steel", "G2"), ("...", "X")], "alias string, ticker string"
    )
    table = entities.alias_table(names, "alias", "ticker")
    arts = spark.createDataFrame(
        [(1, "GENERAL  Steel rises", "text"), (2, None, "steel, steel."), (3, "steel", None), (4, "generals", "steels")],
        "id int, title string, content string",
    )
    pairs = entities.mentions(arts, table)
    assert sorted(map(tuple, pairs.collect())) == [(1, "G2"), (1, "GS"), (1, "ST"), (2, "ST")]
    full = {r["id"]: r["mentioned_tickers"] for r in entities.mentioned_tickers(arts, pairs).collect()}
    assert full == {1: ["G2", "GS", "ST"], 2: ["ST"], 3: [], 4: []}


REVIEWS = [("great film great cast", "pos"), ("great story", "pos"), ("bad film", "neg"), ("bad bad cast story", "neg"),
           ("great film", "pos"), ("dull story film", "neg"), ("great great", "pos"), ("cast story bad", "neg"), ("film", "pos")]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, c) for i, (t, c) in enumerate(REVIEWS)]
    return sentiment.fit(spark.createDataFrame(rows, "id int, text string, label string"), "id", min_df=2)


def brute_force(texts):
    bags = [Counter(t.split()) for t, _ in REVIEWS]
    df = Counter(w for b in bags for w in b)
    voc = sorted(w for w, n in df.items() if n >= 2)
    idf = np.array([math.log((1 + len(bags)) / (1 + df[w])) + 1 for w in voc])

    def vec(t):
        v = np.array([Counter(t.split())[w] for w in voc]) * idf
        return v / (np.linalg.norm(v) or 1)

    x, y = np.array([vec(t) for t, _ in REVIEWS]), np.array([c == "pos" for _, c in REVIEWS])
    score = []
    for c in (True, False):
        s = x[y == c].sum(axis=0) + 1
        score.append(np.array([vec(t) for t in texts]) @ np.log(s / s.sum()) + math.log((y == c).mean()))
    return 1 / (1 + np.exp(score[1] - score[0]))


def test_sentiment(spark, model, path):
    texts = ["great cast", "bad dull", "nothing known", "film film story great"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(9, None), (8, " ")], "id int, text string")
    got = {r["id"]: r for r in model.predict(df, "id").collect()}
    np.testing.assert_allclose([got[i]["p_pos"] for i in range(4)], brute_force(texts))
    model.save(path)
    loaded = sentiment.SentimentModel.load(spark, path)
    scores = {r["id"]: r["sentiment_score"] for r in loaded.score(df, "id").collect()}
    assert scores[9] is None and scores[8] is None and scores[2] == 0.556
    assert [r["term"] for r in loaded.vocabulary().orderBy("term_index").collect()] == ["bad", "cast", "film", "great", "story"]


def test_sentiment_needs_both_classes(spark):
    with pytest.raises(ValueError):
        sentiment.fit(spark.createDataFrame([(1, "x y", "pos")], "id int, text string, label string"), "id", min_df=1)


def test_vocabulary_limit(spark):
    df = spark.createDataFrame([(t,) for t, _ in REVIEWS], "text string")
    got = sentiment.vocabulary(df, min_df=2, max_features=2).orderBy("term_index").collect()
    assert [(r["term"], r["df"], r["freq"]) for r in got] == [("film", 5, 5), ("great", 4, 6)]
    assert sentiment.vocabulary(df, min_df=1, max_features=None).count() == 6


def test_evaluation(spark):
    rows = [("pos", "pos")] * 3 + [("pos", "neg")] + [("neg", "pos")] * 2 + [("odd", "neg")]
    matrix = sentiment.confusion(spark.createDataFrame(rows, "label string, prediction string"))
    got = {r["label"]: r for r in sentiment.class_report(matrix).collect()}
    assert (got["pos"]["precision"], got["pos"]["recall"], got["pos"]["support"]) == (0.6, 0.75, 4)
    assert (got["neg"]["precision"], got["neg"]["recall"], got["neg"]["f1"]) == (0, 0, 0)
    assert got["odd"]["support"] == 1
    empty = spark.createDataFrame([], "keyword string, sentiment_score double")
    assert sentiment.keyword_sentiment(empty).count() == 0


@pytest.mark.parametrize("few", [10_000, 0])
def test_exact_quantiles(spark, monkeypatch, few):
    monkeypatch.setattr(summary, "SLICES", 8)
    monkeypatch.setattr(summary, "MAX_BROADCAST_KEYS", few)
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(size=501), "b": np.round(rng.normal(size=300), 1), "c": np.ones(40), "d": np.array([2.0])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = (0.0, 0.03, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {(r["k"], r["prob"]): r["value"] for r in summary.exact_quantiles(df, ["k"], "v", probs).collect()}
    for k, vs in values.items():
        np.testing.assert_allclose([got[k, p] for p in probs], np.quantile(vs, probs))


def test_describe_and_histogram(spark):
    df = spark.createDataFrame([("x", float(v)) for v in [0, 0.05, 0.95, 1]], "label string, v double")
    row = summary.describe(df, ["label"], ["v"]).first()
    assert (row["n"], row["min"], round(row["p50"], 9), row["max"]) == (4, 0, 0.5, 1)
    bins = {r["bin"]: r["n"] for r in summary.histogram(df, "label", "v", 0.0, 1.0, 20).collect()}
    assert bins == {1: 1, 2: 1, 20: 2}


def plain_stem(w):
    """Porter's rules word by word, with measures counted rather than matched."""
    if len(w) < 3 or not re.fullmatch("[a-z]+", w):
        return w

    def consonant(s, i):
        return s[i] not in "aeiou" and (s[i] != "y" or i == 0 or not consonant(s, i - 1))

    def measure(s):
        return sum(consonant(s, i) and not consonant(s, i - 1) for i in range(1, len(s)))

    def vowel(s):
        return any(not consonant(s, i) for i in range(len(s)))

    def short(s):
        n = len(s)
        return n > 2 and consonant(s, n - 3) and not consonant(s, n - 2) and consonant(s, n - 1) and s[-1] not in "wxy"

    def double(s):
        return len(s) > 1 and s[-1] == s[-2] and s[-1] not in "aeiouy"

    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        cut = next((w[: -len(e)] for e in ("ed", "ing") if w.endswith(e) and vowel(w[: -len(e)])), None)
        if cut is not None:
            w = cut
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif double(w) and w[-1] not in "lsz":
                w = w[:-1]
            elif measure(w) == 1 and short(w):
                w += "e"
    if w.endswith("y") and vowel(w[:-1]):
        w = w[:-1] + "i"
    for table in (stem.STEP_2, stem.STEP_3):
        end = max((e for e in table if w.endswith(e)), key=len, default=None)
        if end and measure(w[: -len(end)]) > 0:
            w = w[: -len(end)] + table[end]
    end = max((e for e in [*stem.STEP_4, "ion"] if w.endswith(e)), key=len, default=None)
    if end and measure(w[: -len(end)]) > 1 and (end != "ion" or w[-4] in "st"):
        w = w[: -len(end)]
    if w.endswith("e") and (measure(w[:-1]) > 1 or measure(w[:-1]) == 1 and not short(w[:-1])):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and measure(w) > 1 else w


def test_stems(spark):
    words = "caresses ponies ties caress cats feed agreed plastered bled motoring sing conflated troubled sized hopping tanned falling hissing fizzed failing filing happy sky".split()
    words += "relational conditional rational valenci digitizer conformabli radicalli differentli vileli analogousli vietnamization predication operator feudalism decisiveness".split()
    words += "hopefulness callousness formaliti sensitiviti sensibiliti triplicate formative formalize electriciti electrical hopeful goodness revival allowance inference airliner".split()
    words += "gyroscopic adjustable defensible irritant replacement adjustment dependent adoption homologou communism activate angulariti homologous effective bowdlerize probate rate cease controll roll".split()
    words += "yes yelled syzygy toy crying by is a über don't work5 aaa eee licensing works bbbs ied ing sses".split()
    rng = random.Random(2)
    words += ["".join(rng.choice(["b", "t", "l", "s", "y", "a", "e", "i", "ing", "ed", "ation", "ness", "al", "ment", "ion", "e", "er"]) for _ in range(rng.randint(2, 6))) for _ in range(1500)]
    rows = spark.createDataFrame([(w,) for w in set(words)], "word string")
    wrong = [(r["word"], r["stem"], plain_stem(r["word"])) for r in stem.with_stem(rows, "word", "stem").collect() if r["stem"] != plain_stem(r["word"])]
    assert not wrong
    assert [plain_stem(w) for w in ("relational", "hopping", "adjustment", "licensing")] == ["relat", "hop", "adjust", "licens"]


def test_stored_index(spark, path, monkeypatch):
    monkeypatch.setattr(textindex, "SPAN", 4)
    monkeypatch.setattr(textindex, "DOCS_PER_BUCKET", 2)
    texts = {k: f"{'common ' * (k % 3 + 1)} w{k % 5} {'rare' if k in (3, 17) else ''}" for k in range(40)} | {-7: "common w3", 50: None, 51: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    index = textindex.TextIndex(spark, path)
    for name, part in (("a", "doc_id < 20"), ("b", "doc_id >= 20 OR doc_id IS NULL")):
        assert index.add(docs.filter(part), F.col("text"), name)
        assert not index.add(docs, F.col("text"), name)

    def check():
        for words in (["common"], ["common", "W3"], ["rare", "w3", "the"], ["rare", "w2"], ["absent"], ["the"]):
            wanted = {w.lower() for w in words} - {"the"}
            want = {(k, sum(t.split().count(w) for w in wanted)) for k, t in texts.items() if t and wanted and all(w in t.split() for w in wanted)}
            assert {(r["doc_id"], r["hits"]) for r in index.search(words).collect()} == want

    check()
    assert index.postings(["common"]).agg(F.max(F.size("offsets"))).first()[0] == 4
    before = len(index.opened(["rare"]))
    index.merge()
    check()
    assert before == 2 and len(index.opened(["rare"])) == 1
    read = index.postings(["rare"]).inputFiles()
    assert len(read) < len(spark.read.parquet(f"{path}/{index._segments()[0]['folder']}").inputFiles())
    assert not index.add(docs, F.col("text"), "b")


def test_matcher_passes_little_but_hits(spark):
    aliases = entities.alias_table(spark.createDataFrame(
        [("Acme", "A"), ("acme corp", "B"), ("The quick brown", "C"), ("The quick brown", "D"), (" ".join(f"w{k}" for k in range(70)), "L"), (None, "N")], "alias string, ticker string"
    ), "alias", "ticker")
    text = "the Acme Corp. and the quick red fox; the quick brown dog " + " ".join(f"w{k}" for k in range(71)) + " acme"
    docs = spark.createDataFrame([(1, "", text), (2, "acme", ""), (3, "", None), (None, "x", "the quick")], "id long, title string, content string")
    got = {(r["id"], r["ticker"]) for r in entities.mentions(docs, aliases).collect()}
    assert got == {(1, t) for t in "ABCDL"} | {(2, "A")}
    words = docs.select("id", F.filter(F.split(F.lower(F.concat_ws(" ", "title", "content")), "[^a-z0-9]+"), lambda w: w != "").alias("w"))
    assert entities.Matcher(aliases).phrases(words, "id", "w").count() == 5


def test_tickers_of_texts_shuffle_no_pairs(spark, monkeypatch):
    """The tree of a small alias table finds what the tables of a large one find, and a list per article is all that is shuffled."""
    names = [("the", f"T{k}") for k in range(40)] + [("a b c", "A"), ("b", "B"), ("b c", "C"), ("c d", "D"), ("été b", "E"), ("d d d", "F")]
    aliases = entities.alias_table(spark.createDataFrame(names, "alias string, ticker string"), "alias", "ticker")
    rows = [(1, "x", "a b c d"), (2, "The", "b"), (3, None, None), (4, "", ""), (5, "d d", "D d, Été-B"), (6, "c", "a b"), (7, "a b", "c"), (7, None, "the")]
    docs = spark.createDataFrame(rows, "id long, title string, content string").repartition(2)
    found = entities.tickers_of_texts(docs, aliases)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {r["id"]: r["mentioned_tickers"] for r in found.collect()}
    assert got[1] == ["A", "B", "C", "D"] and got[3] == got[4] == [] and got[5] == ["B", "E", "F"] and got[6] == ["B"] and len(got[7]) == 43
    pairs = {(r["id"], r["ticker"]) for r in entities.mentions(docs, aliases).collect()}
    monkeypatch.setattr(entities, "BROADCAST_ROWS", 0)
    assert {(r["id"], r["ticker"]) for r in entities.mentions(docs, aliases).collect()} == pairs == {(k, x) for k, v in got.items() for x in v}
    assert {r["id"]: r["mentioned_tickers"] for r in entities.tickers_of_texts(docs, aliases).collect()} == got
