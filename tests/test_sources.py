import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import companies
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.store import BatchStore
from ledgerloom.plans.views import seed_exchanges
from ledgerloom.sources import articles, braces, market, records


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return folder


def test_feed_rules(spark):
    rows = [
        ("u1", "t", None, "2026-04-06T00:00:00Z", [("<b>long</b>",)], "short", "Feed", "f1", 1),
        ("u1", "later", None, None, None, "x", "Other", "f2", 9),
        ("", "no link", None, None, None, "x", "Feed", "f1", 2),
        (None, "no link", None, None, None, "x", "Feed", "f1", 3),
        ("u2", "t2", None, "bad", [], "<i>s</i>", None, "f1", 4),
        ("u3", "t3", None, None, None, None, None, "f1", 5),
    ]
    got = {r["url"]: r for r in articles.feed_articles(spark.createDataFrame(rows, schemas.FEED_ITEM)).collect()}
    assert set(got) == {"u1", "u2", "u3"}
    assert (got["u1"]["title"], got["u1"]["content"], got["u1"]["publisher"]) == ("t", "long", "Feed")
    assert got["u1"]["published_at"] == datetime(2026, 4, 6)
    assert (got["u2"]["content"], got["u2"]["publisher"], got["u2"]["published_at"]) == ("s", "f1", None)
    assert got["u3"]["content"] is None and got["u3"]["source"] == "rss" and got["u3"]["mentioned_tickers"] == []


def test_source_is_only_stamped_when_missing(spark):
    df = spark.createDataFrame([("a", "own"), ("b", None)], "url string, source string")
    assert [r["source"] for r in articles.tag_source(df, "rss").orderBy("url").collect()] == ["own", "rss"]


def test_feed_file_with_broken_item(spark, path):
    write(path, "a.xml", "<rss><item><link>u1</link><summary> s </summary></item></rss>")
    write(path, "b.xml", "<rss><item><link>u2</link><summary>t</summary></item><item><link>u3</rss>")
    assert {r["link"] for r in articles.read_feeds(spark, path).collect()} >= {"u1", "u2"}


HISTORY = [
    ("2020-06-05 06:30:54 UTC", "t", "A", "u1", "p", "x"),
    ("2020-06-30 18:00:00", "t", "A", "u2", "p", "x"),
    ("2020-07-01", "t", "A", "u3", "p", "x"),
    (None, "t", "A", "u4", "p", "x"),
    ("2020-06-10", "t", "B", "u5", "p", "x"),
    ("2020-06-10", "t", "", "u6", "p", "x"),
    ("2020-06-10", "t", "A", "", "p", "x"),
    ("2020-06-10", "t", "A", None, "p", "x"),
]


def test_history_filters(spark):
    rows = spark.createDataFrame(HISTORY, schemas.NEWS_HISTORY)
    kept = articles.historical_news(rows, ["A"], "2020-06-05", "2020-06-30")
    assert {r["url"] for r in kept.collect()} == {"u1", "u2", "u4"}
    every = {r["url"]: r for r in articles.historical_news(rows).collect()}
    assert set(every) == {"u1", "u2", "u3", "u4", "u5", "u6"}
    assert every["u6"]["mentioned_tickers"] == [] and every["u1"]["content"] is None
    counts = {r["status"]: r["n"] for r in articles.scan_counters(rows, ["A"], "2020-06-05", "2020-06-30").collect()}
    assert counts == {"kept": 3, "skipped": 5}


def test_quarantine(spark):
    rows = articles.normalise_history(spark.createDataFrame(HISTORY, schemas.NEWS_HISTORY))
    good, bad = articles.quarantine(rows)
    assert good.count() == 5
    assert sorted(r["reason"] for r in bad.collect()) == ["no date", "no url", "no url"]


def test_registry(spark):
    one = spark.createDataFrame([("u",)], "url string")
    registry = articles.SourceRegistry().add("a", lambda s: one).add("b", lambda s: one)
    assert sorted(r["source"] for r in registry.extract(spark).collect()) == ["a", "b"]
    assert [r["source"] for r in registry.extract(spark, "b").collect()] == ["b"]
    with pytest.raises(KeyError):
        registry.extract(spark, "c")


def test_watchlist(spark, path):
    good = [{"Ticker": "AB", "Company": "x"}, {"Ticker": "CD", "Company": "y"}]
    write(f"{path}/array", "a.json", json.dumps(good, indent=2))
    assert [r["Ticker"] for r in market.read_watchlist(spark, f"{path}/array", multi_line=True).collect()] == ["AB", "CD"]
    write(f"{path}/none", "a.json", json.dumps([{"Company": "x"}]))
    with pytest.raises(Exception, match="without Ticker"):
        market.read_watchlist(spark, f"{path}/none").collect()
    write(f"{path}/bad", "a.json", '{"Ticker": ')
    with pytest.raises(Exception):
        market.read_watchlist(spark, f"{path}/bad").collect()


def test_daily_bars(spark):
    rows = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.5, 1.5, 10, "A"), ("2024-02-01", 1.0, 2.0, 0.5, 1.5, 10, "A")], schemas.PRICE_BAR
    )
    got = market.daily_bars(rows, "2024-01-01", "2024-02-01").collect()
    assert [(r["ticker"], r["date"], float(r["close"]), r["volume"]) for r in got] == [("A", date(2024, 1, 2), 1.5, 10)]


def test_symbols(spark):
    rows = [
        ("BRK/B", "n", "20000000", "Canada"), ("A^B", "n", "20000000", "Canada"), (None, "n", "20000000", "Canada"),
        ("X", "n", "n/a", "Canada"), ("Y", "n", "10000000", "Canada"), ("Z", "n", "20000000", "China"),
        ("W", "n", None, "Canada"),
    ]
    first = spark.createDataFrame(rows, "symbol string, name string, marketCap string, country string").selectExpr(
        "*", "cast(null as string) ipoyear", "'i' industry", "'s' sector"
    )
    got = market.symbol_universe(first, first.drop("ipoyear")).collect()
    assert [(r["symbol"], r["marketCap"]) for r in got] == [("BRK-B", 2e7)] * 2
    assert market.symbols_like(first, "symbol", "BRK").count() == 1


def test_keep_exchange(spark):
    rows = spark.createDataFrame([(1, "nyse arca"), (2, "Nasdaq"), (3, None)], "id int, exchange string")
    assert [r["id"] for r in market.keep_exchange(rows, "exchange").collect()] == [1]
    assert market.keep_exchange(rows.filter("id > 1"), "exchange").count() == 2


def test_concatenated_json(spark, path):
    tricky = 'a "q" }{ ][ \\ end'
    objects = [{"symbol": str(i), "longName": tricky, "marketCap": i} for i in range(6)]
    o = [json.dumps(x) for x in objects]
    write(path, "a.json", f"{o[0]}{o[1]}\n[{o[2]}, {o[3]}][{o[4]}]  {o[5]}\n\n")
    got = sorted(records.read_profiles(spark, path).collect(), key=lambda r: r["symbol"])
    assert [(r["symbol"], r["longName"], r["marketCap"]) for r in got] == [(str(i), tricky, i) for i in range(6)]
    pretty = path + "-pretty"
    write(pretty, "a.json", json.dumps(objects[:3], indent=4) + "\n" + json.dumps(objects[3], indent=4))
    assert records.read_profiles(spark, pretty).count() == 4


def test_objects_over_splits(spark, path):
    """Every object of pretty-printed files comes back in order, however small the splits are."""
    objects = [{"symbol": str(i), "longName": 'a "q" }{ \\ ' + "x" * (i % 40), "marketCap": i} for i in range(300)]
    write(path, "a.json", json.dumps(objects, indent=2))
    write(path, "b.json", "\n".join(json.dumps(o, indent=1) for o in objects[:100]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        rows = records.read_profiles(spark, path).orderBy("seq.file", "seq").collect()
        assert braces.scan_objects(spark, path).rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["symbol"] for r in rows] == [str(i) for i in range(300)] + [str(i) for i in range(100)]


def test_objects_are_parsed_once(spark, path):
    """Reading the profiles again neither scans nor parses the landed files again."""
    write(path, "p.json", '{"symbol": "A"} {"symbol": "B"}')
    plan = records.read_profiles(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "MapInArrow" not in plan


def test_broken_profiles_cost_only_themselves(spark, path):
    good = [json.dumps({"symbol": str(i), "longName": "n"}, indent=1 if i % 2 else None) for i in range(8)]
    text = ["}", good[0], '{"symbol": "open", "longName": ', good[1], good[2], '{"symbol": bad}', good[3], good[4], 'null "x"', good[5]]
    text += ['{"symbol": "typed", "marketCap": "much"}', good[6], '{"symbol": "late"', good[7]]
    for name, cut in (("a", "\n"), ("b", "\n\n")):
        write(f"{path}/{name}", "p.json", cut.join(text))
        for size in ("40b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = records.read_profiles(spark, f"{path}/{name}").orderBy("seq").collect()
            assert [r["symbol"] for r in rows] == ["0", "1", "2", "3", "4", "5", "typed", "6", "7"]
            bad = records.broken_profiles(spark, f"{path}/{name}").orderBy("seq").collect()
            assert [r["reason"] for r in bad] == ["not a record"] * 4 + ["a value of the wrong type", "not a record"]
            assert [r["value"].split(",")[0] for r in bad] == ["}", '{"symbol": "open"', '{"symbol": bad}', 'null "x"', '{"symbol": "typed"', '{"symbol": "late"']
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_companies_from_landed_profiles(spark, path):
    profiles = [{"symbol": s, "exchange": e, "longName": n} for s, e, n in (("A", "NYQ", "first"), ("A", "NYQ", "again"), ("B", "LSE", "x"), (None, "NYQ", "y"), ("C", "NMS", "c"))]
    write(f"{path}/in", "p.json", "".join(json.dumps(p, indent=1) for p in profiles))
    rows = records.read_profiles(spark, f"{path}/in")
    exchanges = seed_exchanges(spark)
    store = BatchStore(spark, f"{path}/companies", schemas.COMPANIES.schema, ["ticker", "exchange_code"], id="id")
    assert companies.append_companies(rows, exchanges, store, "0", dry_run=True) == 2
    assert companies.append_companies(rows, exchanges, store, "0") == 2
    assert companies.append_companies(rows, exchanges, store, "0") == 2
    assert companies.append_companies(rows, exchanges, store, "1") == 0
    assert sorted((r["id"], r["ticker"], r["name"]) for r in store.read().collect()) == [(1, "A", "first"), (2, "C", "c")]
    assert companies.load_companies(rows, exchanges, store.read().limit(0)).count() == 2


def test_search_payloads(spark):
    item = {
        "title": "t", "description": None, "canonical_url": "/x", "published_time": "2024-01-01T00:00:00Z",
        "thumbnail": {"renditions": {"original": {"480w": "img"}}},
    }
    bad = [{k: v for k, v in item.items() if k != drop} for drop in item] + [{**item, "thumbnail": None}]
    payload = json.dumps({"result": {"articles": [item, *bad]}})
    rows = records.nested_hits(spark.createDataFrame([(payload,)], "payload string"), "https://h").collect()
    assert [tuple(r) for r in rows] == [("https://h/", "t", None, "https://h/x", "img", date(2024, 1, 1))]
    flat = json.dumps([{"title": "t", "description": "d", "url": "u", "dominantimage": None, "publishtime": "x"}, {}])
    rows = records.flat_hits(spark.createDataFrame([(flat,)], "payload string"), "https://h").collect()
    assert [tuple(r) for r in rows] == [("https://h/", "t", "d", "u", None, None)]


def test_shuffled_hits_are_the_same_rows(spark):
    rows = spark.range(50).selectExpr(
        "'s' source", "'t' title", "'d' description", "concat('u', id) url", "'i' image", "date'2024-01-01' date"
    )
    a = [r["url"] for r in records.search_hits("k", rows, shuffle_seed=1).collect()]
    b = [r["url"] for r in records.search_hits("k", rows, shuffle_seed=2).collect()]
    assert a != b and sorted(a) == sorted(b)


def test_descriptions(spark):
    by_key = spark.createDataFrame([("ab", "map", 1), ("zz", "only", 2)], "key string, text string, seq int")
    listed = spark.createDataFrame(
        [("", "AB", "late", 2), (None, "AB", "early", 1), ("cd", None, "", 3)],
        "ticker string, symbol string, description string, seq int",
    )
    sources = [
        records.descriptions_from_map(by_key, "key", "text", 1),
        records.descriptions_from_records(listed, 2, ["ticker", "symbol"], ["description"]),
    ]
    masters = spark.createDataFrame(
        [("ab", "n", "NYSE", "own"), ("cd", "n", None, "own"), ("ef", "n", "x", None)],
        "ticker string, name string, exchange string, description string",
    )
    got = {r["ticker"]: (r["exchange"], r["description"]) for r in records.describe_companies(masters, *sources).collect()}
    assert got == {"AB": ("NYSE", "late"), "CD": ("", "own"), "EF": ("x", "")}
    assert {r["ticker"] for r in records.describe_companies(None, *sources).collect()} == {"AB", "ZZ"}


def test_fallback_ticker(spark):
    df = spark.createDataFrame([({"name": "x", "ABC": "y"},), ({"name": "x"},)], "m map<string, string>")
    assert [r[0] for r in df.select(records.fallback_ticker(F.col("m"))).collect()] == ["ABC", None]


def test_filings(spark):
    rows = spark.range(40).selectExpr("id % 2 as company", "id as filing_id", "date_add(date'2024-01-01', int(id)) filed")
    kept = records.first_filings(rows, "company", "filed", "filing_id", 3)
    assert sorted(r["filing_id"] for r in kept.collect()) == [34, 35, 36, 37, 38, 39]
    both = records.concat_filings(spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(1, 3)], "a int, c int"))
    assert both.columns == ["a", "b", "c"] and both.count() == 2


def test_reviews_and_labelled_tree(spark, path):
    write(f"{path}/csv", "r.csv", 'text,stars,type,cool,useful,funny\n"two\nlines, ""quoted""",5,review,1,2,3\n')
    assert records.read_reviews(spark, f"{path}/csv").first()["text"] == 'two\nlines, "quoted"'
    write(f"{path}/tree/pos", "1.txt", "good\nfilm")
    write(f"{path}/tree/neg", "2.txt", "bad")
    got = {tuple(r) for r in records.read_labelled_documents(spark, f"{path}/tree").collect()}
    assert got == {("pos", "pos/1.txt", "good\nfilm"), ("neg", "neg/2.txt", "bad")}


RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>Daily</title>
<item><title>One</title><link>http://a/1</link><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate><dc:creator>Ann</dc:creator>
<description>short</description><content:encoded><![CDATA[<p>long text</p>]]></content:encoded></item>
<item><title>Two</title><link>http://a/2</link><pubDate>Mon, 01 Jan 2024 11:00:00 GMT</pubDate><description>only this</description></item>
</channel></rss>"""
ATOM = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Weekly</title>
<entry><title>Three</title><link rel="self" href="http://b/self"/><link rel="alternate" href="http://b/3"/><updated>2024-01-02T10:00:00Z</updated>
<author><name>Bob</name></author><summary>brief</summary></entry>
<entry><title>Four</title><link href="http://b/4"/><updated>2024-01-02T11:00:00Z</updated><content type="html">words</content></entry>
</feed>"""


@pytest.mark.parametrize("read, text, want", [
    (articles.read_rss, RSS, {"http://a/1": ("One", "Ann", "Daily", "long text"), "http://a/2": ("Two", None, "Daily", "only this")}),
    (articles.read_atom, ATOM, {"http://b/3": ("Three", "Bob", "Weekly", "brief"), "http://b/4": ("Four", None, "Weekly", "words")}),
])
def test_plain_feed_files(spark, path, read, text, want):
    spark.sparkContext._jvm.java.io.File(path).mkdirs()
    with open(f"{path}/feed.xml", "w") as out:
        out.write(text)
    rows = articles.feed_articles(read(spark, path)).collect()
    assert {r["url"]: (r["title"], r["author"], r["publisher"], r["content"]) for r in rows} == want
    assert all(r["published_at"] is not None and r["seq"] is not None for r in rows)


def test_a_broken_item_costs_only_itself(spark, path):
    """A bare ampersand and an unknown name are mended; crossed tags and an item without an end are named."""
    item = "<item><title>{}</title><link>http://a/{}</link><description>{}</description></item>"
    items = [item.format("A & B", 1, "x &nbsp; y &amp; z"), item.format("<b>crossed</i>", 2, "x"), item.format("Three", 3, "<![CDATA[<p>a & b</p>]]>"), "<item><title>open</title>", item.format("Five", 5, "fine"), "<item><title>cut"]
    for part, text in (("rss", RSS.replace("</channel>", "".join(items) + "</channel>")), ("other", RSS)):
        write(f"{path}/{part}", "f.xml", text)
    rows = {r["link"]: r for r in articles.read_rss(spark, f"{path}/rss").collect()}
    assert set(rows) == {"http://a/1", "http://a/2", "http://a/3", "http://a/5"} and rows["http://a/2"]["title"] == "Two"
    bad = articles.broken_items(articles.rss_items(spark, f"{path}/rss")).orderBy("place").collect()
    assert [(r["place"], r["reason"]) for r in bad] == [(3, "broken markup"), (5, "not closed"), (7, "broken markup")] or [(r["place"], r["reason"]) for r in bad] == [(3, "broken markup"), (5, "not closed"), (7, "not closed")]
    assert rows["http://a/3"]["summary"] == "<p>a & b</p>"
    assert articles.broken_items(articles.rss_items(spark, f"{path}/other")).count() == 0


def test_history_keeps_its_order(spark, path):
    lines = "Date,Article_title,Stock_symbol,Url,Publisher,Author\n" + "".join(f"2024-01-01,t{i},A,u{i % 3},p,a\n" for i in range(9))
    write(path, "h.csv", lines)
    rows = articles.historical_news(articles.read_history(spark, path))
    assert {r["url"]: r["title"] for r in first_per_key(rows, ["url"], "seq").collect()} == {"u0": "t0", "u1": "t1", "u2": "t2"}
