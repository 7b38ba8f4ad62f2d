"""Stores, companies, links, integrity, joins."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import commits, companies, integrity, joins, keyindex, news, store as store_module
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.numbering import dense_numbers
from ledgerloom.operators.store import BatchStore
from ledgerloom.plans.views import seed_exchanges
from ledgerloom.schemas import LONG, STRING, _struct
from ledgerloom.session import fresh_dir

KV = _struct(k=STRING, v=STRING, seq=LONG)


def kv(spark, rows):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], KV)


def test_insert_is_idempotent(spark, path):
    store = BatchStore(spark, path, KV, ["k"])
    rows = kv(spark, [("a", "first"), ("b", "x"), ("a", "second")])
    assert store.insert(rows, "0", seq="seq", dry_run=True) == 2
    assert store.read().count() == 0
    assert store.insert(rows, "0", seq="seq") == 2
    assert store.insert(rows, "0", seq="seq") == 2  # the same batch replaces itself
    assert store.insert(rows, "1", seq="seq") == 0
    assert store.insert(kv(spark, [("c", "y"), ("a", "z")]), "2", seq="seq") == 1
    assert {(r["k"], r["v"]) for r in store.read().collect()} == {("a", "first"), ("b", "x"), ("c", "y")}
    assert not store.seed_if_empty(rows)
    store.truncate_and_load(kv(spark, [("n", "n")]), "new")
    assert [r["k"] for r in store.read().collect()] == ["n"]


def test_rows_without_or_with_equal_seq(spark, path):
    store = BatchStore(spark, path, KV, ["k"])
    rows = spark.createDataFrame([("a", "x", None), ("b", "y", None), ("a", "x", 5), ("a", "z", 5), ("c", "w", 5)], KV)
    assert store.insert(rows, "0", seq="seq") == 3
    assert store.insert(rows.unionByName(kv(spark, [("d", "v")])), "1", seq="seq") == 1
    assert sorted(r["k"] for r in store.read().collect()) == ["a", "b", "c", "d"]
    assert {r["seq"] for r in store.read().filter("k = 'a'").collect()} == {5}
    got = first_per_key(rows, ["k"], "seq").collect()
    assert {(r["k"], r["v"]) for r in got if r["k"] != "a"} == {("b", "y"), ("c", "w")}


def test_failed_load_keeps_the_table(spark, path):
    store = BatchStore(spark, path, KV, ["k"])
    store.insert(kv(spark, [("a", "x")]), "0")
    with pytest.raises(Exception):  # noqa: B017
        store.truncate_and_load(kv(spark, [("b", "y")]).withColumn("v", F.raise_error(F.lit("no"))), "bad")
    store.truncate_and_load(kv(spark, [("c", "y"), ("c", "z")]), "good")
    assert [r["k"] for r in store.read().collect()] == ["c"]


def test_seed_only_when_empty(spark, path):
    store = BatchStore(spark, path, KV, ["k"])
    assert store.seed_if_empty(kv(spark, [("a", "x")]))
    assert not store.seed_if_empty(kv(spark, [("b", "x")]))
    assert store.read().count() == 1


@settings(max_examples=4, deadline=None)
@given(st.lists(st.sampled_from("abcde"), min_size=1, max_size=12), st.integers(1, 11))
def test_batch_split_does_not_matter(spark, keys, cut):
    rows = [(k, str(i)) for i, k in enumerate(keys)]
    whole, parts = (BatchStore(spark, fresh_dir(spark, "split"), KV, ["k"]) for _ in range(2))
    whole.insert(kv(spark, rows), "0", seq="seq")
    frame = kv(spark, rows)
    parts.insert(frame.filter(F.col("seq") < cut), "0", seq="seq")
    parts.insert(frame.filter(F.col("seq") >= cut), "1", seq="seq")
    assert set(whole.read().drop("batch_id").collect()) == set(parts.read().drop("batch_id").collect())


def test_first_per_key(spark):
    got = first_per_key(kv(spark, [("a", None), ("a", "x"), ("b", "y")]), ["k"], "seq").collect()
    assert {tuple(r) for r in got} == {("a", None, 0), ("b", "y", 2)}


def test_links(spark):
    stored = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, id long")
    rows = spark.createDataFrame(
        [("u1", ["A", "B"]), ("u1", ["A"]), ("u2", []), ("u9", ["C"])], "url string, mentioned_tickers array<string>"
    )
    links = news.resolve_links(rows, stored)
    assert sorted(map(tuple, links.collect())) == [(1, "A"), (1, "B")]
    old = spark.createDataFrame([(1, "A")], "article_id long, ticker string")
    assert [tuple(r) for r in news.new_links(links, old).collect()] == [(1, "B")]
    assert news.tickers_of_articles(links).first()["tickers"] == ["A", "B"]
    assert news.id_by_url(stored, "u2") == 2 and news.id_by_url(stored, "u7") is None
    assert [tuple(r) for r in news.ids_by_url(stored, rows).orderBy("id").collect()] == [("u1", 1), ("u2", 2)]


def profile(**kw):
    return tuple(kw.get(f.name) for f in schemas.PROFILE.fields)


def test_company_load(spark):
    rows = [
        profile(symbol="A", exchange="NYQ", longName="", shortName="short", city="Paris", state="", marketCap=5),
        profile(symbol="A", exchange="NYQ", longName="again"),
        profile(symbol=None, exchange="NYQ"),
        profile(symbol="", exchange="LSE"),
        profile(symbol="B", exchange="LSE"),
        profile(symbol="B", exchange=None),
        profile(symbol="C", exchange="NMS", longName="x" * 300),
        profile(symbol="D" * 25, exchange="NGM"),
        profile(symbol="D" * 21, exchange="NCM"),
        profile(symbol="S", exchange="NYQ"),
    ]
    shape = _struct(**{f.name: f.dataType for f in schemas.PROFILE.fields}, seq=LONG)
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], shape)
    stored = spark.createDataFrame([("S", "NYSE")], "ticker string, exchange_code string")
    exchanges = seed_exchanges(spark)
    got = {r["ticker"]: r for r in companies.load_companies(frame, exchanges, stored).collect()}
    assert set(got) == {"A", "C", "D" * 20}
    a = got["A"]
    assert (a["name"], a["exchange_code"], a["headquarters"], a["market_cap"], a["is_active"]) == (
        "short", "NYSE", "Paris", 5, True)
    assert len(got["C"]["name"]) == 255 and got["C"]["headquarters"] is None and got["D" * 20]["name"] == ""
    audit = {r["status"]: r["n"] for r in companies.load_audit(frame, exchanges, stored).collect()}
    assert audit == {"insert": 3, "no symbol": 2, "no exchange": 2, "duplicate": 3}
    by_status = companies.classify(frame, exchanges, stored).groupBy("status").count()
    assert {r["status"]: r["count"] for r in by_status.collect()} == audit
    no_exchange = {r["status"]: r["n"] for r in companies.load_audit(frame, exchanges.limit(0), stored).collect()}
    assert no_exchange == {"insert": 0, "no symbol": 2, "no exchange": 8, "duplicate": 0}


def test_integrity(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([(1, "aa"), (3, "b"), (3, "c"), (None, "dddd")], "pid int, name string")
    assert [tuple(r) for r in integrity.fk_violations(children, "pid", parents, "id", "r").collect()] == [("r", "3", 2)]
    assert [r["n"] for r in integrity.unique_violations(children, "t", ["pid"]).collect()] == [2]
    nulls = {r["column_name"]: r["n_null"] for r in integrity.null_violations(children, "t", ["pid", "name"]).collect()}
    assert nulls == {"pid": 1, "name": 0}
    assert [r["length"] for r in integrity.length_violations(children, "t", {"name": 1}, "name").orderBy("key").collect()] == [2, 4]
    left = integrity.cascade_delete(children, "pid", spark.createDataFrame([(3,)], "id int"), "id")
    assert left.count() == 2
    with pytest.raises(ValueError):
        integrity.restrict_delete(parents, parents.filter("id = 1"), "id", children, "pid")
    assert integrity.restrict_delete(parents, parents.filter("id = 2"), "id", children, "pid").count() == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_plain_join(spark, how):
    left = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 400) end as k")
    right = spark.range(300).selectExpr("concat('k', id) as k", "id as x").union(spark.createDataFrame([("hot", -1)], "k string, x long"))
    hot = joins.hot_keys(left, "k")
    assert "hot" in {r["k"] for r in hot.collect()}
    salted = joins.salted_join(left, right, "k", "id", hot, how)
    plain = left.join(right, "k", how)
    assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    small = joins.lookup_join(left, right, "k", "id", how, max_rows=5)
    assert small.count() == plain.count()
    assert "BroadcastHashJoin" in joins.lookup_join(left, right, "k", "id", how)._jdf.queryExecution().toString()


def test_two_writers_lose_and_repeat_nothing(spark, path):
    """The second of two writers that started from one version compares again, and ids stay unique."""
    rows = [kv(spark, [(f"k{i}", str(w)) for i in range(w * 5, w * 5 + 10)]) for w in range(4)]
    BatchStore(spark, path, KV, ["k"], id="id")
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda w: BatchStore(spark, path, KV, ["k"], id="id").insert(rows[w], f"w{w}", seq="seq"), range(4)))
    stored = BatchStore(spark, path, KV, ["k"], id="id").read().collect()
    assert sum(counts) == 25 and {r["k"] for r in stored} == {f"k{i}" for i in range(25)} and len(stored) == 25
    assert sorted(r["id"] for r in stored) == list(range(1, 26))


def test_a_lost_race_is_run_again(spark, path):
    """Another writer commits between this one's comparison and its commit."""
    store, other = (BatchStore(spark, path, KV, ["k"], id="id") for _ in range(2))
    commit = store._commit

    def late(*args):
        other.insert(kv(spark, [("a", "other")]), "other") if not other.batches() else None
        return commit(*args)

    store._commit = late
    assert store.insert(kv(spark, [("a", "mine"), ("b", "mine")]), "mine", seq="seq") == 1
    assert {(r["id"], r["k"], r["v"]) for r in store.read().collect()} == {(1, "a", "other"), (2, "b", "mine")}


def test_a_reader_keeps_its_version(spark, path):
    store = BatchStore(spark, path, KV, ["k"])
    store.insert(kv(spark, [("a", "x")]), "0")
    before, version = store.read(), max(store.versions())
    store.truncate_and_load(kv(spark, [("b", "y")]), "1")
    assert [r["k"] for r in before.collect()] == ["a"] and [r["k"] for r in store.read().collect()] == ["b"]
    assert [r["k"] for r in store.read(version).collect()] == ["a"]
    assert store.vacuum(0) == 0  # all versions are still known
    commits.KEPT, kept = 1, commits.KEPT
    try:
        store.insert(kv(spark, [("c", "z")]), "2")
    finally:
        commits.KEPT = kept
    assert store.vacuum(0) == 2 and sorted(r["k"] for r in store.read().collect()) == ["b", "c"]


def test_indexes_are_merged(spark, path, monkeypatch):
    monkeypatch.setattr(store_module, "INDEXES", 2)
    store = BatchStore(spark, path, KV, ["k"], id="id")
    for n in range(4):
        assert store.insert(kv(spark, [(f"a{n}", ""), (f"b{n}", ""), ("a0", "")]), str(n), seq="seq") == 2
    assert len(store._log.read()[1]["index"]) <= 2
    assert {r["k"]: r["id"] for r in store.known(kv(spark, [("a0", ""), ("b3", ""), ("zz", "")])).collect()} == {"a0": 1, "b3": 8}


def test_a_small_batch_opens_few_buckets(spark, path, monkeypatch):
    """The share of the index that is opened grows with the batch, not with the table."""
    monkeypatch.setattr(keyindex, "BUCKET_ROWS", 100)
    store = BatchStore(spark, path, _struct(k=STRING), ["k"])
    store.insert(spark.range(10_000).select(F.concat(F.lit("k"), "id").alias("k")), "0")
    (entry,) = store._log.read()[1]["index"]
    assert entry["buckets"] == 100
    opened = lambda low, high: keyindex.opened(spark.range(low, high).select(F.concat(F.lit("k"), "id").alias("k")), ["k"], f"{path}/index", [entry])
    assert len(opened(20_000, 20_050)) <= 5  # new keys
    assert 1 <= len(opened(0, 3)) <= 3
    assert 60 <= len(opened(0, 500)) <= 100


def test_a_large_batch_is_indexed_when_a_small_one_asks(spark, path, monkeypatch):
    monkeypatch.setattr(store_module, "AT_ONCE", 100)
    monkeypatch.setattr(keyindex, "BUCKET_ROWS", 500)
    store = BatchStore(spark, path, _struct(k=STRING), ["k"])
    keys = lambda low, high: spark.range(low, high).select(F.concat(F.lit("k"), "id").alias("k"))
    assert store.insert(keys(0, 2000), "0") == 2000 and store.insert(keys(1000, 6000), "1") == 4000
    assert store.insert(keys(0, 0), "none") == 0 and store.known(keys(0, 0)).count() == 0
    assert not os.path.exists(f"{path}/index")  # neither batch was followed by a small one
    assert store.insert(keys(1990, 2010), "2") == 0 and store.insert(keys(5990, 6010), "3") == 10
    assert sorted(r["k"] for r in store.known(keys(5999, 6012)).collect()) == sorted(f"k{i}" for i in range(5999, 6010))
    assert store.read().distinct().count() == store.read().count() == 6010 == sum(store.batches().values())
    assert all(len(os.listdir(f"{path}/index/{f}")) == 1 for f in os.listdir(f"{path}/index"))  # written once


def test_a_table_of_before_is_indexed_anew(spark, path):
    store = BatchStore(spark, path, KV, ["k"], id="id")
    store.insert(kv(spark, [("a", "x"), ("b", "x")]), "0", seq="seq")
    version, state = store._log.read()
    state["index"] = [{k: v for k, v in e.items() if k != "of"} for e in state["index"]]
    assert store._log.commit(version + 1, state)
    assert store.insert(kv(spark, [("b", "y"), ("c", "y")]), "1", seq="seq") == 1
    assert {r["k"]: r["id"] for r in store.known(kv(spark, [("a", ""), ("c", "")])).collect()} == {"a": 1, "c": 3}


def test_merging_writes_a_key_a_few_times():
    index, written = [], 0
    for n in range(1, 1001):
        index.append(keyindex.part_of_index(str(n), [str(n)], 10))
        if len(index) > store_module.INDEXES:
            before = {e["folder"] for e in index}
            index = store_module.merged(index)
            written += sum(e["rows"] for e in index if e["folder"] not in before)
        assert len(index) <= store_module.INDEXES and sum(e["rows"] for e in index) == 10 * n
    assert sorted(int(f) for e in index for f in e["of"]) == list(range(1, 1001))
    assert written <= 10_000 * 10  # 62 merges of everything wrote 313,100 rows


def test_dense_numbers(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    got = dense_numbers(rows, "n", "x", first=5).collect()
    assert sorted((r["x"], r["n"]) for r in got) == [(k, k + 5) for k in range(1000)]
    assert dense_numbers(rows.limit(0), "n", "x").collect() == []
