"""Ticker mentions in article texts by dictionary lookup."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.functions.text import full_text, unnest
from ledgerloom.operators.joins import BROADCAST_ROWS, is_bounded, lookup_join

_WORD_BREAK = r"[^\p{L}\p{N}]+"


CELLS = 1 << 14  # of the table of first words
FILTER = 1 << 20  # bits of the table of phrases
MANY_WORDS = 62  # a phrase of more words counts as one of so many in the table of first words


def alias_table(names: DataFrame, alias: str, ticker: str) -> DataFrame:
    """Aliases as ``(phrase, ticker)`` rows.

    A company name matches in any case, as whole words; a name shared by several
    companies has a row for each.
    """
    words = F.filter(F.split(F.lower(alias), _WORD_BREAK), lambda w: w != "")
    rows = names.select(F.array_join(words, " ").alias("phrase"), F.col(ticker).cast("string").alias("ticker"))
    return rows.filter("phrase != ''").distinct()


def _cell(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(CELLS - 1).cast("int")


def _spot(phrase: Column) -> tuple[Column, Column]:
    bit = F.xxhash64(phrase, F.lit(1)).bitwiseAND(FILTER - 1)
    return F.shiftright(bit, 6).cast("int"), bit.bitwiseAND(63).cast("int")


def _table(rows: DataFrame, size: int) -> Column:
    """Bits (cell, bits) or-ed into a literal array of ``size`` numbers."""
    values = [0] * size
    for row in rows.groupBy("cell").agg(F.bit_or("bits").alias("bits")).collect():
        values[row["cell"]] = row["bits"]
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), "array<bigint>")


class Matcher:
    """Two literal tables of fixed size that let few phrases of a text pass which are no alias.

    The first one has, for the hash of a word, how many words the aliases have that start with it; the second one has a bit for
    the hash of each alias. So a text gives phrases only where an alias starts, only of the lengths that alias has, and
    what passes both is nearly all a hit.
    """

    def __init__(self, aliases: DataFrame):
        words = F.split("phrase", " ")
        phrases = aliases.select("phrase", F.size(words).alias("n"), F.get(words, F.lit(0)).alias("head")).distinct()
        self.longest = phrases.agg(F.max("n")).first()[0] or 1
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.least("n", F.lit(MANY_WORDS)))
        self._starts = _table(phrases.select(_cell(F.col("head")).alias("cell"), mask.alias("bits")), CELLS)
        word, bit = _spot(F.col("phrase"))
        self._bits = _table(phrases.select(word.alias("cell"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits")), FILTER // 64)

    def phrases(self, rows: DataFrame, key: str, words: str) -> DataFrame:
        """(key, phrase): phrases of each text that may be aliases, each once per row."""
        w = F.col(words)
        tables = rows.select(key, w.alias("_w"), F.struct(self._starts.alias("starts"), self._bits.alias("bits")).alias("_t"))
        masks = F.transform("_w", lambda x, i: F.struct(i.alias("i"), F.get("_t.starts", _cell(x)).alias("mask")))
        places = tables.withColumn("_places", F.filter(masks, lambda p: p["mask"] != 0))

        def at(p: Column) -> Column:
            lengths = F.sequence(F.lit(1), F.least(F.size("_w") - p["i"], F.lit(self.longest)))
            bit = lambda n: F.call_function("shiftrightunsigned", p["mask"], F.least(n, F.lit(MANY_WORDS))).bitwiseAND(1)
            return F.transform(F.filter(lengths, lambda n: bit(n) == 1), lambda n: F.array_join(F.slice("_w", p["i"] + 1, n), " "))

        def passes(phrase: Column) -> Column:
            word, bit = _spot(phrase)
            return F.call_function("shiftrightunsigned", F.get("_t.bits", word), bit).bitwiseAND(1) == 1

        found = F.array_distinct(F.filter(F.flatten(F.transform("_places", at)), passes))
        return unnest(places, [key], found, "phrase")


class PhraseTree:
    """A bounded alias table as a tree of words, small enough to be broadcast: texts meet it where they are read.

    A node is a prefix of an alias; ``edges`` are sorted numbers (node, word), with the node each leads to. Tickers are numbered in
    their order, and those of a node are ``owners[starts[node]:starts[node + 1]]``.
    """

    def __init__(self, aliases: DataFrame):
        rows = [(r["phrase"].split(" "), r["ticker"]) for r in aliases.select("phrase", "ticker").distinct().collect()]
        self.tickers = sorted({t for _, t in rows})
        number = {t: k for k, t in enumerate(self.tickers)}
        self.words: dict[str, int] = {}
        steps: dict[tuple[int, int], int] = {}
        owners: list[list[int]] = [[]]
        for phrase, ticker in rows:
            node = 0
            for word in phrase:
                node = steps.setdefault((node, self.words.setdefault(word, len(self.words))), len(owners))
                if node == len(owners):
                    owners.append([])
            owners[node].append(number[ticker])
        size = max(len(self.words), 1)
        edges = np.array([a * size + w for a, w in steps], np.int64)
        order = np.argsort(edges)
        self.size, self.edges, self.targets = size, edges[order], np.array(list(steps.values()), np.int64)[order]
        self.counts = np.array([len(o) for o in owners], np.int64)
        self.starts = np.append(0, np.cumsum(self.counts))
        self.owners = np.array([t for o in owners for t in o], np.int64)

    def found(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(row, ticker number) of the aliases in rows of words, sorted, each once."""
        offsets = words.offsets.to_numpy().astype(np.int64)
        values = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        known = np.array([self.words.get(w, -1) for w in values.dictionary.to_pylist()], np.int64)
        codes = known[values.indices.to_numpy()] if len(known) else np.empty(0, np.int64)
        row = np.repeat(np.arange(len(words), dtype=np.int64), np.diff(offsets))
        last = (offsets[1:] - offsets[0])[row]  # behind the row's last word
        at = np.flatnonzero(codes >= 0)
        rows, node, hits = row[at], np.zeros(len(at), np.int64), []
        while len(at) and len(self.edges):
            edge = node * self.size + codes[at]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            on = self.edges[place] == edge
            at, rows, node = at[on], rows[on], self.targets[place[on]]
            whole = self.counts[node] > 0
            hits.append(np.unique(rows[whole] * len(self.counts) + node[whole]))
            at = at + 1
            on = at < last[at - 1]
            at, rows, node = at[on], rows[on], node[on]
            on = codes[at] >= 0
            at, rows, node = at[on], rows[on], node[on]
        rows, node = np.divmod(np.concatenate(hits) if hits else np.empty(0, np.int64), len(self.counts))
        many = self.counts[node]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owned = self.owners[np.repeat(self.starts[node], many) + inside]
        pairs = np.unique(np.repeat(rows, many) * max(len(self.tickers), 1) + owned)
        return np.divmod(pairs, max(len(self.tickers), 1))


def _lists(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(tree.value.tickers, pa.string())
        for batch in batches:
            rows, owned = tree.value.found(batch.column(1))
            offsets = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            tickers = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(pa.array(owned)))
            yield pa.RecordBatch.from_arrays([batch.column(0), tickers], names=[batch.schema.names[0], "tickers"])

    return run


def _words(articles: DataFrame, key: str, title: str, content: str) -> DataFrame:
    """(key, w): the words of the articles that have a text."""
    text = F.lower(full_text(title, content))
    return articles.filter(F.col(content).isNotNull()).select(key, F.filter(F.split(text, _WORD_BREAK), lambda w: w != "").alias("w"))


def ticker_lists(words: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """(key, tickers) of each row of ``_words``, sorted; no phrase and no pair leaves its row."""
    tree = words.sparkSession.sparkContext.broadcast(PhraseTree(aliases))
    schema = T.StructType([words.schema[key], T.StructField("tickers", T.ArrayType(T.StringType()))])
    return words.select(key, "w").mapInArrow(_lists(tree), schema)


def mentions(
    articles: DataFrame,
    aliases: DataFrame,
    key: str = "id",
    title: str = "title",
    content: str = "content",
) -> DataFrame:
    """Unique ``(key, ticker)`` pairs of articles that name a ticker's alias.

    An alias table whose checked size allows is broadcast as a tree of words and met where the texts are read. With a larger one,
    phrases that may be aliases leave a row once (``Matcher``) and are looked up exactly.
    """
    words = _words(articles, key, title, content)
    if is_bounded(aliases, BROADCAST_ROWS):
        return unnest(ticker_lists(words, aliases, key), [key], F.col("tickers"), "ticker").distinct()
    phrases = Matcher(aliases).phrases(words, key, "w")
    return lookup_join(phrases, aliases, "phrase", key).select(key, "ticker").distinct()


def tickers_of_texts(
    articles: DataFrame, aliases: DataFrame, key: str = "id", title: str = "title", content: str = "content"
) -> DataFrame:
    """``(key, mentioned_tickers)`` of all articles, sorted; none gives an empty array. One row per article is shuffled, not its pairs."""
    empty = F.array().cast("array<string>")
    if not is_bounded(aliases, BROADCAST_ROWS):
        return mentioned_tickers(articles.select(key), mentions(articles, aliases, key, title, content), key)
    lists = ticker_lists(_words(articles, key, title, content), aliases, key)
    none = articles.filter(F.col(content).isNull()).select(key, empty.alias("tickers"))
    every = lists.unionByName(none).groupBy(key).agg(F.flatten(F.collect_list("tickers")).alias("t"))
    return every.select(key, F.array_sort(F.array_distinct("t")).alias("mentioned_tickers"))


def mentioned_tickers(articles: DataFrame, pairs: DataFrame, key: str = "id") -> DataFrame:
    """Articles with their sorted tickers; none gives an empty array."""
    lists = pairs.groupBy(key).agg(F.array_sort(F.collect_set("ticker")).alias("mentioned_tickers"))
    empty = F.array().cast("array<string>")
    return articles.join(lists, key, "left").withColumn("mentioned_tickers", F.coalesce("mentioned_tickers", empty))
