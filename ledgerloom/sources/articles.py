"""Sources of news articles, all on one row shape."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom import schemas
from ledgerloom.functions.dates import feed_date, history_date
from ledgerloom.functions.text import or_null, strip_html
from ledgerloom.operators.dedup import first_per_key

# The names stored as the source of an article.
FEED_SOURCE = "rss"
HISTORY_SOURCE = "huggingface_fnspid"


def tag_source(rows: DataFrame, source: str) -> DataFrame:
    """Name the source of the rows that do not name one."""
    present = F.col("source") if "source" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("source", F.coalesce(present, F.lit(source)))


def conform(rows: DataFrame) -> DataFrame:
    """Bring rows onto the article shape; columns they lack become null."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.ARTICLE_ROW.fields
        ]
    )


PLACES = 31  # bits of an item's place in its file


def arrival_number(position: Column) -> Column:
    """When a row's file was landed (seconds), then its place in the file, of which a text has fewer than 2^31."""
    return F.shiftleft(F.unix_seconds(F.col("landed")), PLACES) + position


def read_feeds(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Landed feed items on the engine's own layout.

    Every field is read as text, so none can fail to parse; an item without a link
    stays, and ``feed_articles`` leaves it out.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("mode", "PERMISSIVE")
        .option("ignoreSurroundingSpaces", "false")
        .schema(_TEXT_ITEM)
        .load(path)
        .withColumn("seq", F.trim("seq").try_cast("long"))
    )


_TEXT_ITEM = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "seq" else f.dataType) for f in schemas.FEED_ITEM.fields]
)


# a bare ampersand, or a name XML does not know, outside CDATA
_LOOSE = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9A-Fa-f]+);)(?!(?:(?!<!\[CDATA\[)[\s\S])*\]\]>)"


def _feed_pieces(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(feed_url, landed, head, place, xml): the items of landed feed files as texts; a file is one row until they are taken apart.

    An item that is not closed ends where the next one starts, or the file.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("feed_url"), F.col("_metadata.file_modification_time").alias("landed"), "value"
    )
    head = F.regexp_extract("value", rf"(?s)^(.*?)(?:<{tag}[\s>]|\z)", 1)
    items = F.regexp_extract_all("value", F.lit(rf"(?s)<{tag}(?=[\s>]).*?(?:</{tag}\s*>|(?=<{tag}[\s>])|\z)"), 0)
    return files.withColumn("head", head).select("feed_url", "landed", "head", F.posexplode(items).alias("place", "xml"))


def _parse_items(pieces: DataFrame, tag: str, schema: T.StructType) -> DataFrame:
    """``pieces`` with ``item``, null if it cannot be parsed; items with loose ampersands are mended and tried again."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"rowTag": tag, "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    good = lambda c: F.col(c).isNotNull() & F.col(c)["_corrupt"].isNull()
    rows = pieces.withColumn("_one", F.from_xml("xml", marked, options))
    mended = F.when(~good("_one"), F.regexp_replace("xml", _LOOSE, "&amp;"))
    rows = rows.withColumn("_two", F.from_xml(mended, marked, options))
    return rows.withColumn("item", F.when(good("_one"), F.col("_one")).when(good("_two"), F.col("_two"))).drop("_one", "_two")


def _title(head: Column) -> Column:
    """The feed's own title, from what stands before its items."""
    raw = F.regexp_extract(head, r"(?s)<title[^>]*>\s*(.*?)\s*</title\s*>", 1)
    plain = F.regexp_replace(raw, r"(?s)^<!\[CDATA\[(.*)\]\]>$", "$1")
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(name), F.lit(sign))
    return F.when(plain != "", plain)


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """Every item of landed RSS 2.0 files, parsed or not (``item`` null, its text in ``xml``)."""
    return _parse_items(_feed_pieces(spark, path, "item"), "item", schemas.RSS_ITEM)


def atom_entries(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of landed Atom files, parsed or not (``item`` null, its text in ``xml``)."""
    return _parse_items(_feed_pieces(spark, path, "entry"), "entry", schemas.ATOM_ENTRY)


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """Landed RSS 2.0 files as feed items; a broken item costs itself alone and is in ``broken_items``."""
    return rss_items(spark, path).filter("item IS NOT NULL").select(
        F.trim("item.link").alias("link"),
        F.col("item.title").alias("title"),
        F.coalesce("item.creator", "item.author").alias("author"),
        F.coalesce("item.pubDate", "item.date").alias("published"),
        F.when(F.col("item.encoded").isNotNull(), F.array(F.struct(F.col("item.encoded").alias("value")))).alias("content"),
        F.col("item.description").alias("summary"),
        _title(F.col("head")).alias("feed_title"),
        "feed_url",
        arrival_number(F.col("place")).alias("seq"),
    )


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """Landed Atom files as feed items; the link is the alternate one, or the first. Broken entries are in ``broken_items``."""
    own = F.filter("item.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(own, F.lit(0)), F.get("item.link", F.lit(0)))["_href"]
    return atom_entries(spark, path).filter("item IS NOT NULL").select(
        link.alias("link"),
        F.col("item.title").alias("title"),
        F.col("item.author.name").alias("author"),
        F.coalesce("item.published", "item.updated").alias("published"),
        F.when(F.col("item.content").isNotNull(), F.array(F.struct(F.col("item.content").alias("value")))).alias("content"),
        F.col("item.summary").alias("summary"),
        _title(F.col("head")).alias("feed_title"),
        "feed_url",
        arrival_number(F.col("place")).alias("seq"),
    )


def broken_items(items: DataFrame) -> DataFrame:
    """(feed_url, place, reason, xml) of the items or entries that could not be read."""
    reason = F.when(F.col("xml").rlike(r"</(?:item|entry)\s*>$"), "broken markup").otherwise("not closed")
    return items.filter("item IS NULL").select("feed_url", "place", reason.alias("reason"), "xml")


def feed_articles(items: DataFrame) -> DataFrame:
    """Feed items to articles: linked items only, the first of each link."""
    raw = F.coalesce(
        F.when(F.size("content") > 0, F.get("content", F.lit(0))["value"]),
        F.when(F.coalesce(F.size("content"), F.lit(0)) <= 0, or_null("summary")),
    )
    linked = items.filter(or_null("link").isNotNull()).select(
        F.col("link").alias("url"),
        "title",
        "author",
        F.coalesce("feed_title", "feed_url").alias("publisher"),
        raw.alias("raw"),
        "published",
        "seq",
    )
    # Repeats go before the markup is parsed, so each text is parsed once.
    kept = first_per_key(linked, ["url"], "seq")
    parsed = kept.withColumn("content", strip_html("raw")).withColumn(
        "published_at", feed_date(F.col("published"))
    )
    return conform(tag_source(parsed, FEED_SOURCE).withColumn("mentioned_tickers", F.array().cast("array<string>")))


def read_history(spark: SparkSession, path: str, file_format: str = "csv", multi_line: bool = False) -> DataFrame:
    """Landed historical news rows (CSV with header, or Parquet).

    ``multi_line`` for values with line breaks; a file is one task then.
    """
    reader = spark.read.schema(schemas.NEWS_HISTORY)
    if file_format == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line).option("escape", '"')
    # rows of a file in its order, files in the reader's
    return reader.format(file_format).load(path).withColumn("seq", F.monotonically_increasing_id())


def normalise_history(rows: DataFrame) -> DataFrame:
    """Historical rows to articles; the content is never known."""
    symbol = or_null("Stock_symbol")
    articles = rows.select(
        F.col("Url").alias("url"),
        F.col("Article_title").alias("title"),
        F.col("Author").alias("author"),
        F.col("Publisher").alias("publisher"),
        history_date(F.col("Date")).alias("published_at"),
        F.when(symbol.isNotNull(), F.array(symbol)).otherwise(F.array().cast("array<string>")).alias(
            "mentioned_tickers"
        ),
        *(["seq"] if "seq" in rows.columns else []),
    )
    return conform(tag_source(articles, HISTORY_SOURCE))


def keep_history(tickers: list[str] | None, start: str | None, end: str | None) -> Column:
    """Rows with a url that pass the ticker and day filters.

    Both days are inclusive; a row without a date passes the day filter.
    """
    keep = or_null("url").isNotNull()
    if tickers:
        keep = keep & F.arrays_overlap("mentioned_tickers", F.array(*[F.lit(t) for t in tickers]))
    day = F.to_date("published_at")
    if start:
        keep = keep & (day.isNull() | (day >= F.lit(start).cast("date")))
    if end:
        keep = keep & (day.isNull() | (day <= F.lit(end).cast("date")))
    return F.coalesce(keep, F.lit(False))


def historical_news(
    rows: DataFrame, tickers: list[str] | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    return normalise_history(rows).filter(keep_history(tickers, start, end))


def scan_counters(
    rows: DataFrame, tickers: list[str] | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """How many rows a scan kept and skipped."""
    status = F.when(keep_history(tickers, start, end), "kept").otherwise("skipped")
    return normalise_history(rows).groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows into storable ones and ones that break a NOT NULL rule."""
    reason = F.when(or_null("url").isNull(), "no url").when(F.col("published_at").isNull(), "no date")
    marked = rows.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


class SourceRegistry:
    """Article sources by id: each one is a function from a session to rows."""

    def __init__(self) -> None:
        self._sources: dict[str, Callable[[SparkSession], DataFrame]] = {}

    def add(self, source_id: str, extract: Callable[[SparkSession], DataFrame]) -> "SourceRegistry":
        self._sources[source_id] = extract
        return self

    def extract(self, spark: SparkSession, *source_ids: str) -> DataFrame:
        """The rows of the named sources (all by default), tagged and united."""
        chosen = source_ids or tuple(self._sources)
        unknown = [s for s in chosen if s not in self._sources]
        if unknown:
            raise KeyError(f"unknown source: {', '.join(unknown)}")
        frames = [conform(tag_source(self._sources[s](spark), s)) for s in chosen]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out
