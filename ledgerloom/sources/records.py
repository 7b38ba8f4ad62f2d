"""JSON sources: profiles, search payloads, descriptions, filings, reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom import schemas
from ledgerloom.functions.dates import published_day
from ledgerloom.functions.text import first_non_empty, or_null, unnest
from ledgerloom.operators.dedup import last_value_per_key
from ledgerloom.sources.braces import parse_objects, scan_objects

HITS_PER_CALL = 20


def split_values(line: Column) -> Column:
    """Top-level JSON values written back to back, one array element each.

    A closing bracket directly followed by an opening one only occurs between
    top-level values. Splitting at quotes first (escaped ones are masked) leaves
    the text outside strings in the even pieces, so brackets inside strings are
    never taken for a boundary.
    """
    masked = F.replace(F.replace(line, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    pieces = F.transform(
        F.split(masked, '"', -1),
        lambda piece, i: F.when(i % 2 == 0, F.regexp_replace(piece, r"([}\]])\s*([{\[])", "$1\x1e$2")).otherwise(
            piece
        ),
    )
    joined = F.array_join(pieces, '"')
    unmasked = F.replace(F.replace(joined, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    return F.filter(F.split(unmasked, "\x1e", -1), lambda v: F.trim(v) != "")


def json_records(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """One row per record of concatenated JSON; arrays are flattened."""
    keep = [c for c in lines.columns if c != column]
    values = unnest(lines, keep, split_values(F.col(column)), "_value")
    return unnest(values, keep, F.from_json("_value", T.ArrayType(schema)), "_record").select(*keep, "_record.*")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Landed profile files in any JSON layout, in order of arrival (``seq``); what cannot be read is in ``broken_profiles``."""
    return parse_objects(scan_objects(spark, path), schemas.PROFILE).filter("record IS NOT NULL").select("record.*", "seq")


def broken_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(seq, reason, value) of landed profiles that could not be read, or not wholly."""
    return parse_objects(scan_objects(spark, path), schemas.PROFILE).filter("reason IS NOT NULL").select("seq", "reason", "value")


def _hits(payloads: DataFrame, articles: Column, source: str, url: Column, image: Column, ok: Column, date: str):
    rows = unnest(payloads, [], articles, "a")
    return rows.filter(ok).select(
        F.lit(source).alias("source"),
        F.col("a")["title"].alias("title"),
        F.col("a")["description"].alias("description"),
        url.alias("url"),
        image.alias("image"),
        published_day(F.col("a")[date]).alias("date"),
    )


def _has(*keys: str) -> Column:
    return reduce(lambda x, y: x & y, [F.map_contains_key("a", k) for k in keys])


def nested_hits(payloads: DataFrame, host: str, column: str = "payload") -> DataFrame:
    """Hits of a payload ``{result: {articles: [...]}}``; incomplete items are skipped."""
    body = F.from_json(column, "result struct<articles: array<map<string, string>>>")
    renditions = F.from_json(
        F.col("a")["thumbnail"], "renditions struct<original: map<string, string>>"
    )["renditions"]["original"]
    ok = (
        _has("title", "description", "canonical_url", "thumbnail", "published_time")
        & F.col("a")["canonical_url"].isNotNull()
        & F.coalesce(F.map_contains_key(renditions, "480w"), F.lit(False))
    )
    url = F.concat(F.lit(host), F.col("a")["canonical_url"])
    return _hits(payloads, body["result"]["articles"], host + "/", url, renditions["480w"], ok, "published_time")


def flat_hits(payloads: DataFrame, host: str, column: str = "payload") -> DataFrame:
    """Hits of a payload ``[{...}, ...]``; incomplete items are skipped."""
    body = F.from_json(column, "array<map<string, string>>")
    ok = _has("title", "description", "url", "dominantimage", "publishtime")
    return _hits(payloads, body, host + "/", F.col("a")["url"], F.col("a")["dominantimage"], ok, "publishtime")


def search_hits(keyword: str, *hits: DataFrame, shuffle_seed: int | None = None) -> DataFrame:
    """All hits of a keyword; with a seed, in an order that looks random."""
    rows = reduce(DataFrame.unionByName, hits).withColumn("keyword", F.lit(keyword))
    if shuffle_seed is None:
        return rows
    return rows.orderBy(F.xxhash64("url", "title", "date", F.lit(shuffle_seed)), "url")


def read_description_map(spark: SparkSession, path: str) -> DataFrame:
    """Landed objects ``{key: text}`` as rows (key, text, seq), later ones last; a value that is no text is left out."""
    objects = scan_objects(spark, path).select("seq", F.from_json("value", "map<string,string>").alias("m"))
    return objects.select("seq", F.posexplode("m").alias("at", "key", "text")).select("key", "text", F.struct("seq", "at").alias("seq"))


def read_description_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Landed objects with these fields, in any layout, as rows with ``seq``."""
    objects = scan_objects(spark, path).select("seq", F.from_json("value", "map<string,string>").alias("m"))
    return objects.select(*[F.try_element_at("m", F.lit(n)).alias(n) for n in names], F.struct("seq", F.lit(0).alias("at")).alias("seq"))


def descriptions_from_map(rows: DataFrame, key: str, text: str, priority: int) -> DataFrame:
    """Source shape ``{key: text}``."""
    return rows.select(
        F.upper(key).alias("ticker"),
        F.col(text).alias("description"),
        F.lit(priority).alias("priority"),
        "seq",
    ).filter(F.col("description").isNotNull())


def descriptions_from_records(
    rows: DataFrame, priority: int, keys: list[str], texts: list[str]
) -> DataFrame:
    """Source shape ``[{key, text}, ...]`` under alternative field names."""
    return rows.select(
        F.upper(first_non_empty(*[F.col(k).cast("string") for k in keys])).alias("ticker"),
        first_non_empty(*texts).alias("description"),
        F.lit(priority).alias("priority"),
        "seq",
    ).filter(F.col("ticker").isNotNull() & F.col("description").isNotNull())


def fallback_ticker(record: Column) -> Column:
    """The first key that looks like a ticker: upper case, five letters at most."""
    return F.get(F.filter(F.map_keys(record), lambda k: k.rlike("^[A-Z]{1,5}$")), F.lit(0))


def describe_companies(masters: DataFrame | None, *sources: DataFrame) -> DataFrame:
    """Companies with the text of the latest source, else their own text.

    Without a master list there is one row per described ticker.
    """
    merged = last_value_per_key(
        reduce(DataFrame.unionByName, sources), ["ticker"], "description", "priority", "seq"
    )
    if masters is None:
        return merged.select(
            "ticker",
            F.lit(None).cast("string").alias("name"),
            F.lit("").alias("exchange"),
            F.coalesce("description", F.lit("")).alias("description"),
        )
    found = merged.withColumnRenamed("description", "_found")
    return (
        masters.withColumn("ticker", F.upper("ticker"))
        .join(found, "ticker", "left")
        .select(
            "ticker",
            "name",
            F.coalesce("exchange", F.lit("")).alias("exchange"),
            F.coalesce(or_null("_found"), F.col("description"), F.lit("")).alias("description"),
        )
    )


def first_filings(filings: DataFrame, company: str, filed: str, filing_id: str, n: int = 10) -> DataFrame:
    """The latest ``n`` filings of each company.

    A ranking limit is applied in the map tasks already, so a company with very
    many filings sends ``n`` rows per task.
    """
    order = Window.partitionBy(company).orderBy(F.desc(filed), F.col(filing_id))
    return filings.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def concat_filings(*frames: DataFrame) -> DataFrame:
    """All rows of filings whose columns differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review CSV with header; texts may hold line breaks and quotes."""
    return spark.read.schema(schemas.REVIEW).csv(path, header=True, multiLine=True, escape='"')


def read_labelled_documents(spark: SparkSession, path: str) -> DataFrame:
    """A tree ``<label>/<file>`` of text files: the folder is the label."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return rows.select(
        F.element_at(parts, -2).alias("label"),
        F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("file_id"),
        F.col("value").alias("text"),
    )
