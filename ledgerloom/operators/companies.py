"""Profiles to companies: exchange lookup, duplicate rule, load audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import schemas
from ledgerloom.functions.text import join_non_empty, or_null, truncate
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.store import BatchStore

def exchange_code(source_code: Column) -> Column:
    """The warehouse code of a profile's exchange code, or null."""
    pairs = [F.lit(x) for pair in schemas.EXCHANGE_CODES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), source_code)


def classify(profiles: DataFrame, exchanges: DataFrame, stored: DataFrame, seq: str = "seq") -> DataFrame:
    """Profiles with ``ticker``, ``exchange_code`` and a load ``status``.

    Tested in this order: no symbol, no exchange, duplicate (of a stored row or
    of an earlier row of the load). The key is the truncated symbol. The winner
    of each key is found by an aggregate and joined back on ``seq``, which is
    unique, so a symbol with very many copies does not skew the join.
    """
    limit = schemas.COMPANIES.lengths["ticker"]
    known = F.broadcast(exchanges.select(F.col("code").alias("exchange_code"), F.lit(True).alias("_known")))
    rows = (
        profiles.withColumn("ticker", truncate(or_null("symbol"), limit))
        .withColumn("exchange_code", exchange_code(F.col("exchange")))
        # Few codes map (see EXCHANGE_CODES), so at most that many rows match here.
        .join(known.filter(F.col("exchange_code").isin(list(schemas.EXCHANGE_CODES.values()))), "exchange_code", "left")
    )
    valid = F.col("ticker").isNotNull() & F.col("_known")
    keys = ["ticker", "exchange_code"]
    winners = (
        rows.filter(valid)
        .groupBy(*keys)
        .agg(F.min(seq).alias(seq))
        .join(stored.select(*keys), keys, "left_anti")
        .select(seq, F.lit(True).alias("_wins"))
    )
    status = (
        F.when(F.col("ticker").isNull(), "no symbol")
        .when(F.col("_known").isNull(), "no exchange")
        .when(F.col("_wins").isNull(), "duplicate")
        .otherwise("insert")
    )
    return rows.join(winners, seq, "left").withColumn("status", status).drop("_known", "_wins")


def to_company(rows: DataFrame) -> DataFrame:
    """Project classified profiles onto the company table."""
    n = schemas.COMPANIES.lengths
    have = set(rows.columns)
    made = {
        "name": truncate(F.coalesce(or_null("longName"), F.col("shortName"), F.lit("")), n["name"]),
        "ticker": F.col("ticker"),
        "exchange_code": F.col("exchange_code"),
        "country": truncate("country", n["country"]),
        "sector": truncate("sector", n["sector"]),
        "industry": truncate("industry", n["industry"]),
        "description": F.col("longBusinessSummary"),
        "website": truncate("website", n["website"]),
        "headquarters": truncate(join_non_empty(", ", "city", "state"), n["headquarters"]),
        "market_cap": F.col("marketCap"),
        "employees": F.col("fullTimeEmployees"),
        "is_active": F.lit(True),
        "created_at": F.current_timestamp(),
        "updated_at": F.current_timestamp(),
    }
    missing = F.lit(None)
    return rows.select(
        *[made.get(f.name, missing).cast(f.dataType).alias(f.name) for f in schemas.COMPANIES.schema.fields],
        *[c for c in ("seq",) if c in have],
    )


def load_companies(profiles: DataFrame, exchanges: DataFrame, stored: DataFrame, seq: str = "seq") -> DataFrame:
    """The company rows a load would add."""
    return to_company(classify(profiles, exchanges, stored, seq).filter(F.col("status") == "insert"))


def append_companies(profiles: DataFrame, exchanges: DataFrame, store: BatchStore, batch_id: str, seq: str = "seq", dry_run: bool = False) -> int:
    """Add the companies that are not stored yet; returns how many. A repeated batch adds nothing.

    The store looks its keys up by the load's own, so only valid rows are made into companies and no stored row is read.
    """
    codes = exchanges.select(F.col("code").alias("exchange_code"))
    rows = profiles.withColumn("ticker", truncate(or_null("symbol"), schemas.COMPANIES.lengths["ticker"])).withColumn("exchange_code", exchange_code(F.col("exchange")))
    known = F.broadcast(codes.filter(F.col("exchange_code").isin(list(schemas.EXCHANGE_CODES.values()))))
    valid = rows.filter(F.col("ticker").isNotNull()).join(known, "exchange_code", "left_semi")
    return store.insert(to_company(valid.withColumnRenamed(seq, "seq")), batch_id, seq="seq", dry_run=dry_run)


def load_audit(profiles: DataFrame, exchanges: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows per load status, the same for a dry run and a real one.

    Counted per key, so no row is joined back: of a new key's ``n`` rows one is
    inserted and the others are duplicates.
    """
    limit = schemas.COMPANIES.lengths["ticker"]
    codes = exchanges.select(F.col("code").alias("exchange_code"), F.lit(True).alias("_known"))
    keys = ["ticker", "exchange_code"]
    sizes = (
        profiles.select(
            truncate(or_null("symbol"), limit).alias("ticker"), exchange_code(F.col("exchange")).alias("exchange_code")
        )
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    seen = stored.select(*keys, F.lit(True).alias("_stored")).distinct()
    known = sizes.join(
        F.broadcast(codes.filter(F.col("exchange_code").isin(list(schemas.EXCHANGE_CODES.values())))),
        "exchange_code",
        "left",
    )
    counted = known.join(seen, keys, "left")
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    no_symbol = F.col("ticker").isNull()
    no_exchange = ~no_symbol & F.col("_known").isNull()
    added = ~no_symbol & ~no_exchange & F.col("_stored").isNull()
    parts = F.array(
        F.struct(F.lit("insert").alias("status"), F.when(added, F.lit(1)).otherwise(zero).alias("n")),
        F.struct(F.lit("no symbol").alias("status"), F.when(no_symbol, n).otherwise(zero).alias("n")),
        F.struct(F.lit("no exchange").alias("status"), F.when(no_exchange, n).otherwise(zero).alias("n")),
        F.struct(
            F.lit("duplicate").alias("status"),
            F.when(no_symbol | no_exchange, zero).when(added, n - 1).otherwise(n).alias("n"),
        ),
    )
    return counted.select(F.inline(parts)).groupBy("status").agg(F.sum("n").alias("n"))


def company_insiders(exchanges: DataFrame, companies: DataFrame, insiders: DataFrame) -> DataFrame:
    """Insiders with their company and its exchange.

    One exchange lists very many companies and one company may have very many
    insiders, so both lookups are balanced.
    """
    listed = lookup_join(companies, exchanges, "exchange_code", "id").select(
        F.col("id").alias("company_id"), F.col("name").alias("company"), "ticker", "exchange_code", "exchange"
    )
    return lookup_join(insiders, listed, "company_id", "name").select(
        "exchange_code",
        "exchange",
        "ticker",
        "company",
        F.col("name").alias("insider"),
        "role",
        "start_date",
        "end_date",
        F.col("end_date").isNull().alias("current"),
    )
