"""The same results in SQL over the benchmark tables, for checking.

Written from the definition of each result rather than from the jobs: windows
instead of aggregates, self joins instead of block products, known dates instead
of parsed ones.
"""

from __future__ import annotations

from ledgerloom import schemas
from ledgerloom.functions.text import STOPWORDS
from ledgerloom.plans import queries as q, views
from ledgerloom.sources.records import HITS_PER_CALL


def _list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


STOP = _list(STOPWORDS)
SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
DAY = "strftime({}, '%Y-%m-%d')"
SECOND = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _second(expr: str) -> str:
    return SECOND.format(expr)


CHECKS: dict[str, str] = {}

# Lookups, dedup, ingestion ----------------------------------------------------

CHECKS["articles_by_ticker"] = f"""
SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS publisher, {_second('o_orderdate')} AS published_at
FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = '{q.BRAND}')
"""

CHECKS["article_tickers"] = """
SELECT l_orderkey AS article_id, string_agg(p_brand, ',' ORDER BY p_brand) AS tickers
FROM (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY l_orderkey
"""

CHECKS["ids_by_url"] = """
SELECT url, page_id AS id FROM pages WHERE url IN (SELECT regexp_replace(url, '[?#].*', '') FROM pages)
"""

CHECKS["dedup_articles"] = """
SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
"""

_DOC_ROWS = f"""
docs AS (
  SELECT '{views.DOC_HOST}' || md5(text) AS url, source, doc_id, upper(lang) AS ticker,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS published_at
  FROM documents)
"""

CHECKS["ingest_articles"] = f"""
WITH {_DOC_ROWS},
early AS (SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)
          QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1),
late AS (SELECT * FROM docs WHERE url NOT IN (SELECT url FROM early)
         QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1)
SELECT url, source, 'labelled' AS batch_id, {_second('published_at')} AS published_at FROM early
UNION ALL SELECT url, source, 'all', {_second('published_at')} FROM late
"""

CHECKS["stored_news"] = f"""
WITH {_DOC_ROWS}
SELECT url, min(doc_id) AS first_doc, string_agg(DISTINCT ticker, ',' ORDER BY ticker) AS tickers, true AS dense_ids, true AS fetched,
       min(doc_id) NOT IN (SELECT doc_id FROM labels WHERE quality = 1) AS untransformed
FROM docs GROUP BY url
"""

CHECKS["stored_by_ticker"] = f"""
WITH {_DOC_ROWS}, firsts AS (SELECT url, min(published_at) AS published_at FROM docs GROUP BY url)
SELECT DISTINCT url, {_second('firsts.published_at')} AS published_at FROM firsts JOIN docs USING (url) WHERE ticker = 'DE'
"""

CHECKS["stream_dedup"] = f"""
WITH {_DOC_ROWS} SELECT url, count(DISTINCT url) AS times, true AS bounded FROM docs GROUP BY url
"""

CHECKS["link_tickers"] = """
WITH done AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_linestatus = 'F'),
every AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
SELECT l_orderkey AS article_id, CAST(l_partkey AS VARCHAR) AS ticker, 'finished' AS batch_id FROM done
UNION ALL
SELECT l_orderkey, CAST(l_partkey AS VARCHAR), 'all' FROM (SELECT * FROM every EXCEPT SELECT * FROM done)
"""

CHECKS["untransformed"] = """
SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
"""

CHECKS["stream_ingest"] = f"""
WITH {_DOC_ROWS} SELECT DISTINCT url, ticker, 'first' AS stream, '0' AS batch FROM docs
"""

# Sources -----------------------------------------------------------------------

_HIDDEN = (
    r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<template\b[^>]*>.*?</template\s*>"
    r"|<!--.*?-->|<![a-z][^>]*>|<\?[^>]*>"
)
_TAG = r"""</?[A-Za-z][^>"'']*(?:"[^"]*"[^>"'']*|''[^'']*''[^>"'']*)*>"""
_GAP = r"[ \t\n\r\f\x{a0}]*"
_CONTENT = f"""
replace(replace(replace(replace(
  regexp_replace(
    regexp_replace(
      regexp_replace(regexp_replace(html, '{_HIDDEN}', '<x>', 'g'), '{_TAG}', '<x>', 'g'),
      '(?:{_GAP}<x>)+{_GAP}', ' ', 'g'),
    '^{_GAP}|{_GAP}$', '', 'g'),
  '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')
"""

CHECKS["feed_articles"] = f"""
SELECT url, 'page ' || page_id AS title, CASE WHEN url LIKE 'https%' THEN 'Feed One' ELSE 'feed-1' END AS publisher,
       'rss' AS source, {_CONTENT} AS content,
       CASE WHEN page_id % 4 < 3 THEN {_second("TIMESTAMP '2024-03-01 00:00:00' + to_minutes(page_id)")} END
         AS published_at
FROM pages
"""

CHECKS["rss_articles"] = f"""
SELECT url, CASE WHEN page_id % 7 = 3 THEN 'A & B ' ELSE 'page ' END || page_id AS title, 'Pages & more' AS publisher, 'rss' AS source,
       {_second("TIMESTAMP '2024-03-01 00:00:00' + to_minutes(page_id)")} AS published_at
FROM pages WHERE page_id % 11 <> 5
"""

CHECKS["broken_feed_items"] = "SELECT page_id, 'broken markup' AS reason FROM pages WHERE page_id % 11 = 5"

_HISTORY = """
history AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE 'order/' || o_orderkey END AS url,
         'Order "' || o_orderkey || '", news' AS title, o_orderstatus AS publisher, c_name AS author,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS symbol,
         CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
              ELSE o_orderdate + to_minutes(o_orderkey % 1440) END AS seen_at
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""
_KEEP = (
    f"(url IS NOT NULL AND coalesce(symbol IN ({_list(q.NEWS_TICKERS)}), false) AND "
    f"(seen_at IS NULL OR CAST(seen_at AS DATE) BETWEEN DATE '{q.NEWS_DAYS[0]}' AND DATE '{q.NEWS_DAYS[1]}'))"
)

CHECKS["historical_news"] = f"""
WITH {_HISTORY}
SELECT url, title, publisher, author, 'huggingface_fnspid' AS source, symbol AS tickers, {_second('seen_at')} AS published_at
FROM history WHERE {_KEEP}
"""

CHECKS["scan_counters"] = f"""
WITH {_HISTORY}
SELECT CASE WHEN {_KEEP} THEN 'kept' ELSE 'skipped' END AS status, count(*) AS n FROM history GROUP BY 1
"""

CHECKS["quarantined_news"] = f"""
WITH {_HISTORY}
SELECT title, CASE WHEN url IS NULL THEN 'no url' ELSE 'no date' END AS reason
FROM history WHERE url IS NULL OR seen_at IS NULL
"""

CHECKS["article_sources"] = f"""
WITH {_HISTORY}, {_DOC_ROWS}
SELECT url, 'rss' AS source FROM pages
UNION ALL SELECT url, 'huggingface_fnspid' FROM history WHERE url IS NOT NULL
UNION ALL SELECT url, 'documents' FROM docs
"""

CHECKS["search_hits"] = f"""
SELECT 'https://nested.example/' AS source, 'Document ' || doc_id AS title, md5(text) AS description_md5,
       'https://nested.example/d/' || doc_id AS url, 'img-' || doc_id AS image,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%d') AS date, 'anything' AS keyword
FROM documents WHERE lang = 'en'
UNION ALL
SELECT 'https://flat.example/', 'Page ' || page_id, md5(html), url, 'pic-' || page_id,
       strftime(TIMESTAMP '2024-03-01 00:00:00' + to_minutes(page_id), '%Y-%m-%d'), 'anything'
FROM pages WHERE url NOT LIKE '%#%'
"""

CHECKS["profile_records"] = f"""
SELECT p || c_custkey AS symbol, 'NYQ' AS exchange, c_name AS "longName",
       '{views.PROFILE_NOTE}' || ' ' || c_mktsegment AS "longBusinessSummary",
       CAST(floor(c_acctbal * 100) AS BIGINT) AS "marketCap"
FROM customer CROSS JOIN (VALUES ('A'), ('B')) AS v(p)
WHERE (p = 'A' OR c_mktsegment IN ('MACHINERY', 'BUILDING', 'FURNITURE')) AND NOT (c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0)
"""

CHECKS["broken_profiles"] = """
SELECT 'A' || c_custkey AS symbol, 'not a record' AS reason FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0
"""

CHECKS["append_companies"] = """
SELECT p || c_custkey AS ticker, 'NYSE' AS exchange_code, c_name AS name, CAST(floor(c_acctbal * 100) AS BIGINT) AS market_cap,
       true AS dense_ids, CAST(0 AS BIGINT) AS added_again
FROM customer CROSS JOIN (VALUES ('A'), ('B')) AS v(p)
WHERE (p = 'A' OR c_mktsegment IN ('MACHINERY', 'BUILDING', 'FURNITURE')) AND NOT (c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0)
"""

CHECKS["fallback_tickers"] = """
SELECT c_custkey, CASE WHEN length(c_mktsegment) >= 4 THEN left(c_mktsegment, 5) END AS ticker FROM customer
"""

CHECKS["reviews"] = """
SELECT doc_id, md5(text) AS text_md5, CAST(1 + 3 * quality + (1 - toxic) AS INTEGER) AS stars FROM documents JOIN labels USING (doc_id)
"""

CHECKS["labelled_documents"] = """
SELECT CASE WHEN item_id % 3 = 0 THEN 'pos' ELSE 'neg' END AS label, md5(text) AS text_md5 FROM benchmark
"""

CHECKS["seeded_exchanges"] = """
SELECT 'N' || n_nationkey AS code, n_name AS name, n_nationkey + 1 AS id, true AS seeded, false AS seeded_again FROM nation
"""

CHECKS["watchlist"] = """
SELECT 'P' || p_partkey AS "Ticker", p_name AS "Company", p_type AS "GICS_Sector", p_brand AS "GICS_Sub_Industry"
FROM part
"""

_COUNTRY = f"([{_list(views.COUNTRIES)}])"
CHECKS["symbol_universe"] = f"""
WITH every AS (
  SELECT replace(s_name, 'Supplier#', 'S/') AS symbol, s_name AS name, floor(s_acctbal * 10000) AS cap,
         {_COUNTRY}[s_nationkey + 1] AS country, '1999' AS ipoyear, 'Supply' AS industry, 'Trade' AS sector
  FROM supplier
  UNION ALL
  SELECT substr(c_mktsegment, 1, 3) || '/' || c_custkey, c_name,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal * 10000) END, {_COUNTRY}[c_nationkey + 1], NULL, 'Retail',
         c_mktsegment
  FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT replace(symbol, '/', '-') AS symbol, name, cap AS "marketCap", country, ipoyear, industry, sector
FROM every WHERE cap > {schemas.MIN_MARKET_CAP} AND country IN ({_list(schemas.ACCEPTED_COUNTRIES)})
"""

CHECKS["symbols_like"] = """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(small|old) (bolt|ring)')
"""

CHECKS["descriptions"] = """
WITH talk AS (SELECT conv_id, text FROM conversations WHERE text <> ''
              QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)
SELECT 'K' || page_id AS ticker, url AS name, regexp_extract(url, 'example\\.([a-z]+)', 1) AS exchange,
       md5(coalesce(nullif(talk.text, ''), CASE WHEN conv_id IS NULL THEN nullif(benchmark.text, '') END,
                    'own ' || url)) AS description_md5
FROM pages LEFT JOIN talk ON conv_id = page_id LEFT JOIN benchmark ON item_id = page_id
"""

CHECKS["exchange_filter"] = "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment ILIKE '%mach%'"
CHECKS["exchange_filter_fallback"] = "SELECT c_custkey, c_mktsegment FROM customer"

CHECKS["insider_filings"] = """
WITH filings AS (
  SELECT DISTINCT l_suppkey, l_orderkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
picked AS (
  SELECT * FROM filings
  QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY o_orderdate DESC, l_orderkey) <= 10)
SELECT l.l_suppkey AS company, l.l_orderkey AS filing_id, l_linenumber AS line, l_quantity AS shares,
       CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS price,
       CASE WHEN l_linestatus = 'O' THEN l_discount END AS discount
FROM lineitem l JOIN picked p ON l.l_suppkey = p.l_suppkey AND l.l_orderkey = p.l_orderkey
"""

# Companies ---------------------------------------------------------------------

CHECKS["exchanges"] = """
SELECT 'N' || n_nationkey AS code, n_name AS name, count(s_suppkey) AS n_companies
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey, n_name
"""

_PROFILES = """
profiles AS (
  SELECT *, nullif(CASE WHEN p_brand = 'Brand#1' THEN ''
                   ELSE substr(replace(p_name, ' ', '-') || '-incorporated-' || p_brand, 1, 20) END, '') AS ticker,
         CASE p_type WHEN 'STANDARD' THEN 'NYSE' WHEN 'ECONOMY' THEN 'NASDAQ' WHEN 'MEDIUM' THEN 'NASDAQ'
                     WHEN 'PROMO' THEN 'NASDAQ' END AS code
  FROM part),
stored AS (SELECT DISTINCT ticker, 'NASDAQ' AS code FROM profiles WHERE p_type = 'ECONOMY' AND ticker IS NOT NULL),
marked AS (
  SELECT *, CASE WHEN ticker IS NULL THEN 'no symbol' WHEN code IS NULL THEN 'no exchange'
                 WHEN (ticker, code) IN (SELECT (ticker, code) FROM stored) THEN 'duplicate'
                 WHEN row_number() OVER (PARTITION BY ticker, code ORDER BY p_partkey) > 1 THEN 'duplicate'
                 ELSE 'insert' END AS status
  FROM profiles)
"""

CHECKS["load_companies"] = f"""
WITH {_PROFILES}
SELECT CASE WHEN p_size >= 10 THEN p_name || ' Inc.' ELSE p_name END AS name, ticker, code AS exchange_code,
       'Canada' AS country, p_type AS sector,
       CASE WHEN p_size > 25 THEN p_brand || ', ' || p_type ELSE p_brand END AS headquarters,
       CAST(floor(p_retailprice * 1000) AS BIGINT) AS market_cap, CAST(p_size AS BIGINT) AS employees, true AS is_active
FROM marked WHERE status = 'insert'
"""

CHECKS["load_audit"] = f"""
WITH {_PROFILES}
SELECT s.status, count(m.status) AS n
FROM (VALUES ('insert'), ('no symbol'), ('no exchange'), ('duplicate')) AS s(status)
LEFT JOIN marked m ON m.status = s.status GROUP BY s.status
"""

_INSIDERS = """
insiders AS (
  SELECT l_suppkey AS company_id, o_custkey, max(o_orderpriority) AS role, min(CAST(o_orderdate AS DATE)) AS start_date,
         CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN max(CAST(o_orderdate AS DATE)) END AS end_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey, o_custkey)
"""

CHECKS["company_insiders"] = f"""
WITH {_INSIDERS}
SELECT n_nationkey AS exchange_code, n_name AS exchange, 'S' || s_suppkey AS ticker, s_name AS company,
       c_name AS insider, role, {DAY.format('start_date')} AS start_date, {DAY.format('end_date')} AS end_date,
       end_date IS NULL AS current
FROM insiders JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = company_id
JOIN nation ON n_nationkey = s_nationkey
"""

# Prices ---------------------------------------------------------------------------

_BARS = """
bars AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)
"""

# Integrity -------------------------------------------------------------------------

CHECKS["unique_violations"] = f"""
WITH {_DOC_ROWS}, {_BARS}
SELECT 'articles' AS table_name, 'url' AS rule, url AS key, count(*) AS n FROM docs GROUP BY url HAVING count(*) > 1
UNION ALL
SELECT 'article_tickers', 'l_orderkey,l_partkey', l_orderkey || '|' || l_partkey, count(*)
FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
UNION ALL
SELECT 'daily_ohlcv', 'ticker,date', ticker || '|' || date, count(*) FROM bars GROUP BY ticker, date HAVING count(*) > 1
UNION ALL
SELECT 'companies', 'p_name,p_brand', p_name || '|' || p_brand, count(*)
FROM part GROUP BY p_name, p_brand HAVING count(*) > 1
"""

CHECKS["fk_violations"] = """
SELECT 'page->benchmark' AS rule, CAST(page_id AS VARCHAR) AS key, count(*) AS n
FROM pages WHERE page_id NOT IN (SELECT item_id FROM benchmark) GROUP BY page_id
UNION ALL
SELECT 'conversation->label', CAST(conv_id AS VARCHAR), count(*)
FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels) GROUP BY conv_id
UNION ALL
SELECT 'link->article', CAST(l_orderkey AS VARCHAR), count(*)
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey
UNION ALL
SELECT 'company->exchange', CAST(s_nationkey AS VARCHAR), count(*)
FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation) GROUP BY s_nationkey
"""

CHECKS["null_violations"] = f"""
WITH {_HISTORY}, {_INSIDERS}
SELECT 'articles' AS table_name, 'url' AS column_name, count(*) - count(url) AS n_null FROM history
UNION ALL SELECT 'articles', 'published_at', count(*) - count(seen_at) FROM history
UNION ALL SELECT 'profiles', 'symbol', 0 FROM (SELECT count(*) FROM part)
UNION ALL SELECT 'profiles', 'exchange', count(*) FILTER (p_type NOT IN ({_list(views.PROFILE_CODES)})) FROM part
UNION ALL SELECT 'profiles', 'longName', count(*) FILTER (p_size < 10) FROM part
UNION ALL SELECT 'insiders', 'company_id', 0
UNION ALL SELECT 'insiders', 'name', 0
UNION ALL SELECT 'insiders', 'end_date', count(*) - count(end_date) FROM insiders
"""

CHECKS["length_violations"] = """
SELECT 'articles' AS table_name, 'url' AS column_name, CAST(page_id AS VARCHAR) AS key, length(url) AS length,
       40 AS limit_n FROM pages WHERE length(url) > 40
UNION ALL SELECT 'articles', 'html', CAST(page_id AS VARCHAR), length(html), 4000 FROM pages WHERE length(html) > 4000
UNION ALL SELECT 'companies', 'p_name', CAST(p_partkey AS VARCHAR), length(p_name), 9 FROM part WHERE length(p_name) > 9
UNION ALL
SELECT 'companies', 'p_brand', CAST(p_partkey AS VARCHAR), length(p_brand), 7 FROM part WHERE length(p_brand) > 7
"""

CHECKS["cascade_delete"] = """
SELECT DISTINCT l_orderkey, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
"""

CHECKS["restricted_delete"] = """
SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND n_nationkey IN (SELECT s_nationkey FROM supplier)
"""

# Prices and risk ---------------------------------------------------------------------

CHECKS["ohlcv_bars"] = f"""
WITH {_BARS}
SELECT ticker, {DAY.format('date')} AS date, open, high, low, close, volume
FROM bars WHERE date >= DATE '{q.PRICE_START}' AND date < DATE '{q.PRICE_END}'
"""

_STORED_BARS = "SELECT ticker, {day} AS date, open, high, low, close, volume, {batch} AS batch_id FROM bars"
CHECKS["ingest_ohlcv"] = f"WITH {_BARS} " + _STORED_BARS.format(
    day=DAY.format("date"), batch=f"CASE WHEN date < DATE '{q.SPLIT_DAY}' THEN 'early' ELSE 'late' END"
)
CHECKS["reload_ohlcv"] = f"WITH {_BARS} " + _STORED_BARS.format(day=DAY.format("date"), batch="'reload'")

_DESCRIBE = (
    "count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
    "round(max({c}), 6) AS max, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    "round(quantile_cont({c}, 0.75), 6) AS p75"
)

CHECKS["ohlcv_summary"] = f"WITH {_BARS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, " + _DESCRIBE.format(c=f"CAST({c} AS DOUBLE)") + " FROM bars"
    for c in ("open", "high", "low", "close", "volume")
)

_RETURNS = f"""
{_BARS},
tickers AS (SELECT DISTINCT ticker FROM bars),
grid AS (
  SELECT t.ticker, d.date, b.close FROM tickers t CROSS JOIN (SELECT DISTINCT date FROM bars) d
  LEFT JOIN bars b ON b.ticker = t.ticker AND b.date = d.date),
filled AS (
  SELECT ticker, date,
         last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close
  FROM grid),
changes AS (
  SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM filled),
returns AS (
  SELECT * FROM changes WHERE date IN (
    SELECT date FROM changes GROUP BY date HAVING count(ret) = (SELECT count(*) FROM tickers)))
"""

CHECKS["daily_returns"] = f"""
WITH {_RETURNS} SELECT ticker, {DAY.format('date')} AS date, round(ret, 6) AS ret FROM returns
"""

CHECKS["return_stats"] = f"""
WITH {_RETURNS}
SELECT ticker, count(ret) AS n, round(avg(ret), 6) AS mean, round(stddev_samp(ret), 6) AS std
FROM returns GROUP BY ticker
"""

_COV = """
cov AS (
  SELECT a.ticker AS t1, b.ticker AS t2, covar_samp(a.ret, b.ret) AS cov
  FROM returns a JOIN returns b ON a.date = b.date GROUP BY a.ticker, b.ticker)
"""

CHECKS["return_cov"] = f"WITH {_RETURNS}, {_COV} SELECT t1, t2, round(cov, 6) AS cov FROM cov"

_WEIGHTS = """
draws AS (
  SELECT CAST(p AS INTEGER) AS portfolio_id, ticker,
         -ln((('0x' || substr(md5('7|' || p || '|' || ticker), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS g
  FROM (SELECT DISTINCT event_type AS ticker FROM events) CROSS JOIN range(1000) AS r(p)),
weights AS (SELECT portfolio_id, ticker, g / sum(g) OVER (PARTITION BY portfolio_id) AS weight FROM draws)
"""

CHECKS["random_weights"] = f"""
WITH {_WEIGHTS} SELECT portfolio_id, ticker, round(weight, 6) AS weight FROM weights
"""

_RISK = f"""
{_RETURNS}, {_COV}, {_WEIGHTS},
means AS (SELECT ticker, avg(ret) AS mean FROM returns GROUP BY ticker),
rate AS (SELECT power(1.03, 1.0 / 252) - 1 AS rf),
gains AS (
  SELECT portfolio_id, sum(weight * (mean - rf - rf)) * 252 AS r, sum(weight * mean) * 252 AS plain
  FROM weights JOIN means USING (ticker) CROSS JOIN rate GROUP BY portfolio_id),
spread AS (
  SELECT a.portfolio_id, sqrt(sum(a.weight * b.weight * cov)) * sqrt(252) AS v
  FROM weights a JOIN weights b ON a.portfolio_id = b.portfolio_id
  JOIN cov ON t1 = a.ticker AND t2 = b.ticker GROUP BY a.portfolio_id)
"""

CHECKS["portfolio_risk"] = f"""
WITH {_RISK}
SELECT portfolio_id, round(r, 6) AS portfolio_return, round(v, 6) AS portfolio_volatility,
       round(r / v, 6) AS sharpe_ratio
FROM gains JOIN spread USING (portfolio_id)
"""

CHECKS["portfolio_risk_standard"] = f"""
WITH {_RISK}
SELECT portfolio_id, round(plain, 6) AS portfolio_return, round(v, 6) AS portfolio_volatility,
       round((plain - 0.03) / v, 6) AS sharpe_ratio
FROM gains JOIN spread USING (portfolio_id)
"""

CHECKS["benchmark_risk"] = f"""
WITH {_BARS},
own AS (SELECT close / lag(close) OVER (ORDER BY date) - 1 AS ret FROM bars WHERE ticker = '{q.BENCHMARK_TICKER}'),
figures AS (SELECT avg(ret) * 252 AS r, stddev_samp(ret) * sqrt(252) AS v FROM own)
SELECT '{q.BENCHMARK_TICKER}' AS ticker, round(r, 6) AS annual_return, round(v, 6) AS annual_volatility,
       round((r - (power(1.03, 1.0 / 252) - 1)) / v, 6) AS sharpe_ratio
FROM figures
"""

CHECKS["top_portfolios"] = f"""
WITH {_RISK},
figures AS MATERIALIZED (SELECT portfolio_id, r, v, r / v AS s FROM gains JOIN spread USING (portfolio_id)),
best AS MATERIALIZED (
  SELECT * FROM (SELECT *, 'sharpe' AS ranking FROM figures ORDER BY s DESC, portfolio_id LIMIT 5)
  UNION ALL SELECT * FROM (SELECT *, 'return' AS ranking FROM figures ORDER BY r DESC, portfolio_id LIMIT 5)
  UNION ALL SELECT * FROM (SELECT *, 'volatility' AS ranking FROM figures ORDER BY v, portfolio_id LIMIT 5))
SELECT portfolio_id, round(r, 6) AS portfolio_return, round(v, 6) AS portfolio_volatility,
       round(s, 6) AS sharpe_ratio, ranking, ticker, round(weight, 6) AS weight
FROM best JOIN weights USING (portfolio_id)
"""

# Text ----------------------------------------------------------------------------------

_CLEAN = f"""
words AS (
  SELECT doc_id, unnest(string_split(lower(regexp_replace(regexp_replace(text, '{SPACE}+', ' ', 'g'),
         '[^a-zA-Z ]', '', 'g')), ' ')) AS term FROM documents),
tokens AS (SELECT doc_id, term FROM words WHERE length(term) > 1 AND term NOT IN ({STOP}))
"""
_RATED = """
rated AS (
  SELECT doc_id, 1 + 3 * quality + (1 - toxic) AS stars,
         CASE WHEN 1 + 3 * quality + (1 - toxic) > 2 THEN 'pos' ELSE 'neg' END AS label,
         substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) < 'b333' AS in_train
  FROM labels WHERE doc_id IN (SELECT doc_id FROM documents))
"""
_FREQ = "freq AS (SELECT label, term AS word, count(*) AS n FROM tokens JOIN rated USING (doc_id) GROUP BY label, term)"

CHECKS["word_freq"] = f"WITH {_CLEAN}, {_RATED}, {_FREQ} SELECT label, word, n FROM freq"

CHECKS["exclusive_words"] = f"""
WITH {_CLEAN}, {_RATED}, {_FREQ}
SELECT label, word, n FROM freq WHERE word NOT IN (
  SELECT word FROM freq WHERE label = 'pos' INTERSECT SELECT word FROM freq WHERE label = 'neg')
"""

CHECKS["vocabulary"] = f"""
WITH {_CLEAN},
kept AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS freq FROM tokens GROUP BY term
         HAVING count(DISTINCT doc_id) >= 3 ORDER BY freq DESC, term LIMIT 8000)
SELECT term, df, freq, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index FROM kept
"""

_MATCHES = "CAST(len(regexp_extract_all(text, '(?i){}')) AS INTEGER)"
CHECKS["keyword_search"] = f"""
SELECT doc_id, source, {_MATCHES.format(q.KEYWORD)} AS matches FROM documents WHERE text ILIKE '%{q.KEYWORD}%'
"""

CHECKS["regex_search"] = f"""
SELECT doc_id, source, {_MATCHES.format(q.PATTERN)} AS matches FROM documents
WHERE regexp_matches(text, '(?i){q.PATTERN}') ORDER BY matches DESC, doc_id LIMIT 20
"""

CHECKS["export_hits"] = f"""
SELECT doc_id, lang, {_MATCHES.format(q.PATTERN)} AS matches FROM documents
WHERE regexp_matches(text, '(?i){q.PATTERN}')
"""

_TERMS = f"""
runs AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM documents),
postings AS (SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf FROM runs
             WHERE length(term) >= 2 AND term NOT IN ({STOP}) GROUP BY term, doc_id)
"""

CHECKS["inverted_index"] = f"WITH {_TERMS} SELECT term, doc_id, tf FROM postings"

_WANTED = sorted({w.lower() for w in q.FULLTEXT if w.lower() not in STOPWORDS})
CHECKS["fulltext_search"] = f"""
WITH {_TERMS.replace(f"AND term NOT IN ({STOP})", "")}
SELECT doc_id, CAST(sum(tf) AS BIGINT) AS hits FROM postings WHERE term IN ({_list(_WANTED)})
GROUP BY doc_id HAVING count(*) = {len(_WANTED)}
"""

CHECKS["stemmed_search"] = f"""
WITH {_TERMS.replace(f"AND term NOT IN ({STOP})", "")},
stems AS (SELECT doc_id, tf, regexp_extract(term, '^(licens|work)(e|es|ed|er|ers|ing|ings|s|able)?$', 1) AS stem,
                 term NOT IN ('licenss', 'licensed', 'licenser', 'licensers', 'worke', 'workes', 'workable', 'worker', 'workers')
                   OR term IN ('licensed') AS known FROM postings)
SELECT doc_id, CAST(sum(tf) AS BIGINT) AS hits FROM stems WHERE stem <> '' AND known GROUP BY doc_id HAVING count(DISTINCT stem) = 2
"""

_ASKED = [w for w in q.QUESTION.lower().split() if len(w) > 1 and w not in STOPWORDS]
_COSINE = f"""
{_TERMS},
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
        FROM postings GROUP BY term),
asked AS (SELECT term, count(*) * any_value(idf) AS qw
          FROM (SELECT unnest([{_list(_ASKED)}]) AS term) JOIN idf USING (term) GROUP BY term),
lengths AS (SELECT doc_id, sqrt(sum((tf * idf) * (tf * idf))) AS len FROM postings JOIN idf USING (term) GROUP BY doc_id),
dots AS (SELECT doc_id, sum(tf * idf * qw) AS dot
         FROM postings JOIN idf USING (term) JOIN asked USING (term) GROUP BY doc_id),
scores AS (
  SELECT d.doc_id, coalesce(dot / (len * (SELECT sqrt(sum(qw * qw)) FROM asked)), 0.0) AS score
  FROM documents d LEFT JOIN dots USING (doc_id) LEFT JOIN lengths USING (doc_id))
"""

CHECKS["tfidf_scores"] = f"WITH {_COSINE} SELECT doc_id, round(score, 6) AS score FROM scores"
CHECKS["tfidf_search"] = f"""
WITH {_COSINE} SELECT doc_id, round(score, 6) AS score FROM scores ORDER BY scores.score DESC, doc_id LIMIT 50
"""

_MENTIONS = """
names AS (SELECT 'T' || item_id AS ticker, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
aliases AS (
  SELECT ticker, unnest(w) AS alias FROM names
  UNION SELECT ticker, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM names),
told AS (
  SELECT doc_id, regexp_extract_all(lower(source || ' ' || lang || ' ' || text), '[\\p{L}\\p{N}]+') AS w
  FROM documents WHERE text IS NOT NULL),
spoken AS (
  SELECT doc_id, unnest(w) AS alias FROM told
  UNION SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM told),
mentions AS (SELECT DISTINCT doc_id AS id, ticker FROM spoken JOIN aliases USING (alias))
"""

CHECKS["entity_tickers"] = f"WITH {_MENTIONS} SELECT id, ticker FROM mentions"
CHECKS["mentioned_tickers"] = f"""
WITH {_MENTIONS}
SELECT doc_id AS id, coalesce(string_agg(ticker, ',' ORDER BY ticker), '') AS tickers
FROM documents LEFT JOIN mentions ON id = doc_id GROUP BY doc_id
"""

# Sentiment -------------------------------------------------------------------------------

_MODEL = f"""
{_CLEAN}, {_RATED},
train AS (SELECT doc_id, label FROM rated WHERE in_train AND (stars > 4 OR stars < 3)),
voc AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS freq FROM tokens JOIN train USING (doc_id) GROUP BY term
        HAVING count(DISTINCT doc_id) >= 3 ORDER BY freq DESC, term LIMIT 6000),
weighted AS (
  SELECT doc_id, term, count(*) * (ln((1.0 + (SELECT count(*) FROM train)) / (1 + any_value(df))) + 1) AS w
  FROM tokens JOIN voc USING (term) GROUP BY doc_id, term),
unit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM weighted),
sums AS (SELECT term, coalesce(sum(w) FILTER (label = 'pos'), 0) AS pos, coalesce(sum(w) FILTER (label = 'neg'), 0) AS neg
         FROM voc LEFT JOIN (SELECT * FROM unit JOIN train USING (doc_id)) USING (term) GROUP BY term),
total AS (SELECT sum(pos) AS pos, sum(neg) AS neg, count(*) AS v FROM sums),
ratio AS (SELECT term, ln((s.pos + 1) / (t.pos + v)) - ln((s.neg + 1) / (t.neg + v)) AS lr FROM sums s CROSS JOIN total t),
prior AS (SELECT ln(count(*) FILTER (label = 'pos') * 1.0 / count(*) FILTER (label = 'neg')) AS lp FROM train),
odds AS (SELECT doc_id, sum(w * lr) AS o FROM unit JOIN ratio USING (term) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, d.text, 1 / (1 + exp(-(coalesce(o, 0) + lp))) AS p_pos,
         CASE WHEN trim(d.text) <> '' THEN round_even(1 / (1 + exp(-(coalesce(o, 0) + lp))), 3) END AS sentiment_score
  FROM documents d LEFT JOIN odds USING (doc_id) CROSS JOIN prior),
held AS (SELECT doc_id, label, CASE WHEN p_pos > 0.5 THEN 'pos' ELSE 'neg' END AS prediction, p_pos
         FROM scored JOIN rated USING (doc_id) WHERE NOT in_train),
reviews AS (SELECT doc_id, label, stars, sentiment_score FROM scored JOIN rated USING (doc_id))
"""

CHECKS["sentiment_train"] = f"WITH {_MODEL} SELECT doc_id, label, prediction, round(p_pos, 6) AS p_pos FROM held"
CHECKS["sentiment_score"] = f"WITH {_MODEL} SELECT doc_id, sentiment_score FROM scored"
CHECKS["sentiment_summary"] = f"""
WITH {_MODEL}
SELECT count(sentiment_score) AS n, min(sentiment_score) AS min, max(sentiment_score) AS max,
       round(avg(sentiment_score), 6) AS mean
FROM scored
"""
CHECKS["sentiment_vocab"] = f"WITH {_MODEL} SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index FROM voc"
CHECKS["keyword_sentiment"] = f"""
WITH {_MODEL},
said AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS keyword FROM documents)
SELECT keyword, count(*) AS n, round(avg(sentiment_score) * 100, 4) AS keyword_sentiment
FROM said JOIN scored USING (doc_id) WHERE keyword IN ({_list(q.KEYWORDS)}) GROUP BY keyword
"""
CHECKS["confusion"] = f"WITH {_MODEL} SELECT label, prediction, count(*) AS n FROM held GROUP BY label, prediction"
CHECKS["class_report"] = f"""
WITH {_MODEL},
counts AS (
  SELECT c.label, count(*) FILTER (h.label = c.label AND prediction = c.label) AS hit,
         count(*) FILTER (h.label = c.label) AS support, count(*) FILTER (prediction = c.label) AS said
  FROM (SELECT label FROM held UNION SELECT prediction FROM held) c CROSS JOIN held h GROUP BY c.label)
SELECT label, CASE WHEN said > 0 THEN round(hit / said, 6) ELSE 0 END AS precision,
       CASE WHEN support > 0 THEN round(hit / support, 6) ELSE 0 END AS recall,
       round(2.0 * hit / (support + said), 6) AS f1, support
FROM counts
"""
CHECKS["label_stats"] = f"WITH {_MODEL} " + " UNION ALL ".join(
    f"SELECT label, '{c}' AS variable, " + _DESCRIBE.format(c=f"CAST({c} AS DOUBLE)") + " FROM reviews GROUP BY label"
    for c in ("sentiment_score", "stars")
)
CHECKS["score_corr"] = f"WITH {_MODEL} SELECT round(corr(stars, sentiment_score), 6) AS corr FROM reviews"
CHECKS["score_histogram"] = f"""
WITH {_MODEL},
binned AS (SELECT label, CAST(least(floor(sentiment_score * 20) + 1, 20) AS BIGINT) AS bin
           FROM reviews WHERE stars <> 3 AND sentiment_score IS NOT NULL)
SELECT label, bin, count(*) AS n, round(CAST((bin - 1) * 0.05 AS DOUBLE), 6) AS bin_lo FROM binned GROUP BY label, bin
"""
_TAILS = [1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16, 31 / 32]
CHECKS["score_letters"] = f"WITH {_MODEL} " + " UNION ALL ".join(
    f"SELECT stars, CAST({round(p, 6)} AS DOUBLE) AS prob, round(quantile_cont(CAST(sentiment_score AS DOUBLE), {p}), 6) AS value "
    "FROM reviews GROUP BY stars"
    for p in _TAILS
)
CHECKS["run_transforms"] = f"""
WITH {_MENTIONS},
one AS (
  SELECT 'sentiment' AS transform, 'ok' AS status, count(*) AS n FROM documents
  UNION ALL SELECT 'broken', 'failed', 0
  UNION ALL SELECT 'entity_extraction', 'ok', count(*) FROM mentions
  UNION ALL SELECT 'links', 'stored', count(*) FROM mentions)
SELECT run, transform, status, n FROM one, (VALUES (1), (2)) AS r(run)
"""

# The same rows from landed files.
CHECKS["landed_bars"] = CHECKS["ohlcv_bars"]
CHECKS["landed_symbols"] = CHECKS["symbol_universe"]
CHECKS["landed_descriptions"] = """
WITH every AS (
  SELECT 'K' || item_id AS ticker, text AS d, 1 AS p, item_id AS n FROM benchmark WHERE text IS NOT NULL
  UNION ALL SELECT 'K' || conv_id, text, 2, turn FROM conversations WHERE coalesce(text, '') <> '')
SELECT ticker, md5(d) AS description_md5 FROM every QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY p DESC, n DESC) = 1
"""
