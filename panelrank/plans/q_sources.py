"""Queries of readers and sinks: files and payloads made of the bars are landed in the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.config import TEST
from panelrank.functions.nulls import rounded
from panelrank.functions.tables import shared_dir, stored
from panelrank.operators.calendar import calendar, schedule
from panelrank.plans import panel as P
from panelrank.plans.q_returns import MOMENTUM, momentum_panel
from panelrank.sources import landed, published, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
B = "WITH " + fixtures.bars_sql()
DAY = landed.DAY_MS
#: Added before prices times volumes are rounded: such products end in 5 at the third digit often, and engines differ there.
OFF_TIES = 0.0000123457


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("s1_s2_bar_files", B + """ SELECT upper(symbol) AS symbol, date, round(close, 6) AS close, round(volume, 2) AS volume FROM bars
WHERE symbol IN ('Brand#11', 'Brand#12', 'Brand#23') AND date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'""")
def bar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "bars")
    fixtures.bars(spark, sf_dir).write.partitionBy("symbol").option("header", True).csv(folder)
    rows = landed.read_bars(spark, folder, ["brand#11", "Brand#12", "Brand#23"], "1994-01-01", "1996-12-31", ("open", "high", "low", "close", "volume", "quote_volume"))
    return rows.select("symbol", "date", F.round("close", 6).alias("close"), F.round("volume", 2).alias("volume"))


@query("s3_s4_exchange_files", """WITH m AS (SELECT p_brand AS symbol, count(*) AS n, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM part GROUP BY 1)
SELECT symbol, CASE WHEN n % 3 <> 0 THEN 'TRADING' END AS status, symbol AS base_asset, n % 2 = 0 AS is_spot_trading_allowed, CASE WHEN n % 2 = 0 THEN 'SPOT,MARGIN' ELSE '' END AS permissions,
  CASE WHEN n % 5 <> 0 THEN v END AS quote_volume_24h, n::DOUBLE AS trade_count_24h FROM m""")
def exchange_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fixtures.table(spark, sf_dir, "part")
    rows = part.groupBy(F.col("p_brand").alias("symbol")).agg(F.count("*").alias("n"), F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").cast("string").alias("v"))
    even = F.col("n") % 2 == 0
    item = F.struct("symbol", F.when(F.col("n") % 3 != 0, "TRADING").alias("status"), F.col("symbol").alias("baseAsset"), F.when(even, True).alias("isSpotTradingAllowed"), F.when(even, F.array(F.lit("SPOT"), F.lit("MARGIN"))).alias("permissions"))
    ticker = F.struct("symbol", F.when(F.col("n") % 5 != 0, F.col("v")).otherwise("none").alias("quoteVolume"), F.col("n").cast("string").alias("count"))
    info, stats = _folder(spark, "info"), _folder(spark, "stats")
    rows.agg(F.to_json(F.struct(F.collect_list(item).alias("symbols")))).write.text(info)
    rows.agg(F.to_json(F.collect_list(ticker))).write.text(stats)
    tickers = landed.read_tickers(spark, stats).select("symbol", "quote_volume_24h", "trade_count_24h")
    return landed.read_exchange_info(spark, info).drop("quote_asset").join(tickers, "symbol")


KLINES_SQL = B + f""",
k AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS i, epoch_ms(date::TIMESTAMP) AS o FROM bars),
kb AS (SELECT *, i // 50 AS page, i % 50 AS pos, CASE WHEN i % 97 = 96 THEN o + 1 ELSE o END AS opened FROM k),
re AS (SELECT symbol, page, max(o) + 3 * {DAY} // 2 AS base, max(i) AS top FROM kb GROUP BY symbol, page)"""


def _kline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 50 bars; every 97th opens late; the last of a page of even number is not closed when received."""
    from pyspark.sql import Window

    bars = fixtures.bars(spark, sf_dir)
    opened = F.unix_date("date").cast("long") * DAY
    rows = bars.select("symbol", "close", opened.alias("o"), (F.row_number().over(Window.partitionBy("symbol").orderBy("date")) - 1).alias("i"))
    start = F.when(F.col("i") % 97 == 96, F.col("o") + 1).otherwise(F.col("o"))
    text = lambda c: c.cast("string")
    price = text(F.col("close"))
    bar = F.array(text(start), price, price, price, price, F.lit("1.5"), text(F.col("o") + DAY - 1), F.lit("x"), F.lit("7"), F.lit("0"), F.lit("0"), F.lit("0"))
    pages = rows.groupBy("symbol", F.floor(F.col("i") / 50).cast("int").alias("page")).agg(F.to_json(F.array_sort(F.collect_list(F.struct("i", bar.alias("b"))))["b"]).alias("payload"), F.max("o").alias("last"), F.min("o").alias("start_ms"))
    received = F.col("last") + F.when(F.col("page") % 2 == 0, DAY // 2).otherwise(DAY * 3 // 2)
    return pages.select("symbol", "page", "payload", received.alias("received_ms"), F.col("start_ms"), (F.col("last") - F.when(F.col("page") == 1, DAY).otherwise(0)).alias("end_ms"))


@query("s5_s7_closed_bars", KLINES_SQL + f"""
SELECT symbol, date, round(close, 6) AS close, opened AS open_time, true AS closed, NULL::DOUBLE AS quote_volume FROM kb JOIN re USING (symbol, page)
WHERE opened = o AND o + {DAY} - 1 < base - CASE WHEN page % 2 = 0 THEN {DAY} ELSE 0 END""")
def closed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, _ = landed.klines(_kline_pages(spark, sf_dir))
    return bars.select("symbol", "date", F.round("close", 6).alias("close"), "open_time", landed.closed_tail().alias("closed"), "quote_volume")


@query("s5_s6_s9_bar_problems", KLINES_SQL + f""",
b2 AS (SELECT *, base - CASE WHEN page % 2 = 0 THEN {DAY} ELSE 0 END AS received FROM kb JOIN re USING (symbol, page)),
tail AS (SELECT symbol, max(date) AS date FROM kb GROUP BY symbol),
good AS (SELECT symbol, date FROM b2 WHERE opened = o AND o + {DAY} - 1 < received)
SELECT symbol, 'invalid_boundaries' AS problem, page::BIGINT AS at FROM b2 WHERE opened <> o
UNION ALL SELECT symbol, 'out_of_order', page FROM (SELECT *, max(o) OVER (PARTITION BY symbol, page) AS mx FROM kb) WHERE opened > mx - CASE WHEN page = 1 THEN {DAY} ELSE 0 END
UNION ALL SELECT symbol, 'unverified_tail', year(date) FROM tail ANTI JOIN good USING (symbol, date)""")  # fmt: skip
def bar_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _kline_pages(spark, sf_dir)
    bars, wrong = landed.klines(pages)
    stored = fixtures.bars(spark, sf_dir).select("symbol", "date", *(F.lit(None).cast("long").alias(c) for c in ("open_time", "close_time", "received_at")))
    tails = landed.unverified_tails(stored, bars).select("symbol", F.lit("unverified_tail").alias("problem"), F.year("date").cast("long").alias("at"))
    order = landed.page_violations(pages).select("symbol", F.lit("out_of_order").alias("problem"), F.col("page").cast("long").alias("at"))
    return wrong.select("symbol", "problem", F.col("page").cast("long").alias("at")).unionByName(order).unionByName(tails)


@query("s12_s13_history_payloads", B + """, h AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS i FROM bars)
SELECT 'days' AS kind, symbol, date, round(close, 6) AS close, round(quote_volume + 0.0000123457, 2) AS quote_volume FROM h WHERE i % 7 <> 0 AND date >= DATE '1995-06-01'
UNION ALL SELECT 'chart', symbol, date, round(close, 6), round(close * volume + 0.0000123457, 2) FROM h WHERE i % 5 <> 0""")
def history_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both payloads hold a day twice (the second counts) and days without prices."""
    from pyspark.sql import Window

    rows = fixtures.bars(spark, sf_dir).withColumn("i", F.row_number().over(Window.partitionBy("symbol").orderBy("date"))).withColumn("t", F.unix_date("date").cast("long") * 86400)
    price = lambda c: F.when(F.col("i") % 7 != 0, F.col(c)).otherwise(0.0).alias(c)
    day = F.struct(F.col("t").alias("time"), *(price(c) for c in ("open", "high", "low", "close")), F.col("volume").alias("volumefrom"), F.col("quote_volume").alias("volumeto"))
    stale = F.struct(F.col("t").alias("time"), *(F.lit(9.0).alias(c) for c in ("open", "high", "low", "close")), F.lit(0.0).alias("volumefrom"), F.lit(0.0).alias("volumeto"))
    kept = F.when(F.col("i") % 7 != 0, F.array(stale, day)).otherwise(F.array(day))
    days = rows.groupBy("symbol").agg(F.to_json(F.struct(F.struct(F.flatten(F.array_sort(F.collect_list(F.struct("i", kept.alias("k"))))["k"]).alias("Data")).alias("Data"))).alias("payload")).withColumn("page", F.lit(0))
    each = rows.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("i", "t", "open", "high", "low", F.when(F.col("i") % 5 != 0, F.col("close")).alias("close"), "volume"))).alias("x"))
    quote = F.struct(*(F.col(f"x.{c}").alias(c) for c in ("open", "high", "low", "close", "volume")))
    result = F.struct(F.col("x.t").alias("timestamp"), F.struct(F.array(quote).alias("quote")).alias("indicators"))
    answers = each.select("symbol", F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")), {"ignoreNullFields": "false"}).alias("payload"))
    out = landed.history_days(days, "1995-06-01").withColumn("kind", F.lit("days")).unionByName(landed.chart(answers).withColumn("kind", F.lit("chart")))
    return out.select("kind", "symbol", "date", F.round("close", 6).alias("close"), F.round(F.col("quote_volume") + OFF_TIES, 2).alias("quote_volume"))


@query("s14_archive_file", B + " SELECT symbol, date, round(close, 6) AS close, round(volume, 2) AS volume, round(close * volume + 0.0000123457, 2) AS quote_volume FROM bars WHERE symbol = 'Brand#12'")
def archive_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "archive")
    rows = fixtures.bars(spark, sf_dir).where("symbol = 'Brand#12'")
    lines = rows.select(F.col("date").alias("d"), F.concat_ws(",", F.concat(F.col("date").cast("string"), F.lit(" 00:00:00")), F.lit("X"), "open", "high", "low", "close", "volume", F.lit("")).alias("value"))
    head = spark.createDataFrame([("0001-01-01", "https://www.CryptoDataDownload.com"), ("0001-01-02", "Date,Symbol,Open,High,Low,Close,Volume BTC,Volume USDT")], "d string, value string").select(F.to_date("d").alias("d"), "value")
    head.unionByName(lines).coalesce(1).sortWithinPartitions("d").select("value").write.text(path)
    out = landed.read_archive(spark, path, "Brand#12")
    return out.select("symbol", "date", F.round("close", 6).alias("close"), F.round("volume", 2).alias("volume"), F.round(F.col("quote_volume") + OFF_TIES, 2).alias("quote_volume"))


@query("s18_s20_csv_files", """WITH c AS (SELECT p_brand AS symbol, count(*) AS n FROM part GROUP BY 1)
SELECT symbol, n::VARCHAR AS market_cap_rank, NULL AS grp, 'one' AS provider FROM c UNION ALL SELECT symbol, NULL, substr(symbol, 7, 1), 'two' FROM c UNION ALL SELECT symbol, (n + 1)::VARCHAR, NULL, 'latest' FROM c""")
def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("symbol")).agg(F.count("*").alias("n"))
    one, two, runs = (_folder(spark, n) for n in ("one", "two", "runs"))
    sinks.write_csv(rows.select("symbol", F.col("n").alias("market_cap_rank")), one)
    sinks.write_csv(rows.select("symbol", F.substring("symbol", 7, 1).alias("grp")), two)
    sinks.write_csv(rows.select("symbol", F.col("n").alias("market_cap_rank")), f"{runs}/2024-01")
    sinks.write_csv(rows.select("symbol", (F.col("n") + 1).alias("market_cap_rank")), f"{runs}/2024-02", compressed=True)
    latest = landed.read_latest(spark, runs, "2024-").withColumns({"provider": F.lit("latest"), "grp": F.lit(None).cast("string")})
    return landed.read_metadata(spark, {"one": one, "two": two}).unionByName(latest)


@query("s19_named_closes", B + """, c AS (SELECT symbol, count(*) AS n, date_diff('day', min(date), max(date)) + 1 - count(*) AS gaps FROM bars WHERE symbol = 'Brand#12' AND date <= DATE '1997-12-31' GROUP BY symbol)
SELECT 0 AS empty, 0::BIGINT AS bad_dates, 0::BIGINT AS other_symbols, 1::BIGINT AS duplicate_dates, 1::BIGINT AS bad_closes, gaps::BIGINT AS missing_days, 0 AS received_late, (n + 1)::BIGINT AS n_rows FROM c""")
def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = fixtures.bars(spark, sf_dir).where("symbol = 'Brand#12'").select(F.col("date").cast("string").alias("date"), F.lower("symbol").alias("symbol"), F.col("close").cast("string").alias("close"))
    first = bars.orderBy("date").limit(1).withColumn("close", F.lit("-1"))
    rows, broken = landed.named_closes(bars.unionByName(first), F.lit("1997-12-31").cast("date"), "BRAND#12", continuous=True)
    return broken.select("empty", "bad_dates", "other_symbols", "duplicate_dates", "bad_closes", F.col("missing_days").cast("long").alias("missing_days"), "received_late").join(rows.agg(F.count("*").alias("n_rows")))


AS_OF = "1998-06-30"


@query("k1_k2_exported_snapshot", P.sql("rules", f"""
, d AS (SELECT * FROM scored WHERE date = DATE '{AS_OF}' AND in_universe)
SELECT '{AS_OF}' AS as_of_date, symbol, current_rank::INT AS current_rank, coalesce(current_rank <= 5, false) AS selected_flag, regime, round(final_score, 6) AS final_score, (SELECT count(*) FROM d)::INT AS n_symbols FROM d""".lstrip()))
def exported_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe and ranking of a date as written and read back."""
    panel, at = P.scored_panel(spark, sf_dir), F.lit(AS_OF).cast("date")
    universe, ranks = _folder(spark, "universe"), _folder(spark, "ranking")
    sinks.write_json(sinks.universe_payload(panel, at), universe)
    sinks.write_csv(sinks.ranking_table(panel, at), ranks)
    members = spark.read.schema("as_of_date string, symbols array<string>").json(universe)
    rows = spark.read.option("header", True).schema(", ".join(f"{c} {'int' if c == 'current_rank' else 'boolean' if c == 'selected_flag' else 'double' if 'score' in c or c == 'confidence' else 'string'}" for c in sinks.RANKING)).csv(ranks)
    joined = rows.join(members.select("as_of_date", F.size("symbols").alias("n_symbols")), "as_of_date")
    return joined.select("as_of_date", "symbol", "current_rank", "selected_flag", "regime", F.round("final_score", 6).alias("final_score"), "n_symbols")


@query("k3_k4_pool_releases", P.sql("rules", """
, t AS (SELECT * FROM scored WHERE in_universe AND current_rank <= 5 AND date IN (SELECT date FROM s0))
SELECT date::VARCHAR AS as_of_date, date::VARCHAR || '-demo' AS version, count(*)::INT AS pool_size, string_agg(symbol, '|' ORDER BY current_rank) AS symbols, count(*)::INT AS n_mapped, count(regime)::INT AS n_meta FROM t GROUP BY date""".lstrip()))
def pool_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = P.scored_panel(spark, sf_dir)
    panel = panel.join(schedule(calendar(panel), "monthly").select("date"), "date", "left_semi")
    folder = _folder(spark, "history")
    sinks.write_releases(sinks.pool_payload(panel, fixtures.metadata(spark, sf_dir), TEST.pool_size, "demo", "demo", ("regime", "confidence")), folder)
    back = spark.read.schema("as_of_date string, mode string, pool_size int, symbols array<string>, symbol_map map<string,string>, selection_meta map<string,string>, version string").json(f"{folder}/releases")
    return back.select("as_of_date", "version", "pool_size", F.concat_ws("|", "symbols").alias("symbols"), F.size("symbol_map").alias("n_mapped"), F.size("selection_meta").alias("n_meta"))


@query("k3_k4_published_pairs", P.sql("rules", """
, t AS (SELECT * FROM scored WHERE in_universe AND current_rank <= 5 AND date IN (SELECT date FROM s0)),
v AS (SELECT date, date::VARCHAR || '-demo' AS version, count(*)::INT AS pool_size, string_agg(symbol, '|' ORDER BY current_rank) AS l, string_agg(symbol, '|' ORDER BY symbol) AS m FROM t GROUP BY date)
SELECT version, 'list' AS form, pool_size, l AS symbols FROM v UNION ALL SELECT version, 'legacy', pool_size, m FROM v""".lstrip()))
def published_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both forms of all pools as published; a later version that lacks a form is refused and leaves them as they are."""
    panel = P.scored_panel(spark, sf_dir)
    panel = panel.join(schedule(calendar(panel), "monthly").select("date"), "date", "left_semi")
    payload = stored(sinks.pool_payload(panel, fixtures.metadata(spark, sf_dir), TEST.pool_size, "demo", "demo", ("regime",)), "payload")
    path = _folder(spark, "pools")
    sinks.publish_pools(payload, path, "first")
    broken = sinks.payload_pairs(payload).where("form = 'list' or as_of_date < '1999-01-01'").withColumn("year", F.substring("as_of_date", 1, 4))
    published.release(broken, path, "second", "year", sinks.pair_checks)
    rows = published.current(spark, path)
    listed = F.array_join(F.from_json(F.get_json_object("payload", "$.symbols"), "array<string>"), "|")
    mapped = F.array_join(F.array_sort(F.map_keys(F.from_json(F.get_json_object("payload", "$.symbols"), "map<string,string>"))), "|")
    return rows.select("version", "form", F.get_json_object("payload", "$.pool_size").cast("int").alias("pool_size"), F.when(F.col("form") == "list", listed).otherwise(mapped).alias("symbols"))


@query("k6_p12_published_lifecycle", MOMENTUM + " SELECT date, symbol, in_universe, round(score, 6) AS final_score, round(close, 6) AS close FROM mp WHERE date < DATE '1998-08-01'")
def published_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle panel as published after its checks; the next version, held to more dates than there are, is refused."""
    panel, path = momentum_panel(spark, sf_dir).withColumnRenamed("score", "final_score"), _folder(spark, "lifecycle")
    today, references = F.lit("1998-08-01").cast("date"), (TEST.benchmark.upper(),)
    sinks.publish_lifecycle(panel, path, "first", today, references, min_dates=500, min_members=0, min_reference=500)
    sinks.publish_lifecycle(panel.where("in_universe"), path, "second", today, references, min_dates=10**6)
    rows = published.current(spark, path)
    return rows.select("date", "symbol", "in_universe", *(rounded(c, 6).alias(c) for c in ("final_score", "close")))
