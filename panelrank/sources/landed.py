"""Readers of landed files (S1 to S7, S9, S12 to S14, S18 to S20): from what a download left behind to typed rows.

Payload readers take a table with the raw text in a column, so that one job parses the answers for all symbols. Numbers are
cast with `try_cast`: what is no number becomes null. Nothing is fetched here.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.functions.nulls import finite, true
from panelrank.functions.tables import names as listing

#: The fields of a bar as it is landed, in order, and the milliseconds of a day.
KLINE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")
DAY_MS = 86_400_000
BARS = ("open", "high", "low", "close", "volume", "quote_volume")


def _number(name: str) -> Column:
    return F.col(name).try_cast("double").alias(name)


def _stem() -> Column:
    """The symbol that a file is of: its folder `symbol=X` if there is one, else its name without what follows the first dot."""
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"/symbol=([^/]+)/", 1)
    decoded = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    # a folder's name is escaped once by Spark's writer and once as a path
    return F.upper(F.when(folder != "", decoded(decoded(folder))).otherwise(decoded(F.regexp_extract(path, r"/([^/.]+)[^/]*$", 1))))


def _named(name: str) -> str:
    """The symbol that a listed name is of, as `_stem` reads it from a path."""
    return unquote(unquote(name.removeprefix("symbol=")) if name.startswith("symbol=") else name.split(".")[0]).upper()


def last_by_date(rows: DataFrame, order: str) -> DataFrame:
    """One row of each symbol and date: the last by `order`."""
    names = [c for c in rows.columns if c not in ("symbol", "date", order)]
    return rows.groupBy("symbol", "date").agg(F.max_by(F.struct(*names), order).alias("x")).select("symbol", "date", "x.*")


def read_bars(spark: SparkSession, folder: str, symbols: list[str] | None = None, start: str | None = None, end: str | None = None, columns=BARS) -> DataFrame:
    """A folder of CSV files with a header, one symbol each: symbol, date and numbers; the last line of a date wins.

    With `symbols` the files are chosen from the folder's listing (`symbol=X` folders or files named after the symbol), so files of
    others are not opened; a folder that is nested otherwise is read whole. Lines without a date are dropped.
    """
    wanted = None if symbols is None else {s.upper() for s in symbols}
    listed = [] if wanted is None else [n for n in listing(spark, folder) if not n.startswith(("_", "."))]
    chosen = [n for n in listed if _named(n) in wanted]
    if wanted is not None and all(n.startswith("symbol=") or "." in n for n in listed):
        if not chosen:
            return spark.createDataFrame([], "symbol string, date date, " + ", ".join(f"{c} double" for c in columns))
        folder = [f"{folder}/{n}" for n in chosen]
    csv = spark.read.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
    names = [c for c in csv.csv(folder).columns if c != "symbol"]  # the header of one file; files with another raise an error
    rows = csv.schema(", ".join(f"`{c}` string" for c in names)).csv(folder)
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in columns if c not in names})
    tagged = rows.select(_stem().alias("symbol"), F.try_to_date(F.substring("date", 1, 10)).alias("date"), *(_number(c) for c in columns), F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("line"))
    tests = [F.col("date").isNotNull()]
    tests += [F.col("symbol").isin([s.upper() for s in symbols])] if symbols is not None else []
    tests += [F.col("date") >= start] if start else []
    tests += [F.col("date") <= end] if end else []
    return last_by_date(tagged.where(reduce(lambda a, b: a & b, tests)), "line")


def read_exchange_info(spark: SparkSession, path: str) -> DataFrame:
    """S3: one row per symbol of an object with the list `symbols`; a missing permission to trade is false."""
    item = "struct<symbol:string,status:string,baseAsset:string,quoteAsset:string,isSpotTradingAllowed:boolean,permissions:array<string>>"
    rows = spark.read.schema(f"symbols array<{item}>").option("multiLine", True).json(path).select(F.explode("symbols").alias("x"))
    return rows.select(
        "x.symbol", "x.status", F.col("x.baseAsset").alias("base_asset"), F.col("x.quoteAsset").alias("quote_asset"),
        F.coalesce("x.isSpotTradingAllowed", F.lit(False)).alias("is_spot_trading_allowed"), F.concat_ws(",", "x.permissions").alias("permissions"),
    )


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """24-hour statistics from one object or a list of them."""
    rows = spark.read.schema("symbol string, quoteVolume string, volume string, count string, weightedAvgPrice string").option("multiLine", True).json(path)
    names = {"quoteVolume": "quote_volume_24h", "volume": "base_volume_24h", "count": "trade_count_24h", "weightedAvgPrice": "weighted_avg_price_24h"}
    return rows.select("symbol", *(F.col(a).try_cast("double").alias(b) for a, b in names.items()))


def _pages(pages: DataFrame) -> DataFrame:
    """The bars of pages (symbol, page, payload, received_ms) with their place; times are whole milliseconds or null."""
    rows = pages.select("symbol", "page", "received_ms", F.posexplode(F.from_json("payload", "array<array<string>>")).alias("pos", "x"))
    whole = lambda c: F.when(c.try_cast("decimal(38,6)") % 1 == 0, c.try_cast("decimal(38,6)").cast("long"))
    item = {name: F.get("x", F.lit(i)) for i, name in enumerate(KLINE)}
    return rows.select("symbol", "page", "pos", "received_ms", *((whole(c) if name.endswith("_time") else c.try_cast("double")).alias(name) for name, c in item.items()))


def klines(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars closed when they were received, violations: symbol, page, pos, problem)."""
    rows = _pages(pages)
    wrong = (
        F.when(F.col("open_time").isNull() | F.col("close_time").isNull(), "invalid_timestamp")
        .when((F.col("open_time") % DAY_MS != 0) | (F.col("close_time") != F.col("open_time") + DAY_MS - 1) | (F.col("open_time") > F.col("received_ms")), "invalid_boundaries")
    )
    good = rows.where(wrong.isNull() & (F.col("close_time") < F.col("received_ms")))
    bars = good.select(F.to_date(F.timestamp_millis("open_time")).alias("date"), "symbol", "open_time", "close_time", F.col("received_ms").alias("received_at"), *(c for c in KLINE if not c.endswith("_time")))
    return bars, rows.where(wrong.isNotNull()).select("symbol", "page", "pos", wrong.alias("problem"))


def page_violations(pages: DataFrame) -> DataFrame:
    """Symbol, page, pos, open_time of bars that do not come after the one before or leave their request (start_ms, end_ms)."""
    from pyspark.sql import Window

    bounds = pages.select("symbol", "page", "start_ms", "end_ms")
    rows = _pages(pages).join(bounds, ["symbol", "page"])
    before = F.lag("open_time").over(Window.partitionBy("symbol").orderBy("page", "pos"))
    bad = F.col("open_time").isNull() | (F.col("open_time") < F.col("start_ms")) | true(F.col("open_time") > F.col("end_ms")) | true(F.col("open_time") <= before)
    return rows.withColumn("bad", bad).where("bad").select("symbol", "page", "pos", "open_time")


def closed_tail(date="date", opened="open_time", closed="close_time", received="received_at") -> Column:
    """Whether a bar's own times show that it was closed when received."""
    whole = [F.when(F.col(c).try_cast("double") % 1 == 0, F.col(c).try_cast("long")) for c in (opened, closed, received)]
    midnight = F.unix_date(F.to_date(date)).cast("long") * DAY_MS
    return true((whole[0] == midnight) & (whole[1] == whole[0] + DAY_MS - 1) & (whole[2] > whole[1]))


def unverified_tails(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Symbol, date: last stored bars without that evidence that no fetched bar replaces."""
    tails = stored.groupBy("symbol").agg(F.max_by(F.struct(closed_tail().alias("fine"), "date"), "date").alias("x")).select("symbol", "x.*").where(~F.col("fine"))
    return tails.join(fetched.select("symbol", "date"), ["symbol", "date"], "left_anti").select("symbol", "date")


def history_days(pages: DataFrame, least: str | None = None) -> DataFrame:
    """Bars from payloads (symbol, page, payload) whose Data.Data lists days in unix seconds; the last of a date wins."""
    day = "struct<time:string,open:string,high:string,low:string,close:string,volumefrom:string,volumeto:string>"
    rows = pages.select("symbol", F.col("page"), F.posexplode(F.from_json("payload", f"struct<Data:struct<Data:array<{day}>>>")["Data"]["Data"]).alias("pos", "x"))
    date = F.to_date(F.timestamp_seconds(F.col("x.time").try_cast("long")))
    out = rows.select("symbol", date.alias("date"), *(F.col(f"x.{a}").try_cast("double").alias(b) for a, b in zip(("open", "high", "low", "close", "volumefrom", "volumeto"), BARS)), F.struct("page", "pos").alias("line"))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in BARS[:4]), F.lit(0.0))
    return last_by_date(out.where((total > 0) & F.col("date").isNotNull() & (F.lit(True) if least is None else F.col("date") >= least)), "line")


def chart(answers: DataFrame, least: str | None = None) -> DataFrame:
    """Bars from payloads (symbol, payload) of parallel arrays; days without a close are dropped, the last of a date wins."""
    quote = "struct<open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<double>>"
    kind = f"struct<chart:struct<result:array<struct<timestamp:array<bigint>,indicators:struct<quote:array<{quote}>>>>>>"
    one = answers.select("symbol", F.get(F.from_json("payload", kind)["chart"]["result"], F.lit(0)).alias("r"))
    q = F.get(F.col("r.indicators.quote"), F.lit(0))
    rows = one.select("symbol", F.posexplode(F.arrays_zip(F.col("r.timestamp").alias("t"), *(q[c].alias(c) for c in BARS[:5]))).alias("pos", "x"))
    out = rows.select("symbol", F.to_date(F.timestamp_seconds("x.t")).alias("date"), *(F.col(f"x.{c}").alias(c) for c in BARS[:5]), (F.col("x.close") * F.col("x.volume")).alias("quote_volume"), F.col("pos").alias("line"))
    return last_by_date(out.where(F.col("close").isNotNull() & F.col("date").isNotNull() & (F.lit(True) if least is None else F.col("date") >= least)), "line")


def read_archive(spark: SparkSession, path: str, symbol: str, banner: str = "CryptoDataDownload", least: str | None = None) -> DataFrame:
    """Bars of one archive file, whose first line may be a banner; the header says which columns hold the volumes.

    The quote volume is the first volume column named after a dollar; only if it is null throughout, it is close times volume.
    """
    first = [r["value"] for r in spark.read.text(path).limit(2).collect()]  # the header
    skip = bool(first) and banner in first[0]
    if len(first) < 1 + skip:
        return spark.createDataFrame([], "symbol string, date date, " + ", ".join(f"{c} double" for c in BARS))
    names = [c.strip().lower().replace(" ", "_") for c in first[skip].split(",")]
    dollars = [c for c in names if c.startswith("volume_") and any(t in c for t in ("usd", "usdt", "usdc"))]
    others = [c for c in names if c.startswith("volume_") and c not in ("volume_usd", "volume_usdt", "volume_usdc")]
    lines = spark.read.text(path).where((F.col("value") != first[0]) & (F.col("value") != first[skip]))
    cells = lines.select(F.from_csv("value", ", ".join(f"`{c}` string" for c in names)).alias("x"), F.monotonically_increasing_id().alias("line"))
    of = lambda c: F.col(f"x.`{c}`").try_cast("double") if c in names else F.lit(None).cast("double")
    volume, quoted = (of(c[0]) if c else F.lit(None).cast("double") for c in (others, dollars))
    rows = cells.select(F.lit(symbol).alias("symbol"), F.try_to_date(F.substring("x.date", 1, 10)).alias("date"), *(of(c).alias(c) for c in BARS[:4]), volume.alias("volume"), quoted.alias("quoted"), "line")
    any_quoted = rows.agg(F.max(F.col("quoted").isNotNull()).alias("any_quoted"))
    filled = rows.join(any_quoted).withColumn("quote_volume", F.when(F.coalesce("any_quoted", F.lit(False)), F.col("quoted")).otherwise(F.col("close") * F.col("volume"))).drop("quoted", "any_quoted")
    total = F.coalesce(F.col("open") + F.col("high") + F.col("low") + F.col("close"), F.lit(0.0))
    return last_by_date(filled.where((total > 0) & F.col("date").isNotNull() & (F.lit(True) if least is None else F.col("date") >= least)), "line")


def read_metadata(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """CSV files by provider, one table: columns that a file lacks are null; `provider` tells the file."""
    parts = [spark.read.option("header", True).csv(path).withColumn("provider", F.lit(name)) for name, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def named_closes(rows: DataFrame, as_of, symbol: str, cutoff_ms: int | None = None, continuous: bool = False) -> tuple[DataFrame, DataFrame]:
    """(date, close up to a date, in order of nothing; one row of violations by name, all 0 for a usable history)."""
    dated = rows.select(F.to_date(F.to_timestamp("date")).alias("date"), F.upper(F.trim("symbol")).alias("symbol"), _number("close"), *(["received_at"] if cutoff_ms is not None else []))
    kept = dated.where(F.col("date").isNull() | (F.col("date") <= as_of))
    late = F.count_if(F.coalesce(F.col("received_at").try_cast("long"), F.lit(2**62)) > cutoff_ms) if cutoff_ms is not None else F.lit(0)
    span = F.datediff(F.max("date"), F.min("date")) + 1 - F.countDistinct("date")
    broken = kept.agg(
        F.when(F.count("*") == 0, 1).otherwise(0).alias("empty"), F.count_if(F.col("date").isNull()).alias("bad_dates"), F.count_if(~F.col("symbol").eqNullSafe(F.lit(symbol))).alias("other_symbols"),
        (F.count("date") - F.countDistinct("date")).alias("duplicate_dates"), F.count_if(~true(finite("close") > 0)).alias("bad_closes"), (span if continuous else F.lit(0)).alias("missing_days"), late.alias("received_late"),
    )
    return kept.select("date", "close"), broken


def read_latest(spark: SparkSession, folder: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """The CSV rows of the greatest name in a folder among those that begin and end as asked; empty without one.

    The choice is made from the folder's listing, so no other file is opened.
    """
    found = [n for n in listing(spark, folder) if n.startswith(prefix) and n.endswith(suffix) and not n.startswith(("_", "."))]
    if not found:
        return spark.createDataFrame([], "date string")
    return spark.read.option("header", True).csv(f"{folder}/{found[-1]}")
