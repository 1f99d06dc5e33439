"""Readers and sinks on small landed files."""

import json
from datetime import date

from pyspark.sql import functions as F

from panelrank.sources import landed, sinks


def test_bar_files(spark, tmp_path):
    (tmp_path / "AAAUSDT.csv").write_text("date,open,close,note\n2024-01-01,1,2,x\n2024-01-02,1,oops,x\n2024-01-01,1,3,y\n,1,1,z\n")
    (tmp_path / "bbbusdt.daily.csv").write_text("date,open,close,note\n2024-01-05 00:00:00,1,9,x\n")
    rows = landed.read_bars(spark, str(tmp_path), columns=("open", "close"))
    assert {(r.symbol, r.date.day, r.close) for r in rows.collect()} == {("AAAUSDT", 1, 3.0), ("AAAUSDT", 2, None), ("BBBUSDT", 5, 9.0)}
    assert {r.symbol for r in landed.read_bars(spark, str(tmp_path), ["bbbusdt"], columns=("open", "close")).collect()} == {"BBBUSDT"}
    assert landed.read_bars(spark, str(tmp_path), start="2024-01-02", end="2024-01-03", columns=("open", "close")).count() == 1


def test_one_ticker_or_many(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"symbol": "A", "quoteVolume": "1.5", "count": 3}))
    (tmp_path / "many.json").write_text(json.dumps([{"symbol": "A", "volume": "bad"}, {"symbol": "B", "count": 4}]))
    assert [tuple(r) for r in landed.read_tickers(spark, str(tmp_path / "one.json")).collect()] == [("A", 1.5, None, 3.0, None)]
    assert landed.read_tickers(spark, str(tmp_path / "many.json")).count() == 2


def test_archive_without_rows_and_with_quote_volume(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("https://www.CryptoDataDownload.com\n")
    assert landed.read_archive(spark, str(tmp_path / "empty.csv"), "A").count() == 0
    (tmp_path / "full.csv").write_text("Date,Open,High,Low,Close,Volume BTC,Volume USDT\n2024-01-01,1,1,1,2,5,7\n2024-01-02,1,1,1,3,5,\n2024-01-03,0,0,0,0,1,1\n2024-01-04,1,,1,1,1,1\n")
    got = {r.date: (r.volume, r.quote_volume) for r in landed.read_archive(spark, str(tmp_path / "full.csv"), "A").collect()}
    assert got == {date(2024, 1, 1): (5.0, 7.0), date(2024, 1, 2): (5.0, None)}


def test_closed_tail(spark):
    day = 19_723 * landed.DAY_MS  # 2024-01-01
    rows = [("2024-01-01", day, day + landed.DAY_MS - 1, day + landed.DAY_MS), ("2024-01-01", day, day + landed.DAY_MS - 1, day + landed.DAY_MS - 1), ("2024-01-02", day, day + landed.DAY_MS - 1, day + landed.DAY_MS), ("2024-01-01", None, None, None)]
    df = spark.createDataFrame(rows, "date string, open_time long, close_time long, received_at long")
    assert [r.x for r in df.select(landed.closed_tail().alias("x")).collect()] == [True, False, False, False]


def test_pool_payload_and_lifecycle(spark, tmp_path):
    rows = [(date(2024, 1, 1), s, True, sc, 0.5, 0.5, 1e6, r) for s, sc, r in (("AUSDT", 0.9, "late"), ("BUSDT", 0.7, None), ("CUSDT", 0.8, "late"), ("DUSDT", None, "late"))]
    panel = spark.createDataFrame(rows, "date date, symbol string, in_universe boolean, final_score double, confidence double, liquidity_stability double, avg_quote_vol_180 double, regime string")
    meta = spark.createDataFrame([("AUSDT", "A"), ("CUSDT", "C")], "symbol string, base_asset string")
    out = sinks.pool_payload(panel, meta, 3, "m", "p", ("regime", "missing")).first()
    assert (out.version, out.pool_size, out.symbols, out.symbol_map) == ("2024-01-01-m", 3, ["AUSDT", "CUSDT", "BUSDT"], {"AUSDT": "A", "CUSDT": "C"})
    assert json.loads(out.selection_meta["AUSDT"]) == {"regime": "late"} and "BUSDT" not in out.selection_meta
    slim = panel.withColumn("close", F.lit(1.0))
    assert sinks.lifecycle_panel(slim, F.lit("2024-01-01").cast("date")).count() == 0
    sinks.write_csv(sinks.lifecycle_panel(slim, F.lit("2024-01-02").cast("date")), str(tmp_path / "out"), compressed=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 4
    sinks.debug_snapshot(slim, F.lit("2024-01-01").cast("date"), str(tmp_path / "one"))
    assert spark.read.option("header", True).csv(str(tmp_path / "one")).count() == 4
