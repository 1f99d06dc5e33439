"""Rolling features of each symbol (W1 to W32) and features relative to a benchmark.

All windows share one partitioning by symbol and one order by date, so a panel costs one exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.config import DAYS_PER_YEAR, Params, UniverseMode
from panelrank.functions.nulls import finite, safe_divide, true
from panelrank.functions.windows import by_symbol, last_rows, rolling, rolling_pair

YEAR = math.sqrt(DAYS_PER_YEAR)
#: What models are trained on, in order.
MODEL_FEATURES = (
    "roc20", "roc60", "roc120", "rs20", "rs60", "rs120", "rs_combo", "rs_risk_adj", "price_vs_sma20", "price_vs_sma60", "price_vs_sma120", "price_vs_sma200",
    "trend_persist_90", "ma200_slope", "dist_to_90d_high", "dist_to_180d_high", "breakout_proximity", "vol20", "vol60", "momentum_combo", "risk_adjusted_momentum",
    "downside_vol60", "atr_ratio", "drawdown180", "ulcer50", "drawdown_severity", "quote_volume", "avg_quote_vol_30", "avg_quote_vol_90", "avg_quote_vol_180",
    "liquidity_stability", "age_days", "tradable_ratio_180", "beta60", "corr60", "liquidity_acceleration", "benchmark_above_sma200", "benchmark_ma200_slope", "benchmark_z120",
    "breadth_above_sma60", "breadth_above_sma200", "momentum_dispersion", "rs_dispersion", "single_leader_burst",
)
#: Fixed values of the power-law price of the reference asset: 10 ** (SLOPE * log10(days) + LEVEL), days since BIRTH.
BIRTH, SLOPE, LEVEL = "2009-01-03", 5.84, -17.01


def change(x: str, n: int) -> Column:
    """Relative change over n rows."""
    return finite(F.try_divide(F.col(x), F.lag(x, n).over(by_symbol())) - 1)


def averages(df: DataFrame) -> DataFrame:
    """Moving averages, geometric average and changes."""
    return df.withColumns(
        {
            **{f"sma{n}": rolling(F.avg, "close", n) for n in (20, 60, 120, 200)},
            "gma200": F.exp(rolling(F.avg, F.ln(F.greatest(F.col("close"), F.lit(1e-10))), 200)),
            **{f"roc{n}": change("close", n) for n in (20, 60, 120)},
            "ret1": change("close", 1),
        }
    )


def volatility(df: DataFrame) -> DataFrame:
    """W5 to W11 of a table with ret1: volatility, downside volatility, true range, drawdown, ulcer index, z-score."""
    before = F.lag("close").over(by_symbol())
    down = F.when(F.col("ret1") < 0, F.col("ret1")).otherwise(0.0)
    step = df.withColumns(
        {
            **{f"vol{n}": rolling(F.stddev_samp, "ret1", n) * YEAR for n in (20, 60)},
            "downside_vol60": rolling(F.stddev_samp, down, 60) * YEAR,
            "true_range": F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)),
            "drawdown180": F.col("close") / F.max("close").over(last_rows(180)) - 1,
            "_dd": (F.col("close") / rolling(F.max, "close", 50) - 1) * 100,
            "zscore120": safe_divide(F.col("close") - rolling(F.avg, "close", 120), rolling(F.stddev_samp, "close", 120)),
        }
    )
    return step.withColumns({"atr14": rolling(F.avg, "true_range", 14), "ulcer50": F.sqrt(rolling(F.avg, F.col("_dd") * F.col("_dd"), 50))}).drop("_dd")


def position(df: DataFrame) -> DataFrame:
    """W19 to W24 of a table with averages and volatility."""
    above = F.when(true(F.col("close") > F.col("sma200")), 1.0).otherwise(0.0)
    step = df.withColumns(
        {
            **{f"price_vs_sma{n}": safe_divide("close", f"sma{n}") - 1 for n in (20, 60, 120, 200)},
            "_above": above,
            "ma200_slope": change("sma200", 20),
            **{f"dist_to_{n}d_high": F.col("close") / rolling(F.max, "close", n) - 1 for n in (90, 180)},
            "momentum_combo": 0.5 * F.col("roc20") + 0.3 * F.col("roc60") + 0.2 * F.col("roc120"),
            "atr_ratio": safe_divide("atr14", "close"),
            "drawdown_severity": F.abs("drawdown180") * (1 + F.coalesce("ulcer50", F.lit(0.0)) / 100),
        }
    )
    return step.withColumns(
        {
            "trend_persist_90": rolling(F.avg, "_above", 90),
            "breakout_proximity": 1 + F.col("dist_to_90d_high"),
            "risk_adjusted_momentum": safe_divide("momentum_combo", "vol20"),
            "downside_vol_penalty": -F.col("downside_vol60"),
            "drawdown_penalty": -F.col("drawdown_severity"),
        }
    ).drop("_above")


def liquidity(df: DataFrame) -> DataFrame:
    """Mean volumes, their stability and acceleration, age and tradable share."""
    means = [f"avg_quote_vol_{n}" for n in (30, 90, 180)]
    step = df.withColumns(
        {
            **{f"avg_quote_vol_{n}": rolling(F.avg, "quote_volume", n) for n in (30, 90, 180)},
            "age_days": F.row_number().over(by_symbol()),
            "_trade": F.when(true((F.col("quote_volume") > 0) & F.col("close").isNotNull()), 1.0).otherwise(0.0),
        }
    )
    return step.withColumns(
        {
            "liquidity_stability": safe_divide(F.least(*means), F.greatest(*means)),
            "tradable_ratio_180": rolling(F.avg, "_trade", 180, 30),
            "liquidity_acceleration": safe_divide("avg_quote_vol_30", "avg_quote_vol_180") - 1,
        }
    ).drop("_trade")


def liquid_days(df: DataFrame, mode: UniverseMode) -> DataFrame:
    """Days above the volume floor among the last 90 and 180 rows; null with fewer rows and without a floor."""
    above = F.when(true(F.col("quote_volume") >= mode.daily_floor), F.lit(1)).otherwise(0)
    days = lambda n: rolling(F.sum, above, n) if mode.daily_floor > 0 else F.lit(None).cast("long")
    return df.withColumns({"liquid_days_90": days(90), "liquid_days_180": days(180)})


def valuation(df: DataFrame) -> DataFrame:
    """W14 to W17 of a table with averages: Mayer multiple, power-law price, AHR999 and its z-score proxy."""
    days = F.greatest(F.lit(1), F.datediff("date", F.lit(BIRTH).cast("date")))
    step = df.withColumns({"mayer": safe_divide("close", "sma200"), "power_law": F.pow(F.lit(10.0), SLOPE * F.log10(days) + LEVEL)})
    return step.withColumns(
        {
            "ahr999": safe_divide("close", "gma200") * safe_divide("close", "power_law"),
            "mvrv_proxy": safe_divide(F.col("mayer") - rolling(F.avg, "mayer", 200), rolling(F.stddev_samp, "mayer", 200)),
        }
    )


def symbol_features(history: DataFrame) -> DataFrame:
    """All features of every symbol; one exchange."""
    return liquidity(position(volatility(averages(history))))


def relative(panel: DataFrame, params: Params) -> DataFrame:
    """Join the benchmark's columns by date and compare. The benchmark has one row a day: broadcast by AQE's size check."""
    mine = F.col("symbol") == params.benchmark
    wanted = {"roc20": "b_roc20", "roc60": "b_roc60", "roc120": "b_roc120", "ret1": "b_ret1", "close": "b_close", "sma200": "b_sma200", "zscore120": "benchmark_z120", "ma200_slope": "benchmark_ma200_slope"}
    side = panel.where(mine).select(F.col("date").alias("b_date"), *(F.col(a).alias(b) for a, b in wanted.items()))
    joined = panel.join(side, F.col("date") == F.col("b_date"), "left").drop("b_date")
    rs = joined.withColumns(
        {
            **{f"rs{n}": F.col(f"roc{n}") - F.col(f"b_roc{n}") for n in (20, 60, 120)},
            "benchmark_above_sma200": F.when(F.col("b_close").isNotNull(), true(F.col("b_close") > F.col("b_sma200")).cast("double")),
            "beta60": F.when(mine, F.lit(1.0)).otherwise(finite(F.try_divide(rolling_pair(F.covar_samp, "ret1", "b_ret1", 60), rolling(F.var_samp, "b_ret1", 60)))),
            "corr60": F.when(mine, F.lit(1.0)).otherwise(finite(rolling_pair(F.corr, "ret1", "b_ret1", 60))),
        }
    )
    combo = rs.withColumn("rs_combo", 0.5 * F.col("rs20") + 0.3 * F.col("rs60") + 0.2 * F.col("rs120"))
    return combo.withColumn("rs_risk_adj", safe_divide("rs_combo", "vol20")).drop("b_roc20", "b_roc60", "b_roc120", "b_ret1", "b_close", "b_sma200")


def feature_panel(history: DataFrame, params: Params) -> DataFrame:
    """Features of all symbols with those relative to the benchmark."""
    return relative(symbol_features(history), params)


def cycle_snapshot(df: DataFrame, as_of) -> DataFrame:
    """Valuation of each symbol on its last row up to a date."""
    full = valuation(averages(df.where(F.col("date") <= as_of)))
    peak = full.withColumn("high252", F.max("close").over(last_rows(252)))
    last = peak.groupBy("symbol").agg(F.max_by(F.struct("date", "close", "sma200", "gma200", "mayer", "power_law", "ahr999", "mvrv_proxy", "high252"), "date").alias("x")).select("symbol", "x.*")
    return last.withColumns({"drawdown_252d": F.coalesce(1 - safe_divide("close", "high252"), F.lit(0.0)), "sma200_gap": F.coalesce(safe_divide("close", "sma200") - 1, F.lit(0.0))})
