"""Parameters of the operators. The defaults are the published ones; `TEST` fits the driver's tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

#: Annualisation: bars come every calendar day.
DAYS_PER_YEAR = 365

#: Weights of each rule scheme, by feature.
RULE_SCHEMES = {
    "relative_strength_focus": {"rs_risk_adj": 0.35, "trend_persist_90": 0.15, "price_vs_sma200": 0.15, "dist_to_90d_high": 0.10, "liquidity_stability": 0.10, "risk_adjusted_momentum": 0.15},
    "balanced_leader": {"rs_risk_adj": 0.25, "trend_persist_90": 0.20, "price_vs_sma200": 0.15, "ma200_slope": 0.10, "risk_adjusted_momentum": 0.15, "liquidity_stability": 0.10, "avg_quote_vol_180": 0.05},
    "conservative_trend_quality": {"trend_persist_90": 0.25, "price_vs_sma200": 0.20, "ma200_slope": 0.15, "liquidity_stability": 0.15, "downside_vol_penalty": 0.10, "drawdown_penalty": 0.15},
}

#: Fixed values: (rule, linear, ml) weights of the ensemble by regime; None is the default.
REGIME_WEIGHTS = {
    None: (0.35, 0.20, 0.45),
    "risk_off": (0.50, 0.25, 0.25),
    "btc_dominant": (0.40, 0.20, 0.40),
    "broad_alt_strength": (0.25, 0.15, 0.60),
    "late_momentum": (0.35, 0.15, 0.50),
}


@dataclass(frozen=True)
class UniverseMode:
    min_history: int = 365
    min_volume: tuple[float, float, float] = (3e6, 5e6, 8e6)  # means over 30, 90 and 180 rows
    min_stability: float = 0.35
    min_tradable: float = 0.85
    daily_floor: float = 0.0
    min_days: tuple[int, int] = (0, 0)  # of the last 90 and 180 rows above the floor
    enter_after: int = 1
    leave_after: int = 1


BROAD_LIQUID = UniverseMode()
CORE_MAJOR = UniverseMode(720, (8e6, 12e6, 18e6), 0.55, 0.92, 10e6, (70, 145), 2, 2)


@dataclass(frozen=True)
class Params:
    benchmark: str = "BTCUSDT"
    mode: UniverseMode = BROAD_LIQUID
    breadth_min_names: int = 5
    horizons: tuple[int, ...] = (30, 60, 90)
    blend: tuple[float, ...] = (0.50, 0.35, 0.15)
    future_top_k: int = 3
    scheme: str = "balanced_leader"
    rebalance: str = "weekly"
    top_n: int = 3
    weighting: str = "inverse_vol"
    lag: int = 1
    fee_bps: float = 10.0
    slippage_bps: float = 5.0
    train_days: int = 720
    test_days: int = 120
    step_days: int = 60
    min_train_rows: int = 300
    pool_size: int = 5
    quotes: tuple[str, ...] = ("USDT",)
    excluded_bases: tuple[str, ...] = ()
    excluded_symbols: tuple[str, ...] = ()
    excluded_keywords: tuple[str, ...] = ("UP", "DOWN", "BULL", "BEAR")
    extra: dict = field(default_factory=dict)

    @property
    def cost(self) -> float:
        return (self.fee_bps + self.slippage_bps) / 1e4


#: Thresholds under which membership changes on the driver's tables; the benchmark is a brand.
TEST = Params(
    benchmark="Brand#1",
    mode=UniverseMode(365, (75_000, 78_000, 78_500), 0.85, 0.90, 20_000, (60, 120), 2, 2),
)
TEST_FAST = replace(TEST, mode=replace(TEST.mode, enter_after=1, leave_after=1))
