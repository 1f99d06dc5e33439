"""Every registered query of the library against its SQL, and hand-computed cases."""

import math
from datetime import date, timedelta
from itertools import product

import pytest
from pyspark.sql import functions as F

from panelrank.config import Params, UniverseMode
from panelrank.functions.windows import rank_pct
from panelrank.operators import calendar, contract, evaluation, merge, portfolio, scores, universe
from panelrank.plans import registry
from tests.helpers import assert_same

QUERIES, ORACLES = registry.registered()
D = date(2024, 1, 1)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, duck, name):
    assert_same(QUERIES[name](spark, sf), duck.sql(ORACLES[name]))


def panel(spark, opens, scores_by_day=None, symbols=("AAA",)):
    rows = [(D + timedelta(i), s, float(o), True, 0.1, 1.0 if scores_by_day is None else scores_by_day[i]) for i, o in enumerate(opens) for s in symbols]
    return spark.createDataFrame(rows, "date date, symbol string, open double, in_universe boolean, vol20 double, score double")


DAILY = Params(rebalance="daily", top_n=1, weighting="equal")


def test_price_drop_returns(spark):
    out = portfolio.daily_returns(panel(spark, [100, 100, 90, 81, 81, 81]), "score", DAILY).orderBy("date").collect()
    want = [0, 0.9 / 1.0015 - 1, -0.1, 0, 0, 0]
    assert all(abs(r.net_return - w) < 1e-12 for r, w in zip(out, want))
    perf = evaluation.performance(portfolio.suite(panel(spark, [100, 100, 90, 81, 81, 81]), ["score"], DAILY), ["strategy"]).first()
    assert abs(perf.max_drawdown - (0.81 / 1.0015 - 1)) < 1e-12


def test_exit_and_reentry(spark):
    out = portfolio.daily_returns(panel(spark, [100] * 6, [1.0, None, None, 1.0, None, None]), "score", DAILY).orderBy("date").collect()
    want = [0, 1 / 1.0015 - 1, -0.0015, 0, 1 / 1.0015 - 1, -0.0015]
    assert all(abs(r.net_return - w) < 1e-12 for r, w in zip(out, want))


@pytest.mark.parametrize("returns,name,want", [([-0.1], "max_drawdown", -0.1), ([-0.1, -0.1], "max_drawdown", -0.19), ([0.1, -0.2], "max_drawdown", -0.2), ([-0.02, 0.01, 0.0], "sortino", -math.sqrt(365 / 12))])
def test_performance_values(spark, returns, name, want):
    rows = [("s", D + timedelta(i), r, 0.0) for i, r in enumerate(returns)]
    table = spark.createDataFrame(rows, "strategy string, date date, net_return double, turnover double")
    assert abs(evaluation.performance(table, ["strategy"]).first()[name] - want) < 1e-12


def test_return_faults(spark):
    values = [None, 0.1, None, float("inf"), -1.0]
    rows = [("s", D + timedelta(i), r) for i, r in enumerate(values)] + [("s", D + timedelta(4), 0.0)]
    r = evaluation.return_faults(spark.createDataFrame(rows, "strategy string, date date, net_return double"), ["strategy"]).first()
    assert (r.leading_gap, r.repeated_dates, r.inner_gaps, r.not_finite, r.at_most_minus_one) == (1, 1, 1, 1, 1)


def test_window_arithmetic(spark):
    days = calendar.calendar(spark.createDataFrame([(D + timedelta(i),) for i in range(8)], "date date"))
    out = calendar.walkforward_windows(days, Params(train_days=4, test_days=2, step_days=2, horizons=(1, 2))).orderBy("window_id").collect()
    assert (out[0].train_end, out[0].effective_train_end, out[0].purge_days) == (D + timedelta(3), D + timedelta(1), 2)
    assert [r.test_start for r in out] == [D + timedelta(4), D + timedelta(6)]


def test_refresh_drops_adjacent_month_end(spark):
    days = calendar.calendar(spark.createDataFrame([(date(2026, m, d),) for m, d in ((5, 31), (6, 30), (7, 31), (8, 1))], "date date"))
    assert sorted(r.date for r in calendar.refresh_schedule(days).collect()) == [date(2026, 5, 31), date(2026, 6, 30), date(2026, 8, 1)]


@pytest.mark.parametrize("enter,leave", [(1, 1), (2, 2), (3, 1), (1, 3)])
def test_hysteresis_against_loop(spark, enter, leave):
    patterns = ["".join(p) for p in product("01-", repeat=5)]
    rows = [(D + timedelta(i), p, c == "1") for p in patterns for i, c in enumerate(p) if c != "-"]
    refreshes = spark.createDataFrame([(D + timedelta(i),) for i in range(5)], "date date")
    got = universe.memberships(spark.createDataFrame(rows, "date date, symbol string, candidate_eligible boolean"), refreshes, UniverseMode(enter_after=enter, leave_after=leave))
    want = {}
    for p in {s for _, s, _ in rows}:
        member, good, bad = False, 0, 0
        for i, c in enumerate(p):
            good, bad = (good + 1, 0) if c == "1" else (0, bad + 1)
            member = (member and bad < leave) or (c == "1" and (member or good >= enter))
            want[p, D + timedelta(i)] = member
    assert {(r.symbol, r.snapshot_date): r.member for r in got.collect()} == want


def test_rank_ties_and_nulls(spark):
    rows = [(1, "a", 3.0), (1, "b", 3.0), (1, "c", 1.0), (1, "d", None), (2, "a", None)]
    df = spark.createDataFrame(rows, "date int, symbol string, x double")
    got = {(r.date, r.symbol): r.p for r in df.withColumn("p", rank_pct("x", "date")).collect()}
    assert got == {(1, "a"): 2.5 / 3, (1, "b"): 2.5 / 3, (1, "c"): 1 / 3, (1, "d"): None, (2, "a"): None}


def test_ranking_ties(spark):
    rows = [(D, "CCC", 0.5, 0.9, 0.1, 1.0), (D, "BBB", 0.5, 0.9, 0.2, 1.0), (D, "AAA", 0.5, 0.8, 0.9, 9.0)]
    df = spark.createDataFrame([(*r, True) for r in rows], "date date, symbol string, final_score double, confidence double, liquidity_stability double, avg_quote_vol_180 double, in_universe boolean")
    assert [r.symbol for r in scores.ranked(df, Params(pool_size=2)).orderBy("current_rank").collect()] == ["BBB", "CCC", "AAA"]
    assert [r.selected_flag for r in scores.ranked(df, Params(pool_size=2)).orderBy("current_rank").collect()] == [True, True, False]


def test_entry_runs(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["date", "symbol", "place", "rs_combo", "rs_risk_adj", "rank_pct", "gap_to_next"]


def test_market_cap_keeps_the_last_row(spark):
    caps = spark.createDataFrame([("a", 9.0, None, 1), ("a", 1.0, None, 2), ("b", 5.0, 3, 1), ("c", None, 1, 1)], "symbol string, market_cap_usd double, market_cap_rank int, at int")
    got = {r.symbol: r.market_cap_eligible for r in universe.market_cap_screen(caps, 4.0, order="at").collect()}
    assert got == {"A": False, "B": True, "C": False}
    assert {r.symbol for r in universe.market_cap_screen(caps, 4.0).where("market_cap_eligible").collect()} == {"A", "B"}


def test_live_candidates_keep_all_that_pass(spark):
    mode = UniverseMode(10, (1.0, 1.0, 1.0), 0.1, 0.1, 0.0)
    rows = [(f"S{i:02}", 20 if i < 30 else 9, 100.0 - i, 0.9) for i in range(40)] + [("BM", 1, 0.5, 0.9)]
    stats = spark.createDataFrame(rows, "symbol string, history_days int, v double, tradable_ratio_180 double").selectExpr("*", "v avg_quote_vol_30", "v avg_quote_vol_90", "v avg_quote_vol_180", "1.0 liquidity_stability", "90 liquid_days_90", "180 liquid_days_180")
    old = spark.createDataFrame([("S35",), ("ZZ",), ("S03",)], "symbol string")
    out = universe.live_candidates(stats, Params(benchmark="BM", mode=mode), old, 15, 24).orderBy("place").collect()
    # 9 days are enough of int(10 * 0.9), so all forty pass, more than the bound on filled places
    assert [r.symbol for r in out] == ["BM", *(f"S{i:02}" for i in range(40)), "ZZ"]
    assert (out[0].source, out[1].source, out[-1].source) == ("benchmark", "ranked", "previous")
    few = universe.live_candidates(stats, Params(benchmark="BM", mode=UniverseMode(1000, (1.0, 1.0, 1.0), 0.1, 0.1, 0.0)), old, 3, 2).orderBy("place").collect()
    assert [r.symbol for r in few] == ["BM", "S00", "S01", "S03", "S35", "ZZ"]


def test_gate_early_exits(spark):
    days = [(D + timedelta(i), 1.0 + i % 3) for i in range(40)]
    frame = lambda symbols, days, source: spark.createDataFrame([(d, s, c, c, c, c, 1.0, c, source, "p", True) for s in symbols for d, c in days], "date date, symbol string, open double, high double, low double, close double, volume double, quote_volume double, data_source string, data_provider string, is_external_source boolean")
    names = ["A", "B", "C", "E"]
    primary, external, check = frame(names, days[30:], "primary"), frame(["A", "B", "E"], days[:35], "x"), frame(["A", "B", "C"], days, "c")
    tiers = spark.createDataFrame([("B", "cautious", "thin"), ("C", "core", None), ("E", "core", "new")], "symbol string, tier string, caution string")
    says = lambda out: {r.symbol: (r.quality_status, r.final_decision, r.check_status, r.notes) for r in out.collect()}
    held = says(merge.quality(primary, external, check, tiers, ["primary", "x"], merge.Gate(min_rows_added=31), merge_cautious=False))
    assert held["A"] == ("not_whitelisted", "binance_only", "informational", "")
    assert held["B"] == ("cautious_holdout", "cautious_holdout", "informational", "thin")
    assert held["C"] == ("no_external_rows", "rejected", "informational", "")
    assert held["E"] == ("insufficient_extension", "rejected", "unavailable", "")
    off = says(merge.quality(primary, external, check, tiers, ["primary", "x"], merge.Gate(enabled=False)))
    assert off["B"] == ("merged", "approved_cautious", "informational", "thin") and off["E"] == ("merged", "approved_core", "informational", "new")


def test_ranks_are_given_before_the_mask(spark):
    rows = [(D, s, True, f, 0.5, 0.5, 1.0, n) for s, f, n in (("A", 0.9, 0), ("B", 0.8, 2), ("C", 0.7, 1), ("E", 0.6, None))]
    panel = spark.createDataFrame(rows, "date date, symbol string, in_universe boolean, final_score double, confidence double, liquidity_stability double, avg_quote_vol_180 double, prediction_window_count int")
    got = {r.symbol: (r.current_rank, r.final_score, r.selected_flag) for r in scores.ranked(panel, Params(pool_size=2)).collect()}
    assert got == {"A": (None, None, False), "B": (2, 0.8, True), "C": (3, 0.7, False), "E": (None, None, False)}


def test_contract_of_a_clean_and_a_broken_release(spark):
    ranks = [(r, "2024-01-31", s, str(i + 1), "true") for r in ("ok", "bad") for i, s in enumerate(("AUSDT", "BUSDT"))]
    ranking = spark.createDataFrame(ranks, "release string, as_of_date string, symbol string, current_rank string, selected_flag string")
    entries = {"AUSDT": "A", "BUSDT": "B"}
    row = lambda name, symbols, version: (name, "2024-01-31", ["AUSDT", "BUSDT", "CUSDT"], *("2024-01-31", version, "m", "2", "p"), symbols, entries, *("2024-01-31", "2024-01-31-m", "m", "2", "p"), entries, entries)
    fields = ["as_of_date string", "version string", "mode string", "pool_size string", "source_project string"]
    schema = ", ".join(["release string", "universe_as_of_date string", "universe_symbols array<string>", *fields, "symbols array<string>", "symbol_map map<string,string>", *(f"legacy_{f}" for f in fields), "legacy_symbols map<string,string>", "legacy_symbol_map map<string,string>"])
    releases = spark.createDataFrame([row("ok", [" ausdt", "BUSDT"], "2024-01-31-m"), row("bad", ["BUSDT", "AUSDT"], None)], schema)
    out = contract.validate(releases, ranking, F.lit(D + timedelta(31)), 0)
    assert {(r.release, r.check) for r in out.collect()} == {("ok", "stale"), ("bad", "stale"), ("bad", "missing_version"), ("bad", "empty_version"), ("bad", "pool_not_in_rank_order")}
    status = {r.release: (r.status, r.preview) for r in contract.status(releases, ranking, out).collect()}
    assert status == {"ok": ("warning", "AUSDT|BUSDT"), "bad": ("error", "AUSDT|BUSDT")}
