"""All queries of the library and their SQL."""

from __future__ import annotations

from panelrank.plans import q_contract, q_merge, q_models, q_panel, q_returns, q_review, q_runs, q_sources, q_streams, q_tracks, q_window_models

MODULES = (q_panel, q_returns, q_merge, q_models, q_contract, q_sources, q_review, q_streams, q_window_models, q_runs, q_tracks)


def registered() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for module in MODULES:
        queries |= module.QUERIES
        oracles |= module.ORACLES
    return queries, oracles
