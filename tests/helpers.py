"""Comparison of a Spark result with SQL run by DuckDB on the same tables."""

from __future__ import annotations

import math

import pandas as pd


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([plain(r[i]) for i in order] for r in rows)


def assert_same(df, relation):
    mine, theirs = table(df.columns, df.collect()), table(relation.columns, relation.fetchall())
    assert mine[0] == theirs[0]
    assert len(mine[1]) == len(theirs[1])
    assert mine[1] == theirs[1]
