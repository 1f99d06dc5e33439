"""Publication in versions: a broken release leaves the published one, partitions move one by one, and names decide what is opened."""

import pytest
from pyspark.sql import functions as F

from panelrank.operators.review import fingerprint
from panelrank.sources import published

SCHEMA = "as_of_date string, symbol string, rank int"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def ranks(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def read(spark, path):
    return sorted(map(tuple, published.current(spark, path).select("as_of_date", "symbol", "rank").collect()))


def whole(table):
    return table.agg(F.lit("ranks from 1").alias("check"), F.coalesce(F.min("rank") == 1, F.lit(False)).alias("ok"))


def test_a_broken_release_leaves_the_published_one(spark, path):
    assert published.current(spark, path) is None
    good = ranks(spark, ("2024-01-31", "a", 1), ("2024-01-31", "b", 2))
    assert published.release(good, path, "v1", "as_of_date", whole).first()["ok"]
    bad = published.release(ranks(spark, ("2024-01-31", "c", 7)), path, "v2", "as_of_date", whole)
    assert [tuple(r) for r in bad.collect()] == [("ranks from 1", False)]
    assert read(spark, path) == [("2024-01-31", "a", 1), ("2024-01-31", "b", 2)]
    assert published.release(ranks(spark, ("2024-01-31", "c", 1)), path, "v2", "as_of_date", whole).first()["ok"]
    assert read(spark, path) == [("2024-01-31", "c", 1)]
    assert published.state(spark, path)["versions"] == ["v1", "v2"]


def test_fingerprint_of_the_published_rows(spark, path):
    good = ranks(spark, ("2024-01-31", "a", 1), ("2024-02-29", "b", 1))
    published.release(good, path, "v1", "as_of_date", whole)
    assert published.state(spark, path)["fingerprint"] == fingerprint(good, good.columns).first().asDict()


def test_fingerprint_of_more_rows_than_63_bits_hold(spark):
    """200,000 hashes of 48 bits: their sum passes 63 bits and is taken modulo 2^64."""
    import hashlib

    n = 200_000
    hashes = [int(hashlib.sha256(f'{{"id":{i}}}'.encode()).hexdigest()[:12], 16) for i in range(n)]
    total, x = sum(hashes), 0
    for h in hashes:
        x ^= h
    assert total > 2**63
    row = fingerprint(spark.range(n), ["id"]).first()
    assert tuple(row) == (n, (total + 2**63) % 2**64 - 2**63, x)
    assert tuple(fingerprint(spark.range(0), ["id"]).first()) == (0, 0, 0)


def test_partitions_of_a_version_replace_their_own(spark, path):
    published.release(ranks(spark, ("2024-01-31", "a", 1), ("2024-02-29", "b", 1)), path, "v1", "as_of_date", whole)
    published.release(ranks(spark, ("2024-02-29", "c", 1), ("2024-03-31", "d", 1)), path, "v2", "as_of_date", whole, whole=False)
    assert read(spark, path) == [("2024-01-31", "a", 1), ("2024-02-29", "c", 1), ("2024-03-31", "d", 1)]
    only = published.current(spark, path, ["as_of_date=2024-03-31"])
    assert len(only.inputFiles()) == 1 and only.count() == 1
    assert published.current(spark, path, ["as_of_date=1999-01-01"]).count() == 0


def test_what_is_staged_is_not_read(spark, path):
    published.release(ranks(spark, ("2024-01-31", "a", 1)), path, "v1", "as_of_date")
    published.stage(ranks(spark, ("2024-01-31", "z", 1)), path, "v2", "as_of_date")
    assert read(spark, path) == [("2024-01-31", "a", 1)]
    assert not published.publish(spark, path, "v1", "as_of_date", SCHEMA)  # published before


def test_an_empty_version_empties_the_table(spark, path):
    published.release(ranks(spark, ("2024-01-31", "a", 1)), path, "v1", "as_of_date")
    published.release(ranks(spark, ("2024-01-31", "a", 1)).where("false"), path, "v2", "as_of_date")
    assert published.current(spark, path).count() == 0
