"""Content digest: order-independent, and red when one cell changes."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from shopstream.functions import digest

SCHEMA = "name string, n long, price double, at timestamp"
ROWS = [("a", 1, 1.5, None), ("a", 1, 1.5, None), ("", 2, -0.0, None), (None, None, None, None), ("x:1", 3, 1e17, None)]


def _digest(df):
    return df.agg(digest.content_digest(df).alias("d")).first()["d"]


def _plain(rows):
    def value(v):
        text = None if v is None else f"{v + 0.0:.6f}" if isinstance(v, float) else str(v)
        return "-" if text is None else f"{len(text.encode())}:{text}"
    # columns by name: at, n, name, price
    texts = ["".join(value(v) for v in (at, n, name, price)) for name, n, price, at in rows]
    return str(sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts))


def test_equals_plain_computation_in_any_order(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert _digest(df) == _plain(ROWS)
    assert _digest(spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(5)) == _plain(ROWS)
    assert _digest(df.select("price", "at", "name", "n")) == _plain(ROWS)
    assert _digest(df.limit(0)) == "0"


@pytest.mark.parametrize("row, changed", [
    (0, ("b", 1, 1.5, None)), (0, ("a", 2, 1.5, None)), (0, ("a", 1, 1.51, None)), (2, (None, 2, 0.0, None)),
    (3, ("", None, None, None)), (4, ("x", 13, 1e17, None))])
def test_one_changed_cell_shows(spark, row, changed):
    rows = [*ROWS[:row], changed, *ROWS[row + 1:]]
    assert _digest(spark.createDataFrame(rows, SCHEMA)) != _plain(ROWS)


def test_lost_and_repeated_rows_show(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert len({_digest(df), _digest(df.distinct()), _digest(df.union(df.limit(1)))}) == 3


def test_moved_value_shows_though_counts_and_sums_stay(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    swapped = df.withColumn("v", F.when(F.col("k") == 1, 2).when(F.col("k") == 2, 1).otherwise(F.col("v")).cast("long"))
    found = {r["side"]: (r["n"], r["digest"]) for r in digest.summary({"a": df, "b": swapped}, "side").collect()}
    assert found["a"][0] == found["b"][0] == 100 and found["a"][1] != found["b"][1]
