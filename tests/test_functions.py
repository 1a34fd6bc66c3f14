"""Scalar Column helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopstream.functions import columns as C
from shopstream.sources.adapter import pad_sql


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col.alias("x")).collect()]


def test_zero_pad_never_truncates(spark):
    data = [(7,), (12345678,), (123456789,)]
    assert _one(spark, C.zero_pad("n", 8), data, "n long") == ["00000007", "12345678", "123456789"]
    df = spark.createDataFrame(data, "n long").selectExpr(f"{pad_sql('n', 8)} AS x")
    assert [r.x for r in df.collect()] == ["00000007", "12345678", "123456789"]


def test_truthy(spark):
    got = _one(spark, C.truthy("s"), [(None,), ("",), (" ",), ("a",)], "s string")
    assert got == [None, None, " ", "a"]


def test_money_fallback_and_format(spark):
    got = _one(spark, C.to_money("v"), [("12.5",), ("abc",), (None,), ("NaN",), ("1e400",), ("1e17",), ("0.004",)],
               "v string")
    assert got == [12.5, 0.0, 0.0, 0.0, 0.0, 1e17, 0.004]
    fm = _one(spark, C.fmt_money("d"), [(1234567.005,), (0.0,), (2.5,), (1e21,), (None,)], "d double")
    assert fm == ["1234567.01", "0.00", "2.50", "1000000000000000000000.00", None]


def test_exact_sums_are_correctly_rounded(spark):
    """Against math.fsum, in shuffled order, with carries, signs, ties and values beyond the bins."""
    import math
    import random

    from shopstream.functions import exact

    rnd = random.Random(1)
    groups = [[1e17, 1e21, 0.004, -1e17], [0.1] * 10, [0.0, -0.0], [-5.5], [1e300, 1.0], [1e16, 1.0, -1e16],
              [2.0 ** -127, 1.0], [1 + 2 ** -52, 2.0 ** -53], [1.0, 2.0 ** -53], [1.0, 2.0 ** -53, 2.0 ** -100],
              [-1.0, -2.0 ** -53, -2.0 ** -100], [float("nan"), 3.0], [2.0 ** 53, 1.0, 1.0], [1e-300, 2.0]]
    for _ in range(200):
        reach = rnd.choice([3, 30, 120])
        groups.append([rnd.choice([-1, 1]) * rnd.random() * 2.0 ** rnd.randrange(-reach, reach)
                       for _ in range(rnd.randrange(1, 40))])
    rows = [(k, float(v)) for k, g in enumerate(groups) for v in g] + [(9999, None)]
    rnd.shuffle(rows)
    df = exact.with_parts(spark.createDataFrame(rows, "g int, v double").repartition(5), p="v")
    got = {r.g: (r.s, r.m) for r in df.groupBy("g").agg(exact.exact_sum("p").alias("s"),
                                                        exact.exact_avg("p").alias("m")).collect()}
    for k, g in enumerate(groups):
        finite = [v for v in g if v == v]
        assert got[k] == (math.fsum(finite), math.fsum(finite) / len(finite)), g
    assert got[9999] == (None, None)


def test_money_has_no_cap(spark):
    from shopstream.operators import batch, metrics

    rows = [(f"e{k}", "cart", "p", "c", "checkout", v, v, None, "t", k)
            for k, v in enumerate([1e17, 1e21, 0.004, -1e17])]
    ev = spark.createDataFrame(rows, "event_id string, event_type string, product_id string, category string, "
                               "cart_action string, total_value double, unit_price double, delivery_status string, "
                               "event_time string, ingested_ms long")
    want = 1e21 + 0.004
    assert batch.sales(ev).first()[2:] == (4, want, want / 4)
    assert batch.product_metrics_batch(ev).first().total_revenue == want
    assert metrics.product_metrics(ev).first().orders_value == want


def test_iso_parse_and_format(spark):
    rows = [("2024-01-01T00:00:07.179Z",), ("2024-01-01 00:00:07",), ("2024-01-01T03:00:00+03:00",),
            ("2024",), ("12:30",), (None,)]
    ms = _one(spark, F.unix_millis(C.parse_iso_ts("s")), rows, "s string")
    assert ms == [1704067207179, 1704067207000, 1704067200000, None, None, None]
    back = _one(spark, C.iso_ms(F.col("m")), [(1704067207179,)], "m long")
    assert back == ["2024-01-01T00:00:07.179Z"]


def test_last_and_first_by_arrival(spark):
    df = spark.createDataFrame(
        [("k", "a", 1, "e1"), ("k", "", 3, "e3"), ("k", "b", 2, "e2"), ("k", None, 4, "e4"),
         ("j", "", 1, "x")],
        "k string, v string, ingested_ms long, event_id string")
    order = C.arrival_key()
    got = {r.k: (r.last, r.first) for r in df.groupBy("k").agg(
        C.last_by_arrival("v", order, "none").alias("last"),
        C.first_by_arrival("v", order, "none").alias("first")).collect()}
    assert got == {"k": ("b", "a"), "j": ("none", "none")}


def test_count_when_is_zero_not_null(spark):
    df = spark.createDataFrame([("a",)], "t string")
    assert df.agg(C.count_when(F.col("t") == "zzz").alias("n")).first().n == 0
