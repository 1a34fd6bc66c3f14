"""Decode, reject reasons and the event-time assigner (golden fixtures)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import ev, lines_df
from shopstream.operators import decode


def _reasons(spark, lines):
    d = decode.decode_lines(lines_df(spark, lines))
    return [r["reason"] for r in d.select("reason").collect()]


def test_bad_lines_reasons(spark):
    good = '{"event_id":"e1","event_type":"click","product_id":"p1"}'
    lines = [
        "   ",                                         # blank
        good[:20],                                     # truncated
        "[" + good + "]",                              # array root
        '"just a string"',                             # bare string
        good + " trailing",                            # trailing text
        '{"event_id":"e2","product_id":null}',        # null product
        '{"event_id":"e3","product_id":""}',          # empty product
        '{"event_id":"e4"}',                           # missing product
        good,
    ]
    assert _reasons(spark, lines) == ["blank", "malformed", "not_object", "not_object",
                                      "malformed", "no_product", "no_product", "no_product",
                                      None]


def test_two_objects_on_a_line_are_malformed(spark):
    good = '{"event_id":"e1","event_type":"click","product_id":"p1"}'
    lines = [good + good, good + " " + good, good + "," + good, good + "],[" + good, good + "," + good + "," + good,
             good]
    assert _reasons(spark, lines) == ["malformed"] * 5 + [None]


def test_null_line_is_blank(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert decode.decode_lines(df).first()["reason"] == "blank"


def test_duplicate_key_last_wins(spark):
    line = '{"event_id":"e1","product_id":"first","product_id":"second","event_type":"click"}'
    row = decode.decode_events(lines_df(spark, [line])).first()
    assert row["product_id"] == "second"


def test_round_trip_types(spark):
    e = ev("e1", "cart", cart_action="checkout", total_value=20.0, quantity=2, unit_price=10.0)
    row = decode.decode_events(lines_df(spark, [e])).first()
    assert row["quantity"] == 2 and row["total_value"] == 20.0 and row["unit_price"] == 10.0
    assert row["event_ms"] == 1704067230000


def test_numbers_as_text_and_junk(spark):
    e = ev("e1", "cart", cart_action="checkout", total_value="12.5")
    bad = ev("e2", "cart", cart_action="checkout", total_value="abc")
    rows = {r["event_id"]: r for r in decode.decode_events(lines_df(spark, [e, bad])).collect()}
    assert rows["e1"]["total_value"] == 12.5
    assert rows["e2"]["total_value"] is None   # kept as an event, value unusable


def test_bad_time_fallbacks(spark):
    ing = "2024-01-01T00:00:30.000Z"
    cases = {
        "null": None, "junk": "junk", "year": "2024", "clock": "12:30",
        "naive": "2024-01-01T00:00:10", "offset": "2024-01-01T00:00:10-03:00",
        "z": "2024-01-01T00:00:10.500Z",
    }
    events = [ev(k, "click", event_time=v, ingested_at=ing) for k, v in cases.items()]
    got = {r["event_id"]: r["event_ms"]
           for r in decode.decode_events(lines_df(spark, events)).collect()}
    ing_ms = 1704067230000
    assert got["null"] == got["junk"] == got["year"] == got["clock"] == ing_ms
    assert got["naive"] == 1704067210000                       # naive = UTC
    assert got["offset"] == 1704067210000 + 3 * 3600 * 1000    # offset applied
    assert got["z"] == 1704067210500


def test_processing_time_last_resort(spark):
    e = ev("e1", "click", event_time=None, ingested_at="bad")
    before = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
    ms = decode.decode_events(lines_df(spark, [e])).first()["event_ms"]
    assert ms >= before - 1000


def test_rejects_keep_line_head(spark):
    long_junk = "x" * 500
    rej = decode.rejects_of(decode.decode_lines(lines_df(spark, [long_junk]))).first()
    assert rej["reason"] == "malformed" and len(rej["line_head"]) == 200


def test_minimal_decode_missing_vs_null_product(spark):
    a = '{"event_type":"click","event_time":"2024-01-01T00:00:00Z"}'
    b = '{"event_type":"click","product_id":null,"event_time":"2024-01-01T00:00:00Z"}'
    c = '{"event_type":"click","product_id":"p9","event_time":"2024-01-01T00:00:00Z"}'
    d = '{"event_type":"click","product_id":"p9","event_time":"bad"}'
    got = sorted(r["product_id"] for r in decode.decode_minimal(lines_df(spark, [a, b, c, d])).collect())
    assert got == ["null", "p9", "unknown"]


def test_decode_plan_parses_once(spark):
    d = decode.decode_events(lines_df(spark, [ev("e1", "click")]))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Generate" in plan


def test_no_python_udf_in_decode(spark):
    d = decode.decode_events(lines_df(spark, [ev("e1", "click")]))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert d.filter(F.col("event_id") == "e1").count() == 1


def test_falsy_product_ids_are_no_product(spark):
    ids = ["0", "0.0", "-0", "0e5", "false", "[]", "{}", "[ ]", "null", '""', '"0"', '"false"', '"[]"', "7", "true", "[1]"]
    lines = spark.createDataFrame([(f'{{"event_type":"click","product_id":{i}}}',) for i in ids], "value string")
    reasons = {r.line: r.reason for r in decode.decode_lines(lines).collect()}
    got = [i for i in ids if reasons[f'{{"event_type":"click","product_id":{i}}}'] == "no_product"]
    assert got == ids[:10]
    assert {r for r in reasons.values()} == {None, "no_product"}


def test_a_rewritten_table_is_read_anew(spark, tmp_dir):
    from conftest import SF001
    from shopstream.plans import catalogue

    table = spark.read.parquet(f"{SF001}/events.parquet")
    table.where("event_id < 100").write.parquet(f"{tmp_dir}/events.parquet")
    first = catalogue.QUERIES["raw_logs"](spark, tmp_dir).count()
    table.where("event_id >= 100").write.mode("overwrite").parquet(f"{tmp_dir}/events.parquet")
    assert (first, catalogue.QUERIES["raw_logs"](spark, tmp_dir).count()) == (
        table.where("event_id < 100").count(), table.where("event_id >= 100").count())
