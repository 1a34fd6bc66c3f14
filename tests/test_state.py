"""Results that depend on nothing but their input: sessions, zones, widths, calls before."""

from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from conftest import SF001, SF01, ev, lines_df, write_lines

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopstream.operators import alerts, decode, serving  # noqa: E402
from shopstream.plans import catalogue, tables  # noqa: E402,F401
from shopstream.sources import jsonl  # noqa: E402


def test_two_folders_in_one_session(spark):
    first = catalogue.QUERIES["raw_logs"](spark, SF001)
    second = catalogue.QUERIES["raw_logs"](spark, SF01)
    assert (first.count(), second.count()) == (1000, 10000)
    first = catalogue.QUERIES["insights_tables"](spark, SF001)
    counts = [tuple(r) for r in catalogue.QUERIES["insights_tables"](spark, SF01).collect()]
    assert first.count() == len(counts)  # its tables are still there


def test_raw_table_of_another_folder_is_an_error(spark, tmp_dir):
    from shopstream.sinks import catalog

    for name in ("a", "b"):
        os.makedirs(f"{tmp_dir}/{name}")
        write_lines(f"{tmp_dir}/{name}/x.json", [ev(name, "click")])
    table = f"{catalog.new_database(spark)}.raw"
    assert jsonl.create_raw_logs_table(spark, table, f"{tmp_dir}/a").count() == 1
    assert jsonl.create_raw_logs_table(spark, table, f"file://{tmp_dir}/a/").count() == 1
    with pytest.raises(ValueError, match="is over"):
        jsonl.create_raw_logs_table(spark, table, f"{tmp_dir}/b")


def test_scan_returns_whole_wide_rows_in_key_order(spark):
    cells = [(f"k{k}", "f", f"q{c:02d}", str(c) if c else None) for k in range(5) for c in range(20)]
    rows = spark.createDataFrame(cells[::-1], "row_key string, family string, qualifier string, value string")
    assert [tuple(r) for r in serving.scan(rows, 3).collect()] == cells[:60]
    assert [tuple(r) for r in serving.scan(rows, None).collect()] == cells


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Sao_Paulo"])
def test_stable_gate_in_any_time_zone(spark, tmp_dir, zone):
    now = dt.datetime.now(dt.timezone.utc).timestamp()
    write_lines(f"{tmp_dir}/old.json", [ev("e1", "click")], mtime=now - 3600)
    write_lines(f"{tmp_dir}/new.json", [ev("e2", "click")], mtime=now)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        names = {r.file_name for r in jsonl.stable_files(spark, tmp_dir).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert names == {"old.json"}


def test_no_alert_without_a_product(spark):
    events = decode.decode_events(lines_df(spark, [ev(f"e{k}", "click", "prod-001") for k in range(12)]))
    odd = events.unionByName(events.withColumn("product_id", events.product_id.substr(0, 0))).unionByName(
        events.selectExpr(*[f"cast(null as string) {c}" if c == "product_id" else c for c in events.columns]))
    found = alerts.click_alerts(alerts.with_event_ts(odd)).collect()
    assert found and {r.product_id for r in found} == {"prod-001"}
