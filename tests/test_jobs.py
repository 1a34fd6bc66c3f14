"""End-to-end jobs: the two-flow streaming job and the batch ETL job."""

from __future__ import annotations

import os

from conftest import SF001
from shopstream.operators import alerts, batch, metrics
from shopstream.plans.batch_job import run_etl
from shopstream.session import new_run_dir
from shopstream.sources import adapter, jsonl
from shopstream.streaming import job as sjob
from shopstream.streaming import queries as sq


def _landed(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    jsonl.write_events_json(adapter.driver_events(spark, SF001), path)
    return path


def test_stream_job_two_flows(spark, tmp_dir):
    src = _landed(spark, tmp_dir)
    out = f"{tmp_dir}/out"
    j = sjob.start_job(spark, src, out, sq.Trigger(available_now=True),
                       size="1 day", slide="6 hours", threshold=2)
    j.await_all()
    assert os.path.isdir(f"{out}/_checkpoints/product_metrics")
    ev = alerts.with_event_ts(adapter.driver_events(spark, SF001))
    m = sjob.current_metrics(spark, out, src)
    expect = metrics.product_metrics(ev)
    cols = list(metrics.OUTPUT_COLUMNS)
    assert sorted(map(tuple, m.select(*cols).collect())) == \
        sorted(map(tuple, expect.select(*cols).collect()))
    a = sjob.current_alerts(spark, out, src, "1 day", "6 hours", 2)
    max_ms = ev.agg({"event_ms": "max"}).first()[0]
    closed = alerts.click_alerts(ev, "1 day", "6 hours", 2).filter(
        f"window_end <= {max_ms - 15000}")
    acols = list(alerts.ALERT_COLUMNS)
    assert a.count() > 0
    assert sorted(map(tuple, a.select(*acols).collect())) == \
        sorted(map(tuple, closed.select(*acols).collect()))


def test_batch_etl_job(spark, tmp_dir):
    src = _landed(spark, tmp_dir)
    db = jsonl.unique_name("t_etl")
    res = run_etl(spark, src, db, db_location=new_run_dir(spark, "db"))
    assert res.events == 1000
    names = {r.tableName for r in res.tables.collect()}
    assert {"insights_cliques", "insights_vendas", "raw_logs", "product_metrics_batch"} <= names
    ev = adapter.driver_events(spark, SF001)
    top = [tuple(r) for r in res.top_clicked.collect()]
    expect = [tuple(r) for r in batch.top_clicked(batch.clicks_by_product(batch.clean(ev))).collect()]
    assert top == expect
    assert res.product_totals.count() == 8


def test_stream_job_decode_once_matches_and_quarantines(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    ev_ = adapter.driver_events(spark, SF001)
    jsonl.write_events_json(ev_, src)
    with open(f"{src}/extra.json", "w") as fh:                   # bad lines in the feed
        fh.write("   \n{not json\n[1, 2]\n" + '{"event_id":"x","event_type":"click"}\n')
    out = f"{tmp_dir}/out"
    j = sjob.start_job(spark, src, out, sq.Trigger(available_now=True),
                       size="1 day", slide="6 hours", threshold=2, decode_once=True)
    j.await_all()
    cols = list(metrics.OUTPUT_COLUMNS)
    m = sjob.current_metrics(spark, out, src)
    assert sorted(map(tuple, m.select(*cols).collect())) == \
        sorted(map(tuple, metrics.product_metrics(ev_).select(*cols).collect()))
    rej = {r.reason: r["count"] for r in
           sq.quarantine(spark, f"{out}/decoded").groupBy("reason").count().collect()}
    assert rej == {"blank": 1, "malformed": 1, "not_object": 1, "no_product": 1}
    a = sjob.current_alerts(spark, out, src, "1 day", "6 hours", 2)
    assert a.count() > 0


def test_decode_once_job_restarts_exactly_once(spark, tmp_dir):
    ev_ = adapter.driver_events(spark, SF001)
    src, out = f"{tmp_dir}/ready", f"{tmp_dir}/out"
    first, second = ev_.filter("event_seq % 2 = 0"), ev_.filter("event_seq % 2 = 1")
    jsonl.write_events_json(first, f"{src}/a")
    j = sjob.start_job(spark, f"{src}/*", out, sq.Trigger(available_now=True), decode_once=True)
    j.await_all()
    jsonl.write_events_json(second, f"{src}/b")                   # new files arrive
    j = sjob.start_job(spark, f"{src}/*", out, sq.Trigger(available_now=True), decode_once=True)
    j.await_all()
    cols = list(metrics.OUTPUT_COLUMNS)
    got = sjob.current_metrics(spark, out, f"{src}/*")
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, metrics.product_metrics(ev_).select(*cols).collect()))
    decoded = spark.read.parquet(f"{out}/decoded").filter("outcome = 'event'")
    assert decoded.count() == 1000                                   # no line decoded twice
