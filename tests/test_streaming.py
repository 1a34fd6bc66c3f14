"""Structured Streaming: stream = batch, restart, replay, lateness, file gating."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from conftest import ev, lines_df, write_lines
from shopstream.operators import alerts, decode, metrics
from shopstream.sinks import changelog
from shopstream.sources import jsonl
from shopstream.streaming import queries as sq

NOW = sq.Trigger(available_now=True)


def _t(sec, minute=0, hour=0):
    return f"2024-01-01T{hour:02d}:{minute:02d}:{sec:02d}.000Z"


def _stage(src, batches, base_mtime=1_600_000_000):
    """One file per batch, increasing modification times (oldest read first)."""
    os.makedirs(src, exist_ok=True)
    for i, b in enumerate(batches):
        write_lines(f"{src}/part-{i:04d}.json", b, mtime=base_mtime + 10 * i)


def _run(start, spark, src, run, **kw):
    q = start(spark, src, f"{run}/sink", f"{run}/ck", NOW, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def _rows(df, keys):
    return sorted(tuple(r) for r in df.select(*keys).collect())


def _funnel(n_files=4):
    es = []
    for i in range(40):
        kind = i % 4
        if kind == 0:
            e = ev(f"e{i}", "click", product_id=f"prod-00{i % 3}", event_time=_t(i % 60, i // 60))
        elif kind == 1:
            e = ev(f"e{i}", "cart", product_id=f"prod-00{i % 3}", cart_action="add",
                   total_value=1.25, event_time=_t(i % 60))
        elif kind == 2:
            e = ev(f"e{i}", "cart", product_id=f"prod-00{i % 3}", cart_action="checkout",
                   total_value=3.1, event_time=_t(i % 60))
        else:
            e = ev(f"e{i}", "delivery_status", product_id=f"prod-00{i % 3}",
                   delivery_status="delivered", event_time=_t(i % 60))
        e["ingested_at"] = _t(i % 60, 1)
        es.append(e)
    per = len(es) // n_files
    return es, [es[k * per:(k + 1) * per] for k in range(n_files)]


def test_stream_equals_batch_metrics(spark, tmp_dir):
    es, files = _funnel()
    batch_rows = _rows(metrics.product_metrics(decode.decode_events(lines_df(spark, es))),
                       metrics.OUTPUT_COLUMNS)
    for mfpt in (None, 1, 3):
        src, run = f"{tmp_dir}/src{mfpt}", f"{tmp_dir}/run{mfpt}"
        _stage(src, files)
        opts = {"max_files_per_trigger": mfpt} if mfpt else {}
        _run(sq.start_product_metrics, spark, src, run, **opts)
        res = sq.current(spark, f"{run}/sink",
                         sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema,
                         ["product_id"])
        assert _rows(res, metrics.OUTPUT_COLUMNS) == batch_rows


def test_restart_continues_from_checkpoint(spark, tmp_dir):
    es, files = _funnel()
    src, run = f"{tmp_dir}/src", f"{tmp_dir}/run"
    _stage(src, files[:2])
    _run(sq.start_product_metrics, spark, src, run, max_files_per_trigger=1)
    for i, b in enumerate(files[2:], start=2):
        write_lines(f"{src}/part-{i:04d}.json", b, mtime=1_600_000_000 + 10 * i)
    _run(sq.start_product_metrics, spark, src, run, max_files_per_trigger=1)
    schema = sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema
    res = sq.current(spark, f"{run}/sink", schema, ["product_id"])
    expect = metrics.product_metrics(decode.decode_events(lines_df(spark, es)))
    assert _rows(res, metrics.OUTPUT_COLUMNS) == _rows(expect, metrics.OUTPUT_COLUMNS)


def test_replayed_batch_is_written_once(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    df = spark.createDataFrame([("prod-001", 1), ("prod-002", 2)], "product_id string, n long")
    changelog.init_log(spark, path, df.schema)
    w = changelog.batch_writer(path)
    w(df, 0)
    w(df, 0)          # replay of the same batch id
    log = changelog.read_log(spark, path, df.schema)
    assert log.count() == 2
    w(df.withColumn("n", F.col("n") + 10), 1)
    cur = {r.product_id: r.n for r in changelog.current_view(
        changelog.read_log(spark, path, df.schema), ["product_id"]).collect()}
    assert cur == {"prod-001": 11, "prod-002": 12}


def test_late_row_dropped_by_windows_counted_by_totals(spark, tmp_dir):
    # batches: on-time, advance (moves watermark), spacer, late, advance
    on_time = [ev("a", "click", event_time=_t(10, 10))]
    advance = [ev("b", "click", event_time=_t(0, 30))]
    spacer = [ev("s", "cart", cart_action="add", event_time=_t(1, 30))]
    late = [ev("late", "click", event_time=_t(20, 10))]          # long behind the watermark
    advance2 = [ev("c", "click", event_time=_t(0, 50))]
    src = f"{tmp_dir}/src"
    _stage(src, [on_time, advance, spacer, late, advance2])
    run_w, run_m = f"{tmp_dir}/w", f"{tmp_dir}/m"
    qw = _run(sq.start_click_windows, spark, src, run_w, max_files_per_trigger=1)
    _run(sq.start_product_metrics, spark, src, run_m, max_files_per_trigger=1)
    assert sq.rows_dropped_by_watermark(qw) == 5      # the late click's 5 windows
    wschema = sq.click_windows_stream(sq.decoded_stream(spark, src)).schema
    wins = sq.current(spark, f"{run_w}/sink", wschema, ["product_id", "window_start", "window_end"])
    # the on-time click's 5 windows closed with 1 click each; the late one added nothing
    t10 = 1704067800000
    covering = wins.filter((F.col("window_start") <= t10) & (F.col("window_end") > t10)).collect()
    assert len(covering) == 5 and all(r.click_count == 1 for r in covering)
    mschema = sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema
    m = sq.current(spark, f"{run_m}/sink", mschema, ["product_id"]).first()
    assert m.clicks == 4             # totals keep the late click


def test_non_click_advances_watermark(spark, tmp_dir):
    clicks = [ev("c1", "click", event_time=_t(5, 1))]
    closer = [ev("d1", "delivery_status", delivery_status="created", event_time=_t(0, 30))]
    src, run = f"{tmp_dir}/src", f"{tmp_dir}/run"
    _stage(src, [clicks, closer])
    _run(sq.start_click_windows, spark, src, run, max_files_per_trigger=1)
    wschema = sq.click_windows_stream(sq.decoded_stream(spark, src)).schema
    wins = sq.current(spark, f"{run}/sink", wschema, ["product_id", "window_start", "window_end"])
    assert wins.count() == 5         # closed by the non-click event's time


def test_alert_stream_matches_batch_closed_windows(spark, tmp_dir):
    clicks = [ev(f"c{i}", "click", event_time=_t(i, 3), ingested_at=_t(i, 3)) for i in range(12)]
    closer = [ev("x", "cart", cart_action="add", event_time=_t(0, 0, 1))]
    src, run = f"{tmp_dir}/src", f"{tmp_dir}/run"
    _stage(src, [clicks, closer])
    _run(sq.start_click_alerts, spark, src, run)
    schema = sq.click_alerts_stream(sq.decoded_stream(spark, src)).schema
    got = sq.current(spark, f"{run}/sink", schema, ["row_key"])
    expect = alerts.click_alerts(decode.decode_events(lines_df(spark, clicks + closer)))
    assert _rows(got, alerts.ALERT_COLUMNS) == _rows(expect, alerts.ALERT_COLUMNS)
    assert got.count() == 5


def test_only_published_json_files_are_read(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    write_lines(f"{src}/a.json", [ev("a", "click")])
    write_lines(f"{src}/b.tmp", [ev("b", "click")])
    write_lines(f"{src}/.c.json", [ev("c", "click")])
    write_lines(f"{src}/d.json.part", [ev("d", "click")])
    run = f"{tmp_dir}/run"
    _run(sq.start_product_metrics, spark, src, run)
    schema = sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema
    assert sq.current(spark, f"{run}/sink", schema, ["product_id"]).first().clicks == 1


def test_stable_file_gate(spark, tmp_dir):
    src = f"{tmp_dir}/staging"
    os.makedirs(src)
    old = time.time() - 120
    write_lines(f"{src}/old.json", [ev("a", "click")], mtime=old)
    write_lines(f"{src}/fresh.json", [ev("b", "click")])        # still being written
    write_lines(f"{src}/old.tmp", [ev("c", "click")], mtime=old)
    got = jsonl.stable_files(spark, src).select("file_name").distinct().collect()
    assert [r.file_name for r in got] == ["old.json"]
    assert jsonl.is_temp_name("x.inprogress") and jsonl.is_temp_name(".x.json")
    assert jsonl.is_temp_name("") and not jsonl.is_temp_name("X.TMP")      # case-sensitive
    assert not jsonl.is_temp_name("ecommerce-1.json")


def test_landing_fan_out_replay_safe(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    _stage(log, [[ev(f"e{i}", "click", event_time=_t(i, 0)) for i in range(5)],
                 [ev(f"f{i}", "click", event_time="2024-01-02T00:00:00.000Z") for i in range(3)]])
    run = f"{tmp_dir}/run"
    q = sq.start_landing(spark, log, f"{run}/raw", f"{run}/staging", f"{run}/ck", NOW,
                         max_files_per_trigger=1)
    q.awaitTermination()
    raw = spark.read.text(f"{run}/raw")
    assert raw.count() == 8 and spark.read.text(f"{run}/staging").count() == 8
    assert {str(r.event_date) for r in raw.select("event_date").distinct().collect()} == {
        "2024-01-01", "2024-01-02"}
    # replaying batch 0 through the writer leaves one copy
    w = sq.landing_writer(f"{run}/raw", f"{run}/staging")
    w(spark.read.text(f"{log}/part-0000.json"), 0)
    assert spark.read.text(f"{run}/staging").count() == 8


def test_publish_stable_files_moves_once(spark, tmp_dir):
    from shopstream.sources.publish import publish_stable_files

    staging, ready = f"{tmp_dir}/staging", f"{tmp_dir}/ready"
    os.makedirs(staging)
    old = time.time() - 60
    write_lines(f"{staging}/ecommerce-1.json", [ev("a", "click")], mtime=old)
    write_lines(f"{staging}/ecommerce-2.json", [ev("b", "click")])          # fresh
    write_lines(f"{staging}/ecommerce-3.json.tmp", [ev("c", "click")], mtime=old)
    write_lines(f"{staging}/.hidden.json", [ev("d", "click")], mtime=old)
    assert publish_stable_files(spark, staging, ready) == ["ecommerce-1.json"]
    assert sorted(os.listdir(ready)) == ["ecommerce-1.json"]
    # a same-named file later: never overwritten, stays in staging
    write_lines(f"{staging}/ecommerce-1.json", [ev("z", "click")], mtime=old)
    assert publish_stable_files(spark, staging, ready) == []
    assert os.path.exists(f"{staging}/ecommerce-1.json")
    later = (time.time() + 60) * 1000
    assert publish_stable_files(spark, staging, ready, now_ms=int(later)) == ["ecommerce-2.json"]


def test_gate_publishes_what_landing_staged(spark, tmp_dir):
    from shopstream.sources.publish import publish_stable_files

    log, run = f"{tmp_dir}/log", f"{tmp_dir}/run"
    _stage(log, [[ev(f"e{i}", "click", event_time=_t(i, 0)) for i in range(5)],
                 [ev(f"f{i}", "click", event_time=_t(i, 0)) for i in range(3)]])
    sq.start_landing(spark, log, f"{run}/raw", f"{run}/staging", f"{run}/ck", NOW,
                     max_files_per_trigger=1).awaitTermination()
    assert jsonl.read_events_json(spark, f"{run}/raw").count() == 8
    assert publish_stable_files(spark, f"{run}/staging", f"{run}/ready") == []       # fresh
    names = publish_stable_files(spark, f"{run}/staging", f"{run}/ready", stable_seconds=0)
    assert len(names) == 2 and all(n.startswith("batch_id=") and n.endswith(".json") for n in names)
    assert spark.read.option("pathGlobFilter", "*.json").text(f"{run}/ready").count() == 8
    # a replayed batch is staged again but not published a second time
    sq.landing_writer(None, f"{run}/staging")(spark.read.text(f"{log}/part-0000.json"), 0)
    assert publish_stable_files(spark, f"{run}/staging", f"{run}/ready", stable_seconds=0) == []


def test_watch_staging_rescans_until_stopped(spark, tmp_dir):
    import threading
    from shopstream.sources.publish import watch_staging

    staging, ready, stop = f"{tmp_dir}/staging", f"{tmp_dir}/ready", threading.Event()
    os.makedirs(f"{staging}/_temporary/0")
    write_lines(f"{staging}/_temporary/0/a.json", [ev("a", "click")])
    threading.Timer(1.0, lambda: write_lines(f"{staging}/b.json", [ev("b", "click")])).start()
    threading.Timer(3.0, stop.set).start()
    assert watch_staging(spark, staging, ready, stop, stable_seconds=0, rescan_seconds=0.3) == 1
    assert os.listdir(ready) == ["b.json"]


def test_continuous_trigger_picks_up_published_files(spark, tmp_dir):
    src, run = f"{tmp_dir}/ready", f"{tmp_dir}/run"
    os.makedirs(src)
    q = sq.start_product_metrics(spark, src, f"{run}/sink", f"{run}/ck",
                                 sq.Trigger(processing_time="200 milliseconds"))
    try:
        for i in range(2):
            write_lines(f"{src}/.f{i}.json", [ev(f"e{i}", "click")])
            os.rename(f"{src}/.f{i}.json", f"{src}/f{i}.json")     # atomic publish
            deadline = time.time() + 60
            while time.time() < deadline:
                if sum(p["numInputRows"] for p in q.recentProgress) >= i + 1:
                    break
                time.sleep(0.1)
        assert sum(p["numInputRows"] for p in q.recentProgress) == 2
    finally:
        q.stop()
    schema = sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema
    assert sq.current(spark, f"{run}/sink", schema, ["product_id"]).first().clicks == 2


def test_compaction_keeps_current_rows(spark, tmp_dir):
    path, out = f"{tmp_dir}/log", f"{tmp_dir}/compacted"
    df = spark.createDataFrame([("p1", 1), ("p2", 2)], "product_id string, n long")
    changelog.init_log(spark, path, df.schema)
    w = changelog.batch_writer(path)
    w(df, 0)
    w(spark.createDataFrame([("p1", 5)], df.schema), 1)
    changelog.compact(spark, path, out, df.schema, ["product_id"])
    log = changelog.read_log(spark, out, df.schema)
    assert log.count() == 2
    assert {r.product_id: r.n for r in changelog.current_view(log, ["product_id"]).collect()} == \
        {"p1": 5, "p2": 2}


def test_state_partitions_fixed_at_start_and_session_restored(spark, tmp_dir):
    es, files = _funnel()
    src, run = f"{tmp_dir}/src", f"{tmp_dir}/run"
    _stage(src, files)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    res = sq.product_metrics_stream(sq.decoded_stream(spark, src))
    q = sq.start_upsert(res, f"{run}/sink", f"{run}/ck", "update", NOW, state_partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    parts = [d for d in os.listdir(f"{run}/ck/state/0") if d.isdigit()]
    assert len(parts) == 3


def test_landing_rolls_as_two_queries(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    _stage(log, [[ev(f"e{i}", "click") for i in range(4)], [ev("f", "click")]])
    run = f"{tmp_dir}/run"
    qr, qs = sq.start_landing_rolls(spark, log, f"{run}/raw", f"{run}/staging", f"{run}/ck",
                                    NOW, NOW)
    qr.awaitTermination()
    qs.awaitTermination()
    assert spark.read.text(f"{run}/raw").count() == 5
    assert spark.read.text(f"{run}/staging").count() == 5
    assert os.path.isdir(f"{run}/ck/raw") and os.path.isdir(f"{run}/ck/staging")


def test_processed_files_are_archived(spark, tmp_dir):
    src, arch, run = f"{tmp_dir}/ready", f"{tmp_dir}/archive", f"{tmp_dir}/run"
    _stage(src, [[ev(f"e{i}", "click")] for i in range(3)])
    q = sq.start_product_metrics(spark, src, f"{run}/sink", f"{run}/ck", NOW,
                                 max_files_per_trigger=1, archive_dir=arch)
    q.awaitTermination()
    deadline = time.time() + 20
    archived = []
    while time.time() < deadline:
        archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".json")]
        if archived:
            break
        time.sleep(0.2)
    assert archived                                      # moved out of the read folder
    assert not set(archived) & set(os.listdir(src))
    schema = sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema
    assert sq.current(spark, f"{run}/sink", schema, ["product_id"]).first().clicks == 3


def test_late_row_still_counts_in_windows_that_are_open(spark, tmp_dir):
    """Lateness is per window: closed windows drop the row, open ones count it."""
    on_time = [ev("a", "click", event_time=_t(10, 10))]                         # 00:10:10
    advance = [ev("x", "cart", cart_action="add", event_time=_t(15, 12))]      # wm -> 00:12:00
    spacer = [ev("s", "cart", cart_action="add", event_time=_t(16, 12))]
    late = [ev("b", "click", event_time=_t(30, 10))]                           # 00:10:30
    close = [ev("c", "cart", cart_action="add", event_time=_t(0, 40))]
    src, run = f"{tmp_dir}/src", f"{tmp_dir}/run"
    _stage(src, [on_time, advance, spacer, late, close])
    q = _run(sq.start_click_windows, spark, src, run, max_files_per_trigger=1)
    assert sq.rows_dropped_by_watermark(q) == 2            # [06,11) and [07,12) had closed
    schema = sq.click_windows_stream(sq.decoded_stream(spark, src)).schema
    wins = {(r.window_start - 1704067200000) // 60000: r.click_count for r in
            sq.current(spark, f"{run}/sink", schema, ["product_id", "window_start", "window_end"],
                       append_only=True).collect()}
    assert wins == {6: 1, 7: 1, 8: 2, 9: 2, 10: 2}


def test_landed_events_give_equal_windows_in_any_number_of_batches(spark, tmp_dir):
    src = jsonl.landed_events(spark, "/root/testdata/sf0.001")
    schema = sq.click_windows_stream(sq.decoded_stream(spark, src)).schema
    keys = ["product_id", "window_start", "window_end"]
    seen = []
    for per_trigger in (1, 3, 10):
        run = f"{tmp_dir}/run{per_trigger}"
        q = _run(sq.start_click_windows, spark, src, run, max_files_per_trigger=per_trigger)
        assert sq.rows_dropped_by_watermark(q) == 0
        seen.append(_rows(sq.current(spark, f"{run}/sink", schema, keys, append_only=True), schema.names))
    assert seen[0] and seen[0] == seen[1] == seen[2]
