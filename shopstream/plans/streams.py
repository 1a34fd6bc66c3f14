"""Registered streaming queries.

Streams run over the driver events landed as JSON-lines files in the shared
work folder, with ``availableNow`` (bounded run in several micro-batches, then
stop), their own checkpoint, and a change-log sink; the returned DataFrame
reads the sink's current view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions import digest
from shopstream.operators import alerts, batch, metrics
from shopstream.plans.catalogue import DAY_SIZE, DAY_SLIDE, events, register
from shopstream.schema import EVENT
from shopstream.session import default_parallelism, new_run_dir
from shopstream.sources import jsonl
from shopstream.sources.publish import age_files, order_files, publish_stable_files
from shopstream.streaming import queries as sq

AVAILABLE_NOW = sq.Trigger(available_now=True)


def _run(spark: SparkSession, sf_dir: str, label: str, build, output_mode: str,
         keys: list[str], fields: tuple[str, ...] | None = None) -> DataFrame:
    """Land the events, run ``build(decoded_stream)`` to completion, read the sink."""
    return _run_over(spark, jsonl.landed_events(spark, sf_dir), label, build, output_mode, keys, fields)


def _run_over(spark: SparkSession, source: str, label: str, build, output_mode: str,
              keys: list[str], fields: tuple[str, ...] | None = None) -> DataFrame:
    """Run ``build(decoded_stream)`` over a folder of published files to completion, read the sink."""
    run = new_run_dir(spark, label)
    result = build(sq.decoded_stream(spark, source, fields,
                                     max_files_per_trigger=jsonl.files_per_trigger(spark)))
    # state partitions sized to the cluster's task slots, not the session default
    q = sq.start_upsert(result, f"{run}/sink", f"{run}/checkpoint", output_mode, AVAILABLE_NOW,
                        state_partitions=default_parallelism(spark))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {label} failed: {q.exception()}")
    return sq.current(spark, f"{run}/sink", result.schema, keys,
                      append_only=output_mode == "append")


@register("stream_product_metrics")
def q_stream_product_metrics(spark, sf_dir):
    return _run(spark, sf_dir, "stream-metrics", sq.product_metrics_stream, "update",
                ["product_id"], metrics.INPUT_FIELDS).select(*metrics.OUTPUT_COLUMNS)


@register("stream_click_windows")
def q_stream_click_windows(spark, sf_dir):
    return _run(spark, sf_dir, "stream-windows", sq.click_windows_stream, "append",
                ["product_id", "window_start", "window_end"],
                alerts.INPUT_FIELDS).select(*alerts.WINDOW_COLUMNS)


@register("stream_click_alerts")
def q_stream_click_alerts(spark, sf_dir):
    return _run(spark, sf_dir, "stream-alerts", sq.click_alerts_stream, "append",
                ["row_key"], alerts.INPUT_FIELDS).select(*alerts.ALERT_COLUMNS)


@register("stream_click_alerts_1d")
def q_stream_click_alerts_1d(spark, sf_dir):
    def build(ev):
        return sq.click_alerts_stream(ev, DAY_SIZE, DAY_SLIDE, 10)
    return _run(spark, sf_dir, "stream-alerts-1d", build, "append",
                ["row_key"], alerts.INPUT_FIELDS).select(*alerts.ALERT_COLUMNS)


@register("stream_decode_rejects")
def q_stream_decode_rejects(spark, sf_dir):
    """Damaged lines through the streaming decode stage; quarantine rows per reason."""
    lines_dir = jsonl.landed_damaged_lines(spark, sf_dir)
    run = new_run_dir(spark, "stream-decode")
    q = sq.start_decode(spark, lines_dir, f"{run}/decoded", f"{run}/checkpoint", AVAILABLE_NOW,
                        glob="*.txt", max_files_per_trigger=jsonl.files_per_trigger(spark))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"decode stream failed: {q.exception()}")
    return (sq.quarantine(spark, f"{run}/decoded").groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n")))


@register("stream_decode_once_metrics")
def q_stream_decode_once_metrics(spark, sf_dir):
    """The two-flow job with the decode-once stage; current product metrics."""
    from shopstream.streaming import job as sjob

    source = jsonl.landed_events(spark, sf_dir)
    out = new_run_dir(spark, "stream-job")
    j = sjob.start_job(spark, source, out, AVAILABLE_NOW, decode_once=True,
                       state_partitions=default_parallelism(spark),
                       max_files_per_trigger=jsonl.files_per_trigger(spark))
    j.await_all()
    return sjob.current_metrics(spark, out, source).select(*metrics.OUTPUT_COLUMNS)


@register("stream_job_rejects")
def q_stream_job_rejects(spark, sf_dir):
    """Broken lines that the default two-flow job reports, per reason."""
    from shopstream.streaming import job as sjob

    out = new_run_dir(spark, "job-rejects")
    j = sjob.start_job(spark, jsonl.landed_damaged_lines(spark, sf_dir), out, AVAILABLE_NOW, glob="*.txt",
                       state_partitions=default_parallelism(spark),
                       max_files_per_trigger=jsonl.files_per_trigger(spark))
    j.await_all()
    return sjob.current_rejects(spark, out).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("stream_job_alerts")
def q_stream_job_alerts(spark, sf_dir):
    """Alerts of the default two-flow job (no decode stage), read from its sink."""
    from shopstream.streaming import job as sjob

    source, out = jsonl.landed_events(spark, sf_dir), new_run_dir(spark, "job-alerts")
    j = sjob.start_job(spark, source, out, AVAILABLE_NOW, DAY_SIZE, DAY_SLIDE, 10,
                       state_partitions=default_parallelism(spark),
                       max_files_per_trigger=jsonl.files_per_trigger(spark))
    j.await_all()
    return sjob.current_alerts(spark, out, source, DAY_SIZE, DAY_SLIDE, 10).select(*alerts.ALERT_COLUMNS)


@register("stream_job_serving")
def q_stream_job_serving(spark, sf_dir):
    """All serving cells that the default two-flow job stored."""
    from shopstream.sinks import serving_store
    from shopstream.streaming import job as sjob

    out = new_run_dir(spark, "job-serving")
    j = sjob.start_job(spark, jsonl.landed_events(spark, sf_dir), out, AVAILABLE_NOW, DAY_SIZE, DAY_SLIDE, 10,
                       state_partitions=default_parallelism(spark), compact_every=2,
                       max_files_per_trigger=jsonl.files_per_trigger(spark))
    j.await_all()
    return serving_store.read(spark, f"{out}/serving/metrics").unionByName(
        serving_store.read(spark, f"{out}/serving/alerts"))


LATE_PARTS = 5


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Rows behind the watermark: the events arrive in five parts, each of which spans the whole time.

    A part is one micro-batch of any number of files; the stream resumes from its
    checkpoint for each.
    """
    run = new_run_dir(spark, "late-rows")
    ev = events(spark, sf_dir)
    for part in range(LATE_PARTS):
        jsonl.write_events_json(ev.where(F.col("event_seq") % LATE_PARTS == part), f"{run}/in/part-{part}")
        q = sq.start_late_rows(spark, f"{run}/in/*", f"{run}/late", f"{run}/checkpoint", AVAILABLE_NOW)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"late rows failed: {q.exception()}")
    return sq.late_rows(spark, f"{run}/late").drop("event_type")


@register("stable_gate")
def q_stable_gate(spark, sf_dir):
    """Events that the gate publishes: files untouched for 15 s, neither younger nor temporary ones."""
    import time

    run = new_run_dir(spark, "stable-gate")
    ev = events(spark, sf_dir)
    staging, ready = f"{run}/staging", f"{run}/ready"
    jsonl.write_events_json(ev.where("event_seq % 2 = 0"), f"{staging}/settled")
    order_files(spark, f"{staging}/settled")
    settled = int(time.time() * 1000)
    # the young files are written a good while after the others, by the gate's clock
    time.sleep(0.1)
    jsonl.write_events_json(ev.where("event_seq % 2 = 1"), f"{staging}/growing")
    age_files(spark, f"{staging}/settled", settled - 60_000)
    publish_stable_files(spark, staging, ready, stable_seconds=jsonl.STABLE_SECONDS, now_ms=settled)
    return jsonl.read_events_json(spark, ready).select("event_id", "product_id", "event_type")


def _land(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Fan-out of the landed log into its two sinks: (raw archive, staging)."""
    log_dir = jsonl.landed_events(spark, sf_dir)
    run = new_run_dir(spark, "stream-landing")
    raw, staging = f"{run}/raw", f"{run}/staging"
    q = sq.start_landing(spark, log_dir, raw, staging, f"{run}/checkpoint", AVAILABLE_NOW,
                         max_files_per_trigger=jsonl.files_per_trigger(spark))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"landing failed: {q.exception()}")
    return raw, staging


@register("pipeline_product_metrics")
def q_pipeline_product_metrics(spark, sf_dir):
    """Land, gate, stream: staged files are published and the metrics flow reads them."""
    _, staging = _land(spark, sf_dir)
    ready = f"{new_run_dir(spark, 'pipeline')}/ready"
    # landing has ended, so every staged file is finished
    publish_stable_files(spark, staging, ready, stable_seconds=0)
    return _run_over(spark, ready, "pipeline-metrics", sq.product_metrics_stream, "update",
                     ["product_id"], metrics.INPUT_FIELDS).select(*metrics.OUTPUT_COLUMNS)


@register("landed_sales")
def q_landed_sales(spark, sf_dir):
    """Land, ETL: sales insight over the raw archive that landing writes."""
    raw, _ = _land(spark, sf_dir)
    return batch.sales(batch.clean(jsonl.read_events_json(spark, raw)))


@register("stream_landing")
def q_stream_landing(spark, sf_dir):
    """Lines in each sink of the landing fan-out, and the digest of their events."""
    raw, staging = _land(spark, sf_dir)
    events_of = {name: spark.read.text(p).select(F.from_json("value", EVENT).alias("e")).select("e.*")
                 for name, p in (("raw", raw), ("staging", staging))}
    return digest.summary(events_of, "sink")


@register("reconcile_tables")
def q_reconcile_tables(spark, sf_dir):
    """Reconciliation of what is stored: the two-flow job's metrics table against the CTAS totals table."""
    from shopstream.operators import quality
    from shopstream.plans.tables import q_product_totals_table
    from shopstream.streaming import job as sjob

    source, out = jsonl.landed_events(spark, sf_dir), new_run_dir(spark, "job-reconcile")
    j = sjob.start_job(spark, source, out, AVAILABLE_NOW, compact_every=2,
                       state_partitions=default_parallelism(spark),
                       max_files_per_trigger=jsonl.files_per_trigger(spark))
    j.await_all()
    return quality.reconcile(sjob.current_metrics(spark, out, source), q_product_totals_table(spark, sf_dir))


@register("reconcile_stream")
def q_reconcile_stream(spark, sf_dir):
    """Stream/batch reconciliation over the real streaming sink vs the batch totals."""
    from shopstream.operators import quality

    running = q_stream_product_metrics(spark, sf_dir)
    return quality.reconcile(running, batch.product_metrics_batch(events(spark, sf_dir)))
