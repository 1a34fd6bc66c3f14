"""The streaming job: two flows over one folder of JSON-lines files.

Flow 1 keeps running product metrics (update mode, change-log upsert); flow
2 raises sliding-window click alerts (watermark, append mode, keyed sink).
Each flow is its own ``StreamingQuery`` with its own checkpoint under
``<out_dir>``, so either can restart independently after a failure.

    python -m shopstream.streaming.job <input_dir> <out_dir> [--available-now]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopstream.schema import ALERT_THRESHOLD, WATERMARK_DELAY, WINDOW_SIZE, WINDOW_SLIDE
from shopstream.operators import alerts, metrics, serving
from shopstream.sinks import pointer, serving_store
from shopstream.sinks.changelog import COMPACT_EVERY
from shopstream.streaming import queries as sq


@dataclass
class StreamJob:
    metrics: StreamingQuery
    alerts: StreamingQuery
    out_dir: str
    decode: StreamingQuery | None = None
    rejects: StreamingQuery | None = None
    late: StreamingQuery | None = None

    @property
    def queries(self) -> list[StreamingQuery]:
        return [q for q in (self.decode, self.metrics, self.alerts, self.rejects, self.late) if q is not None]

    def await_all(self) -> None:
        for q in self.queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"{q.name or q.id} failed: {q.exception()}")

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def start_job(spark: SparkSession, input_dir: str, out_dir: str,
              trigger: sq.Trigger = sq.Trigger(), size: str = WINDOW_SIZE,
              slide: str = WINDOW_SLIDE, threshold: int = ALERT_THRESHOLD,
              watermark: str = WATERMARK_DELAY, decode_once: bool = False,
              state_partitions: int | None = None, compact_every: int = COMPACT_EVERY,
              late_rows: bool = False, **source_opts) -> StreamJob:
    """Start the two flows (and, with ``decode_once``, the shared decode stage).

    ``decode_once``: one query parses every line into ``<out>/decoded``
    (typed events + quarantined rejects, exactly-once file sink) and both
    flows read the typed events from there: each line is parsed once instead
    of once per flow.  With a bounded trigger the decode stage is awaited
    before the flows start.  Without it the broken lines go to
    ``<out>/rejects``.  ``late_rows`` adds the rows behind the watermark, at
    ``<out>/late``.
    """
    ck = f"{out_dir}/_checkpoints"
    if decode_once:
        decoded = f"{out_dir}/decoded"
        d = sq.start_decode(spark, input_dir, decoded, f"{ck}/decode", trigger, **source_opts)
        if trigger.available_now:
            d.awaitTermination()
        ev_m = ev_a = sq.typed_event_stream(spark, decoded)
    else:
        d = None
        ev_m = sq.decoded_stream(spark, input_dir, metrics.INPUT_FIELDS, **source_opts)
        ev_a = sq.decoded_stream(spark, input_dir, alerts.INPUT_FIELDS, **source_opts)
    r = None if decode_once else sq.start_rejects(spark, input_dir, f"{out_dir}/rejects", f"{ck}/rejects", trigger,
                                                  **source_opts)
    late = sq.start_late_rows(spark, input_dir, f"{out_dir}/late", f"{ck}/late", trigger, watermark, size, slide,
                              **source_opts) if late_rows else None
    m = sq.start_upsert(sq.product_metrics_stream(ev_m), f"{out_dir}/product_metrics",
                        f"{ck}/product_metrics", "update", trigger,
                        state_partitions=state_partitions, keys=["product_id"], compact_every=compact_every,
                        cells=serving.metric_cells, cells_path=f"{out_dir}/serving/metrics")
    a = sq.start_upsert(sq.click_alerts_stream(ev_a, size, slide, threshold, watermark),
                        f"{out_dir}/click_alerts", f"{ck}/click_alerts", "append", trigger,
                        state_partitions=state_partitions, compact_every=compact_every,
                        cells=serving.alert_cells, cells_path=f"{out_dir}/serving/alerts")
    return StreamJob(m, a, out_dir, d, r, late)


def current_metrics(spark: SparkSession, job_out: str, input_dir: str) -> DataFrame:
    schema = sq.product_metrics_stream(sq.decoded_stream(spark, input_dir)).schema
    return sq.current(spark, f"{job_out}/product_metrics", schema, ["product_id"])


def current_alerts(spark: SparkSession, job_out: str, input_dir: str, size: str = WINDOW_SIZE,
                   slide: str = WINDOW_SLIDE, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    schema = sq.click_alerts_stream(sq.decoded_stream(spark, input_dir), size, slide,
                                    threshold).schema
    return sq.current(spark, f"{job_out}/click_alerts", schema, ["row_key"], append_only=True)


def current_rejects(spark: SparkSession, job_out: str) -> DataFrame:
    """Broken lines of the job so far, with or without its decode stage."""
    if pointer.exists(spark, f"{job_out}/decoded"):
        return sq.quarantine(spark, f"{job_out}/decoded")
    return sq.rejects(spark, f"{job_out}/rejects")


def serving_get(spark: SparkSession, job_out: str, row_key: str) -> DataFrame:
    """Cells of one row as the job stored them; alert rows have keys of their own store."""
    part = "alerts" if row_key.startswith("alert|") else "metrics"
    return serving_store.get(spark, f"{job_out}/serving/{part}", row_key)


def serving_scan(spark: SparkSession, job_out: str, limit: int = 10, start_key: str | None = None) -> DataFrame:
    """Cells of the first row keys of both stores, in key order."""
    parts = [serving_store.scan(spark, f"{job_out}/serving/{p}", limit, start_key) for p in ("alerts", "metrics")]
    return serving.scan(parts[0].unionByName(parts[1]), limit, start_key)


def main(argv=None) -> None:
    from shopstream.session import build_session

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("input_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--decode-once", action="store_true",
                    help="parse each line once into <out>/decoded, flows read typed events")
    args = ap.parse_args(argv)
    spark = build_session(app_name="shopstream-stream")
    job = start_job(spark, args.input_dir, args.out_dir,
                    sq.Trigger(available_now=args.available_now), decode_once=args.decode_once)
    job.await_all()


if __name__ == "__main__":
    main()
