"""Structured Streaming query starters.

Source: a folder of JSON-lines files (``readStream.text``, published ``*.json``
only).  Two flows share the decoded stream definition, each with its own
checkpoint:

1. running product metrics — streaming aggregation, update mode, no
   watermark (late rows always count), keyed upsert change log;
2. sliding-window click alerts — 15 s watermark, append mode (closed windows
   only), same change-log sink keyed by the alert row key.

Optionally a decode-once stage parses each line into a typed Parquet table
(exactly-once file sink, ``outcome=event|reject``) that both flows read; its
reject partition is the stream's quarantine.

Plus the landing fan-out: one read, two replay-safe sinks (raw archive
partitioned by event date, and a staging copy), or two queries with their
own roll intervals.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shopstream.functions.columns import parse_iso_ts
from shopstream.operators import alerts, decode, metrics
from shopstream.schema import (ALERT_THRESHOLD, EVENT_COLUMNS, WATERMARK_DELAY, WINDOW_SIZE,
                               WINDOW_SLIDE)
from shopstream.session import make_dirs
from shopstream.sinks import changelog, pointer, serving_store
from shopstream.sources.jsonl import PUBLISHED_GLOB

POLL_INTERVAL = "2 seconds"


@dataclass(frozen=True)
class Trigger:
    """``available_now`` for bounded runs/tests, else a processing-time poll."""
    available_now: bool = False
    processing_time: str = POLL_INTERVAL

    def kwargs(self) -> dict:
        if self.available_now:
            return {"availableNow": True}
        return {"processingTime": self.processing_time}


def text_source(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None,
                glob: str = PUBLISHED_GLOB, archive_dir: str | None = None) -> DataFrame:
    """Continuous line source over a folder; hidden and temp files are skipped.

    ``archive_dir``: processed files are moved there once their batch is
    committed (``cleanSource=archive``), so the folder listing and the
    source's seen-file log stay small on a long-running, high-volume feed.
    """
    r = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(directory)


def decoded_stream(spark: SparkSession, directory: str, fields: tuple[str, ...] | None = None,
                   **source_opts) -> DataFrame:
    """Decoded events of a folder stream; ``fields`` prunes the JSON parse."""
    return decode.decode_events(text_source(spark, directory, **source_opts), fields=fields)


# ----------------------------------------------------------------- decode once
OUTCOME = "outcome"          # partition column of the decoded table: event / reject


def decoded_table(lines: DataFrame) -> DataFrame:
    """Every line once: typed fields for events, reason + line head for rejects."""
    d = decode.decode_lines(lines)
    return d.select(
        *EVENT_COLUMNS, "event_ts", "event_ms", "ingested_ms", "reason",
        F.when(F.col("reason").isNotNull(), F.substring("line", 1, decode.LINE_HEAD_CHARS))
         .alias("line_head"),
        F.when(F.col("reason").isNull(), F.lit("event")).otherwise(F.lit("reject"))
         .alias(OUTCOME))


def start_decode(spark: SparkSession, source_dir: str, decoded_path: str, checkpoint: str,
                 trigger: Trigger = Trigger(), **source_opts) -> StreamingQuery:
    """Parse each line once into a typed Parquet table (exactly-once file sink).

    Both flows then read typed, column-pruned events instead of re-parsing
    the JSON, and the ``outcome=reject`` partition is the stream's quarantine.
    """
    return (decoded_table(text_source(spark, source_dir, **source_opts))
            .writeStream.format("parquet").option("path", decoded_path)
            .option("checkpointLocation", checkpoint).partitionBy(OUTCOME)
            .trigger(**trigger.kwargs()).start())


def _decoded_schema(spark: SparkSession):
    empty = spark.createDataFrame([], "value string")
    return decoded_table(empty).schema


def typed_event_stream(spark: SparkSession, decoded_path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Good events from the decoded table, as a stream (partition-pruned)."""
    r = spark.readStream.schema(_decoded_schema(spark))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (r.parquet(decoded_path).filter(F.col(OUTCOME) == "event")
            .select(*EVENT_COLUMNS, "event_ts", "event_ms", "ingested_ms"))


def quarantine(spark: SparkSession, decoded_path: str) -> DataFrame:
    """Rejected lines (reason, first 200 characters) of the decoded table."""
    return (spark.read.schema(_decoded_schema(spark)).parquet(decoded_path)
            .filter(F.col(OUTCOME) == "reject").select("reason", "line_head"))


REJECT_SCHEMA = "reason string, line_head string"


def start_rejects(spark: SparkSession, source_dir: str, rejects_path: str, checkpoint: str,
                  trigger: Trigger = Trigger(), **source_opts) -> StreamingQuery:
    """Broken lines of a folder stream: reason and line head, as an exactly-once Parquet table.

    Only the fields that the reasons need are parsed. The lines of each batch and
    the rejects among them are observed under the name ``decode``, so they show
    in the query's progress without a pass of their own.
    """
    lines = decode.decode_lines(text_source(spark, source_dir, **source_opts), fields=())
    seen = lines.observe("decode", F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejects"))
    return (seen.filter(F.col("reason").isNotNull())
            .select("reason", F.substring("line", 1, decode.LINE_HEAD_CHARS).alias("line_head"))
            .writeStream.format("parquet").option("path", rejects_path)
            .option("checkpointLocation", checkpoint).trigger(**trigger.kwargs()).start())


def rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """Rejected lines so far (reason, first 200 characters)."""
    return spark.read.schema(REJECT_SCHEMA).parquet(rejects_path)


LATE_FIELDS = ("event_id", "event_type", "event_time", "ingested_at", "product_id")
LATE_SCHEMA = ("event_id string, event_type string, product_id string, event_ms long, watermark_ms long, "
               "closed_windows long, batch_id long")


def late_writer(path: str, watermark: str = WATERMARK_DELAY, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE):
    """``foreachBatch`` function: the rows of a batch that lie behind the watermark, and how many of their windows are closed.

    The watermark of a batch is the greatest event time of all batches before it,
    less the delay. Each batch writes its greatest event time under its own id, so
    a replayed batch finds the same watermark and replaces its own rows.
    """
    size_ms, slide_ms, delay_ms = (alerts.duration_ms(x) for x in (size, slide, watermark))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        maxima = f"{path}/maxima"
        batch = batch.persist()
        try:
            (batch.agg(F.max("event_ms").alias("greatest")).withColumn(changelog.BATCH_COL, F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(changelog.BATCH_COL).parquet(maxima))
            before = spark.read.schema("greatest long, batch_id long").parquet(maxima).where(
                F.col(changelog.BATCH_COL) < batch_id).agg(F.max("greatest")).first()[0]
            mark = None if before is None else before - delay_ms
            late = batch.where(F.col("event_ms") < F.lit(mark).cast("long"))
            # the windows of a row end a size after each slide, the last one after the slide it lies in
            last_end = F.col("event_ms") - F.pmod("event_ms", F.lit(slide_ms)) + size_ms
            first_end = last_end - F.expr(f"(({size_ms} - pmod(event_ms, {slide_ms}) - 1) div {slide_ms}) * {slide_ms}")
            closed = F.floor((F.least(F.lit(mark).cast("long"), last_end) - first_end) / slide_ms) + 1
            (late.select("event_id", "event_type", "product_id", "event_ms", F.lit(mark).cast("long").alias("watermark_ms"),
                         F.greatest(closed, F.lit(0)).cast("long").alias("closed_windows"),
                         F.lit(batch_id).cast("long").alias(changelog.BATCH_COL))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(changelog.BATCH_COL).parquet(f"{path}/rows"))
        finally:
            batch.unpersist()
    return write


def start_late_rows(spark: SparkSession, source_dir: str, path: str, checkpoint: str, trigger: Trigger = Trigger(),
                    watermark: str = WATERMARK_DELAY, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                    **source_opts) -> StreamingQuery:
    """Side output of the window flow: every decoded event that arrives behind the watermark."""
    make_dirs(spark, f"{path}/rows")
    events = decoded_stream(spark, source_dir, LATE_FIELDS, **source_opts)
    return (events.writeStream.foreachBatch(late_writer(path, watermark, size, slide))
            .option("checkpointLocation", checkpoint).trigger(**trigger.kwargs()).start())


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Late rows so far, with the watermark that they met and the batch."""
    return spark.read.schema(LATE_SCHEMA).parquet(f"{path}/rows")


def product_metrics_stream(events: DataFrame) -> DataFrame:
    return metrics.product_metrics(events)


def click_windows_stream(events: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                         watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Unthresholded windows; every decoded event (not only clicks) moves the watermark."""
    wm = events.withWatermark("event_ts", watermark)
    return alerts.click_windows(wm, size, slide, guard=True)


def click_alerts_stream(events: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                        threshold: int = ALERT_THRESHOLD,
                        watermark: str = WATERMARK_DELAY) -> DataFrame:
    wm = events.withWatermark("event_ts", watermark)
    return alerts.click_alerts(wm, size, slide, threshold, guard=True)


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str | None):
    """Set a SQL conf for the duration of a ``start()`` (the stream snapshots it)."""
    if value is None:
        yield
        return
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def start_upsert(result: DataFrame, sink_path: str, checkpoint: str, output_mode: str,
                 trigger: Trigger = Trigger(), name: str | None = None,
                 state_partitions: int | None = None, keys: Sequence[str] | None = None,
                 compact_every: int | None = changelog.COMPACT_EVERY, cells=None,
                 cells_path: str | None = None) -> StreamingQuery:
    """Run ``result`` into a replay-safe change log at ``sink_path``.

    ``state_partitions`` fixes the number of state-store partitions for a new
    checkpoint (Spark takes it from ``spark.sql.shuffle.partitions`` when the
    query starts and keeps it for the checkpoint's life); ``None`` keeps the
    session's setting.  With ``keys`` (or in append mode) the log is compacted
    every ``compact_every`` batches.  ``cells`` maps the batch's rows to serving
    cells, which the same micro-batch writes to the store at ``cells_path``.
    """
    spark = result.sparkSession
    append_only = output_mode == "append"
    changelog.init_log(spark, sink_path, result.schema)
    rows = changelog.batch_writer(sink_path, keys, result.schema,
                                  compact_every if keys or append_only else None, append_only)
    write = rows
    if cells is not None:
        stored = serving_store.batch_writer(cells_path, compact_every)
        serving_store.init(spark, cells_path)

        def write(batch: DataFrame, batch_id: int) -> None:
            rows(batch, batch_id)
            # the cells come from the rows just written, so the batch is computed once
            written = f"{sink_path}/{changelog.BATCH_COL}={batch_id}"
            if pointer.exists(spark, written):
                stored(cells(spark.read.schema(result.schema).parquet(written)), batch_id)
    w = (result.writeStream.outputMode(output_mode)
         .foreachBatch(write)
         .option("checkpointLocation", checkpoint)
         .trigger(**trigger.kwargs()))
    if name:
        w = w.queryName(name)
    parts = str(state_partitions) if state_partitions else None
    with _session_conf(spark, "spark.sql.shuffle.partitions", parts):
        return w.start()


def start_product_metrics(spark: SparkSession, source_dir: str, sink_path: str,
                          checkpoint: str, trigger: Trigger = Trigger(),
                          **source_opts) -> StreamingQuery:
    res = product_metrics_stream(decoded_stream(spark, source_dir, metrics.INPUT_FIELDS,
                                                **source_opts))
    return start_upsert(res, sink_path, checkpoint, "update", trigger, keys=["product_id"])


def start_click_windows(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                        trigger: Trigger = Trigger(), size: str = WINDOW_SIZE,
                        slide: str = WINDOW_SLIDE, watermark: str = WATERMARK_DELAY,
                        **source_opts) -> StreamingQuery:
    res = click_windows_stream(decoded_stream(spark, source_dir, alerts.INPUT_FIELDS,
                                              **source_opts), size, slide, watermark)
    return start_upsert(res, sink_path, checkpoint, "append", trigger)


def start_click_alerts(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                       trigger: Trigger = Trigger(), size: str = WINDOW_SIZE,
                       slide: str = WINDOW_SLIDE, threshold: int = ALERT_THRESHOLD,
                       watermark: str = WATERMARK_DELAY, **source_opts) -> StreamingQuery:
    res = click_alerts_stream(decoded_stream(spark, source_dir, alerts.INPUT_FIELDS,
                                             **source_opts), size, slide, threshold, watermark)
    return start_upsert(res, sink_path, checkpoint, "append", trigger)


def current(spark: SparkSession, sink_path: str, result_schema, keys,
            append_only: bool = False) -> DataFrame:
    """Current rows of a change-log sink (``append_only``: no per-key reduction)."""
    log = changelog.read_log(spark, sink_path, result_schema)
    return changelog.appended_rows(log) if append_only else changelog.current_view(log, keys)


# ----------------------------------------------------------------- landing fan-out
def landing_writer(raw_path: str | None, staging_path: str | None):
    """One micro-batch -> raw archive (by event date) and staging; both replay-safe.

    Lines are kept byte for byte (text sink, ``part-*.txt`` files). The batch
    scan reads the archive as it is; the stable-file gate publishes staged
    files under the ``.json`` names that streams read.  Rows are rebalanced
    before a write: a date gets one file a batch, and more only beyond the
    advisory partition size, instead of one per task that met the date.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn(changelog.BATCH_COL, F.lit(batch_id).cast("long"))
        both = raw_path is not None and staging_path is not None
        if both:
            b = b.persist()
        try:
            if raw_path is not None:
                ts = parse_iso_ts(F.get_json_object("value", "$.event_time"))
                date = F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("unknown"))
                (b.withColumn("event_date", date)
                 .select("value", "event_date", changelog.BATCH_COL).hint("rebalance", "event_date")
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("event_date", changelog.BATCH_COL).text(raw_path))
            if staging_path is not None:
                (b.select("value", changelog.BATCH_COL).hint("rebalance")
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(changelog.BATCH_COL).text(staging_path))
        finally:
            if both:
                b.unpersist()
    return write


def start_landing(spark: SparkSession, log_dir: str, raw_path: str, staging_path: str,
                  checkpoint: str, trigger: Trigger = Trigger(), **source_opts) -> StreamingQuery:
    src = text_source(spark, log_dir, **source_opts)
    return (src.writeStream.foreachBatch(landing_writer(raw_path, staging_path))
            .option("checkpointLocation", checkpoint).trigger(**trigger.kwargs()).start())


RAW_ROLL = "30 seconds"
STAGING_ROLL = "10 seconds"


def start_landing_rolls(spark: SparkSession, log_dir: str, raw_path: str, staging_path: str,
                        checkpoint_dir: str, raw_trigger: Trigger = Trigger(processing_time=RAW_ROLL),
                        staging_trigger: Trigger = Trigger(processing_time=STAGING_ROLL),
                        **source_opts) -> tuple[StreamingQuery, StreamingQuery]:
    """The two landing sinks as independent queries with their own roll intervals.

    Each trigger writes new files, so the archive rolls every 30 s and the
    staging copy every 10 s; each query has its own checkpoint (the plain
    text source is cheap to read twice).  Use :func:`start_landing` for one
    read feeding both sinks.
    """
    raw_only = landing_writer(raw_path, None)
    staging_only = landing_writer(None, staging_path)
    qr = (text_source(spark, log_dir, **source_opts).writeStream.foreachBatch(raw_only)
          .option("checkpointLocation", f"{checkpoint_dir}/raw")
          .trigger(**raw_trigger.kwargs()).start())
    qs = (text_source(spark, log_dir, **source_opts).writeStream.foreachBatch(staging_only)
          .option("checkpointLocation", f"{checkpoint_dir}/staging")
          .trigger(**staging_trigger.kwargs()).start())
    return qr, qs


def start_console(result: DataFrame, output_mode: str = "append",
                  trigger: Trigger = Trigger(), checkpoint: str | None = None,
                  rows: int = 20) -> StreamingQuery:
    """Print each micro-batch (debugging; the print sink of the original flows)."""
    w = (result.writeStream.format("console").outputMode(output_mode)
         .option("truncate", "false").option("numRows", str(rows))
         .trigger(**trigger.kwargs()))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


class DropCounter(StreamingQueryListener):
    """Keeps the rows that stateful operators dropped as late, one small file per query and batch.

    A query's own progress list is short; these counts stay, and a batch that is
    run again replaces its own. Attach with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if dropped:
            file = f"{self.path}/{p.id}-{p.batchId}.json"
            pointer.delete(self.spark, file)
            pointer.write(self.spark, file, json.dumps(
                {"query_id": str(p.id), "batch_id": p.batchId, "dropped": dropped}) + "\n")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def counts(self) -> DataFrame:
        """(query_id, batch_id, dropped) of every batch that dropped rows."""
        make_dirs(self.spark, self.path)
        return self.spark.read.schema("query_id string, batch_id long, dropped long").json(self.path)


def rows_dropped_by_watermark(q: StreamingQuery) -> int:
    """Late rows the stateful operators dropped, over the query's recent progress (see :class:`DropCounter`)."""
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total
