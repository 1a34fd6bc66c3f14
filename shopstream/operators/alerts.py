"""Sliding event-time click windows and high-volume alerts.

Windows are epoch-aligned, ``[start, end)``, size/slide windows per click.
Nothing buffers a window's elements: the full-window buffering of the
original flow is replaced by incremental aggregates.  Batch windows are
built from panes (:func:`pane_window_aggregate`: one aggregation of the raw
clicks per pane, then pane aggregates merged per window); streams use
``window()``, which expands each click into its windows before the stateful
aggregation and judges lateness per window.

On a stream the click filter must not be pushed below the watermark (then
only clicks would move it); :func:`click_filter` with ``guard=True`` refers to
the event-time column, which keeps it above the watermark node.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.columns import arrival_key, first_by_arrival, last_by_arrival, truthy
from shopstream.schema import ALERT_THRESHOLD, ALERT_TYPE, WINDOW_SIZE, WINDOW_SLIDE

# ---------------------------------------------------------------------------
# The text line of the unthresholded window job.
WINDOW_LINE_FORMAT = "ALERTA | produto=%s | clicks=%d | janela=%d-%d"
ROW_KEY_PREFIX = "alert"
ROW_KEY_SEPARATOR = "|"
# ---------------------------------------------------------------------------

_MIN_MICROS = -(2 ** 63)

# event fields the click windows / alerts read (the decoder parses only these)
INPUT_FIELDS = ("event_id", "event_type", "event_time", "ingested_at", "product_id")

WINDOW_COLUMNS = ("product_id", "window_start", "window_end", "click_count")
ALERT_COLUMNS = ("row_key", "product_id", "alert_type", "click_count", "window_start",
                 "window_end", "first_event_time", "last_event_time")


def click_filter(events: DataFrame, time_col: str = "event_ts", guard: bool = False) -> DataFrame:
    """Clicks on a usable product: NULL and '' products are dropped, as in the keyed stream."""
    et = F.col("event_type")
    if guard:
        # ``CASE … END IS NOT NULL`` is folded to ``event_type = 'click'`` when the
        # time column is non-nullable (and then pushed below the watermark); a
        # comparison on the time value is not, so the filter stays above it.
        micros = F.when((et == "click") & (F.length("product_id") > 0), F.unix_micros(F.col(time_col)))
        return events.filter(micros > F.lit(_MIN_MICROS))
    return events.filter((et == "click") & (F.length("product_id") > 0))


_UNIT_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000,
            "day": 86_400_000, "week": 604_800_000}


def duration_ms(text: str) -> int | None:
    """``'5 minutes'`` -> 300000; None for anything but ``<int> <unit>``."""
    parts = text.strip().lower().split()
    if len(parts) != 2 or not parts[0].isdigit():
        return None
    unit = parts[1][:-1] if parts[1].endswith("s") else parts[1]
    return int(parts[0]) * _UNIT_MS[unit] if unit in _UNIT_MS and int(parts[0]) > 0 else None


def pane_window_aggregate(clicks: DataFrame, size_ms: int, slide_ms: int,
                          with_times: bool = True) -> DataFrame:
    """Sliding windows from panes ("No pane, no gain", Li et al. 2005).

    Clicks are aggregated once per (product, pane) with pane = gcd(size,
    slide); each pane aggregate, not each click, is then expanded into the
    size/slide windows that cover it and merged (count: sum; first / last
    by arrival: min / max of an (arrival, value) struct).  The raw rows go
    through one aggregation without the size/slide-fold expansion; for
    count-only windows both stages stay hash aggregates.  Exact: windows are
    epoch-aligned unions of panes, as ``window()`` makes them.
    """
    pane_ms = math.gcd(size_ms, slide_ms)
    ms = F.col("event_ms")
    pane = (ms - F.pmod(ms, F.lit(pane_ms))).alias("pane_ms")
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    if with_times:
        v = truthy("event_time")
        tagged = F.when(v.isNotNull(), F.struct(F.col("ingested_ms").alias("ingested_ms"),
                                                F.col("event_id").alias("event_id"),
                                                v.alias("value")))
        aggs += [F.min(tagged).alias("first_s"), F.max(tagged).alias("last_s")]
    panes = clicks.groupBy("product_id", pane).agg(*aggs)
    # windows covering pane P: starts W = multiple of slide with P - size < W <= P
    per_pane = -(-size_ms // slide_ms)
    newest = F.col("pane_ms") - F.pmod(F.col("pane_ms"), F.lit(slide_ms))
    starts = (panes.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(per_pane - 1))))
              .withColumn("window_start", newest - F.col("k") * F.lit(slide_ms))
              .filter(F.col("window_start") > F.col("pane_ms") - F.lit(size_ms)))
    merged: list[Column] = [F.sum("n").alias("click_count")]
    if with_times:
        merged += [F.coalesce(F.min("first_s").getField("value"), F.lit("")).alias("first_event_time"),
                   F.coalesce(F.max("last_s").getField("value"), F.lit("")).alias("last_event_time")]
    return (starts.groupBy("product_id", "window_start").agg(*merged)
            .withColumn("window_end", F.col("window_start") + F.lit(size_ms)))


def window_aggregate(clicks: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                     time_col: str = "event_ts", with_times: bool = True,
                     panes: bool = False) -> DataFrame:
    """(product, window) -> click_count [+ first/last event_time by arrival].

    ``panes``: use :func:`pane_window_aggregate` (batch) when the durations
    are simple and ``event_ms`` is present; otherwise ``window()`` expands
    every click (streams keep this form: it is the stateful window operator).
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    # panes window on ``event_ms``, the millisecond form of ``event_ts``
    if (panes and size_ms and slide_ms and time_col == "event_ts"
            and "event_ms" in clicks.columns):
        return pane_window_aggregate(clicks, size_ms, slide_ms, with_times)
    aggs: list[Column] = [F.count(F.lit(1)).alias("click_count")]
    if with_times:
        order = arrival_key()
        aggs += [first_by_arrival("event_time", order, "").alias("first_event_time"),
                 last_by_arrival("event_time", order, "").alias("last_event_time")]
    w = F.window(time_col, size, slide)
    return (clicks.groupBy(F.col("product_id"), w.alias("window")).agg(*aggs)
            .withColumn("window_start", F.unix_millis(F.col("window.start")))
            .withColumn("window_end", F.unix_millis(F.col("window.end")))
            .drop("window"))


def click_windows(events: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                  time_col: str = "event_ts", guard: bool = False) -> DataFrame:
    """Unthresholded click counts per product and sliding window."""
    agg = window_aggregate(click_filter(events, time_col, guard), size, slide, time_col,
                           with_times=False, panes=not guard)
    return agg.select(*WINDOW_COLUMNS)


def alert_row_key(product: Column, start_ms: Column, end_ms: Column) -> Column:
    return F.concat_ws(ROW_KEY_SEPARATOR, F.lit(ROW_KEY_PREFIX), product,
                       start_ms.cast("string"), end_ms.cast("string"))


def alerts_from_windows(windows: DataFrame, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    hot = windows.filter(F.col("click_count") >= threshold)
    return hot.select(
        alert_row_key(F.col("product_id"), F.col("window_start"), F.col("window_end"))
        .alias("row_key"),
        "product_id",
        F.lit(ALERT_TYPE).alias("alert_type"),
        "click_count", "window_start", "window_end",
        "first_event_time", "last_event_time",
    )


def click_alerts(events: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                 threshold: int = ALERT_THRESHOLD, time_col: str = "event_ts",
                 guard: bool = False) -> DataFrame:
    """Windows with at least ``threshold`` clicks, keyed ``alert|product|start|end``."""
    agg = window_aggregate(click_filter(events, time_col, guard), size, slide, time_col,
                           panes=not guard)
    return alerts_from_windows(agg, threshold)


def window_lines(windows: DataFrame) -> DataFrame:
    """One text line per window (the older unthresholded job's output)."""
    return windows.select(
        F.format_string(WINDOW_LINE_FORMAT, F.col("product_id"), F.col("click_count"),
                        F.col("window_start"), F.col("window_end")).alias("line"))


def with_event_ts(events: DataFrame) -> DataFrame:
    """Canonical events carry ``event_ms``; windows need a TIMESTAMP column."""
    if "event_ts" in events.columns:
        return events
    return events.withColumn("event_ts", F.timestamp_millis("event_ms"))
