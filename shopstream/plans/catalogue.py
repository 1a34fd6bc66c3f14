"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame`` (the registry).

Every query reads the driver tables at ``sf_dir`` (through the event adapter)
and runs over the whole table.  This module holds the batch queries and the
registry; ``plans.streams`` adds the streaming queries (bounded
``availableNow`` runs over landed JSON lines) and ``plans.tables`` the
catalog queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopstream.operators import alerts, batch, decode, metrics, quality, serving
from shopstream.session import ensure_utc, new_run_dir
from shopstream.sinks import serving_store
from shopstream.schema import EVENT_COLUMNS
from shopstream.sources import adapter, jsonl

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Test-density window: at 8 products over 30 days the 5 min / 1 min default
# never reaches 10 clicks; 1 day / 6 h does.  Defaults stay the library's.
DAY_SIZE, DAY_SLIDE = "1 day", "6 hours"


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str, spread_scan: bool = False) -> DataFrame:
    ensure_utc(spark)
    return adapter.driver_events(spark, sf_dir, spread_scan)


# ----------------------------------------------------------------- sources
@register("event_count")
def q_event_count(spark, sf_dir):
    return batch.event_count(events(spark, sf_dir))


@register("raw_logs")
def q_raw_logs(spark, sf_dir):
    """8-column external JSON table over the landed raw files."""
    return jsonl.raw_logs_table(spark, jsonl.landed_events(spark, sf_dir))


@register("decoded_events")
def q_decoded_events(spark, sf_dir):
    """Events -> JSON lines -> decode: must give the events back."""
    lines = jsonl.to_json_lines(events(spark, sf_dir, spread_scan=True))
    ev = decode.decode_events(lines)
    return ev.select(*EVENT_COLUMNS, "event_ms")


@register("decode_rejects")
def q_decode_rejects(spark, sf_dir):
    lines = jsonl.damaged_lines(events(spark, sf_dir, spread_scan=True))
    # reasons only: parse just the always-parsed fields
    return decode.reject_counts(decode.decode_lines(lines, fields=()))


@register("decoded_unknown_product")
def q_decoded_unknown_product(spark, sf_dir):
    lines = jsonl.damaged_lines(events(spark, sf_dir, spread_scan=True), drop_product_key=True)
    return decode.decode_minimal(lines).groupBy("product_id").count().withColumnRenamed("count", "n")


@register("event_times")
def q_event_times(spark, sf_dir):
    lines = jsonl.to_json_lines(events(spark, sf_dir, spread_scan=True))
    return decode.decode_events(lines, fields=("event_id",)).select("event_id", "event_ms")


# ----------------------------------------------------------------- batch ETL
def _branch_cols(df):
    return df.select("event_id", "event_type", "product_id")


@register("clean_events")
def q_clean_events(spark, sf_dir):
    return _branch_cols(batch.clean(events(spark, sf_dir)))


@register("clicks")
def q_clicks(spark, sf_dir):
    return _branch_cols(batch.clicks(batch.clean(events(spark, sf_dir))))


@register("carts")
def q_carts(spark, sf_dir):
    return _branch_cols(batch.carts(batch.clean(events(spark, sf_dir))))


@register("deliveries")
def q_deliveries(spark, sf_dir):
    return _branch_cols(batch.deliveries(batch.clean(events(spark, sf_dir))))


@register("clicks_by_product")
def q_clicks_by_product(spark, sf_dir):
    return batch.clicks_by_product(batch.clean(events(spark, sf_dir)))


@register("top_clicked")
def q_top_clicked(spark, sf_dir):
    return batch.top_clicked(batch.clicks_by_product(batch.clean(events(spark, sf_dir))), 20)


@register("sales")
def q_sales(spark, sf_dir):
    return batch.sales(batch.clean(events(spark, sf_dir)))


@register("product_metrics_batch")
def q_product_metrics_batch(spark, sf_dir):
    return batch.product_metrics_batch(events(spark, sf_dir))


# ----------------------------------------------------------------- running metrics / windows
@register("product_metrics")
def q_product_metrics(spark, sf_dir):
    return metrics.product_metrics(events(spark, sf_dir))


@register("click_windows")
def q_click_windows(spark, sf_dir):
    return alerts.click_windows(alerts.with_event_ts(events(spark, sf_dir)))


@register("click_window_lines")
def q_click_window_lines(spark, sf_dir):
    return alerts.window_lines(alerts.click_windows(alerts.with_event_ts(events(spark, sf_dir))))


@register("click_alerts")
def q_click_alerts(spark, sf_dir):
    return alerts.click_alerts(alerts.with_event_ts(events(spark, sf_dir)))


@register("click_alerts_1d")
def q_click_alerts_1d(spark, sf_dir):
    return alerts.click_alerts(alerts.with_event_ts(events(spark, sf_dir)), DAY_SIZE, DAY_SLIDE, 10)


# ----------------------------------------------------------------- serving view
def _serving_rows(spark, sf_dir):
    ev = alerts.with_event_ts(events(spark, sf_dir))
    return serving.serving_rows(metrics.product_metrics(ev),
                                alerts.click_alerts(ev, DAY_SIZE, DAY_SLIDE, 10))


@register("serving_rows")
def q_serving_rows(spark, sf_dir):
    return _serving_rows(spark, sf_dir)


def _stored_serving(spark, sf_dir) -> str:
    """The serving cells as a stored table, clustered by row key."""
    path = new_run_dir(spark, "serving")
    serving_store.store(_serving_rows(spark, sf_dir), path)
    return path


@register("serving_scan")
def q_serving_scan(spark, sf_dir):
    return serving_store.scan(spark, _stored_serving(spark, sf_dir), 10)


@register("serving_get")
def q_serving_get(spark, sf_dir):
    return serving_store.get(spark, _stored_serving(spark, sf_dir), "prod-001")


# ----------------------------------------------------------------- quality (re-aimed)
@register("contract_violations")
def q_contract_violations(spark, sf_dir):
    return quality.contract_violations(events(spark, sf_dir))


@register("lateness_profile")
def q_lateness_profile(spark, sf_dir):
    return quality.lateness_profile(events(spark, sf_dir))


@register("order_progress")
def q_order_progress(spark, sf_dir):
    return quality.order_progress(events(spark, sf_dir))


@register("reconcile_metrics")
def q_reconcile_metrics(spark, sf_dir):
    ev = events(spark, sf_dir)
    return quality.reconcile(metrics.product_metrics(ev), batch.product_metrics_batch(ev))
