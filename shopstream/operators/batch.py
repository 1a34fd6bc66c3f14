"""Batch ETL operators: clean, branches, counts, sales, product totals, top-k.

All aggregates are algebraic, so Spark plans a partial aggregate before the
shuffle: a hot product (one key holding a third of the rows) is reduced to
one row per map task before anything moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.functions import exact
from shopstream.functions.columns import count_when


def clean(events: DataFrame) -> DataFrame:
    """Events with an id and a type."""
    return events.filter(F.col("event_id").isNotNull() & F.col("event_type").isNotNull())


def branch(events: DataFrame, event_type: str) -> DataFrame:
    return events.filter(F.col("event_type") == event_type)


def clicks(events: DataFrame) -> DataFrame:
    return branch(events, "click")


def carts(events: DataFrame) -> DataFrame:
    return branch(events, "cart")


def deliveries(events: DataFrame) -> DataFrame:
    return branch(events, "delivery_status")


def event_count(events: DataFrame) -> DataFrame:
    """Global row count as a one-row relation (``n``)."""
    return events.agg(F.count(F.lit(1)).alias("n"))


def clicks_by_product(clean_events: DataFrame) -> DataFrame:
    """Clicks per product; a NULL product is kept as its own group."""
    return (clicks(clean_events).groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("total_clicks")))


def top_clicked(by_product: DataFrame, n: int = 20) -> DataFrame:
    """Most-clicked products; ties broken by product id."""
    return by_product.orderBy(F.col("total_clicks").desc(),
                              F.col("product_id").asc_nulls_last()).limit(n)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows for display (``show(n)`` / ``head -n``)."""
    return df.limit(n)


def sales(clean_events: DataFrame) -> DataFrame:
    """Per (product, category): events with a value, their revenue, mean unit price.

    Every valued event counts (adds, removes, deliveries, zero-valued clicks),
    not only checkouts; checkout-only revenue is :func:`product_metrics_batch`.
    """
    valued = clean_events.filter(F.col("total_value").isNotNull())
    return (exact.with_parts(valued, _revenue="total_value", _price="unit_price")
            .groupBy("product_id", "category")
            .agg(F.count(F.lit(1)).alias("events"),
                 exact.exact_sum("_revenue").alias("revenue"),
                 exact.exact_avg("_price").alias("average_price")))


def insight_partials(raw: DataFrame) -> DataFrame:
    """One pass over raw events -> per (product, category) partials of both insights.

    Carries the raw row count, clean clicks, and the sales sums, so the ETL
    reads the raw data once for the count and both insight tables instead of
    once per output.  The sums are exact.
    """
    et, tv = F.col("event_type"), F.col("total_value")
    is_clean = F.col("event_id").isNotNull() & et.isNotNull()
    valued = is_clean & tv.isNotNull()
    only = "CASE WHEN event_id IS NOT NULL AND event_type IS NOT NULL AND total_value IS NOT NULL THEN {} END"
    return (exact.with_parts(raw, _revenue=only.format("total_value"), _price=only.format("unit_price"))
            .groupBy("product_id", "category")
            .agg(F.count(F.lit(1)).alias("raw_rows"),
                 count_when(is_clean & (et == "click")).alias("clicks"),
                 count_when(valued).alias("events"),
                 exact.exact_sum("_revenue").alias("revenue"),
                 exact.exact_avg("_price").alias("average_price")))


def clicks_by_product_from(partials: DataFrame) -> DataFrame:
    """:func:`clicks_by_product` re-summed from :func:`insight_partials`."""
    return (partials.groupBy("product_id").agg(F.sum("clicks").alias("total_clicks"))
            .filter(F.col("total_clicks") > 0))


def sales_from(partials: DataFrame) -> DataFrame:
    """:func:`sales` from :func:`insight_partials` (groups with a valued event)."""
    return partials.filter(F.col("events") > 0).select(
        "product_id", "category", "events", "revenue", "average_price")


_CHECKOUT = "event_type = 'cart' AND cart_action = 'checkout'"
# NULL terms are skipped, and a group of only NULL terms sums to NULL
_REVENUE = f"CASE WHEN {_CHECKOUT} THEN try_cast(total_value AS DOUBLE) ELSE 0D END"


def product_metrics_batch(raw_logs: DataFrame) -> DataFrame:
    """Product totals of the SQL path: (product, category) -> 4 counts + checkout revenue.

    Only a NULL product is dropped; an empty product id is its own group.
    """
    et, ca = F.col("event_type"), F.col("cart_action")
    return (exact.with_parts(raw_logs.filter(F.col("product_id").isNotNull()), _revenue=_REVENUE)
            .groupBy("product_id", "category")
            .agg(count_when(et == "click").alias("total_clicks"),
                 count_when((et == "cart") & (ca == "add")).alias("total_cart_adds"),
                 count_when((et == "cart") & (ca == "checkout")).alias("total_checkouts"),
                 exact.exact_sum("_revenue").alias("total_revenue"),
                 count_when((et == "delivery_status")
                            & (F.col("delivery_status") == "delivered")).alias("total_delivered")))


PRODUCT_METRICS_BATCH_SQL = f"""
SELECT
    product_id,
    category,
    count_if(event_type = 'click') AS total_clicks,
    count_if(event_type = 'cart' AND cart_action = 'add') AS total_cart_adds,
    count_if({_CHECKOUT}) AS total_checkouts,
    {exact.sum_sql("_revenue")} AS total_revenue,
    count_if(event_type = 'delivery_status' AND delivery_status = 'delivered') AS total_delivered
FROM (SELECT *, {exact.parts_sql("_value", "_bin")} AS _revenue
      FROM (SELECT *, {exact.bin_sql("_value")} AS _bin
            FROM (SELECT *, {_REVENUE} AS _value FROM {{source}} WHERE product_id IS NOT NULL)))
GROUP BY product_id, category
"""
