"""Running product metrics — one definition for batch and streaming.

Per product: clicks, cart adds, checkouts, checkout value, delivered events,
plus the newest non-empty category / event_time / event_id *by arrival*.
Events that match no counter (removes, non-final statuses, unknown types)
still create the product row and refresh its meta columns.

The same aggregate list runs as a batch ``groupBy`` or as a streaming
aggregation in update mode (state = one row per product).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions import exact
from shopstream.functions.columns import arrival_key, count_when, ever, last_by_arrival, truthy

# event fields the running metrics read (the decoder parses only these)
INPUT_FIELDS = ("event_id", "event_type", "event_time", "ingested_at", "product_id", "category",
                "cart_action", "total_value", "delivery_status")
METRIC_COLUMNS = ("clicks", "cart_adds", "checkouts", "orders_value", "delivered")
META_COLUMNS = ("category", "last_event_time", "last_event_id")
OUTPUT_COLUMNS = ("product_id",) + METRIC_COLUMNS + META_COLUMNS


# checkout values; a bad or missing one counts the checkout and adds nothing
CHECKOUT_VALUE = ("CASE WHEN event_type = 'cart' AND cart_action = 'checkout' "
                  "THEN try_cast(total_value AS DOUBLE) END")


def metric_aggregates(order: Column | None = None) -> list[Column]:
    """Aggregates over events with the parts of their checkout value (``_value``)."""
    et, ca = F.col("event_type"), F.col("cart_action")
    checkout = (et == "cart") & (ca == "checkout")
    order = arrival_key() if order is None else order
    return [
        count_when(et == "click").alias("clicks"),
        count_when((et == "cart") & (ca == "add")).alias("cart_adds"),
        count_when(checkout).alias("checkouts"),
        F.coalesce(exact.exact_sum("_value"), F.lit(0.0)).alias("orders_value"),
        count_when((et == "delivery_status")
                   & (F.col("delivery_status") == "delivered")).alias("delivered"),
        # ``ever`` keeps the groups, their text winners included, in a hash map
        F.coalesce(F.when(ever(truthy("category").isNotNull()), last_by_arrival("category", order)),
                   F.lit("unknown")).alias("category"),
        last_by_arrival("event_time", order, "").alias("last_event_time"),
        last_by_arrival("event_id", order, "").alias("last_event_id"),
    ]


def keyed_events(events: DataFrame) -> DataFrame:
    """Events with a usable key: the streaming path drops NULL and '' products."""
    return events.filter(F.length("product_id") > 0)


def product_metrics(events: DataFrame) -> DataFrame:
    """Running totals per product over everything seen (no watermark: late rows count)."""
    return (exact.with_parts(keyed_events(events), _value=CHECKOUT_VALUE).groupBy("product_id")
            .agg(*metric_aggregates()).select(*OUTPUT_COLUMNS))
