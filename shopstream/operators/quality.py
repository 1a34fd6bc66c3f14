"""Table checks implied by the event contract and the two processing paths.

* contract violations per rule
* lateness profile per event type (arrival lag vs the watermark)
* order progress: checkout -> latest delivery status (one grouped pass)
* stream/batch reconciliation per product (full outer join)

The one join (reconciliation) happens only after both sides are aggregated
to one row per key, so a hot key never reaches it: the shuffle carries one
row per key per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.functions import exact
from shopstream.functions.columns import arrival_key, count_when, ever, first_by_arrival, last_by_arrival
from shopstream.schema import CART_ACTIONS, DELIVERY_STATUSES, EVENT_TYPES

WATERMARK_MS = 15_000
MONEY_TOLERANCE = 0.005

RULES = ("unknown_event_type", "cart_without_valid_action", "delivery_without_valid_status",
         "action_on_non_cart", "total_mismatch", "click_with_value")


def violation_flags(events: DataFrame) -> dict[str, F.Column]:
    et, ca, ds = F.col("event_type"), F.col("cart_action"), F.col("delivery_status")
    tv = F.col("total_value")
    expected = F.round(F.col("unit_price") * F.col("quantity"), 2)
    return {
        "unknown_event_type": et.isNull() | ~et.isin(*EVENT_TYPES),
        "cart_without_valid_action": (et == "cart") & (ca.isNull() | ~ca.isin(*CART_ACTIONS)),
        "delivery_without_valid_status":
            (et == "delivery_status") & (ds.isNull() | ~ds.isin(*DELIVERY_STATUSES)),
        "action_on_non_cart": (~et.eqNullSafe("cart")) & ca.isNotNull(),
        "total_mismatch": et.isin("cart", "delivery_status")
                          & (F.abs(tv - expected) > MONEY_TOLERANCE),
        "click_with_value": (et == "click") & (tv.isNull() | (tv != 0)),
    }


def contract_violations(events: DataFrame) -> DataFrame:
    """(rule, n) for every rule, zero counts included — one pass, one tiny shuffle."""
    flags = violation_flags(events)
    counts = events.agg(*[count_when(F.coalesce(flags[r], F.lit(False))).alias(r) for r in RULES])
    stacked = F.stack(F.lit(len(RULES)), *[x for r in RULES for x in (F.lit(r), F.col(r))])
    return counts.select(stacked.alias("rule", "n"))


def lateness_profile(events: DataFrame, watermark_ms: int = WATERMARK_MS) -> DataFrame:
    """Per event type: rows, late rows (lag > 0), max lag, rows beyond the watermark."""
    lag = F.col("ingested_ms") - F.col("event_ms")
    return (events.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 count_when(lag > 0).alias("late_n"),
                 F.max(lag).alias("max_lag_ms"),
                 count_when(lag > watermark_ms).alias("over_watermark_n")))


def order_progress(events: DataFrame) -> DataFrame:
    """Per checked-out order: first checkout, latest delivery status, delivered flag.

    Undelivered orders stay; deliveries of orders never checked out are not
    reported.  Equivalent to checkouts LEFT JOIN deliveries on order_id, but
    computed as one grouped aggregation with conditional aggregates: one scan,
    one shuffle (after map-side partial aggregation, so a hot order is
    reduced per task first) and no join.
    """
    order = arrival_key()
    et = F.col("event_type")
    is_checkout = (et == "cart") & (F.col("cart_action") == "checkout")
    is_delivery = et == "delivery_status"
    rel = events.filter(F.col("order_id").isNotNull() & (is_checkout | is_delivery))
    ck_time = F.when(is_checkout, F.col("event_time"))
    status = F.when(is_delivery, F.col("delivery_status"))
    agg = rel.groupBy("order_id").agg(
        first_by_arrival(ck_time, order, "").alias("first_checkout_time"),
        count_when(is_checkout).alias("checkouts"),
        last_by_arrival(status, order).alias("latest_status"),
        count_when(is_delivery).alias("delivery_events"),
        ever(is_delivery & (F.col("delivery_status") == "delivered")).alias("delivered"),
    )
    return agg.filter(F.col("checkouts") > 0).select(
        "order_id", "first_checkout_time", "checkouts", "latest_status", "delivery_events", "delivered")


RECONCILED = (("clicks", "total_clicks"), ("cart_adds", "total_cart_adds"),
              ("checkouts", "total_checkouts"), ("orders_value", "total_revenue"),
              ("delivered", "total_delivered"))


def reconcile(running: DataFrame, batch_totals: DataFrame) -> DataFrame:
    """Running (per product) vs batch (per product, category) totals.

    The batch side is re-summed over category first (a product that changed
    category has several batch rows), then full-outer-joined on product.
    Differences are running minus batch; a side that lacks the product
    counts as zero and is flagged.
    """
    b = (exact.with_parts(batch_totals, _revenue="total_revenue").groupBy("product_id")
         .agg(*[exact.exact_sum("_revenue").alias(bc) if rc == "orders_value" else F.sum(bc).alias(bc)
                for rc, bc in RECONCILED]))
    r = running.select("product_id", *[rc for rc, _ in RECONCILED]).withColumn("_r", F.lit(True))
    b = b.withColumn("_b", F.lit(True))
    j = r.join(b, "product_id", "full_outer")
    diffs = []
    for rc, bc in RECONCILED:
        d = F.coalesce(F.col(rc), F.lit(0)) - F.coalesce(F.col(bc), F.lit(0))
        if rc == "orders_value":
            d = F.round(d, 2)  # the categories' sums are rounded one by one
        diffs.append(d.alias(f"{rc}_diff"))
    return j.select("product_id", *diffs,
                    F.coalesce(F.col("_r"), F.lit(False)).alias("in_running"),
                    F.coalesce(F.col("_b"), F.lit(False)).alias("in_batch"))
