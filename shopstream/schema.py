"""The event contract: one flat JSON object per line, 16 fields.

Decoding reads every field as a string first (a typed numeric field would
flag a whole row corrupt on ``"12.5"``), then converts with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the event contract (must equal the producer's).
# ---------------------------------------------------------------------------
SCHEMA_VERSION = "1.0"
SOURCE = "web"
EVENT_TYPES = ("click", "cart", "delivery_status")
CART_ACTIONS = ("add", "remove", "checkout")
DELIVERY_STATUSES = ("created", "shipped", "in_transit", "out_for_delivery", "delivered")
CATEGORIES = ("eletronicos", "informatica", "casa", "esportes", "moda", "beleza",
              "livros", "brinquedos")
ALERT_TYPE = "HIGH_CLICK_VOLUME"
ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Streaming defaults of the alert flow.
WATERMARK_DELAY = "15 seconds"
WINDOW_SIZE = "5 minutes"
WINDOW_SLIDE = "1 minute"
ALERT_THRESHOLD = 10
# Serving layout: one wide table, three column families, every cell a string.
SERVING_FAMILIES = ("metrics", "meta", "alert")
# ---------------------------------------------------------------------------

EVENT_FIELDS = (
    ("event_id", T.StringType()),
    ("schema_version", T.StringType()),
    ("event_type", T.StringType()),
    ("event_time", T.StringType()),
    ("ingested_at", T.StringType()),
    ("source", T.StringType()),
    ("user_id", T.StringType()),
    ("session_id", T.StringType()),
    ("product_id", T.StringType()),
    ("category", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", T.DoubleType()),
    ("total_value", T.DoubleType()),
    ("cart_action", T.StringType()),
    ("order_id", T.StringType()),
    ("delivery_status", T.StringType()),
)
EVENT_COLUMNS = tuple(name for name, _ in EVENT_FIELDS)

# Typed event table (what decode produces, what the adapter produces).
EVENT = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])

# Wire schema for decoding: every field as text, plus the corrupt marker.
CORRUPT = "_corrupt_record"
EVENT_TEXT = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in EVENT_COLUMNS]
    + [T.StructField(CORRUPT, T.StringType(), True)]
)

# The 8-column raw external table of the SQL path.
RAW_LOGS_DDL = (
    "event_id STRING, event_type STRING, product_id STRING, category STRING, "
    "cart_action STRING, total_value DOUBLE, delivery_status STRING, event_time STRING"
)
RAW_LOGS_COLUMNS = ("event_id", "event_type", "product_id", "category", "cart_action",
                    "total_value", "delivery_status", "event_time")

# Insight tables of the batch ETL.
INSIGHTS_CLIQUES_DDL = "product_id STRING, total_clicks BIGINT"
INSIGHTS_VENDAS_DDL = ("product_id STRING, category STRING, events BIGINT, "
                       "revenue DOUBLE, average_price DOUBLE")
