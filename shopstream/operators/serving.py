"""Wide serving view: ``(row_key, family, qualifier, value)`` string cells.

Metrics rows are keyed by product id (families ``metrics`` and ``meta``);
alert rows by ``alert|product|start|end`` (family ``alert``).  The typed
tables stay the source of truth; this view is a ``stack`` over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.columns import fmt_money

CELL_COLUMNS = ("row_key", "family", "qualifier", "value")


# ---------------------------------------------------------------------------
# Serving cell layout (family, qualifier, source column).
# orders_value is rendered as money.
METRIC_SPEC = (
    ("metrics", "clicks", "clicks"),
    ("metrics", "cart_adds", "cart_adds"),
    ("metrics", "checkouts", "checkouts"),
    ("metrics", "orders_value", "orders_value"),
    ("metrics", "delivered", "delivered"),
    ("meta", "category", "category"),
    ("meta", "last_event_time", "last_event_time"),
    ("meta", "last_event_id", "last_event_id"),
)
ALERT_SPEC = (
    ("alert", "product_id", "product_id"),
    ("alert", "type", "alert_type"),
    ("alert", "click_count", "click_count"),
    ("alert", "window_start", "window_start"),
    ("alert", "window_end", "window_end"),
    ("alert", "first_event_time", "first_event_time"),
    ("alert", "last_event_time", "last_event_time"),
)
# ---------------------------------------------------------------------------
_MONEY_CELLS = {"orders_value"}


def _cells(spec) -> Column:
    def value(src: str) -> Column:
        return fmt_money(F.col(src)) if src in _MONEY_CELLS else F.col(src).cast("string")
    return F.explode(F.array(*[
        F.struct(F.lit(fam).alias("family"), F.lit(q).alias("qualifier"),
                 value(src).alias("value"))
        for fam, q, src in spec]))


def metric_cells(product_metrics: DataFrame) -> DataFrame:
    return (product_metrics.select(F.col("product_id").alias("row_key"),
                                   _cells(METRIC_SPEC).alias("cell"))
            .select("row_key", "cell.*"))


def alert_cells(alerts: DataFrame) -> DataFrame:
    return (alerts.select("row_key", _cells(ALERT_SPEC).alias("cell"))
            .select("row_key", "cell.*"))


def serving_rows(product_metrics: DataFrame, alerts: DataFrame) -> DataFrame:
    return metric_cells(product_metrics).unionByName(alert_cells(alerts))


def scan(rows: DataFrame, limit: int | None = 10, start_key: str | None = None) -> DataFrame:
    """Key-ordered scan; ``limit`` counts row keys (not cells).

    The cells of a key are gathered into one row (its width is that of the
    wide row), the rows are ordered by key, cut by a top-k and spread again,
    so a key always comes with all its cells, however many it has.
    """
    if start_key is not None:
        rows = rows.filter(F.col("row_key") >= start_key)
    cells = F.sort_array(F.collect_list(F.struct("family", "qualifier", "value")))
    wide = rows.groupBy("row_key").agg(cells.alias("cells")).orderBy("row_key")
    if limit is not None:
        wide = wide.limit(limit)
    return wide.select("row_key", F.explode("cells").alias("cell")).select("row_key", "cell.*")


def get(rows: DataFrame, row_key: str) -> DataFrame:
    """Point lookup of one row (all its cells)."""
    return rows.filter(F.col("row_key") == row_key)
