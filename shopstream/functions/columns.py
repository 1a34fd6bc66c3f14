"""Scalar Column helpers (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopstream.schema import ISO_MS_FORMAT

_DATE_SHAPE = r"^\s*\d{4}-\d{2}-\d{2}"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c: Column | str, width: int) -> Column:
    """``%0{width}d``: pads to at least ``width`` digits, never truncates."""
    text = col_of(c).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), "0")


def truthy(c: Column | str) -> Column:
    """Python truthiness of an optional string: NULL and '' both miss."""
    return F.nullif(col_of(c), F.lit(""))


def parse_iso_ts(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP; 'Z' or an offset is applied, naive = UTC.

    Only text that starts with a calendar date is accepted: a bare ``2024`` or
    ``12:30`` would otherwise cast (the latter to *today*).
    """
    c = col_of(c)
    return F.when(c.rlike(_DATE_SHAPE), F.trim(c).try_cast("timestamp"))


def parse_iso_ts_sql(expr: str) -> str:
    """SQL-text form of :func:`parse_iso_ts` for ``selectExpr``."""
    return f"CASE WHEN {expr} RLIKE r'{_DATE_SHAPE}' THEN try_cast(trim({expr}) AS TIMESTAMP) END"


def event_timestamp_sql(event_time: str, ingested_at: str) -> str:
    """SQL-text form of :func:`event_timestamp`."""
    return (f"coalesce({parse_iso_ts_sql(event_time)}, {parse_iso_ts_sql(ingested_at)}, "
            f"current_timestamp())")


def event_timestamp(event_time: Column | str, ingested_at: Column | str) -> Column:
    """Event-time assigner: event_time, else the arrival clock, else now.

    Falling back to the parsed arrival time first keeps replays deterministic;
    the processing clock is only the last resort.
    """
    return F.coalesce(parse_iso_ts(event_time), parse_iso_ts(ingested_at),
                      F.current_timestamp())


def iso_ms(ms: Column | str) -> Column:
    """epoch milliseconds -> ``yyyy-MM-ddTHH:mm:ss.SSSZ`` text (UTC)."""
    return F.date_format(F.timestamp_millis(col_of(ms)), ISO_MS_FORMAT)


def to_money(c: Column | str) -> Column:
    """Float with fallback 0: bad, missing or non-finite values are 0, all others stay as they are."""
    value = col_of(c).try_cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")), value).otherwise(F.lit(0.0))


def count_when(cond: Column) -> Column:
    """Conditional count as BIGINT (0 when nothing matches)."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long"),
                      F.lit(0).cast("long"))


def fmt_money(c: Column | str) -> Column:
    """Text of a number with two decimals, whatever its size."""
    c = col_of(c).cast("double")
    return F.when(c.isNotNull(), F.format_string("%.2f", c))


def arrival_key(ingested_ms: Column | str = "ingested_ms",
                event_id: Column | str = "event_id") -> Column:
    """Arrival order: DataFrames have none, (ingested time, event id) stands in."""
    return F.struct(col_of(ingested_ms).alias("ingested_ms"),
                    col_of(event_id).alias("event_id"))


def last_by_arrival(value: Column | str, order: Column, default: str | None = None) -> Column:
    """Newest non-empty value by arrival; ``default`` when none was ever set."""
    v = truthy(value)
    picked = F.max_by(v, F.when(v.isNotNull(), order))
    return picked if default is None else F.coalesce(picked, F.lit(default))


def first_by_arrival(value: Column | str, order: Column, default: str | None = None) -> Column:
    """Oldest non-empty value by arrival."""
    v = truthy(value)
    picked = F.min_by(v, F.when(v.isNotNull(), order))
    return picked if default is None else F.coalesce(picked, F.lit(default))


def ever(cond: Column) -> Column:
    """Whether the condition holds in any row of the group.

    Held as a set of at most two booleans, which is an aggregate over objects. A
    grouping that has one keeps all its buffers in a hash map of objects
    (ObjectHashAggregate), the text winners of ``max_by`` among them; without one
    Spark sorts every task's rows by key to hold text (SortAggregate). Beyond
    ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` groups a task
    goes on by sorting, so its memory stays bounded.
    """
    return F.array_contains(F.collect_set(F.coalesce(cond, F.lit(False))), True)


def epoch_ms(ts: Column | str) -> Column:
    return F.unix_millis(col_of(ts))
