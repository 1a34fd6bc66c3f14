"""JSON-line decode: lines -> typed events, bad lines -> quarantine.

One ``from_json`` pass per line, all fields read as text and converted with
``try_cast``; everything stays in whole-stage codegen (no Python per row).
Reject reasons, checked in this order:

* ``blank``       — NULL or whitespace-only line
* ``not_object``  — valid JSON whose root is not an object (array, string, …)
* ``malformed``   — not parseable as one JSON value (truncated, trailing text,
  two objects on a line, …)
* ``no_product``  — object whose ``product_id`` is missing, empty or another
  falsy value (``0``, ``false``, ``[]``, ``{}``); the text ``"0"`` is a product

Accepted deviations from a per-line Python ``json.loads``: another number,
``true`` or a filled array as ``product_id`` is kept as its text; bare ``NaN`` / ``true`` as a money
value counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.columns import event_timestamp_sql, parse_iso_ts, parse_iso_ts_sql
from shopstream.schema import EVENT_COLUMNS, EVENT_FIELDS
from shopstream.session import ensure_utc

REASONS = ("blank", "not_object", "malformed", "no_product")
LINE_HEAD_CHARS = 200

_SCALAR = r"^(-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?|true|false|null)$"
# non-standard literals a Python JSON reader accepts as (non-object) values
_PY_LITERAL = r"^(NaN|-?Infinity)$"
_FALSY = r"^(-?0(\.0+)?([eE][+-]?\d+)?|false|\[\s*\]|\{\s*\})$"


def once(df: DataFrame, *cols: Column) -> DataFrame:
    """Project ``cols`` behind a one-row ``inline``.

    Catalyst inlines a projected expression into every filter and expression
    that references it; for a parser that means one parse per reference.
    A generator is not collapsed or pushed through, so the parse runs once.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


# Fields every decode needs: the reject reason reads product_id, the
# event-time assigner reads event_time and ingested_at.
ALWAYS_PARSED = ("product_id", "event_time", "ingested_at")


def _parsed_fields(fields) -> tuple:
    """The (name, type) pairs to parse: all, or ``fields`` + :data:`ALWAYS_PARSED`."""
    if fields is None:
        return EVENT_FIELDS
    want = set(fields) | set(ALWAYS_PARSED)
    unknown = want - {n for n, _ in EVENT_FIELDS}
    if unknown:
        raise ValueError(f"not event fields: {sorted(unknown)}")
    return tuple((n, t) for n, t in EVENT_FIELDS if n in want)


def _parse_sql(t: str, parsed) -> str:
    """The line as an element of a JSON array, before an empty end element; fields as text.

    A reader stops after the first value of a text. Inside an array a second
    object or trailing text fails the parse or changes the number of elements,
    so only a line that is one object gives two.
    """
    fields = ", ".join(f"{n}: STRING" for n, _ in parsed)
    return f"from_json(concat('[', {t}, ',{{}}]'), 'ARRAY<STRUCT<{fields}>>')"


# Outcome of a line, checked in order (``_t`` trimmed line, ``_p`` parsed array).
# ``try_parse_json`` ignores trailing text, so a non-object line must also have
# the shape of one array / string / scalar to count as valid JSON.
_REASON_SQL = f"""
CASE
  WHEN _t IS NULL OR _t = '' THEN 'blank'
  WHEN NOT (startswith(_t, '{{') AND endswith(_t, '}}')) THEN
    CASE WHEN _t RLIKE r'{_PY_LITERAL}' THEN 'not_object'
         WHEN ((startswith(_t, '[') AND endswith(_t, ']'))
               OR (startswith(_t, '"') AND endswith(_t, '"') AND length(_t) > 1)
               OR _t RLIKE r'{_SCALAR}')
              AND try_parse_json(_t) IS NOT NULL
         THEN 'not_object' ELSE 'malformed' END
  WHEN _p IS NULL OR size(_p) <> 2 OR get(_p, 0) IS NULL THEN 'malformed'
  WHEN get(_p, 0).product_id IS NULL OR get(_p, 0).product_id = '' THEN 'no_product'
  -- text that a falsy value would give: only then is the line looked at again, for the value's own type
  WHEN get(_p, 0).product_id RLIKE r'{_FALSY}'
       AND schema_of_variant(try_variant_get(try_parse_json(_t), '$.product_id', 'VARIANT')) <> 'STRING' THEN 'no_product'
END"""


def _strip_sql(expr: str) -> str:
    """Strip surrounding whitespace (space, tab, LF, CR, FF, VT), not only spaces."""
    return f"trim(BOTH ' \\t\\n\\r\\f\\u000B' FROM {expr})"


def _typed_sql(name: str, dtype) -> str:
    if dtype.simpleString() == "string":
        return f"get(_p, 0).{name} AS {name}"
    return f"try_cast(get(_p, 0).{name} AS {dtype.simpleString()}) AS {name}"


def decode_lines(lines: DataFrame, line_col: str = "value",
                 fields: tuple[str, ...] | None = None) -> DataFrame:
    """Every input line with its decode outcome.

    Output: ``line``, ``reason`` (NULL for good events), the typed event
    fields, ``event_ts`` (event-time assigner), ``event_ms`` and
    ``ingested_ms`` (arrival clock).  Use :func:`events_of` /
    :func:`rejects_of` to split.  Built as SQL expression text (a handful of
    gateway calls instead of one per Column node); the plan is the same.

    ``fields``: parse only these event fields (plus :data:`ALWAYS_PARSED`).
    The parse-once barrier hides the consumers from Catalyst's JSON schema
    pruning, so callers that know their columns prune here; reasons are the
    same, since the whole line is still tokenized and validated.
    """
    parsed = _parsed_fields(fields)
    ensure_utc(lines.sparkSession)   # event times without an offset are UTC
    src = f"`{line_col}`"
    t = _strip_sql(src)
    # ``once``: without the barrier, filters on ``reason`` are pushed below the
    # projection with ``from_json`` inlined: every line would be parsed twice.
    stage = lines.selectExpr(
        f"inline(array(struct({src} AS line, {t} AS _t, "
        f"{_parse_sql(t, parsed)} AS _p)))")
    out = stage.selectExpr("line", f"{_REASON_SQL} AS reason",
                           *[_typed_sql(n, dt) for n, dt in parsed])
    return out.selectExpr(
        "*",
        f"{event_timestamp_sql('event_time', 'ingested_at')} AS event_ts",
        f"unix_millis({parse_iso_ts_sql('ingested_at')}) AS ingested_ms",
    ).selectExpr("*", "unix_millis(event_ts) AS event_ms")


def events_of(decoded: DataFrame) -> DataFrame:
    """Good events: the parsed contract fields + event_ts, event_ms, ingested_ms."""
    cols = [c for c in EVENT_COLUMNS if c in decoded.columns]
    return decoded.filter(F.col("reason").isNull()).select(
        *cols, "event_ts", "event_ms", "ingested_ms")


def rejects_of(decoded: DataFrame) -> DataFrame:
    """Quarantine: reason and the first 200 characters of the line."""
    return decoded.filter(F.col("reason").isNotNull()).select(
        "reason", F.substring("line", 1, LINE_HEAD_CHARS).alias("line_head"))


def decode_events(lines: DataFrame, line_col: str = "value",
                  fields: tuple[str, ...] | None = None) -> DataFrame:
    return events_of(decode_lines(lines, line_col, fields))


def reject_counts(decoded: DataFrame) -> DataFrame:
    return rejects_of(decoded).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def decode_minimal(lines: DataFrame, line_col: str = "value",
                   on_missing_product: str = "unknown") -> DataFrame:
    """Three-field decode of the older alert job: event_type, product_id, event_ms.

    An *absent* product_id becomes ``on_missing_product``; a JSON ``null``
    becomes the text ``'null'`` (as a JSON tree's text value would).  Lines the
    older job would fail on (unparseable, no event_type, bad event_time) are
    dropped instead of failing the query.  Deviation: an object or array
    product_id keeps its JSON text, where a JSON tree's text value is empty.
    """
    t = F.expr(_strip_sql(f"`{line_col}`"))
    v = F.try_parse_json(t)
    stage = once(lines, t.alias("_t"), v.alias("_v"))
    v = F.col("_v")
    raw_pid = F.try_variant_get(v, "$.product_id", "variant")
    product = (F.when(raw_pid.isNull(), F.lit(on_missing_product))
                .when(F.is_variant_null(raw_pid), F.lit("null"))
                .otherwise(F.try_variant_get(v, "$.product_id", "string")))
    event_time = F.try_variant_get(v, "$.event_time", "string")
    ts = F.when(event_time.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), parse_iso_ts(event_time))
    out = stage.filter(v.isNotNull() & F.col("_t").startswith("{")).select(
        F.try_variant_get(v, "$.event_type", "string").alias("event_type"),
        product.alias("product_id"),
        F.unix_millis(ts).alias("event_ms"),
    )
    return out.filter(F.col("event_type").isNotNull() & F.col("event_ms").isNotNull())
