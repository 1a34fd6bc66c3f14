"""Independent DuckDB SQL for every batch-checkable query.

The event adapter is re-expressed in SQL (``EV``); each query then states
the expected result directly.  Column names equal the Spark outputs.
Conventions that keep both engines bit-identical:

* epoch ms from µs data: ``epoch_us(ts) // 1000`` (``epoch_ms`` rounds);
* money sums as integers scaled by 2**60 (exact for the given values), rounded once;
* DuckDB ``sum(int)`` is HUGEINT -> cast to BIGINT;
* "last by arrival": ``arg_max(x, arrival) FILTER (x <> '')`` with arrival =
  ``lpad(ingested_ms, 20, '0') || event_id``.
"""

from __future__ import annotations

EV = r"""
WITH src AS (
    SELECT event_id AS seq, user_id AS user_num, event_type AS src_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 + 1 AS k8,
           epoch_us(ts) // 1000 AS event_ms,
           CASE WHEN event_id % 5 = 0 THEN (event_id % 11) * 1000 ELSE 0 END AS lag_ms
    FROM events
), ev AS (
    SELECT
        printf('evt-%08d', seq) AS event_id,
        '1.0' AS schema_version,
        CASE src_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'cart'
                      WHEN 'purchase' THEN 'cart' WHEN 'signup' THEN 'delivery_status'
                      ELSE src_type END AS event_type,
        strftime(make_timestamp(event_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time,
        strftime(make_timestamp((event_ms + lag_ms) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS ingested_at,
        'web' AS source,
        printf('user-%04d', user_num) AS user_id,
        'sess-' || printf('user-%04d', user_num) || '-01' AS session_id,
        printf('prod-%03d', k8) AS product_id,
        (['eletronicos','informatica','casa','esportes','moda','beleza','livros','brinquedos'])[k8] AS category,
        CAST(CASE WHEN src_type = 'click' THEN 1 ELSE seq % 3 + 1 END AS INTEGER) AS quantity,
        value AS unit_price,
        CASE WHEN src_type = 'click' THEN CAST(0.0 AS DOUBLE)
             WHEN src_type = 'error' THEN CAST(NULL AS DOUBLE)
             ELSE round(value * (seq % 3 + 1), 2) END AS total_value,
        CASE WHEN src_type = 'view' THEN CASE WHEN seq % 5 = 0 THEN 'remove' ELSE 'add' END
             WHEN src_type = 'purchase' THEN 'checkout' END AS cart_action,
        CASE WHEN src_type IN ('purchase', 'signup') THEN printf('order-%04d', user_num) END AS order_id,
        CASE WHEN src_type = 'signup' THEN
             (['created','shipped','in_transit','out_for_delivery','delivered'])[seq % 5 + 1] END
             AS delivery_status,
        seq AS event_seq, event_ms, event_ms + lag_ms AS ingested_ms,
        lpad(CAST(event_ms + lag_ms AS VARCHAR), 20, '0') || printf('evt-%08d', seq) AS arrival
    FROM src
)
"""

EVENT_COLS = ("event_id, schema_version, event_type, event_time, ingested_at, source, user_id, "
              "session_id, product_id, category, quantity, unit_price, total_value, cart_action, "
              "order_id, delivery_status")


def _last(col: str, default: str | None) -> str:
    e = f"arg_max({col}, arrival) FILTER (WHERE {col} IS NOT NULL AND {col} <> '')"
    return f"coalesce({e}, '{default}')" if default is not None else e


def _first(col: str, default: str | None) -> str:
    e = f"arg_min({col}, arrival) FILTER (WHERE {col} IS NOT NULL AND {col} <> '')"
    return f"coalesce({e}, '{default}')" if default is not None else e


def _windows(size_ms: int, slide_ms: int, extra_where: str = "") -> str:
    n = size_ms // slide_ms
    return f"""
    SELECT product_id, ws AS window_start, ws + {size_ms} AS window_end, event_time, arrival
    FROM (SELECT product_id, event_time, arrival,
                 (event_ms // {slide_ms}) * {slide_ms} - i * {slide_ms} AS ws
          FROM (SELECT *, unnest(range(0, {n})) AS i FROM ev
                WHERE event_type = 'click' {extra_where}))
    """


def _window_counts(size_ms: int, slide_ms: int, extra: str = "") -> str:
    return f"""
    SELECT product_id, window_start, window_end, count(*) AS click_count
    FROM ({_windows(size_ms, slide_ms)}) w
    GROUP BY product_id, window_start, window_end {extra}
    """


def _alerts(size_ms: int, slide_ms: int, threshold: int, having_extra: str = "") -> str:
    return f"""
    SELECT 'alert|' || product_id || '|' || CAST(window_start AS VARCHAR) || '|'
               || CAST(window_end AS VARCHAR) AS row_key,
           product_id, 'HIGH_CLICK_VOLUME' AS alert_type, count(*) AS click_count,
           window_start, window_end,
           {_first('event_time', '')} AS first_event_time,
           {_last('event_time', '')} AS last_event_time
    FROM ({_windows(size_ms, slide_ms)}) w
    GROUP BY product_id, window_start, window_end
    HAVING count(*) >= {threshold} {having_extra}
    """


MIN, HOUR, DAY = 60_000, 3_600_000, 86_400_000
WATERMARK_MS = 15_000
CLOSED = f"AND window_end <= (SELECT max(event_ms) FROM ev) - {WATERMARK_MS}"

def _exact(value: str) -> str:
    """Sum of doubles without rounding in between."""
    return f"CAST(sum(CAST({value} * 1152921504606846976 AS HUGEINT)) AS DOUBLE) / 1152921504606846976"


_PRODUCT_METRICS = f"""
    SELECT product_id,
           CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
           CAST(count(*) FILTER (WHERE event_type = 'cart' AND cart_action = 'add') AS BIGINT) AS cart_adds,
           CAST(count(*) FILTER (WHERE event_type = 'cart' AND cart_action = 'checkout') AS BIGINT) AS checkouts,
           coalesce({_exact("CASE WHEN event_type = 'cart' AND cart_action = 'checkout' THEN TRY_CAST(total_value AS DOUBLE) END")}, 0) AS orders_value,
           CAST(count(*) FILTER (WHERE event_type = 'delivery_status' AND delivery_status = 'delivered') AS BIGINT) AS delivered,
           {_last('category', 'unknown')} AS category,
           {_last('event_time', '')} AS last_event_time,
           {_last('event_id', '')} AS last_event_id
    FROM ev WHERE product_id IS NOT NULL AND product_id <> ''
    GROUP BY product_id
"""

_PRODUCT_METRICS_BATCH = f"""
    SELECT product_id, category,
           CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS total_clicks,
           CAST(sum(CASE WHEN event_type = 'cart' AND cart_action = 'add' THEN 1 ELSE 0 END) AS BIGINT) AS total_cart_adds,
           CAST(sum(CASE WHEN event_type = 'cart' AND cart_action = 'checkout' THEN 1 ELSE 0 END) AS BIGINT) AS total_checkouts,
           {_exact("CASE WHEN event_type = 'cart' AND cart_action = 'checkout' THEN total_value ELSE 0 END")} AS total_revenue,
           CAST(sum(CASE WHEN event_type = 'delivery_status' AND delivery_status = 'delivered' THEN 1 ELSE 0 END) AS BIGINT) AS total_delivered
    FROM ev WHERE product_id IS NOT NULL
    GROUP BY product_id, category
"""

_SALES = f"""
    SELECT product_id, category, count(*) AS events,
           {_exact("total_value")} AS revenue,
           {_exact("unit_price")} / CAST(count(unit_price) AS DOUBLE) AS average_price
    FROM ev WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND total_value IS NOT NULL
    GROUP BY product_id, category
"""

_CLICKS_BY_PRODUCT = """
    SELECT product_id, count(*) AS total_clicks
    FROM ev WHERE event_id IS NOT NULL AND event_type = 'click'
    GROUP BY product_id
"""


def _digest(label: str, relations: dict[str, tuple[str, str]]) -> str:
    """Count and content digest of each relation, given as (rows, columns)."""
    parts = []
    for name, (rows, columns) in relations.items():
        texts = [f"CASE WHEN typeof({c}) = 'DOUBLE' THEN printf('%.6f', TRY_CAST({c} AS DOUBLE) + 0.0) "
                 f"ELSE CAST({c} AS VARCHAR) END" for c in sorted(columns.replace(",", " ").split())]
        row = " || ".join(f"coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || ({t}), '-')" for t in texts)
        parts.append(f"SELECT '{name}' AS {label}, count(*) AS n, "
                     f"coalesce(CAST(sum(CAST('0x' || md5({row})[1:15] AS BIGINT)) AS VARCHAR), '0') AS digest "
                     f"FROM ({rows})")
    return " UNION ALL ".join(parts)


_CLICK_TABLE = (_CLICKS_BY_PRODUCT, "product_id total_clicks")
_SALES_TABLE = (_SALES, "product_id category events revenue average_price")
_TOTALS_TABLE = (_PRODUCT_METRICS_BATCH, "product_id category total_clicks total_cart_adds total_checkouts "
                                         "total_revenue total_delivered")
_METRICS_TABLE = (_PRODUCT_METRICS, "product_id clicks cart_adds checkouts orders_value delivered category "
                                    "last_event_time last_event_id")
_ALERT_COLUMNS = ("row_key product_id alert_type click_count window_start window_end first_event_time "
                  "last_event_time")


def _damaged(drop_product_key: bool) -> str:
    """The quarantine fixture rebuilt in SQL (classification by DuckDB's JSON reader)."""
    null_pid = "" if drop_product_key else "'product_id', NULL,"
    return f"""
    , lines AS (
        SELECT event_seq,
               CAST(json_object('event_id', event_id, 'event_type', event_type,
                    'product_id', product_id, 'event_time', event_time) AS VARCHAR) AS full_line,
               CAST(json_object('event_id', event_id, 'event_type', event_type,
                    {null_pid} 'event_time', event_time) AS VARCHAR) AS no_product_line
        FROM ev
    ), damaged AS (
        SELECT CASE event_seq % 50
                 WHEN 0 THEN substr(full_line, 1, 40)
                 WHEN 1 THEN no_product_line
                 WHEN 2 THEN '   '
                 WHEN 3 THEN '[' || full_line || ']'
                 ELSE full_line END AS line
        FROM lines
    )
    """


_REJECTS = EV + _damaged(False) + """
    SELECT reason, count(*) AS n FROM (
        SELECT CASE
                 WHEN trim(line) = '' THEN 'blank'
                 WHEN NOT json_valid(line) THEN 'malformed'
                 WHEN json_type(ok_line) <> 'OBJECT' THEN 'not_object'
                 WHEN coalesce(json_extract_string(ok_line, '$.product_id'), '') = '' THEN 'no_product'
               END AS reason
        FROM (SELECT line, CASE WHEN json_valid(line) THEN line END AS ok_line FROM damaged))
    WHERE reason IS NOT NULL
    GROUP BY reason
"""

_UNKNOWN_PRODUCT = EV + _damaged(True) + """
    SELECT CASE WHEN json_exists(ok_line, '$.product_id')
                THEN coalesce(json_extract_string(ok_line, '$.product_id'), 'null')
                ELSE 'unknown' END AS product_id,
           count(*) AS n
    FROM (SELECT CASE WHEN json_valid(line) THEN line END AS ok_line FROM damaged)
    WHERE json_type(ok_line) = 'OBJECT'
    GROUP BY 1
"""

_SERVING_ROWS = EV + f"""
    , pm AS ({_PRODUCT_METRICS}),
    al AS ({_alerts(DAY, 6 * HOUR, 10)}),
    cells AS (
        SELECT product_id AS row_key, 'metrics' AS family, 'clicks' AS qualifier, CAST(clicks AS VARCHAR) AS value FROM pm
        UNION ALL SELECT product_id, 'metrics', 'cart_adds', CAST(cart_adds AS VARCHAR) FROM pm
        UNION ALL SELECT product_id, 'metrics', 'checkouts', CAST(checkouts AS VARCHAR) FROM pm
        UNION ALL SELECT product_id, 'metrics', 'orders_value', printf('%.2f', CAST(orders_value AS DECIMAL(18,2))) FROM pm
        UNION ALL SELECT product_id, 'metrics', 'delivered', CAST(delivered AS VARCHAR) FROM pm
        UNION ALL SELECT product_id, 'meta', 'category', category FROM pm
        UNION ALL SELECT product_id, 'meta', 'last_event_time', last_event_time FROM pm
        UNION ALL SELECT product_id, 'meta', 'last_event_id', last_event_id FROM pm
        UNION ALL SELECT row_key, 'alert', 'product_id', product_id FROM al
        UNION ALL SELECT row_key, 'alert', 'type', alert_type FROM al
        UNION ALL SELECT row_key, 'alert', 'click_count', CAST(click_count AS VARCHAR) FROM al
        UNION ALL SELECT row_key, 'alert', 'window_start', CAST(window_start AS VARCHAR) FROM al
        UNION ALL SELECT row_key, 'alert', 'window_end', CAST(window_end AS VARCHAR) FROM al
        UNION ALL SELECT row_key, 'alert', 'first_event_time', first_event_time FROM al
        UNION ALL SELECT row_key, 'alert', 'last_event_time', last_event_time FROM al
    )
"""

_ORDER_PROGRESS = EV + f"""
    , co AS (
        SELECT order_id, {_first('event_time', '')} AS first_checkout_time, count(*) AS checkouts
        FROM ev WHERE order_id IS NOT NULL AND event_type = 'cart' AND cart_action = 'checkout'
        GROUP BY order_id
    ), de AS (
        SELECT order_id, {_last('delivery_status', None)} AS latest_status,
               count(*) AS delivery_events,
               bool_or(delivery_status = 'delivered') AS delivered
        FROM ev WHERE order_id IS NOT NULL AND event_type = 'delivery_status'
        GROUP BY order_id
    )
    SELECT co.order_id, first_checkout_time, checkouts, latest_status,
           coalesce(delivery_events, 0) AS delivery_events, coalesce(delivered, false) AS delivered
    FROM co LEFT JOIN de ON co.order_id = de.order_id
"""

_RECONCILE = EV + f"""
    , pm AS ({_PRODUCT_METRICS}),
    pb AS (
        SELECT product_id, sum(total_clicks) AS total_clicks, sum(total_cart_adds) AS total_cart_adds,
               sum(total_checkouts) AS total_checkouts,
               sum(CAST(total_revenue AS DECIMAL(18,2))) AS total_revenue,
               sum(total_delivered) AS total_delivered
        FROM ({_PRODUCT_METRICS_BATCH}) GROUP BY product_id
    )
    SELECT coalesce(pm.product_id, pb.product_id) AS product_id,
           CAST(coalesce(clicks, 0) - coalesce(total_clicks, 0) AS BIGINT) AS clicks_diff,
           CAST(coalesce(cart_adds, 0) - coalesce(total_cart_adds, 0) AS BIGINT) AS cart_adds_diff,
           CAST(coalesce(checkouts, 0) - coalesce(total_checkouts, 0) AS BIGINT) AS checkouts_diff,
           CAST(CAST(coalesce(orders_value, 0) AS DECIMAL(18,2))
                - CAST(coalesce(total_revenue, 0) AS DECIMAL(18,2)) AS DOUBLE) AS orders_value_diff,
           CAST(coalesce(delivered, 0) - coalesce(total_delivered, 0) AS BIGINT) AS delivered_diff,
           pm.product_id IS NOT NULL AS in_running,
           pb.product_id IS NOT NULL AS in_batch
    FROM pm FULL OUTER JOIN pb ON pm.product_id = pb.product_id
"""

_CONTRACT = EV + """
    , flags AS (
        SELECT
          count(*) FILTER (WHERE event_type IS NULL
                OR event_type NOT IN ('click', 'cart', 'delivery_status')) AS unknown_event_type,
          count(*) FILTER (WHERE event_type = 'cart' AND (cart_action IS NULL
                OR cart_action NOT IN ('add', 'remove', 'checkout'))) AS cart_without_valid_action,
          count(*) FILTER (WHERE event_type = 'delivery_status' AND (delivery_status IS NULL
                OR delivery_status NOT IN ('created','shipped','in_transit','out_for_delivery','delivered')))
                AS delivery_without_valid_status,
          count(*) FILTER (WHERE event_type IS DISTINCT FROM 'cart' AND cart_action IS NOT NULL) AS action_on_non_cart,
          count(*) FILTER (WHERE event_type IN ('cart', 'delivery_status')
                AND abs(total_value - round(unit_price * quantity, 2)) > 0.005) AS total_mismatch,
          count(*) FILTER (WHERE event_type = 'click' AND (total_value IS NULL OR total_value <> 0)) AS click_with_value
        FROM ev
    )
    SELECT 'unknown_event_type' AS rule, unknown_event_type AS n FROM flags
    UNION ALL SELECT 'cart_without_valid_action', cart_without_valid_action FROM flags
    UNION ALL SELECT 'delivery_without_valid_status', delivery_without_valid_status FROM flags
    UNION ALL SELECT 'action_on_non_cart', action_on_non_cart FROM flags
    UNION ALL SELECT 'total_mismatch', total_mismatch FROM flags
    UNION ALL SELECT 'click_with_value', click_with_value FROM flags
"""

_BRANCH = EV + "SELECT event_id, event_type, product_id FROM ev WHERE event_id IS NOT NULL AND event_type IS NOT NULL"

ORACLE: dict[str, str] = {
    "event_count": EV + "SELECT count(*) AS n FROM ev",
    "raw_logs": EV + "SELECT event_id, event_type, product_id, category, cart_action, "
                     "total_value, delivery_status, event_time FROM ev",
    "decoded_events": EV + f"SELECT {EVENT_COLS}, event_ms FROM ev",
    "decode_rejects": _REJECTS,
    "decoded_unknown_product": _UNKNOWN_PRODUCT,
    "event_times": EV + "SELECT event_id, event_ms FROM ev",
    "clean_events": _BRANCH,
    "clicks": _BRANCH + " AND event_type = 'click'",
    "carts": _BRANCH + " AND event_type = 'cart'",
    "deliveries": _BRANCH + " AND event_type = 'delivery_status'",
    "clicks_by_product": EV + _CLICKS_BY_PRODUCT,
    "top_clicked": EV + _CLICKS_BY_PRODUCT
                   + " ORDER BY total_clicks DESC, product_id ASC NULLS LAST LIMIT 20",
    "top_clicked_saved": EV + _CLICKS_BY_PRODUCT
                         + " ORDER BY total_clicks DESC, product_id ASC NULLS LAST LIMIT 20",
    "insights_cliques": EV + _CLICKS_BY_PRODUCT,
    "insights_vendas": EV + _SALES,
    "product_totals_table": EV + _PRODUCT_METRICS_BATCH,
    "landed_sales": EV + _SALES,
    "pipeline_product_metrics": EV + _PRODUCT_METRICS,
    "sales": EV + _SALES,
    "product_metrics_batch": EV + _PRODUCT_METRICS_BATCH,
    "product_metrics": EV + _PRODUCT_METRICS,
    "click_windows": EV + _window_counts(5 * MIN, MIN),
    "click_window_lines": EV + f"""
        SELECT printf('ALERTA | produto=%s | clicks=%d | janela=%d-%d',
                      product_id, click_count, window_start, window_end) AS line
        FROM ({_window_counts(5 * MIN, MIN)})""",
    "click_alerts": EV + _alerts(5 * MIN, MIN, 10),
    "click_alerts_1d": EV + _alerts(DAY, 6 * HOUR, 10),
    "serving_rows": _SERVING_ROWS + " SELECT * FROM cells",
    "serving_scan": _SERVING_ROWS + """
        SELECT * FROM cells WHERE row_key IN
            (SELECT DISTINCT row_key FROM cells ORDER BY row_key LIMIT 10)""",
    "serving_get": _SERVING_ROWS + " SELECT * FROM cells WHERE row_key = 'prod-001'",
    "contract_violations": _CONTRACT,
    "lateness_profile": EV + f"""
        SELECT event_type, count(*) AS n,
               count(*) FILTER (WHERE ingested_ms - event_ms > 0) AS late_n,
               max(ingested_ms - event_ms) AS max_lag_ms,
               count(*) FILTER (WHERE ingested_ms - event_ms > {WATERMARK_MS}) AS over_watermark_n
        FROM ev GROUP BY event_type""",
    "order_progress": _ORDER_PROGRESS,
    "reconcile_metrics": _RECONCILE,
    # streams: bounded availableNow runs; windows close at max(event time) - 15 s
    "stream_product_metrics": EV + _PRODUCT_METRICS,
    "stream_click_windows": EV + _window_counts(5 * MIN, MIN, f"HAVING true {CLOSED}"),
    "stream_click_alerts": EV + _alerts(5 * MIN, MIN, 10, CLOSED),
    "stream_click_alerts_1d": EV + _alerts(DAY, 6 * HOUR, 10, CLOSED),
    "reconcile_stream": _RECONCILE,
    "reconcile_tables": _RECONCILE,
    "stream_decode_rejects": _REJECTS,
    "stream_decode_once_metrics": EV + _PRODUCT_METRICS,
    "stream_job_rejects": _REJECTS,
    "stream_job_alerts": EV + _alerts(DAY, 6 * HOUR, 10, CLOSED),
    "stream_job_serving": _SERVING_ROWS.replace(_alerts(DAY, 6 * HOUR, 10), _alerts(DAY, 6 * HOUR, 10, CLOSED))
    + " SELECT * FROM cells",
    "stream_late_rows": EV + f"""
        , numbered AS (SELECT *, CAST(substr(event_id, 5) AS BIGINT) % 5 AS part FROM ev),
        parts AS (SELECT part, max(event_ms) AS greatest_ms FROM numbered GROUP BY part),
        marks AS (SELECT a.part, max(b.greatest_ms) - {WATERMARK_MS} AS mark
                  FROM parts a JOIN parts b ON b.part < a.part GROUP BY a.part)
        SELECT event_id, product_id, event_ms, mark AS watermark_ms,
               (SELECT count(*) FROM range(1, 6) ends(k)
                WHERE event_ms - event_ms % {MIN} + k * {MIN} <= mark) AS closed_windows,
               n.part AS batch_id
        FROM numbered n JOIN marks m ON n.part = m.part WHERE event_ms < mark""",
    "stable_gate": EV + "SELECT event_id, product_id, event_type FROM ev WHERE CAST(substr(event_id, 5) AS BIGINT) % 2 = 0",
    "click_preview": EV + _CLICKS_BY_PRODUCT + " ORDER BY total_clicks DESC, product_id LIMIT 5",
    "listed_tables": """
        SELECT unnest(['insights_cliques', 'insights_vendas', 'raw_logs', 'product_metrics_batch',
                       'ecommerce_metrics']) AS table_name, false AS temporary""",
    "stream_landing": EV + _digest("sink", {"raw": ("SELECT * FROM ev", EVENT_COLS),
                                            "staging": ("SELECT * FROM ev", EVENT_COLS)}),
    "insights_tables": EV + _digest("table_name", {
        "insights_cliques": _CLICK_TABLE, "insights_vendas": _SALES_TABLE, "product_metrics_batch": _TOTALS_TABLE}),
    "validation_summary": EV + _digest("relation", {
        "raw_events": ("SELECT * FROM ev", EVENT_COLS), "product_metrics": _METRICS_TABLE,
        "click_alerts": (_alerts(DAY, 6 * HOUR, 10), _ALERT_COLUMNS),
        "insights_cliques": _CLICK_TABLE, "insights_vendas": _SALES_TABLE}),
}
