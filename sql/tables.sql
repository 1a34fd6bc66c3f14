-- Catalog objects of the batch path, for `spark-sql -f sql/tables.sql -d raw_dir=<folder> -d db=<database>`.
-- Same definitions as shopstream.sinks.catalog / shopstream.sources.jsonl.

CREATE DATABASE IF NOT EXISTS ${db};

CREATE TABLE IF NOT EXISTS ${db}.insights_cliques (
    product_id STRING,
    total_clicks BIGINT
) USING parquet;

CREATE TABLE IF NOT EXISTS ${db}.insights_vendas (
    product_id STRING,
    category STRING,
    events BIGINT,
    revenue DOUBLE,
    average_price DOUBLE
) USING parquet;

-- raw JSON-lines events, 8 of the 16 fields, read in place
CREATE TABLE IF NOT EXISTS ${db}.raw_logs (
    event_id STRING, event_type STRING, product_id STRING, category STRING,
    cart_action STRING, total_value DOUBLE, delivery_status STRING, event_time STRING
) USING json LOCATION '${raw_dir}';

-- product totals: created once, a second run leaves it unchanged
-- the statement is shopstream.operators.batch.PRODUCT_METRICS_BATCH_SQL, with its exact sum of doubles
CREATE TABLE IF NOT EXISTS ${db}.product_metrics_batch USING parquet AS
SELECT
    product_id,
    category,
    count_if(event_type = 'click') AS total_clicks,
    count_if(event_type = 'cart' AND cart_action = 'add') AS total_cart_adds,
    count_if(event_type = 'cart' AND cart_action = 'checkout') AS total_checkouts,
    CASE WHEN count(_revenue) > 0 THEN transform(transform(array(array(CAST(0 AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0)), coalesce(sum(CASE WHEN _revenue.bin = 0 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 1 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 2 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 3 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 4 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 5 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 6 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 7 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 8 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), coalesce(sum(CASE WHEN _revenue.bin = 9 THEN _revenue.whole END), CAST(0 AS DECIMAL(38,0))), CAST(0 AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0)))), a -> named_struct('a', a, 'p', aggregate(a, named_struct('carry', CAST(0 AS DECIMAL(38,0)), 'digits', CAST(array() AS ARRAY<BIGINT>)), (s, t) -> named_struct('carry', CAST(((t + s.carry) - pmod((t + s.carry), 4294967296BD)) / 4294967296BD AS DECIMAL(38,0)), 'digits', concat(s.digits, array(CAST(pmod((t + s.carry), 4294967296BD) AS BIGINT))))))), v -> IF(v.p.carry < 0, -transform(transform(array(aggregate(transform(v.a, t -> -t), named_struct('carry', CAST(0 AS DECIMAL(38,0)), 'digits', CAST(array() AS ARRAY<BIGINT>)), (s, t) -> named_struct('carry', CAST(((t + s.carry) - pmod((t + s.carry), 4294967296BD)) / 4294967296BD AS DECIMAL(38,0)), 'digits', concat(s.digits, array(CAST(pmod((t + s.carry), 4294967296BD) AS BIGINT))))).digits), d -> named_struct('d', d, 'k', size(d) - CAST(array_position(reverse(transform(d, x -> x > 0)), true) AS INT))), k -> IF(k.k >= size(k.d), 0D, CAST(CAST(k.d[k.k] AS DECIMAL(38,0)) * 18446744073709551616BD + CAST(k.d[k.k - 1] AS DECIMAL(38,0)) * 4294967296BD + (k.d[k.k - 2] | IF(exists(slice(k.d, 1, k.k - 2), x -> x > 0), 1, 0)) AS DOUBLE) * pow(2D, -180 + 32 * (k.k - 4))))[0], transform(transform(array(v.p.digits), d -> named_struct('d', d, 'k', size(d) - CAST(array_position(reverse(transform(d, x -> x > 0)), true) AS INT))), k -> IF(k.k >= size(k.d), 0D, CAST(CAST(k.d[k.k] AS DECIMAL(38,0)) * 18446744073709551616BD + CAST(k.d[k.k - 1] AS DECIMAL(38,0)) * 4294967296BD + (k.d[k.k - 2] | IF(exists(slice(k.d, 1, k.k - 2), x -> x > 0), 1, 0)) AS DOUBLE) * pow(2D, -180 + 32 * (k.k - 4))))[0]))[0] + coalesce(sum(_revenue.far), 0D) END AS total_revenue,
    count_if(event_type = 'delivery_status' AND delivery_status = 'delivered') AS total_delivered
FROM (SELECT *, CASE WHEN _bin IS NOT NULL THEN named_struct('bin', _bin, 'whole', CASE WHEN _bin >= 0 THEN CAST((CAST(floor((abs(_value) * array(1.532495540865889E+54D, 3.5681192317649E+44D, 8.307674973655724E+34D, 1.9342813113834067E+25D, 4503599627370496.0D, 1048576.0D, 0.000244140625D, 5.684341886080802E-14D, 1.3234889800848443E-23D, 3.0814879110195774E-33D)[_bin]) / 4398046511104D) AS DECIMAL(14,0)) * 4398046511104BD + CAST(CAST((abs(_value) * array(1.532495540865889E+54D, 3.5681192317649E+44D, 8.307674973655724E+34D, 1.9342813113834067E+25D, 4503599627370496.0D, 1048576.0D, 0.000244140625D, 5.684341886080802E-14D, 1.3234889800848443E-23D, 3.0814879110195774E-33D)[_bin]) - CAST(floor((abs(_value) * array(1.532495540865889E+54D, 3.5681192317649E+44D, 8.307674973655724E+34D, 1.9342813113834067E+25D, 4503599627370496.0D, 1048576.0D, 0.000244140625D, 5.684341886080802E-14D, 1.3234889800848443E-23D, 3.0814879110195774E-33D)[_bin]) / 4398046511104D) AS DOUBLE) * 4398046511104D AS BIGINT) AS DECIMAL(14,0))) * CAST(sign(_value) AS DECIMAL(1,0)) AS DECIMAL(28,0)) END, 'far', CASE WHEN _bin < 0 THEN _value END) END AS _revenue
      FROM (SELECT *, CASE WHEN _value IS NULL OR isnan(_value) OR abs(_value) = DOUBLE('Infinity') THEN NULL WHEN _value = 0 THEN 0 WHEN abs(_value) >= 6.277101735386681E+57D THEN -1 WHEN abs(_value) >= 1.461501637330903E+48D THEN 9 WHEN abs(_value) >= 3.402823669209385E+38D THEN 8 WHEN abs(_value) >= 7.922816251426434E+28D THEN 7 WHEN abs(_value) >= 1.8446744073709552E+19D THEN 6 WHEN abs(_value) >= 4294967296.0D THEN 5 WHEN abs(_value) >= 1.0D THEN 4 WHEN abs(_value) >= 2.3283064365386963E-10D THEN 3 WHEN abs(_value) >= 5.421010862427522E-20D THEN 2 WHEN abs(_value) >= 1.262177448353619E-29D THEN 1 WHEN abs(_value) >= 2.938735877055719E-39D THEN 0 ELSE -1 END AS _bin
            FROM (SELECT *, CASE WHEN event_type = 'cart' AND cart_action = 'checkout' THEN try_cast(total_value AS DOUBLE) ELSE 0D END AS _value FROM ${db}.raw_logs WHERE product_id IS NOT NULL)))
GROUP BY product_id, category;

SHOW TABLES IN ${db};
