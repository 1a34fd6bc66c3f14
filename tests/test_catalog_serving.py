"""Catalog (databases, insight tables, CTAS), serving view, smoke rows."""

from __future__ import annotations

from conftest import SF001, ev, lines_df
from shopstream.operators import alerts, batch, decode, metrics, serving
from shopstream.session import new_run_dir
from shopstream.sinks import catalog
from shopstream.sources import adapter, jsonl


def test_smoke_inline_rows(spark):
    df = spark.createDataFrame([("produto_1", 10.0), ("produto_2", 20.0), ("produto_3", 30.0)],
                               ["produto_id", "valor"])
    assert df.count() == 3
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "double"]


def test_database_tables_and_listing(spark):
    db = jsonl.unique_name("t_shop")
    catalog.ensure_database(spark, db, new_run_dir(spark, "db"))
    catalog.ensure_database(spark, db)                      # idempotent
    current = spark.catalog.currentDatabase()
    catalog.use_database(spark, db)
    assert spark.catalog.currentDatabase() == db
    catalog.use_database(spark, current)
    catalog.create_insight_tables(spark, db)
    catalog.create_insight_tables(spark, db)                # IF NOT EXISTS
    names = {r.tableName for r in catalog.list_tables(spark, db).collect()}
    assert names == {"insights_cliques", "insights_vendas"}
    ev_ = adapter.driver_events(spark, SF001)
    clean = batch.clean(ev_)
    catalog.write_insights(batch.clicks_by_product(clean), batch.sales(clean), db)
    catalog.write_insights(batch.clicks_by_product(clean), batch.sales(clean), db)  # overwrite
    assert spark.table(f"{db}.insights_cliques").count() == 8
    top = spark.sql(f"SELECT * FROM {db}.insights_cliques ORDER BY total_clicks DESC").first()
    assert top.total_clicks == batch.clicks_by_product(clean).agg({"total_clicks": "max"}).first()[0]


def test_ctas_if_not_exists_never_refreshes(spark, tmp_dir):
    db = catalog.ensure_database(spark, jsonl.unique_name("t_ctas"), new_run_dir(spark, "db"))
    raw_dir = f"{tmp_dir}/raw"
    first = [ev("e1", "click"), ev("e2", "cart", cart_action="checkout", total_value=7.5)]
    jsonl.write_events_json(decode.decode_events(lines_df(spark, first)), raw_dir)
    raw = jsonl.raw_logs_table(spark, raw_dir, f"{db}.raw_logs")
    assert raw.columns == list(jsonl.RAW_LOGS_COLUMNS)
    t1 = catalog.ctas_product_metrics(spark, db, f"{db}.raw_logs").first()
    assert (t1.total_clicks, t1.total_checkouts, t1.total_revenue) == (1, 1, 7.5)
    more = [ev("e3", "click"), ev("e4", "click")]
    jsonl.write_events_json(decode.decode_events(lines_df(spark, more)), raw_dir, mode="append")
    spark.sql(f"REFRESH TABLE {db}.raw_logs")
    again = catalog.ctas_product_metrics(spark, db, f"{db}.raw_logs").first()
    assert again.total_clicks == 1                          # second run: no-op
    refreshed = catalog.ctas_product_metrics(spark, db, f"{db}.raw_logs", refresh=True).first()
    assert refreshed.total_clicks == 3


def test_sql_and_dataframe_product_totals_agree(spark):
    ev_ = adapter.driver_events(spark, SF001)
    ev_.createOrReplaceTempView("t_events_sf001")
    via_sql = spark.sql(batch.PRODUCT_METRICS_BATCH_SQL.format(source="t_events_sf001"))
    via_df = batch.product_metrics_batch(ev_)
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_df.collect()))


def test_serving_rows_scan_get(spark):
    es = [ev(f"c{i}", "click", event_time=f"2024-01-01T00:03:{i:02d}.000Z") for i in range(10)]
    es.append(ev("k1", "cart", cart_action="checkout", total_value=1234567.005,
                 product_id="prod-002"))
    d = decode.decode_events(lines_df(spark, es))
    rows = serving.serving_rows(metrics.product_metrics(d), alerts.click_alerts(d))
    got = serving.get(rows, "prod-002").collect()
    cells = {(r.family, r.qualifier): r.value for r in got}
    assert cells[("metrics", "orders_value")] == "1234567.01"   # exact decimal, HALF_UP
    assert cells[("meta", "category")] == "casa" and len(cells) == 8
    scan = serving.scan(rows, 2).select("row_key").distinct().collect()
    assert sorted(r.row_key for r in scan) == sorted(
        r.row_key for r in rows.select("row_key").distinct().orderBy("row_key").limit(2).collect())
    alert_keys = {r.row_key for r in rows.filter("family = 'alert'").select("row_key").collect()}
    assert len(alert_keys) == 5 and all(k.startswith("alert|prod-001|") for k in alert_keys)


def test_serving_table_create_if_absent(spark):
    db = catalog.ensure_database(spark, jsonl.unique_name("t_srv"), new_run_dir(spark, "db"))
    t = catalog.create_serving_table(spark, db)
    assert catalog.create_serving_table(spark, db) == t        # exists -> success
    d = decode.decode_events(lines_df(spark, [ev("e1", "click")]))
    rows = serving.serving_rows(metrics.product_metrics(d), alerts.click_alerts(d))
    catalog.write_serving(rows, t)
    assert spark.table(t).count() == 8
    assert serving.scan(spark.table(t), 5).select("row_key").distinct().count() == 1


def test_branch_filters_push_down_on_typed_events(spark, tmp_dir):
    raw_dir = f"{tmp_dir}/raw"
    jsonl.write_events_json(adapter.driver_events(spark, SF001), raw_dir)
    typed = f"{tmp_dir}/typed"
    jsonl.read_events_json(spark, raw_dir).write.parquet(typed)
    for df in (batch.clicks(jsonl.read_events_json(spark, raw_dir)),
               batch.clicks(spark.read.parquet(typed))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(event_type,click)" in plan, plan
    cols = batch.clicks_by_product(batch.clean(spark.read.parquet(typed)))
    plan = cols._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:string,event_type:string,product_id:string>" in plan


def test_scan_start_key_and_unlimited(spark):
    es = [ev(f"c{i}", "click", product_id=p, event_time=f"2024-01-01T00:03:{i:02d}.000Z")
          for i, p in enumerate(["prod-001", "prod-002", "prod-003", "prod-004"])]
    d = decode.decode_events(lines_df(spark, es))
    rows = serving.serving_rows(metrics.product_metrics(d), alerts.click_alerts(d))
    keys = lambda df: sorted({r.row_key for r in df.select("row_key").collect()})
    assert keys(serving.scan(rows, 2, start_key="prod-002")) == ["prod-002", "prod-003"]
    assert keys(serving.scan(rows, None)) == ["prod-001", "prod-002", "prod-003", "prod-004"]
    assert serving.scan(rows, 1).count() == len(serving.METRIC_SPEC)
    assert batch.preview(rows, 3).count() == 3


def test_console_sink_starts_and_stops(spark, tmp_dir):
    import os
    from shopstream.streaming import queries as sq

    src = f"{tmp_dir}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write('{"event_id":"e1","event_type":"click","product_id":"p"}\n')
    q = sq.start_console(sq.product_metrics_stream(sq.decoded_stream(spark, src)), "update",
                         sq.Trigger(available_now=True), f"{tmp_dir}/ck", rows=5)
    q.awaitTermination()
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1


def test_sql_script_matches_library(spark, tmp_dir):
    import os
    raw_dir = f"{tmp_dir}/raw"
    ev_ = adapter.driver_events(spark, SF001)
    jsonl.write_events_json(ev_, raw_dir)
    db = jsonl.unique_name("t_sql")
    catalog.ensure_database(spark, db, new_run_dir(spark, "db"))
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "sql", "tables.sql")
    text = open(path).read().replace("${db}", db).replace("${raw_dir}", raw_dir)
    body = "\n".join(l for l in text.splitlines() if not l.strip().startswith("--"))
    for stmt in (s.strip() for s in body.split(";")):
        if stmt:
            spark.sql(stmt)
    got = spark.table(f"{db}.product_metrics_batch")
    expect = batch.product_metrics_batch(ev_)
    cols = expect.columns
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, expect.select(*cols).collect()))
    assert [f.dataType.simpleString() for f in got.select(*cols).schema.fields] == \
        [f.dataType.simpleString() for f in expect.schema.fields]
