"""Registered catalog queries: insight tables, CTAS totals, validation summary.

They write managed tables into a private database located in the shared work
folder, then read the tables back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopstream.functions import digest
from shopstream.operators import alerts, batch, metrics
from shopstream.plans.catalogue import DAY_SIZE, DAY_SLIDE, events, register
from shopstream.sinks import catalog
from shopstream.sources import jsonl


def _insights(spark, sf_dir) -> tuple[str, dict[str, str]]:
    partials = batch.insight_partials(events(spark, sf_dir)).persist()
    db = catalog.new_database(spark)  # of this call: an earlier result keeps its tables
    catalog.create_insight_tables(spark, db)
    catalog.write_insights(batch.clicks_by_product_from(partials), batch.sales_from(partials), db)
    partials.unpersist()
    jsonl.create_raw_logs_table(spark, f"{db}.raw_logs", jsonl.landed_events(spark, sf_dir))
    catalog.ctas_product_metrics(spark, db, f"{db}.raw_logs", refresh=True)
    return db, {"insights_cliques": f"{db}.insights_cliques",
                "insights_vendas": f"{db}.insights_vendas",
                "product_metrics_batch": f"{db}.product_metrics_batch"}


@register("insights_tables")
def q_insights_tables(spark, sf_dir):
    _, tables = _insights(spark, sf_dir)
    return digest.summary({name: spark.table(table) for name, table in tables.items()}, "table_name")


@register("insights_cliques")
def q_insights_cliques(spark, sf_dir):
    """Rows of the saved click table, read back."""
    return spark.table(_insights(spark, sf_dir)[1]["insights_cliques"])


@register("insights_vendas")
def q_insights_vendas(spark, sf_dir):
    """Rows of the saved sales table, read back."""
    return spark.table(_insights(spark, sf_dir)[1]["insights_vendas"])


@register("product_totals_table")
def q_product_totals_table(spark, sf_dir):
    """Rows of the CTAS product totals, read back."""
    return spark.table(_insights(spark, sf_dir)[1]["product_metrics_batch"])


@register("click_preview")
def q_click_preview(spark, sf_dir):
    """The first rows of the saved click table, most clicked first."""
    saved = spark.table(_insights(spark, sf_dir)[1]["insights_cliques"])
    return batch.preview(saved.orderBy(F.col("total_clicks").desc(), "product_id"), 5)


@register("listed_tables")
def q_listed_tables(spark, sf_dir):
    """Tables of the database that the batch job fills."""
    db, _ = _insights(spark, sf_dir)
    catalog.create_serving_table(spark, db)
    return catalog.list_tables(spark, db).where("not isTemporary").select(F.col("tableName").alias("table_name"), F.col("isTemporary").alias("temporary"))


@register("top_clicked_saved")
def q_top_clicked_saved(spark, sf_dir):
    """Most clicked products of the saved click table."""
    return batch.top_clicked(spark.table(_insights(spark, sf_dir)[1]["insights_cliques"]), 20)


@register("validation_summary")
def q_validation_summary(spark, sf_dir):
    """Rows and content digest per relation: raw log, product metrics, alerts, insight tables."""
    ev = alerts.with_event_ts(events(spark, sf_dir))
    _, tables = _insights(spark, sf_dir)
    rel = {
        "raw_events": jsonl.read_events_json(spark, jsonl.landed_events(spark, sf_dir)),
        "product_metrics": metrics.product_metrics(ev),
        "click_alerts": alerts.click_alerts(ev, DAY_SIZE, DAY_SLIDE, 10),
        "insights_cliques": spark.table(tables["insights_cliques"]),
        "insights_vendas": spark.table(tables["insights_vendas"]),
    }
    return digest.summary(rel, "relation")
