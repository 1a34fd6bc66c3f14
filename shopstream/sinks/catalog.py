"""Catalog operations: databases, insight tables, CTAS product totals, listing.

Managed tables live in databases whose LOCATION is below the shared work
folder (or the warehouse the cluster configures), never in the current
working directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstream.operators.batch import PRODUCT_METRICS_BATCH_SQL
from shopstream.schema import INSIGHTS_CLIQUES_DDL, INSIGHTS_VENDAS_DDL
from shopstream.session import app_id, new_run_dir
from shopstream.sources.jsonl import safe_identifier, unique_name

_SCRATCH: dict[str, str] = {}


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (idempotent)."""
    name = safe_identifier(name)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    return name


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {safe_identifier(name)}")


def scratch_database(spark: SparkSession) -> str:
    """One private database per application, located in the work folder."""
    app = app_id(spark)
    if app not in _SCRATCH:
        _SCRATCH[app] = new_database(spark)
    return _SCRATCH[app]


def new_database(spark: SparkSession) -> str:
    """A private database of its own name and folder in the work folder."""
    name = unique_name("shopstream")
    return ensure_database(spark, name, new_run_dir(spark, "db-" + name))


def create_insight_tables(spark: SparkSession, db: str) -> None:
    """Parquet tables with the fixed insight schemas, if absent."""
    db = safe_identifier(db)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.insights_cliques ({INSIGHTS_CLIQUES_DDL}) "
              f"USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.insights_vendas ({INSIGHTS_VENDAS_DDL}) "
              f"USING parquet")


def write_insights(clicks_by_product: DataFrame, sales: DataFrame, db: str) -> None:
    """Overwrite both insight tables (one job each)."""
    db = safe_identifier(db)
    (clicks_by_product.select("product_id", "total_clicks")
     .write.mode("overwrite").format("parquet").saveAsTable(f"{db}.insights_cliques"))
    (sales.select("product_id", "category", "events", "revenue", "average_price")
     .write.mode("overwrite").format("parquet").saveAsTable(f"{db}.insights_vendas"))


def ctas_product_metrics(spark: SparkSession, db: str, source: str,
                         refresh: bool = False) -> DataFrame:
    """Product totals table from ``source`` (a table or view name).

    ``CREATE TABLE IF NOT EXISTS … AS SELECT``: a second run is a no-op and
    never refreshes.  ``refresh=True`` overwrites the rows instead.
    """
    db = safe_identifier(db)
    target = f"{db}.product_metrics_batch"
    select = PRODUCT_METRICS_BATCH_SQL.format(source=source)
    exists = spark.catalog.tableExists(target)
    if not exists:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {target} USING parquet AS {select}")
    elif refresh:
        spark.sql(f"INSERT OVERWRITE TABLE {target} {select}")
    return spark.table(target)


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {safe_identifier(db)}")


def table_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table_name, n) read back from the catalog, one aggregate per table."""
    from pyspark.sql import functions as F

    parts = [spark.table(full).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(label).alias("table_name"), "n")
             for label, full in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SERVING_DDL = "row_key STRING, family STRING, qualifier STRING, value STRING"


def create_serving_table(spark: SparkSession, db: str, name: str = "ecommerce_metrics") -> str:
    """Create-if-absent serving table (an existing table is success, not an error)."""
    full = f"{safe_identifier(db)}.{safe_identifier(name)}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({SERVING_DDL}) USING parquet")
    return full


def write_serving(rows: DataFrame, table: str) -> None:
    """Replace the serving cells (one job; readers see the old or the new version)."""
    rows.select("row_key", "family", "qualifier", "value").write.mode("overwrite") \
        .format("parquet").saveAsTable(table)
