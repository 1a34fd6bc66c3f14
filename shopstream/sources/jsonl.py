"""JSON-lines sources and exports.

* :func:`to_json_lines`   — events -> one compact JSON object per line, nulls kept
* :func:`damaged_lines`   — the quarantine fixture (truncated, null product, blank, array)
* :func:`landed_events`   — events written once as ``*.json`` files in the shared folder
* :func:`landed_damaged_lines` — the quarantine fixture written once as text files
* :func:`read_events_json`— batch scan of a JSON-lines glob with the fixed schema
* :func:`raw_logs_table`  — external 8-column JSON table over a raw folder
* :func:`stable_files`    — files old enough to be complete (batch; by modification time)
* :func:`is_temp_name`    — names that are not yet published (``.tmp`` / ``.part`` / …)
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.schema import EVENT, EVENT_COLUMNS, RAW_LOGS_COLUMNS, RAW_LOGS_DDL
from shopstream.session import app_id, default_parallelism, new_run_dir

# ---------------------------------------------------------------------------
# File names that are still being written and must not be read.
TEMP_SUFFIXES = (".tmp", ".part", ".partial", ".inprogress")
PUBLISHED_GLOB = "*.json"
LINES_GLOB = "*.{json,txt}"  # published files, and those that landing archives
STABLE_SECONDS = 15
# damage rules of the quarantine fixture, by event_seq % 50
DAMAGE_MOD = 50
TRUNCATE_CHARS = 40
# ---------------------------------------------------------------------------

_JSON_WRITE = {"ignoreNullFields": "false"}


def json_line(cols: list[Column] | None = None) -> Column:
    cols = cols or [F.col(c) for c in EVENT_COLUMNS]
    return F.to_json(F.struct(*cols), _JSON_WRITE)


def to_json_lines(events: DataFrame) -> DataFrame:
    """One compact JSON object per event (column ``value``), nulls written."""
    return events.select(json_line().alias("value"))


def damaged_lines(events: DataFrame, drop_product_key: bool = False) -> DataFrame:
    """JSON lines with every 50th-row class damaged (needs ``event_seq``).

    seq % 50 == 0: first 40 characters only; 1: product_id -> JSON null (or the
    key removed when ``drop_product_key``); 2: three blanks; 3: wrapped in [ ].
    """
    m = F.col("event_seq") % DAMAGE_MOD
    full = json_line()
    no_product_cols = [F.lit(None).cast("string").alias(c) if c == "product_id" else F.col(c)
                       for c in EVENT_COLUMNS]
    if drop_product_key:
        no_product_cols = [F.col(c) for c in EVENT_COLUMNS if c != "product_id"]
    line = (F.when(m == 0, F.substring(full, 1, TRUNCATE_CHARS))
             .when(m == 1, json_line(no_product_cols))
             .when(m == 2, F.lit("   "))
             .when(m == 3, F.concat(F.lit("["), full, F.lit("]")))
             .otherwise(full))
    return events.select(line.alias("value"))


_LANDED: dict[tuple[str, str, str], str] = {}
LANDED_BATCHES = 5  # micro-batches that even a small table is landed for


def write_events_json(events: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """JSON-lines export of the 16 contract fields (``*.json`` part files)."""
    (events.select(*EVENT_COLUMNS).write.mode(mode).options(**_JSON_WRITE)
     .option("compression", "none").json(path))
    return path


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    """The driver events, landed once per session as JSON lines in the work folder.

    Files hold consecutive arrival ranges (ingested time, event id) and rising
    modification times, so a stream that takes a few files per trigger sees
    the events as they arrived and its watermark drops none of them.
    """
    from shopstream.sources.adapter import driver_events, num_splits, table_version
    from shopstream.sources.publish import order_files

    key = table_version(spark, sf_dir, "events")
    if key in _LANDED:
        return _LANDED[key]
    path = new_run_dir(spark, "landing")
    ev = driver_events(spark, sf_dir)
    files = max(num_splits(ev) or 0, LANDED_BATCHES * files_per_trigger(spark))
    arrival = ("ingested_ms", "event_id")
    write_events_json(ev.repartitionByRange(files, *arrival).sortWithinPartitions(*arrival), path)
    order_files(spark, path)
    _LANDED[key] = path
    return path


def files_per_trigger(spark: SparkSession) -> int:
    """Files in a micro-batch of the registered streams: bounded by the cluster, not by the input."""
    return max(2, default_parallelism(spark) // 4)


_LANDED_DAMAGED: dict[tuple[str, str, str], str] = {}


def landed_damaged_lines(spark: SparkSession, sf_dir: str) -> str:
    """The quarantine fixture landed once per session as text files (``part-*.txt``)."""
    from shopstream.sources.adapter import driver_events, table_version

    key = table_version(spark, sf_dir, "events")
    if key not in _LANDED_DAMAGED:
        path = new_run_dir(spark, "landing-damaged")
        damaged_lines(driver_events(spark, sf_dir, spread_scan=True)).write.mode(
            "errorifexists").text(path)
        _LANDED_DAMAGED[key] = path
    return _LANDED_DAMAGED[key]


def read_events_json(spark: SparkSession, path: str, glob: str | None = LINES_GLOB) -> DataFrame:
    """Batch scan of JSON-lines files with the fixed 16-field schema (no inference).

    Reads exported files and the raw archive that landing writes (its folders'
    date and batch are not event fields).
    """
    r = spark.read.schema(EVENT)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path).select(*EVENT_COLUMNS)


def create_raw_logs_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS <table> (8 columns) USING json LOCATION``.

    A table of that name over another folder is an error: its rows would be
    returned for this folder's.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({RAW_LOGS_DDL}) USING json "
              f"LOCATION '{location}'")
    held = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]
    if _plain_path(held) != _plain_path(location):
        raise ValueError(f"table {table} is over {held}, not {location}")
    return spark.table(table)


def _plain_path(path: str) -> str:
    """A location without the local scheme, doubled or trailing slashes."""
    return re.sub(r"/+", "/", re.sub(r"^file:", "", path)).rstrip("/")


def raw_logs_table(spark: SparkSession, location: str, table: str | None = None) -> DataFrame:
    """The raw external table; a scratch database is used when no name is given."""
    from shopstream.sinks.catalog import scratch_database

    if table is None:
        table = f"{scratch_database(spark)}.{unique_name('raw_logs')}"
    return create_raw_logs_table(spark, table, location).select(*RAW_LOGS_COLUMNS)


def is_temp_name(name: str | Column) -> bool | Column:
    """Unpublished file names: empty, hidden (leading '.'), or a temp suffix (case-sensitive)."""
    if isinstance(name, str):
        return (not name) or name.startswith(".") or name.endswith(TEMP_SUFFIXES)
    cond = (name == "") | name.startswith(".")
    for suf in TEMP_SUFFIXES:
        cond = cond | name.endswith(suf)
    return cond


def stable_files(spark: SparkSession, path: str, stable_seconds: int = STABLE_SECONDS,
                 now: dt.datetime | None = None) -> DataFrame:
    """Lines of published files not modified for ``stable_seconds`` (batch gate).

    A streaming file source cannot take ``modifiedBefore``, so the gate is a
    batch step; ``_metadata`` exposes name and modification time per row.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    cutoff = (now - dt.timedelta(seconds=stable_seconds)).strftime("%Y-%m-%dT%H:%M:%S")
    df = (spark.read.option("pathGlobFilter", PUBLISHED_GLOB)
          # the cutoff is UTC text; without the zone it would be read in the session's
          .option("modifiedBefore", cutoff).option("timeZone", "UTC").text(path))
    return df.select("value", F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_modification_time").alias("file_mtime")
                     ).filter(~is_temp_name(F.col("file_name")))


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


_SAFE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def safe_identifier(name: str) -> str:
    if not _SAFE.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name
