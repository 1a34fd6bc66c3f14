"""Session construction and the shared work folder.

Everything that must survive an executor loss (stream checkpoints, staged
landing files, change logs, lineage cuts) is written below the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests) do we create a private folder and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "shopstream",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE, no UI)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # groups with text winners stay in a hash map up to this many a task (about 1 KB each)
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
        # parquet splits sized so one task's working set fits executor memory
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        # state kept off-heap in RocksDB; checkpoints upload only the change log
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # one memory budget per executor for all its RocksDB instances (many
        # state partitions per executor must not add up to an OOM)
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1024",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001
        pass
    ensure_utc(spark)
    if shuffle_partitions is None and "spark.sql.shuffle.partitions" not in conf:
        size_shuffles(spark)
    return spark


def size_shuffles(spark: SparkSession, per_slot: int = 4,
                  advisory_bytes: int = 128 * 1024 * 1024) -> None:
    """Shuffle sizing for large inputs: start wide, let AQE coalesce.

    AQE merges small shuffle partitions but does not split big ones (outside
    skewed joins), so a fixed 200 would leave multi-GB reducer partitions at
    scale.  Starting from ``per_slot`` partitions per task slot and
    coalescing towards ``advisory_bytes`` keeps reducers spill-free.
    """
    n = max(200, per_slot * default_parallelism(spark))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(advisory_bytes))


def ensure_utc(spark: SparkSession) -> None:
    """Event times without an offset are UTC (the event contract)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def app_id(spark: SparkSession) -> str:
    """Application id (cache key for per-application state)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        return spark.conf.get("spark.app.id", "remote")


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (``defaultParallelism``)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.default.parallelism", "8"))


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session; sets a private one only
    in local mode. A cluster that names none is an error: its executors would
    each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
            configured = None
    if not configured:
        master = spark.conf.get("spark.master", None) or "local"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        key = app_id(spark)
        if key not in _PRIVATE_DIRS:
            _PRIVATE_DIRS[key] = tempfile.mkdtemp(prefix="shopstream-ckpt-")
            try:
                spark.sparkContext.setCheckpointDir(_PRIVATE_DIRS[key])
            except Exception:  # noqa: BLE001
                pass
        configured = _PRIVATE_DIRS[key]
    return configured.rstrip("/")


_PRIVATE_DIRS: dict[str, str] = {}


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the work dir (never reused, never wiped)."""
    return f"{work_dir(spark)}/shopstream/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for os-level access (local tests and the bench probe)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def make_dirs(spark: SparkSession, path: str) -> bool:
    """Create a folder on the cluster file system (metadata only, no job).

    Returns False where the file system is not reachable from the driver
    (remote sessions); callers then fall back to a DataFrame write.
    """
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.mkdirs(p))
    except Exception:  # noqa: BLE001
        return False
