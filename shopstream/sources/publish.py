"""Stable-file gate: publish finished files from a staging folder to the read folder.

A file that is still growing must not be read by a line source.  Files in
``staging`` or its sub-folders whose modification time is at least
``stable_seconds`` old are moved to ``ready`` by an atomic rename that never
overwrites an existing file; hidden and temp names are left alone.  The text
files that landing writes are published under a ``.json`` name, which is what
the line source reads.  This is file metadata work (list + rename through the
cluster file system), not data processing, so it runs on the driver through
the Hadoop ``FileSystem`` API and works on any Hadoop-compatible store.

What was published is kept in a ledger, a folder of small files beside the read
folder (``<ready>_ledger``), so a batch that landing replays stays out even
after the source has archived the first copy.  An entry is written before the
rename and closed after it; one that a crash left open names the file it meant
(length and modification time), which tells the unpublished file from a replay.
A replayed batch's file moves to ``<ready>_refused`` and is not listed again; any other
file of a published name stays in staging, for somebody to look at.

    python -m shopstream.sources.publish <staging> <ready>
"""

from __future__ import annotations

import argparse
import re
import threading
import time
import uuid

from pyspark.sql import SparkSession

from shopstream.sinks import pointer
from shopstream.sources.jsonl import STABLE_SECONDS, is_temp_name

PUBLISHED_SUFFIX = ".json"
LANDED_SUFFIX = ".txt"
RESCAN_SECONDS = 5
LEDGER, REFUSED = "_ledger", "_refused"  # beside the read folder: its name with these endings
# a task's file of a landed batch; the unique part of its name changes when the batch is replayed
_BATCH_FILE = re.compile(r"(.*batch_id=\d+/part-\d+)-[0-9a-f-]{36}(.*)")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def order_files(spark: SparkSession, folder: str) -> None:
    """Give the published files of ``folder`` rising modification times in name order.

    A file stream takes the oldest files first, so files that hold consecutive
    ranges are then read range by range, however their tasks finished.
    """
    fs, path, _ = _fs(spark, folder)
    found, listing = {}, fs.listStatusIterator(path)
    while listing.hasNext():
        st = listing.next()
        name = st.getPath().getName()
        if st.isFile() and name.endswith(PUBLISHED_SUFFIX) and not is_temp_name(name):
            found[name] = st
    first = max((st.getModificationTime() for st in found.values()), default=0) - len(found)
    for k, name in enumerate(sorted(found)):
        fs.setTimes(found[name].getPath(), first + k, -1)


def age_files(spark: SparkSession, folder: str, mtime_ms: int) -> None:
    """Set the modification time of all files directly in ``folder`` (to try the gate without waiting)."""
    fs, path, _ = _fs(spark, folder)
    for st in fs.listStatus(path):
        if st.isFile():
            fs.setTimes(st.getPath(), mtime_ms, -1)


def published_name(relative: str) -> str | None:
    """Name in the read folder of a file below staging; ``None`` for names that are not to be read.

    A batch that landing replays writes the same lines under the same task
    numbers, so its files get the names of the first run and are not published
    a second time.
    """
    *folders, name = relative.split("/")
    if is_temp_name(name) or any(f.startswith((".", "_")) for f in folders):
        return None
    if not name.endswith((PUBLISHED_SUFFIX, LANDED_SUFFIX)):
        return None
    batch = _BATCH_FILE.fullmatch(relative)
    plain = (batch[1] + batch[2] if batch else relative).replace("/", "__")
    return plain.removesuffix(LANDED_SUFFIX).removesuffix(PUBLISHED_SUFFIX) + PUBLISHED_SUFFIX


def publish_stable_files(spark: SparkSession, staging: str, ready: str,
                         stable_seconds: int = STABLE_SECONDS,
                         now_ms: int | None = None) -> list[str]:
    """Move stable files from ``staging`` (sub-folders included) to ``ready``; return their new names."""
    fs, src, jvm = _fs(spark, staging)
    dst_dir = jvm.org.apache.hadoop.fs.Path(ready)
    fs.mkdirs(dst_dir)
    if not fs.exists(src):
        return []
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    root = fs.makeQualified(src).toUri().getPath().rstrip("/") + "/"
    stable, listing = [], fs.listFiles(src, True)
    while listing.hasNext():
        st = listing.next()
        name = published_name(st.getPath().toUri().getPath().removeprefix(root))
        if name is not None and now_ms - st.getModificationTime() >= stable_seconds * 1000:
            stable.append((st.getModificationTime(), name, st.getPath()))
    moved, ledger, refused = [], ready.rstrip("/") + LEDGER, ready.rstrip("/") + REFUSED
    for folder in (ledger, refused):
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    for mtime, name, path in sorted(stable, key=lambda s: s[:2]):
        target, entry = jvm.org.apache.hadoop.fs.Path(dst_dir, name), f"{ledger}/{name}"
        file = f"{fs.getFileStatus(path).getLen()} {mtime}"
        opened = pointer.read_text(spark, f"{entry}.open")
        known = fs.exists(target) or pointer.exists(spark, f"{entry}.done") or opened not in (None, file)
        if known:
            if opened is not None:
                _close(spark, entry)
            if _BATCH_FILE.fullmatch(path.toUri().getPath()):
                fs.rename(path, jvm.org.apache.hadoop.fs.Path(refused, f"{uuid.uuid4().hex}-{name}"))
            continue
        if opened is None:
            pointer.write(spark, f"{entry}.open", file)
        if fs.rename(path, target):  # never overwrites
            moved.append(name)
            _close(spark, entry)
    return sorted(moved)


def _close(spark: SparkSession, entry: str) -> None:
    """Marks a ledger entry as published: one rename."""
    fs, path, jvm = _fs(spark, f"{entry}.open")
    if not fs.rename(path, jvm.org.apache.hadoop.fs.Path(f"{entry}.done")):
        fs.delete(path, False)  # it is closed already


def watch_staging(spark: SparkSession, staging: str, ready: str, stop: threading.Event,
                  stable_seconds: int = STABLE_SECONDS, rescan_seconds: float = RESCAN_SECONDS) -> int:
    """Rescan and publish until ``stop`` is set; return the number of published files."""
    published = 0
    while True:
        published += len(publish_stable_files(spark, staging, ready, stable_seconds))
        if stop.wait(rescan_seconds):
            return published


def main(argv=None) -> None:
    from shopstream.session import build_session

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("staging")
    ap.add_argument("ready")
    ap.add_argument("--stable-seconds", type=int, default=STABLE_SECONDS)
    ap.add_argument("--rescan-seconds", type=float, default=RESCAN_SECONDS)
    args = ap.parse_args(argv)
    watch_staging(build_session(app_name="shopstream-gate"), args.staging, args.ready, threading.Event(),
                  args.stable_seconds, args.rescan_seconds)


if __name__ == "__main__":
    main()
