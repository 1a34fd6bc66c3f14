"""Compaction inside the job, the stored serving table, the publish ledger, rejects and late rows."""

from __future__ import annotations

import os

import pytest

from conftest import ev, write_lines
from shopstream.sinks import changelog, pointer, serving_store
from shopstream.streaming import job as sjob
from shopstream.streaming import queries as sq
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def current(spark, path):
    return sorted(map(tuple, changelog.current_view(changelog.read_log(spark, path, SCHEMA), ["k"]).collect()))


def partitions(spark, path):
    return [n for n in pointer.children(spark, path) if n.startswith("batch_id=")]


def test_fifty_batches_keep_a_bounded_log(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    changelog.init_log(spark, path, SCHEMA)
    write, want = changelog.batch_writer(path, ["k"], SCHEMA, compact_every=5), {}
    for k in range(50):
        rows = [(f"k{k % 7}", k), (f"only{k}", k)]
        want.update(rows)
        write(batch(spark, rows), k)
        assert len(partitions(spark, path)) <= 10 and len(pointer.children(spark, f"{path}/_bases")) <= 2
    assert current(spark, path) == sorted(want.items())
    write(batch(spark, [("k0", 49), ("only49", 49)]), 49)  # replayed: lies within the base
    assert current(spark, path) == sorted(want.items())


def test_append_only_log_merges_its_bases(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    changelog.init_log(spark, path, SCHEMA)
    write = changelog.batch_writer(path, None, SCHEMA, compact_every=2, append_only=True)
    for k in range(13):
        write(batch(spark, [(f"k{k}", k)]), k)
    rows = changelog.appended_rows(changelog.read_log(spark, path, SCHEMA))
    assert sorted(map(tuple, rows.collect())) == sorted((f"k{k}", k) for k in range(13))
    assert len(pointer.read(spark, path)["bases"]) <= 2


def test_readers_during_a_compaction_and_a_crash_before_the_switch(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    changelog.init_log(spark, path, SCHEMA)
    write = changelog.batch_writer(path)
    for k in range(4):
        write(batch(spark, [("a", k), (f"b{k}", k)]), k)
    want = current(spark, path)
    before = changelog.current_view(changelog.read_log(spark, path, SCHEMA), ["k"])
    seen = []

    def crash():
        seen.append(current(spark, path))
        raise RuntimeError("lost before the switch")

    with pytest.raises(RuntimeError):
        changelog.compact_log(spark, path, SCHEMA, ["k"], 3, before_switch=crash)
    assert seen == [want] and current(spark, path) == want and pointer.read(spark, path) is None
    changelog.compact_log(spark, path, SCHEMA, ["k"], 3)  # the restart writes a base of its own
    assert current(spark, path) == want
    assert sorted(map(tuple, before.collect())) == want  # a reader of the older version still finds its files
    assert len(pointer.children(spark, f"{path}/_bases")) == 1
    write(batch(spark, [("a", 9)]), 4)
    assert dict(current(spark, path))["a"] == 9


def test_stored_cells_are_read_by_key(spark, tmp_dir):
    path = f"{tmp_dir}/cells"
    rows = [(f"row-{k:04d}", "metrics", q, f"{k}{q}") for k in range(400) for q in ("a", "b")]
    cells = spark.createDataFrame(rows, serving_store.SCHEMA).repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small files, so that there is something to prune
    try:
        serving_store.store(cells, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    serving_store.batch_writer(path)(spark.createDataFrame([("row-0007", "metrics", "a", "new")], serving_store.SCHEMA), 1)
    found = serving_store.get(spark, path, "row-0007")
    assert sorted(map(tuple, found.collect())) == [("row-0007", "metrics", "a", "new"), ("row-0007", "metrics", "b", "7b")]
    files = [f for f in pointer.children(spark, f"{path}/{pointer.read(spark, path)['bases'][0]}") if f.endswith("parquet")]
    assert len(files) > 2 and len(found.inputFiles()) <= 2
    plan = found._jdf.queryExecution().toString()
    assert "EqualTo(row_key,row-0007)" in plan and "event_type" not in plan
    scanned = serving_store.scan(spark, path, 3, "row-0100")
    assert sorted({r.row_key for r in scanned.collect()}) == ["row-0100", "row-0101", "row-0102"]
    assert len(scanned.inputFiles()) < len(files)
    assert serving_store.get(spark, path, "nothing").collect() == []


def test_the_job_stores_its_serving_cells(spark, tmp_dir):
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(source)
    for n in range(6):
        rows = [ev(f"c{n}-{k}", "click", product_id=f"prod-{k % 3:03d}", event_time=f"2024-01-01T0{n}:00:{k:02d}.000Z")
                for k in range(36)]
        write_lines(f"{source}/f{n}.json", rows, mtime=1_700_000_000 + n)
    j = sjob.start_job(spark, source, out, sq.Trigger(available_now=True), compact_every=2, state_partitions=2,
                       max_files_per_trigger=1)
    j.await_all()
    cells = {(r.family, r.qualifier): r.value for r in sjob.serving_get(spark, out, "prod-001").collect()}
    assert cells[("metrics", "clicks")] == "72" and len(cells) == 8
    keys = [r.row_key for r in sjob.serving_scan(spark, out, 1000).select("row_key").distinct().collect()]
    alerts = [r.row_key for r in sjob.current_alerts(spark, out, source).collect()]
    assert alerts and sorted(keys) == sorted([*alerts, "prod-000", "prod-001", "prod-002"])
    some = sjob.serving_get(spark, out, alerts[0]).collect()
    assert {r.qualifier for r in some} >= {"product_id", "click_count", "window_start"}
    assert len(partitions(spark, f"{out}/product_metrics")) <= 4


def test_a_replayed_batch_stays_out_after_its_file_was_archived(spark, tmp_dir):
    from shopstream.sources.publish import publish_stable_files

    staging, ready, archive = f"{tmp_dir}/staging", f"{tmp_dir}/ready", f"{tmp_dir}/archive"
    folder = f"{staging}/batch_id=0"
    os.makedirs(folder)
    os.makedirs(archive)

    def land(unique, mtime):
        write_lines(f"{folder}/part-00000-{unique}.txt", [ev("a", "click")], mtime=mtime)

    first, again = "1" * 8 + "-1111-1111-1111-" + "1" * 12, "2" * 8 + "-2222-2222-2222-" + "2" * 12
    land(first, 1_700_000_000)
    published = publish_stable_files(spark, staging, ready)
    assert len(published) == 1
    os.rename(f"{ready}/{published[0]}", f"{archive}/{published[0]}")  # the source has read and archived it
    land(again, 1_700_000_100)
    assert publish_stable_files(spark, staging, ready) == []
    assert not any(f.endswith(".txt") for f in os.listdir(folder))  # it is not listed at every rescan
    assert [f for f in os.listdir(ready) if not f.startswith((".", "_"))] == []


@pytest.mark.parametrize("renamed", [False, True])
def test_the_ledger_after_a_crash_around_the_rename(spark, tmp_dir, renamed):
    from shopstream.sources.publish import LEDGER, publish_stable_files

    staging, ready = f"{tmp_dir}/staging", f"{tmp_dir}/ready"
    os.makedirs(staging)
    os.makedirs(ready + LEDGER)
    write_lines(f"{staging}/f.json", [ev("a", "click")], mtime=1_700_000_000)
    size = os.path.getsize(f"{staging}/f.json")
    pointer.write(spark, f"{ready}{LEDGER}/f.json.open", f"{size} 1700000000000")
    if renamed:  # published, read and archived before the entry was closed; then landed again
        os.remove(f"{staging}/f.json")
        write_lines(f"{staging}/f.json", [ev("a", "click")], mtime=1_700_000_500)
    assert publish_stable_files(spark, staging, ready) == ([] if renamed else ["f.json"])


def test_rejects_and_late_rows_of_the_default_job(spark, tmp_dir):
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(source)
    write_lines(f"{source}/a.json", [ev("a", "click", event_time="2024-01-01T01:00:00.000Z"), "broken", "[1]"],
                mtime=1_700_000_000)
    write_lines(f"{source}/b.json", [ev("late", "click", event_time="2024-01-01T00:57:30.000Z"),
                                     ev("close", "click", event_time="2024-01-01T00:59:50.000Z"), ""], mtime=1_700_000_001)
    j = sjob.start_job(spark, source, out, sq.Trigger(available_now=True), state_partitions=2, late_rows=True,
                       max_files_per_trigger=1)
    j.await_all()
    assert sorted(r.reason for r in sjob.current_rejects(spark, out).collect()) == ["blank", "malformed", "not_object"]
    seen = [p["observedMetrics"]["decode"] for p in j.rejects.recentProgress if p["numInputRows"]]
    assert [(m["lines"], m["rejects"]) for m in seen] == [(3, 2), (3, 1)]
    late = [tuple(r) for r in sq.late_rows(spark, f"{out}/late").select("event_id", "closed_windows", "batch_id").collect()]
    # watermark 00:59:45: of the windows of 00:57:30 those that end at 00:58 and 00:59 are closed
    assert late == [("late", 2, 1)]


def test_drop_counts_outlive_the_progress_list(spark, tmp_dir):
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(source)
    n = 14
    for k in range(n):
        late = [] if k < 2 else [ev(f"l{k}-{i}", "click", event_time="2024-01-01T00:00:00.000Z") for i in range(2)]
        write_lines(f"{source}/f{k:03d}.json", [ev(f"c{k}", "click", event_time=f"2024-01-02T{k:02d}:00:00.000Z"), *late],
                    mtime=1_700_000_000 + k)
    counter = sq.DropCounter(spark, f"{out}/drops")
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    spark.streams.addListener(counter)
    try:
        q = sq.start_click_windows(spark, source, f"{out}/sink", f"{out}/ck", sq.Trigger(available_now=True),
                                   max_files_per_trigger=1)
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counter)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    total = sum(r.dropped for r in counter.counts().collect())
    # late clicks of one batch and product meet in one partial window row before they are dropped
    assert total >= n - 2 and total > sq.rows_dropped_by_watermark(q)


def test_landing_writes_one_file_a_date(spark, tmp_dir):
    import glob

    rows = [(f'{{"event_time":"2024-01-{d + 1:02d}T00:00:00Z","n":{k}}}',) for k in range(40) for d in range(30)]
    lines = spark.createDataFrame(rows, "value string").repartition(8)
    sq.landing_writer(f"{tmp_dir}/raw", f"{tmp_dir}/staging")(lines, 0)
    files = glob.glob(f"{tmp_dir}/raw/event_date=*/batch_id=0/part-*")
    assert len(files) == 30 and len(glob.glob(f"{tmp_dir}/staging/batch_id=0/part-*")) <= 8
    assert spark.read.text(f"{tmp_dir}/raw").count() == spark.read.text(f"{tmp_dir}/staging").count() == 1200
