"""What the Python workers of a pipeline hold: bounded caches, small batches, nothing of the stage before."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from shopstream.llm import common, decontaminate, exact_dedup, simhash, toxicity

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_arrow_rows_bound_the_batches_inside_the_block_only(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    before = spark.conf.get(ROWS)
    with common.arrow_rows(spark, 7):
        inside = spark.range(100, numPartitions=2).mapInArrow(sizes, "n long").collect()
    outside = spark.range(100, numPartitions=1).mapInArrow(sizes, "n long").collect()
    assert max(r.n for r in inside) == 7 and sum(r.n for r in inside) == 100
    assert [r.n for r in outside] == [100] and spark.conf.get(ROWS) == before


def test_exact_and_near_dedup_release_the_caches_before_them(spark, monkeypatch):
    for start in (exact_dedup._sort_key.func, lambda t: _prints(monkeypatch, t)):
        toxicity._take(100)
        toxicity.term_buckets(b"some words")
        assert len(toxicity._TERMS) == 2
        start(pd.Series([b"a text"]))
        assert not toxicity._TERMS and "toxicity" not in common._HELD


def _prints(monkeypatch, texts):
    with monkeypatch.context() as m:
        m.setattr(simhash.F, "pandas_udf", lambda kind: lambda f: lambda column: f(texts))
        return simhash.fingerprints(F.lit(b""), 3, 42)


def test_a_task_bounds_and_registers_the_cache_that_its_functions_use(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(30)))], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"x{k} y{k} z{k}") for k in range(40)], "doc_id long, text string").coalesce(1)
    marks = spark.sparkContext.broadcast([bytes(1 << 7), bytes(1 << 7)])
    run = decontaminate._cluster_rows(marks, 10, decontaminate.MASKS, decontaminate.HEAVY_MASKS, 50)

    def held(batches):
        from shopstream.llm import common, decontaminate

        for _ in run(batches):
            pass
        owner = common._HELD["decontamination"]
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(decontaminate._HASHES)], pa.int64()),
                                          "own": pa.array([owner.__self__ is decontaminate._HASHES])})

    found = docs.mapInArrow(held, "n long, own boolean").collect()
    assert [(0 < r.n <= 50, r.own) for r in found] == [(True, True)]
    assert decontaminate.contaminated(spark, docs, items, cache=50).count() == 0


def test_small_caches_and_batches_change_no_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.train(spark, docs, labels)
    rows = []
    for cache, batch in ((500_000, 10_000), (20, 3)):
        with common.arrow_rows(spark, batch):
            own = toxicity.train(spark, docs, labels, cache=cache)
            assert own.bias == model.bias and (own.weights == model.weights).all()
            clean = toxicity.keep_clean(spark, docs, own, cache=cache)
            kept = simhash.dedup(spark, exact_dedup.dedup(spark, clean))
            rows.append(sorted(map(tuple, kept.select("doc_id", "text").collect())))
    assert rows[0] == rows[1] and rows[0]


def test_every_stage_of_the_pipeline_bounds_its_batches(spark, monkeypatch):
    seen = []
    for module, name in ((toxicity, "train"), (exact_dedup, "dedup"), (simhash, "dedup"), (decontaminate, "remove"),
                         (corpus_pipeline.packing, "pack")):
        real = getattr(module, name)

        def spy(spark, *args, real=real, **options):
            seen.append(int(spark.conf.get(ROWS)))
            return real(spark, *args, **options)

        monkeypatch.setattr(module, name, spy)
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert seen == [corpus_pipeline.ROWS] * 5
