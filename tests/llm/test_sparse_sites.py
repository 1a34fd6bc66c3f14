"""Quality of documents on sites with little evidence."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopstream.llm import quality

SF = "/root/testdata/sf0.001"


def test_a_document_alone_on_its_path_or_host_takes_the_level_above(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    lone_host, lone_path = F.col("doc_id") % 10 == 0, F.col("doc_id") % 2 == 0
    name = F.col("doc_id").cast("string")
    rows = quality.posteriors(spark, docs, model, host=F.when(lone_host, name).otherwise("host"),
                              path=F.when(lone_path, name).otherwise("path")).collect()
    assert len(rows) == docs.count()
    alone = [r for r in rows if r.doc_id % 2 == 0]
    assert alone and all(r.path_mean == pytest.approx(r.host_mean) for r in alone)
    overall = {round(r.host_mean, 9) for r in rows if r.doc_id % 10 == 0}
    assert len(overall) == 1  # of a host's only document nothing but the mean of all is known
    assert any(abs(r.path_mean - r.host_mean) > 1e-6 for r in rows if r.doc_id % 2)
