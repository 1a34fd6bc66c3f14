"""Every registered query vs its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from shopstream.plans import catalogue  # noqa: E402
from conftest import SF001

TABLES = ("events",)
_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())
    duck = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    spark_types = {f.name: _DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_id", "clicks", "cart_adds", "checkouts", "orders_value",
                          "delivered", "category", "last_event_time", "last_event_id"]


def test_every_query_has_oracle():
    assert set(catalogue.QUERIES) <= set(E.oracle_sql())


def test_repo_has_no_python_udfs():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for dirpath, folders, files in os.walk(os.path.join(root, "shopstream")):
        folders[:] = [d for d in folders if d != "llm"]  # the training-data operators choose their style freely
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f)).read()
                assert "@udf" not in text and "F.udf(" not in text and ".rdd.map" not in text, f


PLAN_FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                  "ArrowEvalPython", "BroadcastExchange")


@pytest.mark.parametrize("name", sorted(n for n in catalogue.QUERIES
                                        if not n.startswith("stream_")
                                        and n not in ("reconcile_stream", "insights_tables",
                                                      "validation_summary")))
def test_plans_have_no_cross_join_udf_or_broadcast(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in PLAN_FORBIDDEN if k in plan], plan[:2000]


def test_bench_prints_one_json_line(tmp_path):
    import json
    import subprocess
    import sys as _sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_DRIVER_MEM="2g")
    out = subprocess.run([_sys.executable, os.path.join(root, "bench.py")], env=env,
                         cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and "failed" not in d
    assert all(isinstance(v, float) for v in d["queries"].values())
