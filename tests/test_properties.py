"""Property tests over generated events (hypothesis), plus stream = batch on driver data."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001, ev, lines_df
from shopstream.functions.columns import ever
from shopstream.operators import alerts, batch, decode, metrics
from shopstream.plans.catalogue import QUERIES
from shopstream.sources import adapter, jsonl
from shopstream.streaming import queries as sq

TYPES = ("click", "cart", "delivery_status", "error")
ACTIONS = (None, "add", "remove", "checkout")
STATUSES = (None, "created", "shipped", "delivered")


@st.composite
def event_lists(draw):
    n = draw(st.integers(min_value=1, max_value=40))
    out = []
    for i in range(n):
        et = draw(st.sampled_from(TYPES))
        sec = draw(st.integers(min_value=0, max_value=3 * 3600))
        lag = draw(st.integers(min_value=0, max_value=10))
        t = 1704067200 + sec
        iso = lambda s: f"2024-01-01T{(s - 1704067200) // 3600:02d}:" \
                        f"{(s - 1704067200) % 3600 // 60:02d}:{(s - 1704067200) % 60:02d}.000Z"
        out.append(ev(
            f"e{i:03d}", et, product_id=draw(st.sampled_from(["p1", "p2", "p3"])),
            event_time=iso(t), ingested_at=iso(t + lag),
            category=draw(st.sampled_from(["", "casa", "moda"])),
            cart_action=draw(st.sampled_from(ACTIONS)) if et == "cart" else None,
            delivery_status=draw(st.sampled_from(STATUSES)) if et == "delivery_status" else None,
            total_value=draw(st.sampled_from([0.0, 1.5, 10.25, None]))))
    return out


SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


@SETTINGS
@given(events=event_lists())
def test_counters_sum_to_filtered_counts(spark, events):
    m = metrics.product_metrics(decode.decode_events(lines_df(spark, events))).collect()
    assert sum(r.clicks for r in m) == sum(e["event_type"] == "click" for e in events)
    assert sum(r.cart_adds for r in m) == sum(
        e["event_type"] == "cart" and e["cart_action"] == "add" for e in events)
    assert sum(r.checkouts for r in m) == sum(
        e["event_type"] == "cart" and e["cart_action"] == "checkout" for e in events)
    assert sum(r.delivered for r in m) == sum(
        e["event_type"] == "delivery_status" and e["delivery_status"] == "delivered"
        for e in events)
    value = sum(round(e["total_value"] or 0, 2) for e in events
                if e["event_type"] == "cart" and e["cart_action"] == "checkout")
    assert abs(sum(r.orders_value for r in m) - value) < 1e-9


@SETTINGS
@given(events=event_lists(), seed=st.integers(min_value=0, max_value=10_000))
def test_results_independent_of_row_order(spark, events, seed):
    shuffled = events[:]
    random.Random(seed).shuffle(shuffled)
    a = decode.decode_events(lines_df(spark, events))
    b = decode.decode_events(lines_df(spark, shuffled))
    for f in (metrics.product_metrics, lambda d: batch.sales(batch.clean(d)),
              lambda d: alerts.click_alerts(d, "1 hour", "20 minutes", 1)):
        assert sorted(map(tuple, f(a).collect())) == sorted(map(tuple, f(b).collect()))


@SETTINGS
@given(events=event_lists())
def test_each_click_in_size_over_slide_windows(spark, events):
    d = decode.decode_events(lines_df(spark, events))
    w = alerts.click_windows(d, "1 hour", "15 minutes").collect()
    clicks = sum(e["event_type"] == "click" for e in events)
    assert sum(r.click_count for r in w) == 4 * clicks
    assert all(r.window_end - r.window_start == 3_600_000 for r in w)
    assert all(r.window_start % 900_000 == 0 for r in w)


def test_stream_equals_batch_on_driver_data_many_batches(spark, tmp_dir):
    ev_ = adapter.driver_events(spark, SF001)
    src = f"{tmp_dir}/landed"
    jsonl.write_events_json(ev_.repartition(6), src)
    run = f"{tmp_dir}/run"
    q = sq.start_product_metrics(spark, src, f"{run}/sink", f"{run}/ck",
                                 sq.Trigger(available_now=True), max_files_per_trigger=2)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 3
    schema = sq.product_metrics_stream(sq.decoded_stream(spark, src)).schema
    got = sq.current(spark, f"{run}/sink", schema, ["product_id"])
    cols = list(metrics.OUTPUT_COLUMNS)
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, metrics.product_metrics(ev_).select(*cols).collect()))


def test_windows_stream_equals_batch_over_arrival_ordered_files(spark, tmp_dir):
    """One file per trigger, in arrival order: nothing is late, closed windows match."""
    import json
    import os

    ev_ = adapter.driver_events(spark, SF001)
    rows = sorted((r.asDict() for r in ev_.collect()),              # 1,000-row fixture
                  key=lambda r: (r["ingested_ms"], r["event_id"]))
    src = f"{tmp_dir}/ordered"
    os.makedirs(src)
    n_files = 7
    per = -(-len(rows) // n_files)
    for i in range(n_files):
        chunk = rows[i * per:(i + 1) * per]
        with open(f"{src}/part-{i:03d}.json", "w") as fh:
            for r in chunk:
                fh.write(json.dumps({k: r[k] for k in ev_.columns[:16]}) + "\n")
        os.utime(f"{src}/part-{i:03d}.json", (1_600_000_000 + i, 1_600_000_000 + i))
    run = f"{tmp_dir}/run"
    q = sq.start_click_windows(spark, src, f"{run}/sink", f"{run}/ck",
                               sq.Trigger(available_now=True), size="1 hour", slide="20 minutes",
                               max_files_per_trigger=1)
    q.awaitTermination()
    assert sq.rows_dropped_by_watermark(q) == 0
    schema = sq.click_windows_stream(sq.decoded_stream(spark, src), "1 hour", "20 minutes").schema
    got = sq.current(spark, f"{run}/sink", schema, ["product_id", "window_start", "window_end"],
                     append_only=True)
    max_ms = max(r["event_ms"] for r in rows)
    expect = alerts.click_windows(alerts.with_event_ts(ev_), "1 hour", "20 minutes").filter(
        f"window_end <= {max_ms - 15000}")
    cols = list(alerts.WINDOW_COLUMNS)
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, expect.select(*cols).collect()))


@SETTINGS
@given(events=event_lists(),
       sizes=st.sampled_from([("5 minutes", "1 minute"), ("10 minutes", "4 minutes"),
                              ("1 hour", "20 minutes"), ("90 seconds", "1 minute")]))
def test_pane_windows_equal_direct_windows(spark, events, sizes):
    size, slide = sizes
    d = decode.decode_events(lines_df(spark, events))
    clicks = alerts.click_filter(d)
    cols = ["product_id", "window_start", "window_end", "click_count",
            "first_event_time", "last_event_time"]
    direct = alerts.window_aggregate(clicks, size, slide, panes=False).select(*cols)
    panes = alerts.window_aggregate(clicks, size, slide, panes=True).select(*cols)
    assert sorted(map(tuple, panes.collect())) == sorted(map(tuple, direct.collect()))


def test_count_windows_are_hash_aggregated_over_panes(spark):
    d = adapter.driver_events(spark, SF001)
    plan = alerts.click_windows(alerts.with_event_ts(d))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SortAggregate" not in plan and "Expand" not in plan
    assert plan.count("HashAggregate") >= 4          # partial + final, twice
    assert alerts.duration_ms("5 minutes") == 300_000 and alerts.duration_ms("1 hour") == 3_600_000
    assert alerts.duration_ms("1 hour 30 minutes") is None


@pytest.mark.parametrize("query", ["product_metrics", "order_progress"])
def test_text_winners_are_hash_aggregated(spark, query):
    """The newest texts by arrival lie in a hash map of groups; no task sorts its rows."""
    plan = QUERIES[query](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("ObjectHashAggregate") >= 2


@pytest.mark.parametrize("threshold", ["1", "65536"])
def test_text_winners_are_equal_with_and_without_room_for_all_groups(spark, threshold):
    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        got = {q: sorted(map(str, QUERIES[q](spark, SF001).collect())) for q in ("product_metrics", "order_progress")}
    finally:
        spark.conf.set(key, before)
    assert got == {q: sorted(map(str, QUERIES[q](spark, SF001).collect())) for q in got}


def test_ever_is_false_for_nulls_alone(spark):
    rows = spark.createDataFrame([("a", None), ("a", False), ("b", None), ("b", True), ("c", None)], "k string, v boolean")
    got = rows.groupBy("k").agg(ever(F.col("v")).alias("e")).collect()
    assert {r.k: r.e for r in got} == {"a": False, "b": True, "c": False}


_TEXT = st.text(alphabet=st.sampled_from(list('ab"\\/ é€中\t\n{}[]:,')), min_size=0, max_size=12)
_NONEMPTY = st.text(alphabet=st.sampled_from(list('ab"\\/ é€中{}[]:,')), min_size=1, max_size=12)


@st.composite
def typed_events(draw):
    from shopstream.schema import EVENT_COLUMNS
    n = draw(st.integers(min_value=1, max_value=15))
    rows = []
    for i in range(n):
        rows.append((
            f"id{i}-" + draw(_TEXT), "1.0", draw(st.sampled_from(["click", "cart", "x"])),
            "2024-01-01T00:00:0" + str(i % 10) + ".000Z", "2024-01-01T00:00:10.000Z",
            draw(_TEXT), draw(_TEXT), draw(_TEXT), draw(_NONEMPTY), draw(_TEXT),
            draw(st.one_of(st.none(), st.integers(min_value=-2**31, max_value=2**31 - 1))),
            draw(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False))),
            draw(st.one_of(st.none(), st.floats(min_value=-1e12, max_value=1e12))),
            draw(st.one_of(st.none(), _TEXT)), draw(st.one_of(st.none(), _TEXT)),
            draw(st.one_of(st.none(), _TEXT))))
    return EVENT_COLUMNS, rows


@SETTINGS
@given(data=typed_events())
def test_json_round_trip_keeps_every_field(spark, data):
    from shopstream.schema import EVENT
    cols, rows = data
    df = spark.createDataFrame(rows, EVENT)
    back = decode.decode_events(jsonl.to_json_lines(df)).select(*cols)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def _py_reason(line):
    """The specification: Python's json reader plus truthiness of product_id."""
    import json
    if line is None or not line.strip():
        return "blank"
    try:
        v = json.loads(line.strip())
    except ValueError:
        return "malformed"
    if not isinstance(v, dict):
        return "not_object"
    return None if v.get("product_id") else "no_product"


@st.composite
def raw_lines(draw):
    import json
    pid = draw(st.sampled_from(["<missing>", None, "", "p1", "x y"]))
    obj = {"event_id": draw(st.text(max_size=5)), "event_type": "click"}
    if pid != "<missing>":
        obj["product_id"] = pid
    text = json.dumps(obj, ensure_ascii=draw(st.booleans()))
    kind = draw(st.sampled_from(["object", "array", "scalar", "truncated", "trailing", "blank",
                                 "garbage", "py_literal", "spaced"]))
    if kind == "object":
        return text
    if kind == "spaced":
        return "  " + text.replace(", ", " ,  ") + " \t"
    if kind == "array":
        return "[" + text + "]"
    if kind == "scalar":
        return draw(st.sampled_from(['"s"', "12", "-3.5e2", "true", "null", '""', "0"]))
    if kind == "truncated":
        return text[: draw(st.integers(min_value=1, max_value=max(1, len(text) - 1)))]
    if kind == "trailing":
        return text + draw(st.sampled_from([" x", "]", ",", " 1"]))
    if kind == "py_literal":
        return draw(st.sampled_from(["NaN", "Infinity", "-Infinity"]))
    if kind == "blank":
        return draw(st.sampled_from(["", "   ", "\t"]))
    return draw(st.text(alphabet=st.sampled_from(list('{}[]":,ab1 ')), min_size=1, max_size=10))


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(lines=st.lists(raw_lines(), min_size=1, max_size=30))
def test_reject_reasons_match_python_reader(spark, lines):
    got = [r.reason for r in decode.decode_lines(
        spark.createDataFrame([(x,) for x in lines], "value string")).select("reason").collect()]
    assert got == [_py_reason(x) for x in lines]


@st.composite
def iso_times(draw):
    import datetime as dt
    t = dt.datetime(2020, 1, 1) + dt.timedelta(
        seconds=draw(st.integers(min_value=0, max_value=6 * 365 * 86400)),
        microseconds=draw(st.integers(min_value=0, max_value=999_999)))
    sep = draw(st.sampled_from(["T", " "]))
    frac = draw(st.sampled_from(["", "ms", "us"]))
    text = t.strftime(f"%Y-%m-%d{sep}%H:%M:%S")
    if frac == "ms":
        text += f".{t.microsecond // 1000:03d}"
    elif frac == "us":
        text += f".{t.microsecond:06d}"
    zone = draw(st.sampled_from(["", "Z", "+03:00", "-05:30", "+00:00"]))
    return text + zone


def _py_event_ms(text):
    import datetime as dt
    d = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    if d.tzinfo is None:
        d = d.replace(tzinfo=dt.timezone.utc)
    delta = d - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (delta.days * 86_400_000_000 + delta.seconds * 1_000_000 + delta.microseconds) // 1000


@SETTINGS
@given(times=st.lists(iso_times(), min_size=1, max_size=20))
def test_event_time_matches_python_isoformat(spark, times):
    from pyspark.sql import functions as F
    from shopstream.functions.columns import parse_iso_ts
    df = spark.createDataFrame([(t,) for t in times], "s string")
    got = [r.ms for r in df.select(F.unix_millis(parse_iso_ts("s")).alias("ms")).collect()]
    assert got == [_py_event_ms(t) for t in times]


def _py_running_metrics(events):
    """Sequential per-product fold in arrival order, written from the spec."""
    from fractions import Fraction

    def money(v):
        try:
            f = float(v or 0.0)
        except (TypeError, ValueError):
            return Fraction(0)
        return Fraction(f) if math.isfinite(f) else Fraction(0)

    def arrival(e):
        return (_py_event_ms(e["ingested_at"]), e["event_id"])

    state = {}
    for e in sorted(events, key=arrival):
        pid = e.get("product_id")
        if not pid:
            continue
        m = state.setdefault(pid, {"clicks": 0, "cart_adds": 0, "checkouts": 0,
                                   "orders_value": Fraction(0), "delivered": 0,
                                   "category": e.get("category") or "unknown",
                                   "last_event_time": "", "last_event_id": ""})
        et = e.get("event_type")
        if et == "click":
            m["clicks"] += 1
        elif et == "cart" and e.get("cart_action") == "add":
            m["cart_adds"] += 1
        elif et == "cart" and e.get("cart_action") == "checkout":
            m["checkouts"] += 1
            m["orders_value"] += money(e.get("total_value"))
        elif et == "delivery_status" and e.get("delivery_status") == "delivered":
            m["delivered"] += 1
        m["category"] = e.get("category") or m["category"]
        m["last_event_time"] = e.get("event_time") or m["last_event_time"]
        m["last_event_id"] = e.get("event_id") or m["last_event_id"]
    return {k: (v["clicks"], v["cart_adds"], v["checkouts"], float(v["orders_value"]),
                v["delivered"], v["category"], v["last_event_time"], v["last_event_id"])
            for k, v in state.items()}


@SETTINGS
@given(events=event_lists())
def test_running_metrics_match_sequential_fold(spark, events):
    got = {r.product_id: tuple(r)[1:] for r in
           metrics.product_metrics(decode.decode_events(lines_df(spark, events))).collect()}
    assert got == _py_running_metrics(events)


def _py_alerts(events, size_ms, slide_ms, threshold):
    wins = {}
    for e in events:
        if e["event_type"] != "click" or not e.get("product_id"):
            continue
        t = _py_event_ms(e["event_time"])
        start = t - t % slide_ms
        while start > t - size_ms:
            wins.setdefault((e["product_id"], start), []).append(e)
            start -= slide_ms
    out = {}
    for (pid, start), es in wins.items():
        if len(es) < threshold:
            continue
        timed = sorted((e for e in es if e.get("event_time")),
                       key=lambda e: (_py_event_ms(e["ingested_at"]), e["event_id"]))
        out[f"alert|{pid}|{start}|{start + size_ms}"] = (
            len(es), timed[0]["event_time"] if timed else "", timed[-1]["event_time"] if timed else "")
    return out


@SETTINGS
@given(events=event_lists(), threshold=st.integers(min_value=1, max_value=3))
def test_alerts_match_brute_force(spark, events, threshold):
    d = decode.decode_events(lines_df(spark, events))
    got = {r.row_key: (r.click_count, r.first_event_time, r.last_event_time)
           for r in alerts.click_alerts(d, "1 hour", "20 minutes", threshold).collect()}
    assert got == _py_alerts(events, 3_600_000, 1_200_000, threshold)


def test_fixture_stream_ten_files_one_per_batch(spark, tmp_dir):
    """FIXTURES 2.3: sf0.01, 10 arrival-ordered files, one per batch -> 9,885 windows, 0 dropped."""
    import json
    import os

    from conftest import SF01

    ev_ = adapter.driver_events(spark, SF01)
    cols = ev_.columns[:16]
    rows = sorted((r.asDict() for r in ev_.collect()),             # 10,000-row fixture
                  key=lambda r: (r["ingested_ms"], r["event_id"]))
    src = f"{tmp_dir}/ten"
    os.makedirs(src)
    per = len(rows) // 10
    for i in range(10):
        with open(f"{src}/part-{i:02d}.json", "w") as fh:
            for r in rows[i * per:(i + 1) * per]:
                fh.write(json.dumps({k: r[k] for k in cols}) + "\n")
        os.utime(f"{src}/part-{i:02d}.json", (1_600_000_000 + i, 1_600_000_000 + i))
    run = f"{tmp_dir}/run"
    q = sq.start_click_windows(spark, src, f"{run}/sink", f"{run}/ck",
                               sq.Trigger(available_now=True), max_files_per_trigger=1)
    q.awaitTermination()
    assert sq.rows_dropped_by_watermark(q) == 0
    schema = sq.click_windows_stream(sq.decoded_stream(spark, src)).schema
    got = sq.current(spark, f"{run}/sink", schema, [], append_only=True)
    assert got.count() == 9885


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(lines=st.lists(raw_lines(), min_size=1, max_size=30))
def test_pruned_decode_equals_full_decode(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    keep = ("event_id", "event_type")
    full = decode.decode_lines(df).select("reason", *keep, "event_ms").collect()
    pruned = decode.decode_lines(df, fields=keep).select("reason", *keep, "event_ms").collect()
    assert [tuple(r)[:3] for r in pruned] == [tuple(r)[:3] for r in full]
    pruned_cols = decode.decode_events(df, fields=keep).columns
    assert "category" not in pruned_cols and "product_id" in pruned_cols


@st.composite
def order_events(draw):
    n = draw(st.integers(min_value=1, max_value=25))
    out = []
    for i in range(n):
        kind = draw(st.sampled_from(["checkout", "delivery", "click"]))
        sec = draw(st.integers(min_value=0, max_value=59))
        minute = draw(st.integers(min_value=0, max_value=59))
        t = f"2024-01-01T00:{minute:02d}:{sec:02d}.000Z"
        oid = draw(st.sampled_from(["o1", "o2", "o3", None]))
        if kind == "checkout":
            e = ev(f"e{i:03d}", "cart", cart_action="checkout", order_id=oid, event_time=t,
                   ingested_at=t)
        elif kind == "delivery":
            e = ev(f"e{i:03d}", "delivery_status", order_id=oid, event_time=t, ingested_at=t,
                   delivery_status=draw(st.sampled_from(["created", "shipped", "delivered"])))
        else:
            e = ev(f"e{i:03d}", "click", event_time=t, ingested_at=t)
        out.append(e)
    return out


def _py_order_progress(events):
    def arrival(e):
        return (_py_event_ms(e["ingested_at"]), e["event_id"])
    out = {}
    for oid in {e["order_id"] for e in events if e.get("order_id")}:
        ck = sorted((e for e in events if e.get("order_id") == oid and e["event_type"] == "cart"
                     and e.get("cart_action") == "checkout"), key=arrival)
        if not ck:
            continue
        de = sorted((e for e in events if e.get("order_id") == oid
                     and e["event_type"] == "delivery_status"), key=arrival)
        st_ = [e for e in de if e.get("delivery_status")]
        out[oid] = (ck[0]["event_time"], len(ck), st_[-1]["delivery_status"] if st_ else None,
                    len(de), any(e.get("delivery_status") == "delivered" for e in de))
    return out


@SETTINGS
@given(events=order_events())
def test_order_progress_matches_brute_force(spark, events):
    from shopstream.operators import quality
    got = {r.order_id: tuple(r)[1:] for r in
           quality.order_progress(decode.decode_events(lines_df(spark, events))).collect()}
    assert got == _py_order_progress(events)


def _py_sales_and_totals(events):
    from fractions import Fraction

    def dec(v):
        return Fraction(float(v))

    sales, totals = {}, {}
    for e in events:
        key = (e.get("product_id"), e.get("category"))
        if e.get("event_id") is not None and e.get("event_type") is not None \
                and e.get("total_value") is not None:
            s = sales.setdefault(key, [0, Fraction(0), Fraction(0), 0])
            s[0] += 1
            s[1] += dec(e["total_value"])
            s[2] += dec(e["unit_price"])
            s[3] += 1
        if e.get("product_id") is not None:
            # SUM(CASE WHEN checkout THEN total_value ELSE 0 END): NULL terms are
            # skipped, and a group of only NULL terms sums to NULL
            t = totals.setdefault(key, [0, 0, 0, Fraction(0), 0, False])
            et, ca = e.get("event_type"), e.get("cart_action")
            checkout = et == "cart" and ca == "checkout"
            t[0] += et == "click"
            t[1] += et == "cart" and ca == "add"
            t[2] += checkout
            if not checkout:
                t[5] = True
            elif e.get("total_value") is not None:
                t[3] += dec(e["total_value"])
                t[5] = True
            t[4] += et == "delivery_status" and e.get("delivery_status") == "delivered"
    return ({k: (v[0], float(v[1]), float(v[2]) / v[3]) for k, v in sales.items()},
            {k: (v[0], v[1], v[2], float(v[3]) if v[5] else None, v[4])
             for k, v in totals.items()})


@SETTINGS
@given(events=event_lists())
def test_sales_and_totals_match_brute_force(spark, events):
    d = decode.decode_events(lines_df(spark, events))
    exp_sales, exp_totals = _py_sales_and_totals(events)
    got_sales = {(r.product_id, r.category): tuple(r)[2:] for r in batch.sales(batch.clean(d)).collect()}
    got_totals = {(r.product_id, r.category): tuple(r)[2:]
                  for r in batch.product_metrics_batch(d).collect()}
    assert got_sales == exp_sales
    assert got_totals == exp_totals
