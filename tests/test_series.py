"""Series operators against plain loops."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalpost.functions.dtw import dtw, paired_distances
from signalpost.operators import windows
from signalpost.operators.ranges import split_months, split_range
from signalpost.operators.similar import nearest_cases

DAY = dt.date(2000, 1, 1)


def days(spark, values, key="a"):
    return spark.createDataFrame([(key, DAY + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)], "k string, d date, v double")


def loop_ema(values, alpha):
    out = [values[0]]
    for v in values[1:]:
        out.append((1 - alpha) * out[-1] + alpha * v)
    return out


@pytest.mark.parametrize("alpha", [0.02, 0.05, 0.5, 0.9, 1.0])
def test_ema_equals_loop_over_many_stretches(spark, alpha):
    rng = random.Random(1)
    values = [rng.random() for _ in range(2500)]  # alpha 0.5 needs 4 stretches, 0.9 needs 12
    got = windows.ema(days(spark, values), ["k"], "d", {"e": ("v", alpha)}).orderBy("d").select("e").collect()
    assert [r[0] for r in got] == pytest.approx(loop_ema(values, alpha), rel=1e-12)


def test_ema_columns_of_different_speed(spark):
    rng = random.Random(2)
    values = [rng.random() for _ in range(300)]
    got = windows.ema(days(spark, values), ["k"], "d", {"fast": ("v", 0.999), "slow": ("v", 0.001)}).orderBy("d").collect()
    assert [r.fast for r in got] == pytest.approx(loop_ema(values, 0.999), rel=1e-12)
    assert [r.slow for r in got] == pytest.approx(loop_ema(values, 0.001), rel=1e-12)


def test_ema_starts_anew_per_series(spark):
    both = days(spark, [1, 2], "a").unionByName(days(spark, [10, 20], "b"))
    got = {(r.k, r.d): r.e for r in windows.ema(both, ["k"], "d", {"e": ("v", 0.5)}).collect()}
    assert got[("b", DAY)] == 10.0


def test_triggers_flat_window_is_quiet(spark):
    values = [0.1] * 10 + [5.0] + [0.1] * 3
    hits = windows.detect_triggers(days(spark, values), ["k"], "d", "v").collect()
    assert [h.d for h in hits] == [DAY + dt.timedelta(days=10)]
    falls = windows.detect_triggers(days(spark, [5.0] * 10 + [0.1]), ["k"], "d", "v", k=2.0, ddof=1, two_sided=True).collect()
    assert [h.d for h in falls] == [DAY + dt.timedelta(days=10)]


def test_slope_alarms_keep_their_distance(spark):
    dates = [1, 10, 17, 40]
    df = spark.createDataFrame([([DAY + dt.timedelta(days=d) for d in dates],)], "a array<date>")
    kept = df.select(windows.keep_with_gap(F.col("a"), 15)).first()[0]
    assert [(k - DAY).days for k in kept] == [1, 17, 40]


def test_gradient_and_rolling(spark):
    df = windows.gradient(days(spark, [0, 1, 4, 9]), ["k"], "d", "v")
    assert [r.slope for r in df.orderBy("d").collect()] == list(np.gradient([0, 1, 4, 9]))
    rolled = windows.rolling_mean(days(spark, [1, 2, 3]), ["k"], "d", "v", 2, "m").orderBy("d").collect()
    assert [r.m for r in rolled] == [None, 1.5, 2.5]


def test_date_spine(spark):
    df = days(spark, [1, 2, 3]).filter(F.col("v") != 2)
    assert [r.v for r in windows.date_spine(df, ["k"], "d", ["v"]).orderBy("d").collect()] == [1.0, 0.0, 3.0]


def test_sliding_windows_end_short(spark):
    got = windows.sliding_windows(days(spark, range(6)), ["k"], "d", "v", 4, 3).orderBy("start").collect()
    assert [(r.start, r.window) for r in got] == [(0, [0, 1, 2, 3]), (1, [1, 2, 3, 4]), (2, [2, 3, 4, 5]), (3, [3, 4, 5])]


def test_split_range(spark):
    df = spark.sql("select timestamp'2024-03-01 01:20:00' t")
    got = split_range(df, F.col("t"), F.lit(10), F.lit(4)).orderBy("part").select(
        F.date_format("start_datetime", "dd HH:mm"), F.date_format("end_datetime", "dd HH:mm")).collect()
    assert [tuple(r) for r in got] == [("01 07:00", "01 09:59"), ("01 04:00", "01 06:59"), ("01 02:00", "01 03:59"), ("01 00:00", "01 01:59")]


def test_split_months(spark):
    df = spark.sql("select timestamp'2024-01-15 10:00:00' a, timestamp'2024-03-02 12:30:00' b")
    got = split_months(df, F.col("a"), F.col("b")).orderBy("start_datetime").select(
        F.date_format("start_datetime", "MM-dd HH:mm"), F.date_format("end_datetime", "MM-dd HH:mm")).collect()
    assert [tuple(r) for r in got] == [("01-15 10:00", "01-31 23:59"), ("02-01 00:00", "02-29 23:59"), ("03-01 00:00", "03-02 12:30")]


def brute_dtw(a, b, squared):
    if not a or not b:
        return math.inf
    table = np.full((len(a) + 1, len(b) + 1), np.inf)
    table[0, 0] = 0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            cost = (x - y) ** 2 if squared else abs(x - y)
            table[i + 1, j + 1] = cost + min(table[i, j], table[i, j + 1], table[i + 1, j])
    return math.sqrt(table[-1, -1]) if squared else table[-1, -1]


numbers = st.lists(st.floats(-100, 100), max_size=8)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(numbers, numbers), min_size=1, max_size=5), st.booleans())
def test_dtw_equals_table(pairs, squared):
    got = paired_distances([p[0] for p in pairs], [p[1] for p in pairs], squared)
    assert got.tolist() == pytest.approx([brute_dtw(a, b, squared) for a, b in pairs], rel=1e-9, abs=1e-9)
    back = paired_distances([p[1] for p in pairs], [p[0] for p in pairs], squared)
    assert back.tolist() == pytest.approx(got.tolist(), rel=1e-9, abs=1e-9)


def test_dtw_in_spark(spark):
    df = spark.createDataFrame([(1, [0, 0, 1, 2, 1, 0, 1, 0, 0], [0, 1, 2, 0, 0, 0, 0, 0, 0]), (2, [3, 4], [3, 4]), (3, [], [1])],
                               "i int, a array<int>, b array<int>")
    df = df.select("i", F.col("a").cast("array<double>").alias("a"), F.col("b").cast("array<double>").alias("b"))
    got = [r[0] for r in df.orderBy("i").select(dtw(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([math.sqrt(2), 0.0, math.inf])


def test_nearest_cases_equals_all_pairs(spark):
    rng = random.Random(3)
    walk = lambda n: np.cumsum([rng.gauss(0, 1) for _ in range(n)]).tolist()
    monitored = [(f"car{i % 5}", f"issue{i % 4}", walk(rng.randint(1, 12))) for i in range(20)]
    cases = [(f"car{i % 6}", f"issue{i % 5}", DAY + dt.timedelta(days=i), walk(rng.randint(1, 15)) if i % 17 else []) for i in range(90)]
    got = nearest_cases(
        spark.createDataFrame(monitored, "car_name string, issue string, monitor_scores array<double>"),
        spark.createDataFrame(cases, "case_car string, case_issue string, trigger_date date, case_scores array<double>"),
        k=3, monitor_block=6, case_block=20).collect()
    want = set()
    for car, issue, scores in monitored:
        ranked = sorted((round(brute_dtw(scores, c[3], True), 9), c[0], c[1], c[2]) for c in cases if c[0] != car and c[1] != issue)
        want |= {(car, issue, i + 1, r[1], r[2], r[3], round(r[0], 6)) for i, r in enumerate(ranked[:3])}
    assert {(r.car_name, r.issue, r["rank"], r.case_car, r.case_issue, r.trigger_date, round(r.distance, 6)) for r in got} == want


def test_nearest_window_meets_few_windows():
    from signalpost.functions.dtw import paired_distances
    from signalpost.operators.similar import nearest_window
    local = np.random.default_rng(12)
    for size, length, n in ((5, 3, 40), (4, 4, 4), (3, 6, 30), (10, 7, 600), (2, 1, 9), (1, 1, 5), (4, 9, 5)):
        series = np.round(np.cumsum(local.normal(size=n)), 2).tolist()
        query = np.round(np.array(series[-length:]) + local.normal(0, 0.1, min(length, n)), 2).tolist() if n >= length else [1.0] * length
        counted = []
        got = nearest_window(series, query, size, 16, counted)
        windows = [series[i:i + size] for i in range(n - length + 1)]
        if not windows:
            assert got is None
            continue
        exact = np.round(paired_distances(windows, [query] * len(windows), False), 9)
        start = min(range(len(windows)), key=lambda i: (exact[i], i))
        assert got == (start, exact[start], windows[start])
        if n == 600:
            assert sum(counted) < 0.5 * len(windows)
    assert nearest_window([], [1.0], 3) is None and nearest_window([1.0], [], 3) is None


def test_blocks_that_are_too_far_are_not_met(spark, monkeypatch):
    from signalpost.operators import similar
    local = np.random.default_rng(7)
    cases = [(f"car{i % 9}", f"i{i % 4}", dt.date(2020, 1, 1) + dt.timedelta(days=i), (local.normal(size=int(local.integers(1, 9))) + 10 * (i % 30)).tolist()) for i in range(900)]
    cases.append(("car1", "i1", dt.date(2019, 1, 1), []))
    monitored = [(f"car{i % 9}", f"m{i}", (local.normal(size=6) + 10 * (i % 30)).tolist()) for i in range(60)] + [("car0", "i0", [])]
    met = []
    plain_meet = similar._meet
    monkeypatch.setattr(similar, "_meet", lambda routed, *rest: met.append(routed.select(F.explode("_parts")).count()) or plain_meet(routed, *rest))
    left = spark.createDataFrame(monitored, "car_name string, issue string, monitor_scores array<double>")
    right = spark.createDataFrame(cases, "case_car string, case_issue string, trigger_date date, case_scores array<double>")
    got = {(r["car_name"], r["issue"], r["rank"]): (r["case_car"], r["case_issue"], r["trigger_date"], r["distance"])
           for r in nearest_cases(left, right, 3, 8, 40).collect()}
    from signalpost.functions.dtw import paired_distances
    want = {}
    for car, issue, series in monitored:
        pairs = [c for c in cases if c[0] != car and c[1] != issue]
        far = np.round(paired_distances([series] * len(pairs), [c[3] for c in pairs]), 9)
        best = sorted((d, *c[:3]) for d, c in zip(far.tolist(), pairs))[:3]
        want |= {(car, issue, n): (*c, d) for n, (d, *c) in enumerate(best, 1)}
    assert got == want
    blocks = -(-len(cases) // 40)
    assert sum(met) < 0.4 * blocks * len(monitored)  # series sent to blocks; without bounds each goes to all
