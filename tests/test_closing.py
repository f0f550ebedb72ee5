"""Triggers in one stream: days closed by timers, late posts, restarts and forgotten series."""

import datetime as dt
import os

import pyarrow as pa
from pyspark.sql import functions as F

from signalpost.operators import aggregates, windows
from signalpost.streaming import closing, triggers

SCHEMA = "ts timestamp, community string, car_name string, issue string, num_views bigint, num_likes bigint"


def post(day, hour=10, car="a", views=10):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day), "c", car, "i", views, views % 5


def run(spark, tmp_path, waves, **options):
    limits = aggregates.bounds(aggregates.with_log(spark.createDataFrame([post(0, views=0), post(0, views=1004)], SCHEMA)))
    limits.write.parquet(f"{tmp_path}/limits")
    limits = spark.read.parquet(f"{tmp_path}/limits")
    for wave in waves:
        spark.createDataFrame(wave, SCHEMA).write.mode("append").parquet(f"{tmp_path}/posts")
        posts = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/posts")
        out = closing.run_closing(closing.closing_stream(posts, limits, **options), str(tmp_path))
    return {(r["car_name"], r["upload_date"].day + 31 * (r["upload_date"].month - 1) - 1): (r["score"], r["is_trigger"]) for r in out.collect()}


def want(spark, rows):
    limits = aggregates.bounds(aggregates.with_log(spark.createDataFrame([post(0, views=0), post(0, views=1004)], SCHEMA)))
    posts = spark.createDataFrame(rows, SCHEMA).withColumn("upload_date", F.to_date("ts"))
    daily = aggregates.daily_features(aggregates.minmax(aggregates.with_log(posts), limits))
    smooth = windows.ema(daily, ["car_name", "issue"], "upload_date", {"v": ("avg_log_view", 0.05), "l": ("sum_log_like", 0.02)})
    return {(r["car_name"], (r["upload_date"] - dt.date(2024, 1, 1)).days): r["score"] for r in windows.score(smooth, ["v", "l"]).collect()}


def test_days_close_in_order_and_late_posts_count_while_their_day_is_open(spark, tmp_path):
    rows = [post(d, h, views=10 + 7 * d + h) for d in range(12) for h in (1, 9, 23)] + [post(d, car="b", views=d) for d in (0, 5, 11)]
    first = [r for r in rows if r[0].day <= 6 and not (r[0].day == 5 and r[0].hour == 9)]
    second = [r for r in rows if r not in first]
    too_late = [post(1, 5, views=900)]  # its day is closed after the first wave
    got = run(spark, tmp_path, [first, [*second, *too_late]])
    expected = want(spark, rows)
    closed = {key for key in expected if key[1] + 1 <= 11 - 2}
    assert set(got) == closed
    assert all(abs(got[key][0] - expected[key]) < 1e-12 for key in closed)
    left = spark.read.format("statestore").option("stateVarName", "days").load(f"{tmp_path}/state")
    assert left.count() == len(expected) - len(closed)  # only open days are held


def test_a_series_without_posts_is_forgotten(spark, tmp_path):
    early = [post(d, views=100 + d) for d in range(4)] + [post(d, car="b", views=5 + d) for d in range(20)]
    later = [post(d, views=7 + d) for d in range(30, 33)] + [post(d, car="b", views=5 + d) for d in range(20, 40)]
    got = run(spark, tmp_path, [early, later, [post(60, car="b")]], idle_days=8)
    alone = want(spark, [r for r in later if r[2] == "a"])
    assert {k: round(v[0], 12) for k, v in got.items() if k[0] == "a" and k[1] >= 30} == {k: round(v, 12) for k, v in alone.items()}
    whole = want(spark, [r for r in early + later if r[2] == "b"])
    assert {k: round(v[0], 12) for k, v in got.items() if k[0] == "b"} == {k: round(v, 12) for k, v in whole.items()}
    held = spark.read.format("statestore").option("stateVarName", "averages").load(f"{tmp_path}/state")
    assert [r[0] for r in held.select("key.car_name").collect()] == ["b"]  # its last timer is due with the next posts


def test_state_partitions_do_not_grow_with_the_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 20)
    try:
        run(spark, tmp_path / "in_one", [[post(d) for d in range(6)]])
        posts = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in_one/posts")
        triggers.trigger_chain(posts, spark.read.parquet(f"{tmp_path}/in_one/limits"), f"{tmp_path}/chain")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for state in ("in_one/state", "chain/days-state", "chain/triggers-state"):
        held = [x for x in os.listdir(f"{tmp_path}/{state}/state/0") if x.isdigit()]
        assert len(held) == triggers.STATE_PARTITIONS, state


def test_posts_are_summed_before_the_shuffle(monkeypatch):
    names = ["car_name", "issue", "upload_date", "closes", "n", "view", "like"]

    def batch(*rows):
        kinds = [pa.string(), pa.string(), pa.date32(), pa.timestamp("us", "UTC"), pa.int64(), pa.float64(), pa.float64()]
        schema = pa.schema([pa.field(n, t, nullable=i < 4) for i, (n, t) in enumerate(zip(names, kinds))])  # as Spark sends them
        return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    day, end = dt.date(2024, 1, 1), dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    posts = [batch(("a", "i", day, end, 1, 0.5, 1.0), ("a", "i", day, end, 1, 0.25, 0.0)), batch(("a", "i", day, end, 1, 0.25, 2.0), (None, "i", None, None, 1, 1.0, 1.0))]

    def rows():
        return [tuple(r.values()) for b in closing.summed(iter(posts)) for r in b.to_pylist()]

    assert sorted(rows(), key=str) == sorted([("a", "i", day, end, 3, 1.0, 3.0), (None, "i", None, None, 1, 1.0, 1.0)], key=str)
    monkeypatch.setattr(closing, "HELD_ROWS", 0)
    assert len(rows()) == 3 and sum(r[4] for r in rows()) == 4
    assert list(closing.summed(iter([]))) == []
