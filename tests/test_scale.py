"""Helpers for large and uneven tables against plain results."""

import datetime as dt
import random

from pyspark.sql import functions as F

from signalpost import scale
from signalpost.operators import tables, windows
from signalpost.operators.aggregates import latest_trigger, today_summary, trigger_urls
from signalpost.plans import ingest, serving
from signalpost.schemas import CRAWL
from signalpost.session import work_folder


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def hot(spark, n=900):
    """One key holds most rows."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 10).cast("string"))).alias("k"))


def test_salted_join(spark):
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4)], "k string, x int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(scale.salted_join(hot(spark), small, ["k"], F.col("id"), how, salts=7)) == rows(hot(spark).join(small, "k", how).select(
            *scale.salted_join(hot(spark), small, ["k"], F.col("id"), how).columns))


def test_interval_join(spark):
    rng = random.Random(4)
    points = spark.createDataFrame([(i, "hot" if i % 3 else "b", rng.randint(-50, 300)) for i in range(300)], "i int, k string, p int")
    spans = [(j, "hot" if j % 2 else "b", a, a + rng.randint(-5, 60)) for j, a in ((j, rng.randint(-60, 300)) for j in range(40))]
    intervals = spark.createDataFrame(spans, "j int, k string, lo int, hi int")
    want = sorted((p.i, s[0]) for p in points.collect() for s in spans if p.k == s[1] and s[2] <= p.p <= s[3])
    for spread in (None, F.col("i")):
        got = scale.interval_join(points, intervals, ["k"], F.col("p"), F.col("lo"), F.col("hi"), 17, spread)
        assert sorted(tuple(r) for r in got.select("i", "j").collect()) == want


def test_name_and_text_matches(spark, monkeypatch):
    texts = ["sonata and ioniq", "ioniq5", "", "son", "그랜저 신형", "x" * 70 + "long", "a.b"]
    names = ["son", "ioniq", "그랜저", "x" * 70, "q5", "zz", ".", "x" * 66 + "y"]
    t = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    n = spark.createDataFrame([(x,) for x in names], "n string")
    want = sorted((i, x) for i, s in enumerate(texts) for x in names if x in s)
    for limit in (scale.SMALL_ROWS, 0):  # once by broadcast, once by the shuffled way
        monkeypatch.setattr(scale, "SMALL_ROWS", limit)
        assert sorted(tuple(r) for r in scale.contains_join(t, "i", "t", n, "n").collect()) == want
        assert sorted(tuple(r) for r in scale.name_matches(t, "t", n, "n").collect()) == sorted((texts[i], x) for i, x in want)


def test_list_in_parts_keeps_every_value(spark):
    df = hot(spark).withColumn("url", F.concat(F.lit("u"), F.col("id").cast("string")))
    sizes = df.groupBy("k").agg(F.count("*").alias("n"))
    got = scale.list_in_parts(df.join(sizes, "k"), ["k"], F.col("n"), "url", limit=100).collect()
    assert max(len(r.url) for r in got) < 200 and sum(len(r.url) for r in got) == 900
    assert len({u for r in got for u in r.url}) == 900 and all(r.part == 0 for r in got if r.k != "hot")


def test_trigger_urls_one_row_for_a_small_trigger(spark):
    df = spark.createDataFrame([("a", "x", dt.date(2024, 1, 1), True, 2, u) for u in ("u2", "u1")],
                               "car_name string, issue string, upload_date date, is_trigger boolean, n_posts int, url string")
    got = trigger_urls(df).collect()
    assert len(got) == 1 and got[0].url == ["u1", "u2"] and got[0].part == 0


def test_running_sum_over_stretches(spark):
    df = spark.createDataFrame([("a", i, i % 3) for i in range(50)] + [(None, i, 1) for i in range(5)], "k string, p int, v int")
    got = {(r.k, r.p): r.s for r in scale.running_sum(df, ["k"], "p", "v", "s", span=7).collect()}
    assert len(got) == 55 and all(got[("a", i)] == sum(j % 3 for j in range(i + 1)) for i in range(50)) and got[(None, 4)] == 5


def test_threads(spark):
    data = [("p", 0, "user", "q1"), ("p", 1, "x", "r1"), ("p", 2, "x", "r2"), ("p", 3, "user", "q2"), ("z", 0, "x", "lost")]
    df = spark.createDataFrame(data, "post string, pos int, role string, text string")
    got = windows.threads(df, "post", "pos", F.col("role") == "user", "text").orderBy("post", "thread").collect()
    assert [(r.post, r.thread, r.text) for r in got] == [("p", 1, "q1\nr1\nr2"), ("p", 2, "q2"), ("z", 0, "lost")]
    parts = windows.threads(df, "post", "pos", F.col("role") == "user", "text", limit=2)
    assert sorted((r.post, r.thread, r.part, r.text) for r in parts.collect()) == [
        ("p", 1, 0, "q1\nr1"), ("p", 1, 1, "r2"), ("p", 2, 0, "q2"), ("z", 0, 0, "lost")]


def test_load_with_post_id_is_dense(spark):
    df = spark.range(5000).select(F.col("id").alias("u"), F.lit("same day").alias("d")).repartition(7)
    got = tables.load_with_post_id(df, ["d", "u"]).orderBy("post_id").collect()
    assert [r.post_id for r in got] == list(range(1, 5001)) and [r.u for r in got] == list(range(5000))


def test_dedupe_sorts_as_written(spark):
    data = [("u", "2024-01-02", "10:00", 99), ("u", "2024-01-01", "11:00", 1), ("u", "2024-01-01", "10:00", 5), ("u", "2024-01-01", "10:00", 7), ("w", "2024-01-01", "10:00", None)]
    df = spark.createDataFrame(data, "Url string, Date string, Time string, View int")
    assert rows(tables.dedupe_first(df)) == [("u", "2024-01-01", "10:00", 7), ("w", "2024-01-01", "10:00", None)]


POSTS = "url string, upload_date date, title string, num_views int"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_upsert_is_repeatable(spark):
    old = spark.createDataFrame([("a", D1, "t", 1), ("b", D1, "t", 1)], POSTS)
    new = spark.createDataFrame([("b", D2, "new", None), ("c", D2, "new", 3)], POSTS)
    once = tables.upsert(old, new, ["url"], ["num_views"])
    assert rows(once) == [("a", D1, "t", 1), ("b", D1, "t", None), ("c", D2, "new", 3)]
    assert rows(tables.upsert(once, new, ["url"], ["num_views"])) == rows(once)
    assert ("b", D2, "new", None) in rows(tables.upsert(old, new, ["url"]))


def test_upsert_days_touches_only_its_days(spark, tmp_path):
    target = str(tmp_path / "posts")
    old = spark.createDataFrame([("a", D1, "t", 1), ("b", D2, "t", 1), ("n", None, "t", 1)], POSTS)
    new = spark.createDataFrame([("b", D3, "new", 2), ("c", D3, "new", 3), ("m", None, "new", 4)], POSTS)
    tables.upsert_days(target, old, ["url"], ["num_views"], "upload_date")
    untouched = sorted((tmp_path / "posts" / "day=2024-01-01").glob("*.parquet"))
    for _ in range(2):
        tables.upsert_days(target, new, ["url"], ["num_views"], "upload_date")
        assert rows(tables.read_days(spark, target).select("url", "upload_date", "title", "num_views")) == [
            ("a", D1, "t", 1), ("b", D2, "t", 2), ("c", D3, "new", 3), ("m", None, "new", 4), ("n", None, "t", 1)]
    assert sorted((tmp_path / "posts" / "day=2024-01-01").glob("*.parquet")) == untouched


def test_insert_ignore(spark):
    old = spark.createDataFrame([("a", 1)], "url string, x int")
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "url string, x int")
    assert rows(tables.insert_ignore(old, new, ["url"], [F.col("x")])) == [("a", 1), ("b", 3)]


def test_overlay_keeps_missing_patches(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "url string, x int")
    patch = spark.createDataFrame([("a", None), ("b", 9)], "url string, x int")
    assert rows(tables.overlay(base, patch, "url", ["x"])) == [("a", 1), ("b", 9)]


def test_summary_is_not_multiplied_by_triggers(spark):
    posts = spark.createDataFrame([("a", "x", D1, 5, 10, 1), ("a", "x", D2, 1, 1, 0)],
                                  "car_name string, issue string, upload_date date, num_likes int, num_views int, mentions int")
    triggers = spark.createDataFrame([("a", "x", D1, "u1"), ("a", "x", D2, "u3"), ("a", "x", D2, "u2")],
                                     "car_name string, issue string, upload_date date, url string")
    got = today_summary(posts, latest_trigger(triggers)).collect()
    assert len(got) == 1
    assert (got[0].num_posts, got[0].total_likes, got[0].total_views, got[0].issue_mentions, got[0].trigger_date, got[0].issue_url) == (2, 6, 11, 3, D2, "u2")


def test_news_naming_two_cars_is_given_once(spark):
    news = spark.createDataFrame([("n1", "car0 car1", D2), ("n2", "car9", D2), ("n3", "car1", dt.date(2023, 1, 1))], "url string, car_name string, upload_date date")
    tracked = spark.createDataFrame([("car0",), ("car1",)], "tracked_name string")
    assert [r.url for r in serving.tracked_news(news, tracked, "2024-01-04 00:00").collect()] == ["n1"]


def test_alert_messages_hold_every_entry(spark):
    df = spark.range(500).select(F.concat(F.lit("car"), F.col("id").cast("string")).alias("car_name"), F.lit("x").alias("issue"))
    got = serving.render_alerts(df, F.col("car_name"), "triggers", "2024-01-04 00:00", ["car_name", "issue"], per_message=50).collect()
    assert sum(r.entries for r in got) == 500 and len(got) == 10
    lines = [line for r in got for line in r.text.split("\n\n")[1:]]
    assert sorted(lines) == sorted(f"car{i}" for i in range(500))


def test_rejected_counters_are_counted(spark):
    raw = spark.createDataFrame([("2024-01-01", "10:00", "t", "b", "c", "", "3", "s", "k", "u"),
                                 ("2024-01-01", "10:00", "t", "b", "c", "조회 1,000", "x", "s", "k", "u2")], CRAWL)
    got = ingest.rejects(raw).first()
    assert (got["rows"], got.bad_views, got.bad_likes) == (2, 1, 1)


def test_work_folder_is_below_the_shared_one(spark):
    root = spark.sparkContext.getCheckpointDir()
    assert work_folder(spark, "x") != work_folder(spark, "x") and root


def test_upsert_days_moves_a_key_and_never_wipes(spark, tmp_path):
    target = str(tmp_path / "moved")
    tables.upsert_days(target, spark.createDataFrame([("a", D1, "t", 1), ("b", D2, "t", 1)], POSTS), ["url"], None, "upload_date")
    tables.upsert_days(target, spark.createDataFrame([("a", D2, "new", 2)], POSTS), ["url"], None, "upload_date")
    assert rows(tables.read_days(spark, target).select("url", "upload_date", "title", "num_views")) == [("a", D2, "new", 2), ("b", D2, "t", 1)]
    assert not (tmp_path / "moved" / f"day={D1}").exists()


def test_nested_columns_are_measured(spark):
    from signalpost.scale import is_small
    wide = spark.range(100).selectExpr("id", "array_repeat(id, 200000) AS a")
    assert is_small(wide.select("id")) and not is_small(wide)


def test_hot_keys_are_cut_by_their_count(spark):
    big = spark.range(20_000).select("id", F.when(F.col("id") % 5 < 3, "hot").when(F.col("id") % 5 == 3, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"))
    small = spark.createDataFrame([("hot", 1), (None, 2), ("k1", 3), ("k2", 4), ("none", 5)], "k string, x int")
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = scale.dealt(big, small, ["k"], F.col("id"))
    sizes = {(r["k"], r["_salt"]): r["count"] for r in left.groupBy("k", "_salt").count().collect()}
    assert max(sizes.values()) < 20_000 / shares  # over half the rows have one key; no piece has more than one task's share
    copies = {r["k"]: r["count"] for r in right.groupBy("k").count().collect()}
    assert copies["hot"] > 1 and copies["k1"] == copies["k2"] == copies["none"] == 1
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(small, "k", how)
        assert rows(scale.salted_join(big, small, ["k"], F.col("id"), how).select(*plain.columns)) == rows(plain)
    assert scale.salted_join(big.limit(0), small, ["k"], F.col("id")).count() == 0


def test_dyadic_cells_cover_each_number_once(spark):
    rng = random.Random(6)
    spans = [(a, a + rng.choice([0, 1, 2, 7, 8, 63, 64, 1000])) for a in (rng.randint(-300, 300) for _ in range(60))] + [(-64, -1), (0, 63), (-1, 0), (5, 5)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i int, a bigint, b bigint")
    for r in df.withColumn("cells", scale.dyadic_cells(F.col("a"), F.col("b"))).collect():
        covered = [n for c in r["cells"] for n in range(c["number"] << c["level"], (c["number"] + 1) << c["level"])]
        assert sorted(covered) == list(range(r["a"], r["b"] + 1)), (r["a"], r["b"])
    ten_years = df.limit(1).select(F.size(scale.dyadic_cells(F.lit(123_456), F.lit(123_456 + 10 * 365 * 86_400)))).first()[0]
    assert ten_years <= 2 * 29


def test_long_intervals_have_few_rows(spark):
    """An interval of ten years and short ones, hourly points."""
    points = spark.range(0, 87_600, 24).select((F.col("id") * 3600).alias("s"))
    spans = [(0, 0, 10 * 365 * 86_400), (1, 5000, 90_000), (2, 7 * 86_400, 7 * 86_400)]
    intervals = spark.createDataFrame(spans, "j int, lo bigint, hi bigint")
    got = scale.interval_join(points, intervals, [], F.col("s"), F.col("lo"), F.col("hi"), 60, F.col("s")).groupBy("j").count().collect()
    want = {j: sum(lo <= h * 3600 <= hi for h in range(0, 87_600, 24)) for j, lo, hi in spans}
    assert {r["j"]: r["count"] for r in got} == {j: n for j, n in want.items() if n}
