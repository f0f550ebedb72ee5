"""The kept interest series against the job that reads all posts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from signalpost.plans import interest
from signalpost.plans.kept import KeptSeries

SCHEMA = "url string, upload_date date, upload_time string, community string, car_name string, issue string, num_views bigint, num_likes bigint, wave int"
ASOFS = ["2024-01-10 12:00", "2024-01-10 13:00", "2024-01-20 06:00", "2024-01-31 00:00"]


def rows():
    local = random.Random(3)
    out = []
    for i in range(1200):
        day, wave = local.randint(1, 30), 0
        while wave < 3 and f"2024-01-{day:02d}" > ASOFS[wave]:
            wave += 1
        if i % 15 == 0:
            wave = min(3, wave + local.randint(1, 3))  # late
        out.append((f"u{i}", f"2024-01-{day:02d}", f"{local.randint(0, 23):02d}:15:00", f"c{local.randint(0, 2)}", f"car{local.randint(0, 3)}",
                    local.choice(['["a"]', '["a","b"]', "[]", '["b"]']), local.choice([None, local.randint(0, 900)]), local.randint(0, 9), wave))
    out += [("n1", None, "10:00", "c0", "car0", '["a"]', 5, 1, 2), ("n2", "2024-01-05", None, None, "car1", '["a"]', 9, 9, 1),
            ("n3", "2024-01-06", "10:00", "c1", None, '["a"]', 7, 2, 0), ("n4", "2024-02-03", "10:00", "c1", "car1", '["a"]', 8, 3, 1),
            ("late", "2023-12-01", "10:00", "c2", "car1", '["a"]', 3000, 40, 3), ("new", "2024-01-02", "10:00", "c9", "car1", '["a"]', 30, 4, 3)]
    return [(u, None if d is None else dt.date.fromisoformat(d), *rest) for u, d, *rest in out]


def as_dict(df):
    return {(r["car_name"], r["issue"], r["upload_date"]): (round(r["score"], 9), r["n_posts"]) for r in df.collect()}


def test_runs_in_waves_equal_one_run_over_everything(spark, tmp_path):
    posts = spark.createDataFrame(rows(), SCHEMA).cache()
    kept = KeptSeries(spark, str(tmp_path))
    for wave, asof in enumerate(ASOFS):
        assert kept.advance(posts.filter(F.col("wave") == wave), asof, wave)
        want = interest.interest_series(posts.filter(F.col("wave") <= wave), asof)
        assert as_dict(kept.series()) == as_dict(want), asof
    # the last run reads its own posts and those of the days that could still change
    exploded = sum(r[5].count('"') // 2 for r in rows() if r[8] == 3 and r[3] is not None)
    assert kept.read_rows["new"] == exploded < 0.7 * posts.count()
    assert kept.read_rows["recent"] < 0.25 * posts.count()
    again = as_dict(kept.series())
    assert kept.store.vacuum() > 0 and as_dict(kept.series()) == again
    assert not kept.advance(posts, ASOFS[-1], 3) and as_dict(kept.series()) == again  # a batch given twice counts once
    with pytest.raises(ValueError):
        kept.advance(posts.filter("wave = 9"), "2024-01-01 00:00", 9)


def test_in_order_runs_do_not_touch_older_days(spark, tmp_path):
    days = [r for r in rows() if r[1] is not None and r[0].startswith("u")]
    posts = spark.createDataFrame(days, SCHEMA)
    old = spark.createDataFrame([(f"o{i}", dt.date(2023, 11, 1 + i), "10:00", "c0", "car0", '["a"]', i, 1, 0) for i in range(20)], SCHEMA)
    kept = KeptSeries(spark, str(tmp_path))
    for batch, day in enumerate(("2024-01-10", "2024-01-15", "2024-01-20")):
        low = F.lit(["2023-01-01", "2024-01-10", "2024-01-15"][batch]).cast("date")
        kept.advance((posts if batch else posts.unionByName(old)).filter((F.col("upload_date") >= low) & (F.col("upload_date") < F.lit(day).cast("date"))), f"{day} 00:00", batch)
    assert kept.read_rows["recent"] + kept.read_rows["new"] < 0.5 * sum(r[5].count('"') // 2 for r in rows())
    # days of November lie in folders of their own, which later runs leave alone
    held = {folder: batch for (part, folder), batch in kept.store.manifest()[0].items() if part == "averages"}
    assert held.pop("span=616") == 2 and held and set(held.values()) == {0}


def test_an_unfinished_run_changes_nothing(spark, tmp_path):
    posts = spark.createDataFrame(rows(), SCHEMA)
    kept = KeptSeries(spark, str(tmp_path))
    kept.advance(posts.filter("wave = 0"), ASOFS[0], 0)
    before = as_dict(kept.series())

    class Lost(KeptSeries):
        def _renew_averages(self, *args):
            super()._renew_averages(*args)
            raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        Lost(spark, str(tmp_path)).advance(posts.filter("wave IN (1, 2)"), ASOFS[2], 1)
    assert as_dict(kept.series()) == before
    assert kept.advance(posts.filter("wave IN (1, 2)"), ASOFS[2], 1)
    assert as_dict(kept.series()) == as_dict(interest.interest_series(posts.filter("wave <= 2"), ASOFS[2]))


def test_nothing_and_no_labels(spark, tmp_path):
    kept = KeptSeries(spark, str(tmp_path))
    with pytest.raises(ValueError):
        kept.series()
    none = spark.createDataFrame([], SCHEMA)
    kept.advance(none, ASOFS[0], 0)
    assert kept.series().count() == 0
    kept.advance(spark.createDataFrame([("x", None, None, "c", "car", "[]", 1, 1, 0)], SCHEMA), ASOFS[1], 1)
    assert kept.series().count() == 0
