"""Stored tables with a key index and commits."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from signalpost.operators import commits

SCHEMA = "url string, upload_date date, title string, num_views bigint"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def state(table):
    found = [tuple(r) for r in table.read().collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


def test_upserts_equal_a_dictionary(spark, tmp_path):
    local = random.Random(2)
    table, want = commits.KeyedTable(spark, str(tmp_path), SCHEMA, ["url"], "upload_date", buckets=16), {}
    for batch in range(4):
        keys = local.sample(range(60), 25)
        rows = [(f"u{k}", None if k % 13 == 0 else day(local.randint(0, 6)), f"t{batch}", local.randint(0, 99)) for k in keys]
        cols = None if batch % 2 else ["num_views"]
        assert table.upsert(spark.createDataFrame([*rows, (None, day(0), "no key", 1)], SCHEMA), batch, cols)
        for url, *rest in rows:
            want[url] = tuple(rest) if cols is None or url not in want else (*want[url][:2], rest[2])
        assert state(table) == want
    assert not table.upsert(spark.createDataFrame([("u1", day(0), "again", 1)], SCHEMA), 3) and state(table) == want
    assert table.store.vacuum() > 0 and state(table) == want


def test_only_buckets_and_days_of_the_new_keys_are_read(spark, tmp_path):
    table = commits.KeyedTable(spark, str(tmp_path), SCHEMA, ["url"], "upload_date", buckets=32)
    table.upsert(spark.createDataFrame([(f"u{i}", day(i % 20), "t", i) for i in range(400)], SCHEMA), 0)
    assert len(table.store.folders(table.store.manifest()[0], "index")) == 32
    table.upsert(spark.createDataFrame([("u5", day(5), "new", 9), ("fresh", day(19), "new", 9)], SCHEMA), 1)
    read = [p.split("/")[-1] for p in table.read_folders]
    assert sorted(p for p in read if p.startswith("day")) == ["day=2024-01-06", "day=2024-01-20"]
    assert len([p for p in read if p.startswith("bucket")]) <= 2
    manifest = table.store.manifest()[0]
    assert sum(b == 1 for (part, _), b in manifest.items() if part == "rows") == 2
    table.upsert(spark.createDataFrame([("u5", day(7), "moved", 1)], SCHEMA), 2)
    assert state(table)["u5"] == (day(7), "moved", 1) and len(state(table)) == 401
    only = commits.KeyedTable(spark, f"{tmp_path}/one", SCHEMA, ["url"], "upload_date")
    only.upsert(spark.createDataFrame([("a", day(1), "t", 1)], SCHEMA), 0)
    only.upsert(spark.createDataFrame([("a", day(2), "t", 1)], SCHEMA), 1)
    assert [f for p, f in only.store.manifest()[0] if p == "rows"] == ["day=2024-01-03"]  # the emptied day is gone


@pytest.mark.parametrize("part", ["rows", "index"])
def test_a_driver_lost_between_two_folders_changes_nothing(spark, tmp_path, monkeypatch, part):
    table = commits.KeyedTable(spark, str(tmp_path), SCHEMA, ["url"], "upload_date", buckets=4)
    table.upsert(spark.createDataFrame([(f"u{i}", day(i % 3), "t", i) for i in range(30)], SCHEMA), 0)
    before = state(table)
    write = commits.Committed.write

    def lost(self, rows, name, batch, by=None):
        write(self, rows, name, batch, by)
        if name == part:
            raise RuntimeError("driver lost")

    monkeypatch.setattr(commits.Committed, "write", lost)
    change = spark.createDataFrame([("u1", day(2), "moved", 5), ("x", day(9), "new", 5)], SCHEMA)
    with pytest.raises(RuntimeError):
        table.upsert(change, 1)
    assert state(table) == before
    monkeypatch.setattr(commits.Committed, "write", write)
    assert table.upsert(change, 1)
    assert state(table) == {**before, "u1": (day(2), "moved", 5), "x": (day(9), "new", 5)}


def test_empty_batches(spark, tmp_path):
    table = commits.KeyedTable(spark, str(tmp_path), SCHEMA, ["url"], "upload_date")
    none = spark.createDataFrame([], SCHEMA)
    assert table.upsert(none, 0) and table.read().count() == 0 and not table.upsert(none, 0)
    assert table.upsert(spark.createDataFrame([("a", None, None, None)], SCHEMA).withColumn("more", F.lit(1)), 1)
    assert state(table) == {"a": (None, None, None)}
