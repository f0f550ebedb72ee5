"""Interest series kept between runs: a run reads the posts that are new, not the posts of all time.

Three facts make the daily scores of ``interest.interest_series`` incremental.

* Only days inside the boost window depend on the run time.  Posts of these days are kept as they are; once a day has left the window
  its posts are summed into cells per (day, car, issue, community), which merge with what arrives late.
* Scaling by the bounds of a community is linear.  Cells and averages are kept unscaled, per community, with the sums of the logarithms and
  their counts side by side; bounds that move change the last step alone, not what is stored.
* The averages are linear too, so an average goes on from its last stored value: only days from the first changed one are computed again, and
  only for series that changed.

Every run is one commit (``operators.commits``); cells and averages are kept in folders of 32 days.  A run that ends halfway has
changed nothing, and a batch is not taken twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalpost.functions.times import boost, compose_ts, run_time
from signalpost.functions.values import has_label
from signalpost.operators import aggregates, windows
from signalpost.operators.commits import Committed
from signalpost.plans.interest import SERIES, explode_issues
from signalpost.scale import is_small
from signalpost.session import cut

CELL = ["car_name", "issue", "community"]
SUMS = ("sv", "nv", "sl", "nl")
RECENT = ("upload_date date, upload_time string, community string, car_name string, issue string, num_views bigint, num_likes bigint")
CELLS = "day_no int, car_name string, issue string, community string, n bigint, sv double, nv bigint, sl double, nl bigint"
LIMITS = "community string, low_v double, high_v double, low_l double, high_l double"
# Averages of a series' community at one day, before scaling, and the posts of the series that day.
AVERAGES = "day_no int, car_name string, issue string, community string, n_posts bigint, a_sv double, a_nv double, b_sl double, b_nl double"
# Place of posts without a date, before all days; days of one stored folder.
NO_DAY, SPAN = -(1 << 31), 32


def _day_no(date: Column) -> Column:
    return F.coalesce(F.unix_date(date), F.lit(NO_DAY))


def _span(day_no: Column) -> Column:
    return F.floor(day_no / SPAN).cast("int")


def _spans(rows: DataFrame) -> list[int]:
    """Spans of the calendar that hold some rows."""
    return [r[0] for r in rows.select(_span(F.col("day_no"))).distinct().collect()]


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join where missing keys meet; the keys of the left side stay."""
    renamed = right.select(*[F.col(c).alias(f"_key_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_key_{k}" for k in keys])


class KeptSeries:
    """Stored state of the interest series below ``root``."""

    def __init__(self, spark: SparkSession, root: str, hours: int = 48, alpha: float = 0.05, beta: float = 0.02):
        self.store, self.hours, self.alpha, self.beta = Committed(spark, root), hours, alpha, beta
        self.read_rows: dict[str, int] = {}  # rows the last run has read, by table

    # --- stored parts

    def _days(self, part: str, schema: str, manifest: dict, first: int | None = None, last: int | None = None, spans: list[int] | None = None) -> DataFrame:
        """Stored days of a part, from ``first`` to below ``last``, or of some spans; only the folders of these are read."""
        def keep(folder: str) -> bool:
            span = int(folder.split("=")[1])
            return (first is None or span >= first // SPAN) and (last is None or span <= (last - 1) // SPAN) and (spans is None or span in spans)

        rows = self.store.read(manifest, part, schema, keep)
        rows = rows if first is None else rows.filter(F.col("day_no") >= first)
        return rows if last is None else rows.filter(F.col("day_no") < last)

    def _write_days(self, rows: DataFrame, part: str, batch: int) -> None:
        self.store.write(rows.withColumn("span", _span(F.col("day_no"))), part, batch, "span")

    # --- cells and averages

    def _recent(self, asof: str) -> Column:
        """Inside the boost window, as ``times.boost`` has it."""
        begin = F.timestamp_seconds(F.unix_timestamp(run_time(asof)) - self.hours * 3600)
        return F.coalesce(F.col("upload_date").cast("timestamp") >= begin, F.lit(False))

    def _cells(self, rows: DataFrame) -> DataFrame:
        logs = aggregates.with_log(rows.withColumn("day_no", _day_no(F.col("upload_date"))))
        return logs.groupBy("day_no", *CELL).agg(
            F.count("*").alias("n"), F.coalesce(F.sum("log_views"), F.lit(0.0)).alias("sv"), F.count("log_views").alias("nv"),
            F.coalesce(F.sum("log_likes"), F.lit(0.0)).alias("sl"), F.count("log_likes").alias("nl"),
            F.min("log_views").alias("low_v"), F.max("log_views").alias("high_v"), F.min("log_likes").alias("low_l"), F.max("log_likes").alias("high_l"))

    @staticmethod
    def _limits(*tables: DataFrame) -> DataFrame:
        both = tables[0].select("community", "low_v", "high_v", "low_l", "high_l")
        for more in tables[1:]:
            both = both.unionByName(more.select(*both.columns))
        return both.groupBy("community").agg(*[F.min(c).alias(c) if c.startswith("low") else F.max(c).alias(c) for c in both.columns[1:]])

    def _averages(self, cells: DataFrame, seeds: DataFrame) -> DataFrame:
        """Averages of every day of ``cells``, for each community its series has had so far, going on from ``seeds``.

        ``seeds`` has the averages of a series' last day before these, if there was one.  A day without posts of a community counts 0 for it.
        """
        days = cells.groupBy(*SERIES, "day_no").agg(F.sum("n").alias("n_posts"))
        before = seeds.groupBy(*SERIES).agg(F.max("day_no").alias("day_no"), F.lit(None).cast("bigint").alias("n_posts"))
        communities = cells.select(*CELL).unionByName(seeds.select(*CELL)).distinct()
        grid = _same(days.unionByName(before.select(*days.columns)), communities, SERIES, "inner")
        values = cells.select("day_no", *CELL, *SUMS).unionByName(seeds.select(
            "day_no", *CELL, F.col("a_sv").alias("sv"), F.col("a_nv").cast("double").alias("nv"), F.col("b_sl").alias("sl"), F.col("b_nl").alias("nl")))
        filled = _same(grid, values, ["day_no", *CELL], "left").na.fill(0.0, list(SUMS))
        # The first row of a series counts in full: it is its first day, or the state it goes on from.
        share = F.coalesce(F.col("n_posts"), F.lit(1))
        ready = filled.withColumns({"x_sv": F.col("sv") / share, "x_nv": F.col("nv") / share, "sl": F.col("sl").cast("double"), "nl": F.col("nl").cast("double")})
        smooth = windows.ema(ready, CELL, "day_no", {"a_sv": ("x_sv", self.alpha), "a_nv": ("x_nv", self.alpha), "b_sl": ("sl", self.beta), "b_nl": ("nl", self.beta)})
        return smooth.filter("n_posts IS NOT NULL").selectExpr(*[c.split()[0] for c in AVERAGES.split(", ")])

    # --- one run

    def advance(self, posts: DataFrame, asof: str, batch: int) -> bool:
        """Take new posts at a run time that does not go back; False if the batch was taken before.

        ``posts`` holds new posts alone (columns of ``schemas.POST``); each post is given once.  Posts may be late by any time.
        """
        if batch in self.store.batches():
            return False
        manifest, before = self.store.manifest()
        if before > asof[:16]:
            raise ValueError(f"run time {asof} lies before that of a batch taken")
        fresh = explode_issues(posts.select("upload_date", "upload_time", "community", "car_name", "issue", "num_views", "num_likes")
                               .filter(has_label(F.col("issue")) & F.col("community").isNotNull()))
        fresh = fresh.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in RECENT.split(", ")])
        pool = cut(self.store.read(manifest, "recent", RECENT).withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True))))
        sizes = {r["_new"]: r["count"] for r in pool.groupBy("_new").count().collect()}
        self.read_rows = {"new": sizes.get(True, 0), "recent": sizes.get(False, 0), "cells": 0}
        pool = pool.drop("_new")
        self.store.write(pool.filter(self._recent(asof)), "recent", batch)

        delta = cut(self._cells(pool.filter(~self._recent(asof))))
        changed = _spans(delta)
        after = dict(manifest)
        if changed:
            held = self._days("cells", CELLS, manifest, spans=changed)
            merged = held.unionByName(delta.select(*held.columns)).groupBy("day_no", *CELL).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in SUMS])
            self._write_days(merged.selectExpr(*held.columns), "cells", batch)
            after |= {("cells", f"span={s}"): batch for s in changed}
            after |= {("averages", f"span={s}"): batch for s in self._renew_averages(delta, after, manifest, batch)}
            self.store.write(self._limits(self.store.read(manifest, "limits", LIMITS), delta), "limits", batch)
            after |= {("limits", ""): batch, ("last", ""): batch}
        self.store.commit(after | {("recent", ""): batch}, batch, asof[:16])
        return True

    def _renew_averages(self, delta: DataFrame, after: dict, manifest: dict, batch: int) -> list[int]:
        """Averages of the changed series from their first changed day on; returns the spans that were written."""
        last = self.store.read(manifest, "last", AVERAGES)
        ends = last.groupBy(*SERIES).agg(F.max("day_no").alias("end"))
        firsts = cut(_same(delta.groupBy(*SERIES).agg(F.min("day_no").alias("first")), ends, SERIES, "left"))
        begin = firsts.agg(F.min("first")).first()[0]
        in_order = F.col("end").isNull() | (F.col("end") < F.col("first"))
        seeds = _same(last, firsts.filter(in_order), SERIES, "left_semi")
        late = firsts.filter(~in_order)
        if not late.isEmpty():  # posts for days that were already averaged: the state before them is looked up in the stored days
            newest = late.agg(F.max("first")).first()[0]
            older = _same(self._days("averages", AVERAGES, manifest, last=newest), late, SERIES, "inner").filter(F.col("day_no") < F.col("first"))
            latest = older.groupBy(*SERIES).agg(F.max("day_no").alias("_latest"))
            seeds = seeds.unionByName(_same(older, latest, SERIES, "inner").filter(F.col("day_no") == F.col("_latest")).select(*last.columns))
        cells = _same(self._days("cells", CELLS, after, first=begin), firsts, SERIES, "inner").filter(F.col("day_no") >= F.col("first"))
        cells = cut(cells.select(*[c.split()[0] for c in CELLS.split(", ")]))
        renewed = cut(self._averages(cells, seeds))
        spans = _spans(renewed)
        held = self._days("averages", AVERAGES, manifest, spans=spans)
        keep = _same(held, firsts.withColumnRenamed("end", "_end"), SERIES, "left").filter(F.col("first").isNull() | (F.col("day_no") < F.col("first")))
        self._write_days(keep.select(*renewed.columns).unionByName(renewed), "averages", batch)
        ended = _same(renewed, renewed.groupBy(*SERIES).agg(F.max("day_no").alias("_end")), SERIES, "inner").filter(F.col("day_no") == F.col("_end")).drop("_end")
        self.store.write(_same(last, firsts, SERIES, "left_anti").unionByName(ended), "last", batch)
        self.read_rows["cells"] = cells.count()
        return spans

    # --- result

    def series(self) -> DataFrame:
        """Daily interest score per (car, issue), as ``interest.interest_series`` gives it for all posts and the last run time."""
        manifest, asof = self.store.manifest()
        if not manifest:
            raise ValueError("no batch has been taken")
        posted = compose_ts(F.col("upload_date"), F.col("upload_time"))
        recent = self.store.read(manifest, "recent", RECENT)
        boosted = recent.withColumns({c: boost(F.col(c), posted, F.col("upload_date"), asof, self.hours) for c in ("num_views", "num_likes")})
        cells = cut(self._cells(boosted))
        seeds = _same(self.store.read(manifest, "last", AVERAGES), cells, SERIES, "left_semi")
        averages = self._days("averages", AVERAGES, manifest).unionByName(self._averages(cells, seeds))
        limits = cut(self._limits(self.store.read(manifest, "limits", LIMITS), cells))
        placed = averages.join(F.broadcast(limits) if is_small(limits) else limits, "community")

        def scaled(total: str, count: str, low: str, high: str) -> Column:
            return F.coalesce(F.try_divide(F.col(total) - F.col(count) * F.col(low), F.col(high) - F.col(low)), F.lit(0.0))

        daily = placed.groupBy(*SERIES, "day_no").agg(
            F.sum(scaled("a_sv", "a_nv", "low_v", "high_v")).alias("ema_view"), F.sum(scaled("b_sl", "b_nl", "low_l", "high_l")).alias("ema_like"),
            F.max("n_posts").alias("n_posts"))
        dated = daily.withColumn("upload_date", F.when(F.col("day_no") > NO_DAY, F.date_from_unix_date("day_no")))
        return windows.score(dated, ["ema_view", "ema_like"]).select(*SERIES, "upload_date", "score", "n_posts")
