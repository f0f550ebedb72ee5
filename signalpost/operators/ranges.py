"""Splitting time ranges for the crawl grid.  Requests are a table, one row per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_range(requests: DataFrame, asof: Column, hours: Column, parts: Column, zone_hours: int = 9) -> DataFrame:
    """Cut the last ``hours`` into ``parts`` ranges, newest first.

    The first ``hours mod parts`` ranges are one hour longer.  Ranges end a minute before the next
    one starts and are anchored at the full hour in the zone.
    """
    base, extra = F.floor(hours / parts), hours % parts
    anchor = F.date_trunc("hour", F.timestamp_seconds(F.unix_timestamp(asof) + zone_hours * 3600))
    out = requests.filter((hours > 0) & (parts > 0)).withColumns({"_anchor": anchor, "_base": base, "_extra": extra})
    out = out.withColumn("part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    length = F.col("_base") + F.when(F.col("part") < F.col("_extra"), 1).otherwise(0)
    ago = (F.col("part") + 1) * F.col("_base") + F.least(F.col("part") + 1, F.col("_extra"))
    out = out.withColumn("_start", F.unix_timestamp("_anchor") - ago * 3600)
    return out.withColumns({
        "start_datetime": F.timestamp_seconds("_start"),
        "end_datetime": F.timestamp_seconds(F.col("_start") + length * 3600 - 60),
    }).drop("_anchor", "_base", "_extra", "_start")


def split_months(requests: DataFrame, start: Column, end: Column) -> DataFrame:
    """Cut [start, end] at month borders: inner parts run from the first 00:00 to the last day 23:59."""
    out = requests.filter(start <= end).withColumns({"_a": start, "_b": end})
    out = out.withColumn("_m", F.explode(F.sequence(
        F.trunc("_a", "MM"), F.trunc("_b", "MM"), F.expr("interval 1 month"))))
    month_end = F.timestamp_seconds(F.unix_timestamp(F.date_add(F.last_day("_m"), 1).cast("timestamp")) - 60)
    return out.withColumns({
        "start_datetime": F.greatest(F.col("_a"), F.col("_m").cast("timestamp")),
        "end_datetime": F.least(F.col("_b"), month_end),
    }).drop("_a", "_b", "_m")
