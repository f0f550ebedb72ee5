"""Daily totals of a stream of labelled posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_totals(stream: DataFrame, ts: str = "ts", delay: str = "48 hours") -> DataFrame:
    """Posts, views and likes per (car, issue, day), given once the day is closed by the watermark."""
    return (stream.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("_w"), "car_name", "issue")
            .agg(F.count("*").alias("posts"), F.sum("num_views").alias("views"), F.sum("num_likes").alias("likes"))
            .select("car_name", "issue", F.to_date("_w.start").alias("upload_date"), "posts", "views", "likes"))


def daily_feature_stream(stream: DataFrame, limits: DataFrame, ts: str = "ts", delay: str = "48 hours") -> DataFrame:
    """Daily features of a stream scaled by a stored snapshot of the community bounds."""
    from signalpost.operators.aggregates import minmax, with_log
    scaled = minmax(with_log(stream), limits)
    return (scaled.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("_w"), "car_name", "issue")
            .agg(F.coalesce(F.avg(F.coalesce("normalized_log_view", F.lit(0.0))), F.lit(0.0)).alias("avg_log_view"),
                 F.coalesce(F.sum(F.coalesce("normalized_log_like", F.lit(0.0))), F.lit(0.0)).alias("sum_log_like"))
            .select("car_name", "issue", F.to_date("_w.start").alias("upload_date"), "avg_log_view", "sum_log_like"))
