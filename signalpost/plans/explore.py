"""Feature exploration over daily measures and ranking of curated cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.functions.series import scores, shift_series
from signalpost.operators import aggregates, windows
from signalpost.operators.similar import known_case_windows, rank_known_cases

MEASURES = ["num_views", "num_likes", "log_views", "log_likes", "normalized_view", "normalized_like",
            "normalized_log_view", "normalized_log_like"]


def daily_measures(posts: DataFrame, group: str = "community", keys: list[str] = ()) -> DataFrame:
    """Sum and mean per day of eight measures: counters, logarithms and their min-max scaling."""
    logged = aggregates.with_log(posts)
    scaled = aggregates.minmax(logged, aggregates.bounds(logged, group), group)
    return aggregates.sums_and_means(scaled, [*keys, "upload_date"], MEASURES)


def feature_triggers(daily: DataFrame, features: list[str], window: int = 10, k: float = 2.7, alpha: float = 0.05) -> DataFrame:
    """Every day filled, each feature smoothed, their product tested on both sides."""
    columns = [c for c in daily.columns if c != "upload_date"]
    filled = windows.date_spine(daily, [], "upload_date", columns)
    filled = windows.ema(filled, [], "upload_date", {f"ema_{c}": (c, alpha) for c in features})
    product = windows.score(filled, [f"ema_{c}" for c in features], "mul")
    return windows.detect_triggers(product, [], "upload_date", "mul", window, k, ddof=1, two_sided=True)


def rank_curated(cases: DataFrame, series: DataFrame, car: str, issue: str, asof: str, days: int = 90, k: int = 5) -> DataFrame:
    """Curated cases nearest to one monitored series, their series moved to the run date.

    A case starts at its first day within the months around its first news date.
    """
    end = F.to_date(F.lit(asof[:10]))
    around = aggregates.nest_series(known_case_windows(cases, series), ["car_name", "issue", "news_date"])
    mine = series.filter((F.col("car_name") == car) & (F.col("issue") == issue)
                         & F.col("upload_date").between(F.date_sub(end, days), end))
    query = aggregates.nest_series(mine, ["car_name", "issue"]).agg(F.first(scores(F.col("series")))).scalar()
    ranked = rank_known_cases(around, query, k)
    start = F.col("series")[0]["upload_date"]
    return ranked.withColumn("recommend_start_date", start).withColumn(
        "moved", shift_series(F.col("series"), F.datediff(end, start)))
