"""Groupings over posts, series and triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalpost.scale import list_in_parts, measured_join
from signalpost.session import cut

MEASURES = ("view", "like", "log_view", "log_like")


def bounds(df: DataFrame, group: str = "community") -> DataFrame:
    """Smallest and largest value of the four measures per group."""
    cols = {"view": "num_views", "like": "num_likes", "log_view": "log_views", "log_like": "log_likes"}
    aggregates = []
    for name, col in cols.items():
        aggregates += [F.min(col).alias(f"min_{name}"), F.max(col).alias(f"max_{name}")]
    return df.groupBy(group).agg(*aggregates)


def with_log(df: DataFrame) -> DataFrame:
    return df.withColumns({"log_views": F.log1p("num_views"), "log_likes": F.log1p("num_likes")})


def minmax(df: DataFrame, limits: DataFrame, group: str = "community") -> DataFrame:
    """Measures on a scale of 0 to 1 within their group; null where the group is constant.

    ``limits`` has one row per group.
    """
    cols = {"view": "num_views", "like": "num_likes", "log_view": "log_views", "log_like": "log_likes"}
    joined = measured_join(df, limits, [group], F.xxhash64(*df.columns))
    scaled = {f"normalized_{n}": F.try_divide(F.col(c) - F.col(f"min_{n}"), F.col(f"max_{n}") - F.col(f"min_{n}"))
              for n, c in cols.items()}
    return joined.withColumns(scaled).drop(*[f"{edge}_{n}" for n in cols for edge in ("min", "max")])


def daily_features(df: DataFrame) -> DataFrame:
    """Mean normalised log views and summed normalised log likes per (car, issue, day)."""
    return df.groupBy("car_name", "issue", "upload_date").agg(
        F.coalesce(F.avg(F.coalesce("normalized_log_view", F.lit(0.0))), F.lit(0.0)).alias("avg_log_view"),
        F.coalesce(F.sum(F.coalesce("normalized_log_like", F.lit(0.0))), F.lit(0.0)).alias("sum_log_like"))


def daily_features_in_one_pass(df: DataFrame) -> DataFrame:
    """The result of bounds, minmax and daily_features from a single pass over the posts.

    Min-max scaling is linear in the counter's logarithm, so posts are first summed per (car, issue,
    day, community) and that small table is stored.  Limits of a community come from it as well, and
    the scaling is applied to it.  The posts are read once and no row-level join is left.
    """
    cell = cut(df.groupBy("car_name", "issue", "upload_date", "community").agg(
        F.count("*").alias("n"),
        F.sum("log_views").alias("sv"), F.sum("log_likes").alias("sl"),
        F.count("log_views").alias("nv"), F.count("log_likes").alias("nl"),
        F.min("log_views").alias("min_v"), F.max("log_views").alias("max_v"),
        F.min("log_likes").alias("min_l"), F.max("log_likes").alias("max_l")))
    limits = cell.groupBy("community").agg(
        F.min("min_v").alias("low_v"), F.max("max_v").alias("high_v"),
        F.min("min_l").alias("low_l"), F.max("max_l").alias("high_l"))
    placed = cell.drop("min_v", "max_v", "min_l", "max_l").join(limits, "community")

    def scaled(total: str, count: str, low: str, high: str) -> Column:
        return F.coalesce(F.try_divide(F.col(total) - F.col(count) * F.col(low), F.col(high) - F.col(low)), F.lit(0.0))

    # A series is short, so one shuffle by series serves this grouping and the windows that follow.
    return placed.repartition("car_name", "issue").groupBy("car_name", "issue", "upload_date").agg(
        F.try_divide(F.sum(scaled("sv", "nv", "low_v", "high_v")), F.sum("n")).alias("avg_log_view"),
        F.sum(scaled("sl", "nl", "low_l", "high_l")).alias("sum_log_like"),
        F.sum("n").alias("n_posts"))


def trigger_urls(posts_at_triggers: DataFrame, limit: int = 10_000) -> DataFrame:
    """URL lists per trigger; a trigger with more than about ``limit`` posts has several parts.

    ``n_posts`` of the trigger day says how many parts are needed.
    """
    return list_in_parts(posts_at_triggers, ["car_name", "issue", "upload_date", "is_trigger"],
                         F.col("n_posts"), "url", limit)


def nest_series(df: DataFrame, keys: list[str], date: str = "upload_date", score: str = "score",
                out: str = "series") -> DataFrame:
    """Daily points of a key as a sorted array; its length is the number of days."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.struct(F.col(date).alias("upload_date"), F.col(score).alias("norm_graph_score")))).alias(out))


def nest_recommendations(ranked: DataFrame) -> DataFrame:
    """Ranked cases of a monitored series as one nested array in rank order."""
    entry = F.struct("rank", "recommend_car_name", "recommend_issue", "recommend_start_date",
                     "recommend_graph_score_list")
    grouped = ranked.groupBy("monitor_car_name", "monitor_issue").agg(F.sort_array(F.collect_list(entry)).alias("_r"))
    return grouped.select("monitor_car_name", "monitor_issue", F.transform("_r", lambda r: F.struct(
        r["recommend_car_name"].alias("recommend_car_name"), r["recommend_issue"].alias("recommend_issue"),
        r["recommend_start_date"].alias("recommend_start_date"),
        r["recommend_graph_score_list"].alias("recommend_graph_score_list"))).alias("recommend_json"))


def sums_and_means(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Sum and mean of every column, named ``<col>_sum`` and ``<col>_mean``."""
    aggregates = []
    for c in cols:
        aggregates += [F.sum(c).alias(f"{c}_sum"), F.avg(c).alias(f"{c}_mean")]
    return df.groupBy(*keys).agg(*aggregates)


def daily_counts(df: DataFrame, date: str, negative: str, keys: list[str] = ()) -> DataFrame:
    """Posts and negative words per day."""
    return df.groupBy(*keys, date).agg(F.count("*").alias("posts"), F.sum(negative).alias("negative_words"))


def term_days(df: DataFrame, date: str) -> DataFrame:
    """Weighted term counts per day."""
    return df.groupBy(date, "term").agg(F.sum("weight").alias("weight"))


def term_windows(df: DataFrame, date: str, today: str, short: int = 7, long: int = 365) -> DataFrame:
    """Weighted counts of a term in the last ``short`` and ``long`` days, in one pass."""
    end = F.to_date(F.lit(today))
    recent = df.filter((F.col(date) > F.date_sub(end, long)) & (F.col(date) <= end))
    return recent.groupBy("term").agg(
        F.coalesce(F.sum(F.when(F.col(date) > F.date_sub(end, short), F.col("weight"))), F.lit(0)).alias("short_count"),
        F.sum("weight").alias("long_count"))


def extremes(df: DataFrame, start: str, end: str, keys: list[str] = ()) -> DataFrame:
    """Earliest start and latest end."""
    return df.groupBy(*keys).agg(F.min(start).alias("first_start"), F.max(end).alias("last_end"))


def z_scores(df: DataFrame, col: str, out: str = "z", keys: list[str] = ()) -> DataFrame:
    """Distance from the mean in sample standard deviations, over the table or per key."""
    if keys:
        stats = df.groupBy(*keys).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd"))
        return df.join(stats, list(keys)).withColumn(
            out, F.try_divide(F.col(col) - F.col("_mean"), F.col("_sd"))).drop("_mean", "_sd")
    stats = df.agg(F.struct(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))).scalar()
    return df.withColumn(out, F.try_divide(F.col(col) - stats["mean"], stats["sd"]))


def today_summary(exploded: DataFrame, latest: DataFrame) -> DataFrame:
    """Posts, likes, views and mentions per (car, issue), with the latest trigger of the pair.

    Posts are summed before the trigger is attached, so several trigger days do not multiply them.
    ``exploded`` has one row per post and label, with a column ``mentions``.
    """
    totals = exploded.groupBy("car_name", "issue").agg(
        F.max("upload_date").alias("upload_date"),
        F.count("*").alias("num_posts"),
        F.sum("num_likes").alias("total_likes"),
        F.sum("num_views").alias("total_views"),
        (F.count("*") + F.coalesce(F.sum("mentions"), F.lit(0))).alias("issue_mentions"))
    return totals.join(latest, ["car_name", "issue"], "left")


def latest_trigger(triggers: DataFrame) -> DataFrame:
    """Latest trigger day per (car, issue) with its smallest URL."""
    return triggers.groupBy("car_name", "issue").agg(
        F.max("upload_date").alias("trigger_date"),
        F.min_by("url", F.struct(-F.unix_date("upload_date"), F.col("url"))).alias("issue_url"))
