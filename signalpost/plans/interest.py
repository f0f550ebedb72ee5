"""Interest series, trigger report and similar past cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.functions.series import scores, scores_until, shift_series
from signalpost.functions.times import boost, compose_ts, last_days
from signalpost.functions.values import has_label, labels
from signalpost.operators import aggregates, windows
from signalpost.operators.similar import case_windows, nearest_cases
from signalpost.operators.tables import attach_urls
from signalpost.session import cut

SERIES = ["car_name", "issue"]


def boost_recent(df: DataFrame, asof: str, hours: int = 48) -> DataFrame:
    """Posts with the counters of recent ones raised; one projection, no self-join."""
    posted = compose_ts(F.col("upload_date"), F.col("upload_time"))
    return df.withColumns({c: boost(F.col(c), posted, F.col("upload_date"), asof, hours) for c in ("num_views", "num_likes")})


def explode_issues(df: DataFrame, limit: int | None = None, position: str | None = None) -> DataFrame:
    """One row per label; with ``limit`` the first labels only, ``position`` names their index."""
    kept = [c for c in df.columns if c != "issue"]
    found = labels(F.col("issue"))
    found = F.slice(found, 1, limit) if limit else found
    if position:
        return df.select(*kept, F.posexplode(found).alias(position, "issue"))
    return df.select(*kept, F.explode(found).alias("issue"))


def labelled_posts(posts: DataFrame, asof: str) -> DataFrame:
    """Posts with labels, boosted, one row per label, with logarithms."""
    needed = posts.select("url", "upload_date", "upload_time", "community", "car_name", "issue", "num_views", "num_likes")
    return aggregates.with_log(explode_issues(boost_recent(needed.filter(has_label(F.col("issue"))), asof)))


def interest_series(posts: DataFrame, asof: str, alpha: float = 0.05, beta: float = 0.02) -> DataFrame:
    """Daily interest score per (car, issue)."""
    daily = aggregates.daily_features_in_one_pass(labelled_posts(posts, asof))
    smooth = windows.ema(daily, SERIES, "upload_date", {"ema_view": ("avg_log_view", alpha), "ema_like": ("sum_log_like", beta)})
    return windows.score(smooth, ["ema_view", "ema_like"]).select(*SERIES, "upload_date", "score", "n_posts")


def recent_triggers(series: DataFrame, asof: str, days: int = 90, k: float = 2.1, cut_before_detect: bool = True) -> DataFrame:
    """Triggers of the last days.  With ``cut_before_detect`` windows start inside those days as well."""
    recent = last_days(F.col("upload_date"), asof, days, closed=True)
    table = series.filter(recent) if cut_before_detect else series
    hits = windows.detect_triggers(table, SERIES, "upload_date", "score", k=k)
    return hits.filter(recent).withColumn("is_trigger", F.lit(True))


def trigger_report(posts: DataFrame, asof: str, list_limit: int = 10_000, k: float = 2.1,
                   series: DataFrame | None = None) -> DataFrame:
    """Triggers of the last 90 days with the URLs of their posts; a stored interest series may be given."""
    series = interest_series(posts, asof) if series is None else series
    triggers = recent_triggers(series, asof, k=k).select(*SERIES, "upload_date", "is_trigger", "n_posts")
    recent = posts.filter(last_days(F.col("upload_date"), asof, 90, closed=True))  # triggers lie in these days
    exploded = explode_issues(recent.select("car_name", "issue", "upload_date", "url").filter(has_label(F.col("issue"))))
    return aggregates.trigger_urls(attach_urls(exploded, triggers), list_limit)


def all_triggers(series: DataFrame, k: float = 2.1) -> DataFrame:
    hits = windows.detect_triggers(series, SERIES, "upload_date", "score", k=k)
    return hits.select(*SERIES, F.col("upload_date").alias("trigger_date"))


def monitored_series(series: DataFrame, asof: str, days: int = 90) -> DataFrame:
    recent = series.filter(last_days(F.col("upload_date"), asof, days, closed=True))
    return aggregates.nest_series(recent, SERIES)


def past_cases(series: DataFrame, days: int = 90, k: float = 2.1) -> DataFrame:
    """Every trigger with the nested series around it."""
    return aggregates.nest_series(case_windows(all_triggers(series, k), series, days), [*SERIES, "trigger_date"])


def ranked_cases(monitored: DataFrame, cases: DataFrame, k: int = 3) -> DataFrame:
    """Nearest cases per monitored series.  Only the part of a case up to its trigger is compared."""
    left = monitored.select(*SERIES, scores(F.col("series")).alias("monitor_scores"))
    right = cases.select(F.col("car_name").alias("case_car"), F.col("issue").alias("case_issue"), "trigger_date",
                         scores_until(F.col("series"), F.col("trigger_date")).alias("case_scores"))
    return nearest_cases(left, right, k)


def similar_cases_of(series: DataFrame, asof: str, k: int = 3) -> DataFrame:
    """Flat recommendations from a stored interest series: rank, distance, case series moved to the run date."""
    monitored, cases = cut(monitored_series(series, asof)), cut(past_cases(series))
    ranked = ranked_cases(monitored, cases, k)
    days = F.datediff(F.to_date(F.lit(asof[:10])), F.col("recommend_start_date"))
    chosen = ranked.select(F.col("car_name").alias("monitor_car_name"), F.col("issue").alias("monitor_issue"), "rank",
                           "distance", F.col("case_car").alias("recommend_car_name"),
                           F.col("case_issue").alias("recommend_issue"),
                           F.col("trigger_date").alias("recommend_start_date"))
    details = cases.select(F.col("car_name").alias("recommend_car_name"), F.col("issue").alias("recommend_issue"),
                           F.col("trigger_date").alias("recommend_start_date"), F.col("series").alias("_series"))
    joined = chosen.join(details, ["recommend_car_name", "recommend_issue", "recommend_start_date"])
    return joined.withColumn("recommend_graph_score_list", shift_series(F.col("_series"), days)).drop("_series")


def similar_cases(posts: DataFrame, asof: str, k: int = 3) -> DataFrame:
    return similar_cases_of(cut(interest_series(posts, asof)), asof, k)


def recommendation_table(series: DataFrame, recommended: DataFrame, asof: str) -> DataFrame:
    """Result table of the scoring job: one row per monitored series, nested values as JSON text."""
    monitored = monitored_series(series, asof).select(
        F.col("car_name").alias("monitor_car_name"), F.col("issue").alias("monitor_issue"),
        F.col("series").alias("monitor_graph_score_list"))
    nested = aggregates.nest_recommendations(recommended)
    return monitored.join(nested, ["monitor_car_name", "monitor_issue"]).select(
        "monitor_car_name", "monitor_issue", F.to_json("monitor_graph_score_list").alias("monitor_graph_score_list"),
        F.to_json("recommend_json").alias("recommend_json"))
