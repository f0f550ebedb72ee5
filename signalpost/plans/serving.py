"""Tables behind the dashboard: summary, chart data, hot list and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalpost.functions.series import shift_date
from signalpost.functions.text import mentions
from signalpost.functions.times import last_days
from signalpost.functions.values import first_url
from signalpost.operators.aggregates import latest_trigger, today_summary
from signalpost.plans.interest import explode_issues
from signalpost.scale import measured_join, name_matches, substrings

TODAY_DAYS, HOT_DAYS, ALERT_DAYS = 5, 10, 5
NAME_PART = 64
# Nested columns of the stored result table, as they are read from their JSON text.
POINTS = "array<struct<upload_date:date,norm_graph_score:double>>"
CASES = ("array<struct<recommend_car_name:string,recommend_issue:string,recommend_start_date:date,"
         "recommend_graph_score_list:array<struct<upload_date:string,norm_graph_score:double>>>>")


def recent_labels(posts: DataFrame, asof: str, days: int = TODAY_DAYS, limit: int | None = None) -> DataFrame:
    """Posts of the last days, one row per label; with ``limit`` the first labels of a post only."""
    return explode_issues(posts.filter(last_days(F.col("upload_date"), asof, days)), limit, "n")


def with_triggers(exploded: DataFrame, triggers: DataFrame) -> DataFrame:
    """Each label row with all trigger days of its (car, issue)."""
    right = triggers.select("car_name", "issue", F.col("upload_date").alias("trigger_date"))
    return measured_join(exploded, right, ["car_name", "issue"], F.col("url"), "left")


def summary(posts: DataFrame, triggers: DataFrame, asof: str) -> DataFrame:
    """Today summary per (car, issue).  ``posts`` has title and body, ``triggers`` one row per URL."""
    rows = recent_labels(posts, asof)
    rows = rows.withColumn("mentions", mentions(F.concat("title", "body"), F.col("issue")))
    return today_summary(rows, latest_trigger(triggers))


def case_news(cases: DataFrame, news: DataFrame, asof: str, days: int = 90) -> DataFrame:
    """News of a recommended case: same issue, up to ``days`` after its start, case car named in the news.

    Car names in the news are listed by their substrings and meet the first ``NAME_PART`` characters of the case
    car by equality, together with the issue and the date cell; the whole name is compared afterwards.
    """
    width = days + 1
    distinct_cases = cases.select("recommend_car_name", "recommend_issue", "recommend_start_date").distinct()
    cells = distinct_cases.withColumn("_part", F.substring("recommend_car_name", 1, NAME_PART)).withColumn("_from", F.unix_date("recommend_start_date")).withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_from") + days) / width))))
    named = news.select("url", "issue", "car_name", "upload_date").withColumn("_day", F.unix_date("upload_date"))
    named = named.withColumn("_cell", F.floor(F.col("_day") / width)).withColumn(
        "_part", F.explode(substrings(F.col("car_name"), NAME_PART)))
    left = named.withColumnsRenamed({"issue": "recommend_issue", "car_name": "news_car_name", "upload_date": "news_date"})
    joined = measured_join(left, cells, ["_part", "recommend_issue", "_cell"], F.col("url"))
    joined = joined.filter(F.contains("news_car_name", "recommend_car_name") & F.col("_day").between(F.col("_from"), F.col("_from") + days))
    return joined.select("recommend_car_name", "recommend_issue", "recommend_start_date", "url", "news_car_name", "news_date",
                         shift_date(asof, F.col("news_date"), F.col("recommend_start_date")).alias("chart_date"))


def aligned(monitored: DataFrame, recommended: DataFrame, k: int = 3) -> DataFrame:
    """Monitored series and its shifted cases side by side on all their dates, gaps null."""
    own = monitored.select(F.col("car_name").alias("monitor_car_name"), F.col("issue").alias("monitor_issue"),
                           F.lit("monitor").alias("line"), F.inline("series")).withColumn(
        "upload_date", F.col("upload_date").cast("string"))
    others = recommended.select("monitor_car_name", "monitor_issue", F.concat(F.lit("case"), F.col("rank")).alias("line"),
                                F.inline("recommend_graph_score_list"))
    lines = ["monitor", *[f"case{i}" for i in range(1, k + 1)]]
    return (own.unionByName(others).groupBy("monitor_car_name", "monitor_issue", "upload_date")
            .pivot("line", lines).agg(F.max("norm_graph_score")))


def lookup(df: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows whose car is equal and whose issue is equal in either case; ``requests`` has (car_name, issue)."""
    wanted = requests.select(F.col("car_name").alias("monitor_car_name"), F.upper("issue").alias("_issue")).distinct()
    return df.withColumn("_issue", F.upper("monitor_issue")).join(wanted, ["monitor_car_name", "_issue"], "left_semi").drop("_issue")


def trigger_link(triggers: DataFrame) -> DataFrame:
    """First URL of the newest trigger per (car, issue), over all parts of its list; ``url`` is a sorted list as JSON text."""
    age = F.datediff(F.lit("1970-01-01").cast("date"), F.col("upload_date").cast("date"))
    first = first_url(F.col("url"))
    newest = triggers.groupBy("car_name", "issue").agg(F.min(F.struct(age.alias("age"), first.isNull().alias("none"), first.alias("url"))).alias("newest"))
    return newest.select("car_name", "issue", F.col("newest.url").alias("url"))


def chart_cases(table: DataFrame) -> DataFrame:
    """Recommended cases in a stored result table by rank, with the label of their line in the chart."""
    rows = table.select("monitor_car_name", "monitor_issue", F.posexplode(F.from_json("recommend_json", CASES)).alias("_at", "_case"))
    rows = rows.select("monitor_car_name", "monitor_issue", (F.col("_at") + 1).alias("rank"), "_case.*")
    return rows.withColumn("label", F.concat("recommend_car_name", F.lit(" - "), "recommend_issue", F.lit(" ("),
                                             F.col("recommend_start_date").cast("string"), F.lit(")")))


def _links_of_charts(triggers: DataFrame) -> DataFrame:
    return trigger_link(triggers).select(F.col("car_name").alias("monitor_car_name"), F.col("issue").alias("monitor_issue"),
                                         F.col("url").alias("trigger_url"))


def chart_dataset(table: DataFrame, triggers: DataFrame, requests: DataFrame | None = None, k: int = 3) -> DataFrame:
    """Points of the charts: a stored result table side by side with its cases, and the link of the newest trigger.

    Without ``requests`` (see ``lookup``) every pair has a chart.
    """
    chosen = table if requests is None else lookup(table, requests)
    own = chosen.select(F.col("monitor_car_name").alias("car_name"), F.col("monitor_issue").alias("issue"),
                        F.from_json("monitor_graph_score_list", POINTS).alias("series"))
    return aligned(own, chart_cases(chosen), k).join(_links_of_charts(triggers), ["monitor_car_name", "monitor_issue"], "left")


def chart_heads(table: DataFrame, triggers: DataFrame, today: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """One row per chart: labels of its cases by rank, today's summary of the pair (null without posts) and the link."""
    chosen = table if requests is None else lookup(table, requests)
    labels = chart_cases(chosen).groupBy("monitor_car_name", "monitor_issue").agg(
        F.array_sort(F.collect_list(F.struct("rank", "label")))["label"].alias("labels"))  # k cases at most
    row = today.withColumnsRenamed({"car_name": "monitor_car_name", "issue": "monitor_issue"})
    keys = ["monitor_car_name", "monitor_issue"]
    return (chosen.select(*keys).join(labels, keys, "left").join(row, keys, "left")
            .join(_links_of_charts(triggers), keys, "left"))


def chart_news(cases: DataFrame, news: DataFrame, asof: str) -> DataFrame:
    """Vertical lines of the charts: news of each case by date and label, with their number."""
    keys = ["recommend_car_name", "recommend_issue", "recommend_start_date"]
    label = F.concat(F.lit("news: "), "news_car_name", F.lit(" - "), "recommend_issue")
    lines = case_news(cases, news, asof).groupBy(*keys, "chart_date", label.alias("label")).agg(F.count("*").alias("news"))
    return cases.select("monitor_car_name", "monitor_issue", "rank", *keys).join(lines, keys).select(
        "monitor_car_name", "monitor_issue", "rank", "chart_date", "label", "news")


def hot_list(triggers: DataFrame, asof: str, days: int = HOT_DAYS) -> DataFrame:
    """Lines for the hot list."""
    recent = triggers.filter(last_days(F.col("upload_date"), asof, days)).select("car_name", "issue", "upload_date").distinct()
    return recent.withColumn("line", F.format_string("%s - %s\n(%s)", "car_name", "issue", F.col("upload_date").cast("string")))


def tracked_news(news: DataFrame, tracked: DataFrame, asof: str, days: int = ALERT_DAYS) -> DataFrame:
    """Recent news that name a tracked car, each once.  ``tracked`` has a column ``tracked_name``."""
    recent = news.filter(last_days(F.col("upload_date"), asof, days))
    named = name_matches(recent, "car_name", tracked, "tracked_name").select("car_name").distinct()
    return measured_join(recent, named, ["car_name"], F.col("url"), "left_semi")


def trigger_line(link: str) -> Column:
    """Alert line of a trigger with a link to its chart."""
    return F.concat(F.format_string("%s - %s\n", "car_name", "issue"), F.lit(link),
                    F.format_string("car_name=%s&issue=%s", "car_name", "issue"))


# Fixed value: the labels of a news alert.
NEWS_LINE = "차량명: %s\n이슈: %s\n제목: %s\n요약: %s\nurl: %s"


def news_line() -> Column:
    return F.format_string(NEWS_LINE, "car_name", "issue", "title", "summary", "url")


def render_alerts(df: DataFrame, line: Column, kind: str, asof: str, order: list[str], per_message: int = 200) -> DataFrame:
    """Messages with subject and text.

    The entries are dealt into messages of about ``per_message`` lines by a hash, so a long list gives
    several messages instead of one that has to fit into a task.
    """
    total = df.agg(F.count("*")).scalar()
    parts = F.greatest(F.ceil(total / F.lit(per_message)), F.lit(1)).cast("bigint")
    rows = df.withColumn("_line", line).withColumn("message", F.pmod(F.xxhash64(*order), parts))
    grouped = rows.groupBy("message").agg(
        F.count("*").alias("entries"),
        F.sort_array(F.collect_list(F.struct(*order, "_line"))).alias("_lines"))
    body = F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n\n")
    return grouped.select("message", "entries", F.lit(f"{asof} {kind}").alias("subject"),
                          F.concat(F.format_string("%d entries\n\n", "entries"), body).alias("text"))


def trigger_alerts(triggers: DataFrame, link: str, asof: str, days: int = ALERT_DAYS, per_message: int = 200) -> DataFrame:
    """Messages about the triggers of the last days; a day of a (car, issue) is told once."""
    recent = triggers.filter(last_days(F.col("upload_date"), asof, days)).select("car_name", "issue", "upload_date").distinct()
    return render_alerts(recent, trigger_line(link), "triggers", asof, ["car_name", "issue", "upload_date"], per_message)
