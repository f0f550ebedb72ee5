"""Sorts, limits, set operations, and the functions that take the place of UDFs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import ASOF, query
from catalog.queries_b import WIDE, _wide_labels
from catalog.queries_c import TODAY, stop_words
from signalpost.functions import series as S
from signalpost.functions import text, times, values
from signalpost.functions.dtw import dtw
from signalpost.operators import aggregates, windows
from signalpost.plans import ingest, interest, keywords

KEYS = ["car_name", "issue"]


@query("f01_sorted_series", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, n_posts FROM long_series""", "long_series")
def f01(spark, sf):
    return V.long_series(spark, sf).orderBy(*KEYS, "upload_date").drop("score")


@query("f02_sorted_posts", """SELECT "Date" AS day, "Time" AS posted, "Url" AS url FROM raw_posts""", "raw_posts")
def f02(spark, sf):
    return V.raw_posts(spark, sf).select(F.col("Date").alias("day"), F.col("Time").alias("posted"), F.col("Url").alias("url")).orderBy(
        "day", "posted", "url")


@query("f03_triggers_newest_first", """SELECT CAST(trigger_date AS VARCHAR) AS trigger_date, car_name, issue FROM long_triggers""", "long_triggers")
def f03(spark, sf):
    return interest.all_triggers(V.long_series(spark, sf)).orderBy(F.desc("trigger_date"), *KEYS)


@query("f04_top_terms", "SELECT term, short_count, long_count FROM rising ORDER BY poisson_score, term LIMIT 30", "rising")
def f04(spark, sf):
    return keywords.rising_keywords(V.doc_posts(spark, sf), stop_words(spark), TODAY).select("term", "short_count", "long_count")


@query("f05_union_by_name", """SELECT url, CAST(upload_date AS VARCHAR) AS upload_date, car_name, num_views FROM posts
  UNION ALL SELECT url, CAST(upload_date AS VARCHAR), car_name, NULL FROM long_posts""", "posts", "long_posts")
def f05(spark, sf):
    one = V.posts(spark, sf).select("url", "upload_date", "car_name", "num_views")
    return one.unionByName(V.long_posts(spark, sf).select("car_name", "url", "upload_date"), allowMissingColumns=True)


@query("f06_label_positions", f"SELECT n, count(*) AS labels, count(DISTINCT issue) AS kinds FROM ({WIDE}) GROUP BY n")
def f06(spark, sf):
    return interest.explode_issues(_wide_labels(spark, sf), 5, "n").groupBy("n").agg(
        F.count("*").alias("labels"), F.countDistinct("issue").alias("kinds"))


@query("g01_interpolation", """SELECT url, round(CASE WHEN upload_date >= DATE '2001-07-31' - 2
    THEN num_views * (pow(1.2, -((DATE '2001-07-31' - upload_date) * 24 - 12)) * 3 + 1) ELSE num_views END, 4) AS num_views FROM long_posts
  """, "long_posts", digits=4)
def g01(spark, sf):
    p = V.long_posts(spark, sf)
    posted = times.compose_ts(F.col("upload_date"), F.col("upload_time"))
    return p.select("url", times.boost(F.col("num_views"), posted, F.col("upload_date"), "2001-07-31 00:00").alias("num_views"))


@query("g02_warping_distance", f"""SELECT car_name, issue, CAST(trigger_date AS VARCHAR) AS trigger_date, round({V.dtw_sql('s', 'o')}, 4) AS distance FROM (
  SELECT t.car_name, t.issue, t.trigger_date, list(d.score ORDER BY d.upload_date) FILTER (WHERE d.upload_date <= t.trigger_date) AS s,
    list(d.score ORDER BY d.upload_date) FILTER (WHERE d.upload_date >= t.trigger_date) AS o
  FROM triggers t JOIN series d ON d.car_name = t.car_name AND d.issue = t.issue AND d.upload_date BETWEEN t.trigger_date - 90 AND t.trigger_date + 90
  GROUP BY 1, 2, 3)""", "triggers", "series", digits=4)
def g02(spark, sf):
    cases = interest.past_cases(V.series(spark, sf))
    before = S.scores_until(F.col("series"), F.col("trigger_date"))
    after = S.scores(F.filter("series", lambda x: x["upload_date"] >= F.col("trigger_date")))
    return cases.select(*KEYS, "trigger_date", before.alias("a"), after.alias("b")).select(
        *KEYS, "trigger_date", dtw(F.col("a"), F.col("b")).alias("distance"))


@query("g03_adjusted_dates", """SELECT monitor_car_name, monitor_issue, line, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score
  FROM chart_points WHERE line <> 'monitor'""", "chart_points")
def g03(spark, sf):
    found = interest.similar_cases(V.posts(spark, sf), ASOF)
    return found.select("monitor_car_name", "monitor_issue", F.concat(F.lit("case"), F.col("rank")).alias("line"),
                        F.inline("recommend_graph_score_list")).withColumnRenamed("norm_graph_score", "score")


@query("g04_graph_score", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score FROM long_series""", "long_series")
def g04(spark, sf):
    return V.long_series(spark, sf).drop("n_posts")


@query("g05_trigger_points", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS trigger_date FROM (
  SELECT *, avg(score) OVER w AS m, stddev_pop(score) OVER w AS s, count(score) OVER w AS n FROM series
  WINDOW w AS (PARTITION BY car_name, issue ORDER BY upload_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
  WHERE n = 7 AND score - m > 1.8 * s + 1e-12 * abs(m)""", "series")
def g05(spark, sf):
    return interest.all_triggers(V.series(spark, sf), 1.8)


@query("g06_cleaned_rows", """SELECT event_id, "Date" AS day, "View" AS views, "Like" AS likes, "Issue"::VARCHAR AS issue, "Url" AS url,
  "CarName" AS car_name FROM clean_raw""", "clean_raw")
def g06(spark, sf):
    raw = V.raw_posts(spark, sf).na.fill("")
    raw = values.map_values(raw, "CarName", V.ALIASES, keep_unknown=True)
    return raw.select(
        "event_id", times.date_part_text(F.col("Date")).alias("day"),
        values.clean_count(values.strip_prefix(F.col("View"))).alias("views"), values.clean_count(F.col("Like")).alias("likes"),
        F.to_json(text.tag_issues(F.concat("Title", "Body"), V.POST_DICTIONARY)).alias("issue"),
        values.clean_url(F.col("Url"), F.col("Community"), V.URL_RULES).alias("url"), F.col("CarName").alias("car_name"))
