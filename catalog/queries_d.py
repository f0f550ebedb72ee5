"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import ASOF, query
from catalog.queries_b import _in_list
from catalog.queries_c import TODAY, crawl_ranges
from signalpost.functions import text
from signalpost.operators import aggregates, tables
from signalpost.plans import explore, ingest, interest, keywords, serving


@query("d01_bounds", "SELECT community, " + ", ".join(f"round({a}_{m}, 6) AS {a}_{m}" for m in ("view", "like", "log_view", "log_like")
                                                       for a in ("min", "max")) + " FROM bounds", "bounds")
def d01(spark, sf):
    return aggregates.bounds(V.labelled(spark, sf))


DAILY = """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(avg_log_view, 6) AS avg_log_view,
  round(sum_log_like, 6) AS sum_log_like FROM daily"""


@query("d02_daily_features", DAILY, "daily")
def d02(spark, sf):
    posts = V.labelled(spark, sf)
    return aggregates.daily_features(aggregates.minmax(posts, aggregates.bounds(posts)))


@query("d02_daily_features_one_pass", DAILY, "daily")
def d02_one_pass(spark, sf):
    return aggregates.daily_features_in_one_pass(V.labelled(spark, sf)).drop("n_posts")


@query("d03_trigger_url_lists", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, 0 AS part, count(*) AS n,
  string_agg(url, ' ' ORDER BY url) AS urls FROM trigger_urls GROUP BY 1, 2, 3""", "trigger_urls")
def d03(spark, sf):
    lists = aggregates.trigger_urls(V.trigger_posts(spark, sf))
    return lists.select("car_name", "issue", "upload_date", "part", F.size("url").alias("n"), F.array_join("url", " ").alias("urls"))


@query("d04_nested_series", """SELECT car_name, issue, count(*) AS days, CAST(min(upload_date) AS VARCHAR) AS first_day,
  CAST(max(upload_date) AS VARCHAR) AS last_day, round(arg_min(score, upload_date), 6) AS first_score,
  round(arg_max(score, upload_date), 6) AS last_score FROM series GROUP BY 1, 2""", "series")
def d04(spark, sf):
    nested = aggregates.nest_series(V.series(spark, sf), ["car_name", "issue"])
    first, last = F.col("series")[0], F.try_element_at("series", F.lit(-1))
    return nested.select("car_name", "issue", F.size("series").alias("days"), first["upload_date"].alias("first_day"),
                         last["upload_date"].alias("last_day"), first["norm_graph_score"].alias("first_score"),
                         last["norm_graph_score"].alias("last_score"))


@query("d05_nested_recommendations", """SELECT car_name AS monitor_car_name, issue AS monitor_issue, count(*) AS cases,
  string_agg(case_car || '/' || case_issue || '/' || CAST(trigger_date AS VARCHAR), ' ' ORDER BY rank) AS listed FROM ranked GROUP BY 1, 2""", "ranked")
def d05(spark, sf):
    nested = aggregates.nest_recommendations(interest.similar_cases(V.posts(spark, sf), ASOF))
    line = F.transform("recommend_json", lambda r: F.concat_ws("/", r["recommend_car_name"], r["recommend_issue"],
                                                               r["recommend_start_date"].cast("string")))
    return nested.select("monitor_car_name", "monitor_issue", F.size("recommend_json").alias("cases"), F.array_join(line, " ").alias("listed"))


SUMMARY = """SELECT p.car_name, p.issue, CAST(p.upload_date AS VARCHAR) AS upload_date, num_posts, total_likes, total_views, issue_mentions,
  CAST(t.trigger_date AS VARCHAR) AS trigger_date, t.issue_url FROM (
  SELECT car_name, issue, max(upload_date) AS upload_date, count(*) AS num_posts, CAST(sum(num_likes) AS BIGINT) AS total_likes,
    CAST(sum(num_views) AS BIGINT) AS total_views,
    CAST(count(*) + sum((length(title || body) - length(replace(title || body, issue, ''))) // length(issue)) AS BIGINT) AS issue_mentions
  FROM (SELECT *, unnest(issues[1:5]) AS issue FROM (SELECT * EXCLUDE (issue) FROM posts_with_text WHERE upload_date >= DATE '2024-01-31' - 5)) GROUP BY 1, 2) p
  LEFT JOIN (SELECT car_name, issue, max(upload_date) AS trigger_date, arg_min(url, (-(upload_date - DATE '1970-01-01'), url)) AS issue_url
    FROM trigger_urls GROUP BY 1, 2) t ON t.car_name = p.car_name AND t.issue = p.issue"""


def today(spark, sf):
    return serving.summary(V.posts_with_text(spark, sf), V.trigger_posts(spark, sf), ASOF)


@query("d06_today_summary", SUMMARY, "posts_with_text", "trigger_urls")
def d06(spark, sf):
    return today(spark, sf)


MEASURES = [f"{m}_{a}" for m in explore.MEASURES for a in ("sum", "mean")]
V.view("long_measures", "SELECT upload_date, " + ", ".join(f"{f}({m}) AS {m}_{a}" for m in explore.MEASURES for a, f in (("sum", "sum"), ("mean", "avg")))
       + " FROM long_normalized GROUP BY upload_date", "long_normalized")


@query("d07_sums_and_means", "SELECT CAST(upload_date AS VARCHAR) AS upload_date, " + ", ".join(f"round({m}, 4) AS {m}" for m in MEASURES)
       + " FROM long_measures", "long_measures", digits=4)
def d07(spark, sf):
    return explore.daily_measures(interest.labelled_posts(V.long_posts(spark, sf), V.LONG_ASOF))


V.view("daily_negative", f"""SELECT upload_date, count(*) AS posts, CAST(sum(len(list_filter(regexp_split_to_array(trim(title), '\\s+'), lambda t: t IN {_in_list(V.NEGATIVE_WORDS)}))
  + len(list_filter(regexp_split_to_array(trim(body), '\\s+'), lambda t: t IN {_in_list(V.NEGATIVE_WORDS)}))) AS BIGINT) AS negative_words
  FROM doc_posts GROUP BY upload_date""", "doc_posts")


def daily_negative(spark, sf):
    counted = V.doc_posts(spark, sf).select("upload_date", text.lexicon_count(
        [F.col("title"), F.col("body"), F.col("comments")], V.NEGATIVE_WORDS).alias("n"))
    return aggregates.daily_counts(counted, "upload_date", "n")


@query("d08_daily_counts", "SELECT CAST(upload_date AS VARCHAR) AS upload_date, posts, negative_words FROM daily_negative", "daily_negative")
def d08(spark, sf):
    return daily_negative(spark, sf)


@query("d09_term_windows", "SELECT term, short_count, long_count FROM term_counts", "term_counts")
def d09(spark, sf):
    found = text.weighted_terms(V.doc_posts(spark, sf).select("upload_date", *keywords.WEIGHTS), keywords.WEIGHTS)
    return aggregates.term_windows(found, "upload_date", TODAY)


@query("d09_term_days", """SELECT CAST(upload_date AS VARCHAR) AS upload_date, term, CAST(sum(weight) AS BIGINT) AS weight
  FROM all_term_rows GROUP BY 1, 2""", "all_term_rows")
def d09_days(spark, sf):
    found = text.weighted_terms(V.doc_posts(spark, sf).select("upload_date", *keywords.WEIGHTS), keywords.WEIGHTS, distinct=False)
    return aggregates.term_days(found, "upload_date")


@query("d10_dedupe_keep_first", """SELECT "Url" AS url, "Date" AS day, "Time" AS posted, "View" AS views, "Title" AS title, "Community" AS community
  FROM deduped_raw""", "deduped_raw")
def d10(spark, sf):
    cleaned = ingest.clean_posts(V.raw_posts(spark, sf), V.POST_DICTIONARY, V.URL_RULES, V.ALIASES)
    return cleaned.select(F.col("Url").alias("url"), F.col("Date").alias("day"), F.col("Time").alias("posted"),
                          F.col("View").alias("views"), F.col("Title").alias("title"), F.col("Community").alias("community"))


@query("d11_representatives", """SELECT car_name, issue, CAST(max(upload_date) AS VARCHAR) AS trigger_date,
  arg_min(url, (-(upload_date - DATE '1970-01-01'), url)) AS issue_url FROM trigger_urls GROUP BY 1, 2""", "trigger_urls")
def d11(spark, sf):
    return aggregates.latest_trigger(V.trigger_posts(spark, sf))


@query("d12_z_scores", """SELECT CAST(upload_date AS VARCHAR) AS upload_date, round((negative_words - m) / s, 6) AS z
  FROM daily_negative, (SELECT avg(negative_words) AS m, stddev_samp(negative_words) AS s FROM daily_negative)
  WHERE abs((negative_words - m) / s) > 1.1""", "daily_negative")
def d12(spark, sf):
    return aggregates.z_scores(daily_negative(spark, sf), "negative_words").filter(F.abs("z") > 1.1).select("upload_date", "z")


@query("d13_range_extremes", """SELECT strftime(min(start_datetime), '%Y-%m-%d %H:%M:%S') AS first_start,
  strftime(max(end_datetime), '%Y-%m-%d %H:%M:%S') AS last_end FROM crawl_ranges""", "crawl_ranges")
def d13(spark, sf):
    return aggregates.extremes(crawl_ranges(spark, sf), "start_datetime", "end_datetime")
