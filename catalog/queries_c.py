"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import ASOF, query
from signalpost.functions.values import has_label
from signalpost.operators import aggregates, similar
from signalpost.operators.ranges import split_range
from signalpost.operators.tables import overlay, top_k
from signalpost.plans import interest, keywords, serving
from signalpost.scale import interval_join, measured_join, name_matches


@query("c01_overlay", """SELECT url, CASE WHEN upload_date >= DATE '2024-01-29' THEN num_views * 2 ELSE num_views END AS num_views,
  CASE WHEN upload_date >= DATE '2024-01-29' AND num_likes % 2 = 0 THEN -num_likes ELSE num_likes END AS num_likes, car_name FROM posts""", "posts")
def c01(spark, sf):
    p = V.posts(spark, sf).select("url", "num_views", "num_likes", "car_name", "upload_date")
    patch = p.filter(F.col("upload_date") >= "2024-01-29").select(
        "url", (F.col("num_views") * 2).alias("num_views"),
        F.when(F.col("num_likes") % 2 == 0, -F.col("num_likes")).alias("num_likes"))
    return overlay(p.drop("upload_date"), patch, "url", ["num_views", "num_likes"])


@query("c02_bounds_join", """SELECT url, issue, community, round(min_log_view, 6) AS min_log_view, round(max_log_view, 6) AS max_log_view
  FROM labelled JOIN bounds USING (community)""", "bounds")
def c02(spark, sf):
    posts = V.labelled(spark, sf)
    limits = aggregates.bounds(posts)
    return measured_join(posts, limits, ["community"], F.col("url")).select("url", "issue", "community", "min_log_view", "max_log_view")


@query("c03_trigger_posts", "SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, url FROM trigger_urls", "trigger_urls")
def c03(spark, sf):
    return V.trigger_posts(spark, sf).select("car_name", "issue", "upload_date", "url")


@query("c04_case_windows", """SELECT car_name, issue, CAST(trigger_date AS VARCHAR) AS trigger_date,
  CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score FROM case_points""", "case_points")
def c04(spark, sf):
    s = V.series(spark, sf)
    return similar.case_windows(interest.all_triggers(s), s).select("car_name", "issue", "trigger_date", "upload_date", "score")


@query("c04_case_windows_long", """SELECT t.car_name, t.issue, CAST(t.trigger_date AS VARCHAR) AS trigger_date, count(*) AS days,
  round(sum(d.score), 4) AS total FROM long_triggers t JOIN long_series d ON d.car_name = t.car_name AND d.issue = t.issue
  AND d.upload_date BETWEEN t.trigger_date - 90 AND t.trigger_date + 90 GROUP BY 1, 2, 3""", "long_triggers", "long_series", digits=4)
def c04_long(spark, sf):
    s = V.long_series(spark, sf)
    points = similar.case_windows(interest.all_triggers(s), s)
    return points.groupBy("car_name", "issue", "trigger_date").agg(F.count("*").alias("days"), F.sum("score").alias("total"))


@query("c05_candidate_cases", """SELECT m.car_name, m.issue, count(c.car_name) AS candidates FROM monitored m
  LEFT JOIN cases c ON m.car_name <> c.car_name AND m.issue <> c.issue GROUP BY 1, 2""", "monitored", "cases")
def c05(spark, sf):
    """Cases of another car and another issue per series.  The pairs themselves never leave a task: see e09, e16."""
    s = V.series(spark, sf)
    cases = interest.all_triggers(s).withColumnsRenamed({"car_name": "case_car", "issue": "case_issue"})
    return similar.candidate_counts(interest.monitored_series(s, ASOF), cases)


@query("c06_posts_with_triggers", """SELECT p.url, p.issue, p.n, CAST(t.trigger_date AS VARCHAR) AS trigger_date FROM (
  SELECT url, car_name, unnest(issues[1:5]) AS issue, unnest(range(least(len(issues), 5))) AS n FROM posts
  WHERE upload_date >= DATE '2024-01-31' - 5) p LEFT JOIN triggers t ON t.car_name = p.car_name AND t.issue = p.issue""", "posts", "triggers")
def c06(spark, sf):
    rows = serving.recent_labels(V.posts(spark, sf), ASOF)
    return serving.with_triggers(rows, V.dated_triggers(spark, sf)).select("url", "issue", "n", "trigger_date")


CASE_NEWS = """SELECT DISTINCT c.case_car AS recommend_car_name, c.case_issue AS recommend_issue, c.trigger_date AS start, n.url, n.car_name AS news_car_name,
  n.upload_date AS news_date FROM ranked c JOIN news n ON n.issue = c.case_issue AND contains(n.car_name, c.case_car)
  AND n.upload_date BETWEEN c.trigger_date AND c.trigger_date + 90"""


def recommended(spark, sf):
    return interest.similar_cases(V.posts(spark, sf), ASOF)


@query("c07_case_news", f"""SELECT recommend_car_name, recommend_issue, CAST(start AS VARCHAR) AS recommend_start_date, url, news_car_name,
  CAST(news_date AS VARCHAR) AS news_date FROM ({CASE_NEWS})""", "ranked", "news")
def c07(spark, sf):
    return serving.case_news(recommended(spark, sf), V.news(spark, sf), ASOF).drop("chart_date")


V.view("chart_points", """SELECT car_name AS monitor_car_name, issue AS monitor_issue, 'monitor' AS line, upload_date, score FROM series
    WHERE upload_date BETWEEN DATE '2024-01-31' - 90 AND DATE '2024-01-31'
  UNION ALL SELECT r.car_name, r.issue, 'case' || r.rank, p.upload_date + CAST(DATE '2024-01-31' - p.trigger_date AS INTEGER), p.score
    FROM ranked r JOIN case_points p ON p.car_name = r.case_car AND p.issue = r.case_issue AND p.trigger_date = r.trigger_date""",
       "series", "ranked", "case_points")

ALIGNED = """SELECT monitor_car_name, monitor_issue, CAST(upload_date AS VARCHAR) AS upload_date,
  round(max(score) FILTER (WHERE line = 'monitor'), 6) AS monitor, round(max(score) FILTER (WHERE line = 'case1'), 6) AS case1,
  round(max(score) FILTER (WHERE line = 'case2'), 6) AS case2, round(max(score) FILTER (WHERE line = 'case3'), 6) AS case3
  FROM chart_points GROUP BY 1, 2, 3"""


@query("c08_aligned_series", ALIGNED, "chart_points")
def c08(spark, sf):
    from signalpost.session import cut
    s = cut(V.series(spark, sf))
    return serving.aligned(interest.monitored_series(s, ASOF), interest.similar_cases_of(s, ASOF))


@query("c09_lookup", """SELECT car_name AS monitor_car_name, issue AS monitor_issue, count(*) AS days FROM series
  WHERE car_name IN (SELECT 'car' || (user_id % 6) FROM events WHERE event_type = 'view' AND value > 150)
  AND (car_name, upper(issue)) IN (SELECT DISTINCT 'car' || (user_id % 6), upper(event_type) FROM events WHERE value > 150) GROUP BY 1, 2""", "series")
def c09(spark, sf):
    e = V.table(spark, sf, "events").filter("value > 150")
    car = F.concat(F.lit("car"), (F.col("user_id") % 6).cast("string"))
    viewed = e.filter("event_type = 'view'").select(car.alias("monitor_car_name")).distinct()
    requests = e.select(car.alias("car_name"), F.initcap("event_type").alias("issue"))
    days = V.series(spark, sf).groupBy(F.col("car_name").alias("monitor_car_name"), F.col("issue").alias("monitor_issue")).agg(
        F.count("*").alias("days"))
    return serving.lookup(days, requests).join(viewed, "monitor_car_name", "left_semi")


TODAY = "2024-12-28"
V.view("term_counts", f"""SELECT term, CAST(sum(weight) AS BIGINT) AS long_count,
  CAST(coalesce(sum(weight) FILTER (WHERE upload_date > DATE '{TODAY}' - 7), 0) AS BIGINT) AS short_count FROM term_rows
  WHERE upload_date > DATE '{TODAY}' - 365 AND upload_date <= DATE '{TODAY}' GROUP BY term""", "term_rows")
V.view("rising", f"""SELECT term, short_count, CAST(trunc(long_count * 7 / 365.0) AS BIGINT) AS expected_short_count, long_count,
  exp(short_count * ln(long_count * 7 / 365.0) - long_count * 7 / 365.0 - lgamma(short_count + 1)) AS poisson_score
  FROM term_counts WHERE short_count >= 9 AND long_count >= 9
  AND term NOT IN ({", ".join(f"'{w}'" for w in V.STOP_WORDS)})""", "term_counts")
V.view("top_terms", "SELECT term FROM rising ORDER BY poisson_score, term LIMIT 5", "rising")


@query("c10_term_links", f"""SELECT term, link_rank, url FROM (SELECT t.term, d.url, row_number() OVER (PARTITION BY t.term ORDER BY d.url) AS link_rank
  FROM top_terms t JOIN doc_posts d ON contains(d.title, t.term) OR contains(d.body, t.term)
  WHERE d.upload_date > DATE '{TODAY}' - 7 AND d.upload_date <= DATE '{TODAY}') WHERE link_rank <= 3""", "top_terms", "doc_posts")
def c10(spark, sf):
    posts = V.doc_posts(spark, sf)
    top = keywords.rising_keywords(posts, stop_words(spark), TODAY, k=5)
    return keywords.term_links(posts, top, TODAY).select("term", "link_rank", "url")


def stop_words(spark):
    return spark.createDataFrame([(w,) for w in V.STOP_WORDS], "word string")


@query("c11_tracked_news", """SELECT url, car_name FROM news WHERE EXISTS (
  SELECT 1 FROM (SELECT DISTINCT 'car' || (user_id % 3) AS name FROM events WHERE event_type = 'signup') t WHERE contains(news.car_name, t.name))""", "news")
def c11(spark, sf):
    tracked = V.table(spark, sf, "events").filter("event_type = 'signup'").select(
        F.concat(F.lit("car"), (F.col("user_id") % 3).cast("string")).alias("tracked_name")).distinct()
    news = V.news(spark, sf)
    named = name_matches(news, "car_name", tracked, "tracked_name").select("car_name").distinct()
    return measured_join(news, named, ["car_name"], F.col("url"), "left_semi").select("url", "car_name")


@query("c12_new_keys", """SELECT url FROM posts WHERE url NOT IN (SELECT url FROM posts WHERE num_views > 2000)""", "posts")
def c12(spark, sf):
    p = V.posts(spark, sf)
    return p.select("url").join(p.filter("num_views > 2000").select("url"), "url", "left_anti")


def known_cases(spark, sf):
    """Curated cases derived from the orders: the two largest days of a priority, plus a car without data."""
    o = V.table(spark, sf, "orders")
    daily = o.groupBy(F.col("o_orderpriority").alias("car_name"), F.col("o_orderstatus").alias("issue"),
                      F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("total"))
    best = top_k(daily, ["car_name", "issue"], [F.round("total", 2).desc(), F.col("day")], 2, "r")
    found = best.groupBy("car_name", "issue").agg(F.sort_array(F.collect_list(F.struct("r", "day"))).alias("d")).select(
        "car_name", "issue", F.transform("d", lambda x: x["day"]).alias("news_dates"))
    absent = found.select(F.lit("absent").alias("car_name"), "issue", "news_dates").limit(1)
    return found.unionByName(absent)


V.view("known_cases", """SELECT car_name, issue, day AS news_date FROM (SELECT *, row_number() OVER (PARTITION BY car_name, issue ORDER BY total DESC, day) AS r
  FROM (SELECT o_orderpriority AS car_name, o_orderstatus AS issue, CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS total
        FROM orders GROUP BY 1, 2, 3)) WHERE r = 1""")
V.view("known_points", """SELECT k.car_name, k.issue, k.news_date, s.upload_date, s.score FROM known_cases k JOIN long_series s
  ON s.car_name = k.car_name AND s.issue = k.issue
  AND s.upload_date BETWEEN CAST(k.news_date - INTERVAL 3 MONTH AS DATE) AND CAST(k.news_date + INTERVAL 3 MONTH AS DATE)""",
       "known_cases", "long_series")


@query("c13_known_case_windows", """SELECT car_name, issue, CAST(news_date AS VARCHAR) AS news_date, CAST(upload_date AS VARCHAR) AS upload_date,
  round(score, 4) AS score FROM known_points""", "known_points", digits=4)
def c13(spark, sf):
    points = similar.known_case_windows(known_cases(spark, sf), V.long_series(spark, sf))
    return points.select("car_name", "issue", "news_date", "upload_date", "score")


def crawl_ranges(spark, sf):
    """Crawl ranges asked for at the end of every day that has events: 24 hours in 5 parts."""
    days = V.table(spark, sf, "events").select(F.date_add(F.to_date("ts"), 1).cast("timestamp").alias("asof")).distinct()
    return split_range(days, F.col("asof"), F.lit(24), F.lit(5), zone_hours=0)


V.view("crawl_ranges", """SELECT ends, part, start_datetime, start_datetime + INTERVAL 1 HOUR * len - INTERVAL 1 MINUTE AS end_datetime FROM (
  SELECT ends, part, len, ends - INTERVAL 1 HOUR * sum(len) OVER (PARTITION BY ends ORDER BY part) AS start_datetime FROM (
   SELECT ends, part, 24 // 5 + CASE WHEN part < 24 % 5 THEN 1 ELSE 0 END AS len FROM (
    SELECT DISTINCT CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS ends FROM events), range(5) r(part)))""")


@query("c14_posts_in_ranges", """SELECT p.url, r.part, strftime(r.start_datetime, '%Y-%m-%d %H:%M:%S') AS start_datetime FROM posts p
  JOIN crawl_ranges r ON epoch(date_trunc('second', p.ts)) BETWEEN epoch(r.start_datetime) AND epoch(r.end_datetime)""", "posts", "crawl_ranges")
def c14(spark, sf):
    joined = interval_join(V.posts(spark, sf).select("url", "ts"), crawl_ranges(spark, sf), [], F.unix_timestamp("ts"),
                           F.unix_timestamp("start_datetime"), F.unix_timestamp("end_datetime"), width=3600, spread=F.col("url"))
    return joined.select("url", "part", "start_datetime")
