"""The composite jobs a user runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import ASOF, query
from catalog.queries_b import replies
from catalog.queries_c import ALIGNED, TODAY, known_cases, recommended, stop_words
from catalog.queries_d import SUMMARY, daily_negative, today
from catalog.queries_e import change_points_sql, curated
from signalpost.functions import text
from signalpost.operators import aggregates, tables
from signalpost.plans import explore, ingest, interest, keywords, serving
from signalpost.schemas import CRAWL
from signalpost.session import cut, work_folder
from signalpost.sources import crawl, sinks


@query("i01_interest_series", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score, n_posts FROM series""", "series")
def i01(spark, sf):
    return V.series(spark, sf)


@query("i02_trigger_report", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, true AS is_trigger, 0 AS part,
  string_agg(url, ' ' ORDER BY url) AS urls FROM trigger_urls GROUP BY 1, 2, 3""", "trigger_urls")
def i02(spark, sf):
    report = interest.trigger_report(V.posts(spark, sf), ASOF)
    return report.withColumn("urls", F.array_join("url", " ")).drop("url")


V.view("long_trigger_counts", """SELECT t.car_name, t.issue, t.trigger_date AS upload_date, count(*) AS posts FROM (
  SELECT car_name, issue, upload_date AS trigger_date FROM (
   SELECT *, avg(score) OVER w AS m, stddev_pop(score) OVER w AS s, count(score) OVER w AS n FROM long_series
   WHERE upload_date BETWEEN DATE '2001-08-01' - 90 AND DATE '2001-08-01'
   WINDOW w AS (PARTITION BY car_name, issue ORDER BY upload_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
  WHERE n = 7 AND score - m > 1.5 * s + 1e-12 * abs(m)) t
  JOIN long_posts p ON p.car_name = t.car_name AND p.issues[1] = t.issue AND p.upload_date = t.trigger_date GROUP BY 1, 2, 3""", "long_series", "long_posts")


@query("i02_trigger_report_long", "SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, posts FROM long_trigger_counts", "long_trigger_counts")
def i02_long(spark, sf):
    """A run date at the end of the orders: only the last 90 days are tested, windows start inside them."""
    s = V.long_series(spark, sf)
    hits = interest.recent_triggers(s, "2001-08-01 00:00", k=1.5).select("car_name", "issue", "upload_date", "is_trigger", "n_posts")
    posts = interest.explode_issues(V.long_posts(spark, sf).select("car_name", "issue", "upload_date", "url"))
    lists = aggregates.trigger_urls(tables.attach_urls(posts, hits), limit=3)
    return lists.groupBy("car_name", "issue", "upload_date").agg(F.sum(F.size("url")).alias("posts"))


@query("i03_similar_cases", """SELECT r.car_name AS monitor_car_name, r.issue AS monitor_issue, r.rank, round(r.distance, 6) AS distance,
  r.case_car AS recommend_car_name, r.case_issue AS recommend_issue, CAST(r.trigger_date AS VARCHAR) AS recommend_start_date,
  CAST(p.upload_date + CAST(DATE '2024-01-31' - p.trigger_date AS INTEGER) AS VARCHAR) AS upload_date, round(p.score, 6) AS norm_graph_score
  FROM ranked r JOIN case_points p ON p.car_name = r.case_car AND p.issue = r.case_issue AND p.trigger_date = r.trigger_date""", "ranked", "case_points")
def i03(spark, sf):
    found = recommended(spark, sf)
    return found.select("monitor_car_name", "monitor_issue", "rank", "distance", "recommend_car_name", "recommend_issue",
                        "recommend_start_date", F.inline("recommend_graph_score_list"))


@query("i03_recommendation_table", """SELECT m.car_name AS monitor_car_name, m.issue AS monitor_issue, len(m.s) AS days, count(r.rank) AS cases,
  arg_min(r.case_car || '/' || r.case_issue, r.rank) AS first_case FROM monitored m JOIN ranked r ON r.car_name = m.car_name AND r.issue = m.issue
  GROUP BY m.car_name, m.issue, len(m.s)""", "monitored", "ranked")
def i03_table(spark, sf):
    """The stored form, nested values as JSON text, read back as the dashboard does."""
    s = cut(V.series(spark, sf))
    table = interest.recommendation_table(s, interest.similar_cases_of(s, ASOF), ASOF)
    first = lambda name: F.get_json_object("recommend_json", f"$[0].{name}")
    return table.select("monitor_car_name", "monitor_issue", F.json_array_length("monitor_graph_score_list").alias("days"),
                        F.json_array_length("recommend_json").alias("cases"),
                        F.concat_ws("/", first("recommend_car_name"), first("recommend_issue")).alias("first_case"))


POST_COLUMNS = ["url", "upload_date", "upload_time", "title", "comments", "num_views", "num_likes", "community", "car_name", "issue"]
V.view("first_load", """SELECT * FROM clean_raw WHERE ts < TIMESTAMP '2024-01-16' QUALIFY row_number() OVER (PARTITION BY "Url"
  ORDER BY "Date", "Time", "View" DESC NULLS LAST, "Title", "Body", "Like") = 1""", "clean_raw")
V.view("second_load", """SELECT * FROM clean_raw WHERE ts >= TIMESTAMP '2024-01-14' QUALIFY row_number() OVER (PARTITION BY "Url"
  ORDER BY "Date", "Time", "View" DESC NULLS LAST, "Title", "Body", "Like") = 1""", "clean_raw")


INGESTED = """SELECT url, replace(CASE WHEN day LIKE '%.' THEN day[:-2] ELSE day END, '.', '-') AS upload_date, upload_time, title, comments, num_views, num_likes,
  community, car_name, issue FROM (
  SELECT coalesce(a."Url", b."Url") AS url, coalesce(a."Date", b."Date") AS day, coalesce(a."Time", b."Time") AS upload_time,
    coalesce(a."Title", b."Title") AS title, CASE WHEN b."Url" IS NULL THEN a."Comment" ELSE b."Comment" END AS comments,
    CASE WHEN b."Url" IS NULL THEN a."View" ELSE b."View" END AS num_views, CASE WHEN b."Url" IS NULL THEN a."Like" ELSE b."Like" END AS num_likes,
    coalesce(a."Community", b."Community") AS community, coalesce(a."CarName", b."CarName") AS car_name, coalesce(a."Issue", b."Issue")::VARCHAR AS issue
  FROM first_load a FULL JOIN second_load b ON a."Url" = b."Url")"""
RULES = (V.POST_DICTIONARY, V.URL_RULES, V.ALIASES)


def _two_crawls(spark, sf):
    raw = V.raw_posts(spark, sf)
    return (raw.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp")).select(*CRAWL.names),
            raw.filter(F.col("ts") >= F.lit("2024-01-14").cast("timestamp")).select(*CRAWL.names))


@query("i04_post_ingest", INGESTED, "first_load", "second_load")
def i04(spark, sf):
    early, late = _two_crawls(spark, sf)
    current = ingest.post_rows(ingest.clean_posts(early, *RULES))
    return ingest.ingest_posts(current, late, *RULES).select(*POST_COLUMNS)


@query("i04_post_ingest_by_day", INGESTED, "first_load", "second_load")
def i04_by_day(spark, sf):
    """The stored form: the second crawl rewrites only the days it touches."""
    target = work_folder(spark, "post-table")
    early, late = _two_crawls(spark, sf)
    ingest.ingest_into(target, early, *RULES)
    ingest.ingest_into(target, late, *RULES)
    return tables.read_days(spark, target).select(*POST_COLUMNS)


@query("i04_ingest_rejects", """SELECT r."Community" AS community, count(*) AS posts, count(*) FILTER (WHERE c."View" IS NULL) AS bad_views,
  count(*) FILTER (WHERE c."Like" IS NULL) AS bad_likes,
  count(*) FILTER (WHERE try_cast(replace(regexp_replace(c."Date", '\\.$', ''), '.', '-') AS DATE) IS NULL) AS bad_dates FROM raw_posts r JOIN clean_raw c USING (event_id) GROUP BY 1""", "raw_posts", "clean_raw")
def i04_rejects(spark, sf):
    return ingest.rejects(V.raw_posts(spark, sf)).withColumnsRenamed({"Community": "community", "rows": "posts"})


@query("i05_range_merge", """SELECT "Community" AS community, "CarName" AS car, "Date" AS day, "Time" AS posted, "Url" AS url, "Title" AS title FROM raw_posts""", "raw_posts")
def i05(spark, sf):
    """Range files of all cells, merged per cell and written in order of time."""
    root = work_folder(spark, "merge")
    raw = V.raw_posts(spark, sf)
    first, second = (F.coalesce(F.col("ts") >= F.lit(x).cast("timestamp"), F.lit(True)) for x in ("2024-01-11", "2024-01-21"))
    parts = []
    for i, inside in enumerate((~first, first & ~second, second)):
        part = raw.filter(inside)
        sinks.write_csv(part.select(*CRAWL.names), f"{root}/range{i}")
        parts.append(spark.read.schema(CRAWL).options(**crawl.CSV).csv(f"{root}/range{i}"))
    merged = ingest.merge_ranges(parts).withColumns({"cell_source": F.col("Community"), "cell_car": F.col("CarName")})
    sinks.write_csv(merged, f"{root}/merged", ("cell_source", "cell_car"))
    stored = spark.read.schema(CRAWL).options(**crawl.CSV).csv(f"{root}/merged/*/*/*.csv")
    return stored.select(F.col("Community").alias("community"), F.col("CarName").alias("car"), F.col("Date").alias("day"),
                         F.col("Time").alias("posted"), F.col("Url").alias("url"), F.col("Title").alias("title"))


@query("i06_today_summary", SUMMARY + " WHERE num_posts > 0", "posts_with_text", "trigger_urls")
def i06(spark, sf):
    return today(spark, sf).filter("num_posts > 0")


def chart_tables(spark, sf):
    """Stored result table of the scoring job, and the trigger report."""
    posts = V.posts(spark, sf)
    s = cut(interest.interest_series(posts, ASOF))
    table = interest.recommendation_table(s, interest.similar_cases_of(s, ASOF), ASOF)
    return table, interest.trigger_report(posts, ASOF, series=s).withColumn("url", F.to_json("url"))


CHART_LINK = """(SELECT car_name, issue, arg_min(url, (-(upload_date - DATE '1970-01-01'), url)) AS url FROM trigger_urls GROUP BY 1, 2)"""


@query("i07_chart_dataset", f"""SELECT a.*, t.url AS trigger_url FROM ({ALIGNED}) a LEFT JOIN {CHART_LINK} t
  ON t.car_name = a.monitor_car_name AND t.issue = a.monitor_issue""", "chart_points", "trigger_urls")
def i07(spark, sf):
    return serving.chart_dataset(*chart_tables(spark, sf))


@query("i07_chart_heads", f"""SELECT m.car_name AS monitor_car_name, m.issue AS monitor_issue, m.labels, s.num_posts, s.total_likes, s.total_views,
  s.issue_mentions, s.trigger_date, t.url AS trigger_url FROM (
  SELECT car_name, issue, string_agg(case_car || ' - ' || case_issue || ' (' || CAST(trigger_date AS VARCHAR) || ')', '; ' ORDER BY rank) AS labels FROM ranked
    WHERE (car_name, upper(issue)) IN (SELECT DISTINCT 'car' || (user_id % 6), upper(event_type) FROM events WHERE event_type <> 'view') GROUP BY 1, 2) m
  LEFT JOIN ({SUMMARY}) s ON s.car_name = m.car_name AND s.issue = m.issue LEFT JOIN {CHART_LINK} t ON t.car_name = m.car_name AND t.issue = m.issue""",
       "ranked", "posts_with_text", "trigger_urls")
def i07_heads(spark, sf):
    table, report = chart_tables(spark, sf)
    requests = V.table(spark, sf, "events").filter("event_type <> 'view'").select(
        F.concat(F.lit("car"), (F.col("user_id") % 6).cast("string")).alias("car_name"), F.initcap("event_type").alias("issue"))
    heads = serving.chart_heads(table, report, today(spark, sf), requests)
    return heads.select("monitor_car_name", "monitor_issue", F.array_join("labels", "; ").alias("labels"), "num_posts", "total_likes", "total_views",
                        "issue_mentions", F.col("trigger_date").cast("string").alias("trigger_date"), "trigger_url")


@query("i07_chart_news_lines", """SELECT r.car_name AS monitor_car_name, r.issue AS monitor_issue, r.rank,
  CAST(DATE '2024-01-31' + CAST(n.upload_date - r.trigger_date AS INTEGER) AS VARCHAR) AS chart_date,
  'news: ' || n.car_name || ' - ' || n.issue AS label, count(*) AS news FROM ranked r JOIN news n ON n.issue = r.case_issue
  AND contains(n.car_name, r.case_car) AND n.upload_date BETWEEN r.trigger_date AND r.trigger_date + 90 GROUP BY ALL""", "ranked", "news")
def i07_lines(spark, sf):
    return serving.chart_news(cut(recommended(spark, sf).drop("recommend_graph_score_list")), V.news(spark, sf), ASOF)


@query("i08_hot_list", """SELECT car_name || ' - ' || issue || chr(10) || '(' || CAST(trigger_date AS VARCHAR) || ')' AS line FROM triggers
  WHERE trigger_date >= DATE '2024-01-31' - 20""", "triggers")
def i08_hot(spark, sf):
    return serving.hot_list(V.dated_triggers(spark, sf), ASOF, 20).select("line")


@query("i08_news_alerts", """SELECT count(*) AS entries, CAST(sum(length('차량명: ' || car_name || chr(10) || '이슈: ' || coalesce(issue, 'null') || chr(10) || '제목: ' || title || chr(10)
   || '요약: ' || summary || chr(10) || 'url: ' || url)) AS BIGINT) AS chars FROM news
  WHERE upload_date >= DATE '2024-01-31' - 5 AND (contains(car_name, 'car1') OR contains(car_name, 'car3'))""", "news")
def i08_news(spark, sf):
    tracked = spark.createDataFrame([("car1",), ("car3",)], "tracked_name string")
    recent = serving.tracked_news(V.news(spark, sf), tracked, ASOF)
    messages = serving.render_alerts(recent, serving.news_line(), "news", ASOF, ["car_name", "upload_date", "url"], per_message=20)
    head = F.length(F.format_string("%d entries\n\n", "entries"))
    return messages.agg(F.sum("entries").alias("entries"),
                        F.sum(F.length("text") - head - 2 * (F.col("entries") - 1)).alias("chars"))


@query("i08_trigger_alerts", """SELECT 0 AS message, count(*) AS entries, '2024-01-20 00:00 triggers' AS subject,
  count(*) || ' entries' || chr(10) || chr(10) || string_agg(car_name || ' - ' || issue || chr(10) ||
    'http://charts/?car_name=' || car_name || '&issue=' || issue, chr(10) || chr(10) ORDER BY car_name, issue, trigger_date) AS text
  FROM triggers WHERE trigger_date >= DATE '2024-01-20' - 5 HAVING count(*) > 0""", "triggers")
def i08_triggers(spark, sf):
    return serving.trigger_alerts(V.dated_triggers(spark, sf), "http://charts/?", "2024-01-20 00:00", per_message=1_000_000)


V.view("news_replies", """SELECT 'n' || (event_id // 2) AS url, CAST(ts AS DATE) AS upload_date, strftime(ts, '%H:%M') AS upload_time, 'News ' || event_id AS title,
  car_name, topic AS issue, summary FROM replies WHERE is_trigger AND lower(topic) <> 'none'""", "replies")


@query("i09_news_ingest", """SELECT url, title, issue, car_name FROM news WHERE upload_date <= DATE '2024-01-10' UNION ALL
  SELECT url, title, issue, car_name FROM (SELECT * FROM news_replies WHERE url NOT IN (SELECT url FROM news WHERE upload_date <= DATE '2024-01-10')
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY upload_date, upload_time, title) = 1)""", "news", "news_replies")
def i09(spark, sf):
    current = V.news(spark, sf).filter(F.col("upload_date") <= "2024-01-10")
    raw = replies(spark, sf).select(
        F.date_format("ts", "yyyy-MM-dd").alias("upload_date"), F.date_format("ts", "HH:mm").alias("upload_time"),
        F.concat(F.lit("News "), F.col("event_id").cast("string")).alias("title"), F.lit("").alias("body"),
        F.concat(F.lit("n"), F.floor(F.col("event_id") / 2).cast("string")).alias("url"), "reply")
    return ingest.ingest_news(current, raw).select("url", "title", "issue", "car_name")


@query("i10_rising_keywords", """SELECT term, short_count, expected_short_count, long_count, round(poisson_score, 6) AS poisson_score
  FROM (SELECT * FROM rising ORDER BY poisson_score, term LIMIT 30)""", "rising")
def i10(spark, sf):
    return keywords.rising_keywords(V.doc_posts(spark, sf), stop_words(spark), TODAY)


V.view("keyword_negative", """SELECT upload_date, CAST(sum(negative) AS BIGINT) AS negative_words FROM (
  SELECT upload_date, len(list_filter(regexp_split_to_array(trim(title), '\\s+'), lambda t: t IN {words}))
    + len(list_filter(regexp_split_to_array(trim(body), '\\s+'), lambda t: t IN {words})) AS negative FROM doc_posts
  WHERE (title || chr(10) || body) ILIKE ANY ('%AND%', '%QUE %', '%ein%') AND upload_date >= DATE '2024-02-01' AND upload_date <= DATE '2024-11-30') GROUP BY upload_date
  """.replace("{words}", "(" + ", ".join(f"'{w}'" for w in V.NEGATIVE_WORDS) + ")").replace(
      "(title || chr(10) || body) ILIKE ANY ('%AND%', '%QUE %', '%ein%')",
      "(title ILIKE '%AND%' OR body ILIKE '%AND%' OR title ILIKE '%QUE %' OR body ILIKE '%QUE %' OR title ILIKE '%ein%' OR body ILIKE '%ein%')"), "doc_posts")


@query("i11_negative_change_points", change_points_sql("keyword_negative", 7, 7, 1.1), "keyword_negative")
def i11(spark, sf):
    return keywords.negative_change_points(V.doc_posts(spark, sf), ["AND", "QUE ", "ein"], V.NEGATIVE_WORDS, "2024-02-01",
                                           "2024-11-30").select("upload_date", "cumulative", "z")


BASE_TERM, OTHER_TERM = "the", "la"
V.view("term_series", f"""SELECT d.upload_date, t.term, CAST(coalesce(c.weight, 0) AS DOUBLE) AS weight FROM (SELECT DISTINCT upload_date FROM doc_posts) d
  CROSS JOIN (SELECT unnest(['{BASE_TERM}', '{OTHER_TERM}']) AS term) t LEFT JOIN (
   SELECT upload_date, term, sum(weight) AS weight FROM all_term_rows GROUP BY 1, 2) c ON c.upload_date = d.upload_date AND c.term = t.term""", "doc_posts", "all_term_rows")
V.view("base_series", f"""SELECT *, row_number() OVER (ORDER BY upload_date) - 1 AS start, count(*) OVER () AS n FROM (
  SELECT upload_date, avg(weight) OVER (ORDER BY upload_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mean FROM term_series
  WHERE term = '{BASE_TERM}' AND upload_date > DATE '{TODAY}' - 365 AND upload_date <= DATE '{TODAY}')""", "term_series")
V.view("other_series", f"""SELECT list(mean ORDER BY upload_date) AS q, count(*) AS m FROM (
  SELECT upload_date, avg(weight) OVER (ORDER BY upload_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean FROM term_series
  WHERE term = '{OTHER_TERM}' AND upload_date > DATE '{TODAY}' - 10 AND upload_date <= DATE '{TODAY}')""", "term_series")


@query("i12_similar_period", f"""SELECT '{BASE_TERM}' AS term, start, round(d, 4) AS distance,
  round((q[1] - list_min(q)) / (list_max(q) - list_min(q)) * (list_max(w) - list_min(w)) + list_min(w), 4) AS first_rescaled FROM (
  SELECT start, q, w, round({V.dtw_sql('w', 'q', 'absolute')}, 9) AS d FROM (
   SELECT start, n, list(mean) OVER (ORDER BY upload_date ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w FROM base_series), other_series WHERE m > 0 AND start <= n - m)
  ORDER BY d, start LIMIT 1""", "base_series", "other_series", digits=4)
def i12(spark, sf):
    series = cut(keywords.term_series(V.doc_posts(spark, sf), {"title": 5, "body": 2, "comments": 0}, [BASE_TERM, OTHER_TERM]))
    best = keywords.similar_period(series, BASE_TERM, OTHER_TERM, TODAY)
    return best.select("term", "start", "distance", F.col("rescaled")[0].alias("first_rescaled"))


FEATURES = ["normalized_log_like_sum", "normalized_view_mean"]
V.view("filled_measures", """SELECT row_number() OVER (ORDER BY day) AS i, day AS upload_date, coalesce(normalized_log_like_sum, 0) AS f1, coalesce(normalized_view_mean, 0) AS f2 FROM (
  SELECT CAST(unnest(generate_series(CAST(min(upload_date) AS TIMESTAMP), CAST(max(upload_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM long_measures) d
  LEFT JOIN long_measures m ON m.upload_date = d.day""", "long_measures")
V.view("smooth_measures", """SELECT d.upload_date, d.i, sum(CASE WHEN h.i = 1 THEN 1 ELSE 0.05 END * pow(0.95, d.i - h.i) * h.f1)
  * sum(CASE WHEN h.i = 1 THEN 1 ELSE 0.05 END * pow(0.95, d.i - h.i) * h.f2) AS mul FROM filled_measures d JOIN filled_measures h ON h.i <= d.i
  GROUP BY d.upload_date, d.i""", "filled_measures")


@query("i13_feature_triggers", """SELECT CAST(upload_date AS VARCHAR) AS upload_date, round(mul, 6) AS mul FROM (
  SELECT *, avg(mul) OVER w AS m, stddev_samp(mul) OVER w AS s FROM smooth_measures WINDOW w AS (ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
  WHERE i > 10 AND abs(mul - m) > 2.3 * s + 1e-12 * abs(m)""", "smooth_measures")
def i13(spark, sf):
    daily = explore.daily_measures(interest.labelled_posts(V.long_posts(spark, sf), V.LONG_ASOF))
    return explore.feature_triggers(daily, FEATURES, window=10, k=2.3).select("upload_date", "mul")


@query("i14_curated_ranking", """SELECT c.car_name, c.issue, round(c.distance, 4) AS distance, CAST(p.upload_date + CAST(DATE '2001-08-01' - c.start AS INTEGER) AS VARCHAR) AS upload_date,
  round(p.score, 4) AS norm_graph_score FROM curated_ranked c JOIN known_points p ON p.car_name = c.car_name AND p.issue = c.issue""", "curated_ranked", "known_points", digits=4)
def i14(spark, sf):
    return curated(spark, sf).select("car_name", "issue", "distance", F.inline("moved"))
