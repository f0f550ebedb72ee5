"""Window functions and time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import ASOF, query
from catalog.queries_c import CASE_NEWS, TODAY, known_cases, recommended, stop_words
from catalog.queries_d import daily_negative
from signalpost.functions import series as S
from signalpost.functions.dtw import dtw
from signalpost.operators import aggregates, ranges, similar, windows
from signalpost.plans import explore, interest, keywords, serving

KEYS = ["car_name", "issue"]
EMAS = {"ema_view": ("avg_log_view", 0.05), "ema_like": ("sum_log_like", 0.02)}


@query("e01_ema", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(ema_view, 6) AS ema_view,
  round(ema_like, 6) AS ema_like FROM ema""", "ema")
def e01(spark, sf):
    daily = aggregates.daily_features_in_one_pass(V.labelled(spark, sf)).drop("n_posts")
    return windows.ema(daily, KEYS, "upload_date", EMAS).drop("avg_log_view", "sum_log_like")


@query("e01_ema_long_series", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(ema_view, 6) AS ema_view,
  round(ema_like, 6) AS ema_like FROM long_ema""", "long_ema")
def e01_long(spark, sf):
    daily = aggregates.daily_features_in_one_pass(interest.labelled_posts(V.long_posts(spark, sf), V.LONG_ASOF)).drop("n_posts")
    return windows.ema(daily, KEYS, "upload_date", EMAS).drop("avg_log_view", "sum_log_like")


@query("e02_interest_score", "SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score FROM series", "series")
def e02(spark, sf):
    return V.series(spark, sf).drop("n_posts")


@query("e03_triggers", """SELECT car_name, issue, CAST(trigger_date AS VARCHAR) AS upload_date, round(score, 6) AS score, n_posts FROM triggers""", "triggers")
def e03(spark, sf):
    return windows.detect_triggers(V.series(spark, sf), KEYS, "upload_date", "score")


@query("e03_triggers_long", """SELECT car_name, issue, CAST(trigger_date AS VARCHAR) AS upload_date, round(score, 6) AS score, n_posts FROM long_triggers""", "long_triggers")
def e03_long(spark, sf):
    return windows.detect_triggers(V.long_series(spark, sf), KEYS, "upload_date", "score")


@query("e04_two_sided_triggers", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score FROM (
  SELECT *, avg(score) OVER w AS m, stddev_samp(score) OVER w AS s, count(score) OVER w AS n,
    row_number() OVER (PARTITION BY car_name, issue ORDER BY upload_date) AS r FROM long_series
  WINDOW w AS (PARTITION BY car_name, issue ORDER BY upload_date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
  WHERE n = 8 AND r >= 9 AND abs(score - m) > 2 * s + 1e-12 * abs(m)""", "long_series")
def e04(spark, sf):
    return windows.detect_triggers(V.long_series(spark, sf), KEYS, "upload_date", "score", window=8, k=2.0, ddof=1,
                                   two_sided=True).drop("n_posts")


V.view("order_days", """SELECT upload_date, count(*) AS posts, CAST(sum(num_views) AS BIGINT) AS views FROM long_posts GROUP BY upload_date""", "long_posts")


def long_daily(spark, sf):
    return V.long_posts(spark, sf).groupBy("upload_date").agg(F.count("*").alias("posts"), F.sum("num_views").alias("views"))


@query("e05_rolling_mean", """SELECT CAST(upload_date AS VARCHAR) AS upload_date, CASE WHEN count(views) OVER w = 7 THEN round(avg(views) OVER w, 4) END AS full_week,
  round(avg(views) OVER v, 4) AS any_days FROM order_days
  WINDOW w AS (ORDER BY upload_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), v AS (ORDER BY upload_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", "order_days", digits=4)
def e05(spark, sf):
    df = windows.rolling_mean(long_daily(spark, sf), [], "upload_date", "views", 7, "full_week")
    return windows.rolling_mean(df, [], "upload_date", "views", 3, "any_days", 1).select("upload_date", "full_week", "any_days")


@query("e06_first_difference", """SELECT CAST(upload_date AS VARCHAR) AS upload_date, views - lag(views) OVER (ORDER BY upload_date) AS change
  FROM order_days""", "order_days")
def e06(spark, sf):
    return windows.diff(long_daily(spark, sf), [], "upload_date", "views", "change").select("upload_date", "change")


@query("e07_running_total", """SELECT CAST(upload_date AS VARCHAR) AS upload_date, CAST(sum(posts) OVER (ORDER BY upload_date) AS BIGINT) AS posts_so_far
  FROM order_days""", "order_days")
def e07(spark, sf):
    return windows.cumsum(long_daily(spark, sf), [], "upload_date", "posts", "posts_so_far").select("upload_date", "posts_so_far")


def change_points_sql(daily: str, n: int, least: int, threshold: float) -> str:
    return f"""SELECT CAST(upload_date AS VARCHAR) AS upload_date, cumulative, round(z, 6) AS z FROM (
  SELECT *, (gradient - avg(gradient) OVER ()) / stddev_samp(gradient) OVER () AS z FROM (
   SELECT *, smoothed - lag(smoothed) OVER (ORDER BY upload_date) AS gradient FROM (
    SELECT *, CASE WHEN count(*) OVER w >= {least} THEN avg(cumulative) OVER w END AS smoothed FROM (
     SELECT upload_date, CAST(sum(negative_words) OVER (ORDER BY upload_date) AS BIGINT) AS cumulative FROM {daily})
    WINDOW w AS (ORDER BY upload_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)))) WHERE abs(z) > {threshold}"""


@query("e08_change_points", change_points_sql("daily_negative", 7, 7, 1.1), "daily_negative")
def e08(spark, sf):
    return windows.change_points(daily_negative(spark, sf), "upload_date", "negative_words").select("upload_date", "cumulative", "z")


@query("e08_change_points_short", change_points_sql("daily_negative", 3, 1, 1.3), "daily_negative")
def e08_short(spark, sf):
    return windows.change_points(daily_negative(spark, sf), "upload_date", "negative_words", 3, 1, 1.3).select("upload_date", "cumulative", "z")


RANKED = """SELECT car_name, issue, rank, case_car, case_issue, CAST(trigger_date AS VARCHAR) AS trigger_date, round(distance, 6) AS distance FROM ranked"""


@query("e09_top_three_cases", RANKED, "ranked")
def e09(spark, sf):
    from signalpost.session import cut
    s = cut(V.series(spark, sf))
    return interest.ranked_cases(cut(interest.monitored_series(s, ASOF)), cut(interest.past_cases(s)))


@query("e10_date_spine", """SELECT car_name, issue, CAST(day AS VARCHAR) AS upload_date, coalesce(s.n_posts, 0) AS n_posts, round(coalesce(s.score, 0), 6) AS score FROM (
  SELECT car_name, issue, CAST(unnest(generate_series(CAST(min(upload_date) AS TIMESTAMP), CAST(max(upload_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM long_series GROUP BY 1, 2) d LEFT JOIN long_series s USING (car_name, issue) WHERE s.upload_date = d.day OR s.upload_date IS NULL
  """.replace("LEFT JOIN long_series s USING (car_name, issue) WHERE s.upload_date = d.day OR s.upload_date IS NULL",
              "LEFT JOIN long_series s ON s.car_name = d.car_name AND s.issue = d.issue AND s.upload_date = d.day")
       .replace("SELECT car_name, issue, CAST(day", "SELECT d.car_name, d.issue, CAST(day"), "long_series")
def e10(spark, sf):
    return windows.date_spine(V.long_series(spark, sf), KEYS, "upload_date", ["score", "n_posts"])


SLOPE = 0.005
V.view("slopes", """SELECT car_name, issue, upload_date, r, CASE WHEN b IS NULL THEN a - score WHEN a IS NULL THEN score - b ELSE (a - b) / 2 END AS slope FROM (
  SELECT *, lag(score) OVER w AS b, lead(score) OVER w AS a, row_number() OVER w AS r FROM long_series
  WINDOW w AS (PARTITION BY car_name, issue ORDER BY upload_date))""", "long_series")
# Alarms are kept one after the other: each step looks for the first steep day after the quiet days.
ALARMS = f"""WITH RECURSIVE steep AS (SELECT car_name, issue, upload_date FROM slopes WHERE r > 1 AND abs(slope) > {SLOPE}),
  kept AS (SELECT car_name, issue, min(upload_date) AS upload_date FROM steep GROUP BY 1, 2
    UNION ALL SELECT car_name, issue, upload_date FROM (
      SELECT k.car_name, k.issue, min(s.upload_date) AS upload_date FROM kept k JOIN steep s
        ON s.car_name = k.car_name AND s.issue = k.issue AND s.upload_date > k.upload_date + 15 GROUP BY k.car_name, k.issue))
  SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date FROM kept"""


@query("e11_slope_alarms", f"SELECT * FROM ({ALARMS})", "slopes")
def e11(spark, sf):
    return windows.slope_alarms(V.long_series(spark, sf), KEYS, "upload_date", "score", SLOPE, 15)


@query("e12_sliding_windows", """SELECT start, len(w) AS points, round(w[1], 4) AS first_value, round(w[-1], 4) AS last_value, round(list_sum(w), 4) AS total FROM (
  SELECT row_number() OVER (ORDER BY upload_date) - 1 AS start, list(CAST(negative_words AS DOUBLE)) OVER (ORDER BY upload_date ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w,
    count(*) OVER () AS n FROM daily_negative) WHERE start <= n - 7""", "daily_negative", digits=4)
def e12(spark, sf):
    daily = daily_negative(spark, sf).withColumn("v", F.col("negative_words").cast("double"))
    w = windows.sliding_windows(daily, [], "upload_date", "v", 10, 7)
    total = F.aggregate("window", F.lit(0.0), lambda a, x: a + x)
    return w.select("start", F.size("window").alias("points"), F.col("window")[0].alias("first_value"),
                    F.try_element_at("window", F.lit(-1)).alias("last_value"), total.alias("total"))


@query("e13_rescale", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date,
  round((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0) * (max(n_posts) OVER w - min(n_posts) OVER w) + min(n_posts) OVER w, 6) AS rescaled
  FROM series WINDOW w AS (PARTITION BY car_name, issue)""", "series")
def e13(spark, sf):
    nested = V.series(spark, sf).groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("upload_date", "score", "n_posts"))).alias("s"))
    pick = lambda name: F.transform("s", lambda x: x[name].cast("double"))
    moved = F.arrays_zip(F.transform("s", lambda x: x["upload_date"]).alias("upload_date"),
                         S.rescale(pick("score"), pick("n_posts")).alias("rescaled"))
    return nested.select(*KEYS, F.inline(moved))


V.view("query_series", """SELECT list(score ORDER BY upload_date) AS q, count(*) AS m FROM (
  SELECT * FROM series WHERE car_name = 'car0' AND issue = 'error' AND upload_date > DATE '2024-01-20')""", "series")


@query("e14_best_subsequence", f"""SELECT car_name, issue, arg_min(start, (d, start)) AS start, round(min(d), 6) AS distance FROM (
  SELECT car_name, issue, start, round({V.dtw_sql('w', 'q', 'absolute')}, 9) AS d FROM (
   SELECT car_name, issue, row_number() OVER (PARTITION BY car_name, issue ORDER BY upload_date) - 1 AS start, count(*) OVER (PARTITION BY car_name, issue) AS n,
     list(score) OVER (PARTITION BY car_name, issue ORDER BY upload_date ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w FROM series), query_series
  WHERE start <= n - m) GROUP BY 1, 2""", "series", "query_series")
def e14(spark, sf):
    s = V.series(spark, sf)
    mine = s.filter((F.col("car_name") == "car0") & (F.col("issue") == "error") & (F.col("upload_date") > "2024-01-20"))
    points = mine.agg(F.sort_array(F.collect_list(F.struct("upload_date", "score"))).alias("p"))
    query_array = points.select(F.transform("p", lambda x: x["score"])).scalar()
    return similar.best_windows(s, KEYS, "upload_date", "score", query_array, 10).drop("window")


@query("e15_rising_terms", """SELECT term, short_count, expected_short_count, long_count, round(poisson_score, 6) AS poisson_score FROM rising""", "rising")
def e15(spark, sf):
    from signalpost.functions.text import weighted_terms
    found = weighted_terms(V.doc_posts(spark, sf).select("upload_date", *keywords.WEIGHTS), keywords.WEIGHTS)
    counts = aggregates.term_windows(found, "upload_date", TODAY)
    return keywords.rising_terms(keywords.drop_terms(counts, stop_words(spark)), 9)


HALVES = """SELECT car_name, issue, list(score ORDER BY upload_date) FILTER (WHERE upload_date <= DATE '2024-01-15') AS a,
  list(score ORDER BY upload_date) FILTER (WHERE upload_date > DATE '2024-01-15') AS b FROM series GROUP BY 1, 2"""


@query("e16_dtw_distance", f"""SELECT car_name, issue, round({V.dtw_sql('a', 'b')}, 6) AS euclidean, round({V.dtw_sql('a', 'b', 'absolute')}, 6) AS absolute
  FROM ({HALVES})""", "series")
def e16(spark, sf):
    nested = aggregates.nest_series(V.series(spark, sf), KEYS)
    border = F.lit("2024-01-15").cast("date")
    early = S.scores_until(F.col("series"), border)
    late = S.scores(F.filter("series", lambda x: x["upload_date"] > border))
    return nested.select(*KEYS, early.alias("a"), late.alias("b")).select(
        *KEYS, dtw(F.col("a"), F.col("b")).alias("euclidean"), dtw(F.col("a"), F.col("b"), "absolute").alias("absolute"))


CAR, ISSUE = "1-URGENT", "O"
V.view("curated", f"""SELECT car_name, issue, list(score ORDER BY upload_date) AS s, min(upload_date) AS start FROM known_points GROUP BY car_name, issue, news_date""", "known_points")
V.view("curated_ranked", f"""SELECT c.car_name, c.issue, c.start, round({V.dtw_sql('c.s', 'q.s')}, 9) AS distance FROM curated c, (
  SELECT list(score ORDER BY upload_date) AS s FROM long_series WHERE car_name = '{CAR}' AND issue = '{ISSUE}'
  AND upload_date BETWEEN DATE '2001-08-01' - 90 AND DATE '2001-08-01') q ORDER BY distance, c.car_name, c.issue LIMIT 5""", "curated", "long_series")


def curated(spark, sf):
    return explore.rank_curated(known_cases(spark, sf), V.long_series(spark, sf), CAR, ISSUE, "2001-08-01 00:00")


@query("e17_rank_known_cases", """SELECT car_name, issue, CAST(start AS VARCHAR) AS recommend_start_date, round(distance, 4) AS distance FROM curated_ranked""", "curated_ranked", digits=4)
def e17(spark, sf):
    return curated(spark, sf).select("car_name", "issue", "recommend_start_date", "distance")


@query("e18_split_range", """SELECT event_id, part, strftime(start_datetime, '%Y-%m-%d %H:%M:%S') AS start_datetime,
  strftime(start_datetime + INTERVAL 1 HOUR * len - INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS end_datetime FROM (
  SELECT *, date_trunc('hour', ts + INTERVAL 9 HOUR) - INTERVAL 1 HOUR * CAST(sum(len) OVER (PARTITION BY event_id ORDER BY part) AS BIGINT) AS start_datetime FROM (
   SELECT event_id, ts, part, hours // parts + CASE WHEN part < hours % parts THEN 1 ELSE 0 END AS len FROM (
    SELECT *, unnest(range(parts)) AS part FROM (SELECT event_id, ts, 24 + user_id % 30 AS hours, 4 + user_id % 5 AS parts FROM events))))""")
def e18(spark, sf):
    e = V.table(spark, sf, "events").select("event_id", "ts", "user_id")
    out = ranges.split_range(e, F.col("ts"), 24 + F.col("user_id") % 30, 4 + F.col("user_id") % 5)
    return out.select("event_id", "part", "start_datetime", "end_datetime")


@query("e19_split_months", """SELECT custkey, strftime(greatest(a, m), '%Y-%m-%d %H:%M:%S') AS start_datetime,
  strftime(least(b, m + INTERVAL 1 MONTH - INTERVAL 1 MINUTE), '%Y-%m-%d %H:%M:%S') AS end_datetime FROM (
  SELECT *, unnest(generate_series(date_trunc('month', a)::TIMESTAMP, date_trunc('month', b)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM (
   SELECT o_custkey AS custkey, min(o_orderdate) + INTERVAL 10 HOUR AS a, max(o_orderdate) + INTERVAL 12 HOUR + INTERVAL 30 MINUTE AS b FROM orders GROUP BY 1))""")
def e19(spark, sf):
    o = V.table(spark, sf, "orders")
    plus = lambda c, s: F.timestamp_seconds(F.unix_timestamp(c) + s)
    spans = o.groupBy(F.col("o_custkey").alias("custkey")).agg(
        plus(F.min("o_orderdate").cast("timestamp"), 36000).alias("a"), plus(F.max("o_orderdate").cast("timestamp"), 45000).alias("b"))
    return ranges.split_months(spans, F.col("a"), F.col("b")).select("custkey", "start_datetime", "end_datetime")


@query("e20_comment_threads", """SELECT conv_id, thread, 0 AS part, string_agg(text, chr(10) ORDER BY turn) AS text, count(*) AS comments FROM (
  SELECT *, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS thread FROM conversations)
  GROUP BY conv_id, thread""")
def e20(spark, sf):
    return windows.threads(V.table(spark, sf, "conversations"), "conv_id", "turn", F.col("role") == "user", "text")


@query("e21_news_date_mapping", f"""SELECT url, recommend_car_name, recommend_issue, CAST(start AS VARCHAR) AS recommend_start_date,
  CAST(DATE '2024-01-31' + CAST(news_date - start AS INTEGER) AS VARCHAR) AS chart_date FROM ({CASE_NEWS})""", "ranked", "news")
def e21(spark, sf):
    return serving.case_news(recommended(spark, sf), V.news(spark, sf), ASOF).select(
        "url", "recommend_car_name", "recommend_issue", "recommend_start_date", "chart_date")
