"""Views over the given tables, as Spark builders and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import ASOF, view
from signalpost.plans import interest

DICTIONARY = [
    ("alpha", ["the ", "with"]),
    ("beta", ["que", "with", "ent"]),
    ("gamma", ["sch", "und "]),
    ("delta", ["zzzz", "qqqq"]),
    ("epsilon", ["ción", "los", "para"]),
]
STOP_WORDS = ["the", "and", "of", "to", "in", "de", "la", "le", "que", "un"]
NEGATIVE_WORDS = ["the", "with", "this", "from", "are", "que", "des", "la", "und", "para"]
POST_DICTIONARY = [("fault", ["error", "fault"]), ("buying", ["purchase", "signup"]), ("any", ["k1", "k2", "error"])]
URL_RULES = {"c0": "&search_pos=", "c1": "&bm="}
ALIASES = {"K0": "car0", "K1": "car1", "K2": "car2", "K3": "car3", "K4": "car4", "ar5": "car5"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its times are in UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"})



def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "event_type",
        F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("url"),
        "ts", F.to_date("ts").alias("upload_date"), F.date_format("ts", "HH:mm:ss").alias("upload_time"),
        F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("community"),
        F.concat(F.lit("car"), (F.col("user_id") % 6).cast("string")).alias("car_name"),
        F.when(F.col("event_id") % 10 == 3, F.lit("[]"))
        .when(F.col("event_id") % 5 == 0, F.concat(F.lit('["'), F.col("event_type"), F.lit('","recall"]')))
        .otherwise(F.concat(F.lit('["'), F.col("event_type"), F.lit('"]'))).alias("issue"),
        F.round(F.col("value") * 100).cast("bigint").alias("num_views"),
        F.get_json_object("props", "$.k").cast("bigint").alias("num_likes"))


view("posts", """SELECT event_id, 'u' || event_id AS url, ts, CAST(ts AS DATE) AS upload_date,
  strftime(ts, '%H:%M:%S') AS upload_time, 'c' || (user_id % 3) AS community, 'car' || (user_id % 6) AS car_name,
  CASE WHEN event_id % 10 = 3 THEN '[]' WHEN event_id % 5 = 0 THEN '["' || event_type || '","recall"]'
       ELSE '["' || event_type || '"]' END AS issue,
  CASE WHEN event_id % 10 = 3 THEN []::VARCHAR[] WHEN event_id % 5 = 0 THEN [event_type, 'recall'] ELSE [event_type] END AS issues,
  CAST(round(value * 100) AS BIGINT) AS num_views, CAST(json_extract(props, '$.k') AS BIGINT) AS num_likes
  FROM events""")


def texts_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    at = F.instr("text", "\n")
    return d.select("doc_id", "lang", F.substring_index("text", "\n", 1).alias("title"),
                    F.when(at > 0, F.substring(F.col("text"), at + 1, F.length("text"))).otherwise("").alias("body"))


view("doc_texts", """SELECT doc_id, lang, split_part(text, chr(10), 1) AS title,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body FROM documents""")


def posts_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    p = posts(spark, sf_dir).withColumn("doc_id", F.col("event_id") % size)
    return p.join(texts_of_documents(spark, sf_dir).drop("lang"), "doc_id", "left").drop("doc_id")


view("posts_with_text", """SELECT p.*, d.title, d.body FROM posts p
  LEFT JOIN doc_texts d ON d.doc_id = p.event_id % (SELECT count(*) FROM documents)""", "posts", "doc_texts")


def long_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("url"),
        F.to_date("o_orderdate").alias("upload_date"), F.lit("12:00:00").alias("upload_time"),
        F.concat(F.lit("c"), (F.col("o_custkey") % 3).cast("string")).alias("community"),
        F.col("o_orderpriority").alias("car_name"), F.concat(F.lit('["'), F.col("o_orderstatus"), F.lit('"]')).alias("issue"),
        F.round("o_totalprice").cast("bigint").alias("num_views"), (F.col("o_custkey") % 100).alias("num_likes"))


view("long_posts", """SELECT 'o' || o_orderkey AS url, CAST(o_orderdate AS DATE) AS upload_date, '12:00:00' AS upload_time,
  'c' || (o_custkey % 3) AS community, o_orderpriority AS car_name, '["' || o_orderstatus || '"]' AS issue,
  [o_orderstatus] AS issues, CAST(round(o_totalprice) AS BIGINT) AS num_views, o_custkey % 100 AS num_likes FROM orders""")


def doc_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = texts_of_documents(spark, sf_dir)
    return d.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("upload_date"),
        "title", "body", F.lit("").alias("comments"), F.col("lang").alias("community"))


view("doc_posts", """SELECT 'd' || doc_id AS url, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS upload_date,
  title, body, '' AS comments, lang AS community FROM doc_texts""", "doc_texts")


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    n = F.col("num_views")
    whole = n.cast("string")
    tenths = F.concat(F.floor(n / 10000).cast("string"), F.lit("."), (F.floor(n / 1000) % 10).cast("string"), F.lit("만"))
    event_type = F.col("event_type")
    return posts(spark, sf_dir).select(
        "event_id", "ts",
        F.when(F.col("community") == "c0", F.date_format("ts", "yyyy.MM.dd. HH:mm"))
        .when(F.col("community") == "c1", F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .otherwise(F.date_format("ts", "yyyy.MM.dd (HH:mm)")).alias("Date"),
        F.date_format("ts", "HH:mm").alias("Time"),
        F.when(e % 13 != 0, F.concat(F.lit("Title "), event_type)).alias("Title"),
        F.concat(event_type, F.lit(" k"), F.col("num_likes").cast("string")).alias("Body"),
        F.when(e % 17 != 0, F.concat(F.lit("comment "), e.cast("string"))).alias("Comment"),
        F.when(e % 101 == 0, "").when(e % 11 == 0, F.concat(F.lit("조회 "), whole)).when(e % 7 == 0, tenths)
        .when(e % 3 == 0, F.format_number(n, 0)).otherwise(whole).alias("View"),
        F.col("num_likes").cast("string").alias("Like"), F.col("community").alias("Community"),
        F.when(F.substring("car_name", 4, 1) == "5", F.lit("ar5"))
        .otherwise(F.concat(F.lit("K"), F.substring("car_name", 4, 1))).alias("CarName"),
        F.concat(F.lit("http://x/"), F.floor(e / 2).cast("string"),
                 F.when(F.col("community") == "c0", F.concat(F.lit("&search_pos="), e.cast("string")))
                 .when(F.col("community") == "c1", F.concat(F.lit("&bm="), e.cast("string"))).otherwise("")).alias("Url"))


view("raw_posts", """SELECT p.event_id, p.ts,
  CASE p.community WHEN 'c0' THEN strftime(p.ts, '%Y.%m.%d. %H:%M') WHEN 'c1' THEN strftime(p.ts, '%Y-%m-%d %H:%M')
       ELSE strftime(p.ts, '%Y.%m.%d (%H:%M)') END AS "Date",
  strftime(p.ts, '%H:%M') AS "Time",
  CASE WHEN p.event_id % 13 <> 0 THEN 'Title ' || e.event_type END AS "Title",
  e.event_type || ' k' || p.num_likes AS "Body",
  CASE WHEN p.event_id % 17 <> 0 THEN 'comment ' || p.event_id END AS "Comment",
  CASE WHEN p.event_id % 101 = 0 THEN '' WHEN p.event_id % 11 = 0 THEN '조회 ' || num_views
       WHEN p.event_id % 7 = 0 THEN (num_views // 10000) || '.' || (num_views // 1000 % 10) || '만'
       WHEN p.event_id % 3 = 0 THEN format('{:,}', num_views) ELSE CAST(num_views AS VARCHAR) END AS "View",
  CAST(num_likes AS VARCHAR) AS "Like", community AS "Community",
  CASE WHEN car_name = 'car5' THEN 'ar5' ELSE 'K' || substr(car_name, 4, 1) END AS "CarName",
  'http://x/' || (p.event_id // 2) || CASE community WHEN 'c0' THEN '&search_pos=' || p.event_id
       WHEN 'c1' THEN '&bm=' || p.event_id ELSE '' END AS "Url"
  FROM posts p JOIN events e ON p.event_id = e.event_id""", "posts")

# Each view counter is written in one of the notations above; its number is known from the row itself.
view("clean_raw", """SELECT event_id, ts, regexp_extract("Date", '(\\S+)', 1) AS "Date", "Time", coalesce("Title", '') AS "Title",
  "Body", coalesce("Comment", '') AS "Comment",
  CASE WHEN "View" = '' THEN NULL WHEN "View" LIKE '%만' THEN CAST(trunc(CAST(replace("View", '만', '') AS DOUBLE) * 10000) AS BIGINT)
       ELSE num_views END AS "View",
  num_likes AS "Like", "Community", car_name AS "CarName",
  'http://x/' || (event_id // 2) AS "Url",
  to_json(list_filter(['fault', 'buying', 'any'], lambda l: CASE l
     WHEN 'fault' THEN contains(t, 'error') OR contains(t, 'fault')
     WHEN 'buying' THEN contains(t, 'purchase') OR contains(t, 'signup')
     ELSE contains(t, 'k1') OR contains(t, 'k2') OR contains(t, 'error') END)) AS "Issue"
  FROM (SELECT r.*, p.num_views, p.num_likes, p.car_name, coalesce("Title", '') || "Body" AS t
        FROM raw_posts r JOIN posts p USING (event_id))""", "raw_posts")
view("deduped_raw", """SELECT * FROM clean_raw QUALIFY row_number() OVER (PARTITION BY "Url"
  ORDER BY "Date", "Time", "View" DESC NULLS LAST, "Title", "Body", "Like") = 1""", "clean_raw")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    following = e.select((F.col("event_id") - 1).alias("event_id"), F.col("event_type").alias("issue"))
    car = F.concat(F.lit("car"), (F.col("user_id") % 6).cast("string"))
    rows = e.filter(F.col("event_type") == "error").join(following, "event_id", "left")
    return rows.select(
        F.to_date("ts").alias("upload_date"), F.date_format("ts", "HH:mm").alias("upload_time"),
        F.concat(F.lit("News "), F.col("event_id").cast("string")).alias("title"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("car0 "), car)).otherwise(car).alias("car_name"), "issue",
        F.concat(F.lit("about "), car).alias("summary"), F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("url"),
        (F.col("event_id") % 3 != 0).alias("is_trigger"))


view("news", """SELECT CAST(e.ts AS DATE) AS upload_date, strftime(e.ts, '%H:%M') AS upload_time, 'News ' || e.event_id AS title,
  CASE WHEN e.event_id % 4 = 0 THEN 'car0 ' ELSE '' END || 'car' || (e.user_id % 6) AS car_name, f.event_type AS issue,
  'about car' || (e.user_id % 6) AS summary, 'n' || e.event_id AS url, e.event_id % 3 <> 0 AS is_trigger
  FROM events e LEFT JOIN events f ON f.event_id = e.event_id + 1 WHERE e.event_type = 'error'""")


# ---- interest series ----

def scoring_views(prefix: str, source: str, asof: str) -> None:
    day = asof[:10]
    view(f"{prefix}labelled", f"""SELECT *, ln(1 + num_views) AS log_views, ln(1 + num_likes) AS log_likes FROM (
      SELECT url, upload_date, upload_time, community, car_name, unnest(issues) AS issue,
        CASE WHEN upload_date >= DATE '{day}' - 2 THEN num_views * (pow(1.2, -age) * 3 + 1) ELSE CAST(num_views AS DOUBLE) END AS num_views,
        CASE WHEN upload_date >= DATE '{day}' - 2 THEN num_likes * (pow(1.2, -age) * 3 + 1) ELSE CAST(num_likes AS DOUBLE) END AS num_likes
      FROM (SELECT *, (epoch(TIMESTAMP '{day} 00:00:00') - epoch(upload_date + CAST(upload_time AS TIME))) / 3600.0 AS age FROM {source})
      WHERE len(issues) > 0)""", source)
    view(f"{prefix}bounds", f"""SELECT community, min(num_views) AS min_view, max(num_views) AS max_view,
      min(num_likes) AS min_like, max(num_likes) AS max_like, min(log_views) AS min_log_view, max(log_views) AS max_log_view,
      min(log_likes) AS min_log_like, max(log_likes) AS max_log_like FROM {prefix}labelled GROUP BY community""", f"{prefix}labelled")
    view(f"{prefix}normalized", f"""SELECT p.*,
      (num_views - min_view) / nullif(max_view - min_view, 0) AS normalized_view,
      (num_likes - min_like) / nullif(max_like - min_like, 0) AS normalized_like,
      (log_views - min_log_view) / nullif(max_log_view - min_log_view, 0) AS normalized_log_view,
      (log_likes - min_log_like) / nullif(max_log_like - min_log_like, 0) AS normalized_log_like
      FROM {prefix}labelled p JOIN {prefix}bounds b USING (community)""", f"{prefix}bounds")
    view(f"{prefix}daily", f"""SELECT car_name, issue, upload_date, avg(coalesce(normalized_log_view, 0)) AS avg_log_view,
      sum(coalesce(normalized_log_like, 0)) AS sum_log_like, count(*) AS n_posts,
      row_number() OVER (PARTITION BY car_name, issue ORDER BY upload_date) AS i
      FROM {prefix}normalized GROUP BY car_name, issue, upload_date""", f"{prefix}normalized")
    view(f"{prefix}ema", f"""SELECT d.car_name, d.issue, d.upload_date, d.n_posts,
      sum(CASE WHEN h.i = 1 THEN 1 ELSE 0.05 END * pow(0.95, d.i - h.i) * h.avg_log_view) AS ema_view,
      sum(CASE WHEN h.i = 1 THEN 1 ELSE 0.02 END * pow(0.98, d.i - h.i) * h.sum_log_like) AS ema_like
      FROM {prefix}daily d JOIN {prefix}daily h ON h.car_name = d.car_name AND h.issue = d.issue AND h.i <= d.i
      GROUP BY d.car_name, d.issue, d.upload_date, d.n_posts""", f"{prefix}daily")
    view(f"{prefix}series", f"SELECT *, ema_view * ema_like AS score FROM {prefix}ema", f"{prefix}ema")
    view(f"{prefix}triggers", f"""SELECT car_name, issue, upload_date AS trigger_date, score, n_posts FROM (
      SELECT *, avg(score) OVER w AS m, stddev_pop(score) OVER w AS s, count(score) OVER w AS n FROM {prefix}series
      WINDOW w AS (PARTITION BY car_name, issue ORDER BY upload_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
      WHERE n = 7 AND score - m > 2.1 * s + 1e-12 * abs(m)""", f"{prefix}series")


scoring_views("", "posts", ASOF)
scoring_views("long_", "long_posts", "2002-01-01 00:00")
view("trigger_urls", """SELECT t.car_name, t.issue, t.trigger_date AS upload_date, l.url FROM triggers t
  JOIN labelled l ON l.car_name = t.car_name AND l.issue = t.issue AND l.upload_date = t.trigger_date""", "triggers", "labelled")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interest.labelled_posts(posts(spark, sf_dir), ASOF)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interest.interest_series(posts(spark, sf_dir), ASOF)


LONG_ASOF = "2002-01-01 00:00"


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interest.interest_series(long_posts(spark, sf_dir), LONG_ASOF)


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interest.all_triggers(series(spark, sf_dir))


def dated_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triggers in the columns of the stored trigger table."""
    hits = interest.recent_triggers(series(spark, sf_dir), ASOF)
    return hits.select("car_name", "issue", "upload_date", "is_trigger", "n_posts")


def trigger_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triggers with one row per URL."""
    from signalpost.functions.times import last_days
    from signalpost.functions.values import has_label
    from signalpost.operators.tables import attach_urls
    recent = posts(spark, sf_dir).filter(last_days(F.col("upload_date"), ASOF, 90, closed=True))
    p = recent.select("car_name", "issue", "upload_date", "url").filter(has_label(F.col("issue")))
    return attach_urls(interest.explode_issues(p), dated_triggers(spark, sf_dir))


def dtw_sql(a: str, b: str, cost: str = "squared") -> str:
    """Warping distance of two DuckDB lists as nested folds over rows and columns."""
    cell = "(x[1] - e[1]) * (x[1] - e[1])" if cost == "squared" else "abs(x[1] - e[1])"
    fold = (f"list_reduce(list_transform({a}, lambda x: [x]), lambda p, x: list_reduce(list_transform({b}, "
            f"lambda v, j: [v, CAST(j AS DOUBLE)]), lambda r, e: list_append(r, {cell} + least(r[len(r)], "
            f"p[CAST(e[2] AS BIGINT)], p[CAST(e[2] AS BIGINT) + 1])), ['infinity'::DOUBLE]), "
            f"list_concat([0.0::DOUBLE], list_transform({b}, lambda v: 'infinity'::DOUBLE)))[-1]")
    return f"sqrt({fold})" if cost == "squared" else fold


view("case_points", """SELECT t.car_name, t.issue, t.trigger_date, d.upload_date, d.score FROM triggers t
  JOIN series d ON d.car_name = t.car_name AND d.issue = t.issue
  AND d.upload_date BETWEEN t.trigger_date - 90 AND t.trigger_date + 90""", "triggers", "series")
view("cases", """SELECT car_name, issue, trigger_date,
  list(score ORDER BY upload_date) FILTER (WHERE upload_date <= trigger_date) AS s FROM case_points GROUP BY ALL""", "case_points")
view("monitored", f"""SELECT car_name, issue, list(score ORDER BY upload_date) AS s FROM series
  WHERE upload_date BETWEEN DATE '{ASOF[:10]}' - 90 AND DATE '{ASOF[:10]}' GROUP BY car_name, issue""", "series")
view("ranked", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY car_name, issue
    ORDER BY distance, case_car, case_issue, trigger_date) AS rank FROM (
  SELECT m.car_name, m.issue, c.car_name AS case_car, c.issue AS case_issue, c.trigger_date,
    round({dtw_sql('m.s', 'c.s')}, 9) AS distance
  FROM monitored m JOIN cases c ON m.car_name <> c.car_name AND m.issue <> c.issue)) WHERE rank <= 3""", "monitored", "cases")
