"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import ASOF, query
from catalog.queries_a import FEED_SQL, feed_payloads
from signalpost.functions import series as S
from signalpost.functions import text, times, values
from signalpost.operators import aggregates
from signalpost.operators.tables import top_k
from signalpost.plans import ingest, interest, keywords, serving
from signalpost.sources import feeds


@query("b01_clean_count", """SELECT event_id, "View" AS num_views FROM (
  SELECT c.event_id, CASE WHEN r."View" LIKE '조회 %' THEN NULL ELSE c."View" END AS "View"
  FROM clean_raw c JOIN raw_posts r USING (event_id))""", "clean_raw")
def b01(spark, sf):
    return V.raw_posts(spark, sf).select("event_id", values.clean_count(F.col("View")).alias("num_views"))


@query("b02_strip_prefix", """SELECT event_id, replace("View", '조회 ', '') AS views FROM raw_posts""", "raw_posts")
def b02(spark, sf):
    return V.raw_posts(spark, sf).select("event_id", values.strip_prefix(F.col("View")).alias("views"))


@query("b03_coerce_long", """SELECT event_id, CAST(trunc(TRY_CAST("View" AS DOUBLE)) AS BIGINT) AS views FROM raw_posts""", "raw_posts")
def b03(spark, sf):
    return V.raw_posts(spark, sf).select("event_id", values.coerce_long(F.col("View")).alias("views"))


@query("b04_clean_url", """SELECT event_id, CASE "Community" WHEN 'c0' THEN regexp_replace("Url", '&search_pos=.*', '')
  WHEN 'c1' THEN regexp_replace("Url", '&bm=.*', '') ELSE "Url" END AS url FROM raw_posts""", "raw_posts")
def b04(spark, sf):
    return V.raw_posts(spark, sf).select("event_id", values.clean_url(F.col("Url"), F.col("Community"), V.URL_RULES).alias("url"))


@query("b05_null_fill", """SELECT event_id, coalesce("Title", '') AS title, coalesce("Comment", '') AS comments FROM raw_posts""", "raw_posts")
def b05(spark, sf):
    return V.raw_posts(spark, sf).na.fill("").select("event_id", F.col("Title").alias("title"), F.col("Comment").alias("comments"))


@query("b06_date_part", """SELECT event_id, split_part("Date", ' ', 1) AS day FROM raw_posts""", "raw_posts")
def b06(spark, sf):
    return V.raw_posts(spark, sf).select("event_id", times.date_part_text(F.col("Date")).alias("day"))


def _notations():
    """The event time in the notation of one of six kinds of sources."""
    ts = F.col("ts")
    shifted = F.timestamp_seconds(F.unix_timestamp(ts) + 9 * 3600)
    forms = [F.date_format(ts, "yyyy.MM.dd"), F.date_format(ts, "yyyy.MM.dd. HH:mm"),
             F.date_format(ts, "yyyy.MM.dd '(Mon)' HH:mm"), F.date_format(ts, "yyyy-MM-dd HH:mm"),
             F.date_format(shifted, "yyyy-MM-dd HH:mm:ss'+09:00'"), F.date_format(shifted, "EEE, d MMM yyyy HH:mm:ss' +0900'")]
    out = F.lit("no date")
    for kind, form in enumerate(forms):
        out = F.when(F.col("event_id") % 7 == kind, form).otherwise(out)
    return out


NOTATIONS = {"s0": [times.DOT_DATE], "s1": [times.DOT_DATE_TIME], "s2": [times.DOT_TIME], "s3": [times.DASH_TIME],
             "s4": [times.ISO_ZONE], "s5": [times.MAIL], "s6": [times.DASH_TIME, times.DOT_TIME]}


@query("b07_parse_dt", """SELECT event_id, CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%d 00:00:00')
  WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:00') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:00')
  WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:00') WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS posted FROM events""")
def b07(spark, sf):
    e = V.table(spark, sf, "events")
    source = F.concat(F.lit("s"), (F.col("event_id") % 7).cast("string"))
    return e.select("event_id", times.parse_dt(_notations(), source, NOTATIONS).alias("posted"))


@query("b08_engagement_boost", """SELECT url, num_views, num_likes FROM (
  SELECT url, CASE WHEN upload_date >= DATE '2024-01-29' THEN num_views * (pow(1.2, -age) * 3 + 1) ELSE num_views END AS num_views,
    CASE WHEN upload_date >= DATE '2024-01-29' THEN num_likes * (pow(1.2, -age) * 3 + 1) ELSE num_likes END AS num_likes
  FROM (SELECT *, date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-01-31 00:00:00') / 3600.0 AS age FROM posts))
  """.replace("SELECT url, num_views, num_likes FROM", "SELECT url, round(num_views, 6) AS num_views, round(num_likes, 6) AS num_likes FROM", 1), "posts")
def b08(spark, sf):
    return interest.boost_recent(V.posts(spark, sf), ASOF).select("url", "num_views", "num_likes")


@query("b09_compose_ts", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS with_seconds,
  strftime(ts, '%Y-%m-%d %H:%M:00') AS with_minutes FROM events""")
def b09(spark, sf):
    e = V.table(spark, sf, "events")
    return e.select("event_id", times.compose_ts(F.to_date("ts"), F.date_format("ts", "HH:mm:ss")).alias("with_seconds"),
                    times.compose_ts(F.to_date("ts"), F.date_format("ts", "HH:mm")).alias("with_minutes"))


@query("b10_value_alias", """SELECT "CarName" AS code, CASE WHEN "CarName" = 'ar5' THEN 'car5' WHEN "CarName" = 'K4' THEN NULL
  ELSE 'car' || substr("CarName", 2) END AS car_name, count(*) AS posts, count(*) FILTER (WHERE "CarName" = 'K4') AS unknown
  FROM raw_posts GROUP BY 1, 2""", "raw_posts")
def b10(spark, sf):
    mapping = {k: v for k, v in V.ALIASES.items() if k != "K4"}
    df = values.map_values(V.raw_posts(spark, sf), "CarName", mapping, "car_name")
    return df.groupBy(F.col("CarName").alias("code"), "car_name").agg(
        F.count("*").alias("posts"), F.count_if(F.col("car_name").isNull()).alias("unknown"))


@query("b11_canonical_columns", """SELECT "Date" AS upload_date, "Title" AS title, "Body" AS body, 'cafe' AS community,
  "CarName" AS car_name, "Url" AS url FROM raw_posts""", "raw_posts")
def b11(spark, sf):
    mapping = {"Date": "upload_date", "Title": "title", "Body": "body", "CarName": "car_name", "Url": "url"}
    return values.to_canonical(V.raw_posts(spark, sf), mapping, {"community": "cafe"},
                               ["upload_date", "title", "body", "community", "car_name", "url"])


@query("b12_time_range_filter", """SELECT url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM posts
  WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'""", "posts")
def b12(spark, sf):
    between = F.col("ts").between(F.lit("2024-01-10 06:00:00").cast("timestamp"), F.lit("2024-01-20 18:00:00").cast("timestamp"))
    return V.posts(spark, sf).filter(between).orderBy("ts", "url").select("url", "ts")


@query("b13_last_days_filter", """SELECT car_name, count(*) FILTER (WHERE upload_date >= DATE '2024-01-31' - 5) AS last_5,
  count(*) FILTER (WHERE upload_date >= DATE '2024-01-31' - 10) AS last_10,
  count(*) FILTER (WHERE upload_date BETWEEN DATE '2024-01-31' - 90 AND DATE '2024-01-31') AS last_90 FROM posts GROUP BY 1""", "posts")
def b13(spark, sf):
    day = F.col("upload_date")
    return V.posts(spark, sf).groupBy("car_name").agg(
        F.count_if(times.last_days(day, ASOF, 5)).alias("last_5"), F.count_if(times.last_days(day, ASOF, 10)).alias("last_10"),
        F.count_if(times.last_days(day, ASOF, 90, closed=True)).alias("last_90"))


@query("b14_near_time_filter", """SELECT url FROM posts
  WHERE abs(date_diff('microsecond', ts, upload_date + INTERVAL 12 HOUR)) < 3600000000""", "posts")
def b14(spark, sf):
    noon = F.timestamp_seconds(F.unix_timestamp(F.col("upload_date").cast("timestamp")) + 12 * 3600)
    return V.posts(spark, sf).filter(times.near(F.col("ts"), noon)).select("url")


@query("b15_feed_recency", f"""SELECT link, title FROM ({FEED_SQL})
  WHERE published BETWEEN date_trunc('second', ts) - INTERVAL 1 HOUR AND date_trunc('second', ts)""")
def b15(spark, sf):
    items = feeds.parse_feed(feed_payloads(spark, sf).withColumn("now", F.date_trunc("second", "ts")).drop("ts"), "payload")
    kind = F.when(F.contains("pub_date", F.lit(",")), "mail").otherwise("plain")
    items = items.withColumn("published", times.parse_dt(F.col("pub_date"), kind, {
        "mail": [times.MAIL], "plain": [times.DASH_SECONDS]}))
    return feeds.recent_items(items, "published", F.col("now")).select("link", "title")


def _tags_sql(col: str) -> str:
    parts = []
    for label, keys in V.DICTIONARY:
        cond = " OR ".join(f"contains({col}, '{k}')" for k in keys)
        parts.append(f"CASE WHEN {cond} THEN '{label}' END")
    return f"list_filter([{', '.join(parts)}], lambda l: l IS NOT NULL)"


@query("b16_dictionary_tags", f"SELECT url, to_json({_tags_sql('title || body')})::VARCHAR AS issue FROM doc_posts", "doc_posts")
def b16(spark, sf):
    return V.doc_posts(spark, sf).select("url", F.to_json(text.tag_issues(F.concat("title", "body"), V.DICTIONARY)).alias("issue"))


@query("b16_dictionary_tags_by_join", f"SELECT url, to_json({_tags_sql('title || body')})::VARCHAR AS issue FROM doc_posts", "doc_posts")
def b16_join(spark, sf):
    """The way taken when the dictionary is a large table."""
    rows = [(i, label, keys) for i, (label, keys) in enumerate(V.DICTIONARY)]
    dictionary = spark.createDataFrame(rows, "position int, defect_type string, keywords array<string>")
    posts = V.doc_posts(spark, sf).select("url", F.concat("title", "body").alias("text"))
    return ingest.tag_by_table(posts, "url", "text", dictionary).select("url", "issue")


@query("b17_has_issue", "SELECT url, issue FROM posts WHERE len(issues) > 0", "posts")
def b17(spark, sf):
    return V.posts(spark, sf).filter(values.has_label(F.col("issue"))).select("url", "issue")


@query("b18_explode_issues", "SELECT url, car_name, unnest(issues) AS issue FROM posts", "posts")
def b18(spark, sf):
    return interest.explode_issues(V.posts(spark, sf).select("url", "car_name", "issue"))


WIDE = """SELECT c_custkey, unnest(l[1:5]) AS issue, unnest(range(least(len(l), 5))) AS n FROM (
  SELECT o_custkey AS c_custkey, list(DISTINCT o_orderpriority || o_orderstatus ORDER BY o_orderpriority || o_orderstatus) AS l
  FROM orders GROUP BY o_custkey)"""


def _wide_labels(spark, sf):
    """Customers labelled with all their order kinds (up to 15), as JSON text."""
    o = V.table(spark, sf, "orders")
    return o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_json(F.sort_array(F.collect_set(F.concat("o_orderpriority", "o_orderstatus")))).alias("issue"))


@query("b19_explode_first_five", WIDE)
def b19(spark, sf):
    return interest.explode_issues(_wide_labels(spark, sf), 5, "n")


@query("b20_any_keyword_filter", """SELECT url FROM doc_posts WHERE title ILIKE '%And%' OR body ILIKE '%And%'
  OR title ILIKE '%QUE %' OR body ILIKE '%QUE %'""", "doc_posts")
def b20(spark, sf):
    return V.doc_posts(spark, sf).filter(text.any_keyword([F.col("title"), F.col("body")], ["And", "QUE "])).select("url")


@query("b21_text_search", """SELECT url FROM doc_posts WHERE contains(body, 'the') AND contains(body, 'and') AND NOT contains(body, 'xx')
  AND (contains(body, 'with') OR contains(body, 'are')) AND contains(body, ' of the')""", "doc_posts")
def b21(spark, sf):
    keep = text.search(F.col("body"), ["the", "and"], ["xx"], ["with", "are"], " of the")
    return V.doc_posts(spark, sf).filter(keep).select("url")


@query("b22_log_features", "SELECT url, round(ln(1 + num_views), 6) AS log_views, round(ln(1 + num_likes), 6) AS log_likes FROM posts", "posts")
def b22(spark, sf):
    return aggregates.with_log(V.posts(spark, sf)).select("url", "log_views", "log_likes")


@query("b23_minmax", """SELECT url, issue, round(normalized_view, 6) AS normalized_view, round(normalized_like, 6) AS normalized_like,
  round(normalized_log_view, 6) AS normalized_log_view, round(normalized_log_like, 6) AS normalized_log_like FROM normalized""", "normalized")
def b23(spark, sf):
    posts = V.labelled(spark, sf)
    return aggregates.minmax(posts, aggregates.bounds(posts)).select(
        "url", "issue", "normalized_view", "normalized_like", "normalized_log_view", "normalized_log_like")


@query("b24_strip_signature", """SELECT conv_id, turn, trim(CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN text || ' - dc'
  ELSE text END) AS text FROM conversations""")
def b24(spark, sf):
    c = V.table(spark, sf, "conversations")
    signed = F.concat("text", F.when(F.col("turn") % 3 == 0, " - dc App").when(F.col("turn") % 3 == 1, " - dc").otherwise(" - dc official App"))
    return c.select("conv_id", "turn", values.strip_suffix(signed).alias("text"))


@query("b25_mentions", """SELECT url, issue, len(string_split(title || body, issue)) - 1 AS mentions FROM (
  SELECT url, title, body, unnest(['the', 'on', lang]) AS issue FROM (
    SELECT p.url, p.title, p.body, p.community AS lang FROM doc_posts p))""", "doc_posts")
def b25(spark, sf):
    d = V.doc_posts(spark, sf).withColumn("issue", F.explode(F.array(F.lit("the"), F.lit("on"), F.col("community"))))
    return d.select("url", "issue", text.mentions(F.concat("title", "body"), F.col("issue")).alias("mentions"))





def replies(spark, sf):
    """Model replies: clean, inside prose, with missing keys, without an object, broken."""
    e = V.table(spark, sf, "events")
    flag = F.when(F.col("event_id") % 2 == 0, "True").otherwise("False")
    topic = F.when(F.col("event_id") % 3 == 0, "None").otherwise(F.col("event_type"))
    full = F.format_string('{"car_name": "car%d", "issue": "%s", "topic": "%s", "summary": "value %s"}',
                           F.col("user_id") % 6, flag, topic, F.col("value").cast("string"))
    kind = F.col("event_id") % 5
    return e.select(
        "event_id", "ts",
        F.when(kind == 0, full).when(kind == 1, F.concat(F.lit("Sure:\n"), full, F.lit("\nBye.")))
        .when(kind == 2, F.format_string('{"issue": "%s", "topic": "%s"}', flag, topic))
        .when(kind == 3, "no object here").otherwise(F.concat(F.lit("{"), full)).alias("reply"))


view_replies = """SELECT event_id, ts, CASE WHEN event_id % 5 IN (0, 1) THEN 'car' || (user_id % 6) END AS car_name,
  event_id % 5 IN (0, 1, 2) AND event_id % 2 = 0 AS is_trigger,
  CASE WHEN event_id % 5 IN (0, 1, 2) THEN CASE WHEN event_id % 3 = 0 THEN 'None' ELSE event_type END END AS topic,
  CASE WHEN event_id % 5 IN (0, 1) THEN 'value ' || value WHEN event_id % 5 = 2 THEN '' END AS summary FROM events"""
V.view("replies", view_replies)


@query("b26_parse_reply", "SELECT event_id, car_name, is_trigger, topic, summary FROM replies", "replies")
def b26(spark, sf):
    return replies(spark, sf).select("event_id", text.parse_reply(F.col("reply")).alias("r")).select("event_id", "r.*")


@query("b27_relevant_news", "SELECT event_id, topic FROM replies WHERE is_trigger AND lower(topic) <> 'none'", "replies")
def b27(spark, sf):
    parsed = replies(spark, sf).select("event_id", text.parse_reply(F.col("reply")).alias("r")).select("event_id", "r.*")
    return text.relevant_news(parsed).select("event_id", "topic")


def _in_list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


LEXICON_SQL = f"""SELECT url, len(list_filter(regexp_split_to_array(trim(title), '\\s+'), lambda t: t IN {_in_list(V.NEGATIVE_WORDS)}))
  + len(list_filter(regexp_split_to_array(trim(body), '\\s+'), lambda t: t IN {_in_list(V.NEGATIVE_WORDS)})) AS negative FROM doc_posts"""


@query("b28_lexicon_count", LEXICON_SQL, "doc_posts")
def b28(spark, sf):
    return V.doc_posts(spark, sf).select("url", text.lexicon_count([F.col("title"), F.col("body"), F.col("comments")],
                                                                   V.NEGATIVE_WORDS).alias("negative"))


@query("b28_lexicon_count_by_join", LEXICON_SQL, "doc_posts")
def b28_join(spark, sf):
    lexicon = spark.createDataFrame([(w,) for w in V.NEGATIVE_WORDS], "word string")
    return text.lexicon_count_by_join(V.doc_posts(spark, sf), "url", ["title", "body", "comments"], lexicon, "word",
                                      "negative").select("url", "negative")


V.view("term_rows", """SELECT url, upload_date, unnest(list_distinct(regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+'))) AS term, 5 AS weight FROM doc_posts
  UNION ALL SELECT url, upload_date, unnest(list_distinct(regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+'))) AS term, 2 AS weight FROM doc_posts""", "doc_posts")
V.view("all_term_rows", """SELECT url, upload_date, unnest(regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+')) AS term, 5 AS weight FROM doc_posts
  UNION ALL SELECT url, upload_date, unnest(regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+')) AS term, 2 AS weight FROM doc_posts""", "doc_posts")


@query("b29_weighted_terms", "SELECT term, count(*) AS fields, CAST(sum(weight) AS BIGINT) AS weight FROM term_rows GROUP BY term", "term_rows")
def b29(spark, sf):
    found = text.weighted_terms(V.doc_posts(spark, sf), keywords.WEIGHTS)
    return found.groupBy("term").agg(F.count("*").alias("fields"), F.sum("weight").alias("weight"))


@query("b29_weighted_terms_every", "SELECT term, count(*) AS fields, CAST(sum(weight) AS BIGINT) AS weight FROM all_term_rows GROUP BY term", "all_term_rows")
def b29_every(spark, sf):
    found = text.weighted_terms(V.doc_posts(spark, sf), {"title": 5, "body": 2, "comments": 0}, distinct=False)
    return found.groupBy("term").agg(F.count("*").alias("fields"), F.sum("weight").alias("weight"))


@query("b30_stop_words", f"""SELECT term, CAST(sum(weight) AS BIGINT) AS weight FROM term_rows WHERE term NOT IN {_in_list(V.STOP_WORDS)} GROUP BY term""", "term_rows")
def b30(spark, sf):
    found = text.weighted_terms(V.doc_posts(spark, sf), keywords.WEIGHTS).groupBy("term").agg(F.sum("weight").alias("weight"))
    return keywords.drop_terms(found, spark.createDataFrame([(w,) for w in V.STOP_WORDS], "word string"))


@query("b31_alert_messages", """SELECT 0 AS message, count(*) AS entries, '2024-01-31 00:00 triggers' AS subject,
  count(*) || ' entries' || chr(10) || chr(10) || string_agg(car_name || ' - ' || issue || chr(10) ||
    'http://charts/?car_name=' || car_name || '&issue=' || issue, chr(10) || chr(10) ORDER BY car_name, issue, trigger_date) AS text
  FROM triggers HAVING count(*) > 0""", "triggers")
def b31(spark, sf):
    return serving.render_alerts(V.triggers(spark, sf), serving.trigger_line("http://charts/?"), "triggers", ASOF,
                                 ["car_name", "issue", "trigger_date"])


@query("b32_shift_series", """SELECT car_name, issue, CAST(trigger_date AS VARCHAR) AS trigger_date,
  CAST(upload_date + CAST(DATE '2024-01-31' - trigger_date AS INTEGER) AS VARCHAR) AS upload_date, round(score, 6) AS norm_graph_score
  FROM case_points""", "case_points")
def b32(spark, sf):
    cases = interest.past_cases(V.series(spark, sf))
    moved = S.shift_series(F.col("series"), F.datediff(F.lit(ASOF[:10]).cast("date"), F.col("trigger_date")))
    return cases.select("car_name", "issue", "trigger_date", F.inline(moved))


@query("b33_json_round_trip", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date,
  round(score, 6) AS norm_graph_score FROM series""", "series")
def b33(spark, sf):
    from signalpost.schemas import SERIES
    from signalpost.sources.sinks import json_text
    nested = json_text(aggregates.nest_series(V.series(spark, sf), ["car_name", "issue"]), ["series"])
    return nested.select("car_name", "issue", F.inline(F.from_json("series", SERIES)))


@query("b34_first_url", """SELECT url, CASE WHEN event_id % 10 <> 3 THEN issues[1] END AS first_label FROM posts""", "posts")
def b34(spark, sf):
    return V.posts(spark, sf).select("url", values.first_url(F.col("issue")).alias("first_label"))
