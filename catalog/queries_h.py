"""Streaming jobs.  Each equals a batch result on the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.base import query, view
from signalpost.functions.values import has_label
from signalpost.operators import aggregates, tables
from signalpost.plans import interest
from signalpost.schemas import CRAWL
from signalpost.session import work_folder
from signalpost.sources import sinks
from signalpost.streaming import ingest, totals, triggers

# Arrival of the rows in three waves; every wave is a run of its own that goes on from the stored state.
# The first wave has no begin, the last no end, and the last takes rows without a time.
WAVES = [(None, "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", None)]


def _in_wave(wave):
    begin, end = (F.lit(x).cast("timestamp") if x else None for x in wave)
    inside = F.lit(True) if begin is None else F.col("ts") >= begin
    inside = inside if end is None else inside & (F.col("ts") < end)
    return inside | F.col("ts").isNull() if end is None else inside


view("waves", """SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS wave FROM clean_raw""", "clean_raw")
view("wave_rows", """SELECT * FROM waves QUALIFY row_number() OVER (PARTITION BY "Url", wave
  ORDER BY "Date", "Time", "View" DESC NULLS LAST, "Title", "Body", "Like") = 1""", "waves")


INGESTED_SQL = """SELECT "Url" AS url, arg_min("Title", wave) AS title, arg_min("CarName", wave) AS car_name, arg_max("Comment", wave) AS comments,
  list("View" ORDER BY wave)[-1] AS num_views, arg_max("Like", wave) AS num_likes FROM wave_rows GROUP BY "Url" """


@query("h01_stream_ingest", INGESTED_SQL, "wave_rows")
def h01(spark, sf):
    root = work_folder(spark, "stream-ingest")
    raw = V.raw_posts(spark, sf)
    for wave in WAVES:
        sinks.write_csv(raw.filter(_in_wave(wave)).select(*CRAWL.names), f"{root}/incoming", mode="append")
        ingest.ingest_stream(ingest.crawl_stream(spark, f"{root}/incoming/*.csv"), f"{root}/table", f"{root}/state",
                             V.POST_DICTIONARY, V.URL_RULES, V.ALIASES)
    return tables.read_days(spark, f"{root}/table").select(
        "url", "title", "car_name", "comments", "num_views", "num_likes")


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _labels_of_stream(spark, sf):
    """Labelled posts from a stream of events, in the notation of the posts view."""
    return _labels(_event_stream(spark, sf))


def _labels(e):
    labels = F.when(F.col("event_id") % 10 == 3, F.array().cast("array<string>")).when(
        F.col("event_id") % 5 == 0, F.array("event_type", F.lit("recall"))).otherwise(F.array("event_type"))
    return e.select("ts", F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("community"),
                    F.concat(F.lit("car"), (F.col("user_id") % 6).cast("string")).alias("car_name"),
                    F.explode(labels).alias("issue"), F.round(F.col("value") * 100).cast("bigint").alias("num_views"),
                    F.get_json_object("props", "$.k").cast("bigint").alias("num_likes"))


CLOSED = "upload_date + 1 <= (SELECT max(ts) - INTERVAL 48 HOUR FROM posts)"


@query("h02_stream_daily_totals", f"""SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, count(*) AS posts, CAST(sum(num_views) AS BIGINT) AS views,
  CAST(sum(num_likes) AS BIGINT) AS likes FROM (SELECT car_name, unnest(issues) AS issue, upload_date, num_views, num_likes FROM posts WHERE {CLOSED})
  GROUP BY car_name, issue, upload_date""", "posts")
def h02(spark, sf):
    root = work_folder(spark, "stream-totals")
    return ingest.run_to_folder(totals.daily_totals(_labels_of_stream(spark, sf)), f"{root}/out", f"{root}/state")


@query("h03_stream_dedupe", """SELECT DISTINCT 'http://x/' || (event_id // 2) AS url FROM events""")
def h03(spark, sf):
    root = work_folder(spark, "stream-dedupe")
    urls = _event_stream(spark, sf).select("ts", F.concat(F.lit("http://x/"), F.floor(F.col("event_id") / 2).cast("string")).alias("url"))
    return ingest.run_to_folder(ingest.dedupe_stream(urls), f"{root}/out", f"{root}/state").select("url")


V.scoring_views("plain_", "posts", "2030-01-01 00:00")


TRIGGERS_SQL = f"""SELECT s.car_name, s.issue, CAST(s.upload_date AS VARCHAR) AS upload_date, round(s.score, 6) AS score,
  t.trigger_date IS NOT NULL AS is_trigger FROM (SELECT * FROM plain_series WHERE {CLOSED}) s LEFT JOIN plain_triggers t
  ON t.car_name = s.car_name AND t.issue = s.issue AND t.trigger_date = s.upload_date"""


@query("h04_stream_triggers", TRIGGERS_SQL, "plain_series", "plain_triggers")
def h04(spark, sf):
    root = work_folder(spark, "stream-triggers")
    limits = _limits(spark, sf)
    events = V.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for wave in WAVES:
        events.filter(_in_wave(wave)).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
        out = triggers.trigger_chain(_labels(stream), limits, root)
    return out


def _limits(spark, sf):
    """Snapshot of the community bounds."""
    posts = interest.explode_issues(V.posts(spark, sf).filter(has_label(F.col("issue"))))
    return sinks.read_written(aggregates.bounds(aggregates.with_log(posts)), "bounds")


@query("h02_stream_daily_features", f"""SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(avg_log_view, 6) AS avg_log_view,
  round(sum_log_like, 6) AS sum_log_like FROM plain_daily WHERE {CLOSED}""", "plain_daily")
def h02_features(spark, sf):
    root = work_folder(spark, "stream-features")
    stream = totals.daily_feature_stream(_labels_of_stream(spark, sf), _limits(spark, sf))
    return ingest.run_to_folder(stream, f"{root}/out", f"{root}/state")
