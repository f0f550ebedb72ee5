"""Jobs that go on from stored state, orders compared by position, long lists, long intervals and tables with a key index."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import queries_h, queries_i, views as V
from catalog.base import ASOF, query
from signalpost.operators import tables
from signalpost.operators.commits import KeyedTable
from signalpost.plans import ingest, interest, serving
from signalpost.plans.kept import KeptSeries
from signalpost.scale import interval_join
from signalpost.schemas import CRAWL, POST
from signalpost.session import work_folder
from signalpost.sources import crawl, sinks
from signalpost.streaming import closing, ingest as stream

SERIES_SQL = """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score, n_posts FROM {}"""


def _in_waves(spark, posts, arrival, ends):
    """The series after one run per wave; a wave holds what has arrived since the run before."""
    kept = KeptSeries(spark, work_folder(spark, "kept-series"))
    posts = posts.withColumn("_arrival", arrival)
    for batch, end in enumerate(ends):
        wave = F.lit(True) if batch == len(ends) - 1 else F.col("_arrival") < F.lit(end).cast("timestamp")
        earlier = F.coalesce(F.col("_arrival") < F.lit(ends[batch - 1]).cast("timestamp"), F.lit(False)) if batch else F.lit(False)
        kept.advance(posts.filter(F.coalesce(wave, F.lit(False)) & ~earlier), end, batch)
    return kept


def kept_series(spark, sf):
    """Three runs; every twentieth post arrives eight days late."""
    late = F.when(F.col("event_id") % 20 == 7, F.expr("INTERVAL 8 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    return _in_waves(spark, V.posts(spark, sf), F.col("ts") + late, ["2024-01-11 00:00", "2024-01-21 00:00", ASOF])


@query("i01_interest_series_kept", SERIES_SQL.format("series"), "series")
def i01_kept(spark, sf):
    return kept_series(spark, sf).series()


@query("i01_interest_series_kept_long", SERIES_SQL.format("long_series"), "long_series")
def i01_kept_long(spark, sf):
    """Seven years in three runs; every thirtieth order arrives more than a year late, into days long averaged."""
    posts = V.long_posts(spark, sf)
    late = F.when(F.crc32(F.col("url").cast("binary")) % 30 == 0, F.lit(400)).otherwise(F.lit(0))
    arrival = F.date_add("upload_date", late.cast("int")).cast("timestamp")
    return _in_waves(spark, posts, arrival, ["1998-01-01 00:00", "2000-01-01 00:00", V.LONG_ASOF]).series()


@query("i02_trigger_report_kept", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, true AS is_trigger, 0 AS part,
  string_agg(url, ' ' ORDER BY url) AS urls FROM trigger_urls GROUP BY 1, 2, 3""", "trigger_urls")
def i02_kept(spark, sf):
    """The trigger report from kept state; of the posts only the last 90 days are read, for their URLs."""
    report = interest.trigger_report(V.posts(spark, sf), ASOF, series=kept_series(spark, sf).series())
    return report.withColumn("urls", F.array_join("url", " ")).drop("url")


# ---- order of rows, compared by position


@query("f02_sorted_posts_by_position", """SELECT row_number() OVER (ORDER BY "Date", "Time", "Url") AS position, "Date" AS day, "Time" AS posted, "Url" AS url FROM raw_posts""", "raw_posts")
def f02_positions(spark, sf):
    ordered = V.raw_posts(spark, sf).select(F.col("Date").alias("day"), F.col("Time").alias("posted"), F.col("Url").alias("url")).orderBy("day", "posted", "url")
    return tables.numbered(ordered, "position")


@query("f03_triggers_by_position", """SELECT row_number() OVER (ORDER BY trigger_date DESC, car_name, issue) AS position,
  CAST(trigger_date AS VARCHAR) AS trigger_date, car_name, issue FROM long_triggers""", "long_triggers")
def f03_positions(spark, sf):
    return tables.numbered(interest.all_triggers(V.long_series(spark, sf)).orderBy(F.desc("trigger_date"), *interest.SERIES), "position")


@query("i05_range_merge_by_position", """SELECT "Community" AS community, "CarName" AS car, row_number() OVER (PARTITION BY "Community", "CarName" ORDER BY "Date", "Time", "Url") AS position,
  "Date" AS day, "Time" AS posted, "Url" AS url FROM raw_posts""", "raw_posts")
def i05_positions(spark, sf):
    """Merged files of each cell, read back as they stand: files by name, rows in the order of a file."""
    root = work_folder(spark, "merge-cells")
    raw = V.raw_posts(spark, sf)
    first, second = (F.coalesce(F.col("ts") >= F.lit(x).cast("timestamp"), F.lit(True)) for x in ("2024-01-11", "2024-01-21"))
    for i, inside in enumerate((second, first & ~second, ~first)):
        sinks.write_csv(raw.filter(inside).select(*CRAWL.names), f"{root}/range{i}")
    parts = [spark.read.schema(CRAWL).options(**crawl.CSV).csv(f"{root}/range{i}") for i in range(3)]
    merged = ingest.merge_by_cell(parts, ["Community", "CarName"]).withColumns({"cell_source": F.col("Community"), "cell_car": F.col("CarName")})
    sinks.write_csv(merged, f"{root}/merged", ("cell_source", "cell_car"))
    stored = spark.read.schema(CRAWL).options(**crawl.CSV).csv(f"{root}/merged/*/*/*.csv")
    placed = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    in_cell = Window.partitionBy("Community", "CarName").orderBy("_file", "_row")
    return placed.select(F.col("Community").alias("community"), F.col("CarName").alias("car"), F.row_number().over(in_cell).alias("position"),
                         F.col("Date").alias("day"), F.col("Time").alias("posted"), F.col("Url").alias("url"))


# ---- long lists of alerts


@query("i08_trigger_alerts_in_messages", """SELECT '2001-08-01 00:00 triggers' AS subject, car_name || ' - ' || issue || chr(10) ||
    'http://charts/?car_name=' || car_name || '&issue=' || issue AS entry, count(*) AS times, true AS within_limit
  FROM (SELECT DISTINCT car_name, issue, trigger_date FROM long_triggers WHERE trigger_date >= DATE '2001-08-01' - 4000) GROUP BY car_name, issue""", "long_triggers")
def i08_in_messages(spark, sf):
    """Messages of about 200 lines as they are sent, taken apart again: every entry stands in one of them, and none is far too long."""
    hits = interest.all_triggers(V.long_series(spark, sf)).withColumnRenamed("trigger_date", "upload_date")
    messages = serving.trigger_alerts(hits, "http://charts/?", "2001-08-01 00:00", days=4000)
    lines = messages.select("subject", "entries", F.explode(F.slice(F.split("text", "\n\n"), 2, F.col("entries").cast("int"))).alias("entry"))
    return lines.groupBy("subject", "entry").agg(F.count("*").alias("times"), (F.max("entries") <= 400).alias("within_limit"))


# ---- intervals of very different lengths


@query("c14_posts_in_long_ranges", """SELECT CAST(d.day AS VARCHAR) AS day, l.seconds, count(*) AS posts FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d,
  (VALUES (3600), (86400), (604800), (315360000)) l(seconds) JOIN events e ON epoch(date_trunc('second', e.ts)) BETWEEN epoch(CAST(d.day AS TIMESTAMP)) AND epoch(CAST(d.day AS TIMESTAMP)) + l.seconds - 1
  GROUP BY d.day, l.seconds""")
def c14_long(spark, sf):
    """Ranges of an hour, a day, a week and ten years from each day on; a range of ten years has a few rows, not one per hour."""
    events = V.table(spark, sf, "events")
    starts = events.select(F.to_date("ts").alias("day")).distinct()
    lengths = F.array(*[F.lit(x) for x in (3600, 86_400, 604_800, 315_360_000)])
    ranges = starts.select("day", F.unix_timestamp(F.col("day").cast("timestamp")).alias("begin"), F.explode(lengths).alias("seconds"))
    joined = interval_join(events.select("event_id", "ts"), ranges, [], F.unix_timestamp("ts"), F.col("begin"),
                           F.col("begin") + F.col("seconds") - 1, width=3600, spread=F.col("event_id"))
    return joined.groupBy("day", "seconds").agg(F.count("*").alias("posts"))


# ---- tables with a key index


def _post_table(spark, purpose):
    return KeyedTable(spark, work_folder(spark, purpose), POST, ["url"], "upload_date", buckets=16)


@query("i04_post_ingest_by_key", queries_i.INGESTED, "first_load", "second_load")
def i04_by_key(spark, sf):
    """Two crawls into a table with a key index; the second is given twice and counts once."""
    table = _post_table(spark, "keyed-posts")
    early, late = queries_i._two_crawls(spark, sf)
    for batch, raw in ((0, early), (1, late), (1, late)):
        ingest.ingest_batch(table, raw, batch, *queries_i.RULES)
    return table.read().select(*queries_i.POST_COLUMNS)


@query("h01_stream_ingest_committed", queries_h.INGESTED_SQL, "wave_rows")
def h01_committed(spark, sf):
    """Three waves of a stream into a table with a key index; the last batch is replayed under its number."""
    root, table = work_folder(spark, "committed-stream"), _post_table(spark, "streamed-posts")
    raw = V.raw_posts(spark, sf)
    for wave in queries_h.WAVES:
        part = raw.filter(queries_h._in_wave(wave)).select(*CRAWL.names)
        sinks.write_csv(part, f"{root}/incoming", mode="append")
        stream.ingest_stream_committed(stream.crawl_stream(spark, f"{root}/incoming/*.csv"), table, f"{root}/state", *queries_i.RULES)
    ingest.ingest_batch(table, part.withColumn("View", F.lit("1")), table.store.batches()[-1], *queries_i.RULES)
    return table.read().select("url", "title", "car_name", "comments", "num_views", "num_likes")


# ---- triggers in one stream


@query("h04_stream_triggers_in_one", queries_h.TRIGGERS_SQL, "plain_series", "plain_triggers")
def h04_in_one(spark, sf):
    """Three waves of posts through one stream whose state closes the days."""
    root, limits = work_folder(spark, "closing-stream"), queries_h._limits(spark, sf)
    events = V.table(spark, sf, "events")
    for wave in queries_h.WAVES:
        events.filter(queries_h._in_wave(wave)).write.mode("append").parquet(f"{root}/events")
        posts = queries_h._labels(spark.readStream.schema(events.schema).parquet(f"{root}/events"))
        out = closing.run_closing(closing.closing_stream(posts, limits), root)
    return out
