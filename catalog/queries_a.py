"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import views as V
from catalog.base import ASOF, query
from signalpost.functions.values import map_values
from signalpost.operators.tables import insert_ignore, load_with_post_id, upsert
from signalpost.plans import ingest
from signalpost.schemas import CRAWL
from signalpost.session import work_folder
from signalpost.sources import crawl, dictionaries, feeds, pages, posts, sinks


@query("a01_post_scan", """SELECT community, car_name, count(*) AS posts, sum(num_views) AS views, sum(num_likes) AS likes,
  CAST(min(upload_date) AS VARCHAR) AS first_day, CAST(max(upload_date) AS VARCHAR) AS last_day FROM posts GROUP BY 1, 2""", "posts")
def a01(spark, sf):
    path = work_folder(spark, "posts")
    sinks.write_overwrite(V.posts(spark, sf), path)
    return posts.read_posts(spark, "parquet", path).groupBy("community", "car_name").agg(
        F.count("*").alias("posts"), F.sum("num_views").alias("views"), F.sum("num_likes").alias("likes"),
        F.min("upload_date").alias("first_day"), F.max("upload_date").alias("last_day"))


def _crawl_files(spark, sf) -> str:
    """Raw posts stored as the crawler stores them: one object per (source, car) and range."""
    root = work_folder(spark, "crawl")
    raw = V.raw_posts(spark, sf).select(*CRAWL.names)
    for source in ("c0", "c1", "c2"):
        # user_id % 3 decides the source and user_id % 6 the car, so each source has two cars
        for car in (f"K{source[1]}", {"c0": "K3", "c1": "K4", "c2": "ar5"}[source]):
            cell = raw.filter((F.col("Community") == source) & (F.col("CarName") == car))
            sinks.write_csv(cell, crawl.crawl_path(root, "community", source, "2024-01-01 00:00", "2024-01-31 00:00", car))
    return root


@query("a02_crawl_csv_grid", """SELECT "Community", "CarName", count(*) AS posts, count("Title") AS titles,
  count(DISTINCT "Url") AS urls, sum(length("Body")) AS body_chars FROM raw_posts
  WHERE "Community" IN ('c0', 'c1') AND "CarName" IN ('K0', 'K1', 'K4') GROUP BY 1, 2""", "raw_posts")
def a02(spark, sf):
    root = _crawl_files(spark, sf)
    df = crawl.read_crawl_csv(spark, root, ["c0", "c1", "missing"], ["K0", "K1", "K4", "other"],
                              "2024-01-01 00:00", "2024-01-31 00:00")
    return df.groupBy("Community", "CarName").agg(
        F.count("*").alias("posts"), F.count("Title").alias("titles"), F.countDistinct("Url").alias("urls"),
        F.sum(F.length("Body")).alias("body_chars"))


@query("a03_path_provenance", """SELECT 'community' AS path_kind, "Community" AS path_source, "CarName" AS path_car,
  '2024-01-01 00:00:00' AS range_start, '2024-01-31 00:00:00' AS range_end, "Community" AS community, "CarName" AS car,
  count(*) AS posts FROM raw_posts GROUP BY "Community", "CarName" """, "raw_posts")
def a03(spark, sf):
    root = _crawl_files(spark, sf)
    df = crawl.read_crawl_csv(spark, root, ["c0", "c1", "c2"], ["K0", "K1", "K2", "K3", "K4", "ar5"],
                              "2024-01-01 00:00", "2024-01-31 00:00")
    return crawl.with_path_provenance(df).groupBy(
        "path_kind", "path_source", "path_car", "range_start", "range_end", F.col("Community").alias("community"),
        F.col("CarName").alias("car")).agg(F.count("*").alias("posts"))


@query("a04_csv_dir_merge", """SELECT url, title, community, CASE WHEN community = 'en' THEN length(body) END AS num_chars
  FROM doc_posts""", "doc_posts")
def a04(spark, sf):
    root = work_folder(spark, "archive")
    d = V.doc_posts(spark, sf).withColumn("post_id", F.substring("url", 2, 20))
    one = d.filter("community = 'en'").select("post_id", "url", "title", "community", F.length("body").alias("num_chars"))
    two = d.filter("community <> 'en'").select("post_id", "url", "title", "community")
    sinks.write_csv(one, f"{root}/with_chars")
    sinks.write_csv(two, f"{root}/without_chars")
    return crawl.merge_csv_dir(spark, [
        (f"{root}/with_chars/*.csv", T.StructType.fromDDL("post_id string, url string, title string, community string, num_chars bigint")),
        (f"{root}/without_chars/*.csv", T.StructType.fromDDL("post_id string, url string, title string, community string"))])


@query("a05_dictionary_scan", """SELECT 'src ' || source AS defect_type, lang AS keyword, count(*) AS docs FROM documents
  GROUP BY source, lang""")
def a05(spark, sf):
    """A dictionary derived from the documents (sources and their languages), stored as JSON and read back."""
    path = work_folder(spark, "dictionary")
    d = V.table(spark, sf, "documents")
    entries = d.groupBy(F.concat(F.lit("src "), F.col("source")).alias("defect_type")).agg(
        F.sort_array(F.collect_set("lang")).alias("keywords"))
    (entries.groupBy(F.pmod(F.xxhash64("defect_type"), F.lit(1000))).agg(
        F.to_json(F.collect_list(F.struct("defect_type", "keywords"))).alias("value")).select("value").write.text(path))
    words = dictionaries.read_dictionary(spark, path, one_document=False).select("defect_type", F.explode("keywords").alias("keyword"))
    docs = d.select(F.concat(F.lit("src "), F.col("source")).alias("defect_type"), F.col("lang").alias("keyword"))
    counts = docs.groupBy("defect_type", "keyword").agg(F.count("*").alias("docs"))
    return words.join(counts, ["defect_type", "keyword"])


@query("a06_word_list_scan", """SELECT word, count(*) AS lines FROM (
  SELECT trim(unnest(string_split(text, chr(10)))) AS word FROM benchmark) GROUP BY word""")
def a06(spark, sf):
    path = work_folder(spark, "words")
    V.table(spark, sf, "benchmark").select("text").write.text(path)
    return dictionaries.read_word_list(spark, path).groupBy("word").agg(F.count("*").alias("lines"))


def feed_payloads(spark, sf):
    """One feed payload per event with one to three items; the last item is in another zone."""
    e = V.table(spark, sf, "events")
    item = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")), lambda i: F.concat(
        F.lit("<item><title>"), F.col("event_type"), F.lit(" &amp; "), i.cast("string"),
        F.lit("</title><link>http://f/"), F.col("event_id").cast("string"), F.lit("/"), i.cast("string"),
        F.lit("</link><pubDate>"),
        F.when(i == 2, F.date_format(F.timestamp_seconds(F.unix_timestamp("ts") + 9 * 3600), "EEE, d MMM yyyy HH:mm:ss' +0900'"))
        .otherwise(F.date_format(F.timestamp_seconds(F.unix_timestamp("ts") - i * 3000), "yyyy-MM-dd HH:mm:ss")),
        F.lit("</pubDate><description>value "), F.col("value").cast("string"), F.lit("</description></item>")))
    return e.select("event_id", F.col("ts"), F.concat(F.lit("<rss><channel><title>feed</title>"), F.array_join(item, ""),
                                                        F.lit("</channel></rss>")).alias("payload"))


FEED_SQL = """SELECT event_id, ts, i, event_type || ' & ' || i AS title, 'http://f/' || event_id || '/' || i AS link,
  CASE WHEN i = 2 THEN strftime(date_trunc('second', ts) + INTERVAL 9 HOUR, '%a, %-d %b %Y %H:%M:%S') || ' +0900'
       ELSE strftime(ts - INTERVAL 3000 SECOND * i, '%Y-%m-%d %H:%M:%S') END AS pub_date,
  CASE WHEN i = 2 THEN date_trunc('second', ts) ELSE date_trunc('second', ts - INTERVAL 3000 SECOND * i) END AS published
  FROM (SELECT *, unnest(range(0, event_id % 3 + 1)) AS i FROM events)"""


@query("a07_feed_scan", f"SELECT event_id, title, link, pub_date FROM ({FEED_SQL})")
def a07(spark, sf):
    return feeds.parse_feed(feed_payloads(spark, sf).drop("ts"), "payload").drop("description")


PAGE_RULES = {"title": "article h1", "body": "article p"}


@query("a08_page_articles", """SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(
    regexp_replace(regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) AS title FROM pages""")
def a08(spark, sf):
    found = pages.extract_pages(V.table(spark, sf, "pages").select("page_id", "html"), "html", PAGE_RULES,
                                [".ad", "script", "style"])
    return found.select("page_id", "title")


def _said(html: str) -> str:
    """SQL for the visible text of markup without hidden elements: tags out, entities decoded, blanks collapsed."""
    out = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''")):
        out = f"replace({out}, '{entity}', '{sign}')"
    return f"trim(regexp_replace(regexp_replace({out}, '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"


@query("a08_page_bodies", f"""SELECT page_id, url, coalesce(nullif(title, ''), 'N/A') AS title,
  coalesce(nullif(array_to_string(list_filter(list_transform(parts, lambda p: {_said('p')}), lambda p: p <> ''), chr(10)), ''), 'N/A') AS body FROM (
  SELECT page_id, url, {_said("regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1)")} AS title, list_transform(
    string_split(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')[2:], lambda p: string_split(p, '</p>')[1]) AS parts FROM pages)""")
def a08_bodies(spark, sf):
    return pages.extract_pages(V.table(spark, sf, "pages").select("page_id", "url", "html"), "html", PAGE_RULES,
                               [".ad", "script", "style"], missing="N/A")


@query("a09_page_links", """SELECT page_id, pos, CASE WHEN starts_with(l, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || l ELSE l END AS link,
  title FROM (SELECT page_id, url, unnest(links) AS l, unnest(titles) AS title, unnest(range(len(links))) AS pos FROM (
   SELECT page_id, url, regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 1) AS links,
     regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 2) AS titles
   FROM (SELECT *, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages)))""")
def a09(spark, sf):
    return pages.extract_links(V.table(spark, sf, "pages"), "html", "url").drop("url")


@query("a10_csv_sink", "SELECT url, CAST(upload_date AS VARCHAR) AS upload_date, title, body, community FROM doc_posts", "doc_posts")
def a10(spark, sf):
    path = work_folder(spark, "csv")
    df = V.doc_posts(spark, sf).drop("comments")
    sinks.write_csv(df, path)
    return spark.read.schema(df.schema).options(**crawl.CSV).csv(path)


@query("a11_json_sink", f"SELECT event_id, title, link, pub_date FROM ({FEED_SQL})")
def a11(spark, sf):
    path = work_folder(spark, "json")
    df = feeds.parse_feed(feed_payloads(spark, sf).drop("ts"), "payload").drop("description")
    sinks.write_json(df, path)
    return spark.read.schema(df.schema).json(path)


@query("a12_overwrite_sink", """SELECT car_name, issue, CAST(upload_date AS VARCHAR) AS upload_date, round(score, 6) AS score
  FROM series""", "series")
def a12(spark, sf):
    path = work_folder(spark, "overwrite")
    sinks.write_overwrite(V.posts(spark, sf).select("url"), path)
    sinks.write_overwrite(V.series(spark, sf).drop("n_posts"), path)
    return spark.read.parquet(path)


SPLIT = "2024-01-15"


def _two_loads(spark, sf):
    """The post table after a first crawl, and the rows of a second crawl that overlaps it."""
    p = V.posts(spark, sf).select("url", "upload_date", "car_name", "num_views", "num_likes")
    first = p.filter(F.col("upload_date") <= SPLIT)
    second = p.filter(F.col("upload_date") >= F.date_sub(F.lit(SPLIT).cast("date"), 2)).withColumns({
        "car_name": F.concat("car_name", F.lit(" new")), "num_views": F.col("num_views") + 1000,
        "num_likes": F.col("num_likes") + 7})
    return first, second


LOADS = f"""a AS (SELECT url, upload_date, car_name, num_views, num_likes FROM posts WHERE upload_date <= DATE '{SPLIT}'),
  b AS (SELECT url, upload_date, car_name || ' new' AS car_name, num_views + 1000 AS num_views, num_likes + 7 AS num_likes
        FROM posts WHERE upload_date >= DATE '{SPLIT}' - 2)"""


def _loads_sql(select: str) -> str:
    return f"SELECT * FROM (WITH {LOADS} {select})"


@query("a13_upsert_counters", _loads_sql("""SELECT url, CAST(a.upload_date AS VARCHAR) AS upload_date, a.car_name,
  coalesce(b.num_views, a.num_views) AS num_views, coalesce(b.num_likes, a.num_likes) AS num_likes FROM a LEFT JOIN b USING (url)
  UNION ALL SELECT url, CAST(upload_date AS VARCHAR), car_name, num_views, num_likes FROM b WHERE url NOT IN (SELECT url FROM a)"""), "posts")
def a13(spark, sf):
    first, second = _two_loads(spark, sf)
    return upsert(first, second, ["url"], ["num_views", "num_likes"])


@query("a14_upsert_all", _loads_sql("""SELECT url, CAST(upload_date AS VARCHAR) AS upload_date, car_name, num_views, num_likes FROM b
  UNION ALL SELECT url, CAST(upload_date AS VARCHAR), car_name, num_views, num_likes FROM a WHERE url NOT IN (SELECT url FROM b)"""), "posts")
def a14(spark, sf):
    first, second = _two_loads(spark, sf)
    return upsert(first, second, ["url"])


@query("a15_insert_ignore", """SELECT * FROM (WITH a AS (SELECT * FROM news WHERE upload_date <= DATE '2024-01-15'),
  b AS (SELECT * REPLACE (title || ' again' AS title) FROM news WHERE upload_date >= DATE '2024-01-10')
  SELECT url, title, CAST(upload_date AS VARCHAR) AS upload_date, car_name, issue FROM a
  UNION ALL SELECT url, title, CAST(upload_date AS VARCHAR), car_name, issue FROM b WHERE url NOT IN (SELECT url FROM a))""", "news")
def a15(spark, sf):
    n = V.news(spark, sf).select("url", "title", "upload_date", "car_name", "issue")
    first = n.filter(F.col("upload_date") <= "2024-01-15")
    second = n.filter(F.col("upload_date") >= "2024-01-10").withColumn("title", F.concat("title", F.lit(" again")))
    return insert_ignore(first, second.unionByName(second), ["url"], [F.col("title")])


@query("a16_load_with_post_id", """SELECT row_number() OVER (ORDER BY upload_date, upload_time, url) AS post_id, url,
  CAST(upload_date AS VARCHAR) AS upload_date, upload_time FROM posts""", "posts")
def a16(spark, sf):
    p = V.posts(spark, sf).select("url", "upload_date", "upload_time")
    return load_with_post_id(p, ["upload_date", "upload_time", "url"])


@query("a17_archive_consumed", """SELECT "Community" AS community, count(*) AS posts, count(DISTINCT "Url") AS urls
  FROM raw_posts GROUP BY 1""", "raw_posts")
def a17(spark, sf):
    """Files are taken one by one and moved to the archive by the following batch; nothing is lost on the way."""
    from signalpost.streaming.ingest import crawl_stream, run_to_folder
    root = work_folder(spark, "incoming")
    raw = V.raw_posts(spark, sf).select(*CRAWL.names)
    sinks.write_csv(raw.repartition(3), f"{root}/files")
    stream = crawl_stream(spark, f"{root}/files/*.csv", f"{root}/archive", 1)
    stored = run_to_folder(stream, f"{root}/out", f"{root}/state")
    return stored.groupBy(F.col("Community").alias("community")).agg(
        F.count("*").alias("posts"), F.countDistinct("Url").alias("urls"))
