"""Post ingest, range merge and news ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.functions import text as texts
from signalpost.functions import values
from signalpost.functions.matching import find_labels
from signalpost.functions.times import date_part_text
from signalpost.operators.commits import KeyedTable
from signalpost.operators.tables import dedupe_first, insert_ignore, upsert, upsert_days

COUNTER_COLS = ["comments", "num_views", "num_likes"]


def clean_posts(raw: DataFrame, dictionary: list[tuple[str, list[str]]], url_rules: dict[str, str],
                aliases: dict[str, str]) -> DataFrame:
    """Crawl rows to typed, labelled posts, one per URL.  Unreadable counters become null."""
    df = raw.na.fill("")
    df = df.withColumns({
        "Date": date_part_text(F.col("Date")),
        "View": values.clean_count(values.strip_prefix(F.col("View"))),
        "Like": values.clean_count(F.col("Like")),
        "Issue": F.to_json(texts.tag_issues(F.concat("Title", "Body"), dictionary)),
        "Url": values.clean_url(F.col("Url"), F.col("Community"), url_rules),
    })
    df = values.map_values(df, "CarName", aliases, keep_unknown=True)
    return dedupe_first(df, ties=["Title", "Body", "Like"])


def rejects(raw: DataFrame) -> DataFrame:
    """Rows whose counters or date cannot be read, per community."""
    bad_view = values.clean_count(values.strip_prefix(F.coalesce("View", F.lit("")))).isNull()
    bad_like = values.clean_count(F.coalesce("Like", F.lit(""))).isNull()
    day = F.regexp_replace(date_part_text(F.coalesce("Date", F.lit(""))), r"\.$", "")
    bad_date = F.regexp_replace(day, r"\.", "-").try_cast("date").isNull()
    return raw.groupBy("Community").agg(F.count("*").alias("rows"), F.count_if(bad_view).alias("bad_views"),
                                        F.count_if(bad_like).alias("bad_likes"), F.count_if(bad_date).alias("bad_dates"))


def tag_by_table(posts: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """Labels from a dictionary table of any size, in dictionary order, as JSON text.

    ``dictionary`` has (position, defect_type, keywords).  Every text is read once and stays in its task.
    """
    keys = dictionary.select("position", F.col("defect_type").alias("label"), F.explode("keywords").alias("pattern"))
    tagged = find_labels(posts, text, keys, "_hits")
    return tagged.withColumn("issue", F.to_json(F.transform("_hits", lambda h: h["label"]))).drop("_hits")


def post_rows(cleaned: DataFrame) -> DataFrame:
    """Cleaned crawl rows in the columns of the post table; a date that cannot be read is null."""
    day = F.regexp_replace("Date", r"\.$", "")
    return cleaned.select(
        F.regexp_replace(day, r"\.", "-").try_cast("date").alias("upload_date"), F.col("Time").alias("upload_time"),
        F.col("Title").alias("title"), F.col("Body").alias("body"), F.col("Comment").alias("comments"),
        F.col("View").alias("num_views"), F.col("Like").alias("num_likes"), F.col("Community").alias("community"),
        F.col("CarName").alias("car_name"), F.col("Issue").alias("issue"), F.col("Url").alias("url"))


def ingest_posts(current: DataFrame, raw: DataFrame, dictionary, url_rules, aliases) -> DataFrame:
    """New state of the post table after a crawl."""
    incoming = post_rows(clean_posts(raw, dictionary, url_rules, aliases))
    return upsert(current, incoming, ["url"], COUNTER_COLS)


def ingest_into(target: str, raw: DataFrame, dictionary, url_rules, aliases) -> None:
    """The same on a stored table, rewriting only the days it touches."""
    upsert_days(target, post_rows(clean_posts(raw, dictionary, url_rules, aliases)), ["url"], COUNTER_COLS,
                "upload_date")


def ingest_batch(table: KeyedTable, raw: DataFrame, batch: int, dictionary, url_rules, aliases) -> bool:
    """The same on a table with a key index, as one commit; a batch that was taken before changes nothing."""
    return table.upsert(post_rows(clean_posts(raw, dictionary, url_rules, aliases)), batch, COUNTER_COLS)


def merge_ranges(parts: list[DataFrame], ties: tuple[str, ...] = ("Url",)) -> DataFrame:
    """Range files of one (community, car) as one table in order of time."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.orderBy("Date", "Time", *ties)


def merge_by_cell(parts: list[DataFrame], cell: list[str], ties: tuple[str, ...] = ("Url",)) -> DataFrame:
    """Range files of all cells, ready to be written by cell: one shuffle deals the rows into ranges of (cell, time).

    A small cell lies in one task and becomes one file, a large one becomes several files in order of time; there is no order over
    the whole table.
    """
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    order = [*cell, "Date", "Time", *ties]
    return merged.repartitionByRange(*order).sortWithinPartitions(*order)


def ingest_news(current: DataFrame, raw: DataFrame, reply: str = "reply") -> DataFrame:
    """New state of the news table: model replies are read, irrelevant news dropped, known URLs kept."""
    df = raw.na.fill("", ["upload_date", "upload_time", "title", "body", "url"])
    df = df.withColumn("_r", texts.parse_reply(F.col(reply))).select(
        F.col("upload_date").try_cast("date").alias("upload_date"), "upload_time", "title", "_r.car_name", "_r.topic", "_r.summary",
        "_r.is_trigger", "url")
    fresh = texts.relevant_news(df).withColumnRenamed("topic", "issue")
    return insert_ignore(current, fresh, ["url"], [F.col("upload_date"), F.col("upload_time"), F.col("title")])
