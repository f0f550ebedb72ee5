"""RSS feed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED = "struct<channel:struct<item:array<struct<title:string,link:string,pubDate:string,description:string>>>>"


def parse_feed(df: DataFrame, payload: str) -> DataFrame:
    """One row per feed item with title, link, pubDate and description."""
    kept = [c for c in df.columns if c != payload]
    items = F.from_xml(F.col(payload), FEED)["channel"]["item"]
    return df.select(*kept, F.inline(items)).withColumnRenamed("pubDate", "pub_date")


def recent_items(df: DataFrame, published: str, now, seconds: int = 3600) -> DataFrame:
    """Items published within the last hour, both ends included; instants are compared in UTC."""
    return df.filter(F.col(published).between(F.timestamp_seconds(F.unix_timestamp(now) - seconds), now))
