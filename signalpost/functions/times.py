"""Column expressions for dates and times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date-time notations of the sources.
DOT_DATE = "yyyy.MM.dd"
DOT_DATE_TIME = "yyyy.MM.dd. HH:mm"
DOT_TIME_IN_PARENTHESES = "yyyy.MM.dd (HH:mm)"
DOT_TIME = "yyyy.MM.dd HH:mm"
DASH_TIME = "yyyy-MM-dd HH:mm"
DASH_SECONDS = "yyyy-MM-dd HH:mm:ss"
ISO_ZONE = "yyyy-MM-dd HH:mm:ssXXX"
MAIL = "d MMM yyyy HH:mm:ss Z"


def date_part_text(col: Column) -> Column:
    """Text up to the first blank."""
    return F.regexp_extract(col, r"(\S+)", 1)


def parse_dt(col: Column, source: Column, formats: dict[str, list[str]]) -> Column:
    """Timestamp of a text whose notation depends on the source; null where none fits.

    A weekday, in front (``Mon, ``) or in parentheses, is cut before parsing.
    """
    text = F.regexp_replace(F.trim(col), r"^[A-Za-z]{3}, *", "")
    text = F.regexp_replace(text, r" *\([^0-9)]+\)", "")
    result = F.lit(None).cast("timestamp")
    for name, notations in formats.items():
        parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(n)) for n in notations])
        result = F.when(source == name, parsed).otherwise(result)
    return result


def compose_ts(date: Column, time: Column) -> Column:
    """Timestamp from a date and an ``HH:mm[:ss]`` text."""
    seconds = F.when(F.length(time) == 5, F.concat(time, F.lit(":00"))).otherwise(time)
    return F.try_to_timestamp(F.concat_ws(" ", date.cast("string"), seconds), F.lit(DASH_SECONDS))


def last_days(date: Column, asof: str, days: int, closed: bool = False) -> Column:
    """Date within the last ``days`` days; ``closed`` also requires it not to be after ``asof``."""
    end = F.to_date(F.lit(asof[:10]))
    recent = date >= F.date_sub(end, days)
    return recent & (date <= end) if closed else recent


def near(ts: Column, at: Column, seconds: int = 3600) -> Column:
    """Less than ``seconds`` away from ``at``."""
    return F.abs(F.unix_micros(at) - F.unix_micros(ts)) < seconds * 1_000_000


def run_time(asof: str) -> Column:
    """Run time literal from ``yyyy-MM-dd HH:mm`` text."""
    return F.lit(datetime.strptime(asof[:16], "%Y-%m-%d %H:%M").strftime("%Y-%m-%d %H:%M:00")).cast("timestamp")


def boost(value: Column, posted: Column, date: Column, asof: str, hours: int = 48) -> Column:
    """Expected final counter of a recent post: ``v * (3 * 1.2^-x + 1)`` with ``x`` hours of age."""
    now = run_time(asof)
    age = (F.unix_timestamp(now) - F.unix_timestamp(posted)) / 3600.0
    recent = date.cast("timestamp") >= F.timestamp_seconds(F.unix_timestamp(now) - hours * 3600)
    return F.when(recent, value * (F.pow(F.lit(1.2), -age) * 3 + 1)).otherwise(value.cast("double"))
