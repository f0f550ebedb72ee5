"""The library's functions for SQL users: temporary functions with SQL bodies, and table functions for lateral joins.

After ``register(spark)`` they can be called in ``spark.sql``.  All bodies are built-in expressions, so Catalyst inlines them; only the warping distance is an
Arrow function.  Series are arrays with at most one value per day.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from signalpost.functions.dtw import _absolute, _euclidean
from signalpost.functions.values import TEN_THOUSAND, VIEW_LABEL

POINTS = "ARRAY<STRUCT<upload_date: DATE, norm_graph_score: DOUBLE>>"

FUNCTIONS = {
    # Text of a counter to a whole number: commas and the label go, 1.2 of the unit of ten thousand is 12000, other text is null.
    "clean_count(counter STRING) RETURNS BIGINT": f"""
        try_cast(try_cast(CASE WHEN contains(counter, '{TEN_THOUSAND}') THEN concat(
            regexp_extract(regexp_replace(replace(counter, '{VIEW_LABEL}', ''), ',', ''), r'^(.*?)([0-9]+\\.?[0-9]*){TEN_THOUSAND}(.*)$', 1),
            CAST(try_cast(try_cast(regexp_extract(regexp_replace(replace(counter, '{VIEW_LABEL}', ''), ',', ''), r'^(.*?)([0-9]+\\.?[0-9]*){TEN_THOUSAND}(.*)$', 2) AS DOUBLE) * 10000 AS BIGINT) AS STRING),
            regexp_extract(regexp_replace(replace(counter, '{VIEW_LABEL}', ''), ',', ''), r'^(.*?)([0-9]+\\.?[0-9]*){TEN_THOUSAND}(.*)$', 3))
          ELSE regexp_replace(replace(counter, '{VIEW_LABEL}', ''), ',', '') END AS DOUBLE) AS BIGINT)""",
    # URL up to the marker of its source, as in map('a', '&page=').
    "clean_url(url STRING, source STRING, rules MAP<STRING, STRING>) RETURNS STRING":
        "IF(map_contains_key(rules, source), substring_index(url, rules[source], 1), url)",
    # Labels, in the order of the dictionary, of which any keyword is part of the text.
    "tag_issues(body STRING, dictionary ARRAY<STRUCT<label: STRING, keys: ARRAY<STRING>>>) RETURNS ARRAY<STRING>":
        "transform(filter(dictionary, e -> exists(e.keys, k -> contains(body, k))), e -> e.label)",
    # Timestamp of a date and an HH:mm[:ss] text.
    "posted_at(day DATE, clock STRING) RETURNS TIMESTAMP":
        "try_to_timestamp(concat_ws(' ', CAST(day AS STRING), IF(length(clock) = 5, concat(clock, ':00'), clock)), 'yyyy-MM-dd HH:mm:ss')",
    # Counter a recent post is expected to end with.
    "boosted(counter DOUBLE, posted TIMESTAMP, day DATE, now TIMESTAMP, hours INT) RETURNS DOUBLE": """
        IF(CAST(day AS TIMESTAMP) >= timestamp_seconds(unix_timestamp(now) - hours * 3600),
           counter * (pow(1.2D, -(unix_timestamp(now) - unix_timestamp(posted)) / 3600D) * 3 + 1), counter)""",
    # Points of a nested series moved by some days; dates become text.
    f"shifted_series(series {POINTS}, days INT) RETURNS ARRAY<STRUCT<upload_date: STRING, norm_graph_score: DOUBLE>>":
        "transform(series, p -> named_struct('upload_date', CAST(date_add(p.upload_date, days) AS STRING), 'norm_graph_score', p.norm_graph_score))",
    # Exponential moving average that starts with the first value.
    "moving_average(vals ARRAY<DOUBLE>, alpha DOUBLE) RETURNS ARRAY<DOUBLE>": """
        aggregate(vals, CAST(array() AS ARRAY<DOUBLE>), (kept, x) ->
            concat(kept, array(IF(size(kept) = 0, x, (1 - alpha) * element_at(kept, -1) + alpha * x))))""",
    # Whether each value stands out from the window of values that ends with it.
    "trigger_flags(vals ARRAY<DOUBLE>, width INT, k DOUBLE) RETURNS ARRAY<BOOLEAN>": """
        transform(transform(transform(vals, (x, i) -> slice(vals, greatest(i - width + 2, 1), least(i + 1, width))),
            w -> named_struct('w', w, 'middle', aggregate(w, 0D, (a, y) -> a + y) / size(w))),
          s -> size(s.w) = width AND element_at(s.w, -1) - s.middle
            > k * sqrt(aggregate(s.w, 0D, (a, y) -> a + (y - s.middle) * (y - s.middle)) / size(s.w)) + 1e-12D * abs(s.middle))""",
}

TABLE_FUNCTIONS = {
    # The last hours cut into parts, newest first; the first (hours mod parts) are one hour longer.
    "split_range(asof TIMESTAMP, hours INT, parts INT, zone_hours INT) RETURNS TABLE(part INT, start_datetime TIMESTAMP, end_datetime TIMESTAMP)": """
        SELECT part, timestamp_seconds(begin), timestamp_seconds(begin + (hours DIV parts + IF(part < hours % parts, 1, 0)) * 3600 - 60) FROM (
          SELECT part, unix_timestamp(date_trunc('hour', timestamp_seconds(unix_timestamp(asof) + zone_hours * 3600)))
            - ((part + 1) * (hours DIV parts) + least(part + 1, hours % parts)) * 3600 AS begin
          FROM (SELECT explode(IF(hours > 0 AND parts > 0, sequence(0, parts - 1), array())) AS part))""",
    # [start, end] cut at month borders.
    "split_months(first TIMESTAMP, last TIMESTAMP) RETURNS TABLE(start_datetime TIMESTAMP, end_datetime TIMESTAMP)": """
        SELECT greatest(first, CAST(m AS TIMESTAMP)), least(last, timestamp_seconds(unix_timestamp(CAST(date_add(last_day(m), 1) AS TIMESTAMP)) - 60)) FROM (
          SELECT explode(IF(first <= last, sequence(trunc(first, 'MM'), trunc(last, 'MM'), INTERVAL 1 MONTH), array())) AS m)""",
}


def register(spark: SparkSession) -> None:
    """Make all functions known to the session; calling it again changes nothing."""
    for head, body in {**FUNCTIONS, **TABLE_FUNCTIONS}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udf.register("warping_distance", _euclidean)
    spark.udf.register("absolute_warping_distance", _absolute)
