"""Column expressions for dirty counters, URLs and labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The unit of ten thousand in view counters and the label in front of them.
TEN_THOUSAND = "만"
VIEW_LABEL = "조회 "


def clean_count(col: Column, unit: str = TEN_THOUSAND, factor: int = 10_000) -> Column:
    """Counter text to a whole number: commas go, ``1.2만`` is 12000, other text is null."""
    plain = F.regexp_replace(col, ",", "")
    pattern = rf"^(.*?)([0-9]+\.?[0-9]*){unit}(.*)$"
    scaled = F.concat(
        F.regexp_extract(plain, pattern, 1),
        (F.regexp_extract(plain, pattern, 2).try_cast("double") * factor).try_cast("bigint").cast("string"),
        F.regexp_extract(plain, pattern, 3))
    number = F.when(F.contains(plain, F.lit(unit)), scaled).otherwise(plain)
    return number.try_cast("double").try_cast("bigint")


def strip_prefix(col: Column, prefix: str = VIEW_LABEL) -> Column:
    return F.replace(col, F.lit(prefix), F.lit(""))


def strip_suffix(col: Column, pattern: str = r"- dc (official )?App$") -> Column:
    """Drop a signature at the end of a text."""
    return F.trim(F.regexp_replace(col, pattern, ""))


def coerce_long(col: Column) -> Column:
    """Whole number, or null where the text is no number."""
    return F.trim(col).try_cast("double").try_cast("bigint")


def clean_url(url: Column, source: Column, rules: dict[str, str]) -> Column:
    """Cut the URL at the marker its source uses, such as ``{"a": "&page="}``."""
    result = url
    for name, marker in rules.items():
        result = F.when(source == name, F.substring_index(url, marker, 1)).otherwise(result)
    return result


def map_values(df: DataFrame, col: str, mapping: dict[str, str], out: str | None = None,
               keep_unknown: bool = False) -> DataFrame:
    """Replace values by their alias; an unknown value becomes null unless it is kept."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    found = F.try_element_at(table, F.col(col))
    return df.withColumn(out or col, F.coalesce(found, F.col(col)) if keep_unknown else found)


def to_canonical(df: DataFrame, mapping: dict[str, str], consts: dict[str, object], order: list[str]) -> DataFrame:
    """Rename, add constant columns and put the columns in order."""
    df = df.withColumnsRenamed(mapping)
    return df.withColumns({k: F.lit(v) for k, v in consts.items()}).select(*order) if consts else df.select(*order)


def first_url(col: Column) -> Column:
    """First URL of a list stored as JSON text, null for an empty list."""
    return F.try_element_at(F.from_json(col, "array<string>"), F.lit(1))


def labels(col: Column) -> Column:
    """Labels stored as JSON text, as an array."""
    return F.from_json(col, "array<string>")


def has_label(col: Column) -> Column:
    """True where the stored list has a first label."""
    return F.get_json_object(col, "$[0]").isNotNull()
