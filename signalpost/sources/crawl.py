"""Crawl files: one CSV object per (source, car, time range), and archive folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalpost.schemas import CRAWL

# An empty field is null and a quoted empty field is an empty text: the null mark is one no file holds.
CSV = {"header": "true", "multiLine": "true", "escape": '"', "nullValue": "\u0000"}
# The cells of a crawl may be missing or broken; only their scan passes over such files.
LENIENT = {**CSV, "ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}

# Fixed value: layout of an object path; times are yyyyMMddHHmm, as colons are not allowed in paths.
OBJECT = r"/monitor/([^/]+)/([^/]+)/(\d{8})/(\d{12})_(\d{12})_([^_/]+)_([^/]+?)\.csv"


def crawl_path(root: str, kind: str, source: str, start: str, end: str, car: str) -> str:
    """Object path of one cell; ``start`` and ``end`` are ``yyyy-MM-dd HH:mm``."""
    a, b = ("".join(ch for ch in t if ch.isdigit()) for t in (start, end))
    return f"{root.rstrip('/')}/monitor/{kind}/{source}/{a[:8]}/{a}_{b}_{source}_{car}.csv"


def _escaped(value: str) -> str:
    return "".join("\\" + ch if ch in "{}[],*?\\" else ch for ch in value)


def read_crawl_csv(spark: SparkSession, root: str, sources: list[str], cars: list[str], start: str, end: str,
                   kind: str = "community", schema: T.StructType = CRAWL) -> DataFrame:
    """Rows of every (source, car) object of one time range.

    The grid is one glob that Spark lists itself, so missing cells are simply not there; an unreadable
    file is skipped (``files_without_rows`` lists it) and an empty grid is an empty table.
    """
    cells = "{" + ",".join(_escaped(s) for s in sources) + "}"
    names = "{" + ",".join(_escaped(c) for c in cars) + "}"
    glob = crawl_path(root, kind, cells, start, end, names)
    try:
        return spark.read.schema(schema).options(**LENIENT).csv(glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def files_without_rows(spark: SparkSession, glob: str, schema: T.StructType = CRAWL) -> DataFrame:
    """Paths and sizes of the files of a glob that give no row: unreadable ones, and those with a header alone."""
    there = spark.read.format("binaryFile").load(glob).select("path", "length")
    read = spark.read.schema(schema).options(**LENIENT).csv(glob).select(F.col("_metadata.file_path").alias("path")).distinct()
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "%20", " "), "^file:/+", "/")
    return there.withColumn("_p", plain("path")).join(read.select(plain("path").alias("_p")), "_p", "left_anti").select("path", "length")


def with_path_provenance(df: DataFrame) -> DataFrame:
    """Columns kind, source, range start, range end and car taken from the object path."""
    path = F.regexp_replace(F.col("_metadata.file_path"), "%20", " ")
    stamp = "yyyyMMddHHmm"
    return df.withColumns({
        "path_kind": F.regexp_extract(path, OBJECT, 1),
        "path_source": F.regexp_extract(path, OBJECT, 2),
        "range_start": F.try_to_timestamp(F.regexp_extract(path, OBJECT, 4), F.lit(stamp)),
        "range_end": F.try_to_timestamp(F.regexp_extract(path, OBJECT, 5), F.lit(stamp)),
        "path_car": F.regexp_extract(path, OBJECT, 7),
    })


def merge_csv_dir(spark: SparkSession, variants: list[tuple[str, T.StructType]], drop: tuple[str, ...] = ("post_id",),
                  ) -> DataFrame:
    """All files of one or more folders as one table; each glob comes with the columns of its files.

    Columns missing in a variant are null, index columns are dropped.
    """
    merged = None
    for glob, schema in variants:
        part = spark.read.schema(schema).options(**CSV).csv(glob).drop(*drop)
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged
