"""Dictionaries, known cases and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalpost.schemas import DICTIONARY, KNOWN_CASES


def read_dictionary(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """Defect dictionary from a JSON array of records; without ``one_document`` an array per line."""
    return spark.read.schema(DICTIONARY).option("multiLine", one_document).json(path)


def read_known_cases(spark: SparkSession, path: str) -> DataFrame:
    """Known past cases from a JSON array; news dates become dates, unreadable ones null."""
    raw = spark.read.schema(KNOWN_CASES).option("multiLine", True).json(path)
    return raw.withColumn("news_dates", F.transform("news_dates", lambda d: d.try_cast("date")))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One stripped word per line, empty lines included."""
    return spark.read.text(path).select(F.trim("value").alias("word"))
