"""Post tables from any Spark source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_posts(spark: SparkSession, fmt: str = "parquet", path: str | None = None, **opts) -> DataFrame:
    """Whole post table.  ``opts`` go to the reader, such as the ones from ``jdbc_options``."""
    reader = spark.read.format(fmt).options(**opts)
    return reader.load(path) if path else reader.load()


def jdbc_options(url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int,
                 fetch_size: int = 10_000, **login) -> dict[str, str]:
    """Reader options that split a database table into ranges read side by side."""
    return {"url": url, "dbtable": table, "partitionColumn": partition_column, "lowerBound": lower,
            "upperBound": upper, "numPartitions": str(partitions), "fetchsize": str(fetch_size), **login}
