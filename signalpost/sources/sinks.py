"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.session import work_folder


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite",
              rows_per_file: int = 500_000) -> None:
    """CSV with header.  Quoted line breaks keep a file in one read task, so files are kept small."""
    (df.write.mode(mode).partitionBy(*partition_by)
     .options(header="true", escape='"', maxRecordsPerFile=rows_per_file).csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a Parquet table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_written(df: DataFrame, purpose: str, fmt: str = "parquet", **options) -> DataFrame:
    """Store a result in the shared folder and read it back; later steps start from the stored table."""
    path = work_folder(df.sparkSession, purpose)
    df.write.format(fmt).options(**options).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).options(**options).load(path)


def json_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nested columns as JSON text, as a result table stores them."""
    return df.withColumns({c: F.to_json(c) for c in cols})
