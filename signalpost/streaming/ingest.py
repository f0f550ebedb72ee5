"""Incremental ingest of crawl files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalpost.operators.commits import KeyedTable
from signalpost.plans.ingest import ingest_batch, ingest_into
from signalpost.schemas import CRAWL
from signalpost.sources.crawl import CSV


def crawl_stream(spark: SparkSession, glob: str, archive: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """Stream of crawl rows.  With ``archive`` a consumed file is moved there by a later batch."""
    reader = spark.readStream.schema(CRAWL).options(**CSV).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(glob)


def ingest_stream(stream: DataFrame, target: str, checkpoint: str, dictionary, url_rules, aliases):
    """Run all available files through cleaning, deduplication and upsert; returns the finished query.

    Repeating a batch changes nothing, as an upsert of the same rows gives the same table.  With a
    row-level table format ``operators.tables.merge_into`` takes the place of ``ingest_into``.
    """
    def apply(batch: DataFrame, number: int) -> None:
        ingest_into(target, batch, dictionary, url_rules, aliases)

    query = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def ingest_stream_committed(stream: DataFrame, table: KeyedTable, checkpoint: str, dictionary, url_rules, aliases):
    """The same into a table with a key index: each micro-batch is one commit under its own number.

    A batch that the stream repeats after a loss is found in the table and left out; a batch lost halfway has left nothing to see.  The
    checkpoint belongs to the table, as batch numbers start anew with a new one.
    """
    def apply(batch: DataFrame, number: int) -> None:
        ingest_batch(table, batch, number, dictionary, url_rules, aliases)

    query = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def dedupe_stream(stream: DataFrame, key: str = "url", ts: str = "ts", delay: str = "48 hours") -> DataFrame:
    """First arrival per URL; a URL is forgotten once the watermark has passed."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_to_folder(stream: DataFrame, folder: str, checkpoint: str, fmt: str = "parquet", state_partitions: int | None = None) -> DataFrame:
    """Run all available input in append mode into a folder and read the result.

    Every batch opens and stores each partition of the state, used or not.  A state that does not grow with the rows needs no more than
    ``state_partitions``, whatever the session shuffles with.  A stored checkpoint keeps the number that it began with.
    """
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    try:
        if state_partitions:
            conf.set("spark.sql.shuffle.partitions", min(int(before), state_partitions))
        query = (stream.writeStream.format(fmt).option("path", folder).option("checkpointLocation", checkpoint)
                 .outputMode("append").trigger(availableNow=True).start())  # takes a copy of the settings
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).format(fmt).load(folder)
