"""Mixing of sources to target weights by systematic sampling.

Each source has a target, a share of all words by its weight.  Every document of a source expects target / source size copies.  The expected
copies are summed over the documents of the source, from the smallest document to the largest, one random offset is added, and a document
is taken once for every whole number that its part of the running sum crosses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalpost.llm.common import stored
from signalpost.scale import measured_join

# Expected copies and offsets count in parts of 2^24, so running sums are whole numbers and exact for 10^11 documents of a source.
UNIT = 1 << 24
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words between ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Words to take of each source, from a table (source, source_size) with one row per source.

    Sources by code point, null last, weigh ``weights``, repeating.  They share the sum of all sizes by weight, but none gets more than ``most``
    times its size; what is above goes to the others by weight until none is above.  Sources that reach their limit are those with the smallest
    size per weight, so their number is found by one running sum and nothing is repeated.  One row per source passes one task.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(number - 1, F.lit(len(weights))) + 1).cast("bigint"))
    # In order of size per weight; the ratio is only compared, and equal ratios reach their limit together.
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = weighed.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("weight") <= most * F.col("source_size"))
    # The first source that stays at or below its limit sets the level of all sources after it.
    chosen = F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0))
    return levelled.withColumn("_chosen", chosen).withColumn(
        "target", F.coalesce(F.col("_chosen") * F.col("weight"), (most * F.col("source_size")).cast("double"))).drop("_level", "_open", "_chosen")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each row among the rows of its source in this sorted partition, from 1."""
    part, last, count = TaskContext.get().partitionId(), (), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sources = batch.column("source").to_pylist()
        places = np.empty(batch.num_rows, dtype=np.int64)
        for row, source in enumerate(sources):
            if (source,) != last:
                last, count = (source,), 0
            count += 1
            places[row] = count
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("source"), batch.column("size"), pa.array(np.full(len(places), part, dtype=np.int32)), pa.array(places)],
                                         names=["_id", "source", "size", "part", "place"])


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3,
        seed: str = "mix", offsets: int = 16) -> DataFrame:
    """One row per document: ``key``, size, source_size, target (of its source) and copies.

    Documents of a source stand in order of size, then md5 of key and text, so that the words taken differ from the target by less than one
    document of the source, whatever the offset.  ``offsets`` random offsets are drawn per source from ``seed`` and the one whose words come
    nearest the target is kept, the first one at ties; a source has one offset.  The sums are whole numbers, so no document gets more than ``most`` copies
    and reruns agree.

    Documents are dealt into ranges of that order, so a source with most rows spreads over many tasks; per range and source only a count is
    carried on.  Null text has no words and is taken without effect; a null source is a source of its own, the last; rows with a null key take part; equal rows
    (key, text, source) share their copies in any order.  An empty table gives an empty result.  Other columns are not read.
    """
    order = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))))
    narrow = stored(docs.select(F.col(key).alias("_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"), order.alias("_order"))
                    .withColumn("_row", F.monotonically_increasing_id()), "sizes")
    goals = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    # No size: every copy is empty, and none is taken.
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    goals = stored(goals.withColumn("step", F.least(F.floor(ratio * UNIT), F.lit(most * UNIT)).cast("bigint")), "targets")

    keys = ["source", "size", "_order", "_row"]
    kind = dict(docs.select(F.col(key).alias("_id"), F.col(source).alias("source")).dtypes)
    placed = stored(narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).select("_id", "source", "size").mapInArrow(
        _places, f"_id {kind['_id']}, source {kind['source']}, size bigint, part int, place bigint"), "places")
    counts = placed.groupBy("part", "source").agg(F.count("*").alias("rows"))
    start = F.coalesce(F.sum("rows").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("start", start)

    drawn = F.transform(F.sequence(F.lit(1), F.lit(offsets)), lambda n: F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(seed), F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source")), n.cast("string"))), 1, 6), 16, 10).cast("bigint"))
    goals = goals.withColumn("drawn", drawn)
    ranges = stored(_same_source(starts, goals, "left"), "ranges")
    joined = _at_range(placed, ranges.select("part", "source", "start", "step", "drawn"))
    upto = (F.col("start") + F.col("place")) * F.col("step")

    def crossed(offset):  # whole-number division, exact beyond doubles
        return F.shiftright(upto + offset, 24) - F.shiftright(upto - F.col("step") + offset, 24)

    sums = joined.groupBy("source").agg(*[F.sum(F.col("size") * crossed(F.col("drawn")[n])).alias(f"_{n}") for n in range(offsets)])
    tried = F.array(*[F.struct(F.abs(F.col(f"_{n}") - F.col("target")).alias("gap"), F.lit(n).alias("number"), F.col("drawn")[n].alias("offset"))
                      for n in range(offsets)])
    chosen = _same_source(goals, sums, "inner").select("source", "source_size", "target", F.array_min(tried)["offset"].alias("offset"))
    final = stored(_same_source(ranges.select("part", "source", "start", "step"), chosen, "inner"), "offsets")
    result = _at_range(placed, final).withColumn("copies", crossed(F.col("offset")).cast("bigint"))
    return result.select(F.col("_id").alias(key), "size", "source_size", "target", "copies")


def _same_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join of two tables with a few rows per source; null is a source."""
    renamed = right.withColumnRenamed("source", "_source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _at_range(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with what is known of their range and source; the ranges are measured before they are sent to all tasks."""
    named = F.concat_ws(":", F.col("part"), F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source")))
    small = ranges.withColumn("_key", named).drop("part", "source")
    return measured_join(rows.withColumn("_key", named), small, ["_key"], F.col("place")).drop("_key")


def copies_of(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mix itself: documents as often as they are taken, with ``copy_no`` from 1.  ``key`` is unique in ``docs``."""
    wanted = mixed.filter("copies > 0").select(F.col(key).alias("_key"), "copies")
    joined = docs.join(wanted, F.col(key) == F.col("_key")).drop("_key")
    return joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_no")).drop("copies")
