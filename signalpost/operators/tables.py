"""Keeping tables: duplicates, upserts, inserts and surrogate keys."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalpost.scale import measured_join
from signalpost.session import cut


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key.

    Spark limits each key inside the map tasks before the shuffle, so a hot key sends at most
    ``k`` rows per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn(rank or "_rank", position).filter(F.col(rank or "_rank") <= k)
    return out if rank else out.drop("_rank")


def dedupe_first(df: DataFrame, key: str = "Url", date: str = "Date", time: str = "Time", views: str = "View",
                 ties: list[str] = ()) -> DataFrame:
    """Keep the earliest row per URL, the larger view count among equal times."""
    order = [F.col(date).asc(), F.col(time).asc(), F.col(views).desc_nulls_last(), *[F.col(c).asc() for c in ties]]
    return top_k(df, [key], order, 1)


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], update_cols: list[str] | None = None) -> DataFrame:
    """New table state: unknown keys are added, known keys take ``update_cols`` from the new rows.

    Without ``update_cols`` all columns but the keys are taken.  Keys must be unique on each side.
    """
    rest = [c for c in current.columns if c not in keys]
    update = rest if update_cols is None else update_cols
    old = current.select(*keys, F.struct(*rest).alias("_old"))
    new = incoming.select(*keys, F.struct(*rest).alias("_new"))
    merged = old.join(new, keys, "full_outer")
    known, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(c: str) -> Column:
        if c in update:
            return F.when(fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
        return F.when(known, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)

    return merged.select(*[F.col(c) if c in keys else value(c) for c in current.columns])


def _stored_days(spark, target: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target).withColumn("day", F.col("day").cast("string"))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert_days(target: str, incoming: DataFrame, keys: list[str], update_cols: list[str] | None, date: str) -> None:
    """Upsert into a Parquet table kept in one folder per day; a table that does not exist is created.

    Of the table only the keys are read, to find the days that hold a known key; those days and the
    days of the new rows are read in full and rewritten, all others stay as they are.  The folder of a day that
    has lost all its rows is removed.
    """
    spark = incoming.sparkSession
    incoming = cut(incoming.withColumn("day", F.coalesce(F.col(date).cast("string"), F.lit("unknown"))))
    current = _stored_days(spark, target)
    if current is None:
        incoming.write.mode("append").partitionBy("day").parquet(target)
        return
    known = measured_join(current.select(*keys, "day"), incoming.select(*keys), keys, F.xxhash64(*keys), "left_semi")
    days = known.select("day").unionByName(incoming.select("day")).distinct()
    # one row per calendar day at most, so it can be sent to every task; it prunes the folders that are read
    touched = current.join(F.broadcast(days), "day", "left_semi")
    merged = cut(upsert(touched.select(*incoming.columns), incoming, keys, update_cols))
    empty = touched.select("day").distinct().join(merged.select("day").distinct(), "day", "left_anti").collect()  # calendar days
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(target)
    for (day,) in empty:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/day={day}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_days(spark, target: str) -> DataFrame:
    """The table kept by ``upsert_days``."""
    return spark.read.parquet(target).drop("day")


def merge_into(spark, target: str, incoming: DataFrame, keys: list[str], update_cols: list[str]) -> None:
    """The same upsert on a catalog table whose format supports row-level changes."""
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"t.{key}") == F.col(f"s.{key}"))
    source = incoming.alias("s")
    (source.mergeInto(f"{target} AS t" if " " not in target else target, on)
     .whenMatched().update({c: F.col(f"s.{c}") for c in update_cols})
     .whenNotMatched().insertAll()
     .merge())


def new_rows(current: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows whose key is new, to be appended; of several rows with one key the first by ``order`` stays."""
    fresh = top_k(incoming, keys, order, 1).join(current.select(*keys), keys, "left_anti")
    return fresh.select(*current.columns)


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Table after an insert that leaves known keys alone."""
    return current.unionByName(new_rows(current, incoming, keys, order))


def overlay(base: DataFrame, patch: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Rows of ``base`` with ``cols`` replaced where ``patch`` has a value; patch keys are unique."""
    new = patch.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = base.join(new, key, "left")
    return joined.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                           for c in base.columns])


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Position of each row in the present order of the table, 1..n, without bringing it into one task.

    The rows are stored once, so that the position within a stored partition is final; the number adds the sizes of the
    partitions before.  That list has one row per partition.
    """
    place = F.monotonically_increasing_id()
    stored = cut(df.withColumn("_place", place))
    stored = (stored.withColumn("_part", F.shiftright("_place", 33))
              .withColumn("_row", F.col("_place").bitwiseAND((1 << 33) - 1)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (stored.groupBy("_part").agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (stored.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_row") + 1)
            .drop("_place", "_part", "_row", "_offset"))


def load_with_post_id(df: DataFrame, order_cols: list[str], name: str = "post_id") -> DataFrame:
    """Dense key 1..n in sort order.  End ``order_cols`` with a unique column so that equal values can be spread."""
    return numbered(df.orderBy(*order_cols), name)


def attach_urls(posts: DataFrame, triggers: DataFrame) -> DataFrame:
    """Posts of trigger days: posts and triggers share (car_name, issue, upload_date)."""
    return measured_join(posts.select("car_name", "issue", "upload_date", "url"), triggers,
                         ["car_name", "issue", "upload_date"], F.col("url"))
