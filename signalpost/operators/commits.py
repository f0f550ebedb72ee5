"""Parts of a stored table that change together.

A run writes new Parquet folders named by its batch and commits them by a manifest, which says which batch holds each folder of each part.  The
manifest is the last thing written, so a run that ends halfway has changed nothing for readers, and a batch that is in it is not taken twice.  Folders
of older batches stay until ``vacuum``; readers of an older manifest are not disturbed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "part string, folder string, batch bigint, note string"


class Committed:
    """Committed folders below ``root``.  The manifest has one row per folder, so folders stand for days, spans or buckets, not for rows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, part: str, batch: int, folder: str = "") -> str:
        return "/".join(x for x in (self.root, part, f"batch={batch}", folder) if x)

    def _files(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        """Complete batches, oldest first."""
        top, fs = self._files(f"{self.root}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
        done = [n for n in names if n.startswith("batch=") and fs.exists(self._files(f"{self.root}/manifest/{n}/_SUCCESS")[0])]
        return sorted(int(n.split("=")[1]) for n in done)

    def manifest(self) -> tuple[dict[tuple[str, str], int], str]:
        """Batch of each (part, folder) in the newest state, and its note."""
        done = self.batches()
        if not done:
            return {}, ""
        rows = self.spark.read.schema(MANIFEST).parquet(self._path("manifest", done[-1])).collect()
        return {(r["part"], r["folder"]): r["batch"] for r in rows if r["part"]}, rows[0]["note"]

    def folders(self, manifest: dict, part: str, keep: Callable[[str], bool] = lambda folder: True) -> list[str]:
        """Paths of the folders of a part."""
        return [self._path(part, batch, folder) for (p, folder), batch in manifest.items() if p == part and keep(folder)]

    def read(self, manifest: dict, part: str, schema: str | StructType, keep: Callable[[str], bool] = lambda folder: True) -> DataFrame:
        """Rows of the folders of a part; other folders are not opened."""
        paths = self.folders(manifest, part, keep)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame, part: str, batch: int, by: str | None = None) -> None:
        """Write a part, in folders by the column ``by``.  What a lost run has left there is replaced."""
        out = rows.hint("rebalance", by) if by else rows
        out.write.mode("overwrite").partitionBy(*([by] if by else [])).parquet(self._path(part, batch))

    def commit(self, manifest: dict, batch: int, note: str = "") -> None:
        """Make a state the newest one."""
        rows = [(part, folder, at, note) for (part, folder), at in manifest.items()] or [(None, None, None, note)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._path("manifest", batch))

    def vacuum(self) -> int:
        """Delete folders that the newest state does not use; returns their number.  Call it when no older reader is left."""
        manifest, _ = self.manifest()
        used, done, gone = {(p, b) for (p, _), b in manifest.items()}, self.batches(), 0
        top, fs = self._files(self.root)
        for part in [s.getPath().getName() for s in fs.listStatus(top)]:
            for status in fs.listStatus(self._files(f"{self.root}/{part}")[0]):
                batch = int(status.getPath().getName().split("=")[1])
                if batch <= done[-1] and (batch != done[-1] if part == "manifest" else (part, batch) not in used):
                    gone += fs.delete(status.getPath(), True)
        return gone


def day_folder(day: str | None) -> str:
    return f"day={'unknown' if day is None else day}"


class KeyedTable:
    """A table with unique keys, kept in one folder per day, with an index of the keys in buckets.

    An upsert reads the buckets of the incoming keys alone to find the days of known keys, then those days and the days of the new rows; all
    other folders stay as they are.  The change is one commit: readers see all of it or nothing, and a batch given twice counts once.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | StructType, keys: list[str], date: str, buckets: int = 64):
        self.store, self.spark = Committed(spark, root), spark
        self.schema, self.keys, self.date, self.buckets = schema, keys, date, buckets
        kinds = dict(spark.createDataFrame([], schema).dtypes)
        self.columns = list(kinds)
        self.index_schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", _day string"
        self.read_folders: list[str] = []  # what the last upsert has read

    def read(self) -> DataFrame:
        return self.store.read(self.store.manifest()[0], "rows", self.schema)

    def upsert(self, incoming: DataFrame, batch: int, update_cols: list[str] | None = None) -> bool:
        """Add unknown keys and give known ones ``update_cols`` (all if None) of the new rows; False if the batch was taken before.

        Keys are unique in ``incoming``; rows without a full key are not taken.  A key whose day changes moves to the folder of its new day.
        """
        from signalpost.operators.tables import upsert
        from signalpost.scale import measured_join
        from signalpost.session import cut

        if batch in self.store.batches():
            return False
        manifest, _ = self.store.manifest()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        day = F.coalesce(F.col(self.date).cast("string"), F.lit("unknown"))
        fresh = cut(incoming.select(*self.columns).dropna(subset=self.keys).withColumns({"bucket": bucket, "day": day}))
        hit = {f"bucket={r[0]}" for r in fresh.select("bucket").distinct().collect()}
        index = self.store.read(manifest, "index", self.index_schema, hit.__contains__)
        known = cut(measured_join(index, fresh.select(*self.keys), self.keys, F.xxhash64(*self.keys), "left_semi"))
        touched = {day_folder(r[0]) for r in known.select("_day").union(fresh.select("day")).distinct().collect()}  # calendar days
        self.read_folders = self.store.folders(manifest, "index", hit.__contains__) + self.store.folders(manifest, "rows", touched.__contains__)
        held = self.store.read(manifest, "rows", self.schema, touched.__contains__)
        merged = cut(upsert(held, fresh.select(*self.columns), self.keys, update_cols).withColumn("day", day))
        left = {day_folder(r[0]) for r in merged.select("day").distinct().collect()}
        # Where each key of the touched buckets lies now.
        moved = measured_join(merged.select(*self.keys, F.col("day").alias("_day")), fresh.select(*self.keys), self.keys, F.xxhash64(*self.keys), "left_semi")
        rest = measured_join(index, fresh.select(*self.keys), self.keys, F.xxhash64(*self.keys), "left_anti")
        self.store.write(merged, "rows", batch, "day")
        self.store.write(rest.unionByName(moved).withColumn("bucket", bucket), "index", batch, "bucket")
        after = {at: b for at, b in manifest.items() if not (at[0] == "rows" and at[1] in touched or at[0] == "index" and at[1] in hit)}
        after |= {("rows", f): batch for f in left} | {("index", f): batch for f in hit}
        self.store.commit(after, batch)
        return True
