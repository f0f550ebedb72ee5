"""Triggers from posts in one stream: days are summed in state, closed by timers of event time, and scored as they close."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from signalpost.streaming.triggers import OUT, STATE_PARTITIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


def _ms(day: dt.date) -> int:
    """Midnight at which a day begins, in UTC."""
    return (day - dt.date(1970, 1, 1)).days * DAY_MS


SUMMED = "car_name string, issue string, upload_date date, closes timestamp, n bigint, view double, like double"
HELD_ROWS = 100_000  # of sums in a task


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per series and day of the posts of one task, so that few rows are shuffled however many posts a day has."""
    keys, sums = ["car_name", "issue", "upload_date", "closes"], ["n", "view", "like"]
    held = None
    for batch in batches:
        rows = pa.table([batch[c] for c in keys + sums], names=keys + sums)  # all columns nullable, as sums are
        rows = rows if held is None else pa.concat_tables([held, rows])
        totals = rows.group_by(keys).aggregate([(c, "sum") for c in sums])
        held = totals.select(keys + [f"{c}_sum" for c in sums]).rename_columns(keys + sums)
        if held.num_rows > HELD_ROWS:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


class DayCloser(StatefulProcessor):
    """State of one (car, issue): sums of its open days, two averages, the last scores.

    A timer at the end of each open day scores it once the watermark has passed; the days of a series close in order.  With ``idle_days`` a series without a day
    for so long is forgotten; if it comes back it starts anew.
    """

    def __init__(self, alpha: float, beta: float, window: int, k: float, idle_days: int | None):
        self.alpha, self.beta, self.window, self.k, self.idle_days = alpha, beta, window, k, idle_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day date", "n bigint, view double, like double")
        self.averages = handle.getValueState("averages", "view double, like double, scores array<double>, last date")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            sums = frame.groupby("upload_date").agg(n=("n", "sum"), view=("view", "sum"), like=("like", "sum"))
            for day, row in zip(sums.index, sums.itertuples(index=False)):
                held = self.days.getValue((day,)) if self.days.containsKey((day,)) else None
                if held is None:
                    self.handle.registerTimer(_ms(day) + DAY_MS)
                n, view, like = held or (0, 0.0, 0.0)
                self.days.updateValue((day,), (n + int(row.n), view + float(row.view), like + float(row.like)))
        yield pd.DataFrame(columns=["car_name", "issue", "upload_date", "score", "is_trigger"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        for day in sorted(d for (d,) in self.days.keys() if _ms(d) + DAY_MS <= end):
            n, view_sum, like_sum = self.days.getValue((day,))
            self.days.removeKey((day,))
            view, like, recent = (*self.averages.get()[:2], list(self.averages.get()[2])) if self.averages.exists() else (None, None, [])
            view = view_sum / n if view is None else (1 - self.alpha) * view + self.alpha * view_sum / n
            like = like_sum if like is None else (1 - self.beta) * like + self.beta * like_sum
            recent = [*recent, view * like][-self.window:]
            mean = float(np.mean(recent))
            hit = len(recent) == self.window and recent[-1] - mean > self.k * float(np.std(recent)) + 1e-12 * abs(mean)
            self.averages.update((float(view), float(like), [float(v) for v in recent], day))
            out.append((key[0], key[1], day, recent[-1], bool(hit)))
            if self.idle_days:
                self.handle.registerTimer(_ms(day) + DAY_MS * (1 + self.idle_days))
        if not out and self.idle_days and self.averages.exists() and _ms(self.averages.get()[3]) + DAY_MS * (1 + self.idle_days) <= end:
            self.averages.clear()
        yield pd.DataFrame(out, columns=["car_name", "issue", "upload_date", "score", "is_trigger"])

    def close(self) -> None:
        pass


def closing_stream(posts: DataFrame, limits: DataFrame, ts: str = "ts", delay_days: int = 2, alpha: float = 0.05, beta: float = 0.02,
                   window: int = 7, k: float = 2.1, idle_days: int | None = None) -> DataFrame:
    """Scores and trigger flags of closed days, from a stream of labelled posts and a snapshot of the community bounds.

    A day is closed once ``delay_days`` whole days have passed after it in the stream; posts of a closed day are dropped.  The watermark runs on the
    ends of days, so a late post counts as long as its day is open.
    """
    from signalpost.operators.aggregates import minmax, with_log
    scaled = minmax(with_log(posts), limits).select(
        "car_name", "issue", F.to_date(ts).alias("upload_date"), F.date_add(F.to_date(ts), 1).cast("timestamp").alias("closes"),
        F.lit(1).cast("bigint").alias("n"), F.coalesce("normalized_log_view", F.lit(0.0)).alias("view"),
        F.coalesce("normalized_log_like", F.lit(0.0)).alias("like"))
    late = scaled.mapInArrow(summed, SUMMED).withWatermark("closes", f"{24 * (delay_days + 1)} hours")
    return late.groupBy("car_name", "issue").transformWithStateInPandas(
        DayCloser(alpha, beta, window, k, idle_days), OUT, "append", "eventTime")


def run_closing(stream: DataFrame, folder: str, state_partitions: int | None = STATE_PARTITIONS) -> DataFrame:
    """Run all available posts; output and state lie below ``folder``, so the next call goes on from there.  Returns all scores found so far.

    ``state_partitions`` has to grow with the number of series, not of posts; None takes the session's.
    """
    from signalpost.streaming.ingest import run_to_folder
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.streaming.stateStore.providerClass")
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        return run_to_folder(stream, f"{folder}/triggers", f"{folder}/state", state_partitions=state_partitions)
    finally:
        conf.set("spark.sql.streaming.stateStore.providerClass", before)
