"""Trigger detection as state: two averages and the last scores of every series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from signalpost.streaming.ingest import run_to_folder
from signalpost.streaming.totals import daily_feature_stream

OUT = "car_name string, issue string, upload_date date, score double, is_trigger boolean"
DAY = "car_name string, issue string, upload_date date, avg_log_view double, sum_log_like double"
STATE = "view double, like double, scores array<double>"
STATE_PARTITIONS = 16  # posts are summed before they are shuffled, so the state has a row per open day or series


def trigger_stream(days: DataFrame, alpha: float = 0.05, beta: float = 0.02, window: int = 7, k: float = 2.1) -> DataFrame:
    """Scores and trigger flags of closed days.

    Input rows are closed days (car_name, issue, upload_date, avg_log_view, sum_log_like); the days of
    a series must arrive in order across batches, within a batch they are sorted here.
    """
    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        view, like, recent = (*state.get[:2], list(state.get[2])) if state.exists else (None, None, [])
        rows = pd.concat(list(batches)).sort_values("upload_date")
        out = []
        for row in rows.itertuples(index=False):
            view = row.avg_log_view if view is None else (1 - alpha) * view + alpha * row.avg_log_view
            like = row.sum_log_like if like is None else (1 - beta) * like + beta * row.sum_log_like
            score = view * like
            recent = [*recent, score][-window:]
            mean = float(np.mean(recent))
            hit = len(recent) == window and score - mean > k * float(np.std(recent)) + 1e-12 * abs(mean)
            out.append((key[0], key[1], row.upload_date, score, bool(hit)))
        state.update((float(view), float(like), [float(v) for v in recent]))
        yield pd.DataFrame(out, columns=["car_name", "issue", "upload_date", "score", "is_trigger"])

    return days.groupBy("car_name", "issue").applyInPandasWithState(
        step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def trigger_chain(posts: DataFrame, limits: DataFrame, folder: str, state_partitions: int | None = STATE_PARTITIONS) -> DataFrame:
    """Run all available labelled posts through daily features and triggers; returns all scores found so far.

    Both steps keep their output and state below ``folder``, so the next call goes on from there.  A day is scored
    once the watermark has closed it.  ``state_partitions`` has to grow with the number of series, not of posts; None takes the session's.
    """
    run_to_folder(daily_feature_stream(posts, limits), f"{folder}/days", f"{folder}/days-state", state_partitions=state_partitions)
    days = posts.sparkSession.readStream.schema(DAY).parquet(f"{folder}/days")
    return run_to_folder(trigger_stream(days), f"{folder}/triggers", f"{folder}/triggers-state", state_partitions=state_partitions)
