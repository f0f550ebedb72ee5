"""Window and time-series operators over daily series.

A series has at most one row per day, so its length is bounded by the calendar, not by the posts.
``keys`` may be empty for one overall series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def ema(df: DataFrame, keys: list[str], order: str, columns: dict[str, tuple[str, float]]) -> DataFrame:
    """Exponential moving averages that start with the first value of a series.

    ``columns`` maps an output name to (input column, alpha); all averages share one pass.  With
    ``q = 1 - alpha`` the average is ``q^i * sum(w_j * v_j * q^-j)``, a running sum.  ``q^-j`` grows, so
    long series are cut into stretches short enough for doubles.  A stretch needs only the result at the
    end of the one before: the weight of older stretches is below 1e-17.
    """
    rates = [alpha for _, alpha in columns.values() if alpha < 1]
    if any(not 0 < alpha <= 1 for _, alpha in columns.values()):
        raise ValueError("alpha must be above 0 and at most 1")
    stretch = min([int(500 / -math.log(1 - alpha)) for alpha in rates], default=1) or 1
    if any((1 - alpha) ** stretch > 1e-17 for alpha in rates):  # too different for one stretch length
        for out, spec in columns.items():
            df = ema(df, keys, order, {out: spec})
        return df
    series = _over(keys, order)
    df = df.withColumn("_i", F.row_number().over(series) - 1)
    df = df.withColumns({"_s": F.floor(F.col("_i") / stretch), "_r": (F.col("_i") % stretch)})
    inside = Window.partitionBy(*keys, "_s").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    local, full = {}, {}
    for out, (col, alpha) in columns.items():
        q = F.lit(1.0 - alpha)
        weight = F.when(F.col("_i") == 0, F.lit(1.0)).otherwise(F.lit(alpha))
        local[f"_{out}"] = F.pow(q, F.col("_r")) * F.sum(weight * F.col(col) * F.pow(q, -F.col("_r"))).over(inside)
        ended = F.when(F.col("_r") == stretch - 1, F.col(f"_{out}"))
        carried = F.coalesce(F.last(ended, True).over(before), F.lit(0.0))
        full[out] = F.col(f"_{out}") + carried * F.pow(q, F.col("_r") + 1)
        if alpha == 1:
            local[f"_{out}"], full[out] = F.col(col).cast("double"), F.col(f"_{out}")
    return df.withColumns(local).withColumns(full).drop("_i", "_s", "_r", *local)


def score(df: DataFrame, features: list[str], out: str = "score") -> DataFrame:
    """Product of features."""
    product = F.col(features[0])
    for feature in features[1:]:
        product = product * F.col(feature)
    return df.withColumn(out, product)


def detect_triggers(df: DataFrame, keys: list[str], order: str, col: str, window: int = 7, k: float = 2.1,
                    ddof: int = 0, two_sided: bool = False) -> DataFrame:
    """Rows that stand out from the window of rows that ends with them, the row included.

    One-sided with population deviation by default.  With ``two_sided`` falls count as well, and the
    first tested row is one later.  A small tolerance keeps flat windows quiet.
    """
    frame = _over(keys, order).rowsBetween(-(window - 1), 0)
    mean = F.avg(col).over(frame)
    deviation = (F.stddev_samp(col) if ddof else F.stddev_pop(col)).over(frame)
    df = df.withColumns({"_mean": mean, "_dev": deviation, "_n": F.count(col).over(frame),
                         "_row": F.row_number().over(_over(keys, order))})
    gap = F.col(col) - F.col("_mean")
    gap = F.abs(gap) if two_sided else gap
    first = window + 1 if two_sided else window
    hit = (gap > k * F.col("_dev") + 1e-12 * F.abs(F.col("_mean"))) & (F.col("_n") == window) & (F.col("_row") >= first)
    return df.filter(hit).drop("_mean", "_dev", "_n", "_row")


def rolling_mean(df: DataFrame, keys: list[str], order: str, col: str, n: int, out: str,
                 min_periods: int | None = None) -> DataFrame:
    """Mean of the last ``n`` rows, null with fewer than ``min_periods`` values (default ``n``)."""
    frame = _over(keys, order).rowsBetween(-(n - 1), 0)
    enough = F.count(col).over(frame) >= (n if min_periods is None else min_periods)
    return df.withColumn(out, F.when(enough, F.avg(col).over(frame)))


def diff(df: DataFrame, keys: list[str], order: str, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(col) - F.lag(col).over(_over(keys, order)))


def cumsum(df: DataFrame, keys: list[str], order: str, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.sum(col).over(_over(keys, order).rowsBetween(Window.unboundedPreceding, 0)))


def change_points(daily: DataFrame, order: str, col: str, n: int = 7, min_periods: int | None = None,
                  threshold: float = 1.1, keys: list[str] = ()) -> DataFrame:
    """Days on which the smoothed running total bends: z-score of its first difference."""
    from signalpost.operators.aggregates import z_scores
    keys = list(keys)
    df = cumsum(daily, keys, order, col, "cumulative")
    df = rolling_mean(df, keys, order, "cumulative", n, "smoothed", min_periods)
    df = diff(df, keys, order, "smoothed", "gradient")
    return z_scores(df, "gradient", "z", keys).filter(F.abs("z") > threshold)


def date_spine(df: DataFrame, keys: list[str], date: str, fill: list[str], overall: bool = False) -> DataFrame:
    """Every day between the first and last day of a key, missing values 0.

    With ``overall`` all keys run over the first and last day of the whole table.
    """
    last = F.max(date).alias("_last")
    spans = df.groupBy(*keys).agg(F.min(date).alias("_first"), last)
    if overall:
        ends = df.agg(F.struct(F.min(date).alias("a"), F.max(date).alias("b"))).scalar()
        spans = spans.withColumns({"_first": ends["a"], "_last": ends["b"]})
    days = spans.select(*keys, F.explode(F.sequence("_first", "_last")).alias(date))
    return days.join(df, [*keys, date], "left").na.fill(0, fill)


def gradient(df: DataFrame, keys: list[str], order: str, col: str, out: str = "slope") -> DataFrame:
    """Central difference per row step, one-sided at both ends."""
    w = _over(keys, order)
    before, after = F.lag(col).over(w), F.lead(col).over(w)
    slope = (F.when(before.isNull(), after - F.col(col)).when(after.isNull(), F.col(col) - before)
             .otherwise((after - before) / 2))
    return df.withColumn(out, slope)


def keep_with_gap(dates: Column, min_gap: int) -> Column:
    """From sorted dates keep the first, then each that is over ``min_gap`` days after the last kept."""
    start = F.array().cast("array<date>")
    return F.aggregate(dates, start, lambda kept, d: F.when(
        (F.size(kept) == 0) | (F.datediff(d, F.try_element_at(kept, F.lit(-1))) > min_gap),
        F.concat(kept, F.array(d))).otherwise(kept))


def slope_alarms(df: DataFrame, keys: list[str], date: str, col: str, threshold: float, min_gap: int = 15) -> DataFrame:
    """Days with a steep slope; an alarm is quiet for ``min_gap`` days after a kept one."""
    steep = gradient(df, keys, date, col)
    steep = steep.withColumn("_row", F.row_number().over(_over(keys, date)))
    steep = steep.filter((F.col("_row") > 1) & (F.abs("slope") > threshold))
    days = steep.groupBy(*keys).agg(F.sort_array(F.collect_list(date)).alias("_days"))
    return days.select(*keys, F.explode(keep_with_gap(F.col("_days"), min_gap)).alias(date))


def sliding_windows(df: DataFrame, keys: list[str], order: str, col: str, size: int, query_length: int) -> DataFrame:
    """Windows of ``size`` consecutive points; starts 0 .. n - query_length, the last may be shorter."""
    w = _over(keys, order)
    ahead = w.rowsBetween(0, size - 1)
    whole = Window.partitionBy(*keys)
    out = df.select(*keys, (F.row_number().over(w) - 1).alias("start"), F.collect_list(col).over(ahead).alias("window"),
                    F.count(F.lit(1)).over(whole).alias("_n"))
    return out.filter(F.col("start") <= F.col("_n") - query_length).drop("_n")


def threads(df: DataFrame, key: str, position: str, is_top: Column, text: str, limit: int = 10_000) -> DataFrame:
    """Comment threads: a top-level comment opens one, replies follow on new lines.

    Replies before the first top-level comment form thread 0.  The thread number is a running sum
    spread over the comments of a post; a thread of more than ``limit`` comments is given in several parts, counted
    from its first comment.
    """
    from signalpost.scale import running_sum
    marked = df.withColumns({"_top": F.when(is_top, 1).otherwise(0), "_one": F.lit(1)})
    numbered = running_sum(running_sum(marked, [key], position, "_top", "thread"), [key], position, "_one", "_count")
    # Only threads over the limit have more than part 0, at most one row per ``limit`` comments.
    begin = numbered.groupBy(key, "thread").agg(F.min("_count").alias("_begin"), F.count("*").alias("_size")).filter(F.col("_size") > limit)
    begin = begin.withColumnsRenamed({key: "_key", "thread": "_thread"})
    numbered = numbered.join(begin, F.col(key).eqNullSafe(F.col("_key")) & F.col("thread").eqNullSafe(F.col("_thread")), "left")
    return (numbered.withColumn("part", F.coalesce(F.floor((F.col("_count") - F.col("_begin")) / limit), F.lit(0)))
            .groupBy(key, "thread", "part")
            .agg(F.sort_array(F.collect_list(F.struct(position, text))).alias("_c"))
            .select(key, "thread", "part", F.array_join(F.transform("_c", lambda c: c[text]), "\n").alias("text"),
                    F.size("_c").alias("comments")))
