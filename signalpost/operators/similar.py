"""Nearest past cases of monitored series by warping distance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalpost.functions.dtw import distances, dtw, paired_distances
from signalpost.functions.series import scores
from signalpost.operators.tables import top_k
from signalpost.scale import interval_join
from signalpost.session import cut

# Digits of a distance; blocks of cases whose extremes are sent to all tasks (80 bytes each).
DIGITS, MOST_BLOCKS = 9, 20_000


def case_windows(triggers: DataFrame, series: DataFrame, days: int = 90) -> DataFrame:
    """Points of a trigger's own series within ``days`` before and after it, both included."""
    day = F.unix_date("trigger_date")
    return interval_join(series, triggers, ["car_name", "issue"], F.unix_date("upload_date"),
                         day - days, day + days, width=2 * days + 1)


def known_case_windows(cases: DataFrame, series: DataFrame, months: int = 3) -> DataFrame:
    """Points of a known case within calendar months around its first news date."""
    day = F.try_element_at("news_dates", F.lit(1))
    return interval_join(series, cases.withColumn("news_date", day), ["car_name", "issue"], F.unix_date("upload_date"),
                         F.unix_date(F.add_months("news_date", -months)),
                         F.unix_date(F.add_months("news_date", months)), width=200)


def _lower_bounds(query: np.ndarray, lows, highs, firsts, lasts, sizes, matrix) -> np.ndarray:
    """Distances no warping can go below: both ends meet, and every point meets one of the other side."""
    ends = (query[0] - firsts) ** 2
    longer = (sizes > 1) | (len(query) > 1)
    ends = ends + np.where(longer, (query[-1] - lasts) ** 2, 0.0)
    outside = np.maximum(query[None, :] - highs[:, None], 0) + np.maximum(lows[:, None] - query[None, :], 0)
    reach = np.maximum(matrix - query.max(), 0) + np.maximum(query.min() - matrix, 0)
    reach = np.where(np.arange(matrix.shape[1])[None, :] < sizes[:, None], reach, 0.0)
    return np.sqrt(np.maximum(ends, np.maximum((outside ** 2).sum(axis=1), (reach ** 2).sum(axis=1))))


def _nearest_in_cell(k: int):
    def find(monitored: pd.DataFrame, cases: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(monitored) and len(cases):
            cases = cases.sort_values(["case_car", "case_issue", "trigger_date"], ignore_index=True)
            arrays = [np.asarray(s, dtype=float) for s in cases["case_scores"]]
            sizes = np.array([len(s) for s in arrays])
            matrix = np.zeros((len(arrays), max(sizes.max(), 1)))
            for row, values in enumerate(arrays):
                matrix[row, :len(values)] = values
            some = sizes > 0
            lows = np.array([s.min() if len(s) else np.inf for s in arrays])
            highs = np.array([s.max() if len(s) else -np.inf for s in arrays])
            firsts = matrix[:, 0]
            lasts = matrix[np.arange(len(arrays)), np.maximum(sizes - 1, 0)]
            car, issue = cases["case_car"].to_numpy(), cases["case_issue"].to_numpy()
            for row in monitored.itertuples(index=False):
                query = np.asarray(row.monitor_scores, dtype=float)
                open_cases = np.nonzero((car != row.car_name) & (issue != row.issue))[0]
                if not len(open_cases):
                    continue
                bound = np.full(len(open_cases), np.inf)
                usable = some[open_cases] & (len(query) > 0)
                if usable.any():
                    at = open_cases[usable]
                    bound[usable] = _lower_bounds(query, lows[at], highs[at], firsts[at], lasts[at], sizes[at], matrix[at])
                order = np.argsort(bound, kind="stable")
                best: list[tuple[float, int]] = []
                for at in range(0, len(order), 64):
                    block = order[at:at + 64]
                    farthest = min(best[-1][0] if len(best) == k else np.inf, row.limit)
                    if bound[block[0]] * (1 - 1e-12) > farthest + 10.0 ** -DIGITS:
                        break
                    chosen = open_cases[block]
                    exact = np.round(paired_distances([query] * len(chosen), [arrays[c] for c in chosen]), DIGITS)
                    best = sorted(best + list(zip(exact.tolist(), chosen.tolist())))[:k]
                found += [(row.car_name, row.issue, car[c], issue[c], cases["trigger_date"][c], d) for d, c in best]
        return pd.DataFrame(found, columns=["car_name", "issue", "case_car", "case_issue", "trigger_date", "distance"])
    return find


def envelopes(cases: DataFrame) -> DataFrame:
    """What bounds the cases of a block from below: ranges of their minima, maxima and ends.  One row per block."""
    ranges = []
    for name in ("_low", "_high", "_first", "_last"):
        ranges += [F.min(name).alias(f"least{name}"), F.max(name).alias(f"most{name}")]
    return cases.groupBy("_block").agg(F.max(F.size("case_scores")).alias("longest"), *ranges)


def block_bounds(query: np.ndarray, blocks: pd.DataFrame) -> np.ndarray:
    """Distance that no case of a block can go below; infinity without a case that has points.

    Both ends meet, every query point meets a point between the smallest minimum and the largest maximum, and the extremes of a case
    meet some point of the query.
    """
    if not len(query):
        return np.full(len(blocks), np.inf)

    def gap(value: float, name: str) -> np.ndarray:
        return np.maximum(value - blocks[f"most{name}"].to_numpy(), 0) + np.maximum(blocks[f"least{name}"].to_numpy() - value, 0)

    ends = gap(query[0], "_first") ** 2
    if len(query) > 1:  # else one step may join both ends
        ends = ends + gap(query[-1], "_last") ** 2
    low, high = blocks["least_low"].to_numpy(), blocks["most_high"].to_numpy()
    outside = np.maximum(query[None, :] - high[:, None], 0) + np.maximum(low[:, None] - query[None, :], 0)
    above = np.maximum(blocks["least_high"].to_numpy() - query.max(), 0) ** 2
    below = np.maximum(query.min() - blocks["most_low"].to_numpy(), 0) ** 2
    bound = np.sqrt(np.maximum(ends, np.maximum((outside ** 2).sum(axis=1), above + below)))
    return np.where(np.isnan(bound), np.inf, bound)


def _route(monitored: DataFrame, blocks: pd.DataFrame, nearest_only: bool) -> DataFrame:
    """Blocks each monitored series has to meet: the one with the smallest bound, or all whose bound is within its ``limit``."""
    def choose(frames):
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                bound = block_bounds(np.asarray(row.monitor_scores, dtype=float), blocks)
                if nearest_only:
                    chosen = blocks["_block"].to_numpy()[[int(np.argmin(bound))]]
                else:
                    chosen = blocks["_block"].to_numpy()[bound * (1 - 1e-12) <= row.limit + 10.0 ** -DIGITS]
                rows.append(chosen.tolist())
            yield frame.assign(_blocks=rows)

    fields = ", ".join(f"{n} {t}" for n, t in monitored.dtypes)
    return monitored.mapInPandas(choose, f"{fields}, _blocks array<int>").withColumn("_block", F.explode("_blocks")).drop("_blocks")


def _meet(routed: DataFrame, cases: DataFrame, k: int, monitor_block: int) -> DataFrame:
    """Best cases of every monitored series within each (block, part) it is sent to; groups have a bounded size on both sides."""
    shares = cut(routed.groupBy("_block").agg(F.ceil(F.count("*") / F.lit(monitor_block)).cast("int").alias("_shares")))
    # one row per block on both sides, so at most MOST_BLOCKS
    left = routed.join(F.broadcast(shares), "_block").withColumn("_share", F.pmod(F.xxhash64("car_name", "issue"), F.col("_shares")).cast("int"))
    left = left.withColumn("_part", F.explode("_parts")).drop("_shares", "_parts")
    copies = shares.select("_block", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share"))
    right = cases.join(copies, "_block")
    schema = "car_name string, issue string, case_car string, case_issue string, trigger_date date, distance double"
    keys = ["_block", "_part", "_share"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda m, c: _nearest_in_cell(k)(m, c), schema)


def nearest_cases(monitored: DataFrame, cases: DataFrame, k: int = 3, monitor_block: int = 512,
                  case_block: int = 2048) -> DataFrame:
    """The ``k`` nearest cases of every monitored series among cases of another car and another issue.

    ``monitored`` has (car_name, issue, monitor_scores), ``cases`` (case_car, case_issue, trigger_date,
    case_scores).  Cases are sorted by their maxima and ends into blocks of about ``case_block`` cases, and the extremes of
    each block are kept.  A first pass meets each series with the block of the smallest bound, which gives a distance that its
    ``k``-th best case cannot exceed; only blocks that may hold something nearer are met in the second.  Nothing is
    approximate: bounds only skip what is too far.  Ranks break ties by car, issue and date.  The cases are counted
    to choose the number of blocks, so pass stored tables.
    """
    blocks = min(-(-max(cases.count(), 1) // case_block), MOST_BLOCKS)
    keys = ["case_car", "case_issue", "trigger_date"]
    order = ["_high", "_last", *keys]
    scored = cases.select(*keys, "case_scores").withColumns({
        "_low": F.array_min("case_scores"), "_high": F.array_max("case_scores"),
        "_first": F.try_element_at("case_scores", F.lit(1)), "_last": F.try_element_at("case_scores", F.lit(-1))})
    dealt = scored.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id())
    per_block = Window.partitionBy("_block")
    dealt = cut(dealt.withColumn("_part", F.pmod(F.xxhash64(*keys), F.ceil(F.count("*").over(per_block) / F.lit(case_block))).cast("int")))
    known = envelopes(dealt).toPandas()  # MOST_BLOCKS rows at most
    if known.empty:
        return dealt.limit(0).selectExpr("'' AS car_name", "'' AS issue", "case_car", "case_issue", "trigger_date", "0D AS distance", "0 AS rank")
    parts = dealt.groupBy("_block").agg(F.array_sort(F.collect_set("_part")).alias("_all"))
    plain = dealt.select(*keys, "case_scores", "_block", "_part")
    # First pass: one part of one block.
    pilots = cut(_route(monitored.select("car_name", "issue", "monitor_scores"), known, True).join(F.broadcast(parts), "_block")
                 .withColumn("_parts", F.slice("_all", 1, 1)).drop("_all").withColumn("limit", F.lit(float("inf"))))
    first = cut(_meet(pilots, plain, k, monitor_block))
    limits = first.groupBy("car_name", "issue").agg(F.count("*").alias("_n"), F.max("distance").alias("_kth"))
    pair = ["car_name", "issue"]
    renamed = limits.select(*[F.col(c).alias(f"_{c}") for c in pair], "_n", "_kth")
    same = F.col("car_name").eqNullSafe(F.col("_car_name")) & F.col("issue").eqNullSafe(F.col("_issue"))
    limited = pilots.withColumnRenamed("_block", "_met").drop("limit", "_parts").join(renamed, same, "left").withColumn(
        "limit", F.when(F.col("_n") == k, F.col("_kth")).otherwise(F.lit(float("inf")))).drop("_car_name", "_issue", "_n", "_kth")
    # Second pass: what may be nearer, without what was met.
    routed = _route(limited, known, False).join(F.broadcast(parts), "_block")
    rest = F.when(F.col("_block") == F.col("_met"), F.slice("_all", 2, F.size("_all"))).otherwise(F.col("_all"))
    routed = cut(routed.withColumn("_parts", rest).drop("_all", "_met").filter(F.size("_parts") > 0))
    found = first.unionByName(_meet(routed, plain, k, monitor_block))
    order = [F.col("distance"), F.col("case_car"), F.col("case_issue"), F.col("trigger_date")]
    return top_k(found, ["car_name", "issue"], order, k, "rank")


def candidate_counts(monitored: DataFrame, cases: DataFrame) -> DataFrame:
    """How many cases of another car and another issue every monitored series is compared with.

    Counted from four small groupings (all - same car - same issue + same pair), without pairing.
    """
    total = cases.agg(F.count("*")).scalar()
    by_car = cases.groupBy(F.col("case_car").alias("car_name")).agg(F.count("*").alias("_car"))
    by_issue = cases.groupBy(F.col("case_issue").alias("issue")).agg(F.count("*").alias("_issue"))
    by_both = cases.groupBy(F.col("case_car").alias("car_name"), F.col("case_issue").alias("issue")).agg(
        F.count("*").alias("_both"))
    joined = (monitored.select("car_name", "issue").join(by_car, "car_name", "left").join(by_issue, "issue", "left")
              .join(by_both, ["car_name", "issue"], "left").na.fill(0, ["_car", "_issue", "_both"]))
    return joined.select("car_name", "issue", (total - F.col("_car") - F.col("_issue") + F.col("_both")).alias("candidates"))


def rank_known_cases(known: DataFrame, monitored_scores, k: int = 5) -> DataFrame:
    """Known cases by distance to one monitored series, the ``k`` nearest.

    ``known`` has (car_name, issue, series); ``monitored_scores`` is an array column, such as a
    scalar subquery with the monitored series.
    """
    measured = known.select("car_name", "issue", "series", dtw(scores(F.col("series")), monitored_scores).alias("distance"))
    measured = measured.withColumn("distance", F.round("distance", DIGITS))
    return measured.orderBy("distance", "car_name", "issue").limit(k)


def _window_bounds(windows: np.ndarray, sizes: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Absolute-cost distance no warping of a window and the query can go below: both ends meet, and points outside the other's range stay away."""
    inside = np.arange(windows.shape[1])[None, :] < sizes[:, None]
    ends = np.abs(windows[:, 0] - query[0])
    ends = ends + np.where((sizes > 1) | (len(query) > 1), np.abs(windows[np.arange(len(sizes)), sizes - 1] - query[-1]), 0.0)
    low = np.where(inside, windows, np.inf).min(axis=1)[:, None]
    high = np.where(inside, windows, -np.inf).max(axis=1)[:, None]
    outside = (np.maximum(query[None, :] - high, 0) + np.maximum(low - query[None, :], 0)).sum(axis=1)
    reach = np.where(inside, np.maximum(windows - query.max(), 0) + np.maximum(query.min() - windows, 0), 0.0).sum(axis=1)
    return np.maximum(ends, np.maximum(outside, reach))


def nearest_window(values: list, query: list, size: int, block: int = 64, counted: list | None = None) -> tuple | None:
    """(start, distance, window) of the window of one series that is nearest to the query, the earliest at ties; None without one.

    All windows are rows of one view of the series.  They are met in the order of their lower bounds, a block at a time, and what is left is given
    up once its bounds are above the best distance.
    """
    data, query = np.asarray(values, dtype=float), np.asarray(query, dtype=float)
    count = len(data) - len(query) + 1
    if count <= 0 or not len(query):
        return None
    padded = np.r_[data, np.zeros(size - 1)]
    windows = np.lib.stride_tricks.sliding_window_view(padded, size)[:count]
    sizes = np.minimum(size, len(data) - np.arange(count))
    bounds = _window_bounds(windows, sizes, query)
    order = np.argsort(bounds, kind="stable")
    best = (np.inf, -1)
    for at in range(0, count, block):
        chosen = order[at:at + block]
        if bounds[chosen[0]] * (1 - 1e-12) > best[0] + 10.0 ** -DIGITS:
            break
        repeated = np.broadcast_to(query, (len(chosen), len(query)))
        exact = np.round(distances(windows[chosen], sizes[chosen], repeated, np.full(len(chosen), len(query)), False, best[0] + 10.0 ** -DIGITS), DIGITS)
        best = min(best, *zip(exact.tolist(), chosen.tolist()))
        if counted is not None:
            counted.append(len(chosen))
    start = best[1]
    return (start, best[0], windows[start][:sizes[start]].tolist()) if start >= 0 else None


def best_windows(df: DataFrame, keys: list[str], order: str, col: str, query: Column, size: int) -> DataFrame:
    """Window of ``size`` consecutive points with the smallest absolute-cost distance to a query array, per key.

    A window starts at any point from which the series is at least as long as the query; the last ones may be shorter than ``size``.  A series is one array
    (a value per day at most) and its windows are never rows.  Rows without a value do not count.
    """
    kind = "struct<start:int,distance:double,window:array<double>>"

    @F.pandas_udf(kind)
    def nearest(series: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        found = [nearest_window(s, q, size) if s is not None and q is not None else None for s, q in zip(series, wanted)]
        rows = [f if f else (-1, np.nan, None) for f in found]
        return pd.DataFrame(rows, columns=["start", "distance", "window"])

    points = df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, F.col(col).cast("double").alias("_v")))).alias("_p"))
    best = points.withColumn("_b", nearest(F.transform("_p", lambda p: p["_v"]), query))
    return best.filter(F.col("_b.start") >= 0).select(*keys, "_b.*")
