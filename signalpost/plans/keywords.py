"""Rising keywords, change points of negative words and similar sub-periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.functions.series import poisson_pmf, rescale
from signalpost.functions.text import any_keyword, lexicon_count, terms as text_terms, weighted_terms
from signalpost.operators import aggregates, windows
from signalpost.operators.similar import best_windows
from signalpost.operators.tables import top_k

WEIGHTS = {"title": 5, "body": 2, "comments": 1}


def drop_terms(df: DataFrame, stop: DataFrame) -> DataFrame:
    """Terms without stop words."""
    return df.join(stop.select(F.col("word").alias("term")).distinct(), "term", "left_anti")


def rising_terms(counts: DataFrame, min_count: int, short: int = 7, long: int = 365,
                 only_above_expected: bool = False) -> DataFrame:
    """Poisson probability of a term's short count, given its long count; small means unusual."""
    kept = counts.filter((F.col("short_count") >= min_count) & (F.col("long_count") >= min_count))
    mean = F.col("long_count") * short / F.lit(float(long))
    out = kept.withColumn("expected", mean)
    out = out.filter(F.col("short_count") > F.col("expected")) if only_above_expected else out
    return out.select("term", "short_count", F.col("expected").cast("bigint").alias("expected_short_count"), "long_count",
                      poisson_pmf(F.col("short_count"), F.col("expected")).alias("poisson_score"))


def rising_keywords(posts: DataFrame, stop: DataFrame, today: str, weights: dict[str, int] = WEIGHTS, short: int = 7,
                    long: int = 365, k: int = 30) -> DataFrame:
    """The ``k`` most unusual terms of the last days.  Posts are reduced to term counts before stop words go."""
    found = weighted_terms(posts.select("upload_date", *weights), weights)
    counts = drop_terms(aggregates.term_windows(found, "upload_date", today, short, long), stop)
    scored = rising_terms(counts, sum(weights.values()) + 1, short, long)
    return scored.orderBy("poisson_score", "term").limit(k)


def term_links(posts: DataFrame, top: DataFrame, today: str, short: int = 7, links: int = 3) -> DataFrame:
    """First links of recent posts that hold a term of a short top list in title or body.

    ``top`` is a limited list; it enters the scan of the posts as one array value.
    """
    end = F.to_date(F.lit(today))
    recent = posts.filter((F.col("upload_date") > F.date_sub(end, short)) & (F.col("upload_date") <= end))
    wanted = top.agg(F.collect_list("term")).scalar()
    found = F.filter("_terms", lambda t: F.contains(F.col("title"), t) | F.contains(F.col("body"), t))
    hits = recent.withColumn("_terms", wanted).select("url", F.explode(found).alias("term"))
    return top_k(hits, ["term"], [F.col("url")], links, "link_rank")


def negative_change_points(posts: DataFrame, keywords: list[str], negative: list[str], start: str, end: str | None = None,
                           n: int = 7, min_periods: int | None = None, threshold: float = 1.1) -> DataFrame:
    """Days on which the running total of negative words of keyword posts bends."""
    picked = posts.filter(any_keyword([F.col("title"), F.col("body"), F.col("comments")], keywords))
    picked = picked.filter(F.col("upload_date") >= F.to_date(F.lit(start)))
    picked = picked.filter(F.col("upload_date") <= F.to_date(F.lit(end))) if end else picked
    counted = picked.select("upload_date", lexicon_count([F.col("title"), F.col("body"), F.col("comments")], negative).alias("n"))
    daily = aggregates.daily_counts(counted, "upload_date", "n")
    return windows.change_points(daily, "upload_date", "negative_words", n, min_periods, threshold)


def term_series(posts: DataFrame, weights: dict[str, int], terms: list[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily weighted counts of some terms on every day that has a post, 0 where a term is absent.

    The wanted terms are counted inside the array of a text's terms, so no other term becomes a row.  ``start`` and ``end`` (both included) limit the
    days that are read.
    """
    if start:
        posts = posts.filter(F.col("upload_date") >= F.to_date(F.lit(start)))
    if end:
        posts = posts.filter(F.col("upload_date") <= F.to_date(F.lit(end)))
    wanted = F.array(*[F.lit(t) for t in terms])
    fields = [(F.filter(text_terms(F.col(c), False), lambda t: F.array_contains(wanted, t)), w) for c, w in weights.items() if w]
    per_post = F.filter(F.transform(wanted, lambda t: F.struct(t.alias("term"), sum(
        (F.size(F.filter(found, lambda x: x == t)) * F.lit(w) for found, w in fields), F.lit(0)).cast("bigint").alias("weight"))), lambda x: x["weight"] > 0)
    counts = aggregates.term_days(posts.select("upload_date", F.inline(per_post)), "upload_date")
    days = posts.select("upload_date").distinct().select(
        "upload_date", F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"))
    return days.join(counts, ["upload_date", "term"], "left").na.fill(0, ["weight"])


def similar_period(series: DataFrame, base: str, other: str, today: str, base_days: int = 365, other_days: int = 10,
                   base_mean: int = 10, other_mean: int = 3, size: int = 10) -> DataFrame:
    """Part of the base term's year that is most like the other term's last days.

    ``series`` has (term, upload_date, weight).  Without days of the other term there is no result.  The other term's series is also returned rescaled into
    the range of the best window.
    """
    end = F.to_date(F.lit(today))

    def smooth(term: str, days: int, n: int) -> DataFrame:
        part = series.filter((F.col("term") == term) & (F.col("upload_date") > F.date_sub(end, days))
                             & (F.col("upload_date") <= end))
        return windows.rolling_mean(part, ["term"], "upload_date", "weight", n, "mean", 1)

    query = smooth(other, other_days, other_mean).agg(F.transform(F.sort_array(F.collect_list(F.struct("upload_date", "mean"))),
                                                                  lambda x: x["mean"])).scalar()
    best = best_windows(smooth(base, base_days, base_mean), ["term"], "upload_date", "mean", query, size)
    return best.withColumn("_query", query).withColumn("rescaled", rescale(F.col("_query"), F.col("window"))).drop("_query")
