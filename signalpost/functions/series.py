"""Column expressions over series held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift_series(series: Column, days: Column) -> Column:
    """Move every date of a nested series; dates become text."""
    return F.transform(series, lambda x: F.struct(
        F.date_add(x["upload_date"], days).cast("string").alias("upload_date"),
        x["norm_graph_score"].alias("norm_graph_score")))


def scores(series: Column) -> Column:
    """Scores of a nested series without nulls."""
    return F.filter(F.transform(series, lambda x: x["norm_graph_score"]), lambda v: v.isNotNull())


def scores_until(series: Column, day: Column) -> Column:
    """Scores up to a day, the day included."""
    return scores(F.filter(series, lambda x: x["upload_date"] <= day))


def rescale(values: Column, other: Column) -> Column:
    """Values stretched into the smallest..largest range of another array."""
    low, high = F.array_min(values), F.array_max(values)
    to_low, to_high = F.array_min(other), F.array_max(other)
    return F.transform(values, lambda v: F.try_divide(v - low, high - low) * (to_high - to_low) + to_low)


def shift_date(asof: str, day: Column, start: Column) -> Column:
    """Day moved so that ``start`` falls on the run date."""
    return F.date_add(F.to_date(F.lit(asof[:10])), F.datediff(day, start))


def log_factorial(k: Column, exact_below: int = 256) -> Column:
    """Natural logarithm of k!: summed for small k, by Stirling's series (error below 1e-17) above."""
    x = k.cast("double")
    summed = F.aggregate(F.when((k > 0) & (k < exact_below), F.sequence(F.lit(1), k.cast("int")))
                         .otherwise(F.array(F.lit(1))),
                         F.lit(0.0), lambda acc, i: acc + F.log(i.cast("double")))
    stirling = (x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x)
                + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)))
    return F.when(k < exact_below, summed).otherwise(stirling)


def poisson_pmf(k: Column, mean: Column) -> Column:
    """Probability of ``k`` events where ``mean`` are expected."""
    log_mean = F.when(mean > 0, F.log(mean))
    return F.exp(k * log_mean - mean - log_factorial(k))
