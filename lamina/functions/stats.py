"""Quantiles, ranks, correlations and rounding as column expressions and grouped aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import running


def round_half_up(x: Column, digits: int = 0) -> Column:
    """floor(x * 10**digits + 1/2) / 10**digits."""
    f = float(10**digits)
    return F.floor(x * f + 0.5) / f


def true_median(x: Column) -> Column:
    return F.percentile(x, F.lit(0.5))


def quantile_linear(x: Column, q: float) -> Column:
    """Linear interpolation between order statistics (R-7)."""
    return F.percentile(x, F.lit(q))


def _ordered(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts per value with the cumulative count up to it: no group's rows are gathered, and without keys the values are summed up in ranges."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    if not keys:
        up = running(counts, [value], "_n", "_from").withColumn("_to", F.col("_from") + F.col("_n")).drop("_from")
        return up.crossJoin(F.broadcast(up.agg(F.sum("_n").alias("_all"))))  # one row
    w = Window.partitionBy(*keys).orderBy(value)
    total = Window.partitionBy(*keys)
    return counts.withColumn("_to", F.sum("_n").over(w)).withColumn("_all", F.sum("_n").over(total))


def quantile_nearest(df: DataFrame, keys: list[str], value: str, q: float, name: str) -> DataFrame:
    """Per group the order statistic with index int((n - 1) * q + 0.5)."""
    o = _ordered(df, keys, value)
    at = F.floor((F.col("_all") - 1) * F.lit(q) + 0.5)
    return o.filter((F.col("_to") > at) & (F.col("_to") - F.col("_n") <= at)).select(*keys, F.col(value).alias(name))


def quantile_floor(df: DataFrame, keys: list[str], value: str, q: float, name: str) -> DataFrame:
    """Per group the order statistic with index int(n * q), the last one at q = 1."""
    o = _ordered(df, keys, value)
    at = F.least(F.floor(F.col("_all") * F.lit(q)), F.col("_all") - 1)
    return o.filter((F.col("_to") > at) & (F.col("_to") - F.col("_n") <= at)).select(*keys, F.col(value).alias(name))


def fractional_ranks(df: DataFrame, keys: list[str], value: str, name: str = "rank") -> DataFrame:
    """0-based ranks in which ties share their mean rank."""
    o = _ordered(df, keys, value).select(*keys, value, (F.col("_to") - F.col("_n") + (F.col("_n") - 1) / 2.0).alias(name))
    same = [df[k].eqNullSafe(o[k]) for k in keys] + [df[value] == o[value]]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return df.join(o, on).select(df["*"], o[name])


def pearson(x: Column, y: Column, n: Column | None = None) -> Column:
    """Pearson correlation from sums; 0 if either variance or the covariance is 0."""
    n = F.count(F.lit(1)) if n is None else n
    sx, sy, sxy = F.sum(x), F.sum(y), F.sum(x * y)
    vx, vy = F.sum(x * x) - sx * sx / n, F.sum(y * y) - sy * sy / n
    cov = sxy - sx * sy / n
    return F.when((vx <= 1e-12) | (vy <= 1e-12) | (cov == 0), F.lit(0.0)).otherwise(cov / F.sqrt(vx * vy))


def spearman_from_ranks(rx: Column, ry: Column) -> Column:
    """1 - 6 sum d**2 / (n (n**2 - 1)) over pairs of ranks."""
    n = F.count(F.lit(1)).cast("double")
    d = rx - ry
    return F.when(n > 1, 1.0 - 6.0 * F.sum(d * d) / (n * (n * n - 1.0)))


def non_zero(x: Column) -> Column:
    return F.count_if(x != 0)


def histogram(x: Column, edges: list[float]) -> Column:
    """Index of the last edge that isn't above x, 0 below all."""
    out = F.lit(0)
    for i, e in enumerate(edges):
        out = F.when(x >= e, F.lit(i + 1)).otherwise(out)
    return out


def watterson_theta(segregating: Column, n: Column) -> Column:
    """S / sum of 1/i for i < n."""
    return segregating / F.aggregate(F.sequence(F.lit(1), n.cast("int") - 1), F.lit(0.0), lambda a, i: a + 1.0 / i)
