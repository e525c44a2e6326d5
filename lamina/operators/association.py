"""Tests and models over counts: exclusion of features, k-mer distances of samples, depth as a negative binomial."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from .sequences import kmer_counts


def log_factorials(spark, most: int) -> DataFrame:
    """One row: lf, the logarithms of 0! to most!."""
    return spark.createDataFrame([([math.lgamma(i + 1) for i in range(most + 1)],)], "lf array<double>")


def _log_choose(n: Column, k: Column) -> Column:
    return F.get("lf", n) - F.get("lf", k) - F.get("lf", n - k)


def hypergeometric_below(x: Column, a: Column, b: Column, n: Column) -> Column:
    """The chance that two random sets of a and b of n samples share x or fewer; needs a column lf."""
    least = F.greatest(a + b - n, F.lit(0).cast("int"))
    term = lambda i: F.exp(_log_choose(a, i) + _log_choose(n - a, b - i) - _log_choose(n, b))
    total = F.aggregate(F.sequence(least, F.greatest(x, least)), F.lit(0.0), lambda s, i: s + term(i))
    return F.when(x < least, 0.0).otherwise(F.least(total, F.lit(1.0)))


def co_exclusion_test(presence: DataFrame, most_p: float = 1e-5) -> DataFrame:
    """(a, b, na, nb, shared, p) of features a < b that share so few samples that chance explains it with at most most_p.

    presence has (feature, sample).  How often a pair can share by chance depends on the two
    numbers of samples alone: pairs of numbers that even no shared sample wouldn't make
    significant are left out before any feature meets another.  Samples shared are counted
    only among features that remain, and pairs that share none come from the numbers.
    """
    spark = presence.sparkSession
    own = cut(presence.select("feature", "sample").filter("feature is not null and sample is not null").distinct())
    n = own.select("sample").distinct().count()
    sizes = cut(own.groupBy("feature").agg(F.count("*").cast("int").alias("n")))
    # There are at most as many numbers as samples; their pairs are a small table.
    kinds = sizes.select("n").distinct()
    table = log_factorials(spark, n)
    pairs = kinds.select(F.col("n").alias("na")).join(kinds.select(F.col("n").alias("nb")), F.col("na") <= F.col("nb")).crossJoin(F.broadcast(table))  # one row
    able = cut(pairs.filter(hypergeometric_below(F.lit(0), F.col("na"), F.col("nb"), F.lit(n)) <= most_p).select("na", "nb"))
    able = able.unionByName(able.filter("na != nb").select(F.col("nb").alias("na"), F.col("na").alias("nb")))
    live = sizes.join(able.select(F.col("na").alias("n")).distinct(), "n", "left_semi")
    one, two = live.select(F.col("feature").alias("a"), F.col("n").alias("na")), live.select(F.col("feature").alias("b"), F.col("n").alias("nb"))
    candidates = one.join(able, "na").join(two, "nb").filter("a < b")
    here = own.join(live.select("feature"), "feature", "left_semi")
    x, y = here.select(F.col("feature").alias("a"), "sample"), here.select(F.col("feature").alias("b"), "sample")
    shared = x.join(y, "sample").filter("a < b").groupBy("a", "b").agg(F.count("*").cast("int").alias("shared"))
    tested = candidates.join(shared, ["a", "b"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))
    # Above the mean of shared samples the chance of so few is near a half or more.
    few = tested.filter(F.col("shared") <= F.col("na") * F.col("nb") / F.lit(float(max(n, 1))))
    p = few.crossJoin(F.broadcast(table)).withColumn("p", hypergeometric_below(F.col("shared"), F.col("na"), F.col("nb"), F.lit(n)))  # one row
    return p.filter(F.col("p") <= most_p).select("a", "b", "na", "nb", "shared", "p")


def _base_codes(k: int) -> np.ndarray:
    """Bases (0 to 3) of each k-mer code."""
    return (np.arange(4**k)[:, None] >> (2 * np.arange(k)[::-1])) & 3


def sample_distances(seqs: DataFrame, k: int = 6, both_strands: bool = True, block: int = 64) -> DataFrame:
    """(a, b, dist) of samples a < b by the d2S dissimilarity of their k-mers; seqs has (sample, seq).

    A sample's counts are centred by what its own base frequencies lead to expect; the product of
    two samples' centred counts is divided, word by word, by the root of the sum of their
    squares.  dist is 0 for equal directions and up to 1; without any k-mer it is null.
    Samples are vectors of 4^k counts, dealt into blocks that meet once each.
    """
    kind = dict(seqs.dtypes)["sample"]
    code = F.conv(F.translate("kmer", "ACGT", "0123"), 4, 10).cast("int")
    counts = kmer_counts(seqs.filter("sample is not null"), "sample", "seq", k, both_strands=both_strands)
    vectors = cut(counts.groupBy("sample", "kmer").agg(F.sum("n").alias("n")).groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct(code, F.col("n")))).alias("v")))
    every = seqs.select("sample").filter("sample is not null").distinct().join(vectors, "sample", "left")
    blocks = max(1, -(-every.count() // block))
    dealt = every.withColumn("i", F.pmod(F.xxhash64("sample"), F.lit(blocks))).select("sample", "v", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("j"))
    dealt = dealt.select("sample", "v", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), (F.col("i") > F.col("j")).alias("side"))
    bases = _base_codes(k)

    def centred(maps) -> np.ndarray:
        out = np.zeros((len(maps), 4**k))
        for row, m in zip(out, maps, strict=True):
            if m:
                row[np.fromiter(m.keys(), int)] = np.fromiter(m.values(), float)
                share = np.bincount(bases.ravel(), weights=np.repeat(row, k), minlength=4)
                row -= row.sum() * (share / share.sum())[bases].prod(axis=1)
        return out

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        one = g["p"].iloc[0] == g["q"].iloc[0]
        left, right = (g, g) if one else (g[~g["side"]], g[g["side"]])
        x, y = centred(left["v"]), centred(right["v"])
        names, found = right["sample"].to_numpy(), []
        for a, u in zip(left["sample"], x, strict=True):
            root = np.sqrt(u * u + y * y)
            weight = np.divide(1.0, root, out=np.zeros_like(root), where=root > 0)
            size = np.sqrt((u * u * weight).sum(axis=1) * (y * y * weight).sum(axis=1))
            near = np.divide((u * y * weight).sum(axis=1), size, out=np.full(len(y), np.nan), where=size > 0)
            for b, d in zip(names, 0.5 * (1 - near), strict=True):
                if a < b or (not one and a != b):
                    found.append((min(a, b), max(a, b), None if d != d else float(d)))
        return pd.DataFrame(found, columns=["a", "b", "dist"])

    return dealt.groupBy("p", "q").applyInPandas(compare, f"a {kind}, b {kind}, dist double")


def fit_negative_binomial(depths: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(mean, size) of the likeliest negative binomial for depths that occur counts times; size is infinite if they vary no more than by chance.

    The mean is that of the depths.  The score of the size k is a sum over how many depths
    exceed each number: with t[j] depths above j it is sum t[j] / (k + j) - n log(1 + mean / k),
    so Newton's steps need no special functions; they are taken in log k and halved on the way out.
    """
    n = counts.sum()
    if not n:
        return math.nan, math.nan
    mean = float((depths * counts).sum() / n)
    variance = float((counts * (depths - mean) ** 2).sum() / n)
    if variance <= mean or mean <= 0:
        return mean, math.inf
    top = int(depths.max())
    above = n - np.cumsum(np.bincount(depths, weights=counts, minlength=top + 1))[:top]  # t[j], j from 0
    j = np.arange(top)
    score = lambda k: float((above / (k + j)).sum() - n * math.log1p(mean / k))
    k = mean * mean / (variance - mean)
    for _ in range(rounds):
        slope = float(-(above / (k + j) ** 2).sum() + n * mean / (k * (k + mean)))
        step = score(k) / (slope * k) if slope < 0 else -math.copysign(1.0, score(k))
        step = max(-1.0, min(1.0, step))
        k *= math.exp(-step)
        if abs(step) < 1e-12:
            break
    return mean, k


def depth_model(depths: DataFrame, key: str) -> DataFrame:
    """(key, n, mean, size, loglik): a negative binomial for the depths (key, depth) of each key.

    Depths are counted first, so that what a task holds of a key is its different depths.
    loglik is the log likelihood of all depths; a key without overdispersion is a Poisson.
    """
    kind = dict(depths.dtypes)[key]
    counted = depths.filter("depth >= 0").groupBy(key, F.col("depth").cast("long").alias("depth")).agg(F.count("*").alias("n"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        d, c = g["depth"].to_numpy(), g["n"].to_numpy()
        mean, size = fit_negative_binomial(d, c)
        if math.isinf(size):
            each = [x * math.log(mean) - mean - math.lgamma(x + 1) if mean > 0 else 0.0 for x in d]
        else:
            each = [math.lgamma(x + size) - math.lgamma(size) - math.lgamma(x + 1) + size * math.log(size / (size + mean)) + x * math.log(mean / (size + mean)) for x in d]
        return pd.DataFrame({key: [g[key].iloc[0]], "n": [int(c.sum())], "mean": [mean], "size": [None if math.isinf(size) else size], "loglik": [float(np.dot(each, c))]})

    return counted.groupBy(key).applyInPandas(run, f"`{key}` {kind}, n long, mean double, size double, loglik double")
