"""Correlation of abundance profiles and assignment of genes to species by it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stats
from ..shared import cut


def profile_correlation(pairs: DataFrame, abund: DataFrame, n_samples: int) -> DataFrame:
    """Pearson correlation over n_samples samples of each pair (a, b) of sparse profiles (feature, sample, value); missing is 0."""
    s = abund.groupBy("feature").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    x, y = abund.select(F.col("feature").alias("a"), "sample", F.col("value").alias("x")), abund.select(F.col("feature").alias("b"), "sample", F.col("value").alias("y"))
    dot = pairs.join(x, "a").join(y, ["b", "sample"]).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("d"))
    sa, sb = s.select(F.col("feature").alias("a"), F.col("s").alias("sa"), F.col("ss").alias("qa")), s.select(F.col("feature").alias("b"), F.col("s").alias("sb"), F.col("ss").alias("qb"))
    j = pairs.join(dot, ["a", "b"], "left").join(sa, "a").join(sb, "b")
    n = float(n_samples)
    va, vb = F.col("qa") - F.col("sa") * F.col("sa") / n, F.col("qb") - F.col("sb") * F.col("sb") / n
    cov = F.coalesce("d", F.lit(0.0)) - F.col("sa") * F.col("sb") / n
    r = F.when((va <= 1e-12) | (vb <= 1e-12), 0.0).otherwise(cov / F.sqrt(va * vb))
    return j.select("a", "b", stats.round_half_up(r, 4).alias("r"))


def spearman(pairs: DataFrame) -> DataFrame:
    """Spearman correlation per key of rows (key, x, y), by the formula on ranks with shared means."""
    r = stats.fractional_ranks(stats.fractional_ranks(pairs, ["key"], "x", "rx"), ["key"], "y", "ry")
    return r.groupBy("key").agg(stats.spearman_from_ranks(F.col("rx"), F.col("ry")).alias("rho"))


def best_species(scores: DataFrame, tolerance: float = 0.01, few: int = 4) -> DataFrame:
    """Genes of several species (gene, species, r, is_mgs, nonzero): those within tolerance of the best, or only the best of sparse genes."""
    s = scores.withColumn("_r", F.col("r") + F.col("is_mgs").cast("int"))
    m = s.withColumn("_m", F.max("_r").over(Window.partitionBy("gene")))
    near = m.filter(F.col("_r") > F.col("_m") - tolerance).withColumn("_k", F.count("*").over(Window.partitionBy("gene")))
    exact = (F.col("_k") > 1) | (F.col("nonzero") < few)
    w = Window.partitionBy("gene").orderBy(F.desc("_r"), "species")
    return near.withColumn("_n", F.row_number().over(w)).filter(~exact | (F.col("_n") == 1)).select("gene", "species", "r")


def rescue(scores: DataFrame, taken: DataFrame, least: float = 0.6) -> DataFrame:
    """Left genes (gene, species, cog, r) to the species of best correlation whose slot (species, cog) is free, one gene a slot."""
    free = scores.filter(F.col("r") >= least).join(taken.select("species", "cog").distinct(), ["species", "cog"], "left_anti")
    w = Window.partitionBy("gene").orderBy(F.desc("r"), "species")
    one = free.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    w = Window.partitionBy("species", "cog").orderBy(F.desc("r"), "gene")
    return one.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def guided_assignment(candidates: DataFrame, least: float = 0.6, near: float = 0.03) -> DataFrame:
    """Seeds and correlation-guided genes of each species, with a running profile.

    candidates: (species, cog, gene, seed boolean, profile array<double>).  A species without seeds,
    or whose seeds have under three samples, gives nothing.  Order within a species is cog,
    then gene; one species is one group.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["cog", "gene"], ignore_index=True)
        seeds = g[g["seed"]]
        out: list[tuple] = []
        if len(seeds):
            total = np.sum([np.asarray(p, float) for p in seeds["profile"]], axis=0)
            if (total != 0).sum() >= 3:
                out += [(r.species, r.cog, r.gene, 1.0) for r in seeds.itertuples()]
                for cog, own in g[~g["cog"].isin(set(seeds["cog"]))].groupby("cog", sort=True):
                    r = np.array([_pearson(total, np.asarray(p, float)) for p in own["profile"]])
                    if r.max(initial=-1) < least:
                        continue
                    for x, row in zip(r, own.itertuples(), strict=True):
                        if x > r.max() - near:
                            out.append((row.species, cog, row.gene, float(x)))
                            total = total + np.asarray(row.profile, float)
        return pd.DataFrame(out, columns=["species", "cog", "gene", "r"])

    kinds = dict(candidates.dtypes)
    return candidates.groupBy("species").applyInPandas(run, f"species {kinds['species']}, cog {kinds['cog']}, gene {kinds['gene']}, r double")


def _pearson(x: np.ndarray, y: np.ndarray) -> float:
    a, b = x - x.mean(), y - y.mean()
    d = float(np.sqrt((a * a).sum() * (b * b).sum()))
    return float((a * b).sum() / d) if d > 0 else 0.0


def _unit(profiles: np.ndarray) -> np.ndarray:
    """Rows centred and scaled to length 1, so that a product is their Pearson correlation; constant rows are 0."""
    z = profiles - profiles.mean(axis=1, keepdims=True)
    size = np.sqrt((z * z).sum(axis=1, keepdims=True))
    return np.divide(z, size, out=np.zeros_like(z), where=size > 1e-150)


def _ranks(profiles: np.ndarray) -> np.ndarray:
    """Ranks within each row, ties sharing the mean of theirs, so that Pearson's correlation of them is Spearman's."""
    order = np.argsort(profiles, axis=1, kind="stable")
    at = np.arange(profiles.shape[1])
    sorted_ = np.take_along_axis(profiles, order, axis=1)
    new = np.ones(profiles.shape, dtype=bool)
    new[:, 1:] = sorted_[:, 1:] != sorted_[:, :-1]
    first = np.maximum.accumulate(np.where(new, at, 0), axis=1)
    ends = np.ones(profiles.shape, dtype=bool)
    ends[:, :-1] = new[:, 1:]
    last = np.minimum.accumulate(np.where(ends, at, profiles.shape[1])[:, ::-1], axis=1)[:, ::-1]
    out = np.empty(profiles.shape)
    np.put_along_axis(out, order, (first + last) / 2, axis=1)
    return out


def _claimed(points: DataFrame, distance: float, batch: int, ranked: bool = False) -> DataFrame:
    """(feature, seed): points (feature, rank, profile) in the order of rank; a point that no seed before it claims is one, and claims all later ones within distance.

    A round settles the first batch of open points among themselves on the driver, at most
    batch profiles, and lets the others find the first of its seeds that claims them, each on
    its own: no pairs are made.
    """
    kinds = dict(points.dtypes)
    open_, done = cut(points), []

    def unit(profiles: np.ndarray) -> np.ndarray:
        return _unit(_ranks(profiles) if ranked else profiles)

    while True:
        first = open_.orderBy("rank", "feature").limit(batch).toPandas()
        if first.empty:
            break
        z = unit(np.stack(first["profile"].to_numpy()).astype(float))
        seeds: list[int] = []
        for i in range(len(z)):
            if not seeds or (1 - z[seeds] @ z[i]).min() > distance:
                seeds.append(i)
        names, own = first["feature"].to_numpy()[seeds], z[seeds]

        def claim(parts: Iterator[pd.DataFrame], names=names, own=own) -> Iterator[pd.DataFrame]:
            for p in parts:
                if len(p):
                    near = 1 - unit(np.stack(p["profile"].to_numpy()).astype(float)) @ own.T <= distance
                    same = p["feature"].to_numpy()[:, None] == names[None, :]
                    hit = near | same
                    p = p.assign(seed=np.where(hit.any(axis=1), names[hit.argmax(axis=1)], None))
                    yield p

        seen = cut(open_.mapInPandas(claim, f"feature {kinds['feature']}, rank {kinds['rank']}, profile array<double>, seed {kinds['feature']}"))
        done.append(seen.filter("seed is not null").select("feature", "seed"))
        open_ = seen.filter("seed is null").drop("seed")
    if not done:
        return points.select("feature", F.col("feature").alias("seed"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _centres(members: DataFrame, points: DataFrame, quantile: float) -> DataFrame:
    """(canopy, profile): the quantile of the members' values in each sample."""
    long = members.join(points, "feature").select("canopy", F.posexplode("profile").alias("pos", "value"))
    per = long.groupBy("canopy", "pos").agg(stats.quantile_linear(F.col("value"), quantile).alias("value"))
    return per.groupBy("canopy").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("profile"))


def canopies(profiles: DataFrame, distance: float = 0.1, merge: float = 0.1, quantile: float = 0.75, top_share: float = 0.7, least_samples: int = 3, batch: int = 2048, method: str = "pearson") -> DataFrame:
    """(feature, canopy, profile): canopies of abundance profiles (feature, profile array<double>) by the distance 1 - r, with Pearson's or Spearman's correlation.

    Profiles of too few samples, or with over top_share in their three largest, are left out.
    In the order of descending totals, a profile that no canopy holds yet opens one, which all
    within distance join.  A canopy's centre is the quantile of its members in each sample;
    canopies whose centres are within merge of an earlier one's join it, and profile is the
    centre of what has come together.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"method: pearson or spearman, not {method}")
    ranked = method == "spearman"
    three = F.aggregate(F.slice(F.sort_array("profile", False), 1, 3), F.lit(0.0), lambda a, x: a + x)
    total = F.aggregate("profile", F.lit(0.0), lambda a, x: a + x)
    fit = (F.size(F.filter("profile", lambda x: x > 0)) >= least_samples) & (three <= F.lit(top_share) * total)
    points = cut(profiles.select("feature", F.col("profile").cast("array<double>").alias("profile")).filter(fit).withColumn("rank", -total).select("feature", "rank", "profile"))
    own = cut(_claimed(points, distance, batch, ranked).withColumnRenamed("seed", "canopy"))
    centres = _centres(own, points.select("feature", "profile"), quantile)
    centred = centres.join(points.select(F.col("feature").alias("canopy"), "rank"), "canopy").select(F.col("canopy").alias("feature"), "rank", "profile")
    joined = _claimed(centred, merge, batch, ranked).select(F.col("feature").alias("canopy"), F.col("seed").alias("_into"))
    out = cut(own.join(joined, "canopy").select("feature", F.col("_into").alias("canopy")))
    return out.join(_centres(out, points.select("feature", "profile"), quantile), "canopy").select("feature", "canopy", "profile")
