"""Genome bins and species clusters: quality tiers, representatives, filters, greedy grouping."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import round_half_up

# Completeness, contamination and lineage purity of the quality tiers, best first.
TIERS = ((98, 1, 0.97), (95, 3, 0.95), (80, 5, 0.92), (60, 10, 0.9))
UNKNOWN_SHARE = (0.75, 0.75, 0.8, 1.1)
OVERLAP = (0.8, 0.8, 0.9, 0.9)


def quality_tier(compl: Column, conta: Column, rounds: int = 3, purity: Column | None = None) -> Column:
    """The first tier whose completeness, contamination and (if given) lineage purity hold, from 0; null if none does."""
    out = F.lit(None).cast("int")
    for i in reversed(range(rounds)):
        holds = (compl >= TIERS[i][0]) & (conta <= TIERS[i][1])
        out = F.when(holds if purity is None else holds & (purity >= TIERS[i][2]), i).otherwise(out)
    return out


def quality_counts(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Bins of high (90, 5), medium (80, 5) and any quality."""
    hq, mq = (F.col("compl") >= 90) & (F.col("conta") <= 5), (F.col("compl") >= 80) & (F.col("conta") <= 5)
    return bins.groupBy(*keys).agg(F.count_if(hq).alias("hq"), F.count_if(mq).alias("mq"), F.count("*").alias("bins"))


def split_by_quality(bins: DataFrame, compl: float, conta: float) -> DataFrame:
    """Bins with passed: complete and clean enough."""
    return bins.withColumn("passed", (F.col("compl") >= compl) & (F.col("conta") <= conta))


def core_gene(occ: Column, multicopy: Column, multibin: Column, marker: Column) -> Column:
    return ((multicopy / occ < 0.1) & (multibin > 0.9) & (multibin < 3)) | marker


def core_range(values: DataFrame, key: str, value: str, bins: int = 40) -> DataFrame:
    """Per key the range of histogram bins above the 60th percentile of counts and half of the largest count."""
    r = values.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    b = values.join(r, key).withColumn("bin", F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))))
    n = b.groupBy(key, "bin", "lo", "hi").agg(F.count("*").alias("n"))
    q = n.groupBy(key).agg(F.percentile("n", F.lit(0.6)).alias("q"), F.max("n").alias("m"))
    keep = n.join(q, key).filter((F.col("n") >= F.col("q")) & (F.col("n") >= 0.5 * F.col("m")))
    step = (F.col("hi") - F.col("lo")) / bins
    return keep.groupBy(key).agg(F.min(F.col("lo") + F.col("bin") * step).alias("core_low"), F.max(F.col("lo") + (F.col("bin") + 1) * step).alias("core_high"))


def gene_importance(genes: DataFrame) -> DataFrame:
    """Genes of each cluster that are kept: markers up to least(q75, 2.2) bins, others up to 1.1 q75 and near the mean occurrence.

    Bins and their limits are compared at nine decimals, so that the order in which a mean was summed decides nothing.
    """
    own = genes.withColumn("_bins", round_half_up(F.col("multibin"), 9))
    s = own.groupBy("mgs").agg(F.percentile("_bins", F.lit(0.75)).alias("q75"), F.avg("occ").alias("avg_occ"))
    g = own.join(s, "mgs")
    marker = F.col("is_marker") & (F.col("_bins") <= round_half_up(F.least("q75", F.lit(2.2)), 9))
    other = ~F.col("is_marker") & (F.col("_bins") <= round_half_up(1.1 * F.col("q75"), 9)) & F.col("occ").between(0.5 * F.col("avg_occ"), 1.5 * F.col("avg_occ"))
    return g.filter(marker | other).drop("q75", "avg_occ", "_bins")


def declutter(counts: DataFrame, share: float = 0.7) -> DataFrame:
    """(gene, mgs, occ, obs): genes of one cluster, and those of several where occ/obs (at most 1) is above share."""
    n = counts.groupBy("gene").agg(F.count("*").alias("_n"))
    return counts.join(n, "gene").filter((F.col("_n") == 1) | (F.least(F.col("occ") / F.col("obs"), F.lit(1.0)) > share)).drop("_n")


def marker_uniqueness(counts: DataFrame) -> DataFrame:
    """Per cluster the share of its genes' assignments that are its own."""
    n = counts.groupBy("gene").agg(F.count("*").alias("_n"))
    return counts.join(n, "gene").groupBy("mgs").agg(F.count("*").alias("genes"), (F.count("*") / F.sum("_n")).alias("uniqueness"))


def representative(genes: DataFrame, quality: DataFrame) -> DataFrame:
    """Per cluster the bin of the best score: mean occurrence of its genes, markers twice, over obs, plus 0.01 (compl - 2 conta)."""
    s = genes.groupBy("mgs", "bin").agg((F.sum(F.col("occ") * F.when(F.col("is_marker"), 2).otherwise(1)) / F.count("*") / F.max("obs")).alias("_s"))
    s = s.join(quality, "bin").withColumn("score", F.col("_s") + 0.01 * (F.col("compl") - 2 * F.col("conta")))
    w = Window.partitionBy("mgs").orderBy(F.desc("score"), "bin")
    return s.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("mgs", "bin", "score")


def representative_per_family(bins: DataFrame, family: str) -> DataFrame:
    """Per family the bin of the largest compl - 2 conta among those above 60 and under 20."""
    w = Window.partitionBy(family).orderBy(F.desc(F.col("compl") - 2 * F.col("conta")), "bin")
    return bins.filter("compl > 60 and conta < 20").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def lineage_purity(votes: DataFrame, levels: int) -> DataFrame:
    """Per bin: level votes (bin, hits, level, name, n) to sum((L-i) h p) / sum((L-i) h), p the top share and h the votes over hits."""
    known = votes.filter("name != '?'").groupBy("bin", "hits", "level").agg((F.max("n") / F.sum("n")).alias("p"), F.sum("n").alias("s"))
    w = (levels - F.col("level")) * F.col("s") / F.col("hits")
    return known.groupBy("bin").agg((F.sum(w * F.col("p")) / F.sum(w)).alias("purity"))


def reciprocal_best(overlap: DataFrame, a: str, b: str, n: str = "n") -> DataFrame:
    """Pairs that are each other's largest overlap."""
    wa, wb = Window.partitionBy(a).orderBy(F.desc(n), b), Window.partitionBy(b).orderBy(F.desc(n), a)
    return overlap.withColumn("_a", F.row_number().over(wa)).withColumn("_b", F.row_number().over(wb)).filter("_a = 1 and _b = 1").drop("_a", "_b")


def better_replacement(current: DataFrame, other: DataFrame) -> DataFrame:
    """Per mgs the bin of the higher score, the current one on a tie."""
    best = other.groupBy("mgs").agg(F.max_by("bin", F.struct("score", F.col("bin"))).alias("_b"), F.max("score").alias("_s"))
    take = F.col("_s") > F.col("score")
    return current.join(best, "mgs", "left").select("mgs", F.when(take, F.col("_b")).otherwise(F.col("bin")).alias("bin"), F.when(take, F.col("_s")).otherwise(F.col("score")).alias("score"))


def co_exclusion(presence: DataFrame, group: str, item: str, where: str) -> DataFrame:
    """Per group the pairs of items that never occur in one place; pairs meet through their group only."""
    p = presence.select(group, item, where).distinct()
    size = p.groupBy(group, item).agg(F.count("*").alias("_n"))
    a, b = size.select(group, F.col(item).alias("a")), size.select(group, F.col(item).alias("b"))
    pairs = a.join(b, group).filter("a < b")
    x, y = p.select(group, F.col(item).alias("a"), where), p.select(group, F.col(item).alias("b"), where)
    met = x.join(y, [group, where]).filter("a < b").select(group, "a", "b").distinct()
    return pairs.join(met, [group, "a", "b"], "left_anti")


def greedy_clusters(bins: DataFrame, genes: DataFrame, family: str = "family") -> DataFrame:
    """Greedy grouping of bins by shared marker genes, best tier and least contamination first.

    Bins that share no marker, directly or through others, never meet, so each family of such
    bins (column family of both inputs, e.g. a connected component) is solved alone.
    """
    rows = genes.join(bins, [family, "bin"]).select(family, "bin", "tier", "conta", "gene", "is_marker")

    def solve(g: pd.DataFrame) -> pd.DataFrame:
        occ: dict[str, dict] = {}
        obs: dict[str, int] = {}
        out = []
        order = g[["bin", "tier", "conta"]].drop_duplicates().sort_values(["tier", "conta", "bin"])
        own = {b: x for b, x in g.groupby("bin")}
        for b in order.itertuples(index=False):
            marks = own[b.bin].loc[own[b.bin]["is_marker"], "gene"].tolist()
            hits: dict[str, int] = {}
            for m in marks:
                for c in occ.get(m, ()):
                    hits[c] = hits.get(c, 0) + 1
            n = max(len(marks), 1)
            unknown = sum(m not in occ for m in marks) / n
            name, kind = None, "ambiguous"
            best = min(hits, key=lambda c: (-hits[c], c)) if hits else None
            if unknown > UNKNOWN_SHARE[b.tier] or (best is None and b.tier < 3):
                name, kind = f"C{len(obs) + 1:06d}", "new"
            elif best is not None and hits[best] / n > 0.6:
                core = sum(occ.get(m, {}).get(best, 0) for m in marks) / (obs[best] * n)
                excl = sum(occ[m].get(best, 0) / sum(occ[m].values()) for m in marks if m in occ) / n
                if core > OVERLAP[b.tier] and excl > OVERLAP[b.tier]:
                    name, kind = best, "merged"
            if name:
                obs[name] = obs.get(name, 0) + 1
                for x in own[b.bin]["gene"]:
                    occ.setdefault(x, {})[name] = occ.get(x, {}).get(name, 0) + 1
            out.append((g[family].iloc[0], b.bin, name, kind))
        return pd.DataFrame(out, columns=[family, "bin", "cluster", "kind"])

    kinds = dict(bins.dtypes)
    return rows.groupBy(family).applyInPandas(solve, f"{family} {kinds[family]}, bin {kinds['bin']}, cluster string, kind string")
