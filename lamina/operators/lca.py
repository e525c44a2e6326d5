"""Lowest-common-ancestor consensus of hits, unrolled over the fixed levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import UNKNOWN

# Identity below which a level isn't assigned, and tolerance by the best identity.
LEVEL_IDENTITY = (97, 95, 93, 91, 88, 85)
TOLERANCE = ((100, 0.1), (99.5, 0.25), (99, 0.5), (98, 1.0), (97, 1.25))


def tolerance(best: Column) -> Column:
    out = F.lit(1.5)
    for at, t in reversed(TOLERANCE):
        out = F.when(best >= at, t).otherwise(out)
    return out


def usable_rows(hits: DataFrame, min_bits: float = 120, max_evalue: float = 1e-14) -> DataFrame:
    """Hits near enough to the best of their query, with the depth that their identity allows."""
    h = hits.withColumn("_id", F.when((F.col("bits") < min_bits) | (F.col("evalue") > max_evalue), 0.0).otherwise(F.col("pident").cast("double")))
    best = h.groupBy("q").agg(F.max(F.struct("_id", "alen")).alias("_b"))
    j = h.join(best, "q").filter((F.col("_id") >= F.col("_b._id") - tolerance(F.col("_b._id"))) & (F.col("alen") >= 0.85 * F.col("_b.alen")))
    allowed = F.lit(len(LEVEL_IDENTITY) + 1)
    for t in LEVEL_IDENTITY:
        allowed = allowed - (F.col("_id") < t).cast("int")
    known = F.array_position("lineage", UNKNOWN)
    return j.withColumn("depth", F.least(allowed, F.when(known == 0, F.size("lineage")).otherwise(known - 1))).drop("_id", "_b")


def _next_level(state: DataFrame, level: int, share: float) -> DataFrame:
    """state (q, _out, _n, _live) with the name of one more level in _out, and those in _live that have it."""
    at = lambda e: F.get(e["lineage"], F.lit(level))
    known = lambda e: (e["depth"] > level) & at(e).isNotNull()
    votes = lambda x: F.aggregate(F.filter("_open", lambda e: at(e) == x), F.lit(0).cast("long"), lambda n, e: n + e["k"])
    state = state.withColumn("_open", F.filter("_live", known))
    state = state.withColumn("_tally", F.transform(F.array_distinct(F.transform("_open", at)), lambda x: F.struct(votes(x).alias("k"), x.alias("name"))))
    state = state.withColumn("_top", F.array_max("_tally"))
    # A tie of two names isn't a majority.
    alone = F.size(F.filter("_tally", lambda t: t["k"] == F.col("_top.k"))) == 1
    state = state.withColumn("_won", F.coalesce((F.col("_top.k") >= F.ceil(F.lit(share) * F.col("_n"))) & alone, F.lit(False)))
    name = F.when(F.col("_won"), F.col("_top.name")).otherwise(F.lit(UNKNOWN))
    left = F.filter("_open", lambda e: F.col("_won") & (at(e) == F.col("_top.name")))
    return state.select("q", F.concat("_out", F.array(name)).alias("_out"), F.when(F.col("_won"), F.col("_top.k")).otherwise(F.col("_n")).alias("_n"), left.alias("_live"))


def consensus(rows: DataFrame, levels: int, share: float = 0.9) -> DataFrame:
    """Per query the lineage that ceil(share * n) of its rows support at each level, n being the rows that supported the level above; '?' below.

    Equal lineages of a query are counted before they meet; the levels are folded over the
    array of its different ones, so that there is one grouping for all levels.
    """
    counted = rows.groupBy("q", "lineage", F.least(F.col("depth"), F.lit(levels)).alias("depth")).agg(F.count("*").alias("k"))
    state = counted.groupBy("q").agg(F.collect_list(F.struct("lineage", "depth", "k")).alias("_live"), F.sum("k").alias("_n")).withColumn("_out", F.array().cast("array<string>"))
    for level in range(levels):
        state = _next_level(state, level, share)
    return state.select("q", F.col("_out").alias("lineage"))
