"""Feature x sample matrices in long form: (feature, sample, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import UNKNOWN
from ..shared import dealt, running


def to_long(wide: DataFrame, feature: str) -> DataFrame:
    """A wide matrix as rows; zeros aren't stored."""
    samples = [c for c in wide.columns if c != feature]
    long = wide.select(F.col(feature).alias("feature"), *[F.col(f"`{c}`").cast("double").alias(c) for c in samples])
    return long.unpivot("feature", samples, "sample", "value").filter("value != 0")


def merge_samples(parts: list[DataFrame], rows: int | None = None) -> DataFrame:
    """Tables of single samples as one matrix: rows are added, never joined.

    Tasks, by feature, follow rows, about how many the parts have together; if that isn't known, they are counted.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return dealt(out, out.count() if rows is None else rows, "feature").groupBy("feature", "sample").agg(F.sum("value").alias("value"))


def roll_up(abund: DataFrame, levels: DataFrame, mean: bool = False, rows: int | None = None) -> DataFrame:
    """Sums per prefix of each hierarchy level and sample.

    levels: (feature, levels array, weight).  Before the prefixes are made, values are added
    per (levels, sample), so that the many features of one annotation meet once.  Features
    without annotation go to the prefix '?'.  Tasks follow rows, about how many rows the join of
    abund and levels has; if that isn't known, they are counted.  levels are joined by merging,
    as a copy of them in each task would grow with the features.  A sample's rows under one parent
    meet in a task, at most one for each feature, so that sums of the levels above are made before
    they are sent.
    """
    weighted = (F.col("value") * F.coalesce("weight", F.lit(1.0))).alias("value")
    joined = abund.join(levels.hint("merge"), "feature", "left").select("sample", weighted, F.coalesce("levels", F.array(F.lit(UNKNOWN))).alias("levels"))
    rows = joined.count() if rows is None else rows
    over = F.xxhash64(F.slice("levels", F.lit(1), F.greatest(F.size("levels") - 1, F.lit(1))))
    own = dealt(joined, rows, over, "sample").withColumn("_over", over).groupBy("_over", "levels", "sample").agg(F.sum("value").alias("value"), F.count("*").alias("n"))
    every = own.select("_over", "sample", "value", "n", "levels", F.explode(F.sequence(F.lit(0), F.size("levels") - 1)).alias("level"))
    every = every.select("_over", "sample", "value", "n", "level", F.array_join(F.slice("levels", F.lit(1), F.col("level") + 1), ";").alias("prefix"))
    some = every.groupBy("_over", "level", "prefix", "sample").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))  # where they are, before they are sent
    total = F.sum("value") / F.sum("n") if mean else F.sum("value")
    return dealt(some, rows, "level", "prefix", "sample").groupBy("level", "prefix", "sample").agg(total.alias("value"))


def credit_terms(anno: DataFrame, column: str = "terms") -> DataFrame:
    """(gene, item, weight): ',' gives every item the full value, '|' shares it among the alternatives."""
    ands = anno.select("gene", F.explode(F.split(column, ",")).alias("_and"))
    alts = F.split("_and", r"\|")
    return ands.select("gene", F.explode(alts).alias("item"), (1.0 / F.size(alts)).alias("weight"))


def marker_means(abund: DataFrame, members: DataFrame, min_genes: int, min_in_sample: int) -> DataFrame:
    """Mean of a group's genes per sample, for groups with min_genes genes in all and samples with min_in_sample."""
    rows = abund.join(members, "feature").filter("value > 0")
    per = rows.groupBy("grp", "sample").agg(F.avg("value").alias("value"), F.count("*").alias("n")).filter(F.col("n") >= min_in_sample)
    size = rows.select("grp", "feature").distinct().groupBy("grp").agg(F.count("*").alias("genes")).filter(F.col("genes") >= min_genes)
    return per.join(size, "grp").select("grp", "sample", "value", "n", "genes")


def cluster_matrix(members: DataFrame, coverage: DataFrame) -> DataFrame:
    """(cluster_id, sample) with count, mean and median coverage of the members."""
    return members.join(coverage, "member").groupBy("cluster_id", "sample").agg(F.sum("count").alias("count"), F.avg("cov").alias("mean_cov"), F.percentile("cov", F.lit(0.5)).alias("median_cov"))


def normalize(abund: DataFrame) -> DataFrame:
    """Values as shares of their sample's total."""
    total = abund.groupBy("sample").agg(F.sum("value").alias("_t"))
    return abund.join(total, "sample").select("feature", "sample", (F.col("value") / F.col("_t")).alias("value"))


def scale_by(abund: DataFrame, depth: DataFrame, per: float = 1.0) -> DataFrame:
    """Values divided by a number of each sample (sample, n)."""
    return abund.join(depth, "sample").select("feature", "sample", (F.col("value") * per / F.col("n")).alias("value"))


def module_scores(modules: DataFrame, abund: DataFrame, least: float = 0.5) -> DataFrame:
    """Completeness and median abundance of modules (module, feature) per sample, where at least that share is present."""
    size = modules.groupBy("module").agg(F.count("*").alias("_n"))
    here = abund.filter("value > 0").join(modules, "feature").groupBy("module", "sample").agg(F.count("*").alias("_k"), F.percentile("value", F.lit(0.5)).alias("value"))
    return here.join(size, "module").withColumn("complete", F.col("_k") / F.col("_n")).filter(F.col("complete") >= least).select("module", "sample", "complete", "value")


def rank_profile(assigned: DataFrame, lineage: DataFrame, background: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Abundance per lineage prefix, with a '?' row per sample for what isn't assigned; rows as in roll_up."""
    known = roll_up(assigned, lineage, rows=rows)
    if background is None:
        return known
    return known.unionByName(background.select(F.lit(0).alias("level"), F.lit(UNKNOWN).alias("prefix"), "sample", "value")).groupBy("level", "prefix", "sample").agg(F.sum("value").alias("value"))


def wide(abund: DataFrame, samples: list, failed: list | None = None) -> DataFrame:
    """A row for each feature by descending total, a column for each named sample, 0 where missing, '-' for failed samples."""
    out = abund.groupBy("feature").pivot("sample", samples).agg(F.sum("value"))
    filled = [F.coalesce(F.col(f"`{s}`"), F.lit(0.0)) for s in samples]
    total = filled[0]
    for c in filled[1:]:
        total = total + c
    cols = [F.lit("-").alias(str(s)) if failed and s in failed else c.alias(str(s)) for s, c in zip(samples, filled, strict=True)]
    return out.select("feature", *cols, total.alias("_total")).orderBy(F.desc("_total"), "feature").drop("_total")


def submatrix(abund: DataFrame, features: DataFrame) -> DataFrame:
    return abund.join(features.select("feature").distinct(), "feature", "left_semi")


def first_last(df: DataFrame, key: Column, value: Column, order: Column) -> DataFrame:
    """The last value of each key."""
    return df.groupBy(key.alias("key")).agg(F.max_by(value, order).alias("value"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def vote_majority(votes: DataFrame, keys: list[str], value: str, least: int, share: float) -> DataFrame:
    """The value with more than share of a group's votes, '?' if none has; groups of under least votes give nothing."""
    n = votes.groupBy(*keys, value).agg(F.count("*").alias("n"))
    top = n.groupBy(*keys).agg(F.max_by(value, F.struct("n", F.col(value))).alias("top"), F.max("n").alias("top_n"), F.sum("n").alias("votes"))
    return top.filter(F.col("votes") >= least).select(*keys, F.when(F.col("top_n") > share * F.col("votes"), F.col("top")).otherwise(F.lit(UNKNOWN)).alias(value), "top_n", "votes")


def numbered(df: DataFrame, order: list[str], name: str = "no", parts: int = 0) -> DataFrame:
    """Rows numbered from 0 in a total order, without gathering them in one task."""
    return running(df, order, None, name, parts)


def sorted_by(df: DataFrame, *order: tuple[str, bool] | str) -> DataFrame:
    """Rows in the order of columns, each ascending or (name, True) descending; Spark sorts in ranges and spills."""
    return df.orderBy(*[F.desc(c[0]) if isinstance(c, tuple) and c[1] else F.asc(c[0] if isinstance(c, tuple) else c) for c in order])


def grouped_order(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of a key together and in order within their partition, as a merge of sorted files would need."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def cumulative_half(df: DataFrame, keys: list[str], value: str, share: float = 0.5, name: str = "n50") -> DataFrame:
    """The length at which the running total of descending lengths reaches share of all (N50 at one half).

    Lengths are counted first, so that the window runs over distinct lengths.
    """
    c = df.groupBy(*keys, value).agg((F.count("*") * F.col(value)).alias("_s"))
    w = Window.partitionBy(*keys).orderBy(F.desc(value))
    run = c.withColumn("_to", F.sum("_s").over(w)).withColumn("_all", F.sum("_s").over(Window.partitionBy(*keys)))
    return run.filter(F.col("_to") >= share * F.col("_all")).groupBy(*keys).agg(F.max(value).alias(name))


def length_ladder(df: DataFrame, keys: list[str], value: str, total: str | None = None) -> DataFrame:
    """(keys, x, nx, lx) for x from 1 to 100: the length and the number of sequences at which descending lengths reach x percent of all.

    With total, a column that is constant within a key (an assumed genome size), x is of that, and
    what the lengths don't reach has no row.  Lengths are counted first; each different
    length gives the x that it reaches, so nothing is compared a hundred times.
    """
    size = F.first(total).alias("_size") if total else F.lit(None).cast("bigint").alias("_size")
    c = df.filter(F.col(value) > 0).groupBy(*keys, value).agg(F.count("*").alias("_n"), size)
    w = Window.partitionBy(*keys).orderBy(F.desc(value))
    run = c.withColumn("_to", F.sum(F.col("_n") * F.col(value)).over(w)).withColumn("_count", F.sum("_n").over(w) - F.col("_n"))
    run = run.withColumn("_all", F.coalesce("_size", F.sum(F.col("_n") * F.col(value)).over(Window.partitionBy(*keys))))
    run = run.withColumn("_from", F.col("_to") - F.col("_n") * F.col(value))
    low, high = F.expr("_from * 100 div _all + 1"), F.least(F.expr("_to * 100 div _all"), F.lit(100).cast("bigint"))
    run = run.filter(low <= high).withColumn("x", F.explode(F.sequence(low, high)))
    need = F.expr(f"(x * _all - _from * 100 + 100 * `{value}` - 1) div (100 * `{value}`)")
    return run.select(*keys, F.col("x").cast("int").alias("x"), F.col(value).alias("nx"), (F.col("_count") + need).alias("lx"))
