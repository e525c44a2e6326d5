"""Rules on hits, genes and clusters that are one grouping, window or join each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stats
from ..functions.seq import cigar_length
from ..schemas import UNKNOWN

UNMAPPED = 4


def fails_alignment(cigar: Column, mapq: Column, divergence: Column, length: Column, min_cover: float, max_divergence: float, min_mapq: int, max_clip: int | None = None) -> Column:
    """Whether an alignment is too short, too far off, of too low quality, or clipped at both ends.

    length is the read's; what insertions and clips take away from it isn't covered.
    """
    gone = cigar_length(cigar, "ISH")
    bad = (1 - gone / length < min_cover) | (divergence > max_divergence) | (mapq < min_mapq)
    if max_clip is not None:
        ends = [F.regexp_extract(cigar, p, 1) for p in (r"^(\d+)[HS]", r"\D(\d+)[HS]$")]
        both = [F.when(e != "", e).cast("int") > max_clip for e in ends]
        bad = bad | F.coalesce(both[0] & both[1], F.lit(False))
    return F.coalesce(bad, F.lit(True))


def flag_unmapped(flag: Column, bad: Column) -> Column:
    """The flag with the unmapped bit set where bad: rows stay."""
    return F.when(bad, flag.bitwiseOR(F.lit(UNMAPPED).cast("int"))).otherwise(flag)


def long_or_marker(length: Column, marker: Column, least: float) -> Column:
    """Genes that are long enough, and markers of any length."""
    return (length >= least) | F.coalesce(marker, F.lit(False))


def single_copy_groups(genes: DataFrame, keys: list[str], copies: str, most: float = 0.2) -> DataFrame:
    """Groups in which at most the share most of the genes has several copies; others hold more than one strain."""
    g = genes.groupBy(*keys).agg(F.count("*").alias("genes"), F.count_if(F.col(copies) > 1).alias("multi"))
    return g.filter(F.col("multi") / F.col("genes") <= most)


def cluster_subset(members: DataFrame, keep: DataFrame, member: str = "member") -> DataFrame:
    """The rows of members whose member is in keep."""
    return members.join(keep.select(member).distinct(), member, "left_semi")


def gene_counts(genes: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Genes of each group, and how many of their names are doubles."""
    return genes.groupBy(*keys).agg(F.count("*").alias("genes"), (F.count("*") - F.countDistinct(name)).alias("doubles"))


def species_profile(abund: DataFrame, members: DataFrame, median: bool = False) -> DataFrame:
    """(species, sample, value): the sum over a species' genes by their number, those that a sample lacks included, or the median of those it has."""
    n = members.groupBy("species").agg(F.count("*").alias("_n"))
    rows = abund.join(members, "feature").join(n, "species")
    value = stats.true_median(F.col("value")) if median else F.sum("value") / F.max("_n")
    return rows.groupBy("species", "sample").agg(value.alias("value"))


def top_taxon(votes: DataFrame, key: str, taxon: str, least: int = 5) -> DataFrame:
    """The taxon with the most votes of each key if it has more than least; ties go to the later name."""
    n = votes.groupBy(key, taxon).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.max_by(taxon, F.struct("n", taxon)).alias(taxon), F.max("n").alias("n")).filter(F.col("n") > least)


def refine_taxon(votes: DataFrame, key: str, name: str, known: Column, known_share: float = 0.7, top_share: float = 0.75) -> DataFrame:
    """(key, name): the known name with the most votes, if enough votes are known and enough of these are for it; else '?'."""
    n = votes.groupBy(key, name).agg(F.count("*").alias("n")).withColumn("_known", known)
    own = F.when(F.col("_known"), F.col("n"))
    k = n.groupBy(key).agg(F.sum("n").alias("a"), F.sum(own).alias("k"), F.max(own).alias("t"), F.max_by(name, F.when(F.col("_known"), F.struct("n", name))).alias("b"))
    return k.select(key, F.when((F.col("k") / F.col("a") >= known_share) & (F.col("t") / F.col("k") > top_share), F.col("b")).otherwise(F.lit(UNKNOWN)).alias(name))


def marker_stats(genes: DataFrame, key: str, marker: str, length: str) -> DataFrame:
    """Genes, different markers and the longest gene of each key."""
    return genes.groupBy(key).agg(F.count("*").alias("genes"), F.countDistinct(marker).alias("markers"), F.max(length).alias("longest"))


def set_overlap(sets: DataFrame, name: str, item: str) -> DataFrame:
    """(a, b, inter, uni) of the pairs of sets with an item in common."""
    s = sets.select(F.col(name).alias("b"), F.col(item).alias("_k")).distinct()
    n = s.groupBy("b").agg(F.count("*").alias("n"))
    inter = s.withColumnRenamed("b", "a").join(s, "_k").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("inter"))
    j = inter.join(n.select(F.col("b").alias("a"), F.col("n").alias("_na")), "a").join(n, "b")
    return j.select("a", "b", "inter", (F.col("_na") + F.col("n") - F.col("inter")).alias("uni"))


def samples_per_group(counts: DataFrame, key: str, genes: str, least: int = 10) -> DataFrame:
    """Samples in which a group has more than least genes, and the median and ninth decile of its genes a sample."""
    return counts.groupBy(key).agg(F.count_if(F.col(genes) > least).alias("samples"), stats.true_median(F.col(genes)).alias("q50"), stats.quantile_linear(F.col(genes), 0.9).alias("q90"))


def run_statistics(reads: DataFrame, sample: str, measures: dict[str, Column]) -> DataFrame:
    """A row of measures for each sample, as one table to write."""
    return reads.groupBy(F.col(sample).alias("sample")).agg(*[c.alias(n) for n, c in measures.items()])


def priority_limit(genes: DataFrame, group: str, category: str, order: list[Column], most: int) -> DataFrame:
    """In the order of priority the first gene of each category, and of these the first most of each group."""
    one, few = Window.partitionBy(group, category).orderBy(*order), Window.partitionBy(group).orderBy(*order)
    first = genes.withColumn("_a", F.row_number().over(one)).filter("_a = 1").drop("_a")
    return first.withColumn("_b", F.row_number().over(few)).filter(F.col("_b") <= most).drop("_b")


def artificial_ids(rows: DataFrame, group: list[str], order: list[str], missing: Column, category: Column, name: str, prefix: str = "uniq") -> DataFrame:
    """rows with name: the category, or where it is missing an id that is unique in the group."""
    marked = rows.withColumn("_m", missing)
    w = Window.partitionBy(*group, "_m").orderBy(*order)
    return marked.withColumn(name, F.when(F.col("_m"), F.concat(F.lit(prefix), F.row_number().over(w).cast("string"))).otherwise(category)).drop("_m")


def correlated_union(one: DataFrame, two: DataFrame, key: str, x: str, y: str, cut: float) -> DataFrame:
    """Keys that both sets have, and those of the first alone above cut."""
    j = one.join(two, key, "full")
    return j.filter((F.col(x).isNotNull() & F.col(y).isNotNull()) | (F.col(x) > cut)).select(key)
