"""Positions and intervals: range joins, run lengths, packing of regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import running


def interval_join(points: DataFrame, intervals: DataFrame, key: str, pos: str, start: str, end: str, bin_size: int) -> DataFrame:
    """Points within [start, end] of the same key: an equi-join on (key, bin), intervals once for each bin that they touch.

    A long key is spread over its bins, so that no key has to meet in one task.
    """
    p = points.withColumn("_bin", F.floor(F.col(pos) / bin_size))
    i = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / bin_size), F.floor(F.col(end) / bin_size))))
    return p.join(i, [key, "_bin"]).filter(F.col(pos).between(F.col(start), F.col(end))).drop("_bin")


def gene_offset(pos: Column, start: Column, end: Column, strand: Column) -> Column:
    """0-based offset in the gene's own direction."""
    return F.when(strand == "-", end - pos).otherwise(pos - start)


def mean_coverage(depth: DataFrame, genes: DataFrame, key: str, bin_size: int) -> DataFrame:
    """Mean depth of genes over inclusive runs (start, end, value); parts of a gene without a run count 0."""
    d = depth.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("d_start") / bin_size), F.floor(F.col("d_end") / bin_size))))
    g = genes.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("end") / bin_size))))
    low, high = F.greatest("d_start", "start", F.col("_bin") * bin_size), F.least("d_end", "end", (F.col("_bin") + 1) * bin_size - 1)
    part = d.join(g, [key, "_bin"]).select("gene", F.when(high >= low, (high - low + 1) * F.col("value")).otherwise(0).alias("_c"))
    total = part.groupBy("gene").agg(F.sum("_c").alias("_c"))
    return genes.join(total, "gene", "left").select("gene", (F.coalesce("_c", F.lit(0)) / (F.col("end") - F.col("start") + 1)).alias("cov"))


def run_lengths(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Runs of equal consecutive values: keys, run number, first and last of order's first column, value, n."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w))
    return marked.groupBy(*keys, "run").agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.first(value).alias(value), F.count("*").alias("n"))


def depth_to_bed(depth: DataFrame) -> DataFrame:
    """Per-base depths (chr, pos, depth), 1-based, as half-open runs, the last one included; a gap ends a run.

    A position without its like before it begins a run, one without its like behind ends one;
    the n-th beginning and the n-th end, both numbered over sorted ranges, are of one run, so
    that a chromosome is no task's.  A position stands once in its chromosome.
    """
    own = depth.select("chr", F.col("pos").cast("long").alias("pos"), "depth").filter("chr is not null and pos is not null and depth is not null")
    like = lambda shift: own.select("chr", (F.col("pos") + shift).alias("pos"), "depth")
    begins = running(own.join(like(1), ["chr", "pos", "depth"], "left_anti"), ["chr", "pos"], None, "_r").select("_r", "chr", (F.col("pos") - 1).alias("start"), F.col("depth").alias("value"))
    ends = running(own.join(like(-1), ["chr", "pos", "depth"], "left_anti").select("chr", "pos"), ["chr", "pos"], None, "_r").select("_r", F.col("pos").alias("end"))
    return begins.join(ends, "_r").select("chr", "start", "end", "value")


def forward_fill(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, True).over(w))


def moving_average(df: DataFrame, keys: list[str], order: list[str], value: str, n: int, name: str) -> DataFrame:
    """Mean of n rows centred on each, fewer at the edges."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n // 2), n - 1 - n // 2)
    return df.withColumn(name, F.avg(value).over(w))


def fixed_regions(contigs: DataFrame, step: int) -> DataFrame:
    """Windows of step bases over (contig, length), 1-based and inclusive."""
    at = F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / step).cast("long")))
    return contigs.filter("length > 0").select("contig", "length", at.alias("_i")).select("contig", (F.col("_i") * step + 1).alias("start"), F.least((F.col("_i") + 1) * step, F.col("length")).alias("end"))


def pack_regions(contigs: DataFrame, chunks: int, order: list[str], group: list[str] | None = None) -> DataFrame:
    """Contigs (contig, length, depth) in about equal chunks of work, long ones split where a chunk ends.

    Work is depth times length, by 1.2 for contigs deeper than 0.85 of the mean, by 0.8 under 0.1
    of it.  A contig's pieces follow from the running work in order: piece k is the part of
    its work in chunk k.
    """
    keys = group or []
    mean = contigs.groupBy(*keys).agg(F.avg("depth").alias("_m"))
    c = contigs.join(mean, keys) if keys else contigs.crossJoin(F.broadcast(mean))  # one row
    factor = F.when(F.col("depth") > 0.85 * F.col("_m"), 1.2).when(F.col("depth") < 0.1 * F.col("_m"), 0.8).otherwise(1.0)
    c = c.withColumn("work", F.col("depth") * F.col("length") * factor)
    if keys:
        w = Window.partitionBy(*keys).orderBy(*order)
        c = c.withColumn("_to", F.sum("work").over(w)).withColumn("_all", F.sum("work").over(Window.partitionBy(*keys))).withColumn("_from", F.col("_to") - F.col("work"))
    else:  # the whole table in order: totals of sorted ranges instead of one window
        c = running(c, order, "work", "_from").withColumn("_to", F.col("_from") + F.col("work"))
        c = c.crossJoin(F.broadcast(c.agg(F.sum("work").alias("_all"))))  # one row
    target = F.col("_all") / chunks
    low = F.floor(F.col("_from") / target)
    high = F.greatest(low, F.least(F.ceil(F.col("_to") / target) - 1, F.lit(chunks - 1)))
    c = c.filter("work > 0").withColumn("chunk", F.explode(F.sequence(F.least(low, F.lit(chunks - 1)), high))).withColumn("_t", target)
    share = lambda x: F.least(F.greatest((x - F.col("_from")) / F.col("work"), F.lit(0.0)), F.lit(1.0))
    start = F.floor(share(F.col("chunk") * F.col("_t")) * F.col("length")) + 1
    end = F.when(F.col("chunk") == F.lit(chunks - 1), F.col("length")).otherwise(F.floor(share((F.col("chunk") + 1) * F.col("_t")) * F.col("length")))
    return c.select(*keys, "contig", F.col("chunk").cast("int").alias("chunk"), start.alias("start"), end.alias("end")).filter("start <= end")
