"""Consensus calls and depth statistics of variant tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.seq import windows


def site_call(ref: Column, alt: Column, depth: Column, freq: Column, qual: Column, min_depth: int = 1, min_qual: float = 20, least: float = 0.501) -> Column:
    """N under min_depth, the alternative above the least frequency at that quality, else the reference."""
    return F.when(depth < min_depth, "N").when((freq > least) & (alt != ".") & (qual >= min_qual), alt).otherwise(ref)


def merge_calls(calls: DataFrame) -> DataFrame:
    """One row per (contig, pos) from several callers: depths add up, the base of the best quality that isn't N wins."""
    best = F.max_by("base", F.struct((F.col("base") != "N").cast("int"), "qual", F.col("base")))
    return calls.groupBy("contig", "pos").agg(F.sum("depth").alias("depth"), best.alias("base"), F.max("qual").alias("qual"), F.count("*").alias("callers"))


def consensus(calls: DataFrame, contigs: DataFrame, block: int = 10_000) -> DataFrame:
    """The sequence of each contig block (contig, block, seq): called bases, n where there is no call.

    A contig is made in blocks, so that no contig has to fit a task; joined in order they are its
    sequence.  A block is written from its sorted calls and the gaps before them, so its time
    grows with its length; of several calls at a position the largest base stands.
    """
    blocks = contigs.select("contig", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / block).cast("int"))).alias("block"))
    own = calls.withColumn("block", F.floor((F.col("pos") - 1) / block).cast("int")).groupBy("contig", "block").agg(F.array_sort(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "base"))).alias("sites"))
    first, last = F.col("block") * block, F.least((F.col("block") + 1) * block, F.col("length")).cast("int")
    j = blocks.join(own, ["contig", "block"], "left").withColumn("sites", F.filter(F.coalesce("sites", F.array().cast("array<struct<pos:int,base:string>>")), lambda x: x["pos"] <= last))
    before = lambda i: F.when(i == 0, first).otherwise(F.get("sites", i - 1)["pos"])
    repeated = lambda x, i: F.coalesce(F.get("sites", i + 1)["pos"] == x["pos"], F.lit(False))
    gap = lambda n: F.repeat(F.lit("n"), F.greatest(n, F.lit(0)).cast("int"))
    pieces = F.transform("sites", lambda x, i: F.concat(gap(x["pos"] - before(i) - 1), F.when(repeated(x, i), F.lit("")).otherwise(F.coalesce(x["base"], F.lit("n")))))
    end = gap(last - F.when(F.size("sites") > 0, F.element_at("sites", -1)["pos"]).otherwise(first))
    return j.select("contig", "block", F.concat(F.array_join(pieces, ""), end).alias("seq"))


def frequency_histogram(calls: DataFrame) -> DataFrame:
    """Sites per whole percent of alternative frequency, and their share."""
    h = calls.groupBy(F.floor(F.col("freq") * 100).cast("int").alias("percent")).agg(F.count("*").alias("n"))
    total = calls.agg(F.count("*").alias("_all"))
    return h.crossJoin(F.broadcast(total)).select("percent", "n", (F.col("n") * 100.0 / F.col("_all")).alias("share"))  # one row


def depth_stats(calls: DataFrame) -> DataFrame:
    """Reference and alternative sites and the mean frequency per depth."""
    return calls.groupBy("depth").agg(F.count_if(F.col("base") == F.col("ref")).alias("ref_sites"), F.count_if(F.col("base") != F.col("ref")).alias("alt_sites"), F.avg("freq").alias("avg_freq"))


def caller_overlap(calls: DataFrame) -> DataFrame:
    """Sites that one and that several sources call."""
    n = calls.groupBy("contig", "pos").agg(F.count("*").alias("k"))
    return n.groupBy(F.when(F.col("k") > 1, "multi").otherwise("unique").alias("kind")).agg(F.count("*").alias("sites"))


def later_wins(calls: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: that of the last source."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return calls.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def conspecific_score(sites: DataFrame, bases: DataFrame) -> DataFrame:
    """Per gene: sites under frequency 0.8 times contamination times 100 over bases."""
    low = sites.groupBy("gene").agg(F.count_if(F.col("freq") < 0.8).alias("low"), F.max("conta").alias("conta"))
    return low.join(bases, "gene").select("gene", (F.col("low") * F.col("conta") * 100 / F.col("bases")).alias("csp"))


def consensus_differences(consensus_: DataFrame, reference: DataFrame, positions: DataFrame, block: int = 4096) -> DataFrame:
    """Positions (contig, pos) at which two sequences differ, with both bases.

    Both sequences are cut into blocks by one pass; equal blocks go as wholes, others give their
    differing positions, which are then looked up in those asked for.
    """
    c = windows(consensus_.select("contig", "seq"), "seq", block).select("contig", "piece_no", F.col("piece").alias("_c"))
    r = windows(reference.select("contig", "seq"), "seq", block).select("contig", "piece_no", F.col("piece").alias("_r"))
    both = c.join(r, ["contig", "piece_no"], "left").withColumn("_r", F.coalesce("_r", F.lit(""))).filter("_c != _r")
    sites = F.filter(F.zip_with(F.sequence(F.lit(1), F.length("_c")), F.arrays_zip(_letters("_c").alias("alt"), _letters("_r").alias("ref")), lambda i, x: F.struct(i.alias("i"), F.coalesce(x["ref"], F.lit("")).alias("ref"), x["alt"].alias("alt"))), lambda x: (x["ref"] != x["alt"]) & ~F.upper(x["alt"]).isin("N", ""))
    found = both.select("contig", "piece_no", F.explode(sites).alias("x")).select("contig", (F.col("piece_no").cast("long") * block + F.col("x.i")).alias("pos"), "x.ref", "x.alt")
    return found.join(positions.select("contig", F.col("pos").alias("_p")).withColumnRenamed("contig", "_k"), (F.col("contig") == F.col("_k")) & (F.col("pos") == F.col("_p"))).select("contig", F.col("_p").alias("pos"), "ref", "alt")


def _letters(piece: str) -> Column:
    return F.regexp_extract_all(piece, F.lit("(?s)(.)"), F.lit(1))
