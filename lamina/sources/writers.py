"""Sinks: matrices, tables, sequences, alignments, variants and depth tracks as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import matrix


def write_table(df: DataFrame, path: str, gzip: bool = False) -> None:
    w = df.write.mode("overwrite").option("sep", "\t").option("header", "true")
    (w.option("compression", "gzip") if gzip else w).csv(path)


def write_matrix(abund: DataFrame, samples: list, path: str, failed: list | None = None) -> None:
    write_table(matrix.wide(abund, samples, failed), path)


def write_hash(df: DataFrame, key: str, value: str, path: str, by_value: bool = True) -> None:
    write_table(df.select(key, value).orderBy(*([F.desc(value), key] if by_value else [key])), path)


def write_partitioned(df: DataFrame, by: list[str], path: str) -> None:
    """One folder for each combination of by."""
    df.write.mode("overwrite").partitionBy(*by).option("sep", "\t").csv(path)


def fasta_lines(seqs: DataFrame, width: int = 0) -> DataFrame:
    """'>id descr' and the sequence, wrapped at width if given, as one value."""
    head = F.concat(F.lit(">"), F.concat_ws(" ", F.col("id"), *([F.nullif(F.col("descr"), F.lit(""))] if "descr" in seqs.columns else [])))
    body = F.regexp_replace(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), "\n$", "") if width else F.col("seq")
    return seqs.select(F.concat(head, F.lit("\n"), body).alias("value"), *[c for c in seqs.columns if c == "grp"])


def write_fasta(seqs: DataFrame, path: str, width: int = 0, gzip: bool = False) -> None:
    """One folder, or with a column grp one for each group."""
    out = fasta_lines(seqs, width)
    w = out.write.mode("overwrite").option("compression", "gzip" if gzip else "none")
    (w.partitionBy("grp") if "grp" in out.columns else w).text(path)


def phylip_lines(msa: DataFrame) -> DataFrame:
    """Per gene the count and length line, then each id and sequence, as (gene, line_no, value)."""
    w = Window.partitionBy("gene").orderBy("id")
    head = msa.groupBy("gene").agg(F.concat_ws(" ", F.count("*").cast("string"), F.max(F.length("seq")).cast("string")).alias("value")).select("gene", F.lit(0).alias("line_no"), "value")
    return head.unionByName(msa.select("gene", F.row_number().over(w).alias("line_no"), F.concat(F.rpad("id", 10, " "), F.lit(" "), "seq").alias("value")))


def nexus_lines(msa: DataFrame) -> DataFrame:
    """Per gene a NEXUS data block, as (gene, line_no, value)."""
    dims = msa.groupBy("gene").agg(F.count("*").alias("n"), F.max(F.length("seq")).alias("l"))
    head = dims.select("gene", F.lit(0).alias("line_no"), F.format_string("#NEXUS\nBEGIN DATA;\nDIMENSIONS NTAX=%d NCHAR=%d;\nFORMAT DATATYPE=DNA MISSING=? GAP=-;\nMATRIX", "n", "l").alias("value"))
    tail = dims.select("gene", (F.col("n") + 1).cast("int").alias("line_no"), F.lit(";\nEND;").alias("value"))
    w = Window.partitionBy("gene").orderBy("id")
    return head.unionByName(msa.select("gene", F.row_number().over(w).alias("line_no"), F.concat_ws("\t", "id", F.translate("seq", "-", "?")).alias("value"))).unionByName(tail)


def cluster_lines(clusters: DataFrame, offset: int = 0) -> DataFrame:
    """id, tab and >m1,>m2; ids are shifted by offset."""
    rows = clusters.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: F.concat(F.lit(">"), m)), ",").alias("m"))
    return rows.select(F.concat_ws("\t", (F.col("cluster_id") + offset).cast("string"), "m").alias("value"))


def renumber(clusters: DataFrame, offset: int = 0) -> DataFrame:
    """Clusters numbered by id from offset on."""
    ids = matrix.numbered(clusters.select("cluster_id").distinct(), ["cluster_id"], "_no")
    return clusters.join(ids, "cluster_id").select((F.col("_no") + offset).alias("cluster_id"), "member")


def vcf_lines(sites: DataFrame) -> DataFrame:
    """Tab lines of (chrom, pos, ref, alt, qual) in order."""
    return sites.orderBy("chrom", "pos").select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.coalesce(F.col("qual").cast("string"), F.lit(".")), F.lit("PASS"), F.lit(".")).alias("value"))


def bed_lines(runs: DataFrame) -> DataFrame:
    return runs.select(F.concat_ws("\t", "chr", F.col("start").cast("string"), F.col("end").cast("string"), F.col("value").cast("string")).alias("value"))


def write_chunks(df: DataFrame, path: str, n: int | None = None, max_rows: int | None = None) -> None:
    """n files of about equal row counts, or files of at most max_rows."""
    w = (df.repartition(n) if n else df).write.mode("overwrite")
    (w.option("maxRecordsPerFile", max_rows) if max_rows else w).text(path)


def write_split(df: DataFrame, test: Column, path: str, other: str) -> None:
    """Text rows that pass the test to path, all others (null counts as not passed) to other; df is read twice."""
    passed = F.coalesce(test, F.lit(False))
    df.filter(passed).write.mode("overwrite").text(path)
    df.filter(~passed).write.mode("overwrite").text(other)
