"""The driver's tables in the shapes of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import round_half_up
from ..shared import dealt
from .registry import Tables

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASES = "ACGT" * 13

#: SQL of the same shapes.
HITS_SQL = "SELECT l_orderkey AS q, l_partkey AS s, 100 * (1 - l_discount) AS pident, l_quantity AS alen, l_extendedprice AS bits, l_tax AS evalue, p_size AS slen, l_linenumber AS line_no, l_suppkey, p_type, p_brand, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey"
DNA_SQL = f"regexp_replace(translate(coalesce(text, ''), '{LETTERS}', '{BASES}'), '[^ACGT]', '', 'g')"


def r(x: Column, digits: int = 4) -> Column:
    return round_half_up(x, digits)


def rq(x: str, digits: int = 4) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def hits(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(F.col("l_orderkey").alias("q"), F.col("l_partkey").alias("s"), (100 * (1 - F.col("l_discount"))).alias("pident"), F.col("l_quantity").alias("alen"), F.col("l_extendedprice").alias("bits"), F.col("l_tax").alias("evalue"), F.col("p_size").alias("slen"), F.col("l_linenumber").alias("line_no"), "l_suppkey", "p_type", "p_brand", "l_returnflag")


def abund(t: Tables, rows: int | None = None) -> DataFrame:
    """Lines as a matrix; tasks by feature follow the number of lines, and a join on the feature finds them so."""
    lines = t.lineitem.select(F.col("l_partkey").alias("feature"), F.col("l_suppkey").alias("sample"), "l_quantity")
    return dealt(lines, t.lineitem.count() if rows is None else rows, "feature").groupBy("feature", "sample").agg(F.sum("l_quantity").alias("value"))


def dna(t: Tables) -> DataFrame:
    """Documents as sequences: letters become bases, all else goes."""
    text = F.coalesce("text", F.lit(""))
    return t.documents.select(F.col("doc_id").alias("id"), F.regexp_replace(F.translate(text, LETTERS, BASES), "[^ACGT]", "").alias("seq"))


def msa(t: Tables) -> DataFrame:
    """Benchmark texts as one alignment: bases, gaps for all else, padded to equal length."""
    b = t.benchmark.select(F.col("item_id").alias("id"), F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), LETTERS, BASES), "[^ACGT]", "-").alias("s"))
    width = b.agg(F.max(F.length("s")).alias("w"))
    return b.crossJoin(F.broadcast(width)).select(F.lit("g").alias("gene"), "id", F.rpad("s", F.col("w"), F.lit("-")).alias("seq"))  # one row


MSA_SQL = f"(SELECT 'g' AS gene, item_id AS id, rpad(s, CAST(max(length(s)) OVER () AS INTEGER), '-') AS seq FROM (SELECT item_id, regexp_replace(translate(coalesce(text, ''), '{LETTERS}', '{BASES}'), '[^ACGT]', '-', 'g') AS s FROM benchmark))"


def bins(t: Tables) -> DataFrame:
    """Suppliers as bins: completeness from the balance, contamination from the rate of returns."""
    ret = t.lineitem.groupBy("l_suppkey").agg((F.count_if(F.col("l_returnflag") == "R") * 100.0 / F.count("*")).alias("ret"))
    return t.supplier.join(ret, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("s_suppkey").alias("bin"), "s_nationkey", r((F.col("s_acctbal") + 1000) / 110, 3).alias("compl"), r(F.col("ret") / 5, 3).alias("conta"))


BINS_SQL = f"(SELECT s_suppkey AS bin, s_nationkey, {rq('(s_acctbal + 1000) / 110', 3)} AS compl, {rq('ret / 5', 3)} AS conta FROM supplier JOIN (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') * 100.0 / count(*) AS ret FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey)"
