"""Lineages: padding, prefixes, and text fix-ups.  An unknown rank is '?'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import UNKNOWN


def pad_lineage(levels: Column, depth: int) -> Column:
    """Exactly depth levels; missing, empty and null ones are unknown."""
    padded = F.slice(F.concat(levels, F.array_repeat(F.lit(UNKNOWN), depth)), 1, depth)
    return F.transform(padded, lambda x: F.when(x.isNull() | (F.trim(x) == "") | (x == "-"), F.lit(UNKNOWN)).otherwise(F.trim(x)))


def parse_taxonomy(text: Column, depth: int, sep: str = ";") -> Column:
    """Levels of a taxonomy text without rank prefixes such as k__ or s__."""
    return pad_lineage(F.transform(F.split(text, sep), lambda x: F.regexp_replace(F.trim(x), "^[a-z]__", "")), depth)


def known_depth(lineage: Column) -> Column:
    """Number of levels before the first unknown one."""
    at = F.array_position(lineage, UNKNOWN)
    return F.when(at == 0, F.size(lineage)).otherwise(at - 1).cast("int")


def cut_unknown(lineage: Column) -> Column:
    """Everything below the first unknown level is unknown."""
    keep = known_depth(lineage)
    return F.transform(lineage, lambda x, i: F.when(i < keep, x).otherwise(F.lit(UNKNOWN)))


def prefixes(df: DataFrame, lineage: str) -> DataFrame:
    """A row for each level (0-based) with the lineage up to it."""
    out = df.select("*", F.posexplode(lineage).alias("level", "_name"))
    return out.withColumn("prefix", F.array_join(F.slice(F.col(lineage), F.lit(1), F.col("level") + 1), ";")).drop("_name")


def ranked_taxonomy(text: Column, depth: int) -> Column:
    """Levels of a text such as k__A; p__[B]; s__: prefixes, quotes and brackets go, empty and unidentified ranks are unknown."""
    plain = lambda x: F.regexp_replace(F.regexp_replace(F.trim(F.replace(x, F.lit('"'), F.lit(""))), "^[kpcofgsd]__", ""), r"^\s*\[|\]\s*$", "")
    return pad_lineage(F.transform(F.split(text, ";"), lambda x: F.when(plain(x) == "unidentified", F.lit(UNKNOWN)).otherwise(plain(x))), depth)


#: Codes of kingdoms by the words of a taxonomy line; fixed values.
KINGDOMS = {"bacteria": 0, "Archaea": 1, "Eukaryota": 2, "Fungi": 3}


def kingdom_code(text: Column) -> Column:
    """The code of the kingdom that a taxonomy line names; fungi only within eukaryotes, bacteria where none is named."""
    fungi = F.when(F.contains(text, F.lit("Fungi")), KINGDOMS["Fungi"]).otherwise(KINGDOMS["Eukaryota"])
    return F.when(F.contains(text, F.lit("Eukaryota")), fungi).when(F.contains(text, F.lit("Archaea")), KINGDOMS["Archaea"]).otherwise(KINGDOMS["bacteria"])
