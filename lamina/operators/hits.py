"""Alignment hit tables: acceptance, mates, best hits, categories."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def accepted(evalue: float = 1e-7, bits: float = 0, alen: float = 30, pident: float = 20, cover: float = 0) -> Column:
    """evalue, bits, length, identity and cover of the subject, whose length is in slen."""
    return (F.col("evalue") <= evalue) & (F.col("bits") >= bits) & (F.col("alen") >= alen) & (F.col("pident") >= pident) & (F.col("alen") > F.col("slen") * cover)


def with_lengths(hits: DataFrame, lengths: DataFrame) -> DataFrame:
    """Hits with their subject's length; a subject without one is an error when the row is read."""
    out = hits.join(lengths, "s", "left")
    return out.withColumn("slen", F.when(F.col("slen").isNull(), F.raise_error(F.concat(F.lit("no length of subject "), F.col("s").cast("string")))).otherwise(F.col("slen")))


def model_cutoff(hits: DataFrame, models: DataFrame) -> DataFrame:
    """Hits on subjects of the model table whose bits reach the model's cutoff for the aligned share."""
    return hits.join(models, "s").filter(F.col("bits") >= F.col("cutoff") * F.col("alen") / F.col("slen"))


def identity_class(pident: Column, alen: Column, qlen: Column, slen: Column, required: float) -> Column:
    """1 pass, 0 fail, -2 malformed."""
    bad = pident.isNull() | alen.isNull() | qlen.isNull() | slen.isNull()
    return F.when(bad, -2).when((pident >= 0.985 * required) & (alen >= 0.1 * slen) & (alen >= 0.7 * qlen), 1).otherwise(0)


def combine_mates(hits: DataFrame, how: str = "inner") -> DataFrame:
    """Hits of both mates (column mate, 1 or 2) on one query and subject as one row.

    The earlier mate by subject start counts first; overlap shortens the length and the bits.
    how is inner, or full to keep hits of one mate alone.
    """
    first = Window.partitionBy("q", "s", "mate").orderBy(F.desc("bits"), "ss", "se")
    one = hits.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    cols = ["pident", "alen", "bits", "evalue", "ss", "se"]
    pick = lambda m, c: F.max(F.when(F.col("mate") == m, F.col(c))).alias(f"{c}{m}")
    both = one.groupBy("q", "s").agg(*[pick(m, c) for m in (1, 2) for c in cols])
    low = {m: F.least(f"ss{m}", f"se{m}") for m in (1, 2)}
    high = {m: F.greatest(f"ss{m}", f"se{m}") for m in (1, 2)}
    one_first = low[1] <= low[2]
    ov = F.greatest(F.lit(0), F.when(one_first, high[1]).otherwise(high[2]) - F.when(one_first, low[2]).otherwise(low[1]))
    ov = F.when(F.col("alen1").isNotNull() & F.col("alen2").isNotNull(), ov).otherwise(F.lit(0))
    a1, a2 = F.coalesce("alen1", F.lit(0)), F.coalesce("alen2", F.lit(0))
    pair = F.col("alen1").isNotNull() & F.col("alen2").isNotNull()
    alen = F.when(pair & (a1 + a2 - ov < 0), a1).otherwise(a1 + a2 - ov)
    bits = F.when(pair, (F.col("bits1") + F.col("bits2")) * (1 - ov / (a1 + a2))).otherwise(F.coalesce("bits1", "bits2"))
    out = both.filter(pair) if how == "inner" else both
    return out.select("q", "s", F.when(pair, (F.col("pident1") + F.col("pident2")) / 2).otherwise(F.coalesce("pident1", "pident2")).alias("pident"), alen.alias("alen"), bits.alias("bits"), F.least("evalue1", "evalue2").alias("evalue"), F.when(pair, 2).otherwise(1).alias("cnt"))


BEST = ("has_cat", "bits", "pident", "alen")


def best_hit(hits: DataFrame, key: str = "q", order: tuple[str, ...] = BEST, tie: str = "s") -> DataFrame:
    """The best row per query by order, all descending, then the tie column ascending; combined before the shuffle."""
    rest = [c for c in hits.columns if c not in (key, tie)]
    width = {c: F.col(c) for c in order if c in hits.columns}
    top = F.max_by(F.struct(tie, *rest), F.struct(*width.values(), (-F.col(tie)).alias("_tie"))) if dict(hits.dtypes)[tie] in ("int", "bigint", "double") else None
    if top is None:
        w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in width], tie)
        return hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return hits.groupBy(key).agg(top.alias("_top")).select(key, "_top.*").select(*hits.columns)


def best_hit_in_order(hits: DataFrame, order: str = "line_no") -> DataFrame:
    """The best hit of each query when hits are met in file order (ties by subject, then by the hit's numbers), with the running bests that the rule names.

    Rows stream through a partition in the order of query and file; of a query only its best row is held.
    """
    names = hits.columns
    at = {n: names.index(n) for n in ("q", "pident", "alen", "bits", "evalue", "has_cat")}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, ever_id, ever_len, found = None, -1.0, -1.0, False
        for part in parts:
            done = []
            for h in part.itertuples(index=False, name=None):
                q, pident, alen, bits, evalue, cat = (h[at[n]] for n in at)
                if best is None or q != best[at["q"]]:
                    if best is not None:
                        done.append(best)
                    best, ever_id, ever_len, found = h, pident, alen, bool(cat)
                    continue
                if found and not cat:
                    continue
                b_id, b_bits, b_e = best[at["pident"]], best[at["bits"]], best[at["evalue"]]
                longer = b_id - 5 < pident and b_e * 10 > evalue and pident >= 0.97 * b_id and pident >= 0.92 * ever_id and alen >= 1.15 * ever_len
                closer = pident >= 1.03 * ever_id and alen >= 0.9 * ever_len
                if longer or closer or bits > b_bits or (cat and not found):
                    best, found = h, bool(cat)
                    ever_id, ever_len = max(ever_id, pident), max(ever_len, alen)
            yield pd.DataFrame(done, columns=names)
        if best is not None:
            yield pd.DataFrame([best], columns=names)

    return hits.repartition("q").sortWithinPartitions("q", order, "s", "bits", "pident", "alen", "evalue").mapInPandas(run, hits.schema)


def best_without_ties(hits: DataFrame, key: str, score: str, group: str) -> DataFrame:
    """The best row per key, unless rows of several groups share the best score."""
    w = Window.partitionBy(key)
    top = hits.withColumn("_m", F.max(score).over(w)).filter(F.col(score) == F.col("_m"))
    return top.groupBy(key).agg(F.min(group).alias(group), F.max(group).alias("_g"), F.max(score).alias(score)).filter(F.col(group) == F.col("_g")).drop("_g")


def score_columns(hits: DataFrame) -> DataFrame:
    """cnt: 1 for a single mate (query ends in /1 or /2), else 2; gln: aligned share of the subject."""
    return hits.withColumn("cnt", F.when(F.col("q").cast("string").rlike("/[12]$"), 1).otherwise(2)).withColumn("gln", F.col("alen") / F.col("slen"))


def terms(df: DataFrame, column: str, sep: str, share: bool) -> DataFrame:
    """A row for each term of a multi-valued column, with full credit, or with an equal share of it."""
    parts = F.split(column, sep)
    return df.select("*", F.explode(parts).alias("term"), (1.0 / F.size(parts) if share else F.lit(1.0)).alias("credit"))


def category_totals(hits: DataFrame, norms: dict[str, Column], kingdom: str, category: str) -> DataFrame:
    """Totals by norm, kingdom and category, all kingdoms together included, in one pass."""
    each = F.explode(F.array(*[F.named_struct(F.lit("norm"), F.lit(n), F.lit("score"), c.cast("double")) for n, c in norms.items()])).alias("_n")
    rows = hits.select(F.explode(F.array(F.col(kingdom).cast("string"), F.lit("ALL"))).alias("kingdom"), F.col(category).alias("category"), each)
    return rows.groupBy("_n.norm", "kingdom", "category").agg(F.sum("_n.score").alias("score"), F.count("*").alias("n"))


def transitive_category(dim: DataFrame, best: DataFrame) -> DataFrame:
    """A subject without a category takes that of its best hit among the subjects (dim: s, category; best: s, other)."""
    other = dim.select(F.col("s").alias("other"), F.col("category").alias("_c"))
    return dim.join(best, "s", "left").join(other, "other", "left").select("s", F.coalesce("category", "_c").alias("category"))


def decoy_contigs(hits: DataFrame, contigs: DataFrame, pident: float = 95, share: float = 0.8) -> DataFrame:
    """Contigs that references don't cover: aligned length of hits above pident is under share of the length."""
    hit = hits.filter(F.col("pident") > pident).groupBy("contig").agg(F.sum("alen").alias("_a"))
    return contigs.join(hit, "contig", "left").filter(F.coalesce("_a", F.lit(0)) < share * F.col("length")).drop("_a")
