"""Alignments as (gene, id, seq) rows of equal length within a gene."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.seq import CODONS

MISSING = "-NnXx?"


def columns(msa: DataFrame) -> DataFrame:
    """A row for each position (0-based) and sequence that has a base there."""
    return msa.select("gene", "id", F.posexplode(F.split("seq", "")).alias("pos", "base")).filter(F.col("base") != "").filter(~F.col("base").isin(*MISSING))


def _shared_columns(x: np.ndarray, y: np.ndarray, width: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(valid, equal) counts of columns of every row of x with every row of y; 0 is missing."""
    valid, equal = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
    for at in range(0, x.shape[1], width):
        a, b = x[:, at : at + width], y[:, at : at + width]
        valid += (a != 0).astype(np.float32) @ (b != 0).astype(np.float32).T
        for c in np.intersect1d(a, b):
            if c:
                equal += (a == c).astype(np.float32) @ (b == c).astype(np.float32).T
    return np.rint(valid).astype(np.int64), np.rint(equal).astype(np.int64)


def _codes(seqs: list[str]) -> np.ndarray:
    """Code points of sequences as rows, 0 where a base is missing or the sequence has ended."""
    out = np.zeros((len(seqs), max((len(s) for s in seqs), default=0)), dtype=np.uint32)
    for i, s in enumerate(seqs):
        out[i, : len(s)] = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)
    out[np.isin(out, [ord(c) for c in MISSING])] = 0
    return out


def pair_identity(msa: DataFrame, block: int = 256) -> DataFrame:
    """Per gene and pair a < b: columns that both have, equal ones, and percent identity (pairwise complete).

    A gene's sequences are dealt into blocks; every two blocks meet once, as matrices of code
    points whose columns are counted by products, so that one gene is spread over many tasks.
    """
    kind = dict(msa.dtypes)
    rows = msa.select("gene", "id", "seq").filter("gene is not null and id is not null and seq is not null")
    size = rows.groupBy("gene").agg(F.ceil(F.count("*") / block).alias("blocks"))
    m = rows.join(size, "gene").withColumn("i", F.pmod(F.xxhash64("id"), F.col("blocks")))
    m = m.select("gene", "id", "seq", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"))
    m = m.select("gene", "id", "seq", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), (F.col("i") > F.col("j")).alias("side"))

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        one = g["p"].iloc[0] == g["q"].iloc[0]
        left = g if one else g[~g["side"]]
        right = g if one else g[g["side"]]
        all_ = _codes(g["seq"].tolist())
        place = {k: n for n, k in enumerate(g.index)}
        x, y = all_[[place[k] for k in left.index]], all_[[place[k] for k in right.index]]
        valid, equal = _shared_columns(x, y)
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        less = a[:, None] < b[None, :]
        i, j = np.nonzero(less if one else less | (a[:, None] > b[None, :]))
        swap = ~less[i, j]
        v, e = valid[i, j], equal[i, j]
        return pd.DataFrame({"gene": g["gene"].iloc[0], "a": np.where(swap, b[j], a[i]), "b": np.where(swap, a[i], b[j]), "valid": v, "equal": e})

    pairs = m.groupBy("gene", "p", "q").applyInPandas(compare, f"gene {kind['gene']}, a {kind['id']}, b {kind['id']}, valid long, equal long")
    return pairs.withColumn("pid", F.when(F.col("valid") > 0, F.col("equal") * 100.0 / F.col("valid")))


def merge_distances(pids: DataFrame, lengths: DataFrame) -> DataFrame:
    """Per pair the mean identity over genes, weighted by gene length."""
    return pids.join(lengths, "gene").groupBy("a", "b").agg((F.sum(F.col("pid") * F.col("length")) / F.sum("length")).alias("pid"), F.sum("length").alias("weight"))


def variable_columns(msa: DataFrame) -> DataFrame:
    """Positions with more than one base."""
    return columns(msa).groupBy("gene", "pos").agg(F.countDistinct("base").alias("bases"), F.count("*").alias("n")).filter("bases > 1")


def site_partition(msa: DataFrame) -> DataFrame:
    """Codon columns by kind: invariant, syn (one amino acid), nonsyn; fourfold if the first two bases agree and any third gives the same."""
    table = F.create_map(*[F.lit(x) for kv in CODONS.items() for x in kv])
    fourfold = sorted({c[:2] for c in CODONS if len({CODONS[c[:2] + t] for t in "TCAG"}) == 1})
    c = msa.select("gene", "id", F.posexplode(F.regexp_extract_all("seq", F.lit("(...)"), F.lit(1))).alias("codon_no", "codon"))
    c = c.withColumn("aa", F.element_at(table, F.upper("codon"))).filter(F.col("aa").isNotNull())
    g = c.groupBy("gene", "codon_no").agg(F.countDistinct("codon").alias("codons"), F.countDistinct("aa").alias("aas"), F.countDistinct(F.substring("codon", 1, 2)).alias("heads"), F.min(F.substring("codon", 1, 2)).alias("head"), F.count("*").alias("n"))
    kind = F.when(F.col("codons") == 1, "invariant").when(F.col("aas") == 1, "syn").otherwise("nonsyn")
    return g.select("gene", "codon_no", kind.alias("kind"), ((F.col("heads") == 1) & F.col("head").isin(*fourfold)).alias("fourfold"), "codons", "aas", "n")


def residues(seq: Column) -> Column:
    return F.length(F.translate(seq, MISSING, ""))


def filter_cascade(msa: DataFrame, per_gene: float, max_genes: float, nt: float, genes: float, min_nt: int, outgroup: str | None = None) -> DataFrame:
    """Sequences kept for a tree: long enough for their gene, genes and species with enough of both; an outgroup is exempt."""
    m = msa.withColumn("len", residues(F.col("seq")))
    q = stats.quantile_nearest(m, ["gene"], "len", 0.9, "q")
    m = m.join(q, "gene").filter(F.col("len") >= F.col("q") * per_gene).drop("q")
    n = m.groupBy("gene").agg(F.count("*").alias("n"))
    q = stats.quantile_nearest(n, [], "n", 0.9, "q")
    m = m.join(n.crossJoin(F.broadcast(q)).filter((F.col("n") >= F.col("q") * max_genes) & (F.col("n") > 3)).select("gene"), "gene", "left_semi")  # q has one row
    s = m.groupBy("id").agg(F.sum("len").alias("nt"), F.count("*").alias("g"))
    q = stats.quantile_nearest(s, [], "nt", 0.9, "qn").crossJoin(F.broadcast(stats.quantile_nearest(s, [], "g", 0.9, "qg")))  # one row each
    ok = ((F.col("nt") >= F.col("qn") * nt) & (F.col("nt") / 3 >= min_nt) & (F.col("g") >= F.col("qg") * genes)) | F.lit(False if outgroup is None else True) & (F.col("id") == F.lit(outgroup))
    return m.join(s.crossJoin(F.broadcast(q)).filter(ok).select("id"), "id", "left_semi")


def concatenated_rows(lengths: DataFrame, share: float, least: int) -> DataFrame:
    """Rows (id, n) of a joined alignment that stay: not (n < share q90 and n < q25), nor n < least."""
    q = stats.quantile_nearest(lengths, [], "n", 0.9, "q90").crossJoin(F.broadcast(stats.quantile_nearest(lengths, [], "n", 0.25, "q25")))  # one row each
    return lengths.crossJoin(F.broadcast(q)).filter(~(((F.col("n") < share * F.col("q90")) & (F.col("n") < F.col("q25"))) | (F.col("n") < least))).select("id", "n")


def mask_columns(msa: DataFrame, scores: DataFrame, least: float) -> DataFrame:
    """Positions whose column score is under least become N."""
    c = msa.select("gene", "id", F.posexplode(F.split("seq", "")).alias("pos", "base")).filter("base != ''").join(scores, ["gene", "pos"], "left")
    b = F.when(F.col("score") < least, "N").otherwise(F.col("base"))
    return c.groupBy("gene", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", b.alias("b")))), lambda x: x["b"]), "").alias("seq"))
