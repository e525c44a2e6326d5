"""Sequence functions on string columns, inside the JVM."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Complements of the nucleotide codes, and the standard genetic code in the
# order of bases TCAG for the first, second and third position.
IUPAC = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv"
IUPAC_COMPLEMENT = "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Codes of two alleles at a heterozygous site; fixed values.
HETEROZYGOUS = {"AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M"}
PIECE = 256  # starts of k-mers that one piece of a sequence holds
CODONS = {"".join(c): a for c, a in zip(product("TCAG", repeat=3), GENETIC_CODE, strict=True)}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, IUPAC_COMPLEMENT))


def codons(seq: Column) -> Column:
    """Whole codons, after N at the end are taken off."""
    return F.regexp_extract_all(F.regexp_replace(seq, "N+$", ""), F.lit("(...)"), F.lit(1))


def translate_codons(seq: Column) -> Column:
    """Amino acids of the whole codons; X for a codon that isn't in the code."""
    table = F.create_map(*[F.lit(x) for kv in CODONS.items() for x in kv])
    return F.array_join(F.transform(codons(F.upper(seq)), lambda c: F.coalesce(F.element_at(table, c), F.lit("X"))), "")


def translate_gene(seq: Column, five_partial: Column, three_partial: Column) -> Column:
    """A gene's protein: an alternative start counts as M unless the 5' end is missing; the stop is cut unless the 3' end is."""
    raw = translate_codons(seq)
    started = F.when(~five_partial & F.upper(F.substring(seq, 1, 3)).isin("ATG", "GTG", "TTG"), F.concat(F.lit("M"), F.substring(raw, 2, 1 << 30))).otherwise(raw)
    return F.when(~three_partial, F.regexp_replace(started, r"\*$", "")).otherwise(started)


def gc_percent(seq: Column) -> Column:
    """Percent of G and C among all characters, three decimals."""
    n = F.length(seq)
    return F.when(n > 0, F.floor(F.regexp_count(seq, F.lit("[GCgc]")) * 100000.0 / n + 0.5) / 1000.0)


def third_positions(seq: Column) -> Column:
    return F.regexp_replace(F.substring(seq, F.lit(1), (F.floor(F.length(seq) / 3) * 3).cast("int")), "..(.)", "$1")


def gc3_percent(seq: Column) -> Column:
    return gc_percent(third_positions(seq))


def kmers(df: DataFrame, seq: str, k: int, name: str = "kmer") -> DataFrame:
    """A row for each k-mer of pure ACGT and its start.

    The sequence is cut into overlapping pieces by one pass of a pattern first, as a substring
    walks its string from the start.
    """
    piece = F.posexplode(F.regexp_extract_all(F.col(seq), F.lit(f"(?s)(?=(.{{1,{PIECE + k - 1}}})).{{1,{PIECE}}}"), F.lit(1))).alias("_c", "_piece")
    starts = F.least(F.length("_piece") - (k - 1), F.lit(PIECE))
    out = df.select("*", piece).filter(F.length("_piece") >= k).select("*", F.explode(F.sequence(F.lit(1), starts)).alias("_at"))
    out = out.withColumn(name, F.substring("_piece", F.col("_at"), F.lit(k))).withColumn("at", F.col("_c") * PIECE + F.col("_at")).drop("_c", "_piece", "_at")
    return out.filter(F.translate(name, "ACGT", "") == "")


def gap_edges_to_unknown(seq: Column) -> Column:
    """Leading and trailing gaps become ?."""
    lead, tail = F.length(F.regexp_extract(seq, "^(-*)", 1)), F.length(F.regexp_extract(seq, "[^-](-*)$", 1))
    body = F.substring(seq, lead + 1, F.length(seq) - lead - tail)
    return F.when(F.regexp_count(seq, F.lit("[^-]")) == 0, F.repeat(F.lit("?"), F.length(seq))).otherwise(F.concat(F.repeat(F.lit("?"), lead), body, F.repeat(F.lit("?"), tail)))


def windows(df: DataFrame, seq: str, size: int, name: str = "piece") -> DataFrame:
    """Consecutive pieces of size characters, the last one shorter, with their number."""
    return df.select("*", F.posexplode(F.regexp_extract_all(F.col(seq), F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))).alias("piece_no", name))


def difference_positions(a: Column, b: Column) -> Column:
    """0-based positions at which two equally long strings differ."""
    marks = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y)
    return F.filter(F.transform(marks, lambda m, i: F.when(m, i)), lambda i: i.isNotNull())


def common_prefix(a: Column, b: Column) -> Column:
    """The longest prefix that two strings share, found by halving its length's possible range."""
    n = F.least(F.length(a), F.length(b))
    powers = F.transform(F.sequence(F.length(F.bin(n)) - 1, F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
    longer = lambda k, x: F.when((k + x <= n) & (F.substring(a, k + 1, x) == F.substring(b, k + 1, x)), k + x).otherwise(k)
    return F.when(a == b, a).when(a.isNotNull() & b.isNotNull(), F.substring(a, F.lit(1), F.aggregate(powers, F.lit(0), longer)))


def clean_header(header: Column, most: int = 40) -> Column:
    """At most most characters, with what tree formats reserve replaced."""
    return F.translate(F.substring(header, 1, most), " :;,()[]'|/\\", "____________")


def cigar_length(cigar: Column, kinds: str) -> Column:
    """Sum of the lengths of the operations named in kinds."""
    numbers = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{kinds}]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x.cast("int"))


def sum_list(text: Column, sep: str = ",") -> Column:
    """Sum of the numbers in a list text."""
    return F.aggregate(F.split(text, sep), F.lit(0.0), lambda a, x: a + F.coalesce(F.try_to_number(x, F.lit("999999999999.999999")).cast("double"), F.lit(0.0)))


def heterozygous_code(one: Column, two: Column) -> Column:
    """The code that stands for two alleles in upper case; the base itself if they are equal, N if either isn't a base."""
    table = F.create_map(*[F.lit(x) for kv in HETEROZYGOUS.items() for x in kv])
    low, high = F.least(F.upper(one), F.upper(two)), F.greatest(F.upper(one), F.upper(two))
    real = low.isin(*"ACGT") & high.isin(*"ACGT")
    return F.when(real & (low == high), low).when(real, F.try_element_at(table, F.concat(low, high))).otherwise(F.lit("N"))


def prefix_header(header: Column, prefix: str, cut: str | None = None) -> Column:
    """prefix and the header, which ends where the pattern cut matches."""
    return F.concat(F.lit(prefix), F.regexp_replace(header, f"(?s)(?:{cut}).*$", "") if cut else header)


def longest_shared(a: str, b: str) -> str:
    """The longest substring that two texts share, of ties the first in a.

    Texts that share one of a length share shorter ones, so its length is found by halving; at a
    length, substrings meet by a hash of theirs, and hits are compared as text.
    """
    if not a or not b:
        return ""
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) for t in (a, b))

    def hashes(codes: np.ndarray, n: int) -> np.ndarray:
        """Hashes of all substrings of n letters, by joining halves."""
        out, width = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
        parts = []
        left = n
        while left:
            if left & width:
                parts.append((width, out))
                left -= width
            if left:
                out = _joined(out[: len(out) - width], out[width:])
                width *= 2
        at, total = 0, None
        for width, h in parts:
            piece = h[at : at + len(codes) - n + 1]
            total = piece if total is None else _joined(total, piece)
            at += width
        return total

    def first(n: int) -> int:
        """Where a's first substring of n letters that b has begins, or -1."""
        if n > min(len(x), len(y)):
            return -1
        for i in np.flatnonzero(np.isin(hashes(x, n), hashes(y, n))):
            if a[i : i + n] in b:
                return int(i)
        return -1

    low, high, at = 0, min(len(a), len(b)), 0
    while low < high:
        middle = (low + high + 1) // 2
        found = first(middle)
        if found >= 0:
            low, at = middle, found
        else:
            high = middle - 1
    return a[at : at + low]


def _joined(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    h = one * np.uint64(0xBF58476D1CE4E5B9) + two
    return (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


_SHORT = 64  # letters of texts that are compared many at once


def shared_spans(x: list[str], y: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Start in x and length of the longest substring of each pair of texts of at most 64 letters, of ties the first in x."""
    n = len(x)
    lx, ly = np.fromiter(map(len, x), np.int64, n), np.fromiter(map(len, y), np.int64, n)
    wx, wy = max(int(lx.max(initial=0)), 1), max(int(ly.max(initial=0)), 1)
    cx = np.ascontiguousarray(np.array(x, dtype=f"U{wx}").view(np.uint32).reshape(n, wx).T)
    cy = np.ascontiguousarray(np.array(y, dtype=f"U{wy}").view(np.uint32).reshape(n, wy).T)
    cx[np.arange(wx)[:, None] >= lx] = 0xFFFFFFFF  # no letters, and not equal to each other
    cy[np.arange(wy)[:, None] >= ly] = 0xFFFFFFFE
    run = np.zeros((wy + 1, n), dtype=np.uint8)
    best, end = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.int64)
    for i in range(wx):
        run[1:] = (run[:-1] + 1) * (cy == cx[i])
        top = run.max(axis=0)
        more = top > best
        end[more] = i + 1
        np.maximum(best, top, out=best)
    return end - best, best.astype(np.int64)


def common_substring(a: Column, b: Column) -> Column:
    """The longest substring that two texts share, of ties the first in a; null if either is.  Short texts are compared many pairs at once."""

    @F.pandas_udf("string")
    def shared(x: pd.Series, y: pd.Series) -> pd.Series:
        x, y = x.tolist(), y.tolist()
        out: list[str | None] = [None] * len(x)
        few = []
        for i, (p, q) in enumerate(zip(x, y, strict=True)):
            if isinstance(p, str) and isinstance(q, str):
                if len(p) <= _SHORT and len(q) <= _SHORT:
                    few.append(i)
                else:
                    out[i] = longest_shared(p, q)
        for low in range(0, len(few), 4096):
            part = few[low : low + 4096]
            at, size = shared_spans([x[i] for i in part], [y[i] for i in part])
            for i, s, n in zip(part, at.tolist(), size.tolist(), strict=True):
                out[i] = x[i][s : s + n]
        return pd.Series(out, dtype=object)

    return shared(a, b)
