"""Sequence-level operators: quality control of reads, k-mer profiles, assembly statistics, clustering of genes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as S
from . import graph, overlap
from ..shared import cut
from .matrix import cumulative_half


def read_filter(seq: Column, qual: Column, min_len: int = 0, min_avg: float = 0, max_error: float | None = None, max_ambiguous: int | None = None, max_homopolymer: int | None = None, offset: int = 33) -> Column:
    """Length, mean quality, summed error probability, ambiguous bases and homopolymer runs of a read."""
    scores = F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - offset)
    total = F.aggregate(scores, F.lit(0.0), lambda a, q: a + q)
    ok = (F.length(seq) >= min_len) & (total / F.greatest(F.size(scores), F.lit(1)) >= min_avg)
    if max_error is not None:
        ok = ok & (F.aggregate(scores, F.lit(0.0), lambda a, q: a + F.pow(F.lit(10.0), -q / 10.0)) <= max_error)
    if max_ambiguous is not None:
        ok = ok & (F.regexp_count(seq, F.lit("[^ACGTacgt]")) <= max_ambiguous)
    if max_homopolymer is not None:
        ok = ok & ~seq.rlike(f"([ACGTacgt])\\1{{{max_homopolymer},}}")
    return ok


def _row_slices(offs: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """First and last row, that one excluded, of slices of whole rows with about size bytes."""
    at, rows = 0, len(offs) - 1
    while at < rows:
        to = min(max(int(np.searchsorted(offs, offs[at] + size, side="right")) - 1, at + 1), rows)
        yield at, to
        at = to


def kept_lengths(data: np.ndarray, offs: np.ndarray, window: int, least: float, offset: int) -> np.ndarray:
    """Where the first window of each row of qualities begins whose mean is under least; a row's length where there is none."""
    total = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
    at = np.arange(max(len(data) - window + 1, 0))
    ends = np.repeat(offs[1:], np.diff(offs))
    bad = at[((total[at + window] - total[at] - offset * window) / window < least) & (at + window <= ends[at])]
    first = np.searchsorted(bad, offs[:-1])
    found = np.append(bad, len(data) + window)[first]
    return np.minimum(np.where(found < offs[1:], found, offs[1:]), offs[1:]) - offs[:-1]


def window_trim(reads: DataFrame, window: int, least: float, offset: int = 33, slice_bytes: int = 1 << 18) -> DataFrame:
    """Reads cut before the first window whose mean quality is under least; only qualities leave the JVM, and about slice_bytes of them are worked on at once."""

    @F.arrow_udf("int")
    def kept(qual: pa.Array) -> pa.Array:
        text = qual.fill_null("")
        offs = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
        own = [kept_lengths(raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at], window, least, offset) for at, to in _row_slices(offs, slice_bytes)]
        return pa.array(np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int32))

    cut = reads.withColumn("_kept", kept("qual"))
    shorter = F.col("_kept") < F.length("qual")
    return cut.select(*[F.when(shorter, F.substring(c, F.lit(1), F.col("_kept"))).otherwise(F.col(c)).alias(c) if c in ("seq", "qual") else F.col(f"`{c}`") for c in reads.columns])


def length_class(length: Column, low: int, high: int) -> Column:
    return F.when(length < low, "short").when(length < high, "middle").otherwise("long")


def completeness(partial: Column) -> Column:
    """Class of a gene's partial flags: 5' first, 3' second."""
    return F.when(partial == "00", "complete").when(partial == "01", "no3").when(partial == "10", "no5").otherwise("fragment")


_CODE = np.full(256, 4, dtype=np.uint8)
_CODE[np.frombuffer(b"ACGT", dtype=np.uint8)] = np.arange(4)


def _kmer_codes(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every k-mer of pure ACGT in the rows of a byte buffer."""
    base = _CODE[data]
    bad = np.concatenate([[0], np.cumsum(base == 4)])
    at = np.arange(max(len(data) - k + 1, 0))
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    at = at[(row[at] == row[at + k - 1]) & (bad[at + k] == bad[at])] if len(at) else at
    code = np.zeros(len(at), dtype=np.int64)
    for j in range(k):
        code = code * 4 + base[at + j]
    return row[at] if len(at) else at, code


def _counted(row: np.ndarray, code: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, n) of the different pairs."""
    codes = 4**k
    if rows * codes <= 4 * len(row) + 65_536:
        n = np.bincount(row * codes + code, minlength=rows * codes)
        at = np.flatnonzero(n)
        return at // codes, at % codes, n[at]
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1]))) if len(row) else row
    return row[head], code[head], np.diff(np.append(head, len(row)))


def _reversed_codes(code: np.ndarray, k: int) -> np.ndarray:
    """Codes of the reverse complements: A, C, G, T are 0 to 3, so a complement is 3 less the code."""
    out = np.zeros_like(code)
    for _ in range(k):
        out = out * 4 + (3 - (code & 3))
        code = code >> 2
    return out


def _kmer_names(code: np.ndarray, k: int) -> pa.Array:
    letters = np.stack([np.frombuffer(b"ACGT", dtype=np.uint8)[(code >> (2 * (k - 1 - j))) & 3] for j in range(k)], axis=1)
    return pa.Array.from_buffers(pa.string(), len(code), [None, pa.py_buffer((np.arange(len(code) + 1) * k).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(letters))])


def _byte_slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, int, np.ndarray, np.ndarray]]:
    """(names, first row, bytes, offsets) of slices of whole rows with about size bytes."""
    for b in batches:
        names, text = b.column(0), b.column(1).fill_null("")
        offs = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
        for at, to in _row_slices(offs, size):
            yield names, at, raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at]


def kmer_counts(seqs: DataFrame, key: str, seq: str, k: int, slice_bytes: int = 1 << 20, both_strands: bool = False) -> DataFrame:
    """(key, kmer, n): counts of each row's k-mers of pure ACGT, by a kernel over the bytes of about slice_bytes at once; k is up to 24.

    With both_strands each k-mer's reverse complement is counted, too.
    """
    if not 0 < k <= 24:
        raise ValueError("k-mers of 1 to 24 bases are counted")
    kind = dict(seqs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, at, data, offs in _byte_slices(batches, slice_bytes):
            row, code = _kmer_codes(data, offs, k)
            if both_strands:
                row, code = np.concatenate([row, row]), np.concatenate([code, _reversed_codes(code, k)])
            row, code, n = _counted(row, code, len(offs) - 1, k)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(row + at)), _kmer_names(code, k), pa.array(n.astype(np.int64))], names=[key, "kmer", "n"])

    return seqs.select(key, seq).mapInArrow(run, f"`{key}` {kind}, kmer string, n long")


def kmer_profile(seqs: DataFrame, k: int, min_len: int = 0, slice_bytes: int = 1 << 20) -> DataFrame:
    """(id, kmer, percent): k-mers of both strands as percent of all, rounded to five decimals of the share.

    Sequences are dealt by id, not the rows of their k-mers; a task holds the counts of one id
    besides a slice, as an id's sequences may go on in the next.
    """
    if not 0 < k <= 24:
        raise ValueError("k-mers of 1 to 24 bases are counted")
    own = seqs.filter(F.length("seq") >= min_len).select("id", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (id, codes, counts)

        def given(names: pa.Array, row: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            total = np.bincount(row, weights=n)
            return pa.RecordBatch.from_arrays([names.take(pa.array(row)), _kmer_names(code, k), pa.array(np.floor(n * 100000.0 / total[row] + 0.5) / 1000.0)], names=["id", "kmer", "percent"])

        def one() -> pa.RecordBatch:
            return given(held[0], np.zeros(len(held[1]), np.int64), held[1], held[2])

        for names, at, data, offs in _byte_slices(batches, slice_bytes):
            names = names.slice(at, len(offs) - 1)
            ids = names.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.append(True, ids[1:] != ids[:-1])
            heads, group = names.take(pa.array(np.flatnonzero(new))), np.cumsum(new) - 1
            row, code = _kmer_codes(data, offs, k)
            row, code, n = _counted(np.tile(group[row], 2), np.concatenate([code, _reversed_codes(code, k)]), len(heads), k)
            if held is not None and held[0][0].as_py() == heads[0].as_py():
                first = int(np.searchsorted(row, 1))
                codes, index = np.unique(np.concatenate([held[1], code[:first]]), return_inverse=True)
                sums = np.bincount(index, weights=np.concatenate([held[2], n[:first]])).astype(np.int64)
                row, code, n = np.concatenate([np.zeros(len(codes), np.int64), row[first:]]), np.concatenate([codes, code[first:]]), np.concatenate([sums, n[first:]])
            elif held is not None and len(held[1]):
                yield one()
            last = int(np.searchsorted(row, len(heads) - 1))
            if last:
                yield given(heads, row[:last], code[:last], n[:last])
            held = (heads.slice(len(heads) - 1), code[last:], n[last:])
        if held is not None and len(held[1]):
            yield one()

    return own.repartition("id").sortWithinPartitions("id").mapInArrow(run, f"id {dict(own.dtypes)['id']}, kmer string, percent double")


def window_counts(data: np.ndarray, offs: np.ndarray, k: int, size: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, window, code, n) of the k-mers of both strands in windows of size letters, one every step letters.

    A k-mer is added in the first window that holds it whole and taken away behind the last; the
    running sum of these changes is a k-mer's count from window to window.
    """
    row, code = _kmer_codes(data, offs, k)
    bad = np.concatenate([[0], np.cumsum(_CODE[data] == 4)])
    at = np.arange(max(len(data) - k + 1, 0))
    of = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    at = at[(of[at] == of[at + k - 1]) & (bad[at + k] == bad[at])] if len(at) else at
    pos, length = at - offs[row], np.diff(offs)[row]
    last = np.maximum(length - size, 0) // step  # the last whole window, or the only one of a short row
    low, high = np.maximum(-((size - k - pos) // step), 0), np.minimum(pos // step, last)
    low = np.where(length < size, 0, low)
    high = np.where(length < size, 0, high)
    inside = low <= high
    row, code, low, high = row[inside], code[inside], low[inside], high[inside]
    first = np.cumsum(np.append(0, np.maximum(np.diff(offs) - size, 0) // step + 1))  # each row's first window, numbered over all rows
    spread = int((high - low + 1).sum())
    if first[-1] * 4**k <= 4 * spread + 65_536:  # few codes: each is counted in every window that holds it
        times = high - low + 1
        window = _spread(first[row] + low, times) * 4**k
        n = np.bincount(np.concatenate([window + np.repeat(code, times), window + np.repeat(_reversed_codes(code, k), times)]), minlength=int(first[-1]) * 4**k)
        at = np.flatnonzero(n)
        of = np.repeat(np.arange(len(offs) - 1), np.diff(first))[at // 4**k]
        return of, at // 4**k - first[of], at % 4**k, n[at]
    row, low, high, code = np.tile(row, 2), np.tile(low, 2), np.tile(high, 2), np.concatenate([code, _reversed_codes(code, k)])
    r, c, w, d = np.tile(row, 2), np.tile(code, 2), np.concatenate([low, high + 1]), np.repeat([1, -1], len(row))
    order = np.lexsort((w, c, r))
    r, c, w, d = r[order], c[order], w[order], d[order]
    total = np.cumsum(d)  # each k-mer of a row adds up to 0
    follows = np.append(w[1:], 0) - w
    follows = np.where((total > 0), follows, 0)
    runs = np.flatnonzero(follows > 0)
    times = follows[runs]
    return np.repeat(r[runs], times), _spread(w[runs], times), np.repeat(c[runs], times), np.repeat(total[runs], times)


def kmer_windows(seqs: DataFrame, k: int, size: int, step: int | None = None, slice_bytes: int = 1 << 18) -> DataFrame:
    """(id, start, kmer, n, percent): k-mers of both strands in sliding windows; start is 0-based, a shorter row is one window.

    Only whole windows count in a row of size letters or more.
    """
    step = step or size
    if not (0 < k <= 24 and k <= size and step > 0):
        raise ValueError("windows hold a k-mer of 1 to 24 bases and move on")
    kind = dict(seqs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, at, data, offs in _byte_slices(batches, slice_bytes):
            row, window, code, n = window_counts(data, offs, k, size, step)
            if len(row) and (np.diff(row) < 0).any() | ((np.diff(row) == 0) & (np.diff(window) < 0)).any():
                order = np.lexsort((code, window, row))
                row, window, code, n = row[order], window[order], code[order], n[order]
            new = np.append(True, (row[1:] != row[:-1]) | (window[1:] != window[:-1])) if len(row) else np.zeros(0, bool)
            group = np.cumsum(new) - 1
            total = np.bincount(group, weights=n) if len(row) else np.zeros(0)
            percent = np.floor(n * 100000.0 / total[group] + 0.5) / 1000.0 if len(row) else np.zeros(0)
            for low in range(0, len(row), 1 << 16):
                part = slice(low, low + (1 << 16))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(row[part] + at)), pa.array(window[part] * step), _kmer_names(code[part], k), pa.array(n[part]), pa.array(percent[part])], names=["id", "start", "kmer", "n", "percent"])

    return seqs.select("id", "seq").mapInArrow(run, f"id {kind}, start long, kmer string, n long, percent double")


def member_choice(members: DataFrame) -> DataFrame:
    """Members (cluster_id, member, contig_len) that stand for their cluster: those on contigs above 10k if more than two, else above 5k, 2k, 1k, else any above 1k, else all."""
    limits = (10_000, 5_000, 2_000, 1_000)
    n = members.groupBy("cluster_id").agg(*[F.count_if(F.col("contig_len") > x).alias(f"n{x}") for x in limits])
    least = F.when(F.col("n1000") > 0, F.lit(1_000)).otherwise(F.lit(-1))
    for x in reversed(limits):
        least = F.when(F.col(f"n{x}") > 2, F.lit(x)).otherwise(least)
    return members.join(n.select("cluster_id", least.alias("_l")), "cluster_id").filter(F.col("contig_len") > F.col("_l")).drop("_l")


def cluster_kmers(members: DataFrame, profiles: DataFrame) -> DataFrame:
    """Mean k-mer profile of a cluster in percent, three decimals (profiles: member, kmer, value)."""
    s = members.join(profiles, "member").groupBy("cluster_id", "kmer").agg(F.sum("value").alias("v"))
    t = s.groupBy("cluster_id").agg(F.sum("v").alias("t"))
    return s.join(t, "cluster_id").select("cluster_id", "kmer", (F.floor(F.col("v") * 100000.0 / F.col("t") + 0.5) / 1000.0).alias("percent"))


def assembly_stats(seqs: DataFrame, key: str) -> DataFrame:
    """Count, total, extremes, mean, median, N50, counts above powers of ten, and base composition per key."""
    c = seqs.withColumn("_l", F.length("seq"))
    base = {b: F.sum(F.regexp_count("seq", F.lit(f"[{b}{b.lower()}]"))).alias(f"n_{b.lower()}") for b in "ACGTN"}
    a = c.groupBy(key).agg(F.count("*").alias("n"), F.sum("_l").alias("total"), F.max("_l").alias("longest"), F.min("_l").alias("shortest"), F.avg("_l").alias("mean"), F.percentile("_l", F.lit(0.5)).alias("median"), *[F.count_if(F.col("_l") > x).alias(f"over_{x}") for x in (1_000, 10_000, 100_000, 1_000_000, 10_000_000)], *base.values())
    return a.join(cumulative_half(c, [key], "_l"), key)


def kmer_hashes(seq: str, k: int) -> np.ndarray:
    """K-mers of a sequence as 64-bit hashes; of a shorter one the whole."""
    codes = np.frombuffer(seq.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    width = min(k, len(codes))
    h = np.full(len(codes) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        h = (h + codes[j : len(codes) - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
    return h


def kmer_set(seq: str, k: int) -> np.ndarray:
    """Distinct k-mers of a sequence, sorted."""
    return overlap.distinct(kmer_hashes(seq, k))


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, count of them."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _runs(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and lengths of the runs of a sorted array."""
    start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
    return tokens[start], start, np.diff(np.append(start, len(tokens)))


def shared_kmers(one: tuple, two: tuple, chunk: int = 1 << 22, columns: int = 1 << 12) -> np.ndarray:
    """Sizes of all intersections of two blocks (sorted k-mers, row of each, sizes).

    K-mers of few rows are counted pair by pair, those of many by products of 0/1 matrices.
    """
    (ta, wa, na), (tb, wb, nb) = one, two
    rows, cols = len(na), len(nb)
    ua, sa, ca = _runs(ta)
    ub, sb, cb = _runs(tb)
    at = np.minimum(np.searchsorted(ub, ua), len(ub) - 1)
    both = ub[at] == ua
    sa, ca, sb, cb = sa[both], ca[both], sb[at[both]], cb[at[both]]
    out = np.zeros(rows * cols, dtype=np.int64)
    many = ca * cb * 256 > rows * cols
    few = np.flatnonzero(~many)
    total = np.cumsum((ca * cb)[few])
    a = 0
    while a < len(few):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + chunk, side="right")))
        t = few[a:b]
        left, times = wa[_spread(sa[t], ca[t])], np.repeat(cb[t], ca[t])
        right = wb[_spread(np.repeat(sb[t], ca[t]), times)]
        out += np.bincount(np.repeat(left, times) * cols + right, minlength=rows * cols)
        a = b
    out = out.reshape(rows, cols)
    dense = np.flatnonzero(many)
    for a in range(0, len(dense), columns):
        t = dense[a : a + columns]
        x, y = np.zeros((rows, len(t)), dtype=np.float32), np.zeros((cols, len(t)), dtype=np.float32)
        x[wa[_spread(sa[t], ca[t])], np.repeat(np.arange(len(t)), ca[t])] = 1
        y[wb[_spread(sb[t], cb[t])], np.repeat(np.arange(len(t)), cb[t])] = 1
        out += np.rint(x @ y.T).astype(np.int64)
    return out


def block_kmers(seqs: list[str], k: int, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mers sorted, row of each, set sizes) of a block; plain: all letters are ACGT, and k-mers are numbers of two bits a letter instead of hashes."""
    if not plain:
        sets = [kmer_set(s, k) for s in seqs]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        t, who = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), size)
        order = np.argsort(t, kind="stable")
        return t[order], who[order], size
    length = np.array([len(s) for s in seqs], dtype=np.int64)
    letters = _TWO_BITS[np.frombuffer("".join(seqs).encode(), dtype=np.uint8)]
    code = np.zeros(len(letters), dtype=np.int64)
    for j in range(k):
        code[: len(code) - j] |= letters[j:] << (2 * (k - 1 - j))
    row = np.repeat(np.arange(len(seqs)), length)
    inside = np.arange(len(letters)) <= np.repeat(np.cumsum(length) - k, length)
    key = (code[inside] << 24) | row[inside]
    short = [((1 << 2 * k) + int("1" + s.translate(_DIGITS), 4)) << 24 | i for i, s in enumerate(seqs) if len(s) < k]
    key = np.sort(np.concatenate([key, np.array(short, dtype=np.int64)]))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    who = key & ((1 << 24) - 1)
    return key >> 24, who, np.bincount(who, minlength=len(seqs))


_TWO_BITS = np.zeros(256, dtype=np.int64)
_TWO_BITS[[ord(c) for c in "ACGT"]] = range(4)
_DIGITS = str.maketrans("ACGT", "0123")
_PLAIN = re.compile("[ACGT]*")


def _near_rows(one: tuple, two: tuple, need: float, label: np.ndarray, left: np.ndarray, right: np.ndarray, out: list, most: int = 32) -> None:
    """Add to out, and to the labels, links between the rows of two blocks that aren't joined yet.

    A row of n k-mers needs at least m in common with any row of the other block.  Its c < m most
    common k-mers are left out, so that m - c of the others must be shared; only rows that have
    a partner of so many are counted whole.  Rows of too many common k-mers go to products of matrices.
    """
    (ta, wa, na), (tb, wb, nb) = one, two
    if not len(ta) or not len(tb):
        return
    cols = len(nb)
    ub, sb, cb = _runs(tb)
    at = np.minimum(np.searchsorted(ub, ta), len(ub) - 1)
    hit = ub[at] == ta
    at, who = at[hit], wa[hit]
    order = np.lexsort((cb[at], who)) if len(ub) >= 1 << 24 else np.argsort((who.astype(np.int64) << 24) | cb[at])
    at, bounds = at[order], np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(na)))])
    least = np.ceil(need / (1 + need) * (na + nb.min()) - 1e-6).astype(np.int64)
    weight = np.concatenate([[0], np.cumsum(cb[at])])
    dense = []

    def join(i: int, js: np.ndarray) -> None:
        for j in js:
            x, y = label[left[i]], label[right[j]]
            if x != y:
                label[label == max(x, y)] = min(x, y)
                out.append((int(left[i]), int(right[j])))

    for i in range(len(na)):
        a, b = bounds[i], bounds[i + 1]
        if b - a < least[i]:
            continue
        c = 4 * int(least[i]) // 5
        if weight[b - c] - weight[a] > most * cols or weight[b] - weight[a] > 64 * most * cols:
            dense.append(i)
            continue
        few = at[a : b - c]
        near = np.flatnonzero(np.bincount(wb[_spread(sb[few], cb[few])], minlength=cols) >= least[i] - c)
        near = near[label[right[near]] != label[left[i]]]
        if len(near):
            every = at[a:b]
            shared = np.bincount(wb[_spread(sb[every], cb[every])], minlength=cols)[near]
            join(i, near[shared >= need * (na[i] + nb[near] - shared)])
    for low in range(0, len(dense), 256):
        rows = np.array(dense[low : low + 256])
        place = np.full(len(na), -1)
        place[rows] = np.arange(len(rows))
        own = place[wa] >= 0
        shared = shared_kmers((ta[own], place[wa[own]], na[rows]), two)
        linked = shared >= need * (na[rows][:, None] + nb[None, :] - shared)
        for x, i in enumerate(rows):
            js = np.flatnonzero(linked[x])
            js = js[label[right[js]] != label[left[i]]]
            # One link for each cluster that the row meets.
            join(i, js[np.unique(label[right[js]], return_index=True)[1]])


def gene_links(seqs: list[str], sides: np.ndarray, k: int, need: float, rows: int = 1 << 14, tokens: int = 1 << 24) -> list[tuple[int, int]]:
    """Links that join what pairs of Jaccard similarity need or more join: pairs of the two sides, or all if there is one side.

    Blocks are cut in the order of set sizes, and blocks whose sizes are too far apart aren't compared.
    """
    plain = k <= 12 and all(_PLAIN.fullmatch(s) for s in seqs)

    def blocks(of: np.ndarray) -> list[tuple]:
        whole = block_kmers([seqs[i] for i in of], k, plain)
        if len(of) <= rows and len(whole[0]) <= tokens:
            return [(of, whole)] if len(of) else []
        order = np.argsort(whole[2], kind="stable")
        cut, held, out = 0, 0, []
        for i, n in enumerate(whole[2][order]):
            if i > cut and (held + n > tokens or i - cut >= rows):
                out.append(of[order[cut:i]])
                held, cut = 0, i
            held += n
        return [(x, block_kmers([seqs[i] for i in x], k, plain)) for x in [*out, of[order[cut:]]]]

    single = len(np.unique(sides)) < 2
    lefts = blocks(np.flatnonzero(sides == sides.min())) if len(sides) else []
    rights = lefts if single else blocks(np.flatnonzero(sides == sides.max()))
    label, out = np.arange(len(seqs)), []
    for n, (left, one) in enumerate(lefts):
        for right, two in rights[n:] if single else rights:
            low, high = (one[2], two[2]) if one[2].max() <= two[2].max() else (two[2], one[2])
            if low.max() >= need * high.min():
                _near_rows(one, two, need, label, left, right, out)
    return out


def cluster_genes(seqs: DataFrame, k: int = 11, identity: float = 0.95, block: int = 1 << 13, entries: int = overlap.ENTRIES) -> DataFrame:
    """(id, cluster): genes linked when the Jaccard similarity of their k-mer sets reaches what the identity implies.

    Equal sequences are one node.  The rare k-mers of the nodes are kept once, in blocks of like
    set sizes, and every two blocks whose sizes can link are counted in one task; pairs that
    share enough of them are compared whole.  No link is missed; the work still grows with the
    square of the nodes, by some nanoseconds for each rare k-mer that two of them share, the
    disk with the nodes.  The longest gene of a cluster names it.
    """
    need = identity**k / (2 - identity**k)
    law = overlap.Law(need / (1 + need), need / (1 + need), 0.0, need, 0.0)
    own = cut(seqs.select("id", F.length("seq").alias("len"), F.sha2("seq", 256).alias("digest"), "seq"))
    nodes = own.filter("id is not null and seq is not null").groupBy("digest").agg(F.any_value("seq").alias("seq"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [len(kmer_set(s, k)) for s in batch.column("seq").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("seq"), pa.array(size, pa.int64())], names=["digest", "seq", "size"])

    def links(one: overlap.Block, i: int, two: overlap.Block, j: int) -> bool:
        x, y = (of.once(n, lambda s: kmer_set(s, k)) for of, n in ((one, i), (two, j)))
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return shared >= need * (len(x) + len(y) - shared)

    sized = cut(nodes.mapInArrow(sizes, "digest string, seq string, size long"))
    roots = graph.merge_clusters(overlap.linked_pairs(overlap.in_parts(sized, lambda s: kmer_hashes(s, k), law, block, entries), law, links))
    placed = own.select("id", "len", "digest").join(roots, F.col("digest") == F.col("node"), "left").select("id", "len", F.coalesce("root", "digest", F.col("id").cast("string")).alias("root")).filter("id is not null")
    top = placed.groupBy("root").agg(F.max_by("id", F.struct("len", "id")).alias("cluster"))
    return placed.join(top, "root").select("id", "cluster")


def interleave(one: DataFrame, two: DataFrame) -> DataFrame:
    """Both mates of each read after one another: (id, mate, seq, qual)."""
    j = one.select("id", F.col("seq").alias("s1"), F.col("qual").alias("q1")).join(two.select("id", F.col("seq").alias("s2"), F.col("qual").alias("q2")), "id")
    pair = F.explode(F.array(F.struct(F.lit(1).alias("mate"), F.col("s1").alias("seq"), F.col("q1").alias("qual")), F.struct(F.lit(2).alias("mate"), F.col("s2").alias("seq"), F.col("q2").alias("qual")))).alias("p")
    return j.select("id", pair).select("id", "p.mate", "p.seq", "p.qual")


def number_names(df: DataFrame, keys: list[str], order: list[str], pattern: str, name: str = "new_id") -> DataFrame:
    """Names by position within a group; pattern has %d."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.format_string(pattern, F.row_number().over(w)))


def gene_catalogue_name(sample: Column, contig_no: Column, length: Column) -> Column:
    """SAMPLE__Cn_L=len=."""
    return F.concat(sample, F.lit("__C"), contig_no.cast("string"), F.lit("_L="), length.cast("string"), F.lit("="))


def parse_name(name: Column) -> Column:
    """smpl, contig, len and gene_no of a structured identifier."""
    pat = r"^(.+?)__(C\d+)_L=(\d+)=(?:_(\d+))?$"
    g = lambda i: F.regexp_extract(name, pat, i)
    return F.struct(g(1).alias("smpl"), g(2).alias("contig"), F.when(g(3) != "", g(3)).cast("long").alias("len"), F.when(g(4) != "", g(4)).cast("int").alias("gene_no"))
