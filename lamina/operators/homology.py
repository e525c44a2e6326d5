"""Genes clustered by the identity of their alignments, without comparing all pairs.

Two genes link if the edit distance of their whole sequences is at most e, the share
1 - identity of the longer one's length (so both are covered).  Candidates are exact:
e edits change at most q e of the longer gene's substrings of q letters, so that the others
are in the shorter gene too, as often; overlap.py finds the pairs that share so many.  Of short
genes, and where so many edits are allowed that no substring need be shared, disjoint pieces are
looked up: e edits touch at most e of them, so of any e + 1 pieces one at least stands unchanged
in the other gene, at most e places away.  Those genes are kept once, in blocks sorted by length,
and only blocks whose lengths lie within e of each other meet.  Pairs that pass the count are
aligned in a band that doubles until it holds the distance or exceeds e.

Families share their pieces: within a task pairs that links have joined already are neither
looked up nor aligned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from . import overlap
from .blocks import compare_blocks, sized_blocks
from .graph import merge_clusters

SEED = 16  # a piece's length at most
LEAST = 64  # letters of a gene that is compared by its substrings
_ODD = np.uint64(0x9E3779B97F4A7C15)


def edits_allowed(length: int, identity: float) -> int:
    return int((1 - identity) * length + 1e-9)


def piece_length(length: int, identity: float) -> int:
    """Length of the pieces of a gene: at least one more than the edits allowed fit in."""
    return min(SEED, length // (edits_allowed(length, identity) + 1))


def codes_of(seq: str) -> np.ndarray:
    return np.frombuffer(seq.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def seed_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each substring of width letters; width is part of it."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        h = (h ^ codes[j : n + j]) * _ODD
        h ^= h >> np.uint64(29)
    return h


def pieces_found(a: np.ndarray, b: np.ndarray, width: int, shift: int) -> int:
    """How many of a's disjoint pieces stand in b at most shift places away."""
    p = len(a) // width
    pieces = seed_hashes(a, width)[: p * width : width][:p]
    subs = seed_hashes(b, width)
    if not len(subs):
        return 0
    names, rank = np.unique(subs, return_inverse=True)
    base = np.int64(len(a) + len(b) + 2 * shift + 2)
    places = np.sort(rank.astype(np.int64) * base + np.arange(len(subs)) + shift)
    at = np.minimum(np.searchsorted(names, pieces), len(names) - 1)
    own = np.arange(p, dtype=np.int64) * width + shift
    low, high = np.searchsorted(places, at * base + own - shift), np.searchsorted(places, at * base + own + shift, side="right")
    return int(((names[at] == pieces) & (high > low)).sum())


def banded_distance(a: np.ndarray, b: np.ndarray, most: int, guess: int = 0) -> int:
    """The edit distance of a and b, or most + 1 if it is larger, in bands that double from a guess of it on."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    start = int(differ[0]) if len(differ) else n
    a, b = a[start:], b[start:]
    n -= start
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    end = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - end], b[: len(b) - end]
    k = max(32, guess, abs(len(a) - len(b)))
    while True:
        k = most if 3 * k >= 2 * most else k
        if 4 * k >= len(a):
            return min(_by_columns(a, b, most), most + 1)
        d = _in_band(a, b, k)
        if d <= k or k >= most:
            return min(d, most + 1)
        k *= 2


def _bits(a: np.ndarray) -> dict[int, int]:
    """Where each letter stands, as the bits of a number."""
    return {c: int.from_bytes(np.packbits(a == c, bitorder="little").tobytes(), "little") for c in np.unique(a).tolist()}


def _by_columns(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """The edit distance, or more than most if it is larger; a column of the table is two numbers, the steps up and down in it."""
    if not len(a):
        return len(b)
    where, whole, last = _bits(a), (1 << len(a)) - 1, len(a) - 1
    up, down, d, left = whole, 0, len(a), len(b)
    for c in b.tolist():
        x = where.get(c, 0)
        v = x | down
        h = (((x & up) + up) ^ up) | x
        plus = down | (~(h | up) & whole)
        minus = up & h
        d += (plus >> last & 1) - (minus >> last & 1)
        left -= 1
        if d - left > most:
            return most + 1
        plus = plus << 1 | 1
        up = (minus << 1 | ~(v | plus)) & whole
        down = plus & v & whole
    return d


def _in_band(a: np.ndarray, b: np.ndarray, k: int, columns: int = 512) -> int:
    """The edit distance, or k + 1 if it is larger, for a longer than k: only places at most k off the diagonal, of which the columns slide down by one letter of b each."""
    width = 2 * k + 2
    whole, first, last = (1 << width) - 1, width - 1, width - 2
    where = _bits(a)
    up, down, d, most = whole ^ ((1 << (width - k - 1)) - 1), 0, k, 2 * k + len(b) - len(a)
    for at in range(0, len(b), columns):
        # Letters that these columns can meet, so that shifts are as short as the band.
        begin = at + k + 1 - width
        some = {c: (x >> begin if begin >= 0 else x << -begin) & ((1 << (width + columns)) - 1) for c, x in where.items()}
        for j, c in enumerate(b[at : at + columns].tolist()):
            x = (some.get(c, 0) >> j) & whole
            z = ((((x & up) + up) ^ up) | x | down) & whole
            plus = down | (~(z | up) & whole)
            minus = z & up
            if at + j < len(a) - k:
                d += 1 - (z >> first)
            else:
                d += (plus >> last & 1) - (minus >> last & 1)
                last -= 1
            if d > most:
                return k + 1
            z >>= 1
            up = minus | (~(z | plus) & whole)
            down = z & plus
        done = min(at + columns, len(b))
        if done < len(a) - k:
            # No place of this column that the end can be reached from by k edits.
            steps = [np.unpackbits(np.frombuffer(x.to_bytes(width // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[last - 2 * k + 1 : last + 1].astype(np.int64) for x in (up, down)]
            here = d - np.append(0, np.cumsum((steps[0] - steps[1])[::-1]))
            rows = done + k - np.arange(2 * k + 1)
            if (here + np.abs((len(a) - rows) - (len(b) - done)))[rows >= 0].min() > k:
                return k + 1
    return min(d, k + 1)


def linked(a: str, b: str, identity: float) -> bool:
    """Whether two sequences link, by counting pieces and then aligning."""
    x, y = codes_of(a), codes_of(b)
    if len(x) < len(y):
        x, y = y, x
    e = edits_allowed(len(x), identity)
    if len(x) - len(y) > e:
        return False
    if not len(x):
        return True
    width = piece_length(len(x), identity)
    if pieces_found(x, y, width, e) < len(x) // width - e:
        return False
    return banded_distance(x, y, e) <= e


def piece_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """seed_hashes of the disjoint pieces only."""
    cut = codes[: len(codes) // width * width].reshape(-1, width)
    h = np.full(len(cut), width, dtype=np.uint64)
    for j in range(width):
        h = (h ^ cut[:, j]) * _ODD
        h ^= h >> np.uint64(29)
    return h


def block_links(one: list[str], two: list[str] | None, identity: float, chunk: int = 1 << 21) -> list[tuple[int, int]]:
    """(place in one, place in two) of links that join what all links between two blocks join; two: the longer genes, or none for the links inside one.

    Both are sorted by length.  Of a gene's p pieces, p - e at least stand in a partner; its
    most common ones are left out, half of those that must be found.  Pieces that stand only in
    genes that are joined with it already aren't looked up.
    """
    longs = one if two is None else two
    short, long = [codes_of(s) for s in one], [codes_of(s) for s in longs]
    lb, la = (np.array([len(x) for x in c], dtype=np.int64) for c in (short, long))
    first = 0 if two is None else len(one)
    label, out = np.arange(first + len(longs)), []
    widths = np.array([piece_length(int(n), identity) if n else 0 for n in la])
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        least = la[rows[0]] - edits_allowed(int(la[rows[0]]), identity)
        pieces = [piece_hashes(long[i], width) for i in rows]
        names, ids = np.unique(np.concatenate(pieces), return_inverse=True)
        ids = np.split(ids, np.cumsum([len(x) for x in pieces])[:-1])
        found, where, whose = [], [], []
        for j in np.flatnonzero((lb >= least) & (lb <= la[rows[-1]])):
            subs = seed_hashes(short[j], width)
            at = np.minimum(np.searchsorted(names, subs), len(names) - 1)
            hit = np.flatnonzero(names[at] == subs)
            found.append(at[hit])
            where.append(hit.astype(np.int32))
            whose.append(np.full(len(hit), j, dtype=np.int32))
        if not found:
            continue
        key = np.concatenate(found)
        order = np.argsort(key, kind="stable")
        where, whose = np.concatenate(where)[order], np.concatenate(whose)[order]
        count = np.bincount(key, minlength=len(names))
        start = np.cumsum(count) - count
        some = np.flatnonzero(count)
        low, high = np.full(len(names), -1), np.full(len(names), -1)  # labels of the genes that a piece stands in
        stale = len(some) > 0
        for n, (i, own) in enumerate(zip(rows[::-1].tolist(), ids[::-1], strict=True)):
            if stale and n % 64 == 0:
                of, stale = label[whose], False
                low[some], high[some] = np.minimum.reduceat(of, start[some]), np.maximum.reduceat(of, start[some])
            e = edits_allowed(int(la[i]), identity)
            spare = (len(own) - e - 1) // 2
            take = np.argsort(count[own], kind="stable")[: len(own) - spare]
            k = own[take]
            use = (count[k] > 0) & ~((low[k] == high[k]) & (low[k] == label[first + i]))
            k, place = k[use], take[use] * width
            if len(k) < len(own) - e - spare:
                continue
            hits, total, a = np.zeros(len(one), dtype=np.int64), np.cumsum(count[k]), 0
            while a < len(k):
                b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + chunk, side="right")))
                size = count[k[a:b]]
                at = np.repeat(start[k[a:b]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                near = np.abs(where[at] - np.repeat(place[a:b], size)) <= e
                hits += np.bincount(whose[at[near]], minlength=len(one))
                a = b
            near = np.flatnonzero((hits >= len(own) - e - spare) & (lb >= la[i] - e) & (lb <= la[i]))
            near = near[near < i] if two is None else near
            for j in near[np.argsort(-hits[near], kind="stable")].tolist():
                x, y = label[j], label[first + i]
                if x != y and linked(longs[i], one[j], identity):
                    label[label == max(x, y)] = min(x, y)
                    out.append((j, i))
                    stale = True
    return out


def gram_width(identity: float) -> int:
    """Length of the substrings that are counted: links share nearly half of them at least."""
    return min(SEED, int(0.55 / (1 - identity) + 1e-9)) if identity < 1 else SEED


def grams(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all substrings of width letters, one that comes again with the number of its time."""
    h = np.sort(seed_hashes(codes, width))
    first = np.append(True, h[1:] != h[:-1])[: len(h)]
    at = np.arange(len(h))
    return h + (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def gram_law(identity: float, width: int) -> overlap.Law:
    """An edit changes at most width substrings; a sequence of n letters has n - width + 1."""
    lost = (1 - identity) * width
    return overlap.Law(0.0, 1 - lost, -lost * (width - 1), identity, (identity - 1) * (width - 1))


def gram_links(one: overlap.Block, i: int, two: overlap.Block, j: int, identity: float, width: int) -> bool:
    """Whether two sequences link, by counting all substrings and then aligning."""
    (x, s), (y, t) = (of.once(n, lambda seq: ((c := codes_of(seq)), np.sort(grams(c, width)))) for of, n in ((one, i), (two, j)))
    e = edits_allowed(max(len(x), len(y)), identity)
    if abs(len(x) - len(y)) > e:
        return False
    lost = max(len(s), len(t)) - len(np.intersect1d(s, t, assume_unique=True))
    return lost <= width * e and banded_distance(x, y, e, 3 * lost // (2 * width)) <= e


def identity_clusters(seqs: DataFrame, identity: float = 0.95, letters: int = 1 << 21, rows: int = 1 << 13, entries: int = overlap.ENTRIES) -> DataFrame:
    """(id, cluster) of genes (id, seq): clusters are what links join, named by their longest gene (of ties the largest id).

    Equal sequences are one node.  Null ids and null sequences are left out; empty sequences
    link to each other only.
    """
    if not 0.5 <= identity <= 1:
        raise ValueError("identity: from 0.5 to 1")
    own = cut(seqs.select("id", F.length("seq").alias("len"), F.sha2("seq", 256).alias("digest"), "seq").filter("id is not null and seq is not null"))
    nodes = cut(own.groupBy("digest").agg(F.any_value("seq").alias("seq")).withColumn("size", F.length("seq")))
    width = gram_width(identity)
    # Of short genes, and where many edits are allowed, too few substrings must be shared.
    least = LEAST if width >= 8 else 1 << 62
    held = sized_blocks(nodes.filter(F.col("size") * identity - 1 < least), letters, rows)
    links = compare_blocks(held, identity - 1e-6, lambda one, two: block_links(one, two, identity))
    if width >= 8:
        law = gram_law(identity, width)
        long = nodes.filter(F.col("size") >= least).withColumn("size", (F.col("size") - (width - 1)).cast("long"))
        parts = overlap.in_parts(long, lambda s: grams(codes_of(s), width), law, rows, entries)
        links = links.union(overlap.linked_pairs(parts, law, lambda one, i, two, j: gram_links(one, i, two, j, identity, width)))
    roots = merge_clusters(links)
    placed = own.join(roots, F.col("digest") == F.col("node"), "left").select("id", "len", F.coalesce("root", "digest").alias("root"))
    top = placed.groupBy("root").agg(F.max_by("id", F.struct("len", "id")).alias("cluster"))
    return placed.join(top, "root").select("id", "cluster")
