"""Pairs of sets that share enough members, found without comparing every two sets whole.

A law says how many members two sets must share at least.  All members are put in one order, rare
ones first, so that of a pair's shared members only the most common ones can be missing where
each set leaves out its last c: a pair that must share m shares m - c of the rest at least.
What is left is kept once, in blocks of sets of like size, and every two blocks whose sizes can
link are counted in one task, by a table of places and numpy; pairs that share m - c are
told to a check of the whole sequences.  The order comes from a sample of the sets and steers
only the work: whatever the order, no pair is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from .blocks import pack, unpack

BITS = 22  # members are told apart by so many bits of their hash; more in common than there is costs a check only
SAMPLE = 1 << 13  # sets that the order is taken from
ENTRIES = 16 << 20  # members of a part, each set counted as some more
_ROW = 1 << 10
_HITS = 1 << 16
_LOW = (1 << 32) - 1
_FIELDS = ("names", "seqs", "sizes", "wants", "ends", "codes")
_SCHEMA = "part int, lo long, hi long, " + ", ".join(f"{c} binary" for c in _FIELDS)
_ARROW = pa.schema([("part", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), *((c, pa.binary()) for c in _FIELDS)])


class Law(NamedTuple):
    """Sets of sizes a <= b link only if they share ceil(small * a + large * b + more) members and a >= share * b + shift."""

    small: float
    large: float
    more: float
    share: float
    shift: float

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Members that sets of these sizes share at least."""
        return np.maximum(np.ceil(self.small * np.minimum(a, b) + self.large * np.maximum(a, b) + self.more - 1e-6), 1).astype(np.int64)

    def partner(self, b: np.ndarray | int) -> np.ndarray:
        """Size of the smallest set that sets of this size link with."""
        return np.maximum(np.ceil(self.share * b + self.shift - 1e-6), 1).astype(np.int64)

    def least_of(self, a: np.ndarray, low: int) -> np.ndarray:
        """Members shared at least with any partner of size low or more."""
        return self.least(a, np.maximum(self.partner(a), low))


#: Part of the sets that hold a hash value, by its class.
_SHARE = (np.exp2(np.arange(256) / 16) - 0.5) / SAMPLE


def distinct(values: np.ndarray) -> np.ndarray:
    """Different values, sorted."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _ids(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(64 - BITS)).astype(np.int64)


def rarity(nodes: DataFrame, members: Callable[[str], np.ndarray], count: int) -> tuple[np.ndarray, float]:
    """(class of each hash value by the number of sampled sets that hold it, mean size of a set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets, total = np.zeros(1 << BITS, dtype=np.uint16), 0, 0
        for batch in batches:
            for seq in batch.column("seq").to_pylist():
                ids = distinct(_ids(members(seq)))
                held[ids] += 1
                sets, total = sets + 1, total + len(ids)
        if sets:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary()), pa.array([sets], pa.int64()), pa.array([total], pa.int64())], names=["held", "sets", "total"])

    digit = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    some = nodes.filter(digit < int(min(1.0, SAMPLE / max(count, 1)) * (1 << 32))).select("seq")
    got = some.repartition(4).mapInArrow(run, "held binary, sets long, total long").collect()
    sets = max(1, sum(r.sets for r in got))
    held = sum((np.frombuffer(r.held, dtype=np.uint16).astype(np.int64) for r in got), np.zeros(1 << BITS, dtype=np.int64))
    return np.minimum(16 * np.log2(1 + held * (SAMPLE / sets)), 255).astype(np.uint8), max(1.0, sum(r.total for r in got) / sets)


def _in_order(members: np.ndarray, grade: np.ndarray, law: Law, mean: float) -> tuple[int, np.ndarray]:
    """(shared members wanted before a pair is checked, hash values kept with their places from the common end in 255ths of the set)."""
    key = distinct((grade[_ids(members)].astype(np.uint64) << np.uint64(56)) | (members >> np.uint64(8)))
    n = len(key)
    # As many as chance hardly gives: what a set of this size shares with others in what is left, several times.
    chance = np.cumsum(_SHARE[(key >> np.uint64(56)).astype(np.int64)]) * (n / mean)
    most = int(law.least(np.int64(n), np.int64(n)))
    drop = np.arange(min(most, n))
    fits = np.flatnonzero(most - drop >= 8 + 4 * chance[n - 1 - drop])
    want = most - int(fits[-1]) if len(fits) else most
    kept = n - max(0, int(law.least_of(np.int64(n), 0)) - want)
    place = (n - 1 - np.arange(kept)) * 255 // max(n, 1)
    code = ((key[:kept] >> np.uint64(56 - BITS)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return want, np.sort(((code << 8) | place).astype(np.uint32))


class Block:
    """Sets as they are kept: their sequences and the members left of each."""

    def __init__(self, row: dict) -> None:
        self.packed = row["names"], row["seqs"]
        self.sizes, self.wants, self.ends = (np.frombuffer(row[c], dtype=np.int64) for c in ("sizes", "wants", "ends"))
        self.codes = np.frombuffer(row["codes"], dtype=np.uint32)  # a hash value and, in the last 8 bits, its place
        self.lo, self.hi = int(self.sizes[0]), int(self.sizes[-1])
        self.texts: list[str] | None = None
        self.made: dict[int, object] = {}

    def names(self) -> list[str]:
        return unpack(self.packed[0])

    def once(self, i: int, make: Callable[[str], object]) -> object:
        """What make gives for a set's sequence, made once."""
        if i not in self.made:
            self.texts = unpack(self.packed[1]) if self.texts is None else self.texts
            self.made[i] = make(self.texts[i])
        return self.made[i]

    def kept(self, law: Law, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(members that each set leaves out beside sets of size low or more, hash values kept, their end in each set)."""
        drop = np.maximum(law.least_of(self.sizes, low) - self.wants, 0)
        keep = (self.codes & 255) >= np.repeat((drop * 255 // self.sizes).astype(np.uint32), np.diff(self.ends, prepend=0))
        return drop, (self.codes[keep] >> 8).astype(np.int64), np.append(0, np.cumsum(keep))[self.ends]


class Places:
    """The sets of some blocks by hash value, against which those of others are counted, none of them smaller than low; at: the number of the first one."""

    def __init__(self, blocks: list[Block], law: Law, low: int, at: int) -> None:
        self.law, self.blocks, self.at = law, blocks, at
        self.first = np.cumsum([0, *(len(b.sizes) for b in blocks)])
        self.sizes = np.concatenate([b.sizes for b in blocks])
        self.lo = int(self.sizes.min())
        self.want = min(int(b.wants.min()) for b in blocks)
        drop, held = [], 0
        key = np.empty(sum(len(b.codes) for b in blocks), dtype=np.int64)
        for b, first in zip(blocks, self.first.tolist(), strict=False):
            own, codes, ends = b.kept(law, low)
            codes <<= 32
            codes |= np.repeat(np.arange(first, first + len(ends)), np.diff(ends, prepend=0))
            drop.append(own)
            key[held : held + len(codes)] = codes
            held += len(codes)
        self.drop, key = np.concatenate(drop), key[:held]
        key.sort()
        self.sets = key.astype(np.uint16 if len(self.sizes) <= 1 << 16 else np.uint32)  # the lower bits
        key >>= 32
        times = np.bincount(key, minlength=1 << BITS)
        self.spans = ((np.cumsum(times) - times) << 32) | times

    def near(self, two: Block, before: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(set of two, sets here that share enough of what is left), most shared first; before: the number here of two's first set, each meets those before it."""
        drop, codes, ends = two.kept(self.law, self.lo)
        span = self.spans[codes]
        times = span & _LOW
        span >>= 32
        hits = np.append(0, np.cumsum(times))
        span -= hits[:-1]
        hits = hits[np.append(0, ends)]
        wants = np.minimum(two.wants, self.want)
        a, rows, cols = 0, len(two.sizes), len(self.sizes)
        while a < rows:
            b = max(a + 1, int(np.searchsorted(hits, hits[a] + _HITS, side="right")) - 1)
            own = slice(ends[a - 1] if a else 0, ends[b - 1])
            at = np.repeat(span[own], times[own])
            at += np.arange(hits[a], hits[b])
            found = self.sets.take(at, mode="clip")
            for i in (a + np.flatnonzero(np.diff(hits[a : b + 1]) >= wants[a:b])).tolist():
                shared = np.bincount(found[hits[i] - hits[a] : hits[i + 1] - hits[a]], minlength=cols)
                if before is not None:
                    shared[before + i :] = 0
                if shared.max() < wants[i]:
                    continue
                js = np.flatnonzero(shared >= wants[i])
                n, size = int(two.sizes[i]), self.sizes[js]
                js = js[(shared[js] >= self.law.least(size, n) - np.maximum(self.drop[js], drop[i])) & (np.minimum(size, n) >= self.law.partner(np.maximum(size, n)))]
                if len(js):
                    yield i, js[np.argsort(-shared[js], kind="stable")]
            a = b

    def links(self, two: Block, label: np.ndarray, right: int, own: bool, linked: Callable[[Block, int, Block, int], bool]) -> Iterator[tuple[int, int]]:
        """(number, set of two) of links that join what all links with two join; label says by number what is joined already, two's first set has the number right (own: it meets smaller numbers only)."""
        here = label[self.at : self.at + len(self.sizes)]
        for i, js in self.near(two, right - self.at if own else None):
            for j in js[here[js] != label[right + i]].tolist():
                x, y = int(here[j]), int(label[right + i])
                of = int(np.searchsorted(self.first, j, side="right")) - 1
                if x != y and linked(self.blocks[of], j - int(self.first[of]), two, i):
                    label[label == max(x, y)] = min(x, y)
                    yield self.at + j, i


class Part:
    """The blocks of a part, in the order of sizes, with tables of those of like size that are made when they are needed first."""

    def __init__(self, blocks: list[Block], law: Law) -> None:
        self.law, self.blocks = law, blocks
        self.first = np.cumsum([0, *(len(b.sizes) for b in blocks)]).tolist()
        self.names = [x for b in blocks for x in b.names()]
        self.groups: list[list[int]] = []
        for k, b in enumerate(blocks):
            if not self.groups or law.partner(b.hi) > blocks[self.groups[-1][0]].lo:
                self.groups.append([])
            self.groups[-1].append(k)
        self.places: dict[int, Places] = {}

    def meeting(self, two: Block, low: int, right: int | None = None) -> Iterator[Places]:
        """Tables of the sets that can link with two's; right: its place here, only tables up to there.  Blocks come in the order of sizes, so that a table goes when it is behind."""
        for g, ks in enumerate(self.groups):
            lo, hi, at = self.blocks[ks[0]].lo, self.blocks[ks[-1]].hi, self.first[ks[0]]
            if hi < self.law.partner(two.lo):
                self.places.pop(g, None)
            elif two.hi >= self.law.partner(lo) and (right is None or at <= right):
                if g not in self.places:
                    self.places[g] = Places([self.blocks[k] for k in ks], self.law, lo if right is not None else min(lo, low), at)
                yield self.places[g]


def in_parts(nodes: DataFrame, members: Callable[[str], np.ndarray], law: Law, rows: int = 1 << 13, entries: int = ENTRIES) -> DataFrame:
    """Blocks of nodes (digest, seq, size): parts of about as many members each follow the sizes, a part's last row says its sizes; materialised.

    members gives a sequence's set, size different hashes of 64 bits, which may be repeated.
    """
    spark = nodes.sparkSession
    key = F.floor(F.log2(F.col("size")) * 64) * 16 + F.pmod(F.xxhash64("digest"), F.lit(16))
    sizes = sorted((r[0], r[1], r[2]) for r in nodes.groupBy(key.alias("key")).agg(F.sum(F.col("size") + _ROW), F.count("*")).collect())
    whole = sum(r[1] for r in sizes)
    # At least so many that pairs of parts, or parts if few others link with one, keep all cores busy.
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, -(-whole // entries), min(int((8 * cores) ** 0.5) if law.share < 0.8 else 2 * cores, whole >> 20))
    limits, held = [], 0
    for k, n, _ in sizes:
        if held >= whole * (len(limits) + 1) / parts:
            limits.append(k)
        held += n
    grade, mean = rarity(nodes, members, sum(r[2] for r in sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lo, hi = -1, 0, 0
        block: list[tuple] = []
        held = 0

        def given() -> pa.RecordBatch:
            names, seqs, sizes, wants, codes = zip(*block, strict=True)
            ends = np.cumsum([len(x) for x in codes])
            data = [pack(names), pack(seqs), *(np.array(x, dtype=np.int64).tobytes() for x in (sizes, wants, ends)), np.concatenate(codes).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sizes[0]], pa.int64()), pa.array([sizes[-1]], pa.int64()), *(pa.array([x], pa.binary()) for x in data)], schema=_ARROW)

        for batch in batches:
            for at, name, seq, size in zip(*(batch.column(c).to_pylist() for c in ("part", "digest", "seq", "size")), strict=True):
                lo, hi, part = (lo if part >= 0 else size), size, at
                want, codes = _in_order(members(seq), grade, law, mean)
                if block and (len(block) >= rows or law.partner(size) > block[0][2] or held + len(codes) > entries // 16):
                    yield given()
                    block, held = [], 0
                block.append((name, seq, size, want, codes))
                held += len(codes)
        if block:
            yield given()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([lo], pa.int64()), pa.array([hi], pa.int64()), *(pa.array([None], pa.binary()) for _ in _FIELDS)], schema=_ARROW)

    part = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in limits]).cast("array<bigint>"), lambda x: x <= key)) if limits else F.lit(0)
    dealt = nodes.select(part.cast("int").alias("part"), "digest", "seq", "size").repartitionById(parts, F.col("part")).sortWithinPartitions("size", "digest")
    return cut(dealt.mapInArrow(run, _SCHEMA))


def linked_pairs(blocks: DataFrame, law: Law, linked: Callable[[Block, int, Block, int], bool]) -> DataFrame:
    """(a, b): links that join what all links join, from in_parts' blocks; materialised.

    The product of partitions reads them and writes nothing.  Each block of a left part meets
    the right part's last row only and the other way round, so that a task gets every block once.
    """
    left, right = (blocks.select(*[F.col(c).alias(f"{c}_{k}") for c in blocks.columns]) for k in "lr")
    last_l, last_r = F.col("names_l").isNull(), F.col("names_r").isNull()
    once = (~last_l & last_r) | (last_l & ~last_r & (F.col("part_l") < F.col("part_r")))
    near = (F.col("hi_l") + 1 >= law.share * F.col("lo_r") + law.shift) & (F.col("hi_r") + 1 >= law.share * F.col("lo_l") + law.shift)
    met = left.hint("shuffle_replicate_nl").join(right, (F.col("part_l") <= F.col("part_r")) & once & near)
    given = met.select(last_l.alias("late"), (F.col("part_l") == F.col("part_r")).alias("own"), F.least("lo_l", "lo_r").alias("low"), *[F.when(last_l, F.col(f"{c}_r")).otherwise(F.col(f"{c}_l")).alias(c) for c in _FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[Block] = []
        part: Part | None = None
        label, low, own = np.zeros(0, dtype=np.int64), 1 << 62, False

        def found(two: Block, label: np.ndarray, right: int) -> Iterator[pa.RecordBatch]:
            links = [x for places in part.meeting(two, low, right if own else None) for x in places.links(two, label, right, own, linked)]
            if links:
                b = two.names()
                yield pa.RecordBatch.from_arrays([pa.array([part.names[j] for j, _ in links]), pa.array([b[i] for _, i in links])], names=["a", "b"])

        for batch in batches:
            for x in range(batch.num_rows):
                row = {c: batch.column(c)[x].as_py() for c in batch.schema.names}
                if not row["late"]:
                    left.append(Block(row))
                    low, own = min(low, row["low"]), row["own"]
                elif left:
                    if part is None:
                        part = Part(left, law)
                        label = np.arange(part.first[-1])
                    two = Block(row)
                    both = np.append(label, len(label) + np.arange(len(two.sizes)))
                    yield from found(two, both, len(label))
                    label = both[: len(label)]
        if own:
            part = Part(left, law)
            label = np.arange(part.first[-1])
            for k, two in enumerate(left):
                yield from found(two, label, part.first[k])

    return cut(given.mapInArrow(run, "a string, b string"))
