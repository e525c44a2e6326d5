"""Pileups of alignments: depth as runs, and the bases at each position, for contigs of any length.

Alignments are (contig, pos, cigar, seq, qual, mapq): pos is 1-based, and qual may be null.  A
CIGAR becomes the blocks of its operations.  Depth comes from events, +1 where a block
begins and -1 behind its end: each contig's events add up to 0, so the running total over all
contigs in order is the depth, and it is worked out over sorted ranges, whose borders cut
contigs anywhere.  Bases are counted per (contig, bin): blocks are sent to their bins, and a
kernel counts each position.  No contig meets in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from .intervals import interval_join

#: Operations that go along the reference, along the read, and along both.
ALONG_REFERENCE, ALONG_READ, ALIGNED = "MDN=X", "MIS=X", "M=X"
_BLOCK = "array<struct<op:string,n:int,ref:int,read:int>>"


def cigar_blocks(cigar: Column) -> Column:
    """Operations with their lengths and 0-based offsets on reference and read; none for a missing or broken CIGAR."""
    n = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)[MIDNSHP=X]"), F.lit(1)), lambda x: x.cast("int"))
    op = F.regexp_extract_all(cigar, F.lit("[0-9]+([MIDNSHP=X])"), F.lit(1))
    first = F.struct(F.array().cast(_BLOCK).alias("done"), F.lit(0).alias("ref"), F.lit(0).alias("read"))

    def step(s: Column, x: Column) -> Column:
        block = F.struct(x["op"].alias("op"), x["n"].alias("n"), s["ref"].alias("ref"), s["read"].alias("read"))
        along = lambda kinds: F.when(F.instr(F.lit(kinds), x["op"]) > 0, x["n"]).otherwise(0)
        return F.struct(F.concat(s["done"], F.array(block)).alias("done"), (s["ref"] + along(ALONG_REFERENCE)).alias("ref"), (s["read"] + along(ALONG_READ)).alias("read"))

    blocks = F.aggregate(F.zip_with(n, op, lambda a, b: F.struct(a.alias("n"), b.alias("op"))), first, step, lambda s: s["done"])
    return F.when(cigar.rlike("^([0-9]+[MIDNSHP=X])+$"), blocks).otherwise(F.array().cast(_BLOCK))


def _kind(ops: str) -> Column:
    return F.instr(F.lit(ops), F.col("b.op")) > 0


def aligned_blocks(alignments: DataFrame, min_mapq: int = 0, ops: str = ALIGNED) -> DataFrame:
    """(contig, start, end, read, op, seq, qual): blocks of the named operations, 1-based and inclusive; read is where the block begins on the read."""
    a = alignments if "mapq" in alignments.columns else alignments.withColumn("mapq", F.lit(255))
    a = a if "qual" in a.columns else a.withColumn("qual", F.lit(None).cast("string"))
    a = a.filter((F.coalesce("mapq", F.lit(0)) >= min_mapq) & F.col("contig").isNotNull() & F.col("pos").isNotNull())
    b = a.select("contig", "pos", "seq", "qual", F.explode(cigar_blocks(F.col("cigar"))).alias("b")).filter(_kind(ops) & (F.col("b.n") > 0))
    start = F.col("pos").cast("long") + F.col("b.ref")
    return b.select("contig", start.alias("start"), (start + F.col("b.n") - 1).alias("end"), F.col("b.read").alias("read"), F.col("b.op").alias("op"), "seq", F.when(F.col("qual") != "*", F.col("qual")).alias("qual"))


def depth_runs(alignments: DataFrame, min_mapq: int = 0, deletions: bool = False) -> DataFrame:
    """(contig, start, end, depth): maximal runs of one depth above 0, 1-based and inclusive; deleted positions count only if asked for."""
    blocks = aligned_blocks(alignments, min_mapq, ALIGNED + ("D" if deletions else ""))
    events = blocks.select("contig", F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).cast("long").alias("delta")), F.struct((F.col("end") + 1).alias("pos"), F.lit(-1).cast("long").alias("delta")))).alias("e"))
    steps = events.groupBy("contig", "e.pos").agg(F.sum("e.delta").alias("delta")).filter("delta != 0")
    parts = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = cut(steps.repartitionByRange(parts, "contig", "pos").sortWithinPartitions("contig", "pos").withColumn("_at", F.monotonically_increasing_id()))
    # What each range adds up to and where it begins; the last event of one is followed by the first of the next.
    told = {r[0]: (r[1], r[2]) for r in own.groupBy(F.shiftright("_at", 33)).agg(F.sum("delta"), F.min_by("pos", "_at")).collect()}
    starts, before = {}, 0
    for k, after in zip(sorted(told), [*sorted(told)[1:], None], strict=False):
        starts[k] = (before, 0 if after is None else told[after][1])
        before += told[k][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (contig, pos, depth) of the last event so far
        depth = behind = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            pos, delta = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            if held is None:
                depth, behind = starts[batch.column(3)[0].as_py() >> 33]
            elif held[2] > 0:
                yield given(held[0], held[1], pos[:1] - 1, np.array([held[2]]))
            total = depth + np.cumsum(delta)
            depth = int(total[-1])
            yield given(batch.column(0).filter(pa.array(np.append(total[:-1] > 0, False))), pos[:-1][total[:-1] > 0], pos[1:][total[:-1] > 0] - 1, total[:-1][total[:-1] > 0])
            held = (batch.column(0).slice(batch.num_rows - 1), pos[-1:], depth)
        if held is not None and held[2] > 0:
            yield given(held[0], held[1], np.array([behind - 1]), np.array([held[2]]))

    def given(contig: pa.Array, start: np.ndarray, end: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([contig, pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(depth, pa.int64())], names=["contig", "start", "end", "depth"])

    kind = dict(own.dtypes)["contig"]
    return own.select("contig", "pos", "delta", "_at").mapInArrow(run, f"contig {kind}, start long, end long, depth long")


_KINDS = ("a", "c", "g", "t", "n", "deleted", "inserted")
_CODE = np.full(256, 4, dtype=np.int64)  # any other letter is n
for _i, _c in enumerate("acgt"):
    _CODE[[ord(_c), ord(_c.upper())]] = _i


def _letters(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes of all letters, number of letters of each row)."""
    text = text.fill_null("")
    offs = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[offs[0] : offs[-1]]
    first = (raw & 0xC0) != 0x80
    total = np.concatenate([[0], np.cumsum(first)])
    return raw[first], np.diff(total[offs - offs[0]])


def _counted(pieces: DataFrame, min_base_quality: int, bin_size: int) -> DataFrame:
    """(contig, pos, counts, ref): pieces (contig, _b, at, text, q, what) counted by position, in one pass over rows sorted by bin.

    what is 0 for bases, 1 for the reference, 5 and 6 for text whose letters are deleted positions and insertions.
    A task holds the counts of one bin besides a batch, however deep the bin is.
    """
    kind = dict(pieces.dtypes)["contig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (contig, bin, positions, counts, references) of the bin that may go on

        def given(names: pa.Array, bins: np.ndarray, group: np.ndarray, at: np.ndarray, counts: np.ndarray, ref: np.ndarray) -> pa.RecordBatch:
            seen = counts.any(axis=1)
            group, at, counts, ref = group[seen], at[seen], counts[seen], ref[seen]
            letters = pa.array([chr(x) if x else None for x in range(256)], pa.string()).take(pa.array(ref))
            return pa.RecordBatch.from_arrays([names.take(pa.array(group)), pa.array(bins[group] * bin_size + at + 1), *[pa.array(counts[:, j]) for j in range(7)], letters], names=["contig", "pos", *_KINDS, "ref"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names, bins = batch.column(0), batch.column(1).to_numpy()
            start, what = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            codes = names.dictionary_encode().indices.to_numpy()
            new = np.append(True, (codes[1:] != codes[:-1]) | (bins[1:] != bins[:-1]))
            group, heads = np.cumsum(new) - 1, np.flatnonzero(new)
            raw, size = _letters(batch.column(3))
            row = np.repeat(np.arange(len(size)), size)
            pos = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            use = np.ones(len(row), dtype=bool)
            if min_base_quality > 0 and batch.column(4).null_count < batch.num_rows:
                q, qn = _letters(batch.column(4))
                known = batch.column(4).is_valid().to_numpy(zero_copy_only=False) & (qn == size) & (what == 0)
                use[known[row]] = q[known[np.repeat(np.arange(len(qn)), qn)]].astype(np.int64) - 33 >= min_base_quality
            key, code = group[row] * bin_size + pos, np.where(what[row] == 0, _CODE[raw], what[row])
            isref = what[row] == 1
            # Positions in order, with those of the bin that the last batch left open.
            goes_on = held is not None and held[0] == names[0] and held[1] == bins[0]
            if held is not None and not goes_on:
                yield given(pa.array([held[0].as_py()], names.type), np.array([held[1]]), np.zeros(len(held[2]), np.int64), held[2], held[3], held[4])
            places, index = np.unique(np.concatenate([key, held[2]]) if goes_on else key, return_inverse=True)
            own = index[: len(key)]
            counting = use & ~isref
            counts = np.bincount(own[counting] * 7 + code[counting], minlength=len(places) * 7).reshape(-1, 7)
            ref = np.zeros(len(places), dtype=np.int64)
            ref[own[isref]] = raw[isref]
            if goes_on:
                counts[index[len(key) :]] += held[3]
                before = index[len(key) :]
                ref[before] = np.where(ref[before] == 0, held[4], ref[before])
            of, at = places // bin_size, places % bin_size
            last = np.searchsorted(of, group[-1])
            if last:
                yield given(names.take(pa.array(heads)), bins[heads], of[:last], at[:last], counts[:last], ref[:last])
            held = (names[-1], bins[-1], at[last:], counts[last:], ref[last:])
        if held is not None:
            yield given(pa.array([held[0].as_py()], held[0].type), np.array([held[1]]), np.zeros(len(held[2]), np.int64), held[2], held[3], held[4])

    dealt = pieces.select("contig", "_b", "at", "text", "q", "what").repartition("contig", "_b").sortWithinPartitions("contig", "_b")
    counted = dealt.mapInArrow(run, f"contig {kind}, pos long, {', '.join(k + ' long' for k in _KINDS)}, ref string")
    return counted.select("contig", "pos", sum((F.col(k) for k in _KINDS[1:5]), F.col("a")).alias("depth"), *_KINDS, "ref")


def _pieces(alignments: DataFrame, min_mapq: int, bin_size: int) -> DataFrame:
    """What alignments say of their positions, cut at the borders of bins: one row a block and bin."""
    length = (F.col("end") - F.col("start") + 1).cast("int")
    along = aligned_blocks(alignments, min_mapq, ALIGNED + "DI")
    base = F.instr(F.lit(ALIGNED), F.col("op")) > 0
    piece = lambda text: F.substring(text, F.col("read") + 1, length)
    q = F.when(base & (F.length(piece("qual")) == F.length(piece("seq"))), piece("qual"))  # shorter than its block: missing
    start = F.when(F.col("op") == "I", F.col("start") - 2).otherwise(F.col("start") - 1)
    own = along.select("contig", start.alias("s"), F.when(base, piece("seq")).when(F.col("op") == "D", F.repeat(F.lit("-"), length)).otherwise(F.lit("+")).alias("text"), q.alias("q"), F.when(base, 0).when(F.col("op") == "D", 5).otherwise(6).alias("what")).filter("(what != 6 or s >= 0) and length(text) > 0")
    last = F.col("s") + F.length("text") - 1
    cut = own.withColumn("_b", F.explode(F.sequence(F.floor(F.col("s") / bin_size), F.floor(last / bin_size))))
    low = F.greatest(F.col("s"), F.col("_b") * bin_size)
    inside = lambda c: F.substring(c, (low - F.col("s") + 1).cast("int"), ((F.col("_b") + 1) * bin_size - low).cast("int"))
    return cut.select("contig", "_b", (low - F.col("_b") * bin_size).alias("at"), inside("text").alias("text"), inside("q").alias("q"), "what")


def base_counts(alignments: DataFrame, min_mapq: int = 0, min_base_quality: int = 0, bin_size: int = 4096) -> DataFrame:
    """(contig, pos, depth, a, c, g, t, n, deleted, inserted) of each position that an alignment covers.

    Bases below the least quality (Phred + 33) aren't counted; without qualities all are.
    inserted counts insertions behind the position.  Blocks are sent, not their bases.
    """
    return _counted(_pieces(alignments, min_mapq, bin_size), min_base_quality, bin_size).drop("ref")


def alignment_calls(alignments: DataFrame, reference: DataFrame, min_mapq: int = 0, min_base_quality: int = 0, bin_size: int = 4096) -> DataFrame:
    """pileup_calls() of the counts of alignments at positions with a base: the reference's pieces (one row a contig) meet the alignments', so counts are sent nowhere."""
    from ..functions.seq import windows

    piece = windows(reference.select("contig", "seq"), "seq", bin_size).select("contig", F.col("piece_no").cast("long").alias("_b"), F.lit(0).cast("long").alias("at"), F.upper("piece").alias("text"), F.lit(None).cast("string").alias("q"), F.lit(1).alias("what"))
    met = _counted(_pieces(alignments, min_mapq, bin_size).unionByName(piece), min_base_quality, bin_size)
    return _called(met.filter("ref is not null and depth > 0"))


def _called(at: DataFrame) -> DataFrame:
    others = F.filter(F.array(*[F.struct(F.col(x.lower()).alias("n"), (-F.ascii(F.lit(x))).alias("order"), F.lit(x).alias("base")) for x in "ACGT"]), lambda x: (x["base"] != F.col("ref")) & (x["n"] > 0))
    top = F.array_max(others)
    return at.select("contig", "pos", "ref", F.coalesce(top["base"], F.lit(".")).alias("alt"), "depth", F.when(F.col("depth") > 0, F.coalesce(top["n"], F.lit(0)) / F.col("depth")).otherwise(0.0).alias("freq"))


def pileup_calls(counts: DataFrame, reference: DataFrame, block: int = 4096) -> DataFrame:
    """Counts against a reference (contig, seq): (contig, pos, ref, alt, depth, freq).

    alt is the most frequent base beside the reference's (of ties the least, . if there is none),
    freq its share of the depth.  Positions beyond the reference are left out.
    """
    from ..functions.seq import windows

    piece = windows(reference.select("contig", "seq"), "seq", block).select("contig", F.col("piece_no").cast("long").alias("_b"), F.col("piece").alias("_s"))
    at = counts.withColumn("_b", F.floor((F.col("pos") - 1) / block)).join(piece, ["contig", "_b"])
    ref = F.upper(F.substring("_s", (F.col("pos") - F.col("_b") * block).cast("int"), F.lit(1)))
    at = at.withColumn("ref", ref).filter("ref != ''")
    return _called(at)


def in_region_order(rows: DataFrame, regions: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Rows (contig, pos, ...) with the number of their region (region, contig, start, end), sorted by region and position.

    Regions are numbers in the order wanted; ranges of regions are partitions, so files written
    from the result, taken in order, are the regions' results one after another.
    """
    named = regions.select(F.col("contig").alias("_contig"), "region", F.col("start").alias("_start"), F.col("end").alias("_end"))
    own = interval_join(rows, named.withColumnRenamed("_contig", "contig"), "contig", "pos", "_start", "_end", bin_size).drop("_start", "_end")
    return own.repartitionByRange("region", "pos").sortWithinPartitions("region", "pos")
