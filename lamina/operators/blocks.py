"""Sequences in blocks of like size, kept once in the shared folder; pairs of blocks are read from there by the tasks that compare them.

Nodes are (digest, seq, size).  They are sorted by size and packed, a row a block, so that
the work on all pairs of like size needs no more disk than the packed sequences: the join of
blocks is a product of partitions, which reads them and writes nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut

_BLOCK = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("first", pa.string()), ("names", pa.binary()), ("data", pa.binary())])


def pack(texts: list[str]) -> bytes:
    """Texts with their lengths in bytes, compressed."""
    raw = [x.encode("utf-8", "surrogatepass") for x in texts]
    return zlib.compress(np.array([len(raw), *map(len, raw)], dtype="<i8").tobytes() + b"".join(raw), 1)


def unpack(data: bytes) -> list[str]:
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw, dtype="<i8", count=1)[0])
    ends = np.cumsum(np.append(8 * (n + 1), np.frombuffer(raw, dtype="<i8", count=n, offset=8))).tolist()
    return [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def sized_blocks(nodes: DataFrame, letters: int = 1 << 23, rows: int = 1 << 14) -> DataFrame:
    """(lo, hi, first, names, data): blocks in the order of (size, digest), a row each, materialised; a block has no more rows than told, and no more letters unless it is one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        seqs: list[str] = []
        sizes: list[int] = []
        held = 0

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([sizes[0]], pa.int64()), pa.array([sizes[-1]], pa.int64()), pa.array([names[0]]), pa.array([pack(names)], pa.binary()), pa.array([pack(seqs)], pa.binary())], schema=_BLOCK)

        for batch in batches:
            for name, seq, size in zip(*(batch.column(c).to_pylist() for c in ("digest", "seq", "size")), strict=True):
                if names and (held + len(seq) > letters or len(names) >= rows):
                    yield given()
                    names, seqs, sizes, held = [], [], [], 0
                names.append(name)
                seqs.append(seq)
                sizes.append(size)
                held += len(seq)
        if names:
            yield given()

    # As many ranges as blocks, about: a range's last block may be small.
    whole = nodes.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)), F.count("*")).first()
    parts = int(max(1, whole[0] / letters, whole[1] / rows) + 1)
    spread = nodes.select("digest", "seq", F.col("size").cast("long").alias("size")).repartitionByRange(parts, "size", "digest").sortWithinPartitions("size", "digest")
    return cut(spread.mapInArrow(run, "lo long, hi long, first string, names binary, data binary"))


def compare_blocks(blocks: DataFrame, share: float, compare: Callable[[list[str], list[str] | None], list[tuple[int, int]]], most: int = 128) -> DataFrame:
    """(a, b): what compare finds between every two blocks, and in each, whose sizes come as near as share; materialised.

    compare gets the sequences of a block and those of a later one (None: the block itself)
    and gives pairs of positions, (one, two), counted from 0 in each.
    """
    parts = max(1, min(most, blocks.count()))
    own = blocks.repartition(parts)
    left, right = (own.select(*[F.col(c).alias(f"{c}_{k}") for c in own.columns]) for k in "lr")
    later = F.struct("lo_l", "first_l") <= F.struct(F.col("lo_r").alias("lo_l"), F.col("first_r").alias("first_l"))
    same = (F.col("lo_l") == F.col("lo_r")) & (F.col("first_l") == F.col("first_r"))
    pairs = left.hint("shuffle_replicate_nl").join(right, later & (F.col("hi_l") >= F.lit(share) * F.col("lo_r")))
    pairs = pairs.select("names_l", "data_l", F.when(~same, F.col("names_r")).alias("names_r"), F.when(~same, F.col("data_r")).alias("data_r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                nl, dl, nr, dr = (batch.column(c)[i].as_py() for c in range(4))
                found = compare(unpack(dl), None if dr is None else unpack(dr))
                if found:
                    one = unpack(nl)
                    two = one if nr is None else unpack(nr)
                    yield pa.RecordBatch.from_arrays([pa.array([one[x] for x, _ in found]), pa.array([two[y] for _, y in found])], names=["a", "b"])

    return cut(pairs.mapInArrow(run, "a string, b string"))
