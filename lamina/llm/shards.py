"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to a few bits each; the index of a row's cell on
the Hilbert curve is the sort key, so that rows that are near on the curve are near in all
dimensions, and a shard's files have narrow minima and maxima in each.  The order is cut
into runs of rows, at most one apart in count (law 'rows').

A categorical dimension is quantised by the rank of its value among all values, weighted by
rows: the values are counted, their running total is taken over sorted ranges, and the steps
are joined as a table, however many values there are.  A number is quantised by the bit
length of its value.  Ties on the curve are ordered by the text's
checksum, so that equal texts stand together, then by id.

Cases: nulls are a value of their own, before all others; a null text has no bytes; no rows
give no shards' rows; repeated rows each get a slot; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _io

def hilbert_index(coords: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of cells in len(coords) dimensions of 2**bits steps.

    Gray-code walk: from the top bit on, each dimension's set bit mirrors the lower bits of
    the first, an unset one exchanges them; the transposed bits are then Gray-decoded.
    """
    x = [np.asarray(c, dtype=np.int64).copy() for c in coords]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(n):
            on = (x[d] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[0]
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            out = (out << 1) | (((x[d] ^ flip) >> level) & 1)
    return out


def rank_steps(df: DataFrame, column: str, bits: int) -> DataFrame:
    """(_value, step): each value's rank among all values of the column, nulls first, weighted by rows, in 2**bits steps."""
    counts = df.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("n"))
    placed = _io.running(counts.withColumn("known", F.col("_value").isNotNull()), ["known", "_value"], "n", "before")
    total = placed.agg(F.sum("n").alias("total"))
    step = F.expr(f"((before + n div 2) * {1 << bits}L) div total")
    return placed.crossJoin(F.broadcast(total)).select("_value", step.alias("step"))  # one row


def with_rank(rows: DataFrame, of: DataFrame, column: str, bits: int, name: str) -> DataFrame:
    """rows with the step of their value among those of the frame of."""
    steps = _io.counted(rank_steps(of, column, bits).withColumnRenamed("step", name))
    return rows.join(steps, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def hilbert_order(rows: DataFrame, dims: dict[str, Column], bits: int) -> DataFrame:
    """rows with a column h, the index of the row's cell; dims are columns of steps below 2**bits."""

    @F.pandas_udf("long")
    def index(steps: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index([steps[c].to_numpy() for c in steps.columns], bits))

    return rows.withColumn("h", index(F.struct(*[c.cast("long").alias(f"d{i}") for i, c in enumerate(dims.values())])))


def cut_runs(rows: DataFrame, order: list[str], shards: int) -> DataFrame:
    """rows with shard, slot and pos: the order is cut into shards runs, at most one apart in count."""
    out = _io.running(rows, order)
    total = max(out.count(), 1)
    shard = F.expr(f"(pos * {shards}L) div {total}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return out.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("pos") - first)


def write_shards(placed: DataFrame, path: str) -> None:
    """Files of each shard in the order of its slots, one folder a shard.

    A file's minima and maxima of every dimension are narrow, as its rows are near on the
    curve, so that readers that filter by any of them skip most files.
    """
    placed.repartitionByRange(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def size_step(column: str, bits: int) -> Column:
    """Bit length of a number, up to 2**bits - 1."""
    return F.least(F.length(F.bin(F.coalesce(F.col(column), F.lit(0)).cast("long"))), F.lit((1 << bits) - 1)).cast("long")


def shard_documents(docs: DataFrame, shards: int = 24, bits: int = 5, keep: list[str] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, lang, source, h, shard, slot and the columns in keep (or none) of every row.

    keep holds whole rows, text included, through the sort; without it only narrow rows are sorted.
    """
    d = _io.keyed(docs, *dict.fromkeys(["doc_id", "text", "lang", "source", *(keep or [])]))
    bytes_ = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    kept = [c for c in (keep or []) if c not in ("doc_id", "lang", "source")]
    narrow = d.select("doc_id", "lang", "source", *kept, (F.octet_length(bytes_).cast("long") + 8).alias("_size"), F.crc32(bytes_).alias("_crc"), F.xxhash64(bytes_).alias("_hash"))
    if not keep:
        narrow = _io.cut(narrow)
    of = docs if keep else narrow
    for column in ("source", "lang"):
        narrow = with_rank(narrow, _io.keyed(of, column), column, bits, f"_{column}_step")
    dims = {"source": F.col("_source_step"), "lang": F.col("_lang_step"), "size": size_step("_size", bits)}
    placed = hilbert_order(narrow, dims, bits).drop("_source_step", "_lang_step")
    group = ["_hash", "_crc", "_size"]
    groups = _io.counted(placed.select("h", *group).groupBy(*group).agg(F.min("h").alias("_least"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"))
    placed = placed.join(groups, group, "left").withColumn("h", F.coalesce("_least", "h")).drop("_least")
    # Rows that are equal in all of the order's columns are interchangeable.
    return cut_runs(placed, ["h", "_hash", "_crc", "doc_id"], shards).drop("_hash")
