"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its documents.
The whole part of that number is taken as it is.  The fractions are rounded dependently:
documents of one source meet in pairs, and words move at random from one to the other, with
the total kept, until one of the two has a whole number of copies; the other goes on to the
next pair.  Each document keeps its expected number of copies, and a source's total stays at
its target up to one document.

The reduction is a tree: (source, bucket) groups of about GROUP documents each leave one
undecided document, FAN of these groups meet in the next level, and so on to one per source,
which is rounded at random.  Groups are fixed by hashes of ids and random numbers by a seed
and the group, so that reruns agree; no group grows with a source.

Cases: a null or empty text has size 0, is taken once and adds nothing; a null source is a
source of its own, last in order; repeated rows, and rows without an id, are numbered and
mixed as rows of their own, so that no group grows with them; no rows give no rows; further
columns are ignored.  Sources are a table, however many there are: their order and sums are
worked out by Spark jobs, and the driver sees one total a round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io

GROUP, FAN, FEW_SOURCES = 2_000, 64, 10_000  # FEW_SOURCES: so many sources, counted, are broadcast
REPEATS = 1 << 16  # equal rows that one task numbers

_SIZES = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64())])


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the words of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            _, _, first = B.word_bounds(data, offs, B.NOT_SPACE)
            yield _io.batch(_SIZES, rows.column("doc_id"), rows.column("source"), np.diff(first))

    return _io.keyed(docs, "doc_id", "source", "text").select(F.col("doc_id").cast("long"), F.col("source").cast("string"), _io.utf8_binary()).mapInArrow(run, _io.ddl(_SIZES))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """sizes (source, source_size, ...) with target: all words shared by weight, none above most times its size, the excess reshared by weight.

    The share of a unit of weight only grows as full sources drop out, so each round is one
    aggregation of the sources that are over it.
    """
    ranked = _io.running(sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"], None, "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = _io.cut(ranked.drop("_last").withColumn("_weight", weight).drop("_rank"))
    share, seen = 0.0, -1
    while True:
        full = F.lit(share) * F.col("_weight") > F.lit(float(most)) * F.col("source_size")
        n, total, held, open_ = ranked.agg(F.count_if(full), F.sum("source_size"), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if n == seen or not open_:
            break
        share, seen = (total - most * (held or 0)) / open_, n
    full = F.lit(share) * F.col("_weight") > F.lit(float(most)) * F.col("source_size")
    return ranked.withColumn("target", F.when(full, F.lit(float(most)) * F.col("source_size")).otherwise(F.lit(share) * F.col("_weight"))).drop("_weight")


def pivot(size: np.ndarray, part: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Move words between pairs until at most one fraction is left: (fractions, its index or -1)."""
    p, held = part.astype(float).copy(), -1
    draws = rng.random(len(p))
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b, wa, wb = held, i, float(size[held]), float(size[i])
        up = min((1.0 - p[a]) * wa, p[b] * wb)  # words that can go from b to a
        down = min(p[a] * wa, (1.0 - p[b]) * wb)
        move = up if draws[i] * (up + down) < down else -down
        for j, words, w in ((a, move, wa), (b, -move, wb)):
            p[j] += words / w
            if p[j] < 1e-9:
                p[j] = 0.0
            elif p[j] > 1.0 - 1e-9:
                p[j] = 1.0
        held = a if 0.0 < p[a] < 1.0 else b if 0.0 < p[b] < 1.0 else -1
    return p, held


_STATE = "doc_id long, missing boolean, no long, source string, size long, whole int, part double, bucket long, done boolean"


def _level(rows: DataFrame, seed: int, level: int, last: bool) -> DataFrame:
    """One level of the tree: each group's fractions become whole but for one, or all at the last level."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "missing", "doc_id", "no"], kind="stable", ignore_index=True)
        name = f"{seed}/{level}/{group['source'].iloc[0]!r}/{group['bucket'].iloc[0]}"
        rng = np.random.Generator(np.random.PCG64([seed, level, zlib.crc32(name.encode()), len(name)]))
        part, held = pivot(group["size"].to_numpy(), group["part"].to_numpy(), rng)
        if held >= 0 and last:
            part[held] = float(rng.random() < part[held])
        group["part"] = part
        group["done"] = True
        if held >= 0 and not last:
            group.loc[held, "done"] = False
        return group[["doc_id", "missing", "no", "source", "size", "whole", "part", "bucket", "done"]]

    return rows.groupBy("source", "bucket").applyInPandas(run, _STATE)


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 1, group: int = GROUP, fan: int = FAN) -> DataFrame:
    """doc_id, no (of rows that are equal in doc_id, source and size), source, size, source_size, target, copies and taken (copies * size) of every row."""
    sizes = _io.cut(word_sizes(docs))
    # Rows that are equal in all that counts here are interchangeable: they are numbered, so that groups can tell them apart.
    again = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("_n"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / REPEATS)))
    many = again.filter("_n > 1").withColumn("_b", block).repartition("doc_id", "source", "size", "_b")
    many = many.withColumn("no", F.explode(F.sequence(F.col("_b") * REPEATS, F.least(F.col("_n"), (F.col("_b") + 1) * REPEATS) - 1))).drop("_b")
    sizes = _io.cut(many.unionByName(again.filter("_n = 1").withColumn("no", F.lit(0).cast("long"))).drop("_n"))
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    known = targets(per_source, weights, most).withColumn("buckets", F.greatest(F.ceil(F.col("_n") / group), F.lit(1))).withColumnRenamed("source", "_of").drop("_n")
    known = _io.counted(known, FEW_SOURCES)
    largest = known.agg(F.max("buckets")).first()[0] or 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    rows = rows.withColumn("rate", F.when(F.col("size") > 0, F.least(rate, F.lit(float(most)))).otherwise(F.lit(1.0)))
    rows = rows.withColumn("whole", F.floor(F.col("rate") + 1e-12).cast("int")).withColumn("part", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "no", F.lit(seed)), F.col("buckets")))
    # Pandas would read a column of ids with nulls as floats.
    state = rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("missing"), "no", "source", "size", "whole", "part", "bucket", F.lit(False).alias("done"))
    done, level = [state.filter("part <= 0 or size = 0").withColumn("done", F.lit(True))], 0
    live, most_buckets = state.filter("part > 0 and size > 0"), int(largest)
    while True:
        last = most_buckets == 1
        ran = _io.cut(_level(live, seed, level, last))
        done.append(ran.filter("done"))
        if last:
            break
        live = ran.filter("not done").withColumn("bucket", F.expr(f"bucket div {fan}L"))
        most_buckets, level = -(-most_buckets // fan), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("whole") + F.col("part").cast("int")).cast("long")
    out = out.join(known, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    return out.select(F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "no", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _words(text: Column) -> Column:
    """The number of words, as word_sizes counts them: each becomes one letter, all else goes."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.regexp_replace(marked, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def take_copies(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 1) -> DataFrame:
    """The rows of docs, with all their columns, each as often as the mix takes it.

    Rows that share id (or lack one), source and size are numbered, in the order of a hash of
    their text, as the mix numbers them, so that each row takes the copies of one place.
    """
    mixed = _io.cut(mix_documents(docs, weights, most, seed))
    named = {n: F.col(f"`{n}`") if n in docs.columns else F.lit(None) for n in ("doc_id", "source", "text")}
    rows = docs.select(F.struct("*").alias("_row"), named["doc_id"].cast("long").alias("_id"), named["source"].cast("string").alias("_source"), named["text"].cast("string").alias("_text"))
    places = mixed.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("no").alias("_no"), F.col("copies").alias("_copies"))
    again = _io.counted(places.filter("_id is not null").groupBy("_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("_id"))

    def taken(own: DataFrame, of: DataFrame, on: list[str]) -> DataFrame:
        """Rows with the copies of their place; most places have one copy, and only the others are looked up."""
        return _matched(own, _io.counted(of.filter("_copies != 1").select(*on, "_copies")), on, "left")

    # An id that stands once is enough to know a row by.
    once = places.filter("_id is not null").join(again, "_id", "left_anti")
    known = taken(rows.filter("_id is not null").join(again, "_id", "left_anti"), once, ["_id"]).select("_row", "_copies")
    others = places.join(again, "_id", "left_semi").unionByName(places.filter("_id is null"))
    key = ["_id", "_source", "_size"]
    # Equal rows are many keys of the range sort, by a draw; made where rows are read, a repeated task repeats it.
    drawn = rows.withColumn("_draw", F.rand(seed))
    rest = drawn.filter("_id is null").unionByName(drawn.join(again, "_id", "left_semi").select(*drawn.columns))
    rest = rest.select("_row", "_id", "_source", _words(F.col("_text")).alias("_size"), F.xxhash64("_text").alias("_hash"), "_draw")
    placed = _io.running(rest, [*key, "_hash", "_draw"], None, "_pos")
    first = _io.counted(placed.groupBy(*key).agg(F.min("_pos").alias("_first")))
    numbered = _matched(placed, first, key, "inner").withColumn("_no", F.col("_pos") - F.col("_first"))
    numbered = taken(numbered, others, [*key, "_no"]).select("_row", "_copies")
    out = known.unionByName(numbered).filter("_copies is null or _copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)).cast("int")))).select("_row.*")


def _matched(own: DataFrame, other: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join on columns where null equals null; on one column it is a plain one."""
    if len(on) == 1:
        return own.join(other, on, how)
    other = other.select(*[F.col(k).alias(f"{k}2") if k in on else F.col(k) for k in other.columns])
    test = F.lit(True)
    for k in on:
        test &= F.col(k).eqNullSafe(F.col(f"{k}2"))
    return own.join(other, test, how).drop(*[f"{k}2" for k in on])
