"""Removal of repeated byte strings by bucket-pointer refinement.

Every LENGTH-byte string of every text that also starts earlier (smaller id, or same text and
earlier start) is covered for removal.  The suffixes that matter are sorted only as far as
LENGTH bytes, and only where a bucket can hold more than one:

1. Initial buckets are q-grams.  A string's bucket is that of its q-gram with the least hash
   (the leftmost of them), so equal strings share bucket and offset, and neighbouring strings
   share one occurrence, an anchor, which owns a run of strings.
2. Anchors of a bucket whose whole runs have equal bytes refine it at once: all but the
   earliest are repeats.  Buckets with one run are finished, and most are of this kind.
3. What is left is refined by sorting: the bytes of the runs are put in buckets of 8-grams,
   and a bucket of n bytes is refined to 2n by sorting on the bucket identifiers at offset n,
   and so on, each round using the identifiers of the one before, up to LENGTH.
4. A q-gram bucket with more than HOT different runs (about a megabyte) isn't sorted in one
   task: its strings go one by one to an aggregation that combines before the shuffle and
   tells each string's earliest place in every document.

A run's bytes are compared through two 64-bit hashes that are independent of each other and
of the q-gram's, which its bucket has in common already.

Cases: a null or empty text has no bytes, and one under LENGTH bytes loses nothing; texts are
bytes, so a cut may fall inside a character; a null id comes after all others; rows that
repeat an id (or have none) with different texts are documents of their own, and none of them
is earlier than another; rows that repeat both are judged once and returned each; no rows give
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io

LENGTH, Q, HOT = 100, 24, 8192
GROUP_BYTES = 2 << 20
_LAST = (1 << 63) - 1

# A document is its id and, among rows that repeat an id, a number of its text (sub, 0 for all others).
_ANCHOR = pa.schema([("h", pa.int64()), ("run", pa.int64()), ("guard", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("meta", pa.int64())])
_MESSAGE = pa.schema([("doc", pa.int64()), ("sub", pa.int64()), ("meta", pa.int64()), ("h", pa.int64())])
_RUN = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("meta", pa.int64()), ("bytes", pa.binary())])
_STRING = pa.schema([("h", pa.int64()), ("string", pa.int64()), ("guard", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("start", pa.int64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

# A run of strings: start << 27 | count << 7 | offset of the anchor in the first string.  Offset 127 marks a known repeat.
_REPEAT, _MOST = 127, (1 << 20) - 1


def pack(start: np.ndarray, count: np.ndarray, offset: np.ndarray | int) -> np.ndarray:
    return (start << 27) | (count << 7) | offset


def unpack(meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return meta >> 27, (meta >> 7) & _MOST, meta & 127


def anchors(data: np.ndarray, offs: np.ndarray, length: int, q: int) -> tuple[np.ndarray, ...]:
    """(row, start, count, offset, q-gram hash, run hash, another run hash) of every anchor, start counted in the chunk; q is a multiple of 8."""
    n, w = len(data), length - q + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return (none,) * 7
    view = B.lanes(data)
    lane = B.mix(view[:n] * B._MIX[21])
    gram = lane[: n + 1 - q] * B._MIX[22]
    for k in range(8, q, 8):
        gram += lane[k : n + 1 - q + k] * B._MIX[22 + k // 8]
    del lane
    low, size = gram, 1
    while 2 * size <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[: len(low) - (w - size)], low[w - size :])
    # low[s] is the least hash of the string at s; strings that reach over a row's end don't count.
    room = np.diff(offs)
    rows = np.flatnonzero(room >= length)
    s = B.spread(offs[:-1][rows], room[rows] - length + 1)
    if not len(s):
        return (none,) * 7
    head = np.ones(len(s), dtype=bool)
    head[1:] = s[1:] != s[:-1] + 1
    before = np.maximum(s - 1, 0)
    enters = gram[s + w - 1] < low[before]
    change = np.flatnonzero(head | enters | (gram[before] == low[before]))
    at, fresh = s[change], (enters & ~head)[change]
    place = at + w - 1
    look = np.flatnonzero(~fresh)
    for a in range(0, len(look), 20_000):
        part = at[look[a : a + 20_000]]
        place[look[a : a + 20_000]] = part + (gram[part[:, None] + np.arange(w)] == low[part][:, None]).argmax(axis=1)
    count = np.diff(np.append(change, len(s)))
    # A run never goes over a row: every row's first string is a change.
    offset = place - at
    shape = offset.astype(np.uint64) * B._MIX[3] + count.astype(np.uint64) * B._MIX[4]
    whole, guard = (B.mix(B.span_hash(view, at, at + count - 1 + length, seed) ^ shape) for seed in (0, 1))
    return np.searchsorted(offs, at, side="right") - 1, at, count, offset, B.signed(gram[place]), B.signed(whole), B.signed(guard)


def repeats(group: list[np.ndarray], doc: np.ndarray, sub: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, again) of places in the order of group, doc, sub, start: heads of groups, and what starts earlier as well.

    A place is again if a smaller id has the string, or the same document at an earlier start.
    """
    first = np.ones(len(doc), dtype=bool)
    if len(doc):
        first[1:] = np.any([g[1:] != g[:-1] for g in group], axis=0)
    lead = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
    own = first.copy()  # the document's first place in the group
    own[1:] |= (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])
    top = np.maximum.accumulate(np.where(own, np.arange(len(doc)), 0))
    return first, (doc != doc[lead]) | (start != start[top])


def _merged(doc: np.ndarray, sub: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts that touch, as one run each."""
    by = np.lexsort((start, sub, doc))
    doc, sub, start, count = doc[by], sub[by], start[by], count[by]
    cut = np.ones(len(doc), dtype=bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (start[1:] > start[:-1] + count[:-1])
    heads = np.flatnonzero(cut)
    stops = np.maximum.reduceat(start + count, heads) if len(heads) else start
    return doc[heads], sub[heads], start[heads], stops - start[heads]


def anchor_rows(docs: DataFrame, length: int, q: int) -> DataFrame:
    """Anchors, but for those that repeat an earlier one of the same slice: these are known repeats, merged to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            ids, subs = rows.column("doc").to_numpy(), rows.column("sub").to_numpy()
            row, at, count, offset, h, whole, guard = anchors(data, offs, length, q)
            start = at - offs[:-1][row]
            order = np.lexsort((start, subs[row], ids[row], guard, whole, h))
            h, whole, guard, start, count, offset = h[order], whole[order], guard[order], start[order], count[order], offset[order]
            doc, sub = ids[row][order], subs[row][order]
            _, again = repeats([h, whole, guard], doc, sub, start)
            d, u, s, c = _merged(doc[again], sub[again], start[again], count[again])
            pieces = -(-c // _MOST)
            part = B.spread(np.zeros(len(c), np.int64), pieces)
            d, u, s, c = np.repeat(d, pieces), np.repeat(u, pieces), np.repeat(s, pieces) + part * _MOST, np.minimum(np.repeat(c, pieces) - part * _MOST, _MOST)
            key = B.signed(B.mix(d.astype(np.uint64) * B._MIX[5] + u.astype(np.uint64) * B._MIX[6] + s.astype(np.uint64)))
            own, none = ~again, np.zeros(len(d), np.int64)
            both = ((h[own], key), (whole[own], none), (guard[own], none), (doc[own], d), (sub[own], u), (pack(start[own], count[own], offset[own]), pack(s, c, _REPEAT)))
            yield _io.batch(_ANCHOR, *(np.concatenate(x) for x in both))

    return docs.mapInArrow(run, _io.ddl(_ANCHOR))


def split_buckets(rows: DataFrame) -> DataFrame:
    """Known repeats, and the runs that are left to be refined.

    In buckets of several runs these are the first of each run, and of documents of one id,
    which don't stand before each other, the first in each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in the order of bucket, run, place.  Held are the open run's first place, of all and of the document,
        # and the first row of a bucket's first run until a second run comes.
        last, alone = None, None
        for batch in batches:
            h, whole, guard, doc, sub, meta = (batch.column(i).to_numpy() for i in range(6))
            known = (meta & 127) == _REPEAT
            out = [(doc[known], sub[known], meta[known], np.zeros(int(known.sum()), np.int64))]
            h, whole, guard, doc, sub, meta = (x[~known] for x in (h, whole, guard, doc, sub, meta))
            if len(h):
                start, count, _ = unpack(meta)
                new_h, new_run, new_own = (np.ones(len(h), dtype=bool) for _ in range(3))
                new_h[1:] = h[1:] != h[:-1]
                new_run[1:] = new_h[1:] | (whole[1:] != whole[:-1]) | (guard[1:] != guard[:-1])
                new_own[1:] = new_run[1:] | (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])
                if last is not None:
                    new_h[0] = h[0] != last[0]
                    new_run[0] = bool(new_h[0]) or (whole[0], guard[0]) != last[1:3]
                    new_own[0] = bool(new_run[0]) or (doc[0], sub[0]) != last[4:6]
                here = np.arange(len(h))
                lead, top = (np.maximum.accumulate(np.where(x, here, -1)) for x in (new_run, new_own))
                lead_doc = np.where(lead >= 0, doc[lead], last[3] if last else 0)
                top_start = np.where(top >= 0, start[top], last[6] if last else 0)
                again = (doc != lead_doc) | (start != top_start)
                out.append((doc[again], sub[again], pack(start[again], count[again], _REPEAT), np.zeros(int(again.sum()), np.int64)))
                f = np.flatnonzero(new_run)
                if len(f):
                    if alone is not None and not new_h[f[0]]:
                        out.append(tuple(np.array([x]) for x in alone))
                    ask = ~new_h[f]
                    ask[:-1] |= ~new_h[f[1:]]
                    g, i = f[ask], f[-1]
                    alone = (int(doc[i]), int(sub[i]), int(meta[i]), int(h[i])) if new_h[i] else None
                    out.append((doc[g], sub[g], meta[g], h[g]))
                g = np.flatnonzero(new_own & ~new_run & ~again)
                out.append((doc[g], sub[g], meta[g], h[g]))
                last = (int(h[-1]), int(whole[-1]), int(guard[-1]), int(lead_doc[-1]), int(doc[-1]), int(sub[-1]), int(top_start[-1]))
            yield _io.batch(_MESSAGE, *(np.concatenate(x) for x in zip(*out, strict=True)))

    return rows.repartition("h").sortWithinPartitions("h", "run", "guard", "doc", "sub", "meta").mapInArrow(run, _io.ddl(_MESSAGE))


class Texts:
    """A group's documents in the order of id and sub."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc", "ascending"), ("sub", "ascending")])
        self.doc, self.sub = table.column("doc").to_numpy(), table.column("sub").to_numpy()
        self.data, self.offs = B.column_bytes(table.column("text"))
        self.table = table

    def rows(self, doc: np.ndarray, sub: np.ndarray) -> np.ndarray:
        """The row of each document asked for."""
        if not self.sub.any():
            return np.searchsorted(self.doc, doc)
        n = len(self.doc)
        rank = np.unique(np.stack([np.concatenate([self.doc, doc]), np.concatenate([self.sub, sub])]), axis=1, return_inverse=True)[1].ravel()
        return np.searchsorted(rank[:n], rank[n:])


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def run_bytes(left: pa.Table, right: pa.Table) -> pa.Table:
    """The bytes of each asked run."""
    if not left.num_rows or not right.num_rows:
        return _RUN.empty_table()
    texts = Texts(left)
    doc, sub, meta = _columns(right, "doc", "sub", "meta")
    start, count, _ = unpack(meta)
    size = count + LENGTH - 1
    at = texts.offs[texts.rows(doc, sub)] + start
    limits = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    blob = np.ascontiguousarray(texts.data[B.spread(at, size)])
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(limits), pa.py_buffer(blob)])
    return pa.Table.from_arrays([*(right.column(n).combine_chunks() for n in ("h", "doc", "sub", "meta")), packed], schema=_RUN)


def run_strings(left: pa.Table, right: pa.Table) -> pa.Table:
    """The strings of each asked run by their hashes, of equal ones in the group only those that nothing there stands before."""
    if not left.num_rows or not right.num_rows:
        return _STRING.empty_table()
    texts = Texts(left)
    h, doc, sub, meta = _columns(right, "h", "doc", "sub", "meta")
    start, count, _ = unpack(meta)
    at = B.spread(texts.offs[texts.rows(doc, sub)] + start, count)
    view = B.lanes(texts.data)
    value, guard = (B.signed(B.span_hash(view, at, at + LENGTH, seed)) for seed in (0, 1))
    h, doc, sub, where = np.repeat(h, count), np.repeat(doc, count), np.repeat(sub, count), B.spread(start, count)
    order = np.lexsort((where, sub, doc, guard, value, h))
    h, value, guard, doc, sub, where = (x[order] for x in (h, value, guard, doc, sub, where))
    keep = ~repeats([h, value, guard], doc, sub, where)[1]
    return pa.Table.from_arrays([pa.array(x[keep]) for x in (h, value, guard, doc, sub, where)], schema=_STRING)


def refine(data: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Bucket identifiers of the length-byte strings at every position with room for them; -1 elsewhere.

    Buckets of 8-grams come first, in byte order; sorting on the pair of a position's own
    identifier and the one at the bucket's depth further on doubles the depth, and a last pair
    that overlaps makes it length.
    """
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    first = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | wide[k : k + n]
    depth = 8
    at = np.flatnonzero(room >= depth)
    rank = np.full(n, -1, dtype=np.int64)
    rank[at] = np.unique(first[at], return_inverse=True)[1]
    while depth < length:
        step = min(depth, length - depth)
        at = np.flatnonzero(room >= depth + step)
        pair = (rank[at].astype(np.uint64) << np.uint64(32)) | rank[at + step].astype(np.uint64)
        rank = np.full(n, -1, dtype=np.int64)
        rank[at] = np.unique(pair, return_inverse=True)[1]
        depth += step
    return rank


def refine_runs(rows: DataFrame) -> DataFrame:
    """Known repeats among the strings of the runs of each bucket."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        h, doc, sub, meta = _columns(rows, "h", "doc", "sub", "meta")
        data, offs = B.column_bytes(rows.column("bytes"))
        room = np.repeat(offs[1:], np.diff(offs)) - np.arange(len(data))
        rank = refine(data, room, LENGTH)
        start, count, _ = unpack(meta)
        of = np.repeat(np.arange(len(h)), count)
        where = B.spread(start, count)
        value = rank[B.spread(offs[:-1], count)]
        # Equal strings of a bucket have equal offsets of the anchor, so that rank and bucket name a class.
        order = np.lexsort((where, sub[of], doc[of], value, h[of]))
        of, where, value = of[order], where[order], value[order]
        again = repeats([value, h[of]], doc[of], sub[of], where)[1]
        d, u, s, c = _merged(doc[of[again]], sub[of[again]], where[again], np.ones(int(again.sum()), np.int64))
        return _io.batch(_MESSAGE, d, u, pack(s, c, _REPEAT), np.zeros(len(d), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of the bucket that is still open, at most HOT
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rows = part if held is None else pa.concat_tables([held, part])
            h = rows.column("h").to_numpy()
            whole = int(np.searchsorted(h, h[-1])) if len(h) else 0
            held = rows.slice(whole)
            if whole:
                yield solve(rows.slice(0, whole))
        if held is not None and held.num_rows:
            yield solve(held)

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, _io.ddl(_MESSAGE))


def covered(texts: Texts, doc: np.ndarray, sub: np.ndarray, meta: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Which bytes of a group's texts are covered.  kind 0: repeats; 1: runs that repeat but for kept strings; 2: kept strings."""
    n = int(texts.offs[-1])
    starts = np.zeros(n + 1, dtype=bool)
    for k in (1, 2, 0):
        pick = kind == k
        s, c, _ = unpack(meta[pick])
        starts[B.spread(texts.offs[texts.rows(doc[pick], sub[pick])] + s, c)] = k != 2
    total = np.zeros(n + 2, dtype=np.int64)
    np.cumsum(starts[: n + 1], out=total[1:])
    upto = np.arange(1, n + 1)
    return total[upto] > total[np.maximum(upto - LENGTH, 0)]


def cut_group(left: pa.Table, right: pa.Table) -> tuple[Texts, np.ndarray]:
    texts = Texts(left)
    return texts, covered(texts, *_columns(right, "doc", "sub", "meta", "kind"))


def _each(texts: Texts, names: list[str], *columns) -> pa.Table:
    """The result rows: each document's id and columns as often as it stands in the input."""
    ids = pa.array(texts.doc, mask=texts.table.column("missing").to_numpy(zero_copy_only=False))
    out = pa.table([ids, *columns], names=["doc_id", *names])
    return out.take(pa.array(np.repeat(np.arange(len(texts.doc)), texts.table.column("n").to_numpy())))


def digest_group(left: pa.Table, right: pa.Table) -> pa.Table:
    """The result rows of a group of texts."""
    if not left.num_rows:
        return _RESULT.empty_table()
    texts, gone = cut_group(left, right)
    data, offs = texts.data, texts.offs
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[offs[1:]] - total[offs[:-1]]
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    inner = offs[:-1][np.diff(offs) > 0]
    head[inner] = gone[inner]
    heads = np.concatenate([[0], np.cumsum(head)])
    out = []
    for a, b, r in zip(offs[:-1].tolist(), offs[1:].tolist(), removed.tolist(), strict=True):
        text = data[a:b] if not r else data[a:b][~gone[a:b]]
        out.append(hashlib.sha256(np.ascontiguousarray(text)).hexdigest())
    return _each(texts, _RESULT.names[1:], pa.array(np.diff(offs)), pa.array(removed), pa.array(heads[offs[1:]] - heads[offs[:-1]]), pa.array(out))


def documents(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(doc, sub, missing, n, text), and whether ids repeat or are null.

    Rows whose id no other row has are taken as they are.  Of the others, equal texts of one id
    are one document that counts n times, and sub tells its different texts apart.
    """
    given = _io.keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    zero, doc = F.lit(0).cast("long"), F.coalesce("doc_id", F.lit(_LAST)).alias("doc")
    repeated = _io.cut(given.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("_of")))
    if repeated.isEmpty():
        return given.select(doc, zero.alias("sub"), F.lit(False).alias("missing"), F.lit(1).cast("long").alias("n"), "text"), False
    repeated = _io.counted(repeated.filter("_of is not null"))
    known, same = given.filter("doc_id is not null"), F.col("doc_id") == F.col("_of")
    others = known.join(repeated, same, "left_semi").unionByName(given.filter("doc_id is null"))
    others = _io.cut(others.groupBy("doc_id", F.xxhash64(F.sha2("text", 256)).alias("sub")).agg(F.count("*").alias("n"), F.any_value("text").alias("text")))
    plain = known.join(repeated, same, "left_anti").select(doc, zero.alias("sub"), F.lit(False).alias("missing"), F.lit(1).cast("long").alias("n"), "text")
    return plain.unionByName(others.select(doc, "sub", F.col("doc_id").isNull().alias("missing"), "n", "text")), True


def _repeats(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """(texts in groups, messages for each group with their kind)."""
    spark = docs.sparkSession
    texts, several = documents(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    group = F.pmod(F.xxhash64("doc", "sub"), F.lit(groups)).alias("group")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = texts.select(group, "doc", "sub", "missing", "n", "text").repartition(parts, "group")

    found = _io.cut(split_buckets(anchor_rows(texts.select("doc", "sub", "text"), LENGTH, Q)))
    known = F.col("meta").bitwiseAND(F.lit(127)) == _REPEAT
    asked = found.filter(~known)
    crowded = _io.cut(asked.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("h"))
    some = not crowded.isEmpty()
    few = asked.join(crowded, "h", "left_anti") if some else asked
    by_group = lambda df: df.select(group, *df.columns)
    both = lambda df, f, schema: placed.groupBy("group").cogroup(by_group(df).groupBy("group")).applyInArrow(f, _io.ddl(schema))
    messages = found.filter(known).unionByName(refine_runs(both(few, run_bytes, _RUN))).select("doc", "sub", "meta", F.lit(0).alias("kind"))
    if some:
        many = asked.join(crowded, "h", "left_semi")
        strings = both(many, run_strings, _STRING)
        kept = strings.groupBy("h", "string", "guard").agg(F.min(F.struct("doc", "sub", "start")).alias("first"))
        if several:  # all documents of the least id keep their first
            least = kept.select("h", "string", "guard", F.col("first.doc").alias("doc"))
            kept = strings.groupBy("h", "string", "guard", "doc", "sub").agg(F.min("start").alias("start")).join(least, ["h", "string", "guard", "doc"]).select(F.struct("doc", "sub", "start").alias("first"))
        kept = kept.select(F.col("first.doc").alias("doc"), F.col("first.sub").alias("sub"), F.shiftleft("first.start", 27).bitwiseOR(F.lit(1 << 7).cast("long")).alias("meta"), F.lit(2).alias("kind"))
        messages = messages.unionByName(many.select("doc", "sub", "meta", F.lit(1).alias("kind"))).unionByName(kept)
    return placed, by_group(messages)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    placed, messages = _repeats(docs, hot)
    return placed.groupBy("group").cogroup(messages.groupBy("group")).applyInArrow(digest_group, _io.ddl(_RESULT))


def kept_texts(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id and kept, the remaining bytes of every row."""
    placed, messages = _repeats(docs, hot)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.schema([("doc_id", pa.int64()), ("kept", pa.binary())]).empty_table()
        texts, gone = cut_group(left, right)
        return _each(texts, ["kept"], pa.array([texts.data[a:b][~gone[a:b]].tobytes() for a, b in zip(texts.offs[:-1], texts.offs[1:], strict=True)], pa.binary()))

    return placed.groupBy("group").cogroup(messages.groupBy("group")).applyInArrow(run, "doc_id long, kept binary")
