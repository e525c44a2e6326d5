"""Benchmark decontamination with a distributed positional inverted index.

build_index stores, for every segment of the training documents (whole texts, about a
megabyte), the sorted positions of each token.  search intersects the lists of a window's
tokens after subtracting each token's offset in the window, from the rarest token on: its
list gives the candidate starts, and each further list removes the ones it doesn't hold.
With slop 0 that is the exact phrase; with more, a token may stand up to slop words from its
place (proximity).

The index is split by documents, so a token that a third of all documents hold is spread
over all segments, and a search moves no postings.  Distinct windows are numbered and reach
the workers in blocks of BLOCK; more windows mean more passes over the stored index, whose
hits are merged for each document.  Which items hold a window is joined afterwards, so that a
phrase of very many items is one window in the search.

Cases: words are [0-9A-Za-z and all non-ASCII]+ with A-Z lower-cased; a null or empty text has
no words and isn't contaminated; an item of fewer words than a window is one window, one
without words none; items that share a window are all reported; the windows of items without
an id are hit as all others, and such items count together as one item without a name
(unnamed); repeated rows are reported each; an empty benchmark hits nothing; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io

WINDOW, BLOCK = 10, 200_000
GAP = 64  # free positions between two documents: no phrase or proximity match reaches over them
_CANDIDATES = 1 << 20

_INDEX = pa.schema([("segment", pa.int64()), ("doc_ids", pa.binary()), ("known", pa.binary()), ("keys", pa.binary()), ("n_words", pa.binary()), ("terms", pa.binary()), ("first", pa.binary()), ("positions", pa.binary())])
_WINDOWS = pa.schema([("item_id", pa.int64()), ("terms", pa.binary())])
_HITS = pa.schema([("segment", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("windows", pa.list_(pa.int64()))])


def item_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id") -> DataFrame:
    """(item_id, terms): the distinct windows of each item, a null id included, terms as 64-bit hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            words, first = B.word_hashes(data, offs, B.ALNUM, lower=True)
            ids, out_id, out = rows.column("item_id"), [], []
            for r in range(rows.num_rows):
                own = words[first[r] : first[r + 1]]
                for k in range(max(1, len(own) - window + 1)) if len(own) else ():
                    out_id.append(ids[r].as_py())
                    out.append(own[k : k + window].tobytes())
            yield _io.batch(_WINDOWS, out_id, out)

    narrow = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), _io.utf8_binary())
    return narrow.mapInArrow(run, _io.ddl(_WINDOWS)).distinct()


class Windows:
    """A block of distinct windows: their numbers, lengths, and a matrix of terms."""

    def __init__(self, rows: list[tuple[int, bytes]], window: int):
        self.number = np.array([n for n, _ in rows], dtype=np.int64)
        self.size = np.array([len(k) // 8 for _, k in rows], dtype=np.int64)
        self.terms = np.zeros((len(rows), window), dtype=np.uint64)
        for i, (_, k) in enumerate(rows):
            self.terms[i, : len(k) // 8] = np.frombuffer(k, dtype=np.uint64)


def build_index(docs: DataFrame, segment: int = B.CHUNK, id_col: str = "doc_id") -> DataFrame:
    """One row for each segment: its documents, and the positions of every token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for rows, data, offs in B.chunks(batches, "text", segment):
            words, first = B.word_hashes(data, offs, B.ALNUM, lower=True)
            order = np.argsort(words, kind="stable")
            words = words[order]
            begin = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
            at = (order + GAP * B.rows_of(first)[order]).astype(np.int32 if len(words) + GAP * rows.num_rows < 2**31 else np.int64)
            ids = rows.column("doc_id")
            yield _io.batch(_INDEX, [number], [np.asarray(ids.fill_null(0)).astype(np.int64).tobytes()], [np.asarray(ids.is_valid().cast("int8")).tobytes()], [rows.column("key").to_numpy().tobytes()], [np.diff(first).tobytes()], [words[begin].tobytes()], [np.append(begin, len(words)).astype(np.int64).tobytes()], [at.tobytes()])
            number += 1

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), _io.utf8_binary()).mapInArrow(run, _io.ddl(_INDEX))


def intersect(terms: np.ndarray, first: np.ndarray, positions: np.ndarray, windows: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all matches in a segment."""
    width = windows.terms.shape[1]
    none = np.zeros(0, np.int64)
    if not len(terms) or not len(windows.size):
        return none, none
    term = np.minimum(np.searchsorted(terms, windows.terms), len(terms) - 1)
    used = np.arange(width)[None, :] < windows.size[:, None]
    length = np.where(terms[term] == windows.terms, np.diff(first)[term], 0)
    length = np.where(used, length, np.iinfo(np.int64).max)
    live = np.flatnonzero(length.min(axis=1) > 0)
    if not len(live):
        return none, none
    order = np.argsort(length[live], axis=1, kind="stable")  # rarest first; places that a short window lacks come last
    rarest = order[:, 0]
    held = term[live, rarest]
    count = first[held + 1] - first[held]
    span = int(positions.max()) + 2 * GAP + 2 if len(positions) else 1
    key = np.repeat(np.arange(len(terms)), np.diff(first)) * span + positions + GAP
    out_w, out_s, total, a = [], [], np.cumsum(count), 0
    while a < len(live):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _CANDIDATES, side="right")))
        which = np.repeat(np.arange(a, b), count[a:b])
        start = positions[B.spread(first[held[a:b]], count[a:b])] - rarest[which]
        for k in range(1, width):
            if not len(which):
                break
            place = order[which, k]
            need = place < windows.size[live[which]]
            want = term[live[which], place] * span + start + place + GAP
            if slop:
                fits = np.searchsorted(key, want + slop, side="right") > np.searchsorted(key, want - slop)
            else:
                fits = key[np.minimum(np.searchsorted(key, want), len(key) - 1)] == want
            ok = fits | ~need
            which, start = which[ok], start[ok]
        out_w.append(live[which])
        out_s.append(start)
        a = b
    return np.concatenate(out_w), np.concatenate(out_s)


def search(index: DataFrame, windows: Windows, slop: int = 0, all_rows: bool = True) -> DataFrame:
    """Documents of the index (all, or those with a hit) with their hit spans (word numbers, begin and end in turn, disjoint) and the numbers of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                cell = lambda n, kind, r=r, batch=batch: np.frombuffer(batch.column(n)[r].as_buffer(), dtype=kind)
                ids, known, n_words, first = cell("doc_ids", np.int64), cell("known", np.int8), cell("n_words", np.int64), cell("first", np.int64)
                positions = cell("positions", np.int32 if batch.column("positions")[r].as_buffer().size == 4 * first[-1] else np.int64).astype(np.int64)
                base = np.cumsum(n_words + GAP) - n_words - GAP
                w, start = intersect(cell("terms", np.uint64), first, positions, windows, slop)
                order = np.lexsort((windows.size[w], start))
                w, start = w[order], start[order]
                doc = np.searchsorted(base, np.maximum(start, 0), side="right") - 1
                # A proximity match may begin before its document's first word.
                begin, end = np.maximum(start, base[doc]), np.minimum(start + windows.size[w], base[doc] + n_words[doc])
                reach = np.maximum.accumulate(end) if len(end) else end
                head = np.ones(len(w), dtype=bool)
                head[1:] = (begin[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(head)
                last = np.append(at[1:], len(w)) - 1 if len(w) else at
                of = doc[at]
                pairs = np.column_stack([begin[at] - base[of], reach[last] - base[of]]).ravel() if len(at) else np.zeros(0, np.int64)
                both = np.unique(np.column_stack([doc, windows.number[w]]), axis=0) if len(w) else np.zeros((0, 2), np.int64)
                out = np.arange(len(ids)) if all_rows else np.unique(doc)
                limits = np.append(2 * np.searchsorted(of, out), 2 * len(of))
                cuts = np.append(np.searchsorted(both[:, 0], out), len(both))
                yield _io.batch(
                    _HITS, np.full(len(out), batch.column("segment")[r].as_py()), out, pa.array(ids[out], mask=known[out] == 0), cell("keys", np.int64)[out], n_words[out],
                    pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(pairs, pa.int64())), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(both[:, 1], pa.int64())),
                )

    return index.mapInArrow(run, _io.ddl(_HITS))


def _merged(spans: Column) -> Column:
    """Disjoint spans from begins and ends in turn of several passes over one document."""
    halves = F.sequence(F.lit(0), F.floor(F.size(spans) / 2).cast("int") - 1)
    pairs = F.array_sort(F.transform(halves, lambda i: F.struct(F.get(spans, 2 * i).alias("b"), F.get(spans, 2 * i + 1).alias("e"))))
    joined = F.aggregate(pairs, F.array().cast("array<long>"), lambda done, p: F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1) >= p["b"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.greatest(F.get(done, F.size(done) - 1), p["e"])))).otherwise(F.concat(done, F.array(p["b"], p["e"]))))
    return F.when(F.size(spans) > 0, joined).otherwise(spans)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, block: int = BLOCK) -> DataFrame:
    """segment, row, doc_id, key (of the text), n_words, spans, items and unnamed (whether items without an id are hit) of every row of docs."""
    if not 0 < window + slop < GAP:
        raise ValueError(f"window and slop together must stay under {GAP}")
    of_items = _io.cut(item_windows(benchmark, window))
    numbered = _io.running(of_items.select("terms").distinct(), ["terms"])
    n = numbered.count()
    index, found = _io.cut(build_index(docs)), None
    for low in range(0, max(n, 1), block):
        own = [(r["pos"], bytes(r["terms"])) for r in numbered.filter(F.col("pos").between(low, low + block - 1)).collect()]  # at most block rows
        hits = search(index, Windows(own, window), slop, all_rows=found is None)
        found = hits if found is None else found.unionByName(hits)
    if n > block:
        found = found.groupBy("segment", "row").agg(F.first("doc_id").alias("doc_id"), F.first("key").alias("key"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("windows")).alias("windows")).withColumn("spans", _merged(F.col("spans")))
    found = _io.cut(found)
    # Documents with a hit meet the items of their windows.
    pairs = found.filter(F.size("windows") > 0).select("segment", "row", F.explode("windows").alias("pos")).join(_io.counted(numbered.join(of_items, "terms").select("pos", "item_id")), "pos").select("segment", "row", "item_id").distinct()
    named = _io.counted(pairs.groupBy("segment", "row").agg(F.array_sort(F.collect_list("item_id")).alias("items"), F.bool_or(F.col("item_id").isNull()).alias("unnamed")))
    none = F.array().cast("array<long>")
    return found.drop("windows").join(named, ["segment", "row"], "left").withColumn("items", F.coalesce("items", none)).withColumn("unnamed", F.coalesce("unnamed", F.lit(False)))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, with all their columns, that hold no window of the benchmark.

    A row is known by its id and its text, so that rows without an id or with a repeated one are judged each.
    """
    hit = _io.counted(find_contamination(docs, benchmark, window).filter(F.size("spans") > 0).select(F.col("doc_id").alias("_hit"), F.col("key").alias("_key")).distinct())
    same = F.col("_row.doc_id").eqNullSafe(F.col("_hit")) & (F.xxhash64("_row.text") == F.col("_key"))
    return docs.select(F.struct("*").alias("_row")).join(hit, same, "left_anti").select("_row.*")
