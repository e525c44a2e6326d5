"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct five-word shingles; documents link when the Jaccard
similarity of their sets is at least 4/5, compared exactly in whole numbers.

Equal sets are one node, named by a 64-bit fingerprint that a second one guards.  A node's
tokens are put in one global order, rare ones first: frequent tokens, whose counts over all
documents are gathered from the tasks that see them often, come last, by count.  Two nodes
of n and m tokens that link share at least a = ceil(4(n + m)/9) tokens, and so at least l of
the first n - a + l and m - a + l in the order, for any l up to a.  Each node chooses its own
l: the higher the estimated number of candidates that its prefix tokens bring, the longer its
prefix, and the more shared prefix tokens a pair needs (the lesser of its two l).

Classes need no pair that is joined already.  So each prefix token first links its nodes to
one pivot, the node in which the token comes earliest; what this leaves apart is then paired
across classes only, counted, and verified on the whole sets.  Nodes meet at a token and two
classes of sizes, their own and their partner's, each time only with the shorter prefix that
partners of that size leave.  Nodes that such a place of more than DENSE nodes ties together
are compared in blocks by matrix products instead, again only with sizes that can link, so
that a dense set of near misses makes no rows of pairs.  Every link between nodes of different
classes is found in the second step, so that the classes are exact.

Cases: words are [^ \\t-\\r]+ with A-Z lower-cased; with fewer than five words the whole sequence
is one shingle; a null or empty text has no shingles and a class of its own; repeated rows are
in one class; a row without an id links with nothing and has no component; rows that repeat an
id with other texts each follow their own text; no rows give no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io
from .components import components

WORDS = 5
LOCAL_MIN, TOTAL_MIN = 2, 8  # a token counts as frequent from so many documents of one task, and of all such tasks, on
FREQUENT = 1_000_000  # at most so many frequent tokens, the most frequent first, are broadcast (16 MB)
FOLD, KNOWN = 2_000_000, 1 << 16  # tokens that a task counts at once, and nodes that it remembers as written
MAX_L, COST_STEP = 4, 128
BLOCK_NODES = 64
DENSE = 64  # a token and sizes of more nodes make their nodes a dense set
DENSE_BLOCK, DENSE_TOKENS = 1024, 1_000_000  # a block of a dense set has about so many nodes and tokens at most
RATIO, REACH = 1.12, 2  # sizes of a class differ by less than RATIO; linked nodes are at most REACH classes apart

_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("guard", pa.int64())])
_COUNTS = pa.schema([("token", pa.int64()), ("count", pa.int64())])
_PREFIX = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("meta", pa.int64())])
_MULTI = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("meta", pa.int64()), ("pivot", pa.int64()), ("pivot_meta", pa.int64())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first): each row's distinct shingles, ascending."""
    words, first = B.word_hashes(data, offs, B.NOT_SPACE, lower=True)
    grams, rows = B.ngrams(words, first, WORDS, short=True)
    return B.distinct(grams, rows, len(offs) - 1)


def fingerprints(tokens: np.ndarray, first: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row's set."""
    n = np.diff(first).astype(np.uint64)
    out = []
    for k in (0, 1):
        total = np.zeros(len(tokens) + 1, dtype=np.uint64)
        np.cumsum(B.mix(tokens + B._MIX[2 * k] * np.uint64(2 * seed + 1)), out=total[1:])
        out.append(B.signed(B.mix((total[first[1:]] - total[first[:-1]]) ^ (n * B._MIX[2 * k + 1]))))
    return out[0], out[1]


def document_sets(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, n, node and guard of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            tokens, first = shingle_sets(data, offs)
            yield _io.batch(_SETS, rows.column("doc_id"), np.diff(first), *fingerprints(tokens, first, seed))

    return docs.mapInArrow(run, _io.ddl(_SETS))


def frequent_tokens(docs: DataFrame) -> DataFrame:
    """(token, n): tokens that tasks see in LOCAL_MIN documents or more, with the counts of those tasks, from TOTAL_MIN on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = [], 0

        def fold() -> pa.RecordBatch:
            tokens, many = np.unique(np.concatenate(pending), return_counts=True)
            often = many >= LOCAL_MIN
            return _io.batch(_COUNTS, B.signed(tokens[often]), many[often])

        for _, data, offs in B.chunks(batches, "text"):
            tokens, _ = shingle_sets(data, offs)
            pending.append(tokens)
            held += len(tokens)
            if held > FOLD:
                yield fold()
                pending, held = [], 0
        if pending:
            yield fold()

    return docs.mapInArrow(run, _io.ddl(_COUNTS)).groupBy("token").agg(F.sum("count").alias("n")).filter(F.col("n") >= TOTAL_MIN)


class Order:
    """The frequent tokens with their counts; every other token comes before them."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.counts = tokens[by], counts[by]

    def count(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)

    def prefixes(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(index, row, place, l) of the prefix tokens of every row."""
        size, rows, count = np.diff(first), B.rows_of(first), self.count(tokens)
        rare = count == 0
        before = np.concatenate([[0], np.cumsum(rare)])
        place = before[:-1] - before[first[rows]]
        often = np.flatnonzero(~rare)
        if len(often):
            by = often[np.lexsort((tokens[often], count[often], rows[often]))]
            of = rows[by]
            start = np.searchsorted(of, of)
            place[by] = (before[first[1:]] - before[first[:-1]])[of] + np.arange(len(by)) - start
        need = (4 * size + 4) // 5
        cost = np.bincount(rows, weights=np.where(place <= (size - need)[rows], count, 0), minlength=len(size))
        more = np.log2(1 + cost / COST_STEP).astype(np.int64)
        l = np.maximum(1, np.minimum(1 + np.minimum(more, MAX_L - 1), need))
        index = np.flatnonzero(place < (size - need + l)[rows])
        return index, rows[index], place[index], l[rows[index]]


def prefix_rows(docs: DataFrame, order: Order, seed: int) -> DataFrame:
    """(token, node, meta): each node's prefix once a task; meta packs place, n and l, so that it sorts by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, np.int64)
        for _, data, offs in B.chunks(batches, "text"):
            tokens, first = shingle_sets(data, offs)
            node, _ = fingerprints(tokens, first, seed)
            _, one = np.unique(node, return_index=True)
            one = one[(np.diff(first)[one] > 0) & ~np.isin(node[one], known)]
            known = np.concatenate([known, node[one]])[-KNOWN:]  # later repeats are removed where tokens meet
            one.sort()
            size = np.diff(first)[one]
            own = tokens[B.spread(first[one], size)]
            of = node[one]
            begin = np.concatenate([[0], np.cumsum(size)])
            index, rows, place, l = order.prefixes(own, begin)
            meta = (place << 36) | (size[rows] << 4) | l
            yield _io.batch(_PREFIX, B.signed(own[index]), of[rows], meta)

    return docs.mapInArrow(run, _io.ddl(_PREFIX))


def shared_tokens(prefixes: DataFrame) -> DataFrame:
    """The prefix rows whose token another node has too, each with the token's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in the order of token, meta, node.  Of a bucket that goes on only the pivot and the last row are held.
        held, pivot, joined = np.zeros((3, 0), np.int64), None, False
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(i).to_numpy() for i in range(3)])], axis=1)
            if rows.shape[1] < 2:
                held = rows
                continue
            new = np.ones(rows.shape[1], dtype=bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
            rows = rows[:, new]
            token = rows[0]
            head = np.ones(len(token), dtype=bool)
            head[1:] = token[1:] != token[:-1]
            goes_on = pivot is not None and token[0] == pivot[0]
            at = np.maximum.accumulate(np.where(head, np.arange(len(token)), 0))
            p_node, p_meta = rows[1][at], rows[2][at]
            if goes_on:
                p_node[at == 0], p_meta[at == 0] = pivot[1], pivot[2]
            multi = ~head
            multi[:-1] |= ~head[1:]
            if goes_on and joined:
                multi[0] = True
            out = multi.copy()
            out[-1] = False
            yield _io.batch(_MULTI, token[out], rows[1][out], rows[2][out], p_node[out], p_meta[out])
            held, joined = rows[:, -1:], bool(multi[-1])
            pivot = (int(token[-1]), int(p_node[-1]), int(p_meta[-1]))
        if held.shape[1] and joined:
            yield _io.batch(_MULTI, held[0], held[1], held[2], np.array([pivot[1]]), np.array([pivot[2]]))

    return prefixes.repartition("token").sortWithinPartitions("token", "meta", "node").mapInArrow(run, _io.ddl(_MULTI))


def _place(meta: str) -> Column:
    return F.shiftright(meta, 36)


def _size(meta: str) -> Column:
    return F.shiftright(meta, 4).bitwiseAND(F.lit((1 << 32) - 1))


def _l(meta: str) -> Column:
    return F.col(meta).bitwiseAND(F.lit(15))


def may_link(a: str, b: str, l: Column) -> Column:
    """Whether nodes of these sizes can link, with the token at these places within both prefixes."""
    n, m = _size(a), _size(b)
    need = F.floor((4 * (n + m) + 8) / 9)
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (_place(a) < n - need + l) & (_place(b) < m - need + l)


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, seed: int) -> DataFrame:
    """Those of the pairs (a, b) that link, by their whole sets.

    Nodes that share a least partner are cut into blocks of about BLOCK_NODES.  The pairs of two
    blocks meet in one group, to which each of their texts comes once: a dense set of m nodes
    sends m times m / BLOCK_NODES texts, not one for each pair, and no group grows with m.
    """
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    near = ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("near"))
    size = near.groupBy("near").agg(F.ceil(F.count("*") / BLOCK_NODES).alias("blocks"))
    block = near.join(size, "near").select("node", F.xxhash64("near", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block"))
    named = block.join(classes.select("node", "first_id"), "node")
    keyed = pairs.select("a", "b").join(named.select(F.col("node").alias("a"), F.col("block").alias("p"), F.col("first_id").alias("ia")), "a").join(named.select(F.col("node").alias("b"), F.col("block").alias("q"), F.col("first_id").alias("ib")), "b")
    keyed = _io.cut(keyed.withColumn("key", F.xxhash64(F.least("p", "q"), F.greatest("p", "q"))))
    asked = _io.counted(keyed.select("key", F.col("a").alias("node"), F.col("ia").alias("_id")).unionByName(keyed.select("key", F.col("b").alias("node"), F.col("ib").alias("_id"))).distinct())
    rows = docs.join(asked, F.col("doc_id") == F.col("_id")).select("key", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    rows = rows.unionByName(keyed.select("key", "a", "b", F.lit(None).cast("binary").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A group's texts come before its pairs; only the sets of the open group are held.
        open_key, sets = None, {}
        for part, data, offs in B.chunks(batches, "text"):
            tokens, first = shingle_sets(data, offs)
            node, _ = fingerprints(tokens, first, seed)
            out: list[tuple[int, int]] = []
            for i, (key, a, b) in enumerate(zip(*(part.column(n).to_pylist() for n in ("key", "a", "b")), strict=True)):
                if key != open_key:
                    open_key, sets = key, {}
                if b is None:
                    if node[i] == a:
                        sets[a] = tokens[first[i] : first[i + 1]].copy()
                elif a in sets and b in sets:
                    x, y = sets[a], sets[b]
                    shared = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    if 100 * shared >= 80 * (len(x) + len(y) - shared):
                        out.append((a, b))
            yield _io.batch(_PAIRS, [x for x, _ in out], [x for _, x in out])

    return rows.repartition("key").sortWithinPartitions("key", "b", "a").mapInArrow(run, _io.ddl(_PAIRS)).distinct()


def block_links(own: list[tuple[int, int, np.ndarray]], split: int, columns: int = 1 << 11) -> list[tuple[int, int]]:
    """Links between the first split and the other of (node, root, set), or among all if split is their number; roots differ.

    Shared tokens are counted by products of 0/1 matrices over slices of the vocabulary.
    """
    size = np.array([len(t) for _, _, t in own], dtype=np.float64)
    who = np.repeat(np.arange(len(own)), size.astype(np.int64))
    tokens = np.concatenate([t for _, _, t in own]) if own else np.zeros(0, np.uint64)
    order = np.argsort(tokens, kind="stable")
    tokens, who = tokens[order], who[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = tokens[1:] != tokens[:-1]
    number = np.cumsum(new) - 1
    often = np.bincount(number) > 1
    held = often[number]
    number, who = (np.cumsum(often) - 1)[number[held]], who[held]
    left = slice(0, split)
    right = slice(split, None) if split < len(own) else left
    shared = np.zeros((split, len(own) - split if split < len(own) else split))
    for at in range(0, int(often.sum()), columns):
        part = slice(*np.searchsorted(number, [at, at + columns]))
        marks = np.zeros((len(own), columns), dtype=np.float32)
        marks[who[part], number[part] - at] = 1
        shared += marks[left] @ marks[right].T
    root = np.array([r for _, r, _ in own])
    ok = (100 * shared >= 80 * (size[left][:, None] + size[right][None, :] - shared)) & (root[left][:, None] != root[right][None, :])
    base = split if split < len(own) else 0
    return [(own[i][0], own[base + j][0]) for i, j in zip(*np.nonzero(ok), strict=True) if base or i < j]


def size_class(n: Column) -> Column:
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / float(np.log(RATIO))).cast("long")


def _least_size(c: Column) -> Column:
    """A number that no size of the class is below."""
    return F.floor(F.pow(F.lit(RATIO), c) * (1 - 1e-9))


def by_size(placed: DataFrame) -> DataFrame:
    """The rows of placed (token, node, meta, ...) once for each class of sizes that a partner can have.

    small and apart name the two classes (apart: how many classes between them), large tells which side the node is on.
    """
    own = placed.withColumn("_n", _size("meta")).withColumn("_c", size_class(F.col("_n"))).withColumn("_e", F.explode(F.sequence(F.lit(-REACH).cast("long"), F.lit(REACH).cast("long"))))
    least = F.greatest(_least_size(F.col("_c") + F.col("_e")), F.ceil(F.col("_n") * 4 / 5), F.when(F.col("_e") > 0, F.col("_n")))
    most = F.pow(F.lit(RATIO), F.col("_c") + F.col("_e") + 1) * (1 + 1e-9)
    need = F.floor((4 * (F.col("_n") + least) + 8) / 9)
    fits = (4 * least <= 5 * F.col("_n")) & (most >= least) & (_place("meta") < F.col("_n") - need + _l("meta"))
    return own.filter(fits).select(*placed.columns, (F.col("_c") + F.least("_e", F.lit(0))).alias("small"), F.abs("_e").alias("apart"), (F.col("_e") < 0).alias("large"))


def verify_dense(members: DataFrame, docs: DataFrame, seed: int) -> DataFrame:
    """Links between the nodes (node, root, n, first_id) of each dense set, by pairs of blocks whose sizes can link; no pair is a row unless it links."""
    # A set that fits one block is one; a larger one is cut by sizes, so that sizes that can't link don't meet.
    whole = members.groupBy("dense").agg(((F.count("*") <= DENSE_BLOCK) & (F.sum("n") <= DENSE_TOKENS)).alias("one"))
    m = members.join(whole, "dense").withColumn("c", F.when(F.col("one"), F.lit(0).cast("long")).otherwise(size_class(F.col("n")))).drop("one")
    size = m.groupBy("dense", "c").agg(F.ceil(F.greatest(F.count("*") / DENSE_BLOCK, F.sum("n") / DENSE_TOKENS)).alias("blocks"))
    near = size.withColumn("d", F.explode(F.sequence(F.col("c") - REACH, F.col("c") + REACH)))
    near = near.join(size.select("dense", F.col("c").alias("d"), F.col("blocks").alias("others")), ["dense", "d"])
    m = m.join(near, ["dense", "c"]).withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")))
    m = m.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    own, other = F.struct(F.col("c").alias("c"), F.col("i").alias("i")), F.struct(F.col("d").alias("c"), F.col("j").alias("i"))
    asked = _io.counted(m.select(F.col("first_id").alias("_id"), "node", "root", F.xxhash64("dense", F.least(own, other), F.greatest(own, other)).alias("key"), F.when(own <= other, 0).otherwise(1).alias("side")))
    rows = docs.join(asked, F.col("doc_id") == F.col("_id")).select("key", "side", "node", "root", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"key": None, "own": [], "seen": set(), "split": 0}

        def solve() -> list[tuple[int, int]]:
            own, split = state["own"], state["split"]
            return block_links(own, split) if len(own) > 1 and split else []

        for part, data, offs in B.chunks(batches, "text"):
            tokens, first = shingle_sets(data, offs)
            node, _ = fingerprints(tokens, first, seed)
            out: list[tuple[int, int]] = []
            for i, (key, right, name, root) in enumerate(zip(*(part.column(n).to_pylist() for n in ("key", "side", "node", "root")), strict=True)):
                if key != state["key"]:
                    out += solve()
                    state.update(key=key, own=[], seen=set(), split=0)
                if node[i] == name and name not in state["seen"]:
                    state["seen"].add(name)
                    state["own"].append((name, root, tokens[first[i] : first[i + 1]].copy()))
                    state["split"] += not right
            yield _io.batch(_PAIRS, [x for x, _ in out], [x for _, x in out])
        out = solve()
        yield _io.batch(_PAIRS, [x for x, _ in out], [x for _, x in out])

    return rows.repartition("key").sortWithinPartitions("key", "side", "node").mapInArrow(run, _io.ddl(_PAIRS))


def duplicate_classes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row."""
    texts = _io.keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), _io.utf8_binary())
    rows = _io.cut(document_sets(texts, seed))
    classes = _io.cut(rows.filter("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("guard").alias("g"), F.max("guard").alias("h")))
    if not classes.filter("g != h").isEmpty():
        return duplicate_classes(docs, seed + 1)  # two sets share a fingerprint: take another

    frequent = frequent_tokens(texts).orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    order = Order(frequent["token"].to_numpy().astype(np.int64).view(np.uint64), frequent["n"].to_numpy().astype(np.int64))
    multi = _io.cut(shared_tokens(prefix_rows(texts.filter("doc_id is not null"), order, seed)))

    star = multi.filter(F.col("node") != F.col("pivot")).filter(may_link("meta", "pivot_meta", F.lit(1)))
    linked = _io.cut(verify(_io.cut(star.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()), texts, classes, seed))
    joined = components(linked, "a", "b")

    # Across classes: only tokens whose nodes are in two classes or more.
    placed = multi.select("token", "node", "meta")
    placed = placed.withColumn("root", F.col("node")) if joined is None else placed.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = _io.cut(placed)
    apart = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")

    # Nodes meet at a token and two sizes.  Many of them there are tied to a dense set; its pairs aren't made, its blocks are compared.
    at = ["token", "small", "apart"]
    met_at = _io.cut(by_size(placed.join(apart.select("token"), "token", "left_semi")))
    places = met_at.groupBy(*at).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("nodes"), F.min("node").alias("lead"), F.count_if("large").alias("larger"))
    places = _io.cut(places.filter("low < high and (apart = 0 or (larger > 0 and larger < nodes))").select(*at, "nodes", "lead"))
    dense = components(met_at.join(places.filter(F.col("nodes") > DENSE), at).select(F.col("lead").alias("a"), F.col("node").alias("b")), "a", "b")
    thin = met_at.join(places.filter(F.col("nodes") <= DENSE).select(*at), at, "left_semi")
    if dense is not None:
        dense = dense.withColumnRenamed("root", "dense")
        members = placed.groupBy("node").agg(F.first("root").alias("root"), F.first(_size("meta")).alias("n")).join(dense, "node").join(classes.select("node", "first_id"), "node")
        linked = linked.unionByName(_io.cut(verify_dense(members, texts, seed)))
        thin = thin.join(dense, "node", "left")
    else:
        thin = thin.withColumn("dense", F.lit(None).cast("long"))

    # Two nodes meet at one place for each token.  Pairs that aren't of one dense set share no crowded place, so that their count is whole.
    x = thin.select(*at, F.col("node").alias("a"), F.col("meta").alias("am"), F.col("root").alias("ar"), F.col("dense").alias("ad"), F.col("large").alias("al"))
    y = thin.select(*at, F.col("node").alias("b"), F.col("meta").alias("bm"), F.col("root").alias("br"), F.col("dense").alias("bd"), F.col("large").alias("bl"))
    least = F.least(_l("am"), _l("bm"))
    other = F.col("ad").isNull() | F.col("bd").isNull() | (F.col("ad") != F.col("bd"))
    met = x.join(y, at).filter((F.col("ar") < F.col("br")) & ((F.col("apart") == 0) | (F.col("al") != F.col("bl"))) & other & may_link("am", "bm", least))
    cross = met.groupBy("a", "b").agg(F.count("*").alias("n"), F.first(least).alias("l")).filter("n >= l")
    more = verify(_io.cut(cross.select("a", "b")), texts, classes, seed)
    links = linked.unionByName(more)
    final = components(links, "a", "b")

    if final is None:
        per_node = classes.select("node", F.col("first_id").alias("component_id"))
    else:
        named = classes.select("node", "first_id").join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least_id = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        per_node = named.join(least_id, "root").select("node", "component_id")
    full = rows.filter("n > 0 and doc_id is not null").join(per_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(alone)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose id is the smallest of their class.

    Rows that repeat an id stay once; rows without an id stay.
    """
    judged = _io.cut(duplicate_classes(docs))
    gone = _io.counted(judged.filter("doc_id != component_id").select(F.col("doc_id").alias("_of")).distinct())
    same = F.col("_row.doc_id") == F.col("_of")
    out = docs.select(F.struct("*").alias("_row")).join(gone, same, "left_anti")
    again = judged.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_of"))
    if again.isEmpty():
        return out.select("_row.*")
    again = _io.counted(again)
    once = out.join(again, same, "left_semi").select("_row", F.col("_row.doc_id").alias("_id")).dropDuplicates(["_id"])
    return out.join(again, same, "left_anti").unionByName(once.drop("_id")).select("_row.*")
