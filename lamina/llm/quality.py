"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text come from vectorised byte kernels.  A base rule rejects texts
of under 50 words and texts of which over half of the words stand in repeated three-word
windows.  Beyond it, boosted trees judge: they are fitted on a bounded sample of labelled
rows (TRAIN_ROWS, the labelled documents with the smallest hashes of their ids), with
monotonic constraints on chosen statistics, and flattened into numpy node arrays, which
score a batch of rows level by level without a loop over rows.

A fifth of the sample is held out by the hash of the id.  The threshold is the largest score
below which no more than REJECT_GOOD of the held-out good documents fall, and never above one
half: when in doubt a document stays.  The report has the accuracy on the held-out rows.

Cases: a null or empty text has no words and fails the base rule; without labels of both
kinds there are no trees and the base rule decides alone; where so few are labelled that the
held-out or the other rows lack a kind, trees and threshold come from all rows; repeated rows are judged each;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io

TRAIN_ROWS, REJECT_GOOD = 4_000, 0.002

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_POINT = np.ones(256, dtype=bool)
_POINT[0x80:0xC0] = False
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_upper", "n_stops", "n_distinct", "n_long_words", "n_bytes")
#: Statistic and the direction in which quality may move with it (0: either).
FEATURES = (("log_words", 0), ("mean_word", 0), ("symbols", -1), ("dup_lines", -1), ("repeats", -1), ("words_per_line", 0), ("digits", -1), ("upper", 0), ("stops", 0), ("distinct", 0), ("long_words", -1))


def _repeated(view: np.ndarray, start: np.ndarray, stop: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which spans equal an earlier one of their row; equal hashes are compared byte by byte."""
    out, rest, seed = np.zeros(len(start), dtype=bool), np.arange(len(start)), 0
    while len(rest):
        h = B.span_hash(view, start[rest], stop[rest], seed)
        order = np.lexsort((rest, h, row[rest]))
        who, h = rest[order], h[order]
        head = np.ones(len(who), dtype=bool)
        head[1:] = (h[1:] != h[:-1]) | (row[who][1:] != row[who][:-1])
        lead = who[np.maximum.accumulate(np.where(head, np.arange(len(who)), 0))]
        size = stop[who] - start[who]
        same = size == stop[lead] - start[lead]
        same[same] = B.same_spans(view, start[who[same]], view, start[lead[same]], size[same])
        out[who[same & ~head]] = True
        rest = np.sort(who[~same])  # others of one hash, which the first one isn't equal to: once more among themselves
        seed = 1 - seed
    return out


def statistics(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of STATS for every row of a chunk."""
    n = len(offs) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[offs[1:]] - total[offs[:-1]]

    starts, ends, first = B.word_bounds(data, offs, B.NOT_SPACE)
    view = B.lanes(data)
    words, rows = B.span_hash(view, starts, ends), B.rows_of(first)
    out = {"n_words": np.diff(first), "n_bytes": np.diff(offs)}
    out["word_chars"] = per_row(B.NOT_SPACE[data] & _POINT[data])
    for name, member in (("n_symbols", _SYMBOL), ("n_digits", _DIGIT), ("n_upper", _UPPER), ("n_stops", _STOP)):
        out[name] = per_row(member[data])
    out["n_long_words"] = np.bincount(rows[ends - starts > 40], minlength=n)

    # Lines with a word: those whose span holds a word's start.
    cut = np.union1d(np.flatnonzero(data == 0x0A) + 1, offs[:-1][np.diff(offs) > 0])
    cut = cut[cut < len(data)]
    stop = np.append(cut[1:], len(data))
    stop = stop - ((stop > cut) & (data[stop - 1] == 0x0A)) if len(cut) else stop
    held = np.searchsorted(starts, stop) > np.searchsorted(starts, cut)
    cut, stop = cut[held], stop[held]
    line_row = np.searchsorted(offs, cut, side="right") - 1
    out["n_lines"] = np.bincount(line_row, minlength=n)
    out["n_dup_lines"] = np.bincount(line_row[_repeated(view, cut, stop, line_row)], minlength=n)
    _, uniq = B.distinct(words, rows, n)
    out["n_distinct"] = np.diff(uniq)

    # Words in three-word windows that the same row has twice or more.
    covered = np.zeros(len(words), dtype=bool)
    if len(words) >= 3:
        at = np.flatnonzero(rows[:-2] == rows[2:])
        key = B.mix(words[at] * B._MIX[0] + words[at + 1] * B._MIX[1] + words[at + 2] * B._MIX[2] + B.mix(rows[at].astype(np.uint64)) * B._MIX[3])
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        again = np.zeros(len(key), dtype=bool)
        again[1:] = key[1:] == key[:-1]
        again = np.flatnonzero(again)
        # Equal hashes are compared word by word with the window before.
        same = rows[at[again]] == rows[at[again - 1]]
        for k in range(3):
            x, y = at[again] + k, at[again - 1] + k
            size = ends[x] - starts[x]
            fits = same & (size == ends[y] - starts[y])
            same = fits.copy()
            same[fits] = B.same_spans(view, starts[x[fits]], view, starts[y[fits]], size[fits])
        again = again[same]
        for k in range(3):
            covered[at[again] + k] = covered[at[again - 1] + k] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """A row of FEATURES for each document."""
    w, b, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_bytes"], 1), np.maximum(s["n_lines"], 1)
    return np.column_stack([np.log1p(s["n_words"]), s["word_chars"] / w, s["n_symbols"] / w, s["n_dup_lines"] / lines, s["n_repeat_words"] / w, s["n_words"] / lines, s["n_digits"] / b, s["n_upper"] / w, s["n_stops"] / w, s["n_distinct"] / w, s["n_long_words"] / w]).astype(float)


@dataclass
class Trees:
    """Boosted trees as node arrays: feature (-1 at a leaf), threshold, left child (the right one follows), value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float
    cutoff: float = 0.0
    report: dict = field(default_factory=dict)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, every = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                step = self.left[node] + (x[every, np.maximum(f, 0)] > self.threshold[node])
                node = np.where(inner, step, node)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 2.0, least: float = 5.0) -> Trees:
    """Histogram gradient boosting of the logistic loss with monotonic constraints.

    A split on a constrained feature is taken only if its children's values keep the direction;
    the middle of the two values bounds everything below either child, so that the whole tree
    is monotonic, not only the split.
    """
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), base)
    feature, threshold, left, value, roots = [], [], [], [], []

    def leaf(v: float) -> int:
        feature.append(-1), threshold.append(0.0), left.append(0), value.append(v)
        return len(feature) - 1

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(leaf(0.0))
        todo = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            fit = lambda a, b, low=low, high=high: np.clip(a / (b + l2), low, high)
            value[node] = rate * float(fit(g, h))
            gain = lambda a, b, v: a * v - 0.5 * (b + l2) * v * v
            best = (1e-6, -1, 0, 0.0, 0.0)
            for j in range(x.shape[1]) if level < depth else ():
                k = len(edges[j]) + 1
                a = np.cumsum(np.bincount(code[rows, j], grad[rows], k))[:-1]
                b = np.cumsum(np.bincount(code[rows, j], hess[rows], k))[:-1]
                if not len(a):
                    continue
                vl, vr = fit(a, b), fit(g - a, h - b)
                win = gain(a, b, vl) + gain(g - a, h - b, vr) - gain(g, h, float(fit(g, h)))
                bad = (b < least * 0.05) | (h - b < least * 0.05) | (directions[j] * (vr - vl) < 0)
                win = np.where(bad, -np.inf, win)
                i = int(np.argmax(win))
                if win[i] > best[0]:
                    best = (float(win[i]), j, i, float(vl[i]), float(vr[i]))
            if best[1] < 0:
                continue
            _, j, i, vl, vr = best
            goes = code[rows, j] > i
            feature[node], threshold[node] = j, float(edges[j][i])
            left[node] = leaf(0.0)
            leaf(0.0)
            middle, d = (vl + vr) / 2, directions[j]
            bounds = ((low, high), (low, high)) if d == 0 else ((low, middle), (middle, high)) if d > 0 else ((middle, high), (low, middle))
            todo += [(left[node], rows[~goes], level + 1, *bounds[0]), (left[node] + 1, rows[goes], level + 1, *bounds[1])]
        out = Trees(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots[-1:]), depth, 0.0)
        margin += out.margin(x)
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots), depth, base)


_STATS = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in STATS)])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            s = statistics(data, offs)
            yield _io.batch(_STATS, rows.column("doc_id"), *(s[n] for n in STATS))

    return _io.keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), _io.utf8_binary()).mapInArrow(run, _io.ddl(_STATS))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, reject_good: float = REJECT_GOOD) -> Trees | None:
    """Trees fitted on at most rows labelled documents; None without labels of both kinds."""
    marked = _io.keyed(labels, "doc_id", "quality").filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    near = _io.keyed(docs, "doc_id", "text").join(F.broadcast(marked), "doc_id", "left_semi")  # at most rows ids
    table = document_statistics(near).join(F.broadcast(marked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *STATS).limit(2 * rows).orderBy("doc_id", *STATS).toPandas()
    if table.empty or table["quality"].nunique() < 2:
        return None
    x, y = features({n: table[n].to_numpy() for n in STATS}), (table["quality"].to_numpy() > 0).astype(float)
    held = B.mix(table["doc_id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(5) == 0
    if len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
        held = np.zeros(len(y), dtype=bool)
    trees = fit_trees(x[~held], y[~held], [d for _, d in FEATURES])
    judged = held if held.any() else ~held
    score, is_good = trees.score(x[judged]), y[judged] == 1
    good = np.sort(score[is_good])
    trees.cutoff = float(min(0.5, good[int(reject_good * len(good))]))
    kept = score >= trees.cutoff
    trees.report = {"rows": int((~held).sum()), "held_out": int(held.sum()), "held_out_accuracy": float(((score >= 0.5) == is_good).mean()), "good_kept": float(kept[is_good].mean()), "bad_rejected": float((~kept[~is_good]).mean())}
    return trees


_JUDGED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("score", pa.float64()), ("kept", pa.bool_())])


def judge(data: np.ndarray, offs: np.ndarray, trees: Trees | None) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    s = statistics(data, offs)
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    score = trees.score(features(s)) if trees else np.ones(len(failed))
    return s, failed, score, ~failed & (score >= (trees.cutoff if trees else 0.0))


def judge_documents(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            s, failed, score, kept = judge(data, offs, trees)
            yield _io.batch(_JUDGED, rows.column("doc_id"), *(s[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), failed, score, kept)

    return _io.keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), _io.utf8_binary()).mapInArrow(run, _io.ddl(_JUDGED))


def keep_documents(docs: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """The rows of docs that are kept, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, text_col):
            yield rows.filter(pa.array(judge(data, offs, trees)[3]))

    return docs.mapInArrow(run, docs.schema)
