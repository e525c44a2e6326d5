"""Fill-in-the-middle forms, cut through a learned index from token ranks to offsets.

A text is a row of tokens [A-Za-z]+|[^A-Za-z] over code points.  Where a token begins is a
function of its rank that grows nearly along a line, so the boundaries of a text are kept as
a piecewise-linear model: segments are lines through two boundaries that miss none of those
between by more than EPSILON bytes, and what a line misses is stored as a residual of one
byte.  A segment that misses by more is halved until it doesn't (two boundaries are always on
their line), all segments of a batch of texts at once, so that a text takes as many segments
as its word lengths ask for.  A cut at a rank is predicted by its segment and made exact by
the residual.

The ranks of the two cuts come from the hash of the document's id, and so do the form and its
order; a text that holds a mark itself, or is empty, stays plain.  restore takes a form apart
by its marks alone and puts the text together again.

Cases: null text is empty; a null id hashes as an empty one; repeated rows give equal rows;
no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SPAN, EPSILON = 256, 100  # ranks of a first segment; bytes that a prediction may miss by (residuals are one byte)
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100: hashes from the first on stay plain, under the second the suffix comes first

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def boundaries(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where tokens begin, first): first[d] is the number of tokens before row d; the bytes are UTF-8."""
    letter = _LETTER[data]
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offs[:-1][np.diff(offs) > 0]] = True
    at = np.flatnonzero(begins)
    return at, np.searchsorted(at, offs)


@dataclass
class RankIndex:
    """Boundaries of the rows of a batch: rank r of row d (the tokens' number is the row's end) is predict + residual."""

    first: np.ndarray  # of each row its first rank, among the ranks of all rows
    rank: np.ndarray  # of each segment its first rank
    base: np.ndarray  # and that rank's offset
    slope: np.ndarray
    residual: np.ndarray  # of each rank, int8

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.rank, ranks, side="right") - 1
        return self.base[s] + np.rint((ranks - self.rank[s]) * self.slope[s]).astype(np.int64)

    def offset(self, rows: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Exact offset of each row's rank."""
        at = self.first[rows] + ranks
        return self.predict(at) + self.residual[at]


def fit(at: np.ndarray, first: np.ndarray, offs: np.ndarray, span: int = SPAN, epsilon: int = EPSILON) -> RankIndex:
    """The index of boundaries at; a row with n tokens has n + 1 ranks, the last being its end."""
    if not 0 <= epsilon <= 127:
        raise ValueError("epsilon: residuals are kept in one byte")
    many = np.diff(first)
    y = np.insert(at, first[1:], offs[1:])
    start = np.append(0, np.cumsum(many + 1))
    count = (many + span) // span  # segments of a row at first
    lo = np.repeat(start[:-1], count) + (B.spread(np.zeros(len(count), np.int64), count)) * span
    hi = np.minimum(lo + span, np.repeat(start[1:], count))  # one past the last rank
    done_lo, done_slope = [], []
    residual = np.zeros(len(y), dtype=np.int8)
    while len(lo):
        size = hi - lo
        slope = (y[hi - 1] - y[lo]) / np.maximum(size - 1, 1)
        ranks, of = B.spread(lo, size), np.repeat(np.arange(len(lo)), size)
        miss = y[ranks] - y[lo][of] - np.rint((ranks - lo[of]) * slope[of]).astype(np.int64)
        worst = np.maximum.reduceat(np.abs(miss), np.cumsum(size) - size)
        good = worst <= epsilon
        kept = good[of]
        residual[ranks[kept]] = miss[kept].astype(np.int8)
        done_lo.append(lo[good])
        done_slope.append(slope[good])
        middle = (lo[~good] + hi[~good]) // 2
        lo, hi = np.concatenate([lo[~good], middle]), np.concatenate([middle, hi[~good]])
    rank, slope = (np.concatenate(done_lo), np.concatenate(done_slope)) if done_lo else (np.zeros(0, np.int64), np.zeros(0))
    order = np.argsort(rank)
    return RankIndex(start[:-1], rank[order], y[rank[order]], slope[order], residual)


def form(kind: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if kind == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if kind == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return prefix + middle + suffix


def restore(kind: str, output: bytes) -> bytes:
    """The text behind an output, by its marks."""
    if kind == "plain":
        return output
    opened, second = (PREFIX, SUFFIX) if kind == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(opened):
        raise ValueError("the first mark is missing")
    a, b = output.index(second), output.index(MIDDLE)
    one, two, middle = output[len(opened) : a], output[a + len(second) : b], output[b + len(MIDDLE) :]
    return one + middle + two if kind == "psm" else two + middle + one


_FORMED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])


def transform(docs: DataFrame, seed: str = "1") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (UTF-8) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in B.chunks(batches, "text"):
            at, first = boundaries(data, offs)
            index, n = fit(at, first, offs), np.diff(first)
            h = np.stack([rows.column(k).to_numpy() for k in ("h1", "h2", "h3", "h4")])
            cuts = np.sort(h[:2] % (n + 1), axis=0)
            every = np.arange(len(n))
            low, high = index.offset(every, cuts[0]), index.offset(every, cuts[1])
            chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            forms, outputs = [], []
            whole = data.tobytes()
            for d in range(len(n)):
                text = whole[offs[d] : offs[d + 1]]
                plain = not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2, d] % 100 >= PLAIN_FROM
                kind = "plain" if plain else "spm" if h[3, d] % 100 < SPM_BELOW else "psm"
                forms.append(kind)
                a, b = low[d] - offs[d], high[d] - offs[d]
                outputs.append(text if plain else form(kind, text[:a], text[a:b], text[b:]))
            plain = np.array([f == "plain" for f in forms], dtype=bool)
            sizes = [pa.array(x, mask=plain) for x in (chars[low] - chars[offs[:-1]], chars[high] - chars[low])]
            yield _io.batch(_FORMED, rows.column("doc_id"), n, forms, *sizes, outputs)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    part = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
    rows = _io.keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), _io.utf8_binary()).select("doc_id", "text", *[part(k) for k in range(4)])
    return rows.mapInArrow(run, _io.ddl(_FORMED))


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])


def digest_forms(formed: DataFrame) -> DataFrame:
    """transform's rows with the output's digest, and that of the text restored from it, in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            outputs, forms = rows.column("output").to_pylist(), rows.column("form").to_pylist()
            back = [hashlib.sha256(restore(k, x)).hexdigest() for k, x in zip(forms, outputs, strict=True)]
            yield _io.batch(_DIGEST, *[rows.column(c) for c in _DIGEST.names[:5]], [hashlib.sha256(x).hexdigest() for x in outputs], back)

    return formed.mapInArrow(run, _io.ddl(_DIGEST))
