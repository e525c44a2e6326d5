"""Vectorised kernels over the UTF-8 bytes of whole texts.

Arrow hands a Python worker its strings as one byte buffer plus offsets.  The functions
here work on that buffer with numpy, so no Python object is made for a word: word limits
come from byte classes, and a word's identity is a 64-bit hash.  The hash reads a span in
lanes of eight bytes, each of which goes through a mixer that isn't linear together with
its place in the span before the lanes are added up.  Where a hash would decide an exact
result, same_spans compares the bytes.  A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text that are worked on at once; a longer text is one chunk
LANES = 1 << 17  # lanes of eight bytes that are mixed at once

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_HEAD = np.append((_U(1) << (_U(8) * np.arange(8, dtype=np.uint64))) - _U(1), _U(2**64 - 1))  # masks of the first 0 to 8 bytes


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads all bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _table(member) -> np.ndarray:
    return np.array([bool(member(b)) for b in range(256)])


#: Byte classes: words between white space, and words of letters and digits.
NOT_SPACE = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying the text; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]] if len(offs) else data[:0], offs - offs[0] if len(offs) else np.zeros(1, np.int64)


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows with about size bytes of text: (rows, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offs = column_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to


def word_bounds(data: np.ndarray, offs: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words; first[d] is the number of words before row d."""
    n = len(data)
    inside = np.empty(n + 1, dtype=np.int8)
    inside[:n] = member[data]
    inside[n] = 0
    before = np.zeros(n + 1, dtype=np.int8)
    before[1:] = inside[:n]
    cut = offs[1:-1]
    before[cut] = 0
    starts = np.flatnonzero((inside == 1) & (before == 0))
    last = np.zeros(n, dtype=bool)
    if n:
        follow = inside[1:].copy()
        inner = cut[(cut > 0) & (cut < n)]
        follow[inner - 1] = 0
        last = (inside[:n] == 1) & (follow == 0)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, zeros after the end; a view of a copy of data."""
    wide = np.zeros(len(data) + 8, dtype=np.uint8)
    wide[: len(data)] = data
    return np.ndarray((len(data) + 1,), np.dtype("<u8"), buffer=wide, strides=(1,))


def _lane_blocks(size: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(spans, of, k, last) for blocks of LANES lanes: which spans, and the span, number and end of each lane."""
    count = (size + 7) >> 3
    upto = np.cumsum(count)
    for low in range(0, int(upto[-1]) if len(upto) else 0, LANES):
        high = min(low + LANES, int(upto[-1]))
        part = slice(int(np.searchsorted(upto, low, side="right")), int(np.searchsorted(upto, high, side="left")) + 1)
        first = upto[part] - count[part]
        many = np.minimum(upto[part], high) - np.maximum(first, low)
        of = np.repeat(np.arange(len(many)), many)
        yield part, of, np.arange(low, high) - first[of], np.cumsum(many)


def span_hash(view: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each byte span of lanes(data), equal for equal bytes wherever they stand."""
    size = ends - starts
    out = size.astype(np.uint64) * _MIX[15 + seed]
    for part, of, k, last in _lane_blocks(size):
        lane = view[starts[part][of] + 8 * k] & _HEAD[np.minimum(size[part][of] - 8 * k, 8)]
        lane *= _MIX[17 + seed]
        lane ^= mix((k.astype(np.uint64) + _U(1)) * _STEP + _MIX[19 + seed])
        total = np.zeros(len(lane) + 1, dtype=np.uint64)
        np.cumsum(mix(lane), out=total[1:])
        total = total[last]
        out[part] += np.diff(total, prepend=_U(0))
    return mix(out)


def same_spans(one: np.ndarray, a: np.ndarray, two: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the size bytes from a on in one view of lanes equal those from b on in the other."""
    out = np.ones(len(size), dtype=bool)
    for part, of, k, last in _lane_blocks(size):
        differ = ((one[a[part][of] + 8 * k] ^ two[b[part][of] + 8 * k]) & _HEAD[np.minimum(size[part][of] - 8 * k, 8)]) != 0
        out[part] &= np.bincount(of[differ], minlength=len(last)) == 0
    return out


def word_hashes(data: np.ndarray, offs: np.ndarray, member: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first); with lower, A-Z count as a-z."""
    starts, ends, first = word_bounds(data, offs, member)
    return span_hash(lanes(LOWER[data] if lower else data), starts, ends), first


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ngrams(words: np.ndarray, first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of n words (under 14) inside a row; with short, a row of fewer words but not none gives one run of them all."""
    rows, total = rows_of(first), len(words)
    at = np.flatnonzero(rows[: total - n + 1] == rows[n - 1 :]) if total >= n else np.zeros(0, np.int64)
    value = np.full(len(at), n, dtype=np.uint64) * _MIX[14]
    for k in range(n):
        value += words[at + k] * _MIX[k]
    out, of = mix(value), rows[at]
    if short:
        size = np.diff(first)
        few = np.flatnonzero((size > 0) & (size < n))
        if len(few):
            value = size[few].astype(np.uint64) * _MIX[14]
            for k in range(n - 1):
                has = size[few] > k
                value[has] += words[first[few[has]] + k] * _MIX[k]
            out, of = np.concatenate([out, mix(value)]), np.concatenate([of, few])
    return out, of


def distinct(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): the distinct values of each row in ascending order, rows one after the other."""
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    v, r = values[order], rows[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.searchsorted(r, np.arange(n_rows + 1))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    jumps = np.ones(total, dtype=np.int64)
    lengths, starts = lengths[lengths > 0], starts[lengths > 0]
    heads = np.cumsum(lengths) - lengths
    jumps[heads[0]] = starts[0]
    jumps[heads[1:]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(jumps)
