"""Token counts of whole texts.

Texts travel in Arrow batches and only lengths return.  A text is cut at safe boundaries:
before a single space that stands between two characters that aren't white space.  A
byte-level pre-tokeniser always starts a new pre-token there and never looks across, so the
counts of the pieces add up to the count of the text.  Whether a tokenizer is of that kind is
read from its file; with any other, texts are encoded whole.  Pieces that are equal within a
slice of CHUNK bytes are encoded once; what must be encoded goes to the library in batches of
about equal bytes.  Every worker remembers a bounded number of pieces with their lengths.
Pieces are found again by a hash and taken as equal only if their bytes are.

Cases: a null or empty text has 0 bytes and 0 tokens; a text without a safe boundary is one
piece, however long; repeated rows are counted each; further columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _io

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

_visible = np.zeros(256, dtype=bool)
_visible[0x21:0x7F] = True
_two_byte = np.zeros(256, dtype=bool)  # lead bytes of two-byte characters that are never white space
_two_byte[0xC3:0xE0] = True


def safe_cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Ascending positions at which a piece starts: row starts and safe boundaries."""
    n = len(data)
    edge = np.zeros(n + 2, dtype=bool)
    edge[offs] = True
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at + 1 < n)]
    at = at[~(edge[at] | edge[at + 1])]
    before, after = data[at - 1], data[at + 1]
    left = _visible[before] | ((before >= 0x80) & _two_byte[data[np.maximum(at - 2, 0)]])
    mark = np.zeros(n, dtype=bool)
    mark[at[left & (_visible[after] | _two_byte[after])]] = True
    mark[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(mark)


def cuts_hold(path: str) -> bool:
    """Whether the tokenizer file at path splits at every safe boundary: byte-level with its own pattern and no normaliser."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    plain = all(not (t.get("lstrip") or t.get("rstrip") or " " in t.get("content", "")) for t in spec.get("added_tokens", []))
    return spec.get("normalizer") is None and len(steps) == 1 and steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex", True) and plain


class _Known:
    """Pieces with their counts, in the order of their hashes."""

    def __init__(self, keys: np.ndarray, count: np.ndarray, start: np.ndarray, size: np.ndarray, data: np.ndarray):
        self.keys, self.count, self.start, self.size, self.data = keys, count, start, size, data
        self.view = B.lanes(data)

    def with_other(self, other: _Known) -> _Known:
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")
        start = np.concatenate([self.start, other.start + len(self.data)])
        return _Known(keys[order], np.concatenate([self.count, other.count])[order], start[order], np.concatenate([self.size, other.size])[order], np.concatenate([self.data, other.data]))


class Lengths:
    """Token counts of pieces by a library; a bounded number of earlier pieces is remembered, in sorted runs."""

    def __init__(self, path: str, batch_bytes: int, memory: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            own = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in own.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            self.encode = lambda texts: [len(x) for x in own.encode_batch_fast(texts, add_special_tokens=False)]
        self.pieces = cuts_hold(path)
        self.batch_bytes, self.memory = batch_bytes, memory
        self.runs: list[_Known] = []

    def batches(self, pieces: list[bytes]) -> np.ndarray:
        """Counts of pieces that are encoded now, in batches of about batch_bytes."""
        sizes = np.cumsum([len(p) for p in pieces])
        limits = np.unique(np.concatenate([np.searchsorted(sizes, np.arange(self.batch_bytes, sizes[-1], self.batch_bytes)), [0, len(pieces)]]))
        out = [n for a, b in zip(limits[:-1], limits[1:], strict=True) for n in self.encode([p.decode("utf-8", "replace") for p in pieces[a:b]])]
        return np.array(out, dtype=np.int64)

    def _encoded(self, at: np.ndarray, size: np.ndarray, raw: bytes) -> np.ndarray:
        return self.batches([raw[a : a + n] for a, n in zip(at.tolist(), size.tolist(), strict=True)])

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of the pieces of a slice of text."""
        view, raw, size = B.lanes(data), data.tobytes(), ends - starts
        keys, one, which = np.unique(B.span_hash(view, starts, ends), return_index=True, return_inverse=True)
        at, long = starts[one], size[one]
        count = np.full(len(keys), -1, dtype=np.int64)
        for run in self.runs:
            place = np.minimum(np.searchsorted(run.keys, keys), len(run.keys) - 1)
            hit = np.flatnonzero((run.keys[place] == keys) & (run.size[place] == long) & (count < 0))
            hit = hit[B.same_spans(view, at[hit], run.view, run.start[place[hit]], long[hit])]
            count[hit] = run.count[place[hit]]
        new = np.flatnonzero(count < 0)
        if len(new):
            count[new] = self._encoded(at[new], long[new], raw)
            self._remember(keys[new], count[new], at[new], long[new], data)
        out = count[which]
        same = size == long[which]
        same[same] = B.same_spans(view, starts[same], view, at[which[same]], size[same])
        if not same.all():  # pieces that share a hash with another
            out[~same] = self._encoded(starts[~same], size[~same], raw)
        return out

    def _remember(self, keys: np.ndarray, count: np.ndarray, at: np.ndarray, size: np.ndarray, data: np.ndarray) -> None:
        held = size <= 64  # longer pieces seldom come again
        keys, count, at, size = keys[held], count[held], at[held], size[held]
        if not len(keys):
            return
        stop = np.cumsum(size)
        self.runs.append(_Known(keys, count.astype(np.int32), (stop - size).astype(np.int32), size.astype(np.int32), data[B.spread(at, size)]))
        while len(self.runs) > 1 and 2 * len(self.runs[-1].keys) > len(self.runs[-2].keys):
            last = self.runs.pop()
            self.runs.append(self.runs.pop().with_other(last))
        if sum(len(r.keys) for r in self.runs) > self.memory:
            self.runs = []


_lengths: dict[tuple, Lengths] = {}  # of this worker process


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 16, memory: int = 2_000_000) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row.

    path: the tokenizer's file, to be found at that place on every executor.  memory: how many
    pieces of up to 64 bytes a worker remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, batch_bytes, memory)
        lengths = _lengths[key] = _lengths.get(key) or Lengths(*key)
        for rows, data, offs in B.chunks(batches, "text"):
            cuts = safe_cuts(data, offs) if lengths.pieces else offs[:-1][np.diff(offs) > 0]
            per_piece = lengths.of(data, cuts, np.append(cuts[1:], len(data))) if len(cuts) else np.zeros(0, np.int64)
            total = np.concatenate([[0], np.cumsum(per_piece)])
            first = np.searchsorted(cuts, offs)
            yield _io.batch(_OUT, rows.column("doc_id"), np.diff(offs), total[first[1:]] - total[first[:-1]])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return narrow.mapInArrow(run, _io.ddl(_OUT))
