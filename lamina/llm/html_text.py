"""Main text of pages: markup first, and a suffix array of each host for what pages repeat.

A page's stream is its tokens (words of its blocks, in order) outside the main text that its
markup names; where main text comes between, the stream breaks.  The streams of a host's
pages, put together, have a suffix array; a substring of RUN tokens or more that distinct
pages share is an interval of it whose suffixes agree to that depth.  So suffixes are sorted no
deeper: their names at depth 1, 2, 4, 8 come from each other by doubling, a name at depth 2d
being that of a suffix and of the one d tokens on, in two hashes of 64 bits with the host's.
Suffixes of one name are an interval, and all that counts of it is whether it holds two
different pages, which are a least and a largest fingerprint: an aggregation that combines
before its shuffle, so that a line on all pages of a host is one row a task.  A stream that is
shorter than RUN between breaks is a suffix of its own length.

Tokens in such an interval are covered.  Of the blocks that markup leaves open, covered runs
are removed as boilerplate and unique runs kept; what markup names as main text stays, whether
other pages have it or not, and what it names as a menu, header, footer, sidebar, notice,
advert, form or comment goes.  Pages are different if any of their blocks are: a page's copies
don't make its text boilerplate.  A page without main text all of whose open text is covered
keeps it, since its near copies cover it.

Each different stream of a host is worked on once, whatever number of pages has it, and joined
to its pages, where Spark splits a stream with very many pages.

Cases: null or empty html has no blocks and an empty text; a null url, or one without a host,
counts to one nameless host; repeated rows and null ids give rows of their own; tags and
character references may be broken, unclosed or cut off; no rows give no rows; further columns
are ignored.
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
from .pages import ARTICLE, FURNITURE, blocks_of
from .urls import host_of

RUN = 8  # tokens of a substring that counts as repeated; a power of two
_U = np.uint64

_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("texts", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())), ("outside", pa.int64()), ("stream", pa.binary())])
_STREAMS = pa.schema([("stream", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("long", pa.list_(pa.int32()))])


def _hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def stream_of(blocks: list[tuple[str, int]]) -> tuple[list[list[str]], list[int]]:
    """(the stream as parts between breaks, of each block its first token's place or -1)."""
    parts: list[list[str]] = [[]]
    starts, at = [], 0
    for text, kind in blocks:
        if kind == ARTICLE:
            starts.append(-1)
            if parts[-1]:
                parts.append([])
            continue
        words = text.split(" ")
        starts.append(at)
        parts[-1] += words
        at += len(words)
    return [p for p in parts if p], starts


def suffixes(parts: list[list[str]], host: int, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, place, length) of the suffixes of a stream at depth run; of a shorter part the whole."""
    words = [w for p in parts for w in p]
    if not words:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none.astype(_U), none, none
    raw = "".join(words).encode("utf-8", "surrogatepass")
    sizes = np.array([len(w.encode("utf-8", "surrogatepass")) for w in words])
    ends = np.cumsum(sizes)
    view = B.lanes(np.frombuffer(raw, np.uint8))
    names = [B.span_hash(view, ends - sizes, ends, seed) for seed in (0, 1)]
    lengths = np.array([len(p) for p in parts])
    heads = np.cumsum(lengths) - lengths
    depth = 1
    full = [n.copy() for n in names]
    left = np.concatenate([n - np.arange(n) for n in lengths])  # tokens from each place to its part's end
    while depth < run:
        for n in full:
            n[:-depth] = B.mix(n[:-depth] * _U(3) + B.mix(n[depth:]))  # names beyond a part's end are dropped below
        depth *= 2
    keep = left >= run
    place, size = np.flatnonzero(keep), np.full(int(keep.sum()), run)
    short = np.flatnonzero(lengths < run)
    out = [n[keep] for n in full]
    if len(short):
        place, size = np.concatenate([place, heads[short]]), np.concatenate([size, lengths[short]])
        for k in range(2):
            whole = [np.add.reduce(names[k][heads[s] : heads[s] + lengths[s]] * (2 * np.arange(lengths[s], dtype=_U) + _U(3))) for s in short]
            out[k] = np.concatenate([out[k], B.mix(np.array(whole, dtype=_U) + lengths[short].astype(_U))])
    seed = B.mix(np.array([host], dtype=_U))
    return B.mix(out[0] + seed), B.mix(out[1] ^ seed), place, size


def _stream_id(host: str, parts: list[list[str]]) -> bytes:
    digest = hashlib.blake2b(host.encode("utf-8", "surrogatepass"), digest_size=16)
    for p in parts:
        digest.update(b"\0\0" + "\0".join(p).encode("utf-8", "surrogatepass"))
    return digest.digest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            yield from zip(*(part.column(k).to_pylist() for k in part.schema.names), strict=True)


def extract_text(pages: DataFrame, run: int = RUN) -> DataFrame:
    """page_id, url, text, n_chars, and the tokens outside the main text: all (n_outside) and those that the host's other pages repeat (n_repeated)."""
    if run < 1 or run & (run - 1):
        raise ValueError("run: a power of two")
    source = _io.keyed(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(host_of(F.col("url").cast("string")), F.lit("")).alias("host"), F.col("html").cast("string"))

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each stream that a task meets, with the least and largest fingerprint of its pages."""
        held: dict[bytes, list] = {}
        size = 0
        for _, _, host, html in _rows(batches):
            blocks = blocks_of(html)
            parts, _ = stream_of(blocks)
            if not parts:
                continue
            name, page = _stream_id(host, parts), _hash64("\n".join(t for t, _ in blocks)) >> 1
            if name not in held:
                a, b, at, long = suffixes(parts, _hash64(host), run)
                held[name] = [page, page, B.signed(a), B.signed(b), at.astype(np.int32), long.astype(np.int32)]
                size += len(a)
            else:
                held[name][:2] = min(held[name][0], page), max(held[name][1], page)
            if size > 1 << 17:
                yield _io.batch(_STREAMS, list(held), *(list(c) for c in zip(*held.values(), strict=True)))
                held, size = {}, 0
        if held:
            yield _io.batch(_STREAMS, list(held), *(list(c) for c in zip(*held.values(), strict=True)))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for page_id, url, host, html in _rows(batches):
            blocks = blocks_of(html)
            parts, starts = stream_of(blocks)
            kept = [k for k, (_, kind) in enumerate(blocks) if kind != FURNITURE]
            out.append((page_id, url, [blocks[k][0] for k in kept], [starts[k] for k in kept], sum(map(len, parts)), _stream_id(host, parts)))
            size += len(html or "")
            if size > B.CHUNK:
                yield _io.batch(_PARSED, *(list(c) for c in zip(*out, strict=True)))
                out, size = [], 0
        if out:
            yield _io.batch(_PARSED, *(list(c) for c in zip(*out, strict=True)))

    own = source.mapInArrow(streams, _io.ddl(_STREAMS)).groupBy("stream").agg(F.min("low").alias("low"), F.max("high").alias("high"), *[F.first(k).alias(k) for k in ("a", "b", "at", "long")])
    own = _io.cut(own).select("stream", "low", "high", F.explode(F.arrays_zip("a", "b", "at", "long")).alias("s")).select("stream", "low", "high", "s.*")
    repeated = own.groupBy("a", "b").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("a", "b")
    covered = own.select("stream", "a", "b", "at", "long").join(repeated, ["a", "b"], "left_semi")
    covered = covered.groupBy(F.col("stream").alias("_s")).agg(F.collect_list("at").alias("at"), F.collect_list("long").alias("long"))
    joined = source.mapInArrow(parsed, _io.ddl(_PARSED)).join(covered, F.col("stream") == F.col("_s"), "left")
    return joined.select("page_id", "url", "texts", "starts", "outside", "at", "long").mapInArrow(_cleaned, _io.ddl(_TEXTS))


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_outside", pa.int64()), ("n_repeated", pa.int64())])


def clean_page(texts: list[str], starts: list[int], covered: np.ndarray) -> str:
    """The text of blocks of main text (start -1) and of open ones, these without their covered tokens."""
    kept = []
    for text, start in zip(texts, starts, strict=True):
        if start >= 0:
            words = text.split(" ")
            text = " ".join(w for w, c in zip(words, covered[start : start + len(words)], strict=True) if not c)
        if text:
            kept.append(text)
    return "\n".join(kept or texts)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    size = 0
    for page_id, url, texts, starts, outside, at, long in _rows(batches):
        change = np.zeros(outside + 1, dtype=np.int64)
        if at:
            np.add.at(change, at, 1)
            np.add.at(change, np.add(at, long), -1)
        covered = np.cumsum(change)[:outside] > 0
        text = clean_page(texts, starts, covered)
        out.append((page_id, url, text, len(text), outside, int(covered.sum())))
        size += len(text)
        if size > B.CHUNK:
            yield _io.batch(_TEXTS, *(list(c) for c in zip(*out, strict=True)))
            out, size = [], 0
    if out:
        yield _io.batch(_TEXTS, *(list(c) for c in zip(*out, strict=True)))
