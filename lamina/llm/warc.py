"""WARC archives: writing pages as records, and reading them back by boundary chains.

Writing: a page is a response record whose block is an HTTP response with the page's html.
Of pages with equal payloads of at least MIN_REVISIT bytes the one with the largest id is the
response; the others become revisit records, which have no block and refer to it.  Spark's
own text sink writes the files, so any file system that Spark knows will do; the record end
(two CRLF) is its line separator.

Reading: records of any version and type are read (the others' payload is their block, a
request's what follows its HTTP header; a revisit's is what it tells).  Spark's text source cuts
files at the magic, so that a large file is read by many tasks, each its own byte ranges, and a gzip file (of one member or one for each record) as a
stream; no file is ever held whole.  What follows a magic is a candidate record and names its
successor, which is where its declared length ends.  A magic inside a payload is a candidate
as well, and may even carry a well-formed record.  Only what pointer jumping from the start of
the file reaches is a record: each byte range resolves its own chains, the ranges' exits are
joined and doubled until no more are reached, and every range marks what its entry reaches.
The chain has to end where the file ends.  A record whose payload holds the magic is put
together from the pieces that lie within it.

Cases: record ids that aren't of pages give a null page_id and are told as record_id; a digest in
base 32 is told in hex; header lines may be folded; null html is an empty payload; a null url leaves out the target header, and control
characters in a url are percent-encoded; a null page_id is a response without an id; repeated
rows with equal payloads and ids are all the response; no pages give no records; a file that
doesn't start with a record, or whose last one is cut, raises; further columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _io

MIN_REVISIT, FILE_BYTES = 1_000, 8 << 20
MAGIC, VERSION, END = b"WARC/", b"1.1", b"\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes and payload_digest."""
    p = _io.keyed(pages, "page_id", "url", "html")
    html = F.coalesce("html", F.lit(""))
    return p.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html.cast("binary")).alias("payload_digest"))


def revisits(paid: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """page_id, payload_digest and refers_to of the pages that become revisit records."""
    narrow = paid.filter(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    groups = narrow.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return narrow.join(groups, "payload_digest").filter("page_id < refers_to").distinct()


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, least: int = MIN_REVISIT) -> None:
    """Write a WARC record for each page into files of about file_bytes under path."""
    paid = payloads(pages)
    again = _io.cut(revisits(paid, least))
    seen = again.count()
    mean = paid.agg(F.avg("payload_bytes")).first()[0] or 0.0
    if seen <= 10_000:
        again = F.broadcast(again)  # counted just now
    rows = paid.join(again, ["page_id", "payload_digest"], "left")
    crlf = "\r\n"
    name = F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    line = lambda key, value: F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit(crlf)), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(crlf * 2))
    is_again = F.col("refers_to").isNotNull()
    block = F.when(is_again, F.lit("")).otherwise(F.concat(http, F.col("html")))
    record = F.concat(
        F.lit((MAGIC + VERSION).decode() + crlf), line("WARC-Type", F.when(is_again, F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", name), line("WARC-Date", F.lit(_DATE)), line("WARC-Target-URI", uri),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        line("WARC-Profile", F.when(is_again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))), line("Content-Type", F.when(is_again, F.lit("message/http")).otherwise(F.lit("application/http;msgtype=response"))),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(crlf), block,
    )
    per_file = max(1, int(file_bytes / (mean + 600)))
    rows.select(record.alias("value")).write.option("lineSep", END.decode()).option("maxRecordsPerFile", per_file).text(path)


_ID = re.compile(rb"<urn:page:(-?\d+)>")
_SPOTS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("successor", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("target_uri", pa.string())])
_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])
_DIGESTS = pa.schema([("file", pa.string()), ("at", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
BIN = 1 << 20


_VERSION = re.compile(rb"\d+\.\d+[ \t]*$")


def header(segment: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """(named fields, where the block begins) of the record whose magic segment follows, or None; of a repeated field the first counts."""
    stop = segment.find(END)
    if stop < 0:
        return None
    version, *lines = segment[:stop].split(b"\r\n")
    if not _VERSION.match(version):
        return None
    head: dict[bytes, bytes] = {}
    last = b""
    for text in lines:
        if text[:1] in (b" ", b"\t") and last:
            head[last] += b" " + text.strip()
            continue
        key, colon, value = text.partition(b":")
        last = b""
        if colon and (key := key.strip().lower()) not in head:
            head[last := key] = value.strip()
    return head, stop + len(END)


def _hex_digest(told: bytes) -> str:
    """A told digest without its algorithm; SHA-1 in base 32 becomes hex."""
    text = told.rpartition(b":")[2].decode("ascii", "replace")
    if len(text) == 32:
        try:
            return base64.b32decode(text.upper()).hex()
        except binascii.Error:
            pass
    return text


def candidate(segment: bytes) -> tuple | None:
    """(length with the record end, page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, refers_to_id, target_uri) of the record that starts with a magic and segment; the digest is null if it goes on behind segment."""
    read = header(segment)
    if read is None or not read[0].get(b"content-length", b"").isdigit():
        return None
    head, begin = read
    end = begin + int(head[b"content-length"])
    if end <= len(segment) and segment[end : end + len(END)] != END:
        return None
    kind, ids = head.get(b"warc-type", b"").lower(), [head.get(k) for k in (b"warc-record-id", b"warc-refers-to")]
    name, refers = (_ID.search(x or b"") for x in ids)
    if kind == b"revisit":
        told = head.get(b"warc-payload-length", b"")
        length, digest = int(told) if told.isdigit() else None, _hex_digest(head.get(b"warc-payload-digest", b""))
    elif end <= len(segment):
        body = _body(kind, segment, begin, end)
        length, digest = end - body, hashlib.sha1(memoryview(segment)[body:end]).hexdigest()
    else:
        length, digest = None, None
    said = lambda x: None if x is None else x.decode("utf-8", "replace")
    return end + len(END), int(name[1]) if name else None, length, digest, said(kind), int(refers[1]) if refers else None, *(x and x.strip("<>") for x in map(said, ids)), said(head.get(b"warc-target-uri"))


def _body(kind: bytes, block: bytes, begin: int, end: int) -> int:
    """Where the payload starts: in HTTP messages behind their header."""
    if kind not in (b"response", b"request"):
        return begin
    at = block.find(END, begin, end)
    return end if at < 0 else at + len(END)


def _jumps(at: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """The candidate that each one names as its successor, or its own number if none of these stands there."""
    here = np.arange(len(at))
    place = np.minimum(np.searchsorted(at, successor), max(len(at) - 1, 0))
    return np.where(at[place] == successor, place, here) if len(at) else here


def exits(at: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Where the chain from each candidate (ascending offsets) leaves them; successor is -1 where there is no record."""
    jump = _jumps(at, successor)
    for _ in range(max(1, len(at)).bit_length()):
        jump = jump[jump]
    return successor[jump]


def marks(at: np.ndarray, successor: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which candidates the chains from the entries hold."""
    jump, seen = _jumps(at, successor), entry.copy()
    for _ in range(max(1, len(at)).bit_length() + 1):
        seen[jump[np.flatnonzero(seen)]] = True
        jump = jump[jump]
    return seen


def reachable(at: np.ndarray, successor: np.ndarray, length: int) -> np.ndarray:
    """Which candidates the chain from offset 0 holds; it has to end at length."""
    if not len(at) or at[0] != 0 or exits(at, successor)[0] != length:
        raise ValueError("the chain of records doesn't reach the end of the archive")
    return marks(at, successor, at == 0)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): what stands between magics, in order within a block, which is a byte range of a file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path, lineSep=MAGIC.decode())
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes | None]]:
    """(file, block, offset in the block, segment) of each magic, and (file, block, length, None) at a block's end."""
    open_, at = None, 0
    for batch in batches:
        for file, block, value in zip(*(batch.column(n) for n in ("file", "block", "value")), strict=True):
            key, segment = (file.as_py(), block.as_py()), value.as_py()
            if key != open_:
                if open_ is not None:
                    yield *open_, at, None
                open_, at = key, 0
                if key[1] == 0:  # what stands before the file's first magic
                    at = len(segment)
                    continue
            yield *key, at, segment
            at += len(MAGIC) + len(segment)
    if open_ is not None:
        yield *open_, at, None


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _io.batch(schema, *(list(c) for c in zip(*held, strict=True)))
            held = []
    if held:
        yield _io.batch(schema, *(list(c) for c in zip(*held, strict=True)))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, refers_to_id and target_uri of every record."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for file, block, at, segment in _placed(batches):
                if segment is None:
                    yield file, block, -1, at, *[None] * 8
                elif (found := candidate(segment)) is None:
                    yield file, block, at, None, *[None] * 8
                else:
                    yield file, block, at, at + len(MAGIC) + found[0], *found[1:]

        return _in_batches(rows(), _SPOTS)

    text = segments(spark, path)
    found = _io.cut(text.mapInArrow(scan, _io.ddl(_SPOTS)))
    # A block starts where those before it end: a row for each block.
    w = Window.partitionBy("file").orderBy("block")
    lengths = found.filter("at < 0").select("file", "block", F.col("successor").alias("_n"))
    blocks = lengths.withColumn("_base", F.sum("_n").over(w) - F.col("_n"))
    base = _io.counted(blocks.select("file", "block", "_base"))
    spots = found.filter("at >= 0").join(base, ["file", "block"]).withColumn("at", F.col("at") + F.col("_base")).withColumn("successor", F.coalesce(F.col("successor") + F.col("_base"), F.lit(-1).cast("long"))).drop("_base")

    def leave(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("at", ignore_index=True)
        return g.assign(exit=exits(g["at"].to_numpy(), g["successor"].to_numpy()))

    narrow = spots.select("file", "block", "at", "successor")
    ways = _io.cut(narrow.groupBy("file", "block").applyInPandas(leave, "file string, block long, at long, successor long, exit long"))
    # Doubling over the ranges' entries: the start of each file, and where a range's chain enters another.
    starts = blocks.filter("_n > 0").select("file", F.lit(0).cast("long").alias("at")).distinct()
    doors = ways.select("file", F.col("exit").alias("at")).filter("at >= 0").unionByName(starts).distinct()
    jump = _io.cut(ways.join(doors, ["file", "at"], "left_semi").select("file", "at", F.col("exit").alias("to")))
    reach, n = _io.cut(starts), -1
    while (now := reach.count()) != n:
        n = now
        step = reach.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reach = _io.cut(reach.unionByName(step).distinct())
        far = jump.select("file", F.col("at").alias("to"), F.col("to").alias("_to"))
        jump = _io.cut(jump.join(far, ["file", "to"], "left").select("file", "at", F.coalesce("_to", "to").alias("to")))
    ends = blocks.groupBy("file").agg(F.sum("_n").alias("at")).filter("at > 0")
    broken = ends.join(reach, ["file", "at"], "left_anti").first()
    if broken is not None:
        raise ValueError(f"the chain of records doesn't reach the end of {broken['file']}")

    def mark(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("at", ignore_index=True)
        return g[marks(g["at"].to_numpy(), g["successor"].to_numpy(), g["entry"].to_numpy())][["file", "at"]]

    entered = narrow.join(reach.withColumn("entry", F.lit(True)), ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    held = entered.groupBy("file", "block").applyInPandas(mark, "file string, at long")
    records = _io.cut(spots.join(held, ["file", "at"], "left_semi"))
    whole = records.filter("payload_digest is not null")
    parted = _io.counted(records.filter("payload_digest is null").select("file", F.col("at").alias("_from"), F.col("successor").alias("_to")))
    if not parted.isEmpty():
        more = _assembled(text, base, parted).withColumnRenamed("payload_bytes", "_b").withColumnRenamed("payload_digest", "_d")
        rest = records.filter("payload_digest is null").join(more, ["file", "at"]).withColumn("payload_bytes", F.col("_b")).withColumn("payload_digest", F.col("_d"))
        whole = whole.unionByName(rest.select(*whole.columns))
    return whole.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "refers_to_id", "target_uri")


def _assembled(text: DataFrame, base: DataFrame, records: DataFrame) -> DataFrame:
    """(file, at, payload_bytes, payload_digest) of records (file, _from, _to) whose payloads hold magics: their pieces in order, as a stream."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(((f, b, at, s) for f, b, at, s in _placed(batches) if s is not None), _PIECES, 64)

    every = text.mapInArrow(pieces, _io.ddl(_PIECES)).join(base, ["file", "block"]).withColumn("at", F.col("at") + F.col("_base")).withColumn("_bin", F.expr(f"at div {BIN}"))
    ranges = records.withColumn("_bin", F.explode(F.sequence(F.expr(f"_from div {BIN}"), F.expr(f"(_to - 1) div {BIN}"))))
    own = every.join(F.broadcast(ranges) if records.count() <= 10_000 else ranges, ["file", "_bin"]).filter("at >= _from and at < _to")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            key, left, size, sha = None, 0, 0, hashlib.sha1()
            for batch in batches:
                for file, start, segment in zip(*(batch.column(n) for n in ("file", "_from", "bytes")), strict=True):
                    of, part = (file.as_py(), start.as_py()), segment.as_py()
                    if of != key:
                        if key is not None:
                            yield *key, size, sha.hexdigest()
                        key, size, sha = of, 0, hashlib.sha1()
                        head, begin = header(part)
                        length = int(head[b"content-length"])
                        body = _body(head.get(b"warc-type", b"").lower(), part, begin, len(part))
                        left, part = length - (body - begin), part[body:]
                    else:
                        part = MAGIC + part
                    part = part[: max(left, 0)]
                    left, size = left - len(part), size + len(part)
                    sha.update(part)
            if key is not None:
                yield *key, size, sha.hexdigest()

        return _in_batches(rows(), _DIGESTS)

    return own.select("file", "_from", "at", "bytes").repartition("file", "_from").sortWithinPartitions("file", "_from", "at").mapInArrow(digest, _io.ddl(_DIGESTS))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder, read them back, and remove the archives."""
    spark = pages.sparkSession
    path = f"{_io.shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    out = _io.cut(read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return out
