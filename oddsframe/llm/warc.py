"""WARC archives: written by Spark's text writer, read back with boundary-chain verification.

Writing. One record per page. Payloads (the html in UTF-8) are grouped by SHA-1 and length with
partial aggregation; of equal payloads of at least ``min_bytes`` the largest page_id is the response,
the others are revisits without the payload that name it. Only digests held more than once are joined
back, broadcast behind a check of their number and shuffled beyond it, so the html itself stays
where it was read. The text writer ends every line with CRLF CRLF, which is how a record ends.

Reading. Tasks scan whole archive files (bounded in records and bytes when written here) for the
record magic and emit every candidate with the offset of its successor. The magic may stand inside
a payload, so candidates are grouped per file and pointers are jumped from the file's start
(distances 1, 2, 4, ...): only what the chain reaches is a record.

Null html is an empty payload; a null url leaves out the target header; rows with a null page_id are
written without an id and read back with null; of repeated rows with the largest page_id each is a
response; extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsframe.llm.common import materialise, scratch_path

MAGIC = b"WARC/1.1\r\n"
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE, FILE_BYTES = 4096, 1 << 26
HEADER_BYTES = 1024  # about what a record adds to its payload
BROADCAST_ROWS = 200_000  # repeated digests (28 bytes each) that may be broadcast


def _base32_of_sha1(hex_digest: F.Column) -> F.Column:
    """40 hex digits -> 32 base32 letters: 5 hex digits are 4 letters."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, n_bytes, sha1, refers_to)``: refers_to is null for responses."""
    p = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                      F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
         .withColumn("n_bytes", F.octet_length("html").cast("long"))
         .withColumn("sha1", F.sha1(F.encode("html", "UTF-8"))))
    repeated = materialise(
        p.filter(F.col("n_bytes") >= min_bytes).groupBy("sha1", "n_bytes")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("sha1", "n_bytes", "first_id"), "warc-repeated")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    joined = p.join(repeated, ["sha1", "n_bytes"], "left")
    own = F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "html", "n_bytes", "sha1",
                         F.when(~own, F.col("first_id")).alias("refers_to"))


def _size_class(records_per_file: int, file_bytes: int) -> tuple[F.Column, list[int]]:
    """Class of a record by its size, and how many records of each class a file may hold: as many as fit in ``file_bytes``, a
    sixteenth per class, in the last class one of any size."""
    per_file = [records_per_file]
    while per_file[-1] > 1:
        per_file.append(max(1, per_file[-1] // 16))
    size = F.col("n_bytes") + HEADER_BYTES
    out = F.lit(len(per_file) - 1)
    for k in range(len(per_file) - 2, -1, -1):
        out = F.when(size <= file_bytes // per_file[k], F.lit(k)).otherwise(out)
    return out, per_file


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
                   file_bytes: int = FILE_BYTES) -> None:
    """Write a WARC record per page below ``path``. A file holds at most ``records_per_file`` records and about ``file_bytes``
    bytes, or a single record that is larger: records are written by size class, with fewer records a file the larger they are."""
    p = plan_records(pages, min_bytes)
    size_class, per_file = _size_class(records_per_file, file_bytes)
    present = [r[0] for r in pages.select(F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
               .groupBy(size_class.alias("c")).count().collect()] or [0]
    revisit = F.col("refers_to").isNotNull()
    header = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    header("Content-Length", F.col("n_bytes").cast("string")), F.lit(CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    uri = F.regexp_replace("url", r"[\r\n]", "%0A")
    record = F.concat(
        F.lit(MAGIC.decode()),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", page("page_id")),
        F.coalesce(header("WARC-Target-URI", uri), F.lit("")),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32_of_sha1(F.col("sha1")))),
        F.when(revisit, F.concat(header("WARC-Refers-To", page("refers_to")), header("WARC-Profile", F.lit(PROFILE))))
         .otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block)
    for k in sorted(present):   # few classes, mostly one
        (p.filter(size_class == k).select(record.alias("value")).write.option("lineSep", RECORD_END)
         .option("maxRecordsPerFile", per_file[k]).text(f"{path}/size{k}"))


_FIELD = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")

CANDIDATE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("successor", T.LongType()),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("intact", T.BooleanType())])


def _page(field: bytes | None) -> int | None:
    m = _PAGE.match(field or b"")
    return int(m[1]) if m else None


def candidates(file: str, content: bytes) -> Iterator[tuple]:
    """Every place where a record may start, with the offset at which its successor would."""
    at = content.find(MAGIC)
    while at >= 0:
        end = content.find(b"\r\n\r\n", at)
        fields = {k.lower(): v for k, v in _FIELD.findall(content, at, end + 2)} if end >= 0 else {}
        length = fields.get(b"content-length", b"")
        if length.isdigit() and len(length) < 16:
            start = end + 4
            stop = start + int(length)
            head = content.find(b"\r\n\r\n", start, stop)
            inner = {k.lower(): v for k, v in _FIELD.findall(content, start, head + 2)} if head >= 0 else {}
            size = inner.get(b"content-length", b"")
            digest = fields.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode("latin-1")
            kind = fields.get(b"warc-type", b"").decode("latin-1")
            intact = True
            if kind == "response":
                payload = content[head + 4:stop] if head >= 0 else content[start:stop]
                size = str(len(payload)).encode()
                intact = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
            url = fields.get(b"warc-target-uri")
            yield (file, at, stop + len(RECORD_END), _page(fields.get(b"warc-record-id")),
                   None if url is None else url.decode("utf-8", "replace"),
                   int(size) if size.isdigit() else None, digest, kind, _page(fields.get(b"warc-refers-to")), intact)
        at = content.find(MAGIC, at + 1)


def reachable(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which of the candidates (sorted by offset) lie on the chain from offset 0, by pointer jumping."""
    n = len(offsets)
    at = np.searchsorted(offsets, successors)
    jump = np.append(np.where(offsets[np.minimum(at, n - 1)] == successors, at, n), n)  # n: the end, its own successor
    mark = np.zeros(n + 1, dtype=bool)
    mark[0] = n > 0 and offsets[0] == 0
    for _ in range(n.bit_length() + 1):
        mark[jump[mark]] = True
        jump = jump[jump]
    return mark[:n]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = CANDIDATE.fieldNames()
    for b in batches:
        for file, content in zip(b["path"], b["content"]):
            found = pd.DataFrame(list(candidates(file, bytes(content))), columns=names)
            yield found.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def _chain(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.astype({f.name: object for f in CANDIDATE if f.dataType == T.StringType()})
    rows = rows.sort_values("offset", kind="stable")
    return rows[reachable(rows["offset"].to_numpy(), rows["successor"].to_numpy())]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: file, offset, successor, page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, and whether a response's payload has its digest."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
             .load(path).select("path", "content"))
    rows = files.mapInPandas(_scan, CANDIDATE)
    return rows.groupBy("file").applyInPandas(_chain, CANDIDATE)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
