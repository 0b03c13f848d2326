"""Operator 6, WARC archives through a chunked record table.

A record is never held whole: its payload travels as rows (record, chunk number, bytes) of bounded size, with a digest
that runs along. The writer gets such rows, cut by the scan, and streams them into archive files; the reader streams the
files back into a table of chunks, each of which carries the digest of all payload bytes up to its end. The last chunk of
a record therefore has its full length and digest, and nothing needs to be grouped.

Archives are files in the shared folder. A task writes files of its own attempt and reports the spans of whole records
it has finished, so a lost or repeated task leaves at most files that no span names. Readers take spans, not files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entryclime.session import scratch_path, write_stage

CHUNK_BYTES = 1 << 20
SPAN_BYTES = 32 << 20
FILE_BYTES = 1 << 30
#: Reading tasks at most; a task takes its spans one after the other.
MAX_READERS = 20_000
#: Payloads shorter than this are always written in full.
REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
#: Fixed value: the standard's profile of a record whose payload is that of an earlier one.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:page:"


def _headers(row: dict) -> bytes:
    revisit = row["record_type"] == "revisit"
    fields = [("WARC-Type", row["record_type"]),
              ("WARC-Record-ID", f"<{_PAGE}{'' if row['page_id'] is None else row['page_id']}>"),
              ("WARC-Target-URI", quote(row["url"] or "", safe="%/:=&?~#+!$,;'@()*[]")), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha256:{row['digest']}")]
    if revisit:
        refers = "" if row["refers_to"] is None else row["refers_to"]
        fields += [("WARC-Refers-To", f"<{_PAGE}{refers}>"), ("WARC-Profile", PROFILE),
                   ("X-Payload-Length", str(row["payload_bytes"]))]
    fields += [("Content-Type", "text/html; charset=utf-8"),
               ("Content-Length", "0" if revisit else str(row["payload_bytes"]))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def records(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_bytes, digest, record_type, refers_to``: which pages are written as revisits.

    Of equal payloads of at least ``REVISIT_BYTES`` the smallest page id is the response. Of rows that repeat that page
    one is the response and the others revisit it.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("digest"))
    facts = write_stage(rows.select("page_id", "payload_bytes", F.unhex("digest").alias("sha")), "warc_facts")
    groups = write_stage(
        facts.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("sha")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("_first")).where("_n > 1")
        .withColumnRenamed("sha", "_sha"), "warc_groups")
    shared = write_stage(
        facts.join(groups, F.col("sha") == F.col("_sha")).groupBy("page_id", "sha")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("_first").alias("_first")), "warc_shared")
    again = shared.select(F.col("page_id").alias("_again"), F.lower(F.hex("sha")).alias("_digest"), "_first", "_copies")
    marked = rows.join(again, F.col("page_id").eqNullSafe(F.col("_again")) & (F.col("digest") == F.col("_digest")), "left")
    copy = F.lit(1)
    if not shared.where("_copies > 1 AND page_id <=> _first").isEmpty():
        copy = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy(F.lit(1)))
    marked = marked.withColumn("_copy", copy)
    revisit = F.col("_copies").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("_first")) | (F.col("_copy") > 1))
    return marked.select("page_id", "url", "html", "payload_bytes", "digest",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("_first")).alias("refers_to"))


def chunked(record_rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of records to write: their columns with ``chunk_no, chunks, data`` in place of the payload.

    A record has at least one chunk; a revisit's only chunk is empty.
    """
    whole = F.when(F.col("record_type") == "response", F.col("html")).otherwise(F.lit("").cast("binary"))
    size = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    chunks = F.greatest(F.lit(1), F.ceil(size / chunk_bytes)).cast("int")
    cut = (record_rows.withColumn("chunks", chunks)
           .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    return cut.select("page_id", "url", "payload_bytes", "digest", "record_type", "refers_to", "chunk_no", "chunks",
                      F.substring(whole, F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"))


def write_archives(chunk_rows: DataFrame, folder: str) -> DataFrame:
    """Stream chunk rows (of a record together and in order) into WARC files; the written spans of whole records:
    ``path, start, stop, records``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        spans, out, path, at, start, count, files = [], None, "", 0, 0, 0, 0
        digest = hashlib.sha256()
        for batch in batches:
            names = batch.schema.names
            for values in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
                row = {k: v.as_py() for k, v in zip(names, values, strict=True)}
                if out is None:
                    path, at, start, count = f"{stem}-{files:04d}.warc", 0, 0, 0
                    out, files = system.open_output_stream(path), files + 1
                if row["chunk_no"] == 0:
                    digest = hashlib.sha256()
                    at += out.write(_headers(row))
                digest.update(row["data"])
                at += out.write(row["data"])
                if row["chunk_no"] == row["chunks"] - 1:
                    if row["record_type"] == "response" and digest.hexdigest() != row["digest"]:
                        raise ValueError(f"the chunks of page {row['page_id']} are not its payload")
                    at += out.write(b"\r\n\r\n")
                    count += 1
                    if at - start >= SPAN_BYTES:
                        spans.append((path, start, at, count))
                        start, count = at, 0
                    if at >= FILE_BYTES:
                        if count:
                            spans.append((path, start, at, count))
                        out.close()
                        out = None
        if out is not None:
            if count:
                spans.append((path, start, at, count))
            out.close()
        if spans:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*spans, strict=True), [pa.string(), pa.int64(), pa.int64(), pa.int64()],
                                                strict=True)], ["path", "start", "stop", "records"])

    return chunk_rows.mapInArrow(run, "path string, start long, stop long, records long")


CHUNKS = ("page_id long, record_type string, refers_to long, declared_bytes long, declared_digest string, "
          "chunk_no long, data binary, bytes_so_far long, digest_so_far string, last boolean")


def read_archives(spans: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of written spans (``CHUNKS``); a record without payload bytes has one empty chunk."""
    def number(value: str | None) -> int | None:
        digits = (value or "").strip("<>").removeprefix(_PAGE)
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(),
                 pa.string(), pa.bool_()]
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)],
                                              names)

        for b in batches:
            for path, start, stop, _ in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                with system.open_input_file(path) as raw:
                    for row in _records(raw, start, stop, chunk_bytes, number):
                        held.append(row)
                        size += len(row[6]) + 300
                        if size > 8 << 20:
                            yield batch()
                            held, size = [], 0
        if held:
            yield batch()

    # A number of partitions of its own: span rows are tiny, and sized by their bytes they would share one task.
    return spans.repartition(min(MAX_READERS, max(1, spans.count()))).mapInArrow(run, CHUNKS)


def _records(raw: pa.NativeFile, start: int, stop: int, chunk_bytes: int, number) -> Iterator[tuple]:
    """Chunk rows of the records between two positions, reading at most a chunk (and a header) at a time."""
    raw.seek(start)
    buffer, left = b"", stop - start

    def fill() -> bool:
        nonlocal buffer, left
        got = raw.read(min(chunk_bytes, left)) if left else b""
        buffer, left = buffer + got, left - len(got)
        return bool(got)

    while left or buffer:
        while b"\r\n\r\n" not in buffer:
            if not fill():
                raise ValueError("a record header is cut off")
        head, _, buffer = buffer.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]}")
        fields = dict(line.split(": ", 1) for line in lines)
        body, kind = int(fields["Content-Length"]), fields["WARC-Type"]
        declared = int(fields["X-Payload-Length"]) if kind == "revisit" else body
        fixed = (number(fields["WARC-Record-ID"]), kind, number(fields.get("WARC-Refers-To")) if kind == "revisit" else None,
                 declared, fields["WARC-Payload-Digest"].removeprefix("sha256:"))
        digest, done, chunk = hashlib.sha256(), 0, 0
        while True:
            while len(buffer) < min(chunk_bytes, body - done) and fill():
                pass
            data = buffer[:min(chunk_bytes, body - done)]
            if len(data) < min(chunk_bytes, body - done):
                raise ValueError("a payload is cut off")
            buffer = buffer[len(data):]
            digest.update(data)
            done += len(data)
            yield (*fixed, chunk, data, done, digest.hexdigest(), done == body)
            chunk += 1
            if done == body:
                break
        while len(buffer) < 4 and fill():
            pass
        if buffer[:4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        buffer = buffer[4:]


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per page and read the archives back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Length and digest of a response are those of the bytes read; a revisit has those its record states. A null html is
    an empty payload, a null url an empty address; null ids come back as null. Repeated rows are records of their own;
    an empty table gives none. Other columns are not read.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    spans = write_stage(write_archives(chunked(records(pages)), folder), "warc_spans")
    chunks = read_archives(spans, folder)
    revisit = F.col("record_type") == "revisit"
    return chunks.where("last").select(
        "page_id", F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type", "refers_to")
