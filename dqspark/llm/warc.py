"""WARC archives with the index first: write records, then read chosen ones by byte range.

``write_archives`` writes each row as one gzip member (a response record, or a
revisit record that names the response with the same payload) and returns the
index: file, offset, length, URL, digest.  ``read_records`` sorts the chosen
index rows by file and offset, joins neighbouring byte ranges into one read
and parses the records from the bytes.

Archives go to the shared folder through ``pyarrow.fs``, each under the id of
the task attempt that wrote it, so the index, itself a written table, names
only complete archives of attempts that succeeded; a rerun of a lost task
writes new files.

Defined results: a null html is an empty payload; a null url leaves out the
target URI; rows without a page_id are responses of their own; equal rows
(same page_id and payload) are each a response; an empty table gives empty
results; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import materialize, prepare, shuffle_partitions
from dqspark.session import scratch_dir

MAX_FILE = 1 << 30          # a new archive is begun beyond this many bytes
MAX_READ = 8 << 20          # one coalesced read takes at most about this many bytes
MAX_GAP = 64 << 10          # unwanted bytes read rather than seeking again

INDEX = ("page_id long, url string, file string, offset long, length long, "
         "digest string, record_type string, refers_to long")
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string")
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(uri: str):
    tail = uri.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def encode_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header and leaves the payload out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        safe = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def decode_record(raw: bytes) -> dict:
    """Headers and payload of one record; the payload's digest is checked for responses."""
    head, _, rest = raw.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(CRLF + CRLF)
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length: "))
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = field["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"payload of {field['WARC-Record-ID']} doesn't match its digest")
    refers = page_of(field["WARC-Refers-To"]) if kind == "revisit" else None
    return {"page_id": page_of(field["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": refers, "url": field.get("WARC-Target-URI"), "payload": payload}


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def _writer(folder: str):
    names = [f.strip().split(" ")[0] for f in INDEX.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx, out, at, number, uri = TaskContext.get(), None, 0, 0, ""
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= MAX_FILE:
                        if out is not None:
                            out.close()
                        uri = f"{folder}/part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}-{number}.warc.gz"
                        store, path = _open(uri)
                        store.create_dir(path.rpartition("/")[0], recursive=True)
                        out, at, number = store.open_output_stream(path, compression=None), 0, number + 1
                    payload = (html or "").encode()
                    member = gzip.compress(encode_record(page_id, url, payload, refers), 1, mtime=0)
                    out.write(member)
                    rows.append((page_id, url, uri, at, len(member), digest_of(payload),
                                 "response" if refers is None else "revisit", refers))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], SCHEMA_INDEX)
        finally:
            if out is not None:
                out.close()
    return run


_TYPES = {"long": pa.int64(), "string": pa.string()}
SCHEMA_INDEX = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in INDEX.split(",")])
SCHEMA_RECORD = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in RECORD.split(",")])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html`` rows as archives below ``folder``; returns the index."""
    rows = pages.select("page_id", "url", "html",
                        F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("same"))
    repeated = materialize(rows.groupBy("same").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
                           .where("n > 1 and keeper is not null").select("same", "keeper"), "warc-repeated")
    refers = F.when(F.col("page_id") != F.col("keeper"), F.col("keeper"))
    marked = rows.join(repeated, "same", "left").select("page_id", "url", "html", refers.alias("refers_to"))
    return materialize(marked.mapInArrow(_writer(folder), INDEX), "warc-index")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, path, source, open_uri = None, "", None, None
    run: list[tuple[int, int, str | None]] = []
    run_file = None

    def fetch():
        nonlocal source, open_uri
        if open_uri != run_file:
            if source is not None:
                source.close()
            store, path = _open(run_file)
            source, open_uri = store.open_input_file(path), run_file
        begin, end = run[0][0], max(o + n for o, n, _ in run)
        blob = source.read_at(end - begin, begin)
        # a record's own url is escaped, the index has it as given
        found = [decode_record(zlib.decompress(blob[o - begin:o - begin + n], 31)) | {"url": url} for o, n, url in run]
        for r in found:
            del r["payload"]
        return pa.RecordBatch.from_pylist(found, SCHEMA_RECORD)

    for batch in batches:
        for uri, offset, length, url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run and (uri != run_file or offset - (run[-1][0] + run[-1][1]) > MAX_GAP
                        or offset + length - run[0][0] > MAX_READ):
                yield fetch()
                run = []
            run_file = uri
            run.append((offset, length, url))
    if run:
        yield fetch()
    if source is not None:
        source.close()


def read_records(index: DataFrame) -> DataFrame:
    """Read the records of the given index rows by coalesced byte ranges."""
    spark = index.sparkSession
    chunk = F.floor(F.col("offset") / (4 * MAX_READ))
    dealt = (index.select("file", "offset", "length", "url")
             .repartition(shuffle_partitions(spark), F.col("file"), chunk)
             .sortWithinPartitions("file", "offset"))
    return dealt.mapInArrow(_reader, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page, read every record back."""
    spark = pages.sparkSession
    prepare(spark)
    return read_records(write_archives(pages, scratch_dir(spark, "warc")))


def read_payload(raw: bytes) -> bytes:
    """The payload of one compressed record (for direct use and tests)."""
    with gzip.GzipFile(fileobj=io.BytesIO(raw)) as f:
        return decode_record(f.read())["payload"]


ORACLE = r"""
select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, url,
  (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (('0x' || substr(sha1(coalesce(html, '')), 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8)) & 31)::int + 1, 1), '' order by i)
     from range(32) t(i)) as payload_digest,
  case when keeper <> page_id then 'revisit' else 'response' end as record_type,
  case when keeper <> page_id then keeper end as refers_to
from (select *, max(page_id) over (partition by coalesce(html, '')) as keeper from pages)
"""
