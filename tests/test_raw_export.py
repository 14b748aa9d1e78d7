"""The raw_export data source: byte ranges, streams, and quoted cells across ranges."""

import io
import random
import re

import pytest

from dqspark.sources import ingest, raw_export
from dqspark.streaming import incremental
from tests.test_ingest import HEADER, ROW


def plain_lines(data: bytes):
    out, at = [], 0
    for m in re.finditer(rb"\r\n|\n|\r", data):
        out.append((at, data[at:m.start()]))
        at = m.end()
    return out + ([(at, data[at:])] if at < len(data) else [])


def test_ranges_read_every_line_once():
    rnd = random.Random(3)
    for _ in range(400):
        data = b"".join(rnd.choice([b"a", b"bc", b"\n", b"\r", b"\r\n", b"\n\n", b"", b"long" * 5]) for _ in range(rnd.randrange(30)))
        split, chunk = rnd.choice([1, 2, 3, 7, 1000]), rnd.choice([1, 2, 5, 1000])
        got = []
        for k in range(0, len(data), split):
            at, offsets, raw = raw_export.lines_of(io.BytesIO(data), k, min(k + split, len(data)), chunk)
            raw = raw.tobytes()
            got += [(int(p), raw[a:b]) for p, a, b in zip(at, offsets[:-1], offsets[1:], strict=True)]
        assert got == plain_lines(data), (data, split, chunk)


def led(ing):
    return sorted(map(tuple, ing.ledger.collect()), key=repr)


def kept(ing):
    return sorted((r["origin"], sorted(r["data"].items())) for r in ing.rows.collect())


@pytest.fixture
def folder(tmp_path):
    def make(files, name="in"):
        (tmp_path / name).mkdir(exist_ok=True)
        for k, v in files.items():
            (tmp_path / name / k).write_bytes(v)
        return str(tmp_path / name)
    return make


def exports(n=60):
    quoted = ROW.replace("CALLE 1", '"CALLE ""1""\nPISO;2\n\nFIN"')
    body = [quoted.replace("0001", f"{i:04d}") if i % 7 == 0 else ROW.replace("0001", f"{i:04d}") for i in range(n)]
    return {"a.csv": "\r\n".join(["junk", HEADER, *body, "Total;1"]).encode("cp1252"),
            "b.csv": ("﻿" + "\n".join([HEADER, *body])).encode(),
            "open.csv": "\n".join([HEADER, *body, ROW.replace("CALLE 1", '"CALLE'), ROW]).encode()}


def test_quoted_cells_across_many_ranges(spark, folder):
    """One range or many: the same ledger and rows; an open quote is an error row."""
    path = folder(exports())
    whole = ingest.ingest(ingest.read_landing(spark, path))
    rows, ledger = kept(whole), led(whole)
    assert len(rows) == 120 and dict(rows[0][1])["DIRECCION"] == 'CALLE "1"\nPISO;2\n\nFIN'
    assert {r["origin"]: r["status"] for r in whole.ledger.collect()}["open.csv"] == "Error: a quote is left open"
    landing = ingest.read_landing(spark, path, split=97)
    assert landing.lines.rdd.getNumPartitions() > 100
    many = ingest.ingest(landing)
    assert kept(many) == rows and led(many) == ledger


def test_stream_loads_each_file_once_and_survives_a_killed_batch(spark, folder, tmp_path, monkeypatch):
    from pyspark.errors import StreamingQueryException
    files = exports(20)
    path, out, ckpt = folder({"a.csv": files["a.csv"]}), str(tmp_path / "out"), str(tmp_path / "ckpt")
    incremental.ingest_stream(spark, path, out, ckpt, split=200)
    folder({"b.csv": files["b.csv"], "open.csv": files["open.csv"]})
    writer = type(spark.range(1).write)
    real = writer.parquet

    def killed(self, where, *args, **kw):
        real(self, where, *args, **kw)
        if "/rows/batch=1" in where:
            raise RuntimeError("killed after the rows")
    monkeypatch.setattr(writer, "parquet", killed)
    with pytest.raises((StreamingQueryException, RuntimeError)):
        incremental.ingest_stream(spark, path, out, ckpt, split=200)
    monkeypatch.setattr(writer, "parquet", real)
    incremental.ingest_stream(spark, path, out, ckpt, split=200)
    incremental.ingest_stream(spark, path, out, ckpt, split=200)       # nothing new
    got, batch = incremental.ingested(spark, out), ingest.ingest(ingest.read_landing(spark, path))
    assert kept(got) == kept(batch) and led(got) == led(batch)
    assert ingest.strict_union(got).count() == 40
