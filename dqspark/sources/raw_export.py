"""``raw_export``: raw text files as a Spark data source, in byte ranges.

``spark.read.format("raw_export").load(folder)`` gives a row per line:
``origin`` (file name), ``start`` (first byte of the range that read it),
``nr`` (byte at which the line begins) and ``raw`` (its bytes, without the line
break).  Lines end at ``\\n``, ``\\r\\n`` or ``\\r``.  A file of any size is read
by as many tasks as it has ranges of ``splitBytes``; a line belongs to the range
in which it begins, so ranges need to know nothing of each other.

``spark.readStream`` reads files as they land.  Each look at the folder that
finds new files adds an entry to a log (option ``log``, a shared folder); the
stream's offset is the number of entries, so it stays small however many files
there are, and a batch that is run again reads the same ranges.  A file belongs
to one entry, thus to one batch; files must be complete when they appear.

Options: ``path``; ``glob`` (of file names, default ``*``); ``splitBytes``;
``originPattern`` (of the decoded path, its first group is the origin); ``log``.
Files whose names begin with ``_`` or ``.`` are left out; empty files have no
lines.  Only names and sizes reach the driver.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "raw_export"
SCHEMA = "origin string, start long, nr long, raw binary"
SPLIT_BYTES = 32 << 20      # without a session's spark.sql.files.maxPartitionBytes
CHUNK = 1 << 16             # bytes read at first to finish the last line of a range
ROWS = 10000                # lines handed to Spark at once
ORIGIN = "([^/]+)$"
CR, LF = 13, 10


@dataclass
class Range(InputPartition):
    path: str
    origin: str
    begin: int
    end: int


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or local path."""
    return fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "/", path))


def listed(path: str, glob: str = "*", pattern: str = ORIGIN) -> list[tuple[str, str, int]]:
    """``(path, origin, bytes)`` of the matching files below a folder."""
    where, root = store(path)
    found = where.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    out = []
    for f in found:
        name = f.path.rpartition("/")[2]
        if f.type == fs.FileType.File and name[0] not in "_." and fnmatch.fnmatch(name, glob):
            origin = re.search(pattern, unquote(f.path))
            out.append((f.path, origin.group(1) if origin else name, f.size))
    return sorted(out)


def ranges(files: list[tuple[str, str, int]], split: int) -> list[Range]:
    return [Range(p, o, k, min(k + split, size)) for p, o, size in files for k in range(0, size, split)]


def line_starts(data: np.ndarray) -> np.ndarray:
    """Whether a line begins at each byte but the first."""
    before, here = data[:-1], data[1:]
    return (before == LF) | ((before == CR) & (here != LF))


def lines_of(source, begin: int, end: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the lines that begin in ``begin..end``, their bytes without line breaks as n + 1 offsets and data.

    Beyond ``end`` as much is read as the last line needs.
    """
    base = max(0, begin - 1)
    source.seek(base)
    raw = source.read(end - base + 1)       # one more byte: \r and \n are one break
    while True:
        data = np.frombuffer(raw, np.uint8)
        starts = np.flatnonzero(line_starts(data)) + 1 if len(data) else np.zeros(0, np.int64)
        if begin == 0 and len(data):
            starts = np.concatenate([[0], starts])
        if len(starts) and base + starts[-1] >= end:
            break
        more = source.read(chunk)
        if not more:
            break
        raw, chunk = raw + more, 2 * chunk
    stops = np.append(starts[1:], len(data))
    own = base + starts < end
    starts, stops = starts[own], stops[own]
    if not len(starts):
        return starts, np.zeros(1, np.int32), data[:0]
    last = data[stops - 1]
    ended = (last == LF) | (last == CR)
    both = (last == LF) & (stops - starts > 1) & (data[stops - 2] == CR)
    keep = np.ones(len(data), bool)
    keep[(stops - 1)[ended]] = False
    keep[(stops - 2)[both]] = False
    offsets = np.concatenate([[0], np.cumsum(stops - starts - ended - both)]).astype(np.int32)
    whole = slice(starts[0], stops[-1])
    return base + starts, offsets, data[whole][keep[whole]]


def read_range(part: Range, folder: str) -> Iterator[pa.RecordBatch]:
    where, _ = store(folder)
    with where.open_input_file(part.path) as source:
        at, offsets, data = lines_of(source, part.begin, part.end)
    raw = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    for k in range(0, len(at), ROWS):
        n = min(ROWS, len(at) - k)
        yield pa.RecordBatch.from_arrays([pa.array([part.origin] * n, pa.string()), pa.array(np.full(n, part.begin)),
                                          pa.array(at[k:k + n]), raw.slice(k, n)], names=["origin", "start", "nr", "raw"])


class RawExport(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RawReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RawStream(self.options)


class _Options:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.glob, self.pattern = options.get("glob", "*"), options.get("originPattern", ORIGIN)
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.log = options.get("log")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition, self.path)


class RawReader(_Options, DataSourceReader):
    def partitions(self) -> list[Range]:
        return ranges(listed(self.path, self.glob, self.pattern), self.split) or [Range("", "", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition, self.path) if partition.end else iter(())


class RawStream(_Options, DataSourceStreamReader):
    def __init__(self, options: dict):
        super().__init__(options)
        if not self.log:
            raise ValueError("option log: a shared folder for the files of each batch")
        self.where, self.root = store(self.log)
        self.where.create_dir(self.root, recursive=True)

    def _entries(self) -> list[str]:
        found = self.where.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        return sorted(f.path for f in found if re.fullmatch(r"\d{12}\.json", f.path.rpartition("/")[2]))

    def _files(self, entry: str) -> list[tuple[str, str, int]]:
        with self.where.open_input_file(entry) as f:
            return [tuple(x) for x in json.loads(f.read())]

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        entries = self._entries()
        seen = {path for e in entries for path, _, _ in self._files(e)}
        new = [f for f in listed(self.path, self.glob, self.pattern) if f[0] not in seen]
        if new:
            name = f"{self.root}/{len(entries):012d}.json"
            with self.where.open_output_stream(f"{name}.tmp") as f:
                f.write(json.dumps(new).encode())
            self.where.move(f"{name}.tmp", name)
        return {"entries": len(entries) + bool(new)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        files = [f for e in self._entries()[start["entries"]:end["entries"]] for f in self._files(e)]
        return ranges(files, self.split)

    def commit(self, end: dict) -> None:
        """Nothing is kept beyond the log."""


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(RawExport)


def split_bytes(spark: SparkSession, split: int | None = None) -> int:
    """``split``, or the session's ``spark.sql.files.maxPartitionBytes``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return split or int(number) << " kmgt".index(unit or " ") * 10


def load(spark: SparkSession, folder: str, glob: str = "*", pattern: str = ORIGIN, split: int | None = None) -> DataFrame:
    """The lines of a folder's files."""
    register(spark)
    return (spark.read.format(NAME).option("glob", glob).option("originPattern", pattern)
            .option("splitBytes", split_bytes(spark, split)).load(folder))


def load_stream(spark: SparkSession, folder: str, log: str, glob: str = "*", pattern: str = ORIGIN,
                split: int | None = None) -> DataFrame:
    """The lines of files as they land; ``log`` is the shared folder of the stream's entries."""
    register(spark)
    return (spark.readStream.format(NAME).option("glob", glob).option("originPattern", pattern)
            .option("splitBytes", split_bytes(spark, split)).option("log", log).load(folder))
