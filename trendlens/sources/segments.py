"""Zipped segments as a Spark data source, batch (S6) and stream.

``spark.read.format("trendlens_segments")`` gives the lines of the first entry
of each zip: ``path, line_no, value`` and, with ``layout``, the segment's number
of lines and its first record id. Files are packed into partitions by size. An
entry is unzipped and decoded as it is read (malformed UTF-8 bytes are dropped;
``\\n``, ``\\r`` and ``\\r\\n`` end a line) and handed on in bounded batches, so a
task's memory doesn't grow with the segment; with ``layout`` it is read twice,
the first time to count. ``start`` and ``end`` (inclusive stamps) cut the listing
before any file is opened.

As a stream, the offset is the name of the last segment read: names ascend with
time, so only files named later are new, and none is read twice.

Files are opened through pyarrow's file systems (local or mounted paths, ``file``,
``hdfs``, ``s3``, ``gs``), in the tasks.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "trendlens_segments"
SCHEMA = "path string, line_no long, value string, n_lines long, first_id string"
_ARROW = pa.schema([("path", pa.string()), ("line_no", pa.int64()), ("value", pa.string()), ("n_lines", pa.int64()), ("first_id", pa.string())])
#: Bytes of zip files that a task reads, and characters and lines of a batch that it hands on.
PARTITION_BYTES = 64 << 20
BATCH_CHARS = 1 << 20
BATCH_LINES = 1 << 16


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (arrow_fs.LocalFileSystem(), path)


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def listing(path: str, pattern: str = "*.zip", start: str | None = None, end: str | None = None, after: str = "", upto: str | None = None) -> list[tuple[str, int]]:
    """Path and size of the segments in a folder, or of the one or several that a path or a pattern names, by name.

    ``start`` and ``end`` bound the stamp that a name begins with, ``after`` and ``upto`` the whole name.
    """
    base, _, last = path.rstrip("/").rpartition("/")
    if re.search(r"[*?\[]", last):
        path, pattern = base or "/", last
    files, at = _open(path)
    info = files.get_file_info(at)
    found = [info] if info.type == arrow_fs.FileType.File else files.get_file_info(arrow_fs.FileSelector(at)) if info.type == arrow_fs.FileType.Directory else []
    scheme = path[:len(path) - len(at)] if path.endswith(at) else ""
    kept = []
    for f in found:
        stamp = re.match(r"\d*", f.base_name)[0]
        if (f.type == arrow_fs.FileType.File and fnmatch(f.base_name, pattern) and (not start or stamp >= start) and (not end or stamp[:len(end)] <= end)
                and f.base_name > after and (upto is None or f.base_name <= upto)):
            kept.append((scheme + f.path, f.size))
    return sorted(kept, key=lambda x: _name(x[0]))


def _text(path: str, zipped: zipfile.ZipFile) -> io.TextIOWrapper | None:
    names = zipped.namelist()
    return io.TextIOWrapper(zipped.open(names[0]), encoding="utf-8", errors="ignore", newline=None) if names else None


def segment_batches(path: str, layout: bool) -> Iterator[pa.RecordBatch]:
    """The lines of a segment in bounded batches."""
    files, at = _open(path)
    with files.open_input_file(at) as raw, zipfile.ZipFile(io.BufferedReader(_Reader(raw))) as zipped:
        n, first = None, None
        if layout:
            lines = _text(path, zipped)
            if lines is None:
                return
            with lines:
                n, first = 0, ""
                for line in lines:
                    if not n:
                        first = line.rstrip("\n").split("\t", 1)[0]
                    n += 1
        lines = _text(path, zipped)
        if lines is None:
            return
        with lines:
            done, held, chars = 0, [], 0

            def batch():
                k = len(held)
                return pa.RecordBatch.from_arrays([pa.array([path] * k), pa.array(range(done, done + k), pa.int64()), pa.array(held, pa.string()),
                                                   pa.array([n] * k, pa.int64()), pa.array([first] * k, pa.string())], schema=_ARROW)

            for line in lines:
                held.append(line.rstrip("\n"))
                chars += len(line)
                if chars > BATCH_CHARS or len(held) >= BATCH_LINES:
                    yield batch()
                    done, held, chars = done + len(held), [], 0
            if held:
                yield batch()


class _Reads:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.layout = str(options.get("layout", "false")).lower() == "true"
        self.bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.cut = {k: options[k] for k in ("pattern", "start", "end") if options.get(k)}

    def packed(self, files: list[tuple[str, int]]) -> list[Files]:
        """Files in order, about ``bytes`` together."""
        parts, held, size = [], [], 0
        for path, n in files:
            if held and size + n > self.bytes:
                parts.append(_files(held))
                held, size = [], 0
            held.append(path)
            size += n
        return parts + ([_files(held)] if held else [])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            yield from segment_batches(path, self.layout)


def _files(paths: list[str]) -> Files:
    return Files(tuple(paths))


class SegmentReader(_Reads, DataSourceReader):
    def partitions(self) -> list[Files]:
        return self.packed(listing(self.path, **self.cut)) or [_files([])]


class SegmentStreamReader(_Reads, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"name": ""}

    def latestOffset(self) -> dict:
        files = listing(self.path, **self.cut)
        return {"name": _name(files[-1][0]) if files else ""}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return self.packed(listing(self.path, **self.cut, after=start["name"], upto=end["name"]))


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)

    def streamReader(self, schema) -> SegmentStreamReader:
        return SegmentStreamReader(self.options)


def _options(reader, layout: bool, start: str | None, end: str | None, partition_bytes: int):
    reader = reader.format(NAME).option("layout", str(layout).lower()).option("partitionBytes", str(partition_bytes))
    for k, v in (("start", start), ("end", end)):
        if v:
            reader = reader.option(k, v)
    return reader


def read_segments(spark: SparkSession, path: str, layout: bool = False, start: str | None = None, end: str | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The lines of the segments that ``path`` (a folder, a file or a pattern) names."""
    spark.dataSource.register(SegmentSource)
    return _options(spark.read, layout, start, end, partition_bytes).load(path)


def follow_segments(spark: SparkSession, path: str, start: str | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The lines of new segments as a stream, with their layout; a trigger takes all that are named after the last one read."""
    spark.dataSource.register(SegmentSource)
    return _options(spark.readStream, True, start, None, partition_bytes).load(path)


def write_segments(records: DataFrame, path: str, segment_col: str = "segment", order_col: str = "line_no", value_col: str = "value") -> DataFrame:
    """Records as zipped segments ``path/<segment>.zip`` of one entry, lines in order; returns ``segment, lines``.

    A segment is one file, written by one task through pyarrow's file systems.
    """
    def write(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order_col)
        name = rows[segment_col][0].as_py()
        files, at = _open(path)
        files.create_dir(at)
        with files.open_output_stream(f"{at}/.{name}.part") as raw:
            with zipfile.ZipFile(io.BufferedWriter(_Writer(raw)), "w", zipfile.ZIP_DEFLATED) as zipped:
                with zipped.open(name, "w") as entry:
                    for batch in rows.select([value_col]).to_batches(max_chunksize=BATCH_LINES):
                        entry.write("".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode())
        files.move(f"{at}/.{name}.part", f"{at}/{name}.zip")
        return pa.table({"segment": [name], "lines": pa.array([len(rows)], pa.int64())})

    return records.select(segment_col, order_col, value_col).groupBy(segment_col).applyInArrow(write, "segment string, lines long")


class _Reader(io.RawIOBase):
    """A file of pyarrow as a raw file: a seek before its start is an ``OSError``, which ``zipfile`` expects."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


class _Writer(io.RawIOBase):
    """An output stream of pyarrow as a raw file."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)
