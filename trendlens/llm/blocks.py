"""Blocks of documents: compressed, so that a shuffle-free join can bring results back to texts.

A block is what one task reads, up to about ``BLOCK_BYTES`` of text. It stands in
several rows of about ``ROW_BYTES`` of text each, as large values are dear to the
JVM. The table of blocks is bucketed by their number: steps that group by it, or
cogroup it with what was computed for its documents elsewhere, shuffle only that,
never the texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from .memory import tidy
from .text_kernels import chunks

BLOCK_BYTES = 16 << 20
ROW_BYTES = 1 << 19


def text_offsets(column: pa.Array) -> np.ndarray:
    """Where the texts of a string column begin, in bytes, with the end; without a copy of the texts."""
    if not len(column):
        return np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def _packed(parts: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for p in parts:
            out.write_batch(p)
    return sink.getvalue().to_pybytes()


def unpacked(rows: pa.Table) -> pa.Table:
    """A block's documents, in their order, from its rows (``first, blob``)."""
    blobs = rows.sort_by("first")["blob"]
    return pa.concat_tables([pa.ipc.open_stream(blob.as_py()).read_all() for blob in blobs])


def _pack(size: int, row_size: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, block_bytes, held, held_bytes = TaskContext.get().partitionId() << 32, 0, 0, [], 0

        def row():
            n = sum(map(len, held))
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([first], pa.int32()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays([p.column(0) for p in held])),
                pa.array([_packed(held)], type=pa.binary())], names=["block", "first", "ids", "blob"]), n

        for batch in batches:
            offsets = text_offsets(batch.column(1))
            for a, b in chunks(offsets, row_size):
                held.append(batch.slice(a, b - a))
                held_bytes += int(offsets[b] - offsets[a])
                if held_bytes >= row_size or sum(map(len, held)) >= 10_000:
                    out, n = row()
                    yield out
                    first, block_bytes, held, held_bytes = first + n, block_bytes + held_bytes, [], 0
                    if block_bytes >= size:
                        number, first, block_bytes = number + 1, 0, 0
        if held:
            yield row()[0]
    return tidy(emit)


def blocks(docs: DataFrame, keep: list[str], size: int = BLOCK_BYTES, row_size: int = ROW_BYTES) -> DataFrame:
    """``block, first, ids, blob``: the documents with columns ``doc_id`` (long), ``text``, ``lang``, and ``row`` (a struct of ``keep`` without the text)."""
    spark = docs.sparkSession
    rest = [F.col(f"`{c}`") for c in keep if c != "text"]
    row = F.struct(*rest) if rest else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), row.alias("row"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"trendlens_{uuid.uuid4().hex}"
    rows.mapInArrow(_pack(size, row_size), "block long, first int, ids array<long>, blob binary").write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay until the scratch folder goes
    return found


def positions(table: DataFrame) -> DataFrame:
    """``block, pos, doc_id`` of every document; ``pos`` is its place in the block."""
    return table.select("block", "first", F.posexplode("ids").alias("at", "doc_id")).select("block", (F.col("first") + F.col("at")).alias("pos"), "doc_id")
