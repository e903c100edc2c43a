"""Token ids in Parquet list columns, for selective reads of tokens and metadata.

Files hold ``part, pos, doc_id, n_tokens, ids`` in ascending ``doc_id`` order
across and within files. ``ids`` is dictionary-encoded (a vocabulary's ids fit
one dictionary page), the ascending columns are delta-encoded (format version
2), row groups are bounded, and the page index that the writer adds lets
readers skip pages by ``doc_id``. Without the ids, a scan reads only metadata.

Texts are shuffled once, by range of ``doc_id``; each task sorts its range,
encodes batch by batch and writes one file. Rows that share a ``doc_id`` are
ordered by text; a null ``doc_id`` comes first; a null text is empty. An empty
table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import encoder

END = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
_SCHEMA = "part int, pos long, doc_id long, n_tokens int, ids array<int>"


def encode_rows(docs: DataFrame, vocab: str, end: int = END) -> DataFrame:
    """``part, pos, doc_id, n_tokens, ids``: rows as they stand in their partition."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos, enc = TaskContext.get().partitionId(), 0, encoder(vocab)
        for batch in batches:
            for a, ids, edges in enc.encode_column(batch.column(1), end):
                n = len(edges) - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), pa.array(np.arange(pos, pos + n)), batch.column(0).slice(a, n),
                    pa.array(np.diff(edges).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.view(np.int32)))],
                    names=["part", "pos", "doc_id", "n_tokens", "ids"])
                pos += n
    return docs.mapInArrow(encode, _SCHEMA)


def write_tokens(docs: DataFrame, path: str, vocab: str, end: int = END) -> None:
    """Encode ``doc_id, text`` and write the files to ``path``."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    (encode_rows(ordered, vocab, end).write.mode("error")
     .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#pos", "false").option("parquet.enable.dictionary#doc_id", "false")
     .parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        edges = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(edges).astype(np.int64)), pa.array(crc, type=pa.int64())],
                                         names=["part", "pos", "doc_id", "n_tokens", "ids_crc32"])


def token_spans(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each stored document.

    ``start`` counts the ids of all documents before it: a running sum within
    each file's rows plus the totals of the files before (one row per file).
    """
    rows = tokens.select("part", "pos", "doc_id", "ids").mapInArrow(_digest, "part int, pos long, doc_id long, n_tokens long, ids_crc32 long")
    before = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file: a window over all of them is small
    parts = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).join(earlier, F.col("part") == F.col("of"))
            .select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))
