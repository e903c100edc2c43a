"""Best-fit packing of token sequences, with certified lower bounds.

Documents longer than ``SIZE`` tokens are cut into pieces of ``SIZE``, the first
one being the shorter. Pieces are dealt to partitions by a salted hash and each
partition is packed by best-fit decreasing. Dual feasible functions bound from
below how many sequences its lengths need; a partition that meets its bound is
certified and stays as it is. The others exchange documents: their sequences
that have room go, whole, to new and fewer partitions, which run best-fit
decreasing over them anew and keep what is better, the new packing or the old.
This goes on until all are certified, one partition is left, or a round saves
nothing; ``certified`` says which pieces lie in partitions that meet their bound.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no pieces. Results depend on the rows alone
(ties in length go by id, piece and checksum).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .bpe import encoder
from .memory import tidy

SIZE = 1024
END = 2
#: So many pieces go to a partition on average.
PARTITION_PIECES = 16_384
_NO_ID = -(1 << 63)  # stands for a null id inside tasks
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
_PACKED = _PIECES + ", sequence_id long, offset long, room long, certified boolean"


def pieces(docs: DataFrame, vocab: str, size: int = SIZE, end: int = END) -> DataFrame:
    """The pieces of every document: position, length and checksum. No shuffle."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        enc, salt = encoder(vocab), 0
        for batch in batches:
            for a, ids, edges in enc.encode_column(batch.column(1), end):
                n = np.diff(edges)
                count = -(-n // size)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = n - (count - 1) * size
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * size)
                length = np.where(piece == 0, first[doc], size)
                at = edges[:-1][doc] + start
                ids = ids.astype("<u4", copy=False)
                crc = [zlib.crc32(ids[b:b + k]) for b, k in zip(at, length, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(n)).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc, type=pa.int64()), pa.array(np.arange(salt, salt + len(doc)))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])
                salt += len(doc)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(tidy(cut), _PIECES)


def lower_bound(lengths: np.ndarray, size: int = SIZE) -> int:
    """Sequences that these lengths need at least (two families of dual feasible functions)."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1)[:size + 1].astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // size)
    # lengths above size - e fill a sequence, those below e count as nothing
    below, weight = np.cumsum(count), np.cumsum(count * x)
    for e in range(1, size // 2 + 1):
        best = max(best, -(-int((below[size] - below[size - e]) * size + weight[size - e] - weight[e - 1]) // size))
    # rounding to multiples of 1 / k: exact multiples of size / (k + 1) keep their share, others round down
    for k in range(1, 33):
        exact = (x * (k + 1)) % size == 0
        scaled = np.where(exact, x * k, (x * (k + 1)) // size * size)
        best = max(best, -(-int((count * scaled).sum()) // (k * size)))
    return best


def best_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each length (descending order is expected) and the room left in each sequence."""
    open_by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, where, has = [], np.empty(len(lengths), dtype=np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        fit = has >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = open_by_room[room].pop()
            if not open_by_room[room]:
                has &= ~(1 << room)
        else:
            room, b = size, len(rooms)
            rooms.append(size)
        left = room - n
        rooms[b], where[i] = left, b
        if left:
            open_by_room[left].append(b)
            has |= 1 << left
    return where, np.array(rooms, dtype=np.int64)


def _pack(key: tuple, rows: pd.DataFrame, size: int, round_: int) -> pd.DataFrame:
    """Pack one partition's pieces; keep the packing they come with if that needs no more sequences."""
    rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32", "salt"], ascending=[False, True, True, True, True], ignore_index=True)
    where, rooms = best_fit(rows["length"].to_numpy(), size)
    bound = lower_bound(rows["length"].to_numpy(), size)
    if round_ and rows["sequence_id"].nunique() <= len(rooms):
        rows["certified"] = rows["sequence_id"].nunique() == bound
        return rows
    order = np.argsort(where, kind="stable")
    n = rows["length"].to_numpy()[order]
    filled = np.cumsum(n) - n
    opens = np.concatenate([[True], where[order][1:] != where[order][:-1]])
    offset = np.empty(len(rows), dtype=np.int64)
    offset[order] = filled - np.maximum.accumulate(np.where(opens, filled, 0))
    return rows.assign(sequence_id=(round_ << 56) + (int(key[0]) << 32) + where, offset=offset, room=rooms[where], certified=len(rooms) == bound)


def _step(size: int, round_: int):
    columns = [c.split()[0] for c in _PACKED.split(", ")]
    return lambda key, rows: _pack(key, rows, size, round_)[columns]


def _sequences(packed: DataFrame) -> int:
    """Each sequence has one piece at its start."""
    return packed.filter("offset = 0").count()


def pack(cut: DataFrame, size: int = SIZE, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset`` and ``certified``."""
    todo = materialize(cut, "pieces").withColumns({
        "doc_id": F.coalesce("doc_id", F.lit(_NO_ID)),
        "sequence_id": F.xxhash64("doc_id", "piece", "salt"), "offset": F.lit(0).cast("long"), "room": F.lit(0).cast("long"), "certified": F.lit(False)})
    settled: list[DataFrame] = []
    round_, before = 0, None
    while n := todo.count():
        partitions = -(-n // partition_pieces)
        dealt = todo.withColumn("bucket", F.pmod(F.xxhash64("sequence_id", F.lit(round_)), F.lit(partitions)))
        # the round is part of a sequence's number, in seven bits
        packed = materialize(dealt.groupBy("bucket").applyInPandas(_step(size, round_ % 128), _PACKED), f"packed-{round_}")
        if partitions == 1 or (round_ and _sequences(packed) == before):
            settled.append(packed)
            break
        loose = ~F.col("certified") & (F.col("room") > 0)
        settled.append(packed.filter(~loose))
        todo = packed.filter(loose)
        round_, before = round_ + 1, _sequences(todo)
    out = settled[0] if settled else todo
    for more in settled[1:]:
        out = out.unionAll(more)
    return out.select(F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def pack_documents(docs: DataFrame, vocab: str, size: int = SIZE) -> DataFrame:
    """Every document's pieces and their places in sequences of at most ``size`` tokens."""
    return pack(pieces(docs, vocab, size), size)
