"""Top-N consumer of the histogram changelog.

``top_n_stream`` attaches a ``foreachBatch`` sink to a published changelog
(``name, salt, count, ts, seq, batch``; the batch is the one that emitted the
row). Its tables are kept incrementally; a micro-batch reads and writes only
what its changes touch:

1. The batch is folded to the latest count per (name, salt), by (batch, seq)
   (A9, one aggregation).
2. The histogram lies in ``buckets`` by hash of the name. Buckets with changed
   names get a new version ``hist/v=<id>/bucket=<b>``; all others stay as they
   are. Each count is stored with its (batch, seq), so a row that comes after a
   newer one of its key loses; a count of 0 is remembered for ``FORGET``
   published batches for that reason.
3. The candidate table (O6) holds every name whose total is above ``floor``, and
   perhaps some others. Changed names enter it when they rise above the floor
   and leave it at 0. While the n-th candidate is above the floor, the top ``n``
   of the table is the exact top ``n`` of the histogram. Otherwise, and every
   ``refresh_every`` batches, it is refreshed: the ``candidates`` largest totals,
   with the next one as the floor. A table that has doubled is cut the same way.
4. The top table is written to ``top/batch=<id>``, its difference to the batch
   before as one JSON message ``[{"name", "count"}, …]`` (leavers carry 0) to
   ``messages/batch=<id>``, and the whole table as one message to
   ``snapshot/batch=<id>`` for readers that join late (K7).
5. The manifest ``manifest/batch=<id>`` commits the batch: the version of each
   bucket, the floor, the batch of the last refresh. It appears by a rename,
   complete or not at all. Readers see committed batches only.

A batch that is run again before its commit overwrites its own folders, which
no manifest names; one that is committed is left alone. Versions that neither
the last nor the one before last manifest names are deleted. ``retain`` bounds
the messages and snapshots kept; who joins later starts from a snapshot
(:func:`join_at`). Driver values are the bucket numbers, the floor and counts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.shape import delta_message
from ..operators.topn import fold_changelog, top_n, top_n_delta
from .runner import running_query

#: Buckets of the histogram, candidates of the top table, batches between refreshes.
BUCKETS = 64
CANDIDATES = 1000
REFRESH_EVERY = 60
#: Published batches for which a count of 0 is remembered.
FORGET = 1000

# Histogram versions hold one partial count per (name, salt) of the
# changelog and which row it is from; top tables and messages hold totals per name.
HIST_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("salt", T.IntegerType()),
    T.StructField("count", T.LongType()),
    T.StructField("batch", T.LongType()),
    T.StructField("seq", T.LongType()),
])
TOP_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("count", T.LongType()),
])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, base: str) -> list[str]:
    fs, p = _fs(spark, base)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def _numbers(spark: SparkSession, base: str, key: str = "batch") -> list[int]:
    """The numbers of the folders or files ``<key>=<number>`` in ``base``, ascending."""
    return sorted(int(x.split("=", 1)[1]) for x in _children(spark, base) if x.startswith(f"{key}="))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _drop_before(spark: SparkSession, base: str, keep_from: int) -> None:
    for v in _numbers(spark, base):
        if v < keep_from:
            _delete(spark, f"{base}/batch={v}")


def _commit(spark: SparkSession, path: str, batch: int, manifest: dict) -> None:
    """Write the batch's manifest under another name and rename it."""
    fs, draft = _fs(spark, f"{path}/manifest/.draft-{batch}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(draft, _fs(spark, f"{path}/manifest/batch={batch}")[1]):
        raise OSError(f"the manifest of batch {batch} could not be committed")


def _manifest(spark: SparkSession, path: str, batch: int) -> dict:
    fs, p = _fs(spark, f"{path}/manifest/batch={batch}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def committed(spark: SparkSession, path: str) -> list[int]:
    """The committed batches whose manifests are kept, ascending."""
    return _numbers(spark, f"{path}/manifest")


_KEY = ["name", "salt"]


def newest(rows: DataFrame, *by: str) -> DataFrame:
    """The latest row of each (name, salt): by (batch, seq), as ``seq`` starts anew when state is cleared."""
    last = F.max_by(F.struct("count", "batch", "seq"), F.struct("batch", "seq")).alias("last")
    return rows.groupBy(*_KEY, *by).agg(last).select(*_KEY, "last.count", "last.batch", "last.seq", *by)


def totals(hist: DataFrame) -> DataFrame:
    """Count per name: the sum of its salts' partial counts."""
    return hist.groupBy("name").agg(F.sum("count").cast("bigint").alias("count"))


class TopNSink:
    """The ``foreachBatch`` function of :func:`top_n_stream`."""

    def __init__(self, path: str, n: int = 100, retain: int | None = None, candidates: int = CANDIDATES, buckets: int = BUCKETS,
                 refresh_every: int = REFRESH_EVERY):
        if candidates < n:
            raise ValueError("there must be as many candidates as top names, at least")
        self.path, self.n, self.retain, self.candidates, self.buckets = path, n, retain, candidates, buckets
        self.refresh_every = refresh_every

    def __call__(self, changes: DataFrame, batch: int) -> None:
        spark, path = changes.sparkSession, self.path
        done, query = committed(spark, path), running_query(spark)
        last = _manifest(spark, path, done[-1]) if done else {
            "batch": None, "buckets": {}, "count": self.buckets, "floor": 0, "newest": -1, "refreshed": batch, "refreshes": 0, "query": query}
        if last["count"] != self.buckets or last["query"] != query:
            raise ValueError(f"{path} holds the tables of another query, or of {last['count']} buckets")
        if done and batch <= done[-1]:
            return  # committed before; a replay adds nothing
        changed, seen = self._fold(changes, batch)
        versions = self._histogram(spark, batch, last, changed, max(seen, last["newest"]))
        floor, refreshed = self._candidates(spark, batch, last, versions, changed)
        top = self._read(spark, "top", batch, TOP_SCHEMA)
        delta = top_n_delta(self._read(spark, "top", last["batch"], TOP_SCHEMA), top)
        delta_message(delta).write.mode("overwrite").text(f"{path}/messages/batch={batch}")
        snapshot_message(top).write.mode("overwrite").text(f"{path}/snapshot/batch={batch}")
        _commit(spark, path, batch, {
            "batch": batch, "before": last["batch"], "buckets": versions, "count": self.buckets, "floor": floor, "newest": max(seen, last["newest"]),
            "refreshed": batch if refreshed else last["refreshed"], "refreshes": last["refreshes"] + refreshed, "query": query})
        _delete(spark, f"{path}/work/batch={batch}")
        self._clean(spark, batch, last, versions)

    def _read(self, spark: SparkSession, kind: str, batch: int | None, schema) -> DataFrame:
        return spark.createDataFrame([], schema) if batch is None else spark.read.schema(schema).parquet(f"{self.path}/{kind}/batch={batch}")

    def _buckets(self, spark: SparkSession, versions: dict, which=None) -> DataFrame:
        """The histogram's rows in these buckets."""
        paths = [f"{self.path}/hist/v={v}/bucket={b}" for b, v in versions.items() if which is None or int(b) in which]
        return spark.read.schema(HIST_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], HIST_SCHEMA)

    def _fold(self, changes: DataFrame, batch: int) -> tuple[set[int], int]:
        """Write the batch's latest rows; which buckets they lie in, and the newest published batch among them."""
        work = f"{self.path}/work/batch={batch}"
        newest(changes).withColumn("bucket", _bucket(self.buckets)).write.mode("overwrite").parquet(work)
        found = changes.sparkSession.read.parquet(work).groupBy("bucket").agg(F.max("batch").alias("newest")).collect()
        return {r["bucket"] for r in found}, max((r["newest"] for r in found), default=-1)

    def _work(self, spark: SparkSession, batch: int) -> DataFrame:
        return spark.read.schema(T.StructType([*HIST_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{self.path}/work/batch={batch}")

    def _histogram(self, spark: SparkSession, batch: int, last: dict, changed: set[int], seen: int) -> dict:
        """Write new versions of the changed buckets; the version of every bucket."""
        versions = {b: v for b, v in last["buckets"].items() if int(b) not in changed}
        if not changed:
            return versions
        old = self._buckets(spark, last["buckets"], changed).withColumn("bucket", _bucket(self.buckets))
        rows = newest(old.unionByName(self._work(spark, batch)), "bucket").filter((F.col("count") != 0) | (F.col("batch") > seen - FORGET))
        out = f"{self.path}/hist/v={batch}"
        rows.repartition(len(changed), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        return versions | {str(b): batch for b in _numbers(spark, out, "bucket")}

    def _candidates(self, spark: SparkSession, batch: int, last: dict, versions: dict, changed: set[int]) -> tuple[int, bool]:
        """Write the candidates and the top table; the floor, and whether the table was refreshed."""
        floor, path = last["floor"], f"{self.path}/candidates/batch={batch}"
        names = self._work(spark, batch).select("name").distinct()
        now = totals(self._buckets(spark, versions, changed).join(names, "name", "left_semi")).filter(F.col("count") > 0)
        members = self._read(spark, "candidates", last["batch"], TOP_SCHEMA)
        entered = now.join(members.select("name", F.lit(True).alias("member")), "name", "left").filter(F.col("member") | (F.col("count") > floor))
        members.join(names, "name", "left_anti").unionByName(entered.select("name", "count")).write.mode("overwrite").parquet(path)
        table = self._read(spark, "candidates", batch, TOP_SCHEMA)
        size = self._top(table, batch)
        exact = floor == 0 or (size[0] == self.n and size[1] > floor)
        due = batch - last["refreshed"] >= self.refresh_every
        if not exact or (due and floor > 0):
            floor = self._cut(totals(self._buckets(spark, versions)).filter(F.col("count") > 0), path, 0)
        elif table.count() > 2 * self.candidates:
            floor = self._cut(table, path, floor)
            return floor, False
        else:
            return floor, False
        self._top(self._read(spark, "candidates", batch, TOP_SCHEMA), batch)
        return floor, True

    def _top(self, table: DataFrame, batch: int) -> tuple[int, int]:
        """Write the top table; how many rows it has and its least count."""
        top_n(table, self.n).write.mode("overwrite").parquet(f"{self.path}/top/batch={batch}")
        size = self._read(table.sparkSession, "top", batch, TOP_SCHEMA).agg(F.count("*"), F.coalesce(F.min("count"), F.lit(0))).first()
        return size[0], size[1]

    def _cut(self, table: DataFrame, path: str, floor: int) -> int:
        """Keep the table's largest rows as the candidates; the greatest count outside."""
        spark = table.sparkSession
        draft = f"{path}-cut"
        top_n(table, self.candidates + 1).write.mode("overwrite").parquet(draft)
        rows = spark.read.schema(TOP_SCHEMA).parquet(draft)
        if rows.count() > self.candidates:
            floor = max(floor, rows.agg(F.min("count")).first()[0])
        top_n(rows, self.candidates).write.mode("overwrite").parquet(path)
        _delete(spark, draft)
        return floor

    def _clean(self, spark: SparkSession, batch: int, last: dict, versions: dict) -> None:
        """Delete what neither this nor the last manifest names."""
        path = self.path
        if last["batch"] is not None:
            if last.get("before") is not None:
                old = _manifest(spark, path, last["before"])["buckets"]
                for b, v in old.items():
                    if v not in (last["buckets"].get(b), versions.get(b)):
                        _delete(spark, f"{path}/hist/v={v}/bucket={b}")
                named = {*last["buckets"].values(), *versions.values()}
                for v in set(old.values()) - named:
                    _delete(spark, f"{path}/hist/v={v}")
            for kind in ("manifest", "candidates", "top"):
                _drop_before(spark, f"{path}/{kind}", last["batch"])
        if self.retain is not None:
            for kind in ("messages", "snapshot"):
                _drop_before(spark, f"{path}/{kind}", batch - self.retain + 1)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("name"), F.lit(buckets)).cast("int")


def top_n_sink(path: str, n: int = 100, retain: int | None = None, **more) -> TopNSink:
    """The ``foreachBatch`` function of :func:`top_n_stream`."""
    return TopNSink(path, n, retain, **more)


def top_n_stream(changes: DataFrame, path: str, checkpoint: str, n: int = 100,
                 trigger: dict | None = None, query_name: str | None = None, retain: int | None = None, **more):
    """Start the top-N consumer; one delta message per micro-batch.

    ``more``: ``candidates``, ``buckets``, ``refresh_every`` (see the module).
    ``trigger={"processingTime": "1 second"}`` gives the reference's
    one-message-per-second cadence; the default runs what is available now.
    """
    w = changes.writeStream.foreachBatch(top_n_sink(path, n, retain, **more)).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_top(spark: SparkSession, path: str) -> DataFrame:
    """The top table of the newest committed batch (``name, count``)."""
    done = committed(spark, path)
    return spark.read.schema(TOP_SCHEMA).parquet(f"{path}/top/batch={done[-1]}") if done else spark.createDataFrame([], TOP_SCHEMA)


def read_messages(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """The delta messages of committed batches, of those after ``after`` if given, as rows ``batch, name, count`` (F-19)."""
    done = committed(spark, path)
    kept = [b for b in _numbers(spark, f"{path}/messages") if done and b <= done[-1] and (after is None or b > after)]
    if not kept:
        return spark.createDataFrame([], "batch long, name string, count long")
    msgs = spark.read.option("basePath", f"{path}/messages").text([f"{path}/messages/batch={b}" for b in kept]).withColumn("batch", F.col("batch").cast("long"))
    return msgs.select("batch", F.explode(F.from_json("value", T.ArrayType(TOP_SCHEMA))).alias("m")).select(
        "batch", F.col("m.name").alias("name"), F.col("m.count").alias("count"))


def apply_messages(messages: DataFrame) -> DataFrame:
    """Fold delta messages into the table they describe (the visualizer's view)."""
    return fold_changelog(messages, order_cols=("batch",))


def snapshot_message(top: DataFrame) -> DataFrame:
    """K7: the full top table as one message, for a reader that joins late."""
    return delta_message(top)


def read_snapshot(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """The newest committed snapshot, or that of ``batch``, as rows ``batch, name, count``; later messages apply on top of it."""
    done = committed(spark, path)
    if not done:
        return spark.createDataFrame([], "batch long, name string, count long")
    at = done[-1] if batch is None else batch
    text = spark.read.text(f"{path}/snapshot/batch={at}")
    items = text.select(F.explode(F.from_json("value", T.ArrayType(TOP_SCHEMA))).alias("m"))
    return items.select(F.lit(at).cast("long").alias("batch"), F.col("m.name").alias("name"), F.col("m.count").alias("count"))


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The batches that a reader can join at."""
    done = committed(spark, path)
    return [b for b in _numbers(spark, f"{path}/snapshot") if done and b <= done[-1]]


def join_at(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """S11 without a broker: the top table as a reader has it that joins at ``batch`` (default: the newest).

    It takes the snapshot of that batch, no history, and from then on only
    messages of later batches.
    """
    points = snapshots(spark, path)
    if not points:
        return spark.createDataFrame([], TOP_SCHEMA)
    at = points[-1] if batch is None else batch
    return apply_messages(read_snapshot(spark, path, at).unionByName(read_messages(spark, path, at)))
