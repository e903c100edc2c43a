"""Adapters from the warehouse tables to the record / mention shapes.

The test tables hold no news records, so (as planned in SURVEY §7.3):

* record  = an order; its date is ``o_orderdate``; its names are the part
  names of its line items (one mention per line item).
* mention = an event; its time is ``ts``; its name is ``user_id`` (or
  ``event_type``).

Nothing here collects per record: building the reference's ``AllNames``
string would need one group per order, so mention rows are produced
directly by joins and the record-level rules are applied to those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.timefns import as_event_time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_mentions(spark: SparkSession, sf_dir: str, name_rules=None, tasks: int | None = None) -> DataFrame:
    """One row per line item: ``record_id, DATE, name, offset``.

    ``offset`` plays the role of the character offset in ``name,offset``
    (the line number). Catalyst prunes every other column at the scans.
    ``orders`` is joined by sort-merge: its file's compressed size may promise a
    small table, and broadcast it would stand whole in every executor. The
    strategy for ``part`` is left to the planner and AQE.

    ``name_rules(part_df) -> part_df`` may rewrite and filter ``p_name`` on
    the part table before the join: a name depends only on its part, so the
    per-name rules then run once per part instead of once per line item.

    ``tasks`` deals the rows by record to so many tasks before ``orders`` is
    joined, so that join and what follows by record hold that share of the rows.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    if name_rules is not None:
        part = name_rules(part)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    named = li.join(part, li.l_partkey == part.p_partkey)
    if tasks:
        named = named.repartition(tasks, "l_orderkey")
    return (named.join(orders.hint("merge"), named.l_orderkey == orders.o_orderkey)
              .select(F.col("l_orderkey").alias("record_id"),
                      F.to_date("o_orderdate").alias("DATE"),
                      F.col("p_name").alias("name"),
                      F.col("l_linenumber").alias("offset")))


def event_mentions(spark: SparkSession, sf_dir: str, name_col: str = "user_id") -> DataFrame:
    """``event_id, name, ts`` from ``events``; ``ts`` stays ``TIMESTAMP_NTZ``."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col(name_col).cast("string").alias("name"), "ts")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor-shaped rows from ``events``: sensorname, timestamp, numA."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("sensorname"), F.col("ts").alias("timestamp"),
                     F.col("value").alias("numA"), F.col("event_id").alias("numC"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record-stream rows ``key, value, timestamp`` from ``events``, one per event.

    ``value`` is a 27-field tab-separated record line: id, date stamp, and
    the name list ``user <letters>,<offset>;<event type>,<offset>``. User ids
    are spelled with letters (digit d → the d-th letter from ``a``), because
    the cleaning rules strip digits from names.
    """
    ev = table(spark, sf_dir, "events")
    user = F.concat(F.lit("user "), F.translate(F.col("user_id").cast("string"), "0123456789", "abcdefghij"))
    names = F.concat_ws(";", F.concat_ws(",", user, F.lit("0")),
                        F.concat_ws(",", F.col("event_type"), F.lit("1")))
    fields = ([F.col("event_id").cast("string"), F.date_format("ts", "yyyyMMddHHmmss")]
              + [F.lit("")] * 21 + [names] + [F.lit("")] * 3)
    return ev.select(F.col("event_id").cast("string").alias("key"), F.concat_ws("\t", *fields).alias("value"),
                     as_event_time(ev, "ts").alias("timestamp"))
