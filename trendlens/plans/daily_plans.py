"""Daily top-k queries (flagship). record = order, date = order date,
names = part names of its line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import clean_mentions, clean_name_table, clean_names, tasks_for
from ..operators.daily import daily_counts, daily_lists, result_json, to_result_schema, top_k_daily
from ..operators.metrics import reject_counts
from ..operators.shape import daily_text
from ..session import scratch_path
from ..sources.records import read_records, read_records_text, split_record_lines
from ..sources.tables import event_records, order_mentions, table
from ..jobs import daily_top_k
from .catalog import register


_SQL_ORDER_MENTIONS = """
  SELECT l.l_orderkey AS record_id, CAST(o.o_orderdate AS DATE) AS day,
         regexp_replace(p.p_name, '[,0-9]', '', 'g') AS name
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
"""
_SQL_KEEP = "trim(name) <> '' AND position('Type ParentCategory' IN name) = 0"


def _sql_counts(distinct: bool) -> str:
    src = f"SELECT DISTINCT * FROM ({_SQL_ORDER_MENTIONS})" if distinct else _SQL_ORDER_MENTIONS
    return (f"SELECT day, name, count(*) AS cnt FROM ({src}) m WHERE {_SQL_KEEP} "
            f"GROUP BY day, name")


def _names(spark: SparkSession, sf_dir: str, per_record: str = "distinct") -> DataFrame:
    # Per-name rules run on the part table (once per part), the per-record
    # rule (distinct names per order) on the mentions.
    # a line item has one mention at most: its table's row count (from the files' footers) bounds them
    tasks = tasks_for(table(spark, sf_dir, "lineitem").count(), int(spark.conf.get("spark.sql.shuffle.partitions"))) if per_record == "distinct" else None
    m = order_mentions(spark, sf_dir, lambda part: clean_name_table(part, "p_name"), tasks)
    m = m.select("record_id", F.col("DATE").alias("day"), "name")
    return clean_mentions(m, per_record=per_record, names_cleaned=True)


def _flat_topk(ranked: DataFrame) -> DataFrame:
    return ranked.select("day", F.col("name").alias("topic"), "count", "rank")


@register("daily_counts", f"""
SELECT day, name AS topic, cnt AS "count" FROM ({_sql_counts(True)}) c
""")
def q_daily_counts(spark, sf_dir):
    return daily_counts(_names(spark, sf_dir), "day").select("day", F.col("name").alias("topic"), "count")


@register("topk_daily_rank", f"""
SELECT day, name AS topic, cnt AS "count",
       CAST(rank() OVER (PARTITION BY day ORDER BY cnt DESC) AS BIGINT) AS "rank"
FROM ({_sql_counts(True)}) c
QUALIFY "rank" <= 10
""")
def q_topk_daily_rank(spark, sf_dir):
    return _flat_topk(top_k_daily(daily_counts(_names(spark, sf_dir), "day"), 10, "rank", "day"))


@register("topk_daily_exact", f"""
SELECT day, name AS topic, cnt AS "count",
       CAST(row_number() OVER (PARTITION BY day ORDER BY cnt DESC, name ASC) AS BIGINT) AS "rank"
FROM ({_sql_counts(True)}) c
QUALIFY "rank" <= 10
""")
def q_topk_daily_exact(spark, sf_dir):
    return _flat_topk(top_k_daily(daily_counts(_names(spark, sf_dir), "day"), 10, "row_number", "day"))


@register("topk_daily_mentions", f"""
SELECT day, name AS topic, cnt AS "count",
       CAST(rank() OVER (PARTITION BY day ORDER BY cnt DESC) AS BIGINT) AS "rank"
FROM ({_sql_counts(False)}) c
QUALIFY "rank" <= 10
""")
def q_topk_daily_mentions(spark, sf_dir):
    names = _names(spark, sf_dir, per_record="mentions")
    return _flat_topk(top_k_daily(daily_counts(names, "day"), 10, "rank", "day"))


_SQL_JSON = f"""
WITH r AS (
  SELECT day, name, cnt FROM ({_sql_counts(True)}) c
  QUALIFY rank() OVER (PARTITION BY day ORDER BY cnt DESC) <= 10
)
SELECT day AS data,
       CAST(to_json(struct_pack(data := day,
            result := list(struct_pack(topic := name, count := cnt) ORDER BY cnt DESC, name))) AS VARCHAR)
         AS value
FROM r GROUP BY day
"""


@register("topk_daily_json", _SQL_JSON)
def q_topk_daily_json(spark, sf_dir):
    ranked = top_k_daily(daily_counts(_names(spark, sf_dir), "day"), 10, "rank", "day")
    res = to_result_schema(daily_lists(ranked, "day"), "day").orderBy("data")
    return result_json(res, keep=("data",))


# The record path in batch: events as 27-field record lines, written as text
# by Spark, read back by the CSV reader (S1) or as raw lines (S2), cleaned
# inside each row (strip, split, drop blank/noise, distinct per record).
_SQL_RECORDS_JSON = """
WITH m AS (
  SELECT CAST(ts AS DATE) AS day,
         'user ' || translate(CAST(user_id AS VARCHAR), '0123456789', 'abcdefghij') AS name FROM events
  UNION ALL
  SELECT CAST(ts AS DATE) AS day, event_type AS name FROM events
), c AS (SELECT day, name, count(*) AS cnt FROM m GROUP BY day, name),
r AS (SELECT day, name, cnt FROM c QUALIFY rank() OVER (PARTITION BY day ORDER BY cnt DESC) <= 10)
SELECT day AS data,
       CAST(to_json(struct_pack(data := day,
            result := list(struct_pack(topic := name, count := cnt) ORDER BY cnt DESC, name))) AS VARCHAR)
         AS value
FROM r GROUP BY day
"""


def _record_lines(spark, sf_dir) -> str:
    path = scratch_path(spark, "record-lines")
    event_records(spark, sf_dir).select("value").write.text(path)
    return path


def _records_json(records):
    names = clean_names(records)
    ranked = top_k_daily(daily_counts(names), 10, "rank")
    return result_json(to_result_schema(daily_lists(ranked)).orderBy("data"), keep=("data",))


@register("topk_daily_records", _SQL_RECORDS_JSON)
def q_topk_daily_records(spark, sf_dir):
    return _records_json(read_records(spark, _record_lines(spark, sf_dir)))


@register("topk_daily_records_text", _SQL_RECORDS_JSON)
def q_topk_daily_records_text(spark, sf_dir):
    return _records_json(read_records_text(spark, _record_lines(spark, sf_dir)))


# The tuple-text form (K2, F-21), lists by count and name.
@register("topk_daily_text", f"""
WITH r AS (
  SELECT day, name, cnt FROM ({_sql_counts(True)}) c
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY cnt DESC, name ASC) <= 10
)
SELECT '(' || strftime(day, '%Y-%m-%d') || ',List(' ||
       string_agg('(' || name || ',' || cnt || ')', ',' ORDER BY cnt DESC, name) || '))' AS value
FROM r GROUP BY day
""")
def q_topk_daily_text(spark, sf_dir):
    ranked = top_k_daily(daily_counts(_names(spark, sf_dir), "day"), 10, "row_number", "day")
    return daily_text(to_result_schema(daily_lists(ranked, "day"), "day"))


def _irregular_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record line of one of five kinds: plain; a repeated name and a
    trailing separator; a blank and a noise name; too few fields; a bad date."""
    kind = F.col("key").cast("bigint") % 5
    f = F.split("value", "\t", -1)
    names = f.getItem(23)
    changed = (F.when(kind == 1, F.concat(names, F.lit(";"), names, F.lit(";")))
               .when(kind == 2, F.concat(names, F.lit("; ,3;Type ParentCategory,5"))).otherwise(names))
    day = F.when(kind == 4, F.lit("20159940000000")).otherwise(f.getItem(1))
    line = F.concat_ws("\t", f.getItem(0), day, *[F.lit("")] * 21, changed, *[F.lit("")] * 3)
    return event_records(spark, sf_dir).select(F.when(kind == 3, F.concat_ws("\t", f.getItem(0), f.getItem(1), F.lit("a"))).otherwise(line).alias("value"))


# Short lines (P3, F6) and bad dates (F8) are dropped, repeated names count
# once per record (F-3), noise (P4, F-5) and blank names (F-6) go.
@register("record_rules", """
WITH e AS (SELECT *, 'user ' || translate(CAST(user_id AS VARCHAR), '0123456789', 'abcdefghij') AS u FROM events WHERE event_id % 5 NOT IN (3, 4)),
m AS (SELECT CAST(ts AS DATE) AS "DATE", u AS name FROM e UNION ALL SELECT CAST(ts AS DATE), event_type FROM e)
SELECT "DATE", name, count(*) AS "count" FROM m GROUP BY ALL
""")
def q_record_rules(spark, sf_dir):
    return daily_counts(clean_names(split_record_lines(_irregular_lines(spark, sf_dir)))).select("DATE", "name", "count")


# F8: what the batch job drops, by reason (short lines are gone before).
@register("record_rejects", """
SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 5 = 4) AS null_date, CAST(0 AS BIGINT) AS null_names
FROM events WHERE event_id % 5 <> 3
""")
def q_record_rejects(spark, sf_dir):
    return reject_counts(split_record_lines(_irregular_lines(spark, sf_dir)))


# F8 measured by the job itself: the run that writes the daily result also
# delivers its rejects.
@register("record_rejects_observed", """
SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 5 = 4) AS null_date, CAST(0 AS BIGINT) AS null_names, true AS written
FROM events WHERE event_id % 5 <> 3
""")
def q_record_rejects_observed(spark, sf_dir):
    lines, out = scratch_path(spark, "irregular"), scratch_path(spark, "daily-observed")
    _irregular_lines(spark, sf_dir).write.text(lines)
    rejects = daily_top_k(spark, lines, out, reader="text")
    written = spark.read.text(out).agg((F.count("*") > 0).alias("written"))
    return written.select(*[F.lit(v).cast("bigint").alias(k) for k, v in rejects.items()], "written")
