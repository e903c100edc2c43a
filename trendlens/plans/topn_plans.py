"""Top-N, folds, deltas and result shaping over the test tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators.daily import daily_counts, daily_lists, to_result_schema, top_k_daily
from ..operators.rolling import HOUR_US, rolling_changelog
from ..operators.shape import extent, sorted_histogram, timeline_grid
from ..operators.topn import candidate_top_n, fold_changelog, fold_increments, lowest, top_n, top_n_delta
from ..sources.tables import event_mentions, table
from .catalog import register
from .daily_plans import _names, _sql_counts


def _user_totals(spark, sf_dir):
    inc = event_mentions(spark, sf_dir, "user_id").withColumn("increment", F.lit(1))
    return fold_increments(inc)


@register("top100_users", """
SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS "count" FROM events
GROUP BY user_id ORDER BY "count" DESC, name ASC LIMIT 100
""")
def q_top100_users(spark, sf_dir):
    return top_n(_user_totals(spark, sf_dir), 100)


@register("top100_candidates", """
SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS "count" FROM events
GROUP BY user_id ORDER BY "count" DESC, name ASC LIMIT 100
""")
def q_top100_candidates(spark, sf_dir):
    return candidate_top_n(_user_totals(spark, sf_dir), 100, 1000)


@register("lowest_user", """
SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS "count" FROM events
GROUP BY user_id ORDER BY "count" ASC, name ASC LIMIT 1
""")
def q_lowest_user(spark, sf_dir):
    return lowest(_user_totals(spark, sf_dir))


@register("histogram_sorted", """
SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS "count" FROM events GROUP BY user_id
""")
def q_histogram_sorted(spark, sf_dir):
    return sorted_histogram(_user_totals(spark, sf_dir), by="count", ascending=False)


@register("fold_increments", """
SELECT CAST(user_id AS VARCHAR) AS name,
       CAST(sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) AS BIGINT) AS "count"
FROM events GROUP BY user_id
""")
def q_fold_increments(spark, sf_dir):
    inc = (table(spark, sf_dir, "events")
           .select(F.col("user_id").cast("string").alias("name"),
                   F.when(F.col("event_type") == "error", -1).otherwise(1).alias("increment")))
    return fold_increments(inc)


# Latest value per name of the 1-hour changelog, as seen at the last event
# time W: the count of mentions in (W − 1 h, W]; names at 0 are removed.
@register("fold_changelog", """
WITH w AS (SELECT max(ts) AS w FROM events)
SELECT CAST(user_id AS VARCHAR) AS name, CAST(count(*) AS BIGINT) AS "count"
FROM events, w WHERE ts + INTERVAL 1 HOUR > w.w
GROUP BY user_id
""")
def q_fold_changelog(spark, sf_dir):
    m = event_mentions(spark, sf_dir, "user_id")
    w = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    changes = rolling_changelog(m, HOUR_US).filter(F.col("ts") <= w)
    return fold_changelog(changes, order_cols=("ts",))


@register("histogram_end_1h", """
WITH w AS (SELECT max(ts) AS w FROM events)
SELECT CAST(user_id AS VARCHAR) AS name,
       CAST(count(*) FILTER (WHERE ts + INTERVAL 1 HOUR > (SELECT w FROM w)) AS BIGINT) AS "count"
FROM events GROUP BY user_id
""")
def q_histogram_end_1h(spark, sf_dir):
    m = event_mentions(spark, sf_dir, "user_id")
    w = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    changes = rolling_changelog(m, HOUR_US).filter(F.col("ts") <= w)
    return fold_changelog(changes, order_cols=("ts",), keep_zero=True)


# T9 per day: the top-5 users of each day against the previous day's top-5;
# names that left get count 0. The first day is compared with an empty table.
_SQL_DAILY_DELTA = """
WITH c AS (
  SELECT CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS name, count(*) AS cnt
  FROM events GROUP BY 1, 2
), t AS (
  SELECT day, name, cnt FROM c
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY cnt DESC, name) <= 5
), p AS (
  SELECT CAST(day + INTERVAL 1 DAY AS DATE) AS day, name, cnt FROM t
), days AS (SELECT DISTINCT day FROM t)
SELECT coalesce(t.day, p.day) AS day, coalesce(t.name, p.name) AS name,
       CAST(coalesce(t.cnt, 0) AS BIGINT) AS "count"
FROM t FULL OUTER JOIN p ON t.day = p.day AND t.name = p.name
WHERE (t.cnt IS DISTINCT FROM p.cnt) AND coalesce(t.day, p.day) IN (SELECT day FROM days)
"""


@register("top_n_delta", _SQL_DAILY_DELTA)
def q_top_n_delta(spark, sf_dir):
    ev = event_mentions(spark, sf_dir, "user_id").withColumn("day", F.to_date("ts"))
    counts = daily_counts(ev, "day")
    cur = top_k_daily(counts, 5, "row_number", "day").select("day", "name", "count")
    # One pass: each top row is its day's current and the next day's previous
    # entry. At most ten rows per day meet in the window that keeps days of the data.
    none = F.lit(None).cast("bigint")
    both = F.array(F.struct(F.col("day").alias("day"), F.col("count").alias("c"), none.alias("p")),
                   F.struct(F.date_add("day", 1).alias("day"), none.alias("c"), F.col("count").alias("p")))
    pairs = cur.select("name", F.explode(both).alias("x")).groupBy(F.col("x.day").alias("day"), "name").agg(
        F.max("x.c").alias("c"), F.max("x.p").alias("p"))
    there = F.max(F.col("c").isNotNull()).over(Window.partitionBy("day"))
    return (pairs.withColumn("there", there).filter(F.col("there") & ~F.col("c").eqNullSafe(F.col("p")))
            .select("day", "name", F.coalesce(F.col("c"), F.lit(0)).cast("bigint").alias("count")))


@register("top_n_delta_halves", """
WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS mid FROM events),
prev AS (
  SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS cnt FROM events, m WHERE ts < m.mid
  GROUP BY user_id ORDER BY cnt DESC, name LIMIT 20
), cur AS (
  SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS cnt FROM events
  GROUP BY user_id ORDER BY cnt DESC, name LIMIT 20
)
SELECT coalesce(cur.name, prev.name) AS name, CAST(coalesce(cur.cnt, 0) AS BIGINT) AS "count"
FROM cur FULL OUTER JOIN prev ON cur.name = prev.name
WHERE cur.cnt IS DISTINCT FROM prev.cnt
""")
def q_top_n_delta_halves(spark, sf_dir):
    ev = event_mentions(spark, sf_dir, "user_id")
    b = table(spark, sf_dir, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    mid = b.select(F.col("lo") + (F.col("hi") - F.col("lo")) / 2).scalar()
    prev = top_n(fold_increments(ev.filter(F.col("ts") < mid).withColumn("increment", F.lit(1))), 20)
    cur = top_n(fold_increments(ev.withColumn("increment", F.lit(1))), 20)
    return top_n_delta(prev, cur)


@register("extent", f"""
SELECT max(cnt) AS max_count, min(day) AS first_day, max(day) AS last_day
FROM ({_sql_counts(True)}) c
""")
def q_extent(spark, sf_dir):
    counts = daily_counts(_names(spark, sf_dir), "day")
    return extent(counts.withColumnRenamed("day", "data")).select(
        "max_count", "first_day", "last_day")


@register("timeline_grid", f"""
WITH r AS (
  SELECT day, name, row_number() OVER (PARTITION BY day ORDER BY cnt DESC, name) AS rn
  FROM ({_sql_counts(True)}) c
)
SELECT day AS data,
{", ".join(f"max(CASE WHEN rn = {i + 1} THEN name END) AS p{i}" for i in range(10))}
FROM r GROUP BY day
""")
def q_timeline_grid(spark, sf_dir):
    ranked = top_k_daily(daily_counts(_names(spark, sf_dir), "day"), 10, "row_number", "day")
    return timeline_grid(to_result_schema(daily_lists(ranked, "day"), "day"), 10)

