"""Rolling-horizon queries on ``events`` (mention = event, name = user or type)."""

from __future__ import annotations


from ..operators.rolling import HOUR_US, rolling_changelog, rolling_counts
from ..sources.tables import event_mentions
from .catalog import register


def _sql_counts(name_col: str, hours: int) -> str:
    # Half-open (ts − h, ts]: a range frame of h − 1 µs preceding.
    return f"""
SELECT event_id, CAST({name_col} AS VARCHAR) AS name, ts,
       CAST(count(*) OVER (PARTITION BY {name_col} ORDER BY ts
            RANGE BETWEEN to_microseconds({hours * HOUR_US - 1}) PRECEDING AND CURRENT ROW) AS BIGINT)
         AS "count"
FROM events
"""


def _sql_changelog(name_col: str, hours: int) -> str:
    return f"""
WITH d AS (
  SELECT CAST({name_col} AS VARCHAR) AS name, ts AS t, 1 AS d FROM events
  UNION ALL
  SELECT CAST({name_col} AS VARCHAR) AS name, ts + to_microseconds({hours * HOUR_US}) AS t, -1 AS d FROM events
), n AS (
  SELECT name, t, sum(d) AS net FROM d GROUP BY name, t
), c AS (
  SELECT name, t, net,
         sum(net) OVER (PARTITION BY name ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
  FROM n
)
SELECT name, t AS ts, CAST(cnt AS BIGINT) AS "count" FROM c WHERE net <> 0
"""


@register("rolling_counts_1h", _sql_counts("user_id", 1))
def q_rolling_counts_1h(spark, sf_dir):
    m = event_mentions(spark, sf_dir, "user_id")
    return rolling_counts(m, HOUR_US).select("event_id", "name", "ts", "count")


@register("rolling_counts_2h", _sql_counts("event_type", 2))
def q_rolling_counts_2h(spark, sf_dir):
    m = event_mentions(spark, sf_dir, "event_type")
    return rolling_counts(m, 2 * HOUR_US).select("event_id", "name", "ts", "count")


@register("rolling_changelog_1h", _sql_changelog("user_id", 1))
def q_rolling_changelog_1h(spark, sf_dir):
    return rolling_changelog(event_mentions(spark, sf_dir, "user_id"), HOUR_US)


@register("rolling_changelog_type_1h", _sql_changelog("event_type", 1))
def q_rolling_changelog_type_1h(spark, sf_dir):
    return rolling_changelog(event_mentions(spark, sf_dir, "event_type"), HOUR_US)


