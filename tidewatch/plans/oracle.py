"""Reference SQL (DuckDB dialect) for the named queries.

Every statement starts from the same ChangeEvent view over ``events`` and is
written independently of the Spark plans (plain GROUP BY / OVER clauses, with
windows computed from epoch microseconds), so agreement is a real check.
"""

from __future__ import annotations

# ChangeEvent view and the edit filter, shared by every statement.
_BASE = """
WITH ch AS (
  SELECT event_id AS id,
         'page_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS title,
         'user_' || CAST(user_id AS VARCHAR) AS "user",
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "timestamp",
         CASE event_type WHEN 'view' THEN 'edit' WHEN 'click' THEN 'edit' WHEN 'purchase' THEN 'edit'
                         WHEN 'signup' THEN 'new' WHEN 'error' THEN 'log' END AS type,
         (['a.example', 'b.example', 'c.example'])[CAST(event_id % 3 AS INTEGER) + 1] AS server_name,
         event_type AS comment,
         user_id % 10 = 0 AS bot,
         value < 10 AS minor,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS INTEGER) AS namespace,
         ts AS event_time
  FROM events
),
e AS (SELECT * FROM ch WHERE id IS NOT NULL AND type = 'edit' AND event_time IS NOT NULL)
"""

_TRENDING = """,
tb AS (SELECT title, server_name, (epoch_us(event_time) // 30000000) * 30000000 AS b0 FROM e),
tx AS (SELECT title, server_name, b0 - k * 30000000 AS ws FROM tb CROSS JOIN range(0, 20) r(k)),
trending AS (
  SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + 600000000) AS window_end,
         title AS article_title, server_name, count(*) AS edit_count
  FROM tx GROUP BY ws, title, server_name)
"""


def _spikes(window_us: int, mult: float) -> str:
    return f""",
mc AS (SELECT title, (epoch_us(event_time) // {window_us}) * {window_us} AS ws, count(*) AS n
       FROM e GROUP BY 1, 2),
sp AS (
  SELECT title AS article_title, make_timestamp(ws) AS window_start,
         make_timestamp(ws + {window_us}) AS window_end, n AS current_edit_count,
         coalesce(avg(n) OVER w, 0.0) AS historical_average,
         CASE WHEN coalesce(avg(n) OVER w, 0.0) = 0.0 THEN 0.0 ELSE n / avg(n) OVER w END AS spike_multiplier,
         (count(n) OVER w > 0 AND n > coalesce(avg(n) OVER w, 0.0) * {mult}) AS is_spike
  FROM mc
  WINDOW w AS (PARTITION BY title ORDER BY ws ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
"""


_SPANS = """,
lg AS (SELECT "user", id, event_time,
              lag(event_time) OVER (PARTITION BY "user" ORDER BY event_time, id) AS p FROM e),
sg AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(event_time) - epoch_us(p) >= 3600000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY "user" ORDER BY event_time, id ROWS UNBOUNDED PRECEDING) AS sid FROM lg),
rn AS (SELECT "user", id, event_time, min(event_time) OVER (PARTITION BY "user", sid) AS span_start,
              count(*) OVER (PARTITION BY "user", sid ORDER BY event_time, id ROWS UNBOUNDED PRECEDING) AS total_edits,
              event_time AS last_activity FROM sg),
spans AS (SELECT "user", min(event_time) AS span_start, count(*) AS total_edits, max(event_time) AS last_activity,
                 epoch_us(max(event_time)) + 3600000000 < (SELECT epoch_us(max(event_time)) FROM e) - 600000000
                   AS is_expired
          FROM sg GROUP BY "user", sid)
"""

ORACLE_SQL: dict[str, str] = {
    "parse_changes": _BASE + """
SELECT id, title, "user", "timestamp", type, server_name, comment, bot, minor, namespace,
       substr(server_name, 1, 1) AS wiki, make_timestamp("timestamp" * 1000000) AS event_time
FROM e""",
    "trending_sliding": _BASE + _TRENDING + "SELECT * FROM trending",
    "trending_prebucketed": _BASE + _TRENDING + "SELECT * FROM trending",
    "minute_counts": _BASE + """
SELECT title, make_timestamp((epoch_us(event_time) // 60000000) * 60000000) AS window_start,
       make_timestamp((epoch_us(event_time) // 60000000) * 60000000 + 60000000) AS window_end,
       count(*) AS edit_count
FROM e GROUP BY 1, 2, 3""",
    "evolved_counts": _BASE + """
SELECT title, window_start,
       CASE WHEN window_start >= TIMESTAMP '2024-01-16 00:00:00' THEN window_start + INTERVAL 1 MINUTE END AS window_end,
       edit_count
FROM (SELECT title, make_timestamp((epoch_us(event_time) // 60000000) * 60000000) AS window_start, count(*) AS edit_count
      FROM e GROUP BY 1, 2)""",
    "spikes_batch": _BASE + _spikes(60_000_000, 5.0) + "SELECT * FROM sp",
    "spikes_wide": _BASE + _spikes(21_600_000_000, 2.0) + "SELECT * FROM sp",
    "editor_spans": _BASE + _SPANS + "SELECT * FROM spans",
    "editor_running": _BASE + _SPANS + "SELECT * FROM rn",
    "top_trending": _BASE + _TRENDING + """
SELECT article_title, server_name, CAST(sum(edit_count) AS BIGINT) AS total_edits
FROM trending
WHERE epoch_us(window_start) >= (SELECT epoch_us(max(event_time)) FROM e) - 3600000000
GROUP BY article_title, server_name
ORDER BY total_edits DESC, article_title, server_name
LIMIT 20""",
    "top_trending_distinct": _BASE + _TRENDING + """
SELECT article_title, server_name, CAST(sum(edit_count) AS BIGINT) AS total_edits
FROM trending
WHERE epoch_us(window_start) >= (SELECT epoch_us(max(event_time)) FROM e) - 86400000000
  AND epoch_us(window_start) % 600000000 = 0
GROUP BY article_title, server_name
ORDER BY total_edits DESC, article_title, server_name
LIMIT 20""",
    "active_board": _BASE + _SPANS + """,
latest AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY span_start DESC) AS r FROM spans)
SELECT "user", total_edits, last_activity FROM latest
WHERE r = 1 AND NOT is_expired
ORDER BY total_edits DESC, "user", last_activity DESC
LIMIT 20""",
    "spike_board": _BASE + _spikes(21_600_000_000, 2.0) + """
SELECT article_title, window_start, window_end, current_edit_count, historical_average,
       CAST(round(CAST(spike_multiplier AS DECIMAL(38, 12)), 2) AS DOUBLE) AS spike_ratio
FROM sp WHERE is_spike
ORDER BY window_start DESC, article_title
LIMIT 20""",
    "hourly_heatmap": _BASE + _TRENDING + """
SELECT date_trunc('hour', window_start) AS hour_bucket, server_name, CAST(sum(edit_count) AS BIGINT) AS total_edits
FROM trending GROUP BY 1, 2 ORDER BY hour_bucket DESC, total_edits DESC, server_name""",
}

# Stream keys: the wire form carries whole epoch seconds, so event time is
# truncated to the second; after the flush batches every span has expired.
_BASE_WIRE = _BASE.replace("ts AS event_time", "make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS event_time")

ORACLE_SQL.update({
    "trending_stream": _BASE_WIRE + _TRENDING + "SELECT * FROM trending",
    "editors_stream": _BASE_WIRE + _SPANS
    + 'SELECT "user", span_start, total_edits, last_activity, TRUE AS is_expired FROM spans',
    "spikes_stream": _BASE_WIRE + _spikes(21_600_000_000, 2.0) + "SELECT * FROM sp",
})

# Batch = UTC day: a batch's watermark is the newest edit of the days before it less ten minutes.
_DAYS = """,
u AS (SELECT "user", epoch_us(event_time) AS t, epoch_us(event_time) // 86400000000 AS d FROM e),
days AS (SELECT d, max(max(t)) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000000 AS wm FROM u GROUP BY d)
"""

ORACLE_SQL.update({
    "as_of_snapshot": _BASE_WIRE + _DAYS + """,
mid AS (SELECT d, wm FROM days ORDER BY d LIMIT 1 OFFSET (SELECT (count(*) - 1) // 2 FROM days)),
lg AS (SELECT "user", t, lag(t) OVER (PARTITION BY "user" ORDER BY t) AS p FROM u WHERE d <= (SELECT d FROM mid)),
sg AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p >= 3600000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY "user" ORDER BY t ROWS UNBOUNDED PRECEDING) AS sid FROM lg),
sp AS (SELECT "user", sid, min(t) AS s, count(*) AS n, max(t) AS l FROM sg GROUP BY "user", sid)
SELECT "user", make_timestamp(s) AS span_start, n AS total_edits, make_timestamp(l) AS last_activity,
       coalesce(l + 3600000000 <= (SELECT wm FROM mid), FALSE) AS is_expired
FROM sp QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY sid DESC) = 1""",
    # a running total ends when a day's batch without the user has a watermark an hour past the last edit
    "editors_live": _BASE_WIRE + _DAYS + """,
ud AS (SELECT "user", d, count(*) AS n, max(t) AS l FROM u GROUP BY "user", d),
nx AS (SELECT *, lag(l) OVER (PARTITION BY "user" ORDER BY d) AS pl, lag(d) OVER (PARTITION BY "user" ORDER BY d) AS pd FROM ud),
st AS (SELECT nx.*, pl IS NULL OR EXISTS (
         SELECT 1 FROM days WHERE days.d > nx.pd AND days.d < nx.d AND days.wm >= nx.pl + 3600000000) AS fresh FROM nx),
chain AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY "user" ORDER BY d ROWS UNBOUNDED PRECEDING) AS c FROM st),
rt AS (SELECT "user", c, d, sum(n) OVER w AS total, max(l) OVER w AS last
       FROM chain WINDOW w AS (PARTITION BY "user", c ORDER BY d ROWS UNBOUNDED PRECEDING))
SELECT "user", total::BIGINT AS total_edits, make_timestamp(last) AS last_activity, FALSE AS is_expired FROM rt
UNION ALL
SELECT "user", max(total)::BIGINT, make_timestamp(max(last)), TRUE FROM rt GROUP BY "user", c""",
    "spikes_live": _BASE_WIRE + """,
w AS (SELECT title, epoch_us(event_time) // 86400000000 AS d, epoch_us(event_time) // 60000000 * 60000000 AS ws, count(*) AS n
      FROM e GROUP BY ALL),
l AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY title, d ORDER BY ws DESC) = 1),
h AS (SELECT *, avg(n) OVER p AS a, count(n) OVER p AS k FROM l
      WINDOW p AS (PARTITION BY title ORDER BY d ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
SELECT title AS article_title, make_timestamp(ws) AS window_start, make_timestamp(ws + 60000000) AS window_end,
       n AS current_edit_count, coalesce(a, 0.0) AS historical_average,
       CASE WHEN coalesce(a, 0.0) = 0.0 THEN 0.0 ELSE n / a END AS spike_multiplier,
       k > 0 AND n > coalesce(a, 0.0) * 5.0 AS is_spike
FROM h""",
})

ORACLE_SQL.update({k: ORACLE_SQL["trending_stream"] for k in ("trending_chained", "trending_dedup")})
ORACLE_SQL["editors_sessions"] = ORACLE_SQL["editors_stream"]

# The feed out of order: micro-batch i judges rows by the newest edit of the batches before i - 1, less ten minutes.
_ARRIVALS = """,
ar AS (SELECT id, epoch_us(event_time) // 86400000000 + CASE WHEN id % 20 = 0 THEN 1 + (id // 20) % 3 ELSE 0 END AS b FROM ch),
bi AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS i FROM (SELECT DISTINCT b FROM ar)),
ea AS (SELECT e.*, epoch_us(e.event_time) AS t, bi.i FROM e JOIN ar USING (id) JOIN bi USING (b)),
nw AS (SELECT i, max(t) AS m FROM ea GROUP BY i),
wm AS (SELECT bi.i, (SELECT max(m) FROM nw WHERE nw.i <= bi.i - 2) - 600000000 AS w FROM bi)
"""

# Batch i of the replay in order closes windows up to the newest edit of the batches before it, less ten minutes;
# two flush batches a day past the newest change and one without data follow.
_CLOSING = """,
di AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM (SELECT DISTINCT epoch_us(event_time) // 86400000000 AS d FROM ch)),
dn AS (SELECT di.i, max(epoch_us(e.event_time)) AS m FROM e JOIN di ON di.d = epoch_us(e.event_time) // 86400000000 GROUP BY di.i),
far AS (SELECT (SELECT count(*) FROM di) AS n, (SELECT max("timestamp") FROM ch) * 1000000 AS newest),
bw AS (
  SELECT di.i, (SELECT max(m) FROM dn WHERE dn.i < di.i) - 600000000 AS w FROM di
  UNION ALL SELECT n, (SELECT max(m) FROM dn) - 600000000 FROM far
  UNION ALL SELECT n + 1, newest + 86400000000 - 600000000 FROM far
  UNION ALL SELECT n + 2, newest + 86401000000 - 600000000 FROM far)
"""

ORACLE_SQL.update({
    "late_rows": _BASE_WIRE + _ARRIVALS
    + 'SELECT id, title, "user", event_time, ea.i AS batch_id FROM ea JOIN wm USING (i) WHERE t <= w',
    "trending_late": _BASE_WIRE + _ARRIVALS + """,
tx AS (SELECT title, server_name, t // 30000000 * 30000000 - k * 30000000 AS ws, w FROM ea JOIN wm USING (i) CROSS JOIN range(0, 20) r(k))
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + 600000000) AS window_end, title AS article_title, server_name,
       count(*) AS edit_count
FROM tx WHERE w IS NULL OR ws + 600000000 > w GROUP BY ws, title, server_name""",
    "editors_restart": _BASE_WIRE + _SPANS + """
SELECT "user", span_start, total_edits, last_activity FROM spans
WHERE epoch_us(last_activity) + 3600000000 > (SELECT epoch_us(max(event_time)) FROM e) - 600000000""",
    "spikes_expiring": _BASE_WIRE + _CLOSING + """,
mc AS (SELECT title, (epoch_us(event_time) // 21600000000) * 21600000000 AS ws, count(*) AS n FROM e GROUP BY 1, 2),
cl AS (SELECT *, (SELECT min(i) FROM bw WHERE w >= ws + 21600000000) AS b FROM mc),
gr AS (SELECT title, b, max(ws) + 21600000000 + 43200000000 AS ends FROM cl GROUP BY title, b),
fi AS (SELECT *, (SELECT min(i) FROM bw WHERE i >= b AND w >= ends) AS fires, lead(b) OVER (PARTITION BY title ORDER BY b) AS nb FROM gr),
ex AS (SELECT *, fires IS NOT NULL AND (nb IS NULL OR fires < nb) AS expires FROM fi),
ch2 AS (SELECT *, coalesce(sum(expires::INT) OVER (PARTITION BY title ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM ex),
h AS (SELECT cl.*, avg(n) OVER p AS a, count(n) OVER p AS k FROM cl JOIN ch2 USING (title, b)
      WINDOW p AS (PARTITION BY title, life ORDER BY ws ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
SELECT title AS article_title, make_timestamp(ws) AS window_start, make_timestamp(ws + 21600000000) AS window_end, n AS current_edit_count,
       coalesce(a, 0.0) AS historical_average, CASE WHEN coalesce(a, 0.0) = 0.0 THEN 0.0 ELSE n / a END AS spike_multiplier,
       k > 0 AND n > coalesce(a, 0.0) * 2.0 AS is_spike
FROM h
UNION ALL
SELECT title, make_timestamp(0), make_timestamp(0), 0, 0.0, 0.0, FALSE FROM ex WHERE expires""",
    "top_trending_table": _BASE_WIRE + _TRENDING + """
SELECT article_title, server_name, CAST(sum(edit_count) AS BIGINT) AS total_edits
FROM trending WHERE window_start >= (SELECT max(window_start) FROM trending) - INTERVAL 1 DAY
GROUP BY article_title, server_name
ORDER BY total_edits DESC, article_title, server_name
LIMIT 20""",
    "heatmap_table": _BASE_WIRE + _TRENDING + """
SELECT date_trunc('hour', window_start) AS hour_bucket, server_name, CAST(sum(edit_count) AS BIGINT) AS total_edits
FROM trending GROUP BY 1, 2""",
    "active_board_table": _BASE_WIRE + _SPANS + """,
latest AS (SELECT * FROM spans QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY span_start DESC) = 1)
SELECT "user", total_edits, last_activity FROM latest
WHERE epoch_us(last_activity) + 3600000000 > (SELECT epoch_us(max(event_time)) FROM e) - 600000000
ORDER BY total_edits DESC, "user", last_activity DESC
LIMIT 20""",
    "spike_board_table": _BASE_WIRE + _spikes(21_600_000_000, 2.0) + """
SELECT article_title, window_start, window_end, current_edit_count, historical_average,
       CAST(round(CAST(spike_multiplier AS DECIMAL(38, 12)), 2) AS DOUBLE) AS spike_ratio
FROM sp WHERE is_spike
ORDER BY window_start DESC, article_title
LIMIT 20""",
})
ORACLE_SQL["active_board_current"] = ORACLE_SQL["active_board_table"]
