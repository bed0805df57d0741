"""DuckDB SQL for the registered queries (views over the given tables).

Event time in ms is ``epoch_us(ts) // 1000`` (Spark floors microseconds;
DuckDB's ``epoch_ms`` would round)."""

from __future__ import annotations

# Shared CTE: events as parsed messages (fixture mapping).
MSG = """
msg AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id,
         event_id,
         epoch_us(ts) // 1000 AS event_ts,
         CAST(user_id AS VARCHAR) AS thread_id,
         'thread-' || CAST(user_id AS VARCHAR) AS thread_name,
         CAST(event_id AS INTEGER) AS seq,
         event_type AS dim1,
         CAST(floor(value) AS INTEGER) AS metrics1,
         epoch_us(ts) // 1000 + 1000 AS process_ts,
         epoch_us(ts) // 1000 + ((event_id * 7919) % 97) * 60000 AS arrival_ms,
         epoch_us(ts) + ((event_id * 7919) % 97) * 60000000 AS arrival_us
  FROM events
)"""

DIM = """
dim(dim1, dim1_val) AS (VALUES ('click', 'navigation'), ('purchase', 'checkout'),
                               ('signup', 'account'), ('view', 'catalog'))"""

ENR = f"""
{MSG.strip()},
{DIM.strip()},
enr AS (
  SELECT msg.*, coalesce(dim.dim1_val, 'Not Found') AS dim1_val
  FROM msg LEFT JOIN dim ON msg.dim1 = dim.dim1
)"""

W6H = 21600000

ORACLE = {
    "parse_csv_messages": f"""
WITH {MSG.strip()}
SELECT message_id, event_ts, thread_id, thread_name, seq, dim1, metrics1, process_ts,
       event_ts AS event_time_ms
FROM msg""",

    "route_dead_letter": """
SELECT route, reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN event_id % 50 IN (0, 7, 17, 33, 41) THEN 'dead_letter' ELSE 'valid' END AS route,
         CASE event_id % 50 WHEN 0 THEN 'too_few_fields' WHEN 7 THEN 'bad_event_ts'
              WHEN 17 THEN 'bad_metrics1' WHEN 33 THEN 'null_payload'
              WHEN 41 THEN 'bad_event_ts' ELSE 'ok' END AS reason
  FROM events) t
GROUP BY route, reason""",

    "dedup_by_id": f"""
WITH {MSG.strip()}
SELECT message_id AS id, message_id,
       concat_ws(',', CAST(event_ts AS VARCHAR), thread_id, thread_name, CAST(seq AS VARCHAR),
                 dim1, CAST(metrics1 AS VARCHAR)) AS payload,
       arrival_ms AS publish_ms
FROM msg""",

    "enrich_broadcast": f"""
WITH {ENR.strip()}
SELECT message_id, dim1, dim1_val, metrics1 FROM enr""",

    "agg_window_stats": f"""
WITH {ENR.strip()}
SELECT dim1,
       (event_ts // {W6H}) * {W6H} AS win_start_ms,
       (event_ts // {W6H}) * {W6H} + {W6H} AS win_end_ms,
       count(*) AS num_records,
       CAST(sum(metrics1) AS BIGINT) AS sum,
       max(metrics1) AS max,
       min(metrics1) AS min,
       CAST(CAST(sum(metrics1) AS FLOAT) / CAST(count(*) AS FLOAT) AS FLOAT) AS avg
FROM enr GROUP BY 1, 2, 3""",

    "min_globally_windowed": f"""
WITH {MSG.strip()}
SELECT (event_ts // {W6H}) * {W6H} AS win_start_ms,
       (event_ts // {W6H}) * {W6H} + {W6H} AS win_end_ms,
       min(metrics1) AS min_value
FROM msg GROUP BY 1, 2""",

    "latest_n_per_key": f"""
WITH {MSG.strip()}
SELECT dim1, CAST(row_number() OVER (PARTITION BY dim1 ORDER BY process_ts DESC, seq DESC) AS INTEGER) AS rank,
       message_id, event_ts, process_ts, metrics1
FROM msg
QUALIFY rank <= 3""",

    "latest_globally": f"""
WITH {MSG.strip()}
SELECT message_id, event_ts, seq, dim1, metrics1 FROM msg
ORDER BY event_ts DESC, seq DESC LIMIT 1""",

    "count_per_element": """
WITH w AS (SELECT unnest(regexp_split_to_array(text, '[^a-zA-Z'']+')) AS word FROM documents)
SELECT word, count(*) AS n, word || ': ' || CAST(count(*) AS VARCHAR) AS formatted
FROM w WHERE word <> '' GROUP BY word""",

    "assign_event_time": f"""
WITH {MSG.strip()}
SELECT message_id,
       CASE WHEN event_id % 50 IN (33, 41) THEN arrival_ms ELSE event_ts END AS event_time_ms
FROM msg""",
}


def _iso(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"


def _win_str(start: str, end: str) -> str:
    return f"'[' || {_iso(start)} || '..' || {_iso(end)} || ')'"


def _ts_s(ms: str) -> str:
    return f"make_timestamp((({ms}) // 1000) * 1000000)"


DETAIL_SQL = f"""
detail AS (
  SELECT event_ts, thread_id, thread_name, seq, dim1, metrics1, process_ts, dim1_val,
         {_win_str(f"(event_ts // {W6H}) * {W6H}", f"(event_ts // {W6H}) * {W6H} + {W6H}")} AS "window",
         'PaneInfo.NO_FIRING' AS pane_info, CAST(0 AS BIGINT) AS pane_idx,
         CAST(0 AS BIGINT) AS pane_nonspeculative_idx, true AS is_first, true AS is_last,
         'UNKNOWN' AS pane_timing, event_ts AS pane_event_ts
  FROM enr
)"""

E30M = 1800000
L30M = 1800000
LMAX = 9223372036854775807

def _favg(s: str, n: str) -> str:
    return f"CAST(CAST({s} AS FLOAT) / CAST({n} AS FLOAT) AS FLOAT)"


def _pane_text() -> str:
    return ("'PaneInfo{' || CASE WHEN is_first THEN 'isFirst=true, ' ELSE '' END"
            " || CASE WHEN is_last THEN 'isLast=true, ' ELSE '' END"
            " || 'timing=' || timing || ', index=' || CAST(pane_idx AS VARCHAR)"
            " || CASE WHEN pane_nonspeculative_idx <> -1 THEN ', onTimeIndex='"
            " || CAST(pane_nonspeculative_idx AS VARCHAR) ELSE '' END || '}'")


ORACLE.update({
    "typed_by_schema": f"""
WITH {ENR.strip()},
{DETAIL_SQL.strip()}
SELECT *, CAST(NULL AS VARCHAR) AS error FROM detail""",

    "typed_warehouse_row": f"""
WITH {ENR.strip()},
{DETAIL_SQL.strip()}
SELECT {_ts_s('event_ts')} AS event_ts, thread_id, thread_name, seq, dim1, metrics1,
       {_ts_s('process_ts')} AS process_ts, dim1_val, "window", pane_info, pane_idx,
       pane_nonspeculative_idx, is_first, is_last, pane_timing,
       {_ts_s('pane_event_ts')} AS pane_event_ts,
       CAST(CAST({_ts_s('event_ts')} AS DATE) AS VARCHAR) AS event_date
FROM detail""",

    "warehouse_daily": f"""
WITH {MSG.strip()}
SELECT CAST(CAST({_ts_s('event_ts')} AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows
FROM msg GROUP BY 1""",

    "json_document": f"""
WITH {ENR.strip()}
SELECT message_id,
       CAST(json_object('@timestamp', event_ts, 'thread_id', thread_id, 'thread_name', thread_name,
                        'seq', CAST(seq AS BIGINT), 'dim1', dim1, 'metrics1', CAST(metrics1 AS BIGINT),
                        'process_ts', process_ts, 'dim1_val', dim1_val) AS VARCHAR) AS doc,
       octet_length(encode(CAST(json_object('@timestamp', event_ts, 'thread_id', thread_id,
                        'thread_name', thread_name, 'seq', CAST(seq AS BIGINT), 'dim1', dim1,
                        'metrics1', CAST(metrics1 AS BIGINT), 'process_ts', process_ts,
                        'dim1_val', dim1_val) AS VARCHAR))) AS n_bytes
FROM enr""",

    "windowed_path": f"""
WITH {MSG.strip()},
w AS (SELECT (event_ts // {W6H}) * {W6H} AS s, (event_ts // {W6H}) * {W6H} + {W6H} AS e, count(*) AS n_rows
      FROM msg WHERE event_id % 50 IN (0, 7, 17, 33, 41) GROUP BY 1, 2)
SELECT 'err/' || strftime(make_timestamp(e * 1000), '%Y/%m/%d/%H') || '/events'
       || {_iso('s')} || '-' || {_iso('e')} || '-pane-0-last-00-of-01.csv' AS path,
       n_rows
FROM w""",
})


ORACLE.update({
    "bulk_batches": f"""
WITH {ENR.strip()},
docs AS (SELECT CAST(json_object('@timestamp', event_ts, 'thread_id', thread_id, 'thread_name', thread_name,
                        'seq', CAST(seq AS BIGINT), 'dim1', dim1, 'metrics1', CAST(metrics1 AS BIGINT),
                        'process_ts', process_ts, 'dim1_val', dim1_val) AS VARCHAR) AS doc FROM enr)
SELECT count(*) AS n_docs, CAST(sum(octet_length(encode(doc))) AS BIGINT) AS doc_bytes,
       CAST(sum(octet_length(encode(doc)) + 18) AS BIGINT) AS body_bytes, true AS within_limits
FROM docs""",

    "bulk_item_errors": f"""
WITH {ENR.strip()}
SELECT message_id AS doc_id, 400 AS status, 'mapper_parsing_exception' AS error_type,
       CAST(json_object('@timestamp', event_ts, 'thread_id', thread_id, 'thread_name', thread_name,
                        'seq', CAST(seq AS BIGINT), 'dim1', dim1, 'metrics1', CAST(metrics1 AS BIGINT),
                        'process_ts', process_ts, 'dim1_val', dim1_val) AS VARCHAR) AS doc
FROM enr WHERE dim1_val = 'Not Found'""",
})


ORACLE["limit_n"] = f"""
WITH {ENR.strip()}
SELECT message_id, event_ts, dim1, dim1_val, metrics1 FROM enr
ORDER BY event_ts DESC, seq DESC LIMIT 10"""


# Streams. The messages arrive in slices of 12270 minutes, counted from 10 minutes
# before the midnight ahead of the first arrival; ``wm_before`` of a slice is the
# greatest event time of the slices before it. A row counts in its window unless
# wm_before has reached the window's end + allowed lateness.
_SLICE = ("((arrival_us - ((SELECT min(arrival_us) FROM msg) - (SELECT min(arrival_us) FROM msg) % 86400000000) "
          "+ 600000000) // 736200000000)")


def _sliced(src: str, lateness: int) -> str:
    return f"""
sl AS (SELECT {src}.*, {_SLICE} AS b, (event_ts // {W6H}) * {W6H} AS win_start_ms,
              (event_ts // {W6H}) * {W6H} + {W6H} AS win_end_ms FROM {src}),
slw AS (SELECT b, max(max(event_ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm_before
        FROM sl GROUP BY b),
counted AS (SELECT sl.*, slw.wm_before FROM sl JOIN slw USING (b)
            WHERE slw.wm_before IS NULL OR slw.wm_before < sl.win_end_ms + {lateness})"""


_UPDATE = f"""
  SELECT dim1, win_start_ms, win_start_ms + {W6H} AS win_end_ms, acc_n AS num_records, acc_s AS sum,
         acc_mx AS max, acc_mn AS min, {_favg('acc_s', 'acc_n')} AS avg, b AS batch_id
  FROM (SELECT dim1, win_start_ms, b, sum(n) OVER w AS acc_n, CAST(sum(s) OVER w AS BIGINT) AS acc_s,
               min(mn) OVER w AS acc_mn, max(mx) OVER w AS acc_mx
        FROM (SELECT dim1, win_start_ms, b, count(*) AS n, sum(metrics1) AS s, min(metrics1) AS mn, max(metrics1) AS mx
              FROM counted GROUP BY ALL) pb
        WINDOW w AS (PARTITION BY dim1, win_start_ms ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) acc"""

# A window is final once the greatest event time has reached its end + lateness.
_APPEND = f"""
  SELECT dim1, win_start_ms, win_end_ms, count(*) AS num_records, CAST(sum(metrics1) AS BIGINT) AS sum,
         max(metrics1) AS max, min(metrics1) AS min, {_favg('sum(metrics1)', 'count(*)')} AS avg
  FROM counted WHERE win_end_ms + {L30M} <= (SELECT max(event_ts) FROM sl) GROUP BY dim1, win_start_ms, win_end_ms"""

ORACLE.update({
    "stream_dedup": f"""
WITH {MSG.strip()}
SELECT message_id AS id,
       concat_ws(',', CAST(event_ts AS VARCHAR), thread_id, thread_name, CAST(seq AS VARCHAR),
                 dim1, CAST(metrics1 AS VARCHAR)) AS payload
FROM msg""",

    # the lookup has two more rows from the third slice on
    "stream_enrich_refreshing": f"""
WITH {ENR.strip()}
SELECT message_id, dim1, metrics1, event_ts AS event_ms,
       CASE WHEN {_SLICE} >= 2 AND dim1 = 'error' THEN 'support'
            WHEN {_SLICE} >= 2 AND dim1 = 'click' THEN 'landing' ELSE dim1_val END AS dim1_val
FROM enr""",

    # the value that was valid at the event's time
    "stream_enrich_as_of": f"""
WITH {ENR.strip()},
lim AS (SELECT (min(arrival_us) // 86400000000) * 86400000 AS t0 FROM enr)
SELECT message_id, dim1, metrics1, event_ts AS event_ms,
       CASE WHEN dim1 = 'error' AND event_ts >= t0 + 864000000 THEN 'support'
            WHEN dim1 = 'click' AND event_ts >= t0 + 1296000000 THEN 'landing'
            WHEN dim1 = 'view' AND event_ts >= t0 + 1728000000 THEN 'Not Found' ELSE dim1_val END AS dim1_val
FROM enr, lim""",

    "stream_update_stats": f"WITH {ENR.strip()}, {_sliced('enr', L30M).strip()} {_UPDATE}",

    "stream_append_stats": f"WITH {ENR.strip()}, {_sliced('enr', L30M).strip()} {_APPEND}",

    # redelivered copies never count twice: the same statistics as without them
    "stream_dedup_stats": f"""
WITH {ENR.strip()}, {_sliced('enr', L30M).strip()}
SELECT *, 'update' AS mode FROM ({_UPDATE}) u
UNION ALL SELECT *, CAST(-1 AS BIGINT) AS batch_id, 'append' AS mode FROM ({_APPEND}) a""",

    "stream_per_trigger_stats": f"""
WITH {ENR.strip()},
x AS (SELECT enr.*, {_SLICE} AS b FROM enr)
SELECT dim1, count(*) AS num_records, CAST(sum(metrics1) AS BIGINT) AS sum, max(metrics1) AS max,
       min(metrics1) AS min, {_favg('sum(metrics1)', 'count(*)')} AS avg, b AS batch_id
FROM x GROUP BY dim1, b""",

    # no lateness: a dead letter counts if the dead letters before its slice have not reached its window's end
    "stream_error_windows": f"""
WITH {MSG.strip()}, bad AS (SELECT * FROM msg WHERE event_id % 50 IN (0, 7, 17, 33, 41)),
{_sliced('bad', 0).strip()}
SELECT win_start_ms, win_end_ms, count(*) AS n_rows FROM counted
WHERE win_end_ms <= (SELECT max(event_ts) FROM sl) GROUP BY win_start_ms, win_end_ms""",
})


def _pane_rows(src: str) -> str:
    """Pane indexes and running totals over the panes in ``src``."""
    return f"""
  SELECT {src}.*,
         CAST(row_number() OVER w - 1 AS BIGINT) AS pane_idx,
         CAST(CASE WHEN timing = 'EARLY' THEN -1
              ELSE sum(CASE WHEN timing <> 'EARLY' THEN 1 ELSE 0 END)
                   OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 END AS BIGINT)
           AS pane_nonspeculative_idx,
         row_number() OVER w = 1 AS is_first, false AS is_last,
         sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc_n,
         CAST(sum(s) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS acc_s,
         min(mn) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc_mn,
         max(mx) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc_mx
  FROM {src} WINDOW w AS (PARTITION BY dim1, win_start_ms ORDER BY b, ord)"""


# Panes of the stream, late firing count 3. A slice is much longer than the
# lateness, so a window gets late rows from one slice at most: they fire at once if
# there are three, else with the closing pane (the last one) when the greatest
# event time reaches end + lateness.
LATE_COUNT = 3


def _pane_ctes(late_count: int, closed: bool = False) -> str:
    """``acc`` and ``dis``, the accumulating and discarding panes. ``closed``: the input ends, so
    every window's end and closing are reached."""
    closing = "true" if closed else f"win_end_ms + {L30M} <= (SELECT max(event_ts) FROM sl)"
    after = "(SELECT max(b) + 1 FROM wa)" if closed else "NULL"
    return f"""
wa AS (SELECT b, max(max(event_ts)) OVER (ORDER BY b) AS wm_after FROM sl GROUP BY b),
t AS (SELECT *, CASE WHEN wm_before >= win_end_ms THEN 'LATE' ELSE 'EARLY' END AS timing FROM counted),
pp AS (SELECT dim1, win_start_ms, win_end_ms, b, timing, 0 AS ord, count(*) AS n, CAST(sum(metrics1) AS BIGINT) AS s,
              min(metrics1) AS mn, max(metrics1) AS mx FROM t GROUP BY ALL),
fired AS (SELECT pp.*, timing = 'LATE' AND n < {late_count} AS last FROM pp
          WHERE timing = 'EARLY' OR n >= {late_count} OR {closing}),
ot AS (SELECT o.dim1, o.win_start_ms, o.win_end_ms,
              coalesce((SELECT min(wa.b) FROM wa WHERE wa.wm_after >= o.win_end_ms), {after}) AS b,
              'ON_TIME' AS timing, 1 AS ord, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS s,
              CAST(NULL AS INTEGER) AS mn, CAST(NULL AS INTEGER) AS mx, false AS last
       FROM (SELECT DISTINCT dim1, win_start_ms, win_end_ms FROM pp WHERE timing = 'EARLY') o),
allp AS (SELECT * FROM fired UNION ALL SELECT * FROM ot WHERE b IS NOT NULL),
acc AS (SELECT * REPLACE (last AS is_last) FROM ({_pane_rows("allp")}) x),
dis AS (SELECT * REPLACE (last AS is_last) FROM ({_pane_rows("fired")}) x)"""


_ACC = f"""dim1, win_start_ms, win_end_ms, timing, pane_idx, pane_nonspeculative_idx, is_first, is_last,
       acc_n AS num_records, acc_s AS sum, acc_mx AS max, acc_mn AS min, {_favg('acc_s', 'acc_n')} AS avg"""
_DIS = f"""dim1, win_start_ms, win_end_ms, timing, pane_idx, pane_nonspeculative_idx, is_first, is_last,
       n AS num_records, s AS sum, mx AS max, mn AS min, {_favg('s', 'n')} AS avg"""
_ENDS = "WITH " + ENR.strip() + ", " + _sliced("enr", L30M).strip() + ", "

ORACLE.update({
    "stream_panes": f"""{_ENDS} {_pane_ctes(LATE_COUNT)}
SELECT {_ACC}, 'accumulating' AS mode FROM acc UNION ALL SELECT {_DIS}, 'discarding' AS mode FROM dis""",
    "pane_replay_live_discarding": f"{_ENDS} {_pane_ctes(1)} SELECT {_DIS} FROM dis",
    "pane_replay_live_accumulating": f"{_ENDS} {_pane_ctes(1)} SELECT {_ACC} FROM acc",
    "pane_replay_discarding": f"{_ENDS} {_pane_ctes(LATE_COUNT, True)} SELECT {_DIS} FROM dis",
    "pane_replay_accumulating": f"{_ENDS} {_pane_ctes(LATE_COUNT, True)} SELECT {_ACC} FROM acc",

    # every row, fired, dropped or waiting
    "lateness_audit": f"""{_ENDS}
w AS (SELECT sl.*, slw.wm_before FROM sl JOIN slw USING (b))
SELECT win_start_ms, win_end_ms, CASE WHEN wm_before >= win_end_ms + {L30M} THEN 'DROPPED'
         WHEN wm_before >= win_end_ms THEN 'LATE' ELSE 'EARLY' END AS timing, count(*) AS n_rows
FROM w GROUP BY ALL""",

    "read_wide_total": f"""{_ENDS}
x AS (SELECT 1)
SELECT dim1, win_start_ms, win_end_ms, count(*) AS num_records, CAST(sum(metrics1) AS BIGINT) AS sum,
       max(metrics1) AS max, min(metrics1) AS min, {_favg('sum(metrics1)', 'count(*)')} AS avg
FROM counted GROUP BY dim1, win_start_ms, win_end_ms""",

    "sink_wide_rows": f"""{_ENDS} {_pane_ctes(1)},
q AS (SELECT dim1 || '#' || win_start_ms || '#' || win_end_ms AS row_key,
             unnest(['avg', 'max', 'min', 'num_records', 'sum']) AS st, pane_idx FROM dis)
SELECT row_key, CAST(count(*) AS INTEGER) AS n_cells,
       array_to_string(list_sort(list('stats:' || st || '#' || pane_idx)), ',') AS qualifiers
FROM q GROUP BY row_key""",

    "wide_encode": f"""{_ENDS} {_pane_ctes(1, True)},
k AS (SELECT *, dim1 || '#' || win_start_ms || '#' || win_end_ms AS row_key, win_end_ms + pane_idx AS process_ts,
             '#' || pane_idx AS sfx FROM dis)
SELECT row_key, 'stats' AS family, qualifier, process_ts AS cell_ts, value FROM (
  SELECT row_key, process_ts, 'num_records' || sfx AS qualifier, CAST(n AS VARCHAR) AS value FROM k
  UNION ALL SELECT row_key, process_ts, 'sum' || sfx, CAST(s AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'max' || sfx, CAST(mx AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'min' || sfx, CAST(mn AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'avg' || sfx, CAST({_favg('s', 'n')} AS VARCHAR) FROM k
) c""",

    "tall_encode": f"""{_ENDS} {_pane_ctes(1, True)},
k AS (SELECT *, win_end_ms + pane_idx AS process_ts,
             dim1 || '#' || ({LMAX} - win_end_ms - pane_idx) || '#' || win_start_ms AS row_key FROM acc)
SELECT row_key, family, qualifier, process_ts AS cell_ts, value FROM (
  SELECT row_key, process_ts, 'stats' AS family, 'num_records' AS qualifier, CAST(acc_n AS VARCHAR) AS value FROM k
  UNION ALL SELECT row_key, process_ts, 'stats', 'sum', CAST(acc_s AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'stats', 'max', CAST(acc_mx AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'stats', 'min', CAST(acc_mn AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'stats', 'avg', CAST({_favg('acc_s', 'acc_n')} AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'window', {_win_str('win_start_ms', 'win_end_ms')} FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'pane', {_pane_text()} FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'pane_idx', CAST(pane_idx AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'pane_nonspeculative_idx',
                   CAST(pane_nonspeculative_idx AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'is_first', CAST(is_first AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'is_last', CAST(is_last AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'timing', timing FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'win_start_ts', CAST(win_start_ms AS VARCHAR) FROM k
  UNION ALL SELECT row_key, process_ts, 'window_info', 'win_end_ts', CAST(win_end_ms AS VARCHAR) FROM k
) c""",

    "sink_warehouse_failures": f"""
WITH {ENR.strip()}
SELECT seq, CASE WHEN seq % 50 IN (0, 7, 17, 33) THEN 'failed' ELSE 'rows' END AS route,
       CASE seq % 50 WHEN 0 THEN 'type metrics1' WHEN 7 THEN 'required dim1' WHEN 17 THEN 'range metrics1' WHEN 33 THEN 'range metrics1'
            ELSE concat_ws('|', CAST(CAST(make_timestamp(event_ts * 1000) AS DATE) AS VARCHAR), dim1, CAST(metrics1 AS VARCHAR)) END AS value
FROM enr""",

    "read_tall_latest": f"""{_ENDS} {_pane_ctes(1, True)},
k AS (SELECT *, win_end_ms + pane_idx AS process_ts,
             dim1 || '#' || ({LMAX} - win_end_ms - pane_idx) || '#' || win_start_ms AS row_key FROM acc),
r AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY dim1 ORDER BY row_key) <= 10)
SELECT row_key, 'num_records' AS qualifier, process_ts AS cell_ts, CAST(acc_n AS VARCHAR) AS value FROM r
UNION ALL SELECT row_key, 'sum', process_ts, CAST(acc_s AS VARCHAR) FROM r""",

    # three shards per window and micro-batch, empty ones too; a window's micro-batches are its panes
    "sink_named_files": f"""{_ENDS}
f AS (SELECT *, (event_ts // 864000000) * 864000000 AS ws FROM sl),
p AS (SELECT ws, b, row_number() OVER (PARTITION BY ws ORDER BY b) - 1 AS pane FROM f GROUP BY ws, b),
c AS (SELECT ws, b, seq % 3 AS shard, count(*) AS n FROM f GROUP BY ALL)
SELECT strftime(make_timestamp((p.ws + 864000000) * 1000), '%Y/%m/%d/%H') || '/events' || {_iso('p.ws')} || '-' || {_iso('p.ws + 864000000')}
       || '-pane-' || pane || '-' || lpad(CAST(sh AS VARCHAR), 2, '0') || '-of-03.csv' AS path,
       coalesce(c.n, 0) AS n_lines
FROM p CROSS JOIN (SELECT unnest([0, 1, 2]) AS sh) x LEFT JOIN c ON c.ws = p.ws AND c.b = p.b AND c.shard = sh""",
})


# Early panes by age: windows of 10 days per user, slices of 6480 minutes, a delay of 144
# hours. Per window the slices are gone through in order. A slice's rows come first,
# at the clock of the slice's end and the watermark of the slices before; then the
# watermark moves on and the timers fire.
W240H, E144H, EARLY_SLICE_MS = 864000000, 518400000, 388800000

ORACLE["stream_early_delay"] = f"""
WITH RECURSIVE {ENR.strip()},
lim AS (SELECT (min(arrival_us) // 86400000000) * 86400000 - 600000 AS t0 FROM enr),
sl AS (SELECT enr.*, (arrival_ms - t0) // {EARLY_SLICE_MS} AS b, (event_ts // {W240H}) * {W240H} AS ws FROM enr, lim),
bs AS (SELECT b, max(event_ts) AS top, row_number() OVER (ORDER BY b) AS i FROM sl GROUP BY b),
wm AS (SELECT b, i, coalesce(max(top) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0,
              max(top) OVER (ORDER BY b) AS w1 FROM bs),
g AS (SELECT thread_id, ws, i, count(*) AS n, CAST(sum(metrics1) AS BIGINT) AS s, min(metrics1) AS mn, max(metrics1) AS mx,
             max(event_ts) AS last FROM sl JOIN wm USING (b) GROUP BY ALL),
kw AS (SELECT DISTINCT thread_id, ws, ws + {W240H} AS we FROM g),
clk AS (SELECT i, w0, w1, t0 + (b + 1) * {EARLY_SLICE_MS} AS clock FROM wm, lim),
step AS (
  SELECT thread_id, ws, we, 0::BIGINT AS i, 0::BIGINT AS en, 0::BIGINT AS es, NULL::BIGINT AS emn, NULL::BIGINT AS emx,
         NULL::BIGINT AS opened, NULL::BIGINT AS due, false AS known, false AS done,
         NULL::STRUCT(t VARCHAR, ord INTEGER, n BIGINT, s BIGINT, mn BIGINT, mx BIGINT)[] AS fired
  FROM kw
  UNION ALL
  SELECT thread_id, ws, we, i,
         CASE WHEN sent THEN 0 ELSE an END, CASE WHEN sent THEN 0 ELSE asum END,
         CASE WHEN sent THEN NULL ELSE amn END, CASE WHEN sent THEN NULL ELSE amx END,
         CASE WHEN sent THEN NULL ELSE aop END, CASE WHEN sent THEN NULL ELSE adue END,
         known2, done OR ends OR (late AND known2),
         list_filter([
           CASE WHEN by_age THEN {{'t': 'EARLY', 'ord': 0, 'n': an, 's': asum, 'mn': amn, 'mx': amx}} END,
           CASE WHEN by_timer THEN {{'t': 'EARLY', 'ord': 1, 'n': an, 's': asum, 'mn': amn, 'mx': amx}} END,
           CASE WHEN ends THEN {{'t': 'ON_TIME', 'ord': 2, 'n': CASE WHEN by_age THEN 0 ELSE an END,
                                 's': CASE WHEN by_age THEN 0 ELSE asum END, 'mn': CASE WHEN by_age THEN NULL ELSE amn END,
                                 'mx': CASE WHEN by_age THEN NULL ELSE amx END}} END,
           CASE WHEN late THEN {{'t': 'LATE', 'ord': 3, 'n': rn, 's': rs, 'mn': rmn, 'mx': rmx}} END], lambda x: x IS NOT NULL)
  FROM (
    SELECT *, by_age OR by_timer OR ends AS sent FROM (
      SELECT *, NOT by_age AND an > 0 AND w1 < we AND adue <= w1 AS by_timer,
             known2 AND NOT done AND w0 < we AND w1 >= we AS ends
      FROM (
        SELECT *, early AND clock - aop >= {E144H} AS by_age, known OR early OR late AS known2
        FROM (
          SELECT p.thread_id, p.ws, p.we, c.i, p.known, p.done, c.w0, c.w1, c.clock, g.n AS rn, g.s AS rs, g.mn AS rmn, g.mx AS rmx,
                 g.n IS NOT NULL AND c.w0 < p.we AS early,
                 g.n IS NOT NULL AND c.w0 >= p.we AND c.w0 < p.we + {L30M} AS late,
                 p.en + CASE WHEN g.n IS NOT NULL AND c.w0 < p.we THEN g.n ELSE 0 END AS an,
                 p.es + CASE WHEN g.n IS NOT NULL AND c.w0 < p.we THEN g.s ELSE 0 END AS asum,
                 CASE WHEN g.n IS NOT NULL AND c.w0 < p.we THEN least(p.emn, g.mn) ELSE p.emn END AS amn,
                 CASE WHEN g.n IS NOT NULL AND c.w0 < p.we THEN greatest(p.emx, g.mx) ELSE p.emx END AS amx,
                 coalesce(p.opened, CASE WHEN g.n IS NOT NULL AND c.w0 < p.we THEN c.clock END) AS aop,
                 coalesce(p.due, CASE WHEN g.n IS NOT NULL AND c.w0 < p.we THEN greatest(c.w0, g.last) + {E144H} END) AS adue
          FROM step p JOIN clk c ON c.i = p.i + 1
          LEFT JOIN g ON g.thread_id = p.thread_id AND g.ws = p.ws AND g.i = c.i) x1) x2) x3) x4),
panes AS (SELECT thread_id, ws, we, i, unnest(fired, recursive := true) FROM step WHERE fired IS NOT NULL),
modes AS (
  SELECT *, 'accumulating' AS mode FROM panes UNION ALL SELECT *, 'discarding' FROM panes WHERE n > 0),
num AS (
  SELECT thread_id, ws AS win_start_ms, we AS win_end_ms, t AS timing, mode, n, s, mn, mx,
         CAST(row_number() OVER w - 1 AS BIGINT) AS pane_idx,
         CAST(CASE WHEN t = 'EARLY' THEN -1
              ELSE sum(CASE WHEN t <> 'EARLY' THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 END
              AS BIGINT) AS pane_nonspeculative_idx,
         row_number() OVER w = 1 AS is_first, false AS is_last,
         CAST(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS acc_n,
         CAST(sum(s) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS acc_s,
         min(mn) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc_mn,
         max(mx) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc_mx
  FROM modes WINDOW w AS (PARTITION BY mode, thread_id, ws ORDER BY i, ord))
SELECT thread_id, win_start_ms, win_end_ms, timing, pane_idx, pane_nonspeculative_idx, is_first, is_last,
       CASE WHEN mode = 'accumulating' THEN acc_n ELSE n END AS num_records,
       CASE WHEN mode = 'accumulating' THEN acc_s ELSE s END AS sum,
       CASE WHEN mode = 'accumulating' THEN acc_mx ELSE mx END AS max,
       CASE WHEN mode = 'accumulating' THEN acc_mn ELSE mn END AS min,
       CASE WHEN mode = 'accumulating' THEN {_favg('acc_s', 'acc_n')} ELSE {_favg('s', 'n')} END AS avg, mode
FROM num"""


# Fan-out over the faulty messages in one run: what every sink holds.
_DEAD = "event_id % 50 IN (0, 7, 17, 33, 41)"

ORACLE["stream_fanout_sinks"] = f"""
WITH {ENR.strip()},
good AS (SELECT * FROM enr WHERE NOT ({_DEAD})),
d AS (SELECT *, (event_ts // {W6H}) * {W6H} AS ws FROM good),
w AS (SELECT dim1, ws, count(*) AS n, CAST(sum(metrics1) AS BIGINT) AS s, max(metrics1) AS mx, min(metrics1) AS mn
      FROM d GROUP BY dim1, ws),
p AS (SELECT 'EARLY' AS timing FROM w UNION ALL
      SELECT 'ON_TIME' FROM w WHERE ws + {W6H} <= (SELECT max(event_ts) FROM good))
SELECT 'csv' AS sink, CAST(event_ts AS VARCHAR) AS key,
       concat_ws(',', event_ts, thread_id, thread_name, seq, dim1, metrics1, process_ts, dim1_val,
                 {_win_str('ws', f'ws + {W6H}')}, 'PaneInfo.NO_FIRING', '0', '0', 'true', 'true', 'UNKNOWN', event_ts) AS value
FROM d
UNION ALL SELECT 'records', CAST(seq AS VARCHAR),
       concat_ws('|', event_ts, dim1, metrics1, dim1_val, {_iso('ws')} || '-' || {_iso(f'ws + {W6H}')}) FROM d
UNION ALL SELECT 'warehouse', CAST(seq AS VARCHAR),
       concat_ws('|', CAST(CAST({_ts_s('event_ts')} AS DATE) AS VARCHAR), dim1_val, metrics1) FROM d
UNION ALL SELECT 'docs', CAST(seq AS VARCHAR),
       CAST(json_object('@timestamp', event_ts, 'thread_id', thread_id, 'thread_name', thread_name,
                        'seq', CAST(seq AS BIGINT), 'dim1', dim1, 'metrics1', CAST(metrics1 AS BIGINT),
                        'process_ts', process_ts, 'dim1_val', dim1_val) AS VARCHAR) FROM d
UNION ALL SELECT 'errors', CAST(NULL AS VARCHAR),
       CASE event_id % 50
         WHEN 0 THEN concat_ws(',', event_ts, thread_id, thread_name)
         WHEN 7 THEN ' ' || event_ts || ' ,' || concat_ws(',', thread_id, thread_name, seq, dim1, metrics1)
         WHEN 17 THEN concat_ws(',', event_ts, thread_id, thread_name, seq, dim1) || ',n/a'
         WHEN 33 THEN 'Failed to extract pubsub payload'
         ELSE 'x17,' || concat_ws(',', thread_id, thread_name, seq, dim1, metrics1) END
FROM msg WHERE {_DEAD}
UNION ALL SELECT 'panes', timing, CAST(count(*) AS VARCHAR) FROM p GROUP BY timing
UNION ALL SELECT 'tall', 'cells', CAST(count(*) AS VARCHAR) FROM p
UNION ALL SELECT 'wide', dim1 || '|' || ws, concat_ws('|', n, s, mx, mn) FROM w"""
