"""The SQL each query must agree with, for DuckDB over the same tables."""

from __future__ import annotations


def steady(x: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"floor(({x}) * {scale} + 0.31830988) / {scale}"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def clock(ts: str) -> str:
    return f"strftime({ts}, '%H:%M:%S.%g')"


def _samples(key: str) -> str:
    return f"""s AS (
  SELECT CAST({key} AS VARCHAR) AS signame, ts, event_id AS tie, value,
         row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) - 1 AS idx,
         count(*) OVER (PARTITION BY {key}) AS n
  FROM events)"""


def _windows(key: str, size: int, slide: int) -> str:
    return f"""{_samples(key)},
w AS (
  SELECT signame, k, idx - greatest(0, k * {slide} - {size}) AS pos, ts, value
  FROM (SELECT *, unnest(generate_series(idx // {slide} + 1, least((idx + {size}) // {slide}, n // {slide}))) AS k
        FROM s))"""


def _chain(
    key: str = "event_type", size: int = 576, slide: int = 288, width: int = 50,
    threshold: float = 0.75, te: float = 0.018, rr: str = "0.4",
) -> str:
    """Windows w, flagged rows p, segments g, beats b, stamped beats f, abnormal beats a."""
    return f"""WITH {_windows(key, size, slide)},
p AS (
  SELECT *, value > {threshold}
    AND coalesce(max(value) OVER (o ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING) < value, true)
    AND coalesce(max(value) OVER (o ROWS BETWEEN 1 FOLLOWING AND {width} FOLLOWING) <= value, true) AS is_peak
  FROM w WINDOW o AS (PARTITION BY signame, k ORDER BY pos)),
g AS (
  SELECT *, CAST(sum(CAST(is_peak AS INT)) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg,
    coalesce(lead(is_peak) OVER o, false) AS closes,
    lead(value, 1) OVER o AS x1, lead(value, 2) OVER o AS x2
  FROM p WINDOW o AS (PARTITION BY signame, k ORDER BY pos)),
q AS (
  SELECT signame, k, seg, pos, value, ts, lead(value) OVER (PARTITION BY signame, k ORDER BY seg) AS closing
  FROM g WHERE is_peak),
b AS (
  SELECT g.signame, g.k, g.seg, q.pos AS start, count(*) + 1 AS len, q.value AS opening, q.closing, q.ts AS peak_ts,
    sum(CASE WHEN g.closes THEN 0 ELSE g.x1 * g.x1 - g.value * g.x2 END) / (count(*) + 1) AS avg_te,
    (count(*) + 1) / 360.0 AS rr,
    q.pos + greatest(0, g.k * {slide} - {size}) AS abs_start
  FROM g JOIN q ON q.signame = g.signame AND q.k = g.k AND q.seg = g.seg
  WHERE q.closing IS NOT NULL GROUP BY ALL),
f AS (
  SELECT b.*, w.ts AS time, abs_start + len - 1 AS abs_end
  FROM b JOIN w ON w.signame = b.signame AND w.k = b.k AND w.pos = b.seg - 1),
a AS (SELECT *, 'TRUE' AS abnormal FROM f WHERE avg_te < {te} OR rr < {rr})
"""


WIDE = dict(key="user_id", size=32, slide=16, width=5, rr="CAST(10 AS DOUBLE) / 360")

REPORT = (
    f"SELECT signame, k, seg, start, len, {steady('avg_te')} AS avg_te, {steady('rr')} AS rr, "
    f"{stamp('time')} AS time, abnormal FROM a"
)

# The slice of beat a, sample by sample, closing peak included.
SLICES = (
    "JOIN w ON w.signame = a.signame AND w.k = a.k AND w.pos BETWEEN a.start AND a.start + a.len - 1"
)

STORED = f"SELECT signame, {stamp('time')} AS time, len AS n, opening, closing, abnormal FROM a"

IDS = "i AS (SELECT row_number() OVER (ORDER BY signame, k, seg) AS id, * FROM a)"

IDENTITY = f"SELECT event_type AS signame, {stamp('ts')} AS ts, event_id AS tie, value FROM events"

TABLE = """t AS (
  SELECT event_id AS id, printf('%03d', user_id) AS signame, ts AS time,
         CASE WHEN event_type = 'error' THEN 'TRUE' ELSE 'FALSE' END AS abnormal FROM events)"""

EVENT = f"id, signame, {stamp('time')} AS time, abnormal"

COLLECTED = (
    f"SELECT signame, k, count(*) AS n, {stamp('min(ts)')} AS first_ts, {stamp('max(ts)')} AS last_ts, "
    "string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS cents FROM w GROUP BY ALL"
)

VECTORS = """v AS (
  SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS value
  FROM embeddings)"""

HOLD = """r AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS xs, 0 AS pos, CAST(embedding[1] AS DOUBLE) AS value,
         greatest(CAST(embedding[1] AS DOUBLE),
                  CAST(0.95 AS DOUBLE) * embedding[1] + (1 - CAST(0.95 AS DOUBLE)) * embedding[1]) AS av
  FROM embeddings
  UNION ALL
  SELECT vec_id, xs, pos + 1, xs[pos + 2],
         greatest(xs[pos + 2], CAST(0.95 AS DOUBLE) * av + (1 - CAST(0.95 AS DOUBLE)) * xs[pos + 2])
  FROM r WHERE pos + 1 < len(xs))"""


def _maxima(source: str, group: str, width: int, order: str = "idx") -> str:
    """Rows of ``source`` that are the first maximum of their neighbourhood."""
    return f"""m AS (
  SELECT *, coalesce(max(value) OVER (o ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING) < value, true)
        AND coalesce(max(value) OVER (o ROWS BETWEEN 1 FOLLOWING AND {width} FOLLOWING) <= value, true) AS is_max
  FROM {source} WINDOW o AS (PARTITION BY {group} ORDER BY {order}))"""


def _relative(select: str) -> str:
    return f"""WITH {_samples('user_id')}, {_maxima('s', 'signame', 3)},
z AS (SELECT *, avg(value) OVER (PARTITION BY signame ORDER BY idx ROWS BETWEEN 9 PRECEDING AND 2 FOLLOWING) AS mean FROM m)
SELECT signame, idx AS pos, value FROM z WHERE value > mean + 0.7512345 {select}"""


MANIFEST = """SELECT DISTINCT CAST(user_id AS VARCHAR) AS record FROM events e
WHERE EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error')"""

MESSAGE = f"event_type || ',' || {clock('ts')} || ',' || CAST(value AS VARCHAR)"


# Ends of the first two thirds of the events' span, in whole milliseconds.
THIRDS = """thirds AS (
  SELECT (lo + (hi - lo) // 3) // 1000 * 1000 AS one, hi FROM (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events))"""

# Events over a day behind the newest one when they arrive.
BEHIND = "epoch_us(ts) < one - 86400000000 AND event_id % 97 = 0"

# What a topic's events are as messages, and what is wrong with them.
TOPIC = f"""m AS (
  SELECT event_id, CASE WHEN event_id % 50 = 2 THEN event_type ELSE event_type || ',' ||
      CASE WHEN event_id % 50 = 1 THEN '25:61' ELSE {clock('ts')} END || ',' ||
      CASE WHEN event_id % 50 = 0 THEN '-' ELSE CAST(value AS VARCHAR) END END AS message,
    CASE WHEN event_id % 50 IN (0, 2) THEN 'no value' WHEN event_id % 50 = 1 THEN 'bad time of day' END AS reason
  FROM events)"""


def _over(rows: str, chain: str) -> str:
    """``chain`` over other events, given as "…, events AS (…)"."""
    return f"WITH {rows}, {chain.removeprefix('WITH ')}"


def all_sql() -> dict[str, str]:
    chain, wide = _chain(), _chain(**WIDE)
    hold = f"SELECT vec_id, pos, {steady('av')} AS av FROM r"
    return {
        # sources
        "scan_signal_files": f"WITH {_samples('event_type')} SELECT signame AS record, idx, value FROM s",
        "replay_timestamps": f"""WITH {_samples('event_type')},
t AS (SELECT signame, idx AS pos, TIMESTAMP '2024-01-01 10:00:00'
        + to_microseconds(CAST(round(round(idx / 360.0, 3) * 1000000) AS BIGINT)) AS ts FROM s)
SELECT signame, pos, {stamp('ts')} AS ts, {clock('ts')} AS time FROM t""",
        "encode_message": f"SELECT {MESSAGE} AS message FROM events",
        "parse_sample": f"SELECT event_type AS signame, {clock('ts')} AS time, value FROM events",
        "parse_sample_quarantine": """SELECT CASE WHEN event_type = 'error' THEN 'refused' ELSE event_type END AS signame,
count(*) AS n FROM events GROUP BY 1""",
        "event_time": f"""SELECT event_type AS signame, {clock('ts')} AS time,
{stamp("TIMESTAMP '2024-01-01' + to_microseconds((epoch_us(ts) % 86400000000) // 1000 * 1000)")} AS ts, value FROM events""",
        "source_stream": IDENTITY,
        "parse_header_comments": """WITH u AS (SELECT DISTINCT user_id FROM events)
SELECT CAST(user_id AS VARCHAR) AS record, 'age' AS field, CAST(user_id + 1 AS VARCHAR) AS text FROM u
UNION ALL SELECT CAST(user_id AS VARCHAR), 'sex', 'M' FROM u
UNION ALL SELECT CAST(user_id AS VARCHAR), 'sinus rhythm', 'no' FROM u""",
        "record_metadata": """SELECT CAST(user_id AS VARCHAR) AS record,
'{"age":"' || (user_id + 1) || '","fs":360.0,"n_sig":' || count(DISTINCT event_type) || ',"sex":"M","sig_len":' || count(*)
|| ',"sig_name":["' || string_agg(DISTINCT event_type, '","' ORDER BY event_type)
|| '"],"sinus rhythm":"no","units":["mV"]}' AS metadata FROM events GROUP BY user_id""",
        "select_channel": """SELECT CAST(user_id AS VARCHAR) AS record, event_type AS channel, event_id AS idx, value
FROM events WHERE event_type = 'error'""",
        "record_manifest": MANIFEST,
        "record_manifest_skip_first": MANIFEST
        + " AND CAST(user_id AS VARCHAR) <> (SELECT min(CAST(user_id AS VARCHAR)) FROM events)",
        # windows
        "rebalance": IDENTITY,
        "key_by": IDENTITY,
        "watermark": IDENTITY,
        "watermark_delay": IDENTITY,
        "count_window": f"WITH {_windows('event_type', 576, 288)} SELECT signame, k, pos, {stamp('ts')} AS ts, value FROM w",
        "count_window_ranged": f"WITH {_windows('event_type', 576, 288)} SELECT signame, k, pos, {stamp('ts')} AS ts, value FROM w",
        "count_window_short": f"WITH {_windows('user_id', 5, 7)} SELECT signame, k, pos, {stamp('ts')} AS ts, value FROM w",
        "window_collect": f"WITH {_windows('event_type', 576, 288)} {COLLECTED}",
        "count_window_stream": f"WITH {_windows('event_type', 576, 288)} {COLLECTED}",
        # detection
        "r_peaks": chain + "SELECT signame, k, pos, value FROM q",
        "min_peaks_gate": chain + "SELECT signame, k, count(*) AS n_peaks FROM q GROUP BY ALL HAVING count(*) >= 2",
        "beat_segments": chain + "SELECT signame, k, seg, start, len, abs_start, abs_end, opening, closing FROM f",
        "teager_energy": chain
        + f"""SELECT signame, k, seg, j, {steady('psi')} AS psi FROM (
  SELECT g.signame, g.k, g.seg, g.pos - b.start AS j, CASE WHEN g.closes THEN 0 ELSE g.x1 * g.x1 - g.value * g.x2 END AS psi
  FROM g JOIN b ON b.signame = g.signame AND b.k = g.k AND b.seg = g.seg
  UNION ALL SELECT signame, k, seg, len - 1, 0 FROM b)""",
        "avg_teager": chain + f"SELECT signame, k, seg, {steady('avg_te')} AS avg_te FROM b",
        "rr_interval": chain + f"SELECT signame, k, seg, len, {steady('rr')} AS rr FROM b",
        "beat_timestamp": chain + f"SELECT signame, k, seg, {stamp('time')} AS time FROM f",
        "beat_timestamp_peak": chain + f"SELECT signame, k, seg, {stamp('peak_ts')} AS time FROM b",
        "classify_beat": chain + "SELECT signame, k, seg, abnormal FROM a",
        "detect_anomalies": chain + REPORT,
        "detect_anomalies_wide": wide + REPORT,
        "detect_anomalies_ranged": chain + REPORT,
        "detect_anomalies_dedup": chain
        + REPORT + " QUALIFY row_number() OVER (PARTITION BY signame, abs_start, abs_end ORDER BY k) = 1",
        "anomaly_rows": chain
        + f"SELECT a.signame, {stamp('a.time')} AS time, w.pos - a.start AS x, w.value AS y, abnormal FROM a {SLICES}",
        "detect_stream": chain + STORED,
        "detect_stream_carry": chain + STORED,
        "detect_stream_dedup": chain
        + f"SELECT * FROM ({STORED} QUALIFY row_number() OVER (PARTITION BY signame, abs_start, abs_end ORDER BY k) = 1)",
        "detect_stream_ordered": _over(
            f"{THIRDS}, events AS (SELECT e.* FROM events e, thirds WHERE NOT ({BEHIND}) AND epoch_us(ts) <= hi - 86400000000)", chain
        ) + STORED,
        "late_samples": f"WITH {THIRDS} SELECT event_type AS signame, {stamp('ts')} AS ts, event_id AS tie, value FROM events, thirds WHERE {BEHIND}",
        "detect_messages": _over(
            "events AS (SELECT * REPLACE (date_trunc('milliseconds', ts) AS ts) FROM events WHERE event_id % 50 > 2)", chain
        ) + STORED,
        "refused_messages": f"WITH {TOPIC} SELECT event_id AS \"offset\", message, reason FROM m WHERE reason IS NOT NULL",
        # sinks
        "sink_signal_samples": chain + STORED,
        "sink_append_twice": chain
        + f"SELECT o.*, (SELECT 4 * count(*) FROM a) AS ids FROM ({STORED}) AS o, range(4)",
        "sink_unique_append": chain
        + f""", u AS (
  SELECT 0 AS writer, * FROM a UNION ALL SELECT 1, * REPLACE (peak_ts AS time) FROM a)
SELECT signame, {stamp('u.time')} AS time, len AS n, opening, closing, abnormal FROM u
QUALIFY row_number() OVER (PARTITION BY signame, u.time ORDER BY writer, k, seg) = 1""",
        "parse_array_text": """SELECT event_id, CAST(0 AS BIGINT) AS x, value AS y FROM events
UNION ALL SELECT event_id, 1, CAST(user_id AS DOUBLE) FROM events""",
        "assign_id": wide + f", {IDS} SELECT id, signame, k, seg FROM i",
        "assign_id_appends": wide
        + ", i AS (SELECT row_number() OVER (ORDER BY k % 3, signame, k, seg) AS id, * FROM a) SELECT id, signame, k, seg FROM i",
        "ecg_signal_stored": chain
        + f", {IDS} SELECT w.pos - a.start AS x, w.value AS y FROM i AS a {SLICES} WHERE a.id = (SELECT max(id) FROM i)",
        "time_chunk": wide + f", {IDS} SELECT id, {stamp("date_trunc('minute', time)")} AS chunk FROM i",
        "unique_signal_time": wide
        + f""", {IDS} SELECT id, signame, {stamp('time')} AS time FROM i
QUALIFY row_number() OVER (PARTITION BY signame, i.time ORDER BY id) = 1""",
        # signal functions
        "find_peaks": f"WITH {_samples('user_id')}, {_maxima('s', 'signame', 5)} "
        "SELECT signame, idx AS pos, value FROM m WHERE is_max AND value > 0.75",
        "find_peaks_long": f"WITH {_samples('event_type')}, {_maxima('s', 'signame', 50)} "
        "SELECT signame, idx AS pos, value FROM m WHERE is_max AND value > 0.75",
        "find_peaks_relative": _relative("AND is_max"),
        "find_peaks_decay": f"WITH RECURSIVE {HOLD}, {_maxima('r', 'vec_id', 2, 'pos')} "
        f"SELECT vec_id, pos, {steady('value')} AS value FROM m WHERE is_max AND value > 0.01 AND value >= av",
        "over_threshold": _relative(""),
        "exp_decay_hold": f"WITH RECURSIVE {HOLD} {hold}",
        "exp_decay_hold_chunked": f"WITH RECURSIVE {HOLD} {hold}",
        "top_n_peaks": f"WITH {_samples('user_id')}, {_maxima('s', 'signame', 2)}, "
        "c AS (SELECT *, row_number() OVER (PARTITION BY signame ORDER BY value DESC, idx) AS rank FROM m WHERE is_max) "
        "SELECT signame, rank, idx AS pos, value FROM c WHERE rank <= 3",
        "normalise": f"""WITH {VECTORS},
z AS (SELECT *, avg(value) OVER g AS mean, stddev_pop(value) OVER g AS sd FROM v WINDOW g AS (PARTITION BY vec_id))
SELECT vec_id, pos, {steady('(value - mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END')} AS value FROM z""",
        "rolling_slope": f"""WITH {_samples('user_id')},
z AS (SELECT *, regr_slope(value, idx * (CAST(1 AS DOUBLE) / 360))
        OVER (PARTITION BY signame ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS slope FROM s)
SELECT s.signame, s.idx AS pos, {steady('CASE WHEN s.n >= 7 THEN z.slope END', 4)} AS slope
FROM s JOIN z ON z.signame = s.signame AND z.idx = greatest(3, least(s.idx, s.n - 4))""",
        "array_min": "SELECT vec_id, list_min(CAST(embedding AS DOUBLE[])) AS array_min FROM embeddings",
        "array_max": "SELECT vec_id, list_max(CAST(embedding AS DOUBLE[])) AS array_max FROM embeddings",
        "arg_min": "SELECT vec_id, CAST(list_position(embedding, list_min(embedding)) - 1 AS BIGINT) AS arg_min FROM embeddings",
        "arg_max": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS arg_max FROM embeddings",
        "extremes": f"""WITH {_samples('event_type')},
e AS (SELECT signame, min(value) AS lo, max(value) AS hi FROM s GROUP BY signame)
SELECT e.signame, lo AS array_min, min(CASE WHEN value = lo THEN idx END) AS arg_min,
       hi AS array_max, min(CASE WHEN value = hi THEN idx END) AS arg_max
FROM e JOIN s ON s.signame = e.signame GROUP BY ALL""",
        # serving
        "ecg_signal": wide + f", {IDS} SELECT w.value AS y FROM i AS a {SLICES} WHERE a.id = 10",
        "latest_events": f"WITH {TABLE} SELECT {EVENT} FROM t WHERE signame = '007' AND abnormal = 'TRUE' "
        "ORDER BY t.time DESC, id DESC LIMIT 50",
        "latest_events_stored": chain + f"SELECT signame, {stamp('time')} AS time, abnormal FROM a WHERE signame = 'error'",
        "latest_events_kept": chain
        + f"SELECT signame, {stamp('a.time')} AS time, abnormal FROM a WHERE signame = 'error' ORDER BY a.time DESC LIMIT 50",
        "recent_events_kept": chain
        + f"SELECT signame, {stamp('a.time')} AS time, abnormal FROM a WHERE a.time > (SELECT max(a.time) - INTERVAL 86400 SECOND FROM a) "
        "ORDER BY a.time LIMIT 50",
        "recent_events": f"WITH {TABLE} SELECT {EVENT} FROM t WHERE t.time > (SELECT max(t.time) - INTERVAL 86400 SECOND FROM t) "
        "ORDER BY t.time, id LIMIT 50",
        "events_view_all": f"WITH {TABLE} SELECT {EVENT} FROM t WHERE t.time > (SELECT max(t.time) - INTERVAL 60 SECOND FROM t) "
        "ORDER BY t.time, id LIMIT 50",
        "events_view_name": f"WITH {TABLE} SELECT {EVENT} FROM t WHERE signame = '003' AND abnormal = 'TRUE' "
        "ORDER BY t.time DESC, id DESC LIMIT 50",
        "signal_trace": wide + f", {IDS} SELECT w.pos - a.start AS x, w.value AS y FROM i AS a {SLICES} WHERE a.id = 10",
        "signal_names": f"WITH {TABLE} SELECT DISTINCT signame FROM t",
    }
