"""ANSI SQL counterparts of the named queries, written for DuckDB.

They state each result directly over `events`; columns that the Spark queries
recover by parsing names and paths are taken here from the events themselves.
"""

from __future__ import annotations

import re

# Scaled thresholds, as in the queries.
FULL, SHORT, MIN_FILES, MIN_COUNT, STAMP_MIN, TAIL = 40, 5, 80, 20, 3, 5
NEAR = FULL - SHORT
PRESENT = "DATE '2024-01-11'"

# Common table expressions in order of dependency.
CTES = {
    "named": """
        SELECT event_id, ts, props, event_type,
               'ST' || (user_id % 4) AS station_dir,
               'ST' || (CASE WHEN event_id % 97 = 0 THEN (user_id + 1) % 4 ELSE user_id % 4 END) AS token,
               CAST(ts AS DATE) AS day,
               strftime(ts, '%H%M') AS hhmm,
               CASE WHEN event_type = 'error' THEN strftime(ts, '%S')
                    WHEN user_id % 4 = 1 AND hour(ts) >= 12 THEN '24' ELSE '02' END AS ss,
               CASE WHEN (user_id % 4 IN (0, 1)) <> (event_id % 17 = 0) THEN 'dmx' ELSE 'ms.zip' END AS ext,
               event_type = 'error' AND event_id % 5 = 0 AS trig,
               event_type IN ('click', 'view') AS spaced,
               CAST(round(value * 100) AS BIGINT) + 1 AS length,
               '/archive/ST' || (user_id % 4) || '/continuous/' || strftime(ts, '%Y/%m/%d') AS folder
        FROM events""",
    "listed": """
        SELECT station_dir, day, hhmm, token AS station, length, folder, trig, event_id, props, ts,
               CASE WHEN spaced THEN 'spaced' ELSE 'underscored' END AS style,
               CASE WHEN spaced OR ext = 'dmx' THEN ss END AS ss,
               CAST(NULL AS VARCHAR) AS cha,
               ext AS kind,
               (CASE WHEN trig THEN '.trig.' ELSE '.' END) || ext AS ext,
               (CASE WHEN spaced THEN CAST(day AS VARCHAR) || ' ' || hhmm || ' ' || ss || ' '
                     WHEN ext = 'dmx' THEN CAST(day AS VARCHAR) || '_' || hhmm || '_' || ss || '_'
                     ELSE strftime(day, '%Y%m%d') || '_' || hhmm || '_' END)
                 || token || (CASE WHEN trig THEN '.trig.' ELSE '.' END) || ext AS name
        FROM named""",
    "files": """
        SELECT * FROM listed
        UNION ALL
        SELECT station_dir, day, hhmm, token, 100, folder, false, event_id, props, ts, 'spaced', ss,
               CASE WHEN event_id % 3 = 2 THEN 'CHZ' END,
               CASE event_id % 3 WHEN 0 THEN 'ss' WHEN 1 THEN 'xml' ELSE 'mseed' END,
               CASE event_id % 3 WHEN 0 THEN '.ss' WHEN 1 THEN '.station.xml' ELSE '.mseed.zip' END,
               CAST(day AS VARCHAR) || ' ' || hhmm || ' ' || ss || ' ' || token
                 || (CASE event_id % 3 WHEN 0 THEN '.ss' WHEN 1 THEN '.station.xml' ELSE '_CHZ.mseed.zip' END)
        FROM named WHERE event_id % 50 = 0""",
    "valid": """
        SELECT *, CASE kind WHEN 'dmx' THEN 'echo' ELSE 'gecko' END AS family
        FROM files WHERE kind IN ('dmx', 'ms.zip') AND NOT trig""",
    "valid_echo": "SELECT * FROM valid WHERE family = 'echo'",
    "valid_gecko": "SELECT * FROM valid WHERE family = 'gecko'",
    "counts": """
        SELECT station_dir, day,
               count(*) FILTER (kind = 'dmx') AS n_dmx,
               count(*) FILTER (kind = 'ms.zip') AS n_ms,
               count(*) FILTER (kind IN ('dmx', 'ms.zip')) AS n_total
        FROM files GROUP BY ALL""",
    "decided": f"""
        SELECT *, CASE WHEN n_ms = 0 AND n_dmx > 0 THEN 'echo'
                       WHEN n_dmx = 0 AND n_ms > 0 THEN 'gecko'
                       WHEN n_total >= {MIN_FILES} THEN CASE WHEN n_dmx > n_ms THEN 'echo' ELSE 'gecko' END
                  END AS decided
        FROM counts""",
    "types": """
        SELECT *, coalesce(last_value(decided IGNORE NULLS) OVER (
                    PARTITION BY station_dir ORDER BY day
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'echo') AS recorder
        FROM decided""",
    "types_month": """
        SELECT *, coalesce(last_value(decided IGNORE NULLS) OVER (
                    PARTITION BY station_dir, date_trunc('month', day) ORDER BY day
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'echo') AS recorder
        FROM decided""",
    "types_alone": "SELECT *, coalesce(decided, 'echo') AS recorder FROM decided",
    "tokens": """
        SELECT station_dir, day, station AS token, count(*) AS n
        FROM valid JOIN types_alone USING (station_dir, day)
        WHERE family = recorder GROUP BY ALL""",
    "token_rank": """
        SELECT *, row_number() OVER (PARTITION BY station_dir, day ORDER BY n DESC, token DESC) AS r
        FROM tokens""",
    "majority": "SELECT station_dir, day, token AS station FROM token_rank WHERE r = 1",
    "stamped": """
        SELECT *, ss AS stamp FROM files WHERE kind = 'dmx' AND style = 'underscored'""",
    "stamp_n": "SELECT station_dir, day, stamp, count(*) AS n FROM stamped GROUP BY ALL",
    "stamp_top": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_dir, day
                                                    ORDER BY n DESC, stamp DESC) AS r FROM stamp_n)
        WHERE r = 1""",
    "echo_counts": """
        SELECT station_dir, day, count(*) FILTER (style = 'underscored') AS us,
               count(*) FILTER (style = 'spaced') AS sp
        FROM valid_echo GROUP BY ALL""",
    "gecko_counts": """
        SELECT station_dir, day, count(*) FILTER (style = 'underscored') AS us,
               count(*) FILTER (style = 'spaced') AS sp
        FROM valid_gecko GROUP BY ALL""",
    "cascade_groups": """
        SELECT station_dir, day, style, CASE WHEN style = 'underscored' THEN ss END AS stamp, count(*) AS n
        FROM valid_echo GROUP BY ALL""",
    "cascade_full": f"""
        SELECT station_dir, day, max_by(stamp, (n, stamp)) AS full_stamp
        FROM cascade_groups WHERE stamp IS NOT NULL AND abs(n - {FULL}) <= {SHORT} GROUP BY ALL""",
    "cascade_days": f"""
        SELECT station_dir, day, full_stamp,
               coalesce(sum(n) FILTER (style = 'underscored'), 0) AS us,
               coalesce(sum(n) FILTER (style = 'spaced'), 0) AS sp,
               coalesce(sum(n) FILTER (stamp IS NOT NULL AND n >= {STAMP_MIN}), 0) AS common
        FROM cascade_groups LEFT JOIN cascade_full USING (station_dir, day) GROUP BY ALL""",
    "cascade": f"""
        SELECT station_dir, day, full_stamp,
               CASE WHEN abs(us - {FULL}) <= {SHORT} THEN 'local'
                    WHEN us < {NEAR} AND abs(sp - {FULL}) <= {SHORT} THEN 'telemetered'
                    WHEN us > {FULL + SHORT} AND full_stamp IS NOT NULL THEN 'one_stamp'
                    WHEN us > {FULL + SHORT} AND common >= {NEAR} THEN 'stamps'
                    WHEN us > {FULL + SHORT} THEN 'stamps_patched'
                    ELSE 'patched' END AS rule
        FROM cascade_days""",
    "cascade_files": """
        SELECT v.*, rule,
               v.style = 'underscored' AND (
                 rule IN ('local', 'patched')
                 OR (rule = 'one_stamp' AND v.ss = full_stamp)
                 OR (rule IN ('stamps', 'stamps_patched') AND g.n >= %d)) AS kept
        FROM valid_echo v JOIN cascade USING (station_dir, day)
        LEFT JOIN cascade_groups g ON g.station_dir = v.station_dir AND g.day = v.day
             AND g.style = 'underscored' AND g.stamp = v.ss""" % STAMP_MIN,
    "minute_files": """
        SELECT *, CASE WHEN kind = 'dmx' THEN 'dmx' ELSE 'ms' END AS side
        FROM files WHERE kind IN ('dmx', 'ms.zip', 'mseed')""",
    "minute_local": """
        SELECT DISTINCT station_dir, day, hhmm, side FROM minute_files WHERE style = 'underscored'""",
    "minute_local_grid": """
        SELECT DISTINCT station_dir, day, hhmm, side FROM minute_files
        WHERE style = 'underscored' AND NOT trig""",
    "present_minutes": """
        SELECT DISTINCT station_dir, day,
               CAST(substr(hhmm, 1, 2) AS INTEGER) * 60 + CAST(substr(hhmm, 3, 2) AS INTEGER) AS minute
        FROM files""",
    "day_rule": f"""
        SELECT station_dir, day, recorder,
               count(*) FILTER (family = recorder) AS n_valid,
               count(*) FILTER (family = recorder AND style = 'underscored') AS us,
               count(*) FILTER (family = recorder AND style = 'spaced') AS sp
        FROM types LEFT JOIN valid USING (station_dir, day) GROUP BY ALL""",
    "archive_days": f"""
        SELECT *, CASE WHEN us > 0 AND sp > 0 AND us < {NEAR} THEN 'all'
                       WHEN us > 0 THEN 'underscored' WHEN sp > 0 THEN 'spaced' END AS keep
        FROM day_rule""",
    "chosen": """
        SELECT v.*, recorder, keep FROM valid v JOIN archive_days d
          ON v.station_dir = d.station_dir AND v.day = d.day AND v.family = d.recorder
         AND (d.keep = 'all' OR d.keep = v.style)""",
    "raw_records": """
        SELECT 'AB' AS net, station_dir AS sta, '60' AS loc,
               CASE WHEN station_dir = 'ST3' THEN ['CHZ', 'CHN', 'CHE'][event_id % 3 + 1]
                    ELSE ['DLZ', 'DLN', 'DLE', 'DNZ', 'DNN', 'DNE'][event_id % 6 + 1] END AS cha,
               ts AS start_ts,
               ts + to_seconds(1 + event_id % 120) AS end_ts,
               100 * (1 + event_id % 120) AS n_samples,
               CAST(100 AS DOUBLE) AS rate,
               folder || '/' || name AS src_path,
               station_dir, day, event_id
        FROM listed
        CROSS JOIN LATERAL (SELECT unnest(range(CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END)))""",
    "unique_records": """
        SELECT net, sta, loc, cha, start_ts, end_ts, n_samples, rate,
               min(src_path) AS src_path, min(station_dir) AS station_dir, min(day) AS day,
               net || '.' || sta || '.' || loc || '.' || cha AS stream_id
        FROM raw_records GROUP BY ALL""",
    "streams": "SELECT DISTINCT station_dir, day, net, sta, loc, cha, stream_id FROM unique_records",
    "stream_n": "SELECT *, count(*) OVER (PARTITION BY station_dir, day) AS n_streams FROM streams",
    "channels": """
        SELECT * FROM (
          SELECT station_dir, day, stream_id, net, sta, loc, cha,
                 row_number() OVER (PARTITION BY station_dir, day ORDER BY cha, stream_id) AS ord
          FROM stream_n
          WHERE NOT (n_streams > 3 AND substr(cha, 2, 1) = 'N') AND right(cha, 1) IN ('Z', 'E', 'N'))
        WHERE ord <= 3""",
    "rules": """
        SELECT station_dir, day, ord, stream_id AS src,
               'VW.' || sta || '.00.CH' || right(cha, 1) AS dst FROM channels""",
    "specs": """
        SELECT station_dir, day, substr(cha, 1, 2) || '?' AS spec FROM channels WHERE ord = 1""",
    "sds": """
        SELECT *, year(start_ts) AS year, dayofyear(start_ts) AS doy,
               year(start_ts) || '/' || net || '/' || sta || '/' || cha || '.D/' || net || '.' || sta
                 || '.' || loc || '.' || cha || '.D.' || year(start_ts) || '.'
                 || lpad(CAST(dayofyear(start_ts) AS VARCHAR), 3, '0') AS sds_path
        FROM unique_records""",
    # The run: records of chosen files only, their own channels and rules.
    "run_records": """
        SELECT DISTINCT net, sta, loc, cha, start_ts, end_ts, n_samples, rate, station_dir, day,
               net || '.' || sta || '.' || loc || '.' || cha AS stream_id
        FROM raw_records
        WHERE src_path IN (SELECT folder || '/' || name FROM chosen)""",
    "run_streams": """
        SELECT *, count(*) OVER (PARTITION BY station_dir, day) AS n_streams
        FROM (SELECT DISTINCT station_dir, day, sta, cha, stream_id FROM run_records)""",
    "run_channels": """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY station_dir, day ORDER BY cha, stream_id) AS ord
          FROM run_streams
          WHERE NOT (n_streams > 3 AND substr(cha, 2, 1) = 'N') AND right(cha, 1) IN ('Z', 'E', 'N'))
        WHERE ord <= 3""",
    "run_plan": f"""
        SELECT d.station_dir, d.day, d.recorder,
               CASE d.keep WHEN 'all' THEN n_valid WHEN 'underscored' THEN us WHEN 'spaced' THEN sp ELSE 0 END AS n_selected,
               count(c.ord) AS n_rules
        FROM archive_days d LEFT JOIN run_channels c ON c.station_dir = d.station_dir AND c.day = d.day
        GROUP BY ALL""",
    "day_status": f"""
        SELECT *, CASE WHEN day < {PRESENT} THEN 'PRESENT' WHEN n_selected = 0 THEN 'EMPTY'
                       WHEN n_rules = 0 THEN 'NO_RULES' ELSE 'OK' END AS status
        FROM run_plan""",
    "lines": """
        SELECT station_dir AS station, day, event_id AS line_no,
               hhmm || ' ' || event_type || ' ' || props AS line
        FROM named""",
    "tail": f"""
        SELECT station, day, line_no, line FROM (
          SELECT *, row_number() OVER (PARTITION BY station, day ORDER BY line_no DESC) AS r FROM lines)
        WHERE r <= {TAIL}""",
}

_FILE = "station_dir, day, name, length"
_KEY = "net, sta, loc, cha, start_ts, end_ts, n_samples"
_FILED = f"{_KEY}, rate, year(start_ts) AS year, dayofyear(start_ts) AS doy"


def _with(body: str) -> str:
    """Prefix the CTEs that `body` needs, directly or through others."""
    def uses(text: str) -> set[str]:
        return {c for c in CTES if re.search(rf"\b(?:FROM|JOIN)\s+{c}\b", text)}

    needed, todo = set(), uses(body)
    while todo:
        needed |= todo
        todo = set().union(*[uses(CTES[c]) for c in todo]) - needed
    heads = ", ".join(f"{c} AS ({CTES[c]})" for c in CTES if c in needed)
    return f"WITH {heads} {body}" if heads else body


def _histogram(select: str) -> str:
    return f"""
        SELECT station_dir, day, stamp, n,
               row_number() OVER (PARTITION BY station_dir, day ORDER BY n DESC, stamp DESC) AS rank
        FROM (SELECT station_dir, day, stamp, count(*) AS n FROM ({select}) GROUP BY ALL)"""


_SPACED_ECHO = "SELECT *, ss AS stamp FROM files WHERE style = 'spaced' AND kind = 'dmx' AND NOT trig"
_SPACED_GECKO = "SELECT *, ss AS stamp FROM files WHERE style = 'spaced' AND kind = 'ms.zip' AND NOT trig"
_US_GECKO = "SELECT *, station AS stamp FROM files WHERE style = 'underscored' AND kind = 'ms.zip' AND NOT trig"


def _near(counts: str, valid: str) -> str:
    return f"""
        SELECT {_FILE} FROM {valid} JOIN {counts} USING (station_dir, day)
        WHERE style = 'underscored' OR (style = 'spaced' AND (us = 0 OR us < {NEAR}))"""


def _level(when_month: str) -> str:
    """Levels of the folders of a listing whose day folders all hold files."""
    return f"""
        SELECT folder, CASE WHEN n_archive > 0 THEN 'DAY' {when_month} ELSE 'UNKNOWN' END AS level
        FROM ({_SHAPE})"""


_SHAPE = r"""
        SELECT folder,
               CAST(sum(CASE WHEN up = 0 THEN n ELSE 0 END) AS BIGINT) AS n_data,
               CAST(sum(CASE WHEN up = 0 THEN n ELSE 0 END) AS BIGINT) AS n_archive,
               bool_or(up = 1 AND n > 0) AS child_has_data,
               count(DISTINCT child) AS n_subfolders,
               count(DISTINCT CASE WHEN regexp_matches(child, '^\d\d$') THEN child END) AS n_two_digit
        FROM (
          SELECT array_to_string(parts[1:len(parts) - up], '/') AS folder, up, n,
                 CASE WHEN up > 0 THEN parts[len(parts) - up + 1] END AS child
          FROM (SELECT string_split(folder, '/') AS parts, count(*) FILTER (kind IN ('dmx', 'ms.zip')) AS n
                FROM files GROUP BY folder) AS leaves, LATERAL (SELECT unnest(range(len(parts))) AS up)
          WHERE len(parts) > up + 1)
        GROUP BY folder"""

_TYPE_OUT = "station_dir, day, n_dmx, n_ms, n_total, decided, recorder"

_IMPORTED = """
        SELECT DISTINCT CASE WHEN c.ord IS NULL THEN net ELSE 'VW' END AS net, r.sta,
               CASE WHEN c.ord IS NULL THEN loc ELSE '00' END AS loc,
               CASE WHEN c.ord IS NULL THEN r.cha ELSE 'CH' || right(r.cha, 1) END AS cha,
               start_ts, end_ts, n_samples, rate, year(start_ts) AS year, dayofyear(start_ts) AS doy
        FROM run_records r
        JOIN run_channels f ON f.station_dir = r.station_dir AND f.day = r.day AND f.ord = 1
             AND length(r.cha) = 3 AND left(r.cha, 2) = left(f.cha, 2)
        LEFT JOIN run_channels c
          ON c.station_dir = r.station_dir AND c.day = r.day AND c.stream_id = r.stream_id"""

_BODIES = {
    "parse_names": """
        SELECT folder || '/' || name AS path, station_dir, day, name, day AS date, hhmm, ss, station, cha, ext,
               style, trig AS is_trig, regexp_replace(name, '\\.[^.]+$', '') AS stem,
               length(name) - length(replace(name, '_', '')) AS n_underscores,
               CAST(substr(hhmm, 1, 2) AS INTEGER) * 60 + CAST(substr(hhmm, 3, 2) AS INTEGER) AS minute,
               kind IN ('ms.zip', 'mseed') AS compressed,
               CASE kind WHEN 'dmx' THEN 'echo' WHEN 'ms.zip' THEN 'gecko' END AS family
        FROM files""",
    "strict_spaced_names": """
        SELECT station_dir, day, name,
               style = 'spaced' AND kind = 'dmx' AND NOT trig AS strict_echo,
               style = 'spaced' AND kind = 'ms.zip' AND NOT trig AS strict_gecko
        FROM files""",
    "valid_files": f"SELECT family, {_FILE} FROM valid",
    "day_folders": """
        SELECT DISTINCT station_dir, day FROM files
        WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "family_counts": "SELECT station_dir, day, n_dmx, n_ms, n_total FROM counts",
    "recorder_type": f"SELECT {_TYPE_OUT} FROM types",
    "recorder_type_monthly": f"SELECT {_TYPE_OUT} FROM types_month",
    "recorder_type_alone": f"SELECT {_TYPE_OUT} FROM types_alone",
    "folder_shape": _SHAPE,
    "archive_level": _level("WHEN child_has_data THEN 'MONTH' WHEN n_subfolders > 0 THEN 'YEAR'"),
    "archive_level_by_name": _level(
        r"WHEN regexp_matches(folder, '/\d{4}/(0[1-9]|1[0-2])$') OR n_two_digit >= 28 THEN 'MONTH'"
        " WHEN n_two_digit <= 12 AND n_subfolders > 0 THEN 'YEAR'"
    ),
    "archive_level_by_count": _level(
        "WHEN n_two_digit >= 28 THEN 'MONTH' WHEN n_two_digit BETWEEN 1 AND 12 THEN 'YEAR'"
    ),
    "majority_station": "SELECT station_dir, day, station FROM majority",
    "station_census": f"""
        SELECT station_dir, day, max(token) FILTER (r = 1) AS station, max(n) AS n_station,
               CAST(sum(n) AS BIGINT) AS n_files, count(*) AS n_names,
               max(n) >= {MIN_COUNT} AS count_ok,
               CAST(max(n) AS DOUBLE) / CAST(sum(n) AS BIGINT) AS confidence
        FROM token_rank GROUP BY station_dir, day""",
    "station_errants": "SELECT station_dir, day, token AS errant, n FROM token_rank WHERE r > 1",
    "resolve_station": """
        SELECT DISTINCT f.station_dir, f.day, coalesce(m.station, 'UNKNOWN') AS station
        FROM files f LEFT JOIN majority m ON m.station_dir = f.station_dir AND m.day = f.day""",
    "errant_files": f"SELECT {_FILE}, station FROM files WHERE station <> station_dir",
    "stamp_histogram": _histogram("SELECT * FROM stamped"),
    "stamp_histogram_spaced_echo": _histogram(_SPACED_ECHO),
    "stamp_histogram_spaced_gecko": _histogram(_SPACED_GECKO),
    "underscored_gecko_stations": _histogram(_US_GECKO),
    "stamp_totals": """
        SELECT station_dir, day, source, count(*) FILTER (hit) AS n_considered FROM (
          SELECT station_dir, day, 'underscored' AS source, style = 'underscored' AND kind = 'dmx' AS hit FROM files
          UNION ALL SELECT station_dir, day, 'spaced_echo', style = 'spaced' AND kind = 'dmx' AND NOT trig FROM files
          UNION ALL SELECT station_dir, day, 'spaced_gecko', style = 'spaced' AND kind = 'ms.zip' AND NOT trig FROM files
          UNION ALL SELECT station_dir, day, 'underscored_gecko',
                           style = 'underscored' AND kind = 'ms.zip' AND NOT trig FROM files)
        GROUP BY ALL""",
    "stamp_mode": "SELECT station_dir, day, stamp, n FROM stamp_top",
    "stamp_diff": """
        SELECT station_dir, day, total, stamp, n AS matching, total - n AS not_matching
        FROM stamp_top JOIN (SELECT station_dir, day, count(*) AS total FROM stamped GROUP BY ALL)
        USING (station_dir, day)""",
    "day_modes": """
        SELECT station_dir, day,
               max_by(stamp, (n, stamp)) FILTER (k = 'us') AS us_stamp, max(n) FILTER (k = 'us') AS us_n,
               max_by(stamp, (n, stamp)) FILTER (k = 'sp') AS sp_stamp, max(n) FILTER (k = 'sp') AS sp_n
        FROM (SELECT station_dir, day, ss AS stamp, CASE style WHEN 'underscored' THEN 'us' ELSE 'sp' END AS k,
                     count(*) AS n
              FROM files WHERE (style = 'spaced' OR kind = 'dmx') AND kind <> 'mseed'
                           AND NOT (trig AND kind = 'dmx') GROUP BY ALL)
        GROUP BY station_dir, day""",
    "rare_stamp_files": f"""
        SELECT {_FILE}, stamp, n FROM stamped JOIN stamp_n USING (station_dir, day, stamp) WHERE n < {STAMP_MIN}""",
    "style_counts": """
        SELECT station_dir, day, count(*) FILTER (style = 'underscored') AS n_underscored,
               count(*) FILTER (style = 'spaced') AS n_spaced, count(*) AS n_files
        FROM files GROUP BY ALL""",
    "day_completeness": f"""
        SELECT station_dir, day, us AS n_underscored, sp AS n_spaced, us + sp AS n_files, {FULL} - us AS missing,
               CAST(us AS DOUBLE) / {FULL} AS share_underscored, CAST(sp AS DOUBLE) / {FULL} AS share_spaced,
               us >= {NEAR} AS near_complete
        FROM echo_counts""",
    "select_near_complete": _near("echo_counts", "valid_echo"),
    "select_near_complete_gecko": _near("gecko_counts", "valid_gecko"),
    "select_near_complete_v0": f"""
        SELECT {_FILE} FROM valid_echo JOIN echo_counts USING (station_dir, day)
        WHERE us < {NEAR} OR style = 'underscored'""",
    "select_all_valid": f"SELECT {_FILE} FROM valid_echo",
    "select_per_minute": f"""
        SELECT {_FILE} FROM minute_files f WHERE style = 'underscored' OR NOT EXISTS (
          SELECT 1 FROM minute_local l WHERE l.station_dir = f.station_dir AND l.day = f.day
             AND l.hhmm = f.hhmm AND l.side = f.side)""",
    "select_per_minute_grid": f"""
        SELECT {_FILE} FROM minute_files f WHERE NOT trig AND (style = 'underscored' OR NOT EXISTS (
          SELECT 1 FROM minute_local_grid l WHERE l.station_dir = f.station_dir AND l.day = f.day
             AND l.hhmm = f.hhmm AND l.side = f.side))""",
    "select_larger": f"""
        SELECT {_FILE} FROM (
          SELECT *, row_number() OVER (PARTITION BY station_dir, day, hhmm, side
                    ORDER BY length DESC, style = 'underscored' DESC, name) AS r FROM minute_files)
        WHERE r = 1""",
    "select_by_stamp": f"""
        SELECT {_FILE} FROM (
          SELECT *, count(*) OVER (PARTITION BY station_dir, day) AS total,
                 count(*) OVER (PARTITION BY station_dir, day, stamp) AS n FROM stamped)
        WHERE total = {FULL} OR n >= {STAMP_MIN}""",
    "cascade_plan": "SELECT station_dir, day, rule FROM cascade",
    "select_cascade": f"""
        SELECT {_FILE}, rule FROM cascade_files f
        WHERE kept OR (style = 'spaced' AND (rule = 'telemetered' OR (
          rule IN ('patched', 'stamps_patched') AND NOT EXISTS (
            SELECT 1 FROM cascade_files k WHERE k.kept AND k.station_dir = f.station_dir
               AND k.day = f.day AND k.hhmm = f.hhmm))))""",
    "patch_minutes": f"""
        SELECT {_FILE} FROM valid_echo f WHERE style = 'underscored' OR NOT EXISTS (
          SELECT 1 FROM valid_echo l WHERE l.style = 'underscored' AND l.station_dir = f.station_dir
             AND l.day = f.day AND l.hhmm = f.hhmm)""",
    "missing_minutes": """
        SELECT station_dir, day, minute FROM
          (SELECT DISTINCT station_dir, day, unnest(range(1440)) AS minute FROM files)
          ANTI JOIN present_minutes USING (station_dir, day, minute)""",
    "missing_minute_counts": """
        SELECT station_dir, day, 1440 - count(*) AS n_missing FROM present_minutes GROUP BY ALL""",
    "choose_files": f"SELECT {_FILE}, recorder, keep FROM chosen",
    "dedup_records": f"SELECT {_KEY}, rate, src_path FROM unique_records",
    "sorted_records": f"""
        SELECT {_KEY}, row_number() OVER (PARTITION BY net, sta, loc, cha, CAST(start_ts AS DATE)
                       ORDER BY end_ts, start_ts, n_samples) AS position FROM unique_records""",
    "stream_inventory": """
        SELECT stream_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts, count(*) AS records,
               CAST(sum(n_samples) AS BIGINT) AS samples, max(rate) AS rate
        FROM unique_records GROUP BY stream_id""",
    "stream_inventory_daily": """
        SELECT station_dir, day, stream_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts, count(*) AS records,
               CAST(sum(n_samples) AS BIGINT) AS samples, max(rate) AS rate
        FROM unique_records GROUP BY station_dir, day, stream_id""",
    "inventory_summary": """
        SELECT min(start_ts) AS start_ts, max(end_ts) AS end_ts, count(DISTINCT net) AS networks,
               count(DISTINCT (net, sta)) AS stations, count(DISTINCT stream_id) AS streams,
               count(*) AS records, CAST(sum(n_samples) AS BIGINT) AS samples
        FROM unique_records""",
    "too_many_streams": """
        SELECT station_dir, day, count(*) AS n_streams FROM streams GROUP BY ALL HAVING count(*) > 3""",
    "select_channels": "SELECT station_dir, day, ord, stream_id, net, sta, loc, cha FROM channels",
    "select_channels_v0": """
        SELECT * FROM (
          SELECT station_dir, day, stream_id, net, sta, loc, cha,
                 row_number() OVER (PARTITION BY station_dir, day ORDER BY stream_id) AS ord
          FROM stream_n WHERE NOT (n_streams > 3 AND contains(stream_id, 'N')))
        WHERE ord <= 3""",
    "rename_rules": "SELECT station_dir, day, ord, src, dst FROM rules",
    "rename_strings": """
        SELECT station_dir, day, string_agg(src || ':' || dst, ',' ORDER BY ord) AS rename, any_value(spec) AS spec
        FROM rules JOIN specs USING (station_dir, day) GROUP BY station_dir, day""",
    "channel_spec": "SELECT station_dir, day, spec FROM specs",
    "renamed_records": """
        SELECT coalesce(split_part(dst, '.', 1), net) AS net, coalesce(split_part(dst, '.', 2), sta) AS sta,
               coalesce(split_part(dst, '.', 3), loc) AS loc, coalesce(split_part(dst, '.', 4), cha) AS cha,
               start_ts, end_ts, n_samples, u.station_dir, u.day
        FROM unique_records u JOIN specs s
          ON s.station_dir = u.station_dir AND s.day = u.day AND u.cha LIKE replace(s.spec, '?', '_')
        LEFT JOIN rules r ON r.station_dir = u.station_dir AND r.day = u.day AND r.src = u.stream_id""",
    "renamed_wildcard": """
        SELECT CASE WHEN sta = 'ST1' AND cha = 'DLZ' THEN 'VW' WHEN sta = 'ST1' AND cha LIKE 'DL%' THEN 'VX'
                    WHEN cha = 'DLE' THEN 'VY' ELSE 'ZZ' END AS net,
               sta,
               CASE WHEN sta = 'ST1' AND cha = 'DLZ' THEN '00' WHEN sta <> 'ST1' AND cha = 'DLE' THEN '10'
                    ELSE loc END AS loc,
               CASE WHEN sta <> 'ST1' AND cha = 'DLE' THEN 'BHE' ELSE cha END AS cha,
               start_ts, end_ts, n_samples
        FROM unique_records""",
    "band_codes": f"""
        SELECT {_KEY}, rate, corner_period,
               CASE WHEN rate >= 250 AND rate < 1000 THEN CASE WHEN corner_period < 10 THEN 'D' ELSE 'C' END
                    WHEN rate >= 80 THEN CASE WHEN corner_period < 10 THEN 'E' ELSE 'H' END
                    WHEN rate >= 10 THEN CASE WHEN corner_period < 10 THEN 'S' ELSE 'B' END END AS band_code,
               CASE substr(cha, 2, 1) WHEN 'H' THEN 'High Gain Seismometer' WHEN 'L' THEN 'Low Gain Seismometer'
                    WHEN 'N' THEN 'Accelerometer' END AS instrument
        FROM (SELECT {_KEY},
                     CAST([5, 20, 100, 250, 500, 1000][(n_samples // 100) % 6 + 1] AS DOUBLE) AS rate,
                     CAST(CASE WHEN n_samples % 700 = 0 THEN 60 ELSE 2 END AS DOUBLE) AS corner_period
              FROM unique_records)""",
    "sds_keys": f"SELECT {_KEY}, year, doy, sds_path FROM sds",
    "sds_day_counts": """
        SELECT year, net, sta, loc, cha, doy, sds_path, count(*) AS records,
               CAST(sum(n_samples) AS BIGINT) AS samples
        FROM sds GROUP BY ALL""",
    "midnight_spill": f"SELECT station_dir, day, {_KEY} FROM unique_records WHERE CAST(end_ts AS DATE) > day",
    "skip_present_days": f"SELECT DISTINCT net, sta, year, doy FROM sds WHERE start_ts >= {PRESENT}",
    "new_records": f"SELECT {_KEY} FROM unique_records WHERE start_ts >= {PRESENT}",
    "write_sds_roundtrip": f"SELECT {_FILED}, CAST(0 AS INTEGER) AS written_again FROM unique_records",
    "rehome_roundtrip": f"SELECT {_FILED.replace('net,', chr(39) + 'VX' + chr(39) + ' AS net,', 1)} FROM unique_records",
    "manifest_roundtrip": f"""
        SELECT {_FILE}, style, year(day) AS year FROM valid_echo JOIN echo_counts USING (station_dir, day)
        WHERE style = 'underscored' OR us = 0 OR us < {NEAR}""",
    "catalog_roundtrip": f"SELECT folder || '/' || name AS path, year(day) AS year, {_FILE} FROM files",
    "expand_members": """
        SELECT folder || '/' || name || (CASE kind WHEN 'dmx' THEN '.gz' ELSE '' END) AS path,
               CASE kind WHEN 'dmx' THEN name ELSE left(name, length(name) - 4) END AS member,
               CAST(strlen(props) AS BIGINT) AS member_size, md5(props) AS digest
        FROM listed""",
    "day_plan": "SELECT station_dir, day, recorder, n_selected, n_rules, status FROM day_status",
    "run_summary": """
        SELECT station_dir AS station, status, 2 * count(*) AS n_days FROM day_status GROUP BY ALL""",
    "run_lines": """
        SELECT station_dir AS station, day,
               CAST(day AS VARCHAR) || ' | ' || recorder || ' | Status: ' || status AS line FROM day_status""",
    "day_lines": """
        SELECT station_dir AS station, day, unnest(range(5)) AS line_no,
               unnest(['Station-day taken up: ' || day, 'Recorder family: ' || recorder,
                       'Selected files: ' || n_selected, 'Rename rules: ' || n_rules,
                       'Status: ' || status]) AS line
        FROM day_status""",
    "last_log_lines": "SELECT station, day, line_no, line FROM tail",
    "crash_report": """
        SELECT station, day, error, line_no, line FROM tail JOIN (
          SELECT station, day, CAST(count(*) FILTER (contains(line, ' error ')) AS VARCHAR) AS error
          FROM lines GROUP BY ALL HAVING count(*) FILTER (contains(line, ' error ')) * 4 > count(*))
        USING (station, day)""",
    "import_archive": _IMPORTED,
    "import_one_day": f"{_IMPORTED} WHERE r.day = DATE '2024-01-15'",
    "filed_payloads": """
        SELECT 'AB' AS net, station_dir AS sta, '60' AS loc,
               CASE WHEN station_dir = 'ST3' THEN ['CHZ', 'CHN', 'CHE'][event_id % 3 + 1]
                    ELSE ['DLZ', 'DLN', 'DLE', 'DNZ', 'DNN', 'DNE'][event_id % 6 + 1] END AS cha,
               ts AS start_ts, ts + to_seconds(1 + event_id % 120) AS end_ts,
               100 * (1 + event_id % 120) AS n_samples, md5(props) AS digest,
               min(folder || '/' || name) AS src_path
        FROM listed GROUP BY ALL""",
}

# A listing with ancillary files alone on every fifth day, and records without known
# channels on the days after: the chain of decisions over it.
_ODD = ["files", "valid", "counts", "decided", "types", "day_rule", "archive_days", "chosen", "raw_records",
        "run_records", "run_streams", "run_channels", "run_plan"]


def _odd(text: str) -> str:
    return re.sub(rf"\b({'|'.join(_ODD)})\b", r"odd_\1", text)


CTES["odd_files"] = "SELECT * FROM files WHERE kind NOT IN ('dmx', 'ms.zip') OR dayofmonth(day) % 5 <> 0"
for _name in _ODD[1:]:
    CTES[f"odd_{_name}"] = _odd(CTES[_name])
CTES["odd_types"] = CTES["odd_types"].replace("'echo') AS recorder", "'none') AS recorder")
CTES["odd_raw_records"] = """
        SELECT * REPLACE (CASE WHEN dayofmonth(day) % 5 = 1 THEN 'DL1' ELSE cha END AS cha) FROM raw_records"""
CTES["sparse_days"] = """
        SELECT station_dir, day, us, sp, CASE WHEN abs(us - 3) <= 1 THEN 'local'
                    WHEN us < 2 AND abs(sp - 3) <= 1 THEN 'telemetered' ELSE 'patched' END AS rule
        FROM gecko_counts"""
# A record of a chosen file that meets its day's spec; copies count.
CTES["run_raw"] = """
        SELECT r.* FROM raw_records r
        JOIN run_channels f ON f.station_dir = r.station_dir AND f.day = r.day AND f.ord = 1
             AND length(r.cha) = 3 AND left(r.cha, 2) = left(f.cha, 2)
        WHERE src_path IN (SELECT folder || '/' || name FROM chosen)"""
CTES["lost_days"] = """
        SELECT station_dir, day, count(*) FILTER (bad) AS n_rejected,
               count(DISTINCT (net, sta, loc, cha, start_ts, end_ts, n_samples)) FILTER (NOT bad) AS n_filed
        FROM (SELECT *, dayofmonth(start_ts) % 7 = 3 AND n_samples % 200 = 0 AS bad FROM run_raw) GROUP BY ALL"""

_BODIES.update({
    "days_changed": """
        SELECT station_dir, day, CASE WHEN day < DATE '2024-01-20' AND early > 0 THEN early END AS n_before, n_files,
               CASE WHEN day >= DATE '2024-01-20' OR early = 0 THEN 'new' WHEN early <> n_files THEN 'changed' ELSE 'same' END AS change
        FROM (SELECT station_dir, day, count(*) AS n_files,
                     count(*) FILTER (event_id % 29 <> 0 OR ts < TIMESTAMP '2024-01-11') AS early FROM files GROUP BY ALL)""",
    "refiled_days": _IMPORTED,
    "import_with_key_table": _IMPORTED,
    "recorder_type_stored": f"SELECT {_TYPE_OUT} FROM types WHERE day >= DATE '2024-01-15'",
    "carried_into_weeks": """
        SELECT station_dir, period, last_value(decided IGNORE NULLS) OVER (PARTITION BY station_dir ORDER BY period
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried
        FROM (SELECT station_dir, CAST(date_trunc('week', day) AS DATE) AS period,
                     max_by(decided, day) FILTER (decided IS NOT NULL) AS decided FROM decided GROUP BY ALL)""",
    "rehome_resumed": """
        SELECT year, doy, count(*) AS n_in, count(*) AS n_out FROM (SELECT year(start_ts) AS year, dayofyear(start_ts) AS doy FROM unique_records)
        GROUP BY ALL""",
    "renamed_by_table": """
        SELECT CASE WHEN sta = 'ST1' AND cha = 'DLZ' THEN 'VW' WHEN cha = 'DLE' THEN 'VY' WHEN sta = 'ST1' THEN 'VX' ELSE 'ZZ' END AS net,
               sta, CASE WHEN sta = 'ST1' AND cha = 'DLZ' THEN '00' WHEN cha = 'DLE' THEN '10' ELSE loc END AS loc,
               CASE WHEN cha = 'DLE' THEN 'BHE' ELSE cha END AS cha, start_ts, end_ts, n_samples
        FROM unique_records""",
    "failed_days": """
        SELECT p.station_dir, p.day,
               CASE WHEN n_rejected > 0 THEN 'FAILED' WHEN n_selected = 0 THEN 'EMPTY' WHEN n_rules = 0 THEN 'NO_RULES' ELSE 'OK' END AS status,
               CASE WHEN n_rejected > 0 THEN n_rejected END AS n_rejected,
               CASE WHEN n_rejected > 0 THEN 'no end time' END AS reason,
               CASE WHEN n_filed > 0 THEN n_filed END AS n_filed
        FROM run_plan p LEFT JOIN lost_days l ON l.station_dir = p.station_dir AND l.day = p.day""",
    "walked_folders": """
        SELECT station_dir || '/continuous/' || strftime(day, '%Y/%m/%d') || '/' || min(name) AS path,
               station_dir, day, min(name) AS name, 10 * count(*) AS length
        FROM listed GROUP BY station_dir, day, kind""",
    "record_conflicts": f"""
        SELECT {_KEY}, count(*) AS versions, string_agg(src_path, '|' ORDER BY src_path) AS sources
        FROM (
          SELECT {_KEY}, digest, min(src_path) AS src_path FROM (
            SELECT {_KEY}, src_path, md5(props) AS digest FROM raw_records JOIN (SELECT event_id, props FROM named) USING (event_id)
            UNION ALL SELECT {_KEY}, src_path || '.gz', md5('other') FROM raw_records WHERE n_samples % 700 = 0)
          GROUP BY ALL)
        GROUP BY ALL HAVING count(*) > 1""",
    "manifest_again": _BODIES["manifest_roundtrip"],
    "select_cascade_gecko": f"""
        SELECT {_FILE}, rule FROM valid_gecko f JOIN sparse_days USING (station_dir, day)
        WHERE (style = 'underscored' AND rule <> 'telemetered') OR (style = 'spaced' AND (rule = 'telemetered' OR (
          rule = 'patched' AND NOT EXISTS (
            SELECT 1 FROM valid_gecko k WHERE k.style = 'underscored' AND k.station_dir = f.station_dir
               AND k.day = f.day AND k.hhmm = f.hhmm))))""",
    "day_plan_statuses": """
        SELECT station_dir, day, recorder, CASE WHEN recorder = 'none' THEN 0 ELSE n_selected END AS n_selected,
               CASE WHEN recorder = 'none' THEN 0 ELSE n_rules END AS n_rules,
               CASE WHEN dayofmonth(day) = 7 THEN 'PRESENT' WHEN recorder = 'none' THEN 'UNKNOWN_RECORDER'
                    WHEN n_selected = 0 THEN 'EMPTY' WHEN n_rules = 0 THEN 'NO_RULES' ELSE 'OK' END AS status
        FROM odd_run_plan""",
})

ORACLES = {name: _with(body).strip() for name, body in _BODIES.items()}
