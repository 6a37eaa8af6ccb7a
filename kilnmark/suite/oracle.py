"""The same answers as plain SQL over the driver's tables (DuckDB dialect)."""

from __future__ import annotations

EVENT_METERS = ("click", "error", "signup", "view")
METERS = ("inputTemperatureProduct", "waterFlowProcess", "intensityFanProcess", "waterTemperatureProcess",
          "temperatureProcess1", "temperatureProcess2")

EV = """ev AS (
    SELECT event_id, ts, CAST(ts AS DATE) AS archive_day, printf('%03d', user_id % 3 + 1) AS factory_id,
           printf('%03d', user_id) AS oven_id, event_type, value,
           CASE WHEN event_type = 'purchase' THEN value END AS productHumidity,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS datetime
    FROM events)"""

SENSOR = "sensor AS (SELECT * FROM ev WHERE event_type <> 'purchase')"
ROUND2 = "CAST(round(CAST({0} AS DECIMAL(18, 6)), 2) AS DOUBLE)"
FILE_COLUMNS = {m: "avginputTemperatureProduct" if m == METERS[0] else "avg" + m[0].upper() + m[1:] for m in METERS}
EXPORT = ", ".join(f'value + {i} AS "{m}"' for i, m in enumerate(METERS))


def _means(alias="{m}", source="value", digits=6):
    return ", ".join(
        f"round(avg(CASE WHEN event_type = '{m}' THEN {source} END), {digits}) AS \"{alias.format(m=m)}\""
        for m in EVENT_METERS)


# --- segments ---------------------------------------------------------------

def _marked(part: str) -> str:
    return f"""marked AS (
        SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
            PARTITION BY factory_id, oven_id{part} ORDER BY ts
            RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker
        FROM ev)"""


SEGMENTS = f"""WITH {EV}, {_marked(', archive_day')}, segments AS (
    SELECT factory_id || '#' || oven_id || '#' || strftime(archive_day, '%Y%m%d') || '#'
               || strftime(min(ts), '%H%M') || '#' || strftime(max(ts), '%H%M') AS key,
           factory_id, oven_id, archive_day, min(ts) AS "startTimestamp", max(ts) AS "endTimestamp",
           max(productHumidity) AS "productHumidity", {_means('avg_{m}')}, count(*) AS n_rows
    FROM marked WHERE marker IS NOT NULL
    GROUP BY factory_id, oven_id, archive_day, marker)"""
SEGMENT_COLUMNS = ('key, factory_id, oven_id, archive_day, "startTimestamp", "endTimestamp", "productHumidity", '
                   + ", ".join(f"avg_{m}" for m in EVENT_METERS))

CROSS_MIDNIGHT = f"""WITH {EV}, {_marked('')}
    SELECT factory_id, oven_id, min(ts) AS start_ts, max(ts) AS end_ts, max(productHumidity) AS "productHumidity",
           count(*) AS n_rows, {_means('avg_{m}')}
    FROM marked WHERE marker IS NOT NULL GROUP BY factory_id, oven_id, marker"""

SHIFTED = f"""WITH {EV}, cut AS (SELECT *, CAST(ts - INTERVAL 6 HOUR AS DATE) AS unit FROM ev), marked AS (
        SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
            PARTITION BY factory_id, oven_id, unit ORDER BY ts
            RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker,
            min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY factory_id, oven_id, unit) AS first_marker
        FROM cut)
    SELECT factory_id || '#' || oven_id || '#' || strftime(first_marker, '%Y%m%d') || '#'
               || strftime(min(ts), '%H%M') || '#' || strftime(max(ts), '%H%M') AS key,
           factory_id, oven_id, min(ts) AS "startTimestamp", max(ts) AS "endTimestamp",
           max(productHumidity) AS "productHumidity", {_means('avg_{m}')}
    FROM marked WHERE marker IS NOT NULL GROUP BY factory_id, oven_id, unit, first_marker, marker"""

FILES = f"""WITH {EV}, cut AS (
        SELECT *, date_trunc('second', ts) AS s, CAST(date_trunc('second', ts) - INTERVAL 6 HOUR AS DATE) AS unit FROM ev),
    marked AS (
        SELECT *, min(CASE WHEN event_type = 'purchase' THEN s END) OVER (
            PARTITION BY unit ORDER BY s RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker,
            min(CASE WHEN event_type = 'purchase' THEN s END) OVER (PARTITION BY unit) AS first_marker
        FROM cut)
    SELECT '001#001#' || strftime(first_marker, '%Y%m%d') || '#' || strftime(min(s), '%H%M') || '#'
               || strftime(max(s), '%H%M') AS key,
           CAST(first_marker AS DATE) AS archive_day, min(s) AS "startTimestamp", max(s) AS "endTimestamp",
           max(productHumidity) AS "productHumidity",
           {', '.join(f'round(avg(value + {METERS.index(m)}), 6) AS "{c}"' for m, c in FILE_COLUMNS.items())}
    FROM marked WHERE marker IS NOT NULL GROUP BY unit, first_marker, marker"""

MANY_OVENS = SEGMENTS + """
    SELECT factory_id, oven_id, count(*) AS n_segments, CAST(sum(n_rows) AS BIGINT) AS n_rows,
           max("productHumidity") AS max_humidity, round(avg(click_exact), 6) AS mean_click
    FROM segments GROUP BY factory_id, oven_id"""
MANY_OVENS = MANY_OVENS.replace("count(*) AS n_rows",
                                "avg(CASE WHEN event_type = 'click' THEN value END) AS click_exact, count(*) AS n_rows")

# --- running averages ---------------------------------------------------------

HALF_HOURS = f"""WITH {EV}, {SENSOR}, spread AS (
    SELECT factory_id, oven_id, event_type, value,
           unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start
    FROM sensor)"""
RUNNING = HALF_HOURS + """, running AS (
    SELECT factory_id, oven_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type AS meter,
           avg(value) AS avg
    FROM spread GROUP BY factory_id, oven_id, window_start, event_type)"""
WIDE = HALF_HOURS + f""", wide AS (
    SELECT factory_id || '#' || oven_id || '#' || strftime(window_start + INTERVAL 1 HOUR, '%Y%m%d%H%M') AS key,
           factory_id, oven_id, window_start, window_start + INTERVAL 1 HOUR AS window_end,
           {', '.join(f"avg(CASE WHEN event_type = '{m}' THEN value END) AS " + f'"{m}"' for m in EVENT_METERS)}
    FROM spread GROUP BY factory_id, oven_id, window_start)"""
WIDE6 = ", ".join(f'round("{m}", 6) AS "{m}"' for m in EVENT_METERS)
WIDE2 = ", ".join(ROUND2.format(f'"{m}"') + f' AS "{m}"' for m in EVENT_METERS)
RUNNING_ROWS = RUNNING + """
    SELECT factory_id, oven_id, window_start, window_end, meter, round(avg, 6) AS avg FROM running"""

UNEVEN = f"""WITH {EV}, {SENSOR}, spread AS (
    SELECT *, unnest([0, 1, 2]) AS back, epoch_us(ts) // 420000000 AS slot FROM sensor), placed AS (
    SELECT *, make_timestamp((slot - back) * 420000000) AS window_start FROM spread)
    SELECT factory_id, oven_id, window_start, window_start + INTERVAL 15 MINUTE AS window_end, event_type AS meter,
           round(avg(value), 6) AS avg
    FROM placed WHERE window_start + INTERVAL 15 MINUTE > ts
    GROUP BY factory_id, oven_id, window_start, event_type"""

IN_24H = """ WHERE window_end >= TIMESTAMP '2024-01-14 12:34:00' AND window_end < TIMESTAMP '2024-01-15 12:34:00'"""
IN_12MIN = """ WHERE window_end >= TIMESTAMP '2024-01-15 11:53:00' AND window_end < TIMESTAMP '2024-01-15 12:05:00'"""

SERIES = """series AS (SELECT * FROM (VALUES ('productHumidity', 'humidity', 'humidity'),
    ('click', 'productTemp', 'temperature'), ('error', 'waterTemp', 'temperature'),
    ('signup', 'waterFlow', 'water'), ('view', 'fanIntensity', 'fan')) t(meter, series, panel))"""

# --- keyed table --------------------------------------------------------------

CELLS = f"""WITH {EV}, cells AS (
    SELECT factory_id, oven_id, archive_day,
           CASE WHEN event_type = 'purchase' THEN 'productHumidity' ELSE event_type END AS meter,
           date_trunc('minute', ts) AS minute_ts, arg_max(value, event_id) AS value, max(event_id) AS seq
    FROM ev GROUP BY ALL)"""
CELL_KEY = "factory_id || '#' || oven_id || '#' || meter || '#' || strftime(minute_ts, '%Y%m%d#%H')"

# --- streams ------------------------------------------------------------------

PASSED = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"

LATEST_PER_BUCKET = f"""WITH {EV}, buckets AS (SELECT *, date_trunc('hour', ts) AS bucket FROM ev)
    SELECT factory_id, oven_id, bucket AS ts, max(productHumidity) AS "productHumidity",
           (arg_max(event_id, event_id) FILTER (WHERE event_type <> 'purchase')) % 2 = 1 AS is_on,
           {', '.join(f"arg_max(value + {i}, event_id) FILTER (WHERE event_type <> 'purchase') AS " + f'"{m}"'
                      for i, m in enumerate(METERS))}
    FROM buckets GROUP BY factory_id, oven_id, bucket"""

GOOD = """NOT (event_type = 'signup' AND value > 200) AND NOT (event_type = 'view' AND value < 5)
          AND event_type <> 'error'"""

# --- message feeds --------------------------------------------------------------

# Written in three deliveries, within each by event_id. All messages are of one device.
WRITTEN = f"""WITH {EV}, sent AS (
    SELECT *, date_trunc('hour', ts)::TIMESTAMP AS hour_ts, step * 1000000000000 + event_id AS ord,
           event_type = 'purchase' AS is_lab, {GOOD} AS is_good
    FROM (SELECT *, (day(ts) - 1) // 16 + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS step FROM ev))"""
ONE_DEVICE = "'001' AS factory_id, '001' AS oven_id"

DELIVERED = f"""WITH {EV}, rows AS (
    SELECT 'sensor' AS feed, ts, value, event_id FROM ev WHERE {GOOD}
    UNION ALL SELECT 'lab', ts, value, event_id FROM ev WHERE event_type = 'purchase'),
    steps AS (SELECT *, (day(ts) - 1) // 10 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS step FROM rows),
    reached AS (SELECT step, max(max(ts)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
                FROM steps GROUP BY step)"""

ORACLE = {
    "segment_averages": SEGMENTS + f" SELECT {SEGMENT_COLUMNS} FROM segments",
    "segment_averages_cross_midnight": CROSS_MIDNIGHT,
    "segment_shifted_archives": SHIFTED,
    "segment_all_files": SEGMENTS + f" SELECT {SEGMENT_COLUMNS} FROM segments",
    "files_reread": FILES,
    "replaced_days": SEGMENTS + f" SELECT {SEGMENT_COLUMNS} FROM segments WHERE archive_day < DATE '2024-01-15'",
    "many_ovens": MANY_OVENS,
    "lab_markers": f"""WITH {EV}
        SELECT factory_id, oven_id, ts, event_id AS seq, "productHumidity" FROM ev WHERE event_type = 'purchase'""",
    "interval_rows": """
        SELECT event_id, date_trunc('hour', ts) AS ts, value FROM events
        WHERE date_trunc('hour', ts) > TIMESTAMP '2024-01-10 06:00:00'
          AND date_trunc('hour', ts) <= TIMESTAMP '2024-01-12 18:00:00'""",
    "raw_clean_sorted": f"""WITH {EV}
        SELECT datetime, ts, "productHumidity", CAST(event_id % 2 AS VARCHAR) AS "processIsOn", {EXPORT},
               rank() OVER (ORDER BY ts) AS position FROM ev""",
    "export_dead_letters": f"""WITH {EV}
        SELECT CASE WHEN event_type = 'signup' AND value > 200 THEN 'not-a-time' ELSE datetime END AS datetime,
               CASE WHEN event_type = 'signup' AND value > 200 THEN 'bad timestamp'
                    WHEN event_type = 'view' AND value < 5 THEN 'bad number' END AS reason FROM ev""",
    "rank_with_missing_times": """
        SELECT event_id, t AS ts, CASE WHEN t IS NOT NULL THEN rank() OVER (ORDER BY t NULLS LAST) END AS position
        FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS t FROM events)""",
    "chronological_export": f"""WITH {EV}
        SELECT factory_id, oven_id, event_id AS seq, datetime, "productHumidity",
               CAST(event_id % 2 AS VARCHAR) AS "processIsOn", {EXPORT} FROM ev ORDER BY ts, event_id""",
    "split_sensor_lab": f"""WITH {EV}
        SELECT 'sensor' AS topic, factory_id, oven_id, event_id AS seq, datetime, CAST(NULL AS DOUBLE) AS "productHumidity",
               CAST(event_id % 2 AS VARCHAR) AS "processIsOn", {EXPORT} FROM ev
        UNION ALL
        SELECT 'lab', factory_id, oven_id, event_id, datetime, "productHumidity", NULL,
               {', '.join('NULL' for _ in METERS)} FROM ev WHERE event_type = 'purchase'""",
    "parse_payload": f"""WITH {EV}
        SELECT factory_id, oven_id, event_id AS seq, datetime, ts, ts AS ts_local, event_id % 2 = 1 AS "processIsOn",
               {EXPORT} FROM ev WHERE {GOOD}""",
    "parse_lab_payload": f"""WITH {EV}
        SELECT factory_id, oven_id, event_id AS seq, ts, "productHumidity" FROM ev WHERE event_type = 'purchase'""",
    "dead_letter": f"""WITH {EV}
        SELECT factory_id, oven_id, event_id AS seq,
               CASE WHEN event_type = 'signup' THEN 'bad timestamp' WHEN event_type = 'view' THEN 'malformed'
                    ELSE 'empty block' END AS reason, CAST(8 AS BIGINT) AS n_fields
        FROM ev WHERE NOT ({GOOD})""",
    "key_by_timestamp": f"""WITH {EV}
        SELECT factory_id, oven_id, event_id AS seq,
               CASE WHEN event_type = 'signup' AND value > 200 THEN 'not-a-time' ELSE datetime END AS ts_raw,
               event_id % 2 = 1 AS is_on, CAST(7 AS BIGINT) AS n_fields FROM ev""",
    "unpivot_meters": f"""WITH {EV}, wide AS (
        SELECT factory_id, oven_id, datetime, event_id AS seq, CAST(event_id % 2 AS DOUBLE) AS "processIsOn",
               "productHumidity", {EXPORT} FROM ev)
        UNPIVOT wide ON "processIsOn", "productHumidity", {', '.join(f'"{m}"' for m in METERS)}
        INTO NAME meter VALUE value""",
    "merge_sensor_lab": f"""WITH {EV}, s AS (
        SELECT factory_id, oven_id, date_trunc('day', ts)::TIMESTAMP AS ts, {_means()}
        FROM ev WHERE event_type <> 'purchase' GROUP BY ALL), l AS (
        SELECT factory_id, oven_id, date_trunc('day', ts)::TIMESTAMP AS ts, max(value) AS "productHumidity"
        FROM ev WHERE event_type = 'purchase' GROUP BY ALL)
        SELECT factory_id, oven_id, ts, "productHumidity", {', '.join(f'"{m}"' for m in EVENT_METERS)}
        FROM s FULL OUTER JOIN l USING (factory_id, oven_id, ts)""",
    "merge_latest_wins": LATEST_PER_BUCKET,
    "merge_duplicates": f"""WITH {EV}
        SELECT factory_id, oven_id, date_trunc('day', ts)::TIMESTAMP AS ts,
               count(*) FILTER (WHERE event_type <> 'purchase') AS n_sensor,
               count(*) FILTER (WHERE event_type = 'purchase') AS n_lab,
               min("productHumidity") AS lab_min, max("productHumidity") AS lab_max
        FROM ev GROUP BY factory_id, oven_id, date_trunc('day', ts)""",
    "duplicate_events": f"""WITH {EV}, {SENSOR}, counted AS (
        SELECT factory_id, oven_id, date_trunc('hour', ts) AS hour_ts, event_id, event_type, value,
               count(*) OVER (PARTITION BY factory_id, oven_id, date_trunc('hour', ts)) AS n_rows FROM sensor)
        SELECT factory_id, oven_id, hour_ts AS ts, event_id AS seq, event_type AS meter, value, n_rows
        FROM counted WHERE n_rows > 1""",
    "running_avg": RUNNING_ROWS,
    "running_avg_uneven_slide": UNEVEN,
    "running_avg_of_rows": RUNNING_ROWS,
    "running_avg_wide": WIDE + f" SELECT key, factory_id, oven_id, window_end, {WIDE6} FROM wide",
    "averages_payload": RUNNING + f""", rounded AS (SELECT *, {ROUND2.format('avg')} AS r FROM running)
        SELECT factory_id, oven_id, window_end, meter AS topic_key, meter || ',' || CAST(r AS VARCHAR) AS payload,
               r AS parsed FROM rounded""",
    "current_conditions_wide": CELLS + f"""
        SELECT {CELL_KEY} AS key, {', '.join(
            f'max(value) FILTER (WHERE minute(minute_ts) = {m}) AS "{m:02d}"' for m in range(60))}
        FROM cells GROUP BY {CELL_KEY}""",
    "current_conditions_map": CELLS + f"""
        SELECT {CELL_KEY} AS key, count(*) AS n_cells,
               string_agg(strftime(minute_ts, '%M'), ',' ORDER BY minute_ts) AS minutes, round(sum(value), 6) AS total
        FROM cells GROUP BY {CELL_KEY}""",
    "upsert_last_wins": CELLS + " SELECT factory_id, oven_id, archive_day, meter, minute_ts, value FROM cells",
    "settled_days": CELLS + """ SELECT factory_id, oven_id, archive_day, meter, minute_ts, value FROM cells
        WHERE archive_day < DATE '2024-01-15'""",
    "repeated_batch": CELLS + " SELECT factory_id, oven_id, archive_day, meter, minute_ts, value FROM cells",
    "settled_plus_live": CELLS + " SELECT factory_id, oven_id, archive_day, meter, minute_ts, value FROM cells",
    "settled_running": WIDE + f" SELECT key, factory_id, oven_id, window_end, {WIDE6} FROM wide",
    "stored_key_range": WIDE + f""" SELECT key, window_end, {WIDE6} FROM wide
        WHERE key >= '002#007#202401030000' AND key < '002#007#202401200000'""",
    "stored_past_24h": WIDE + f" SELECT key, {WIDE2} FROM wide{IN_24H} ORDER BY key",
    "meter_prefix_scan": f"""WITH {EV}
        SELECT factory_id, oven_id, archive_day, event_type AS meter, date_trunc('minute', ts) AS minute_ts, value,
               event_id AS seq
        FROM ev WHERE event_type = 'click' AND archive_day >= DATE '2024-01-10' AND archive_day < DATE '2024-01-15'""",
    "meter_hour_scan": f"""WITH {EV}
        SELECT factory_id, oven_id, event_type AS meter, date_trunc('minute', ts) AS minute_ts, value
        FROM ev WHERE event_type = 'view' AND date_trunc('hour', ts) = TIMESTAMP '2024-01-01 08:00:00'""",
    "range_scan_past_24h": WIDE + f" SELECT key, {WIDE2} FROM wide{IN_24H} ORDER BY key",
    "range_scan_past_minutes": WIDE + f" SELECT key, {WIDE2} FROM wide{IN_12MIN} ORDER BY key",
    "key_range_scan": WIDE + f""" SELECT key, window_end, {WIDE6} FROM wide
        WHERE key >= '002#007#202401030000' AND key < '002#007#202401200000'""",
    "batch_past_week": SEGMENTS.replace(", 6) AS", ", 12) AS") + f"""
        SELECT key, factory_id, oven_id, archive_day, "startTimestamp", "endTimestamp",
               {ROUND2.format('"productHumidity"')} AS "productHumidity",
               {', '.join(ROUND2.format(f'avg_{m}') + f' AS avg_{m}' for m in EVENT_METERS)}
        FROM segments WHERE archive_day >= DATE '2024-01-08' AND archive_day < DATE '2024-01-15' ORDER BY key""",
    "current_row": f"""WITH {EV}
        SELECT factory_id, oven_id, max(ts) AS ts,
               CASE WHEN max(event_id) % 2 = 1 THEN 'ON' ELSE 'OFF' END AS "processIsOn",
               {', '.join(ROUND2.format(f'arg_max(value + {i}, ts)') + f' AS "{m}"' for i, m in enumerate(METERS))}
        FROM ev WHERE {GOOD} GROUP BY factory_id, oven_id""",
    "current_reading": f"""WITH {EV}, {SENSOR}
        SELECT factory_id, oven_id, event_type AS meter, max(ts) AS ts, arg_max(value, ts) AS value,
               arg_max(event_id, ts) AS seq
        FROM sensor GROUP BY factory_id, oven_id, event_type""",
    "current_averages": RUNNING + f"""
        SELECT factory_id, oven_id, meter, max(window_end) AS window_end,
               {ROUND2.format('arg_max(avg, window_end)')} AS avg
        FROM running GROUP BY factory_id, oven_id, meter""",
    "batch_series": SEGMENTS.replace(", 6) AS", ", 12) AS") + f""", {SERIES}, points AS (
        UNPIVOT (SELECT key, "productHumidity", {', '.join(f'avg_{m} AS "{m}"' for m in EVENT_METERS)} FROM segments
                 WHERE archive_day >= DATE '2024-01-08' AND archive_day < DATE '2024-01-15')
        ON "productHumidity", {', '.join(f'"{m}"' for m in EVENT_METERS)} INTO NAME meter VALUE y)
        SELECT key, series, panel, strptime(split_part(key, '#', 3) || split_part(key, '#', 5), '%Y%m%d%H%M') AS x,
               {ROUND2.format('y')} AS y
        FROM points JOIN series USING (meter) ORDER BY x DESC, key, series""",
    "running_series": WIDE + f""", {SERIES}, points AS (
        UNPIVOT (SELECT key, {WIDE2} FROM wide{IN_24H})
        ON {', '.join(f'"{m}"' for m in EVENT_METERS)} INTO NAME meter VALUE y)
        SELECT key, series, panel, strptime(split_part(key, '#', 3), '%Y%m%d%H%M') AS x, y
        FROM points JOIN series USING (meter) ORDER BY x DESC, key, series""",
    "running_items": WIDE + f""", points AS (
        UNPIVOT (SELECT key, {WIDE2} FROM wide{IN_24H})
        ON {', '.join(f'"{m}"' for m in EVENT_METERS)} INTO NAME meter VALUE y)
        SELECT key, meter AS "column", y AS cell FROM points""",
    "display_time": """
        SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS shown FROM events""",
    "archive_daily_counts": f"""WITH {EV}
        SELECT archive_day, factory_id, oven_id, count(*) AS n_rows,
               strftime(archive_day, '%Y-%m-%dT00_00_00') AS label
        FROM ev GROUP BY archive_day, factory_id, oven_id""",
    "archive_windows": f"""WITH {EV}, cut AS (
        SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS opened FROM ev), marked AS (
        SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
            PARTITION BY factory_id, oven_id, opened ORDER BY ts
            RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker FROM cut)
        SELECT factory_id, oven_id,
               strftime(opened, '%Y-%m-%dT%H_%M_%S') || '--' || strftime(opened + INTERVAL 6 HOUR, '%Y-%m-%dT%H_%M_%S')
                   AS archive_window,
               min(ts) AS start_ts, max(ts) AS end_ts, max(productHumidity) AS "productHumidity",
               count(*) AS n_rows, {_means('avg_{m}')}
        FROM marked WHERE marker IS NOT NULL GROUP BY factory_id, oven_id, opened, marker""",
    "burst_counts": """
        SELECT CASE WHEN event_type = 'purchase' THEN 'lab' ELSE 'sensor' END AS topic,
               date_trunc('hour', ts) AS burst, count(*) AS n_rows
        FROM events GROUP BY ALL""",
    "sql_view": SEGMENTS + HALF_HOURS.replace(f"WITH {EV}", "") + """, running AS (
        SELECT factory_id, oven_id, window_start + INTERVAL 1 HOUR AS window_end FROM spread
        GROUP BY factory_id, oven_id, window_start)
        SELECT s.factory_id, s.oven_id, s.archive_day, count(*) AS n_segments, max(s."productHumidity") AS max_humidity,
               max(w.n_windows) AS n_windows
        FROM segments s
        JOIN (SELECT factory_id, oven_id, CAST(window_end AS DATE) AS archive_day, count(*) AS n_windows
              FROM running GROUP BY ALL) w
          ON w.factory_id = s.factory_id AND w.oven_id = s.oven_id AND w.archive_day = s.archive_day
        GROUP BY s.factory_id, s.oven_id, s.archive_day""",
    "preview": f"""WITH {EV}, counts AS (
        SELECT archive_day, factory_id, oven_id, count(*) AS n_rows FROM ev GROUP BY ALL
        ORDER BY archive_day, factory_id, oven_id LIMIT 20)
        SELECT '{{"archive_day":"' || archive_day || '","factory_id":"' || factory_id || '","oven_id":"' || oven_id
               || '","n_rows":' || n_rows || '}}' AS record FROM counts""",
    "stream_running_avg": RUNNING_ROWS,
    "stream_messages": RUNNING + """
        SELECT meter AS key, count(*) AS n_messages, round(sum(avg), 3) AS total FROM running GROUP BY meter""",
    "stream_closed_windows": WIDE + f""" SELECT factory_id, oven_id, window_start, window_end, {WIDE6} FROM wide
        WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events
                             WHERE event_type <> 'purchase')""",
    "stream_merge": f"""WITH {EV}
        SELECT factory_id, oven_id, date_trunc('day', ts)::TIMESTAMP AS ts, max(productHumidity) AS "productHumidity",
               arg_max(value, event_id) FILTER (WHERE event_type <> 'purchase') AS value,
               (max(event_id) FILTER (WHERE event_type <> 'purchase')) % 2 = 1 AS is_on
        FROM ev GROUP BY factory_id, oven_id, date_trunc('day', ts)""",
    "stream_archive": f"""WITH {EV}
        SELECT factory_id, oven_id, ts, archive_day, "productHumidity",
               {', '.join(f"CASE WHEN event_type = '{m}' THEN value END AS " + f'"{m}"' for m in EVENT_METERS)}
        FROM ev WHERE ts <= {PASSED}""",
    "stream_segments": SEGMENTS + f""" SELECT {SEGMENT_COLUMNS} FROM segments
        WHERE archive_day < (SELECT CAST(max(ts) AS DATE) FROM events WHERE ts <= {PASSED})""",
    "stream_current": f"""WITH {EV}, {SENSOR}
        SELECT factory_id, oven_id, event_type AS meter, max(ts) AS ts, arg_max(value, ts) AS value,
               arg_max(event_id, ts) AS seq
        FROM sensor GROUP BY factory_id, oven_id, event_type""",
    "stream_cells": CELLS + " SELECT factory_id, oven_id, archive_day, meter, minute_ts, value FROM cells",
    "stream_late_update": WIDE + f" SELECT factory_id, oven_id, window_start, window_end, {WIDE6} FROM wide",
    "stored_current_averages": RUNNING + f"""
        SELECT factory_id, oven_id, meter, max(window_end) AS window_end,
               {ROUND2.format('arg_max(avg, window_end)')} AS avg
        FROM running GROUP BY factory_id, oven_id, meter""",
    "loaded_schema": f"""WITH {EV}
        SELECT factory_id, oven_id, event_id AS seq,
               CASE WHEN event_type = 'signup' AND value > 200 THEN 'not-a-time' ELSE datetime END AS datetime,
               CAST(event_id % 2 AS VARCHAR) AS "processIsOn",
               {', '.join(f"CASE WHEN event_type <> 'error' AND NOT (event_type = 'view' AND value < 5) THEN value + {i} END AS " + f'"{m}"'
                          for i, m in enumerate(METERS))},
               event_type = 'view' AND value < 5 AS corrupt, true AS refused FROM ev""",
    "stream_message_cells": WRITTEN + f""", wide AS (
        SELECT hour_ts, ord, CAST(event_id % 2 AS DOUBLE) AS "processIsOn", {EXPORT} FROM sent WHERE is_good),
        cells AS (
        UNPIVOT wide ON "processIsOn", {', '.join(f'"{m}"' for m in METERS)} INTO NAME meter VALUE value
        UNION ALL BY NAME SELECT hour_ts, ord, 'productHumidity' AS meter, value FROM sent WHERE is_lab)
        SELECT {ONE_DEVICE}, CAST(hour_ts AS DATE) AS archive_day, meter, hour_ts AS minute_ts, arg_max(value, ord) AS value
        FROM cells GROUP BY hour_ts, meter""",
    "stream_message_merge": WRITTEN + f"""
        SELECT {ONE_DEVICE}, hour_ts AS ts, max("productHumidity") AS "productHumidity",
               (arg_max(event_id, ord) FILTER (WHERE is_good)) % 2 = 1 AS "processIsOn",
               {', '.join(f'arg_max(value + {i}, ord) FILTER (WHERE is_good) AS "{m}"' for i, m in enumerate(METERS))}
        FROM sent WHERE is_good OR is_lab GROUP BY hour_ts""",
    "stream_current_conditions": WRITTEN + f"""
        SELECT {ONE_DEVICE}, hour_ts AS ts, CASE WHEN event_id % 2 = 1 THEN 'ON' ELSE 'OFF' END AS "processIsOn",
               {', '.join(ROUND2.format(f'value + {i}') + f' AS "{m}"' for i, m in enumerate(METERS))}
        FROM sent WHERE is_good ORDER BY hour_ts DESC, ord DESC LIMIT 1""",
    "stream_arrival_windows": WRITTEN + f""", arrived AS (
        SELECT *, TIMESTAMP '2024-03-01 00:00:00' + step * INTERVAL 1 HOUR AS arrival FROM sent WHERE is_good),
        spread AS (SELECT *, unnest([arrival, arrival - INTERVAL 30 MINUTE]) AS window_start FROM arrived)
        SELECT {ONE_DEVICE}, window_start, window_start + INTERVAL 1 HOUR AS window_end,
               {', '.join(f'round(avg(value + {i}), 6) AS "{m}"' for i, m in enumerate(METERS))}
        FROM spread GROUP BY window_start""",
    "stream_late_rows": DELIVERED + """
        SELECT feed, ts, value, coalesce(ts <= newest - INTERVAL 1 DAY, false) AS late FROM steps JOIN reached USING (step)""",
    "stream_sized_archive": f"""WITH {EV}, passed AS (SELECT * FROM ev WHERE ts <= {PASSED})
        SELECT archive_day, count(*) AS n_rows,
               archive_day < (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) FROM passed) AS closed
        FROM passed GROUP BY archive_day""",
    "replay_from_position": WRITTEN + """
        SELECT 'sensor' AS feed, hour_ts AS ts, value FROM sent WHERE is_good AND step >= 1
        UNION ALL SELECT 'lab', hour_ts, value FROM sent WHERE is_lab AND step >= 1""",
}
