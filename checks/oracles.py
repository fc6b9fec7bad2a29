"""The expected result of every query, as SQL over the given tables (DuckDB dialect)."""

from __future__ import annotations

from citypulse import schemas as S

CELLS = S.grid_ids()


def _cases(expr: str, values: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


CITY = _cases("user_id % 5", ("Hamburg", "Berlin", "Frankfurt", "Munich", "Cologne"))
LINE = _cases("event_id % 6", ("Bus 5", "STR 10", "S1", "U3", "bus 7"))
DIRECTION = "'to ' || " + _cases("event_id % 5", ("Hamburg", "Berlin", "Frankfurt", "Munich", "Cologne"))
GRID = "(VALUES " + ", ".join(f"('{c}', {n})" for n, c in enumerate(CELLS)) + ") AS g(grid_id, n)"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def r9(expr: str) -> str:
    return f"round_even(({expr}) * 1e9, 0) / 1e9"


def ratio(cur: str, free: str) -> str:
    return (
        f"CASE WHEN {free} > 0 THEN round_even(CAST({cur} AS DOUBLE) / nullif({free}, 0) * 100, 0) / 100 "
        "ELSE CAST(1.0 AS DOUBLE) END"
    )


FIXTURE = f"""
WITH scrape AS (
  SELECT event_id, user_id, event_type, value, ts, {CITY} AS meta_city, {ISO} AS meta_scraped_at FROM events
),
probe AS (
  SELECT s.*, grid_id, n, CAST(48.0 + n * 0.25 AS DOUBLE) AS lat, CAST(8.0 + n * 0.5 AS DOUBLE) AS lon,
         event_id + n AS k, (event_id + n) % 23 <> 0 AS answered,
         CAST(FLOOR(value) AS INT) + n AS cur,
         CASE WHEN (event_id + n) % 17 = 0 THEN 0 ELSE CAST(20 + user_id % 100 AS INT) END AS free
  FROM scrape s CROSS JOIN {GRID}
),
traffic AS (
  SELECT event_id, meta_city, meta_scraped_at, ts, grid_id, lat, lon,
         CASE WHEN answered THEN cur END AS current_speed,
         CASE WHEN answered THEN free END AS free_flow_speed,
         CASE WHEN answered THEN {ratio('cur', 'free')} END AS congestion_ratio,
         CASE WHEN answered THEN CAST(k % 10 AS DOUBLE) / 10 END AS confidence
  FROM probe WHERE event_type IN ('view', 'click')
),
weather AS (
  SELECT event_id, meta_city, meta_scraped_at, ts, grid_id, lat, lon,
         CASE WHEN answered THEN value / 10 + n END AS temp,
         CASE WHEN answered THEN CAST(40 + k % 60 AS INT) END AS humidity,
         CASE WHEN answered THEN CAST(k % 30 AS DOUBLE) / 2 END AS wind_speed,
         CASE WHEN answered THEN CASE WHEN k % 4 = 0 THEN value / 100 ELSE CAST(0 AS DOUBLE) END END AS rain_1h_mm,
         CASE WHEN answered THEN CASE WHEN k % 4 = 0 THEN 'Rain' ELSE 'Clear' END END AS weather_main,
         CASE WHEN answered THEN CASE WHEN k % 4 = 0 THEN 'light rain' ELSE 'clear sky' END END AS description
  FROM probe WHERE event_type = 'signup'
),
transit AS (
  SELECT event_id, meta_city, meta_scraped_at, ts, {LINE} AS line,
         CASE WHEN event_id % 13 <> 0 THEN CAST(FLOOR(value * 5) AS INT) END AS delay,
         {DIRECTION} AS direction, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS planned_time
  FROM scrape WHERE event_type IN ('purchase', 'error')
)"""


def bucket(ts: str) -> str:
    return f"time_bucket(INTERVAL '30 minutes', {ts})"


ROAD = "(contains(line, 'Bus') OR contains(line, 'STR'))"


def _mode(cond: str, name: str) -> str:
    return (
        f"avg(CASE WHEN {cond} THEN delay END) AS {name}_avg_delay, "
        f"CAST(sum(CASE WHEN {cond} AND delay > 300 THEN 1 ELSE 0 END) AS DOUBLE) "
        f"/ nullif(count(CASE WHEN {cond} THEN 1 END), 0) AS {name}_stress_index"
    )


def _pivot(m1: str, n1: str, m2: str, n2: str) -> str:
    return ", ".join(
        f"avg(CASE WHEN grid_id = '{c}' THEN {m} END) AS {c}_{n}" for c in CELLS for m, n in ((m1, n1), (m2, n2))
    )


TRAFFIC_PIVOT = _pivot("congestion_ratio", "congestion", "current_speed", "speed")
WEATHER_PIVOT = _pivot("rain_1h_mm", "rain", "temp", "temp")
TRANSIT_STATS = f"{_mode(f'NOT {ROAD}', 'rail')}, {_mode(ROAD, 'bus')}"

GRID_TRAFFIC = [f"{c}_{m}" for c in CELLS for m in ("congestion", "speed")]
GRID_WEATHER = [f"{c}_{m}" for c in CELLS for m in ("rain", "temp")]
TRANSIT = ["rail_avg_delay", "rail_stress_index", "bus_avg_delay", "bus_stress_index"]


def gold_ctes(suffix: str = "", where: str = "TRUE", transit_where: str | None = None) -> str:
    """CTEs ending in ``gold<suffix>``, over the rows the conditions let through."""
    tw = transit_where or where
    key = f"meta_city, {bucket('ts')} AS time_bucket"
    return f""",
t{suffix} AS (SELECT {key}, {TRAFFIC_PIVOT} FROM traffic WHERE {where} GROUP BY 1, 2),
w{suffix} AS (SELECT {key}, {WEATHER_PIVOT} FROM weather WHERE {where} GROUP BY 1, 2),
d{suffix} AS (SELECT {key}, {TRANSIT_STATS} FROM transit WHERE {tw} GROUP BY 1, 2),
spine{suffix} AS (
  SELECT meta_city, time_bucket FROM t{suffix} UNION SELECT meta_city, time_bucket FROM w{suffix}
  UNION SELECT meta_city, time_bucket FROM d{suffix}
),
gold{suffix} AS (
  SELECT s.meta_city, s.time_bucket, t.* EXCLUDE (meta_city, time_bucket), w.* EXCLUDE (meta_city, time_bucket),
         d.* EXCLUDE (meta_city, time_bucket),
         CAST(hour(s.time_bucket) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(s.time_bucket) + 1 AS INTEGER) AS day_of_week
  FROM spine{suffix} s
  LEFT JOIN t{suffix} t ON t.meta_city = s.meta_city AND t.time_bucket = s.time_bucket
  LEFT JOIN w{suffix} w ON w.meta_city = s.meta_city AND w.time_bucket = s.time_bucket
  LEFT JOIN d{suffix} d ON d.meta_city = s.meta_city AND d.time_bucket = s.time_bucket
)"""


GOLD = FIXTURE + gold_ctes()
WIDE_OUT = ", ".join(
    ["meta_city", "time_bucket"]
    + [f"{r9(c)} AS {c}" for c in GRID_TRAFFIC + GRID_WEATHER + TRANSIT]
    + ["hour_of_day", "day_of_week"]
)
# Before the cut only traffic and weather had arrived; the first run holds its newest bucket back.
EARLY = "ts < TIMESTAMP '2024-01-15'"
LATE_CTES = f""",
arrived AS (
  SELECT max(ts) AS edge FROM (
    SELECT ts FROM traffic WHERE {EARLY} UNION ALL SELECT ts FROM weather WHERE {EARLY})
)"""

T_COLS = "meta_city, meta_scraped_at, grid_id, lat, lon, current_speed, free_flow_speed, congestion_ratio, confidence"
W_COLS = (
    "meta_city, meta_scraped_at, grid_id, lat, lon, {temp} AS temp, humidity, wind_speed, {rain} AS rain_1h_mm, "
    "weather_main, description"
).format(temp=r9("temp"), rain=r9("rain_1h_mm"))
D_COLS = "meta_city, meta_scraped_at, line, delay, direction, planned_time"


def _sum_cells(metric: str, cells: list[str], default: str | None = None) -> str:
    cell = (lambda c: f"coalesce({c}_{metric}, {default})") if default else (lambda c: f"{c}_{metric}")
    return "(" + " + ".join(cell(c) for c in cells) + ")"


def _known(metric: str) -> str:
    present = " + ".join(f"CAST({c}_{metric} IS NOT NULL AS INT)" for c in CELLS)
    return f"{_sum_cells(metric, CELLS, '0')} / nullif({present}, 0)"


DIAGONAL = ["grid_0_0", "grid_1_1", "grid_2_2"]
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
SPAN = f"time_bucket BETWEEN TIMESTAMP '2024-01-01' AND {AS_OF}"


def _since(period: str) -> str:
    return f"time_bucket >= {AS_OF} - INTERVAL '{period}'"


CLOSED = f"time_bucket < (SELECT {bucket('max(ts)')} FROM events)"

INDEX = """
  SELECT event_id, meta_city, meta_scraped_at, count(*) AS sample_count,
         CASE WHEN sum(CASE WHEN confidence > 0.5 THEN free_flow_speed END) > 0
              THEN CAST(sum(CASE WHEN confidence > 0.5 THEN current_speed END) AS DOUBLE)
                   / sum(CASE WHEN confidence > 0.5 THEN free_flow_speed END)
              ELSE 1.0 END AS ratio
  FROM traffic GROUP BY 1, 2, 3"""
STATUS = "CASE WHEN {r} < 0.7 THEN 'congested' WHEN {r} < 0.85 THEN 'heavy_traffic' ELSE 'flowing' END"

RAW_LINE = """CASE event_type
  WHEN 'view' THEN props
  WHEN 'click' THEN CASE event_id % 5
    WHEN 0 THEN props || props WHEN 1 THEN props || ' x}' WHEN 2 THEN props || ',}' WHEN 3 THEN props || ','
    ELSE '[' || props || ']' END
  WHEN 'signup' THEN CAST(event_id AS VARCHAR)
  WHEN 'purchase' THEN left(props, length(props) - 1)
  ELSE CASE WHEN user_id % 2 = 0 THEN 'null' ELSE 'not json ' || CAST(event_id AS VARCHAR) END END"""

# The box text of every event, taken apart again; malformed ones give no points.
GRID_POINTS = f"""
WITH part AS (
  SELECT event_id, user_id % 170 AS west, user_id % 80 AS south FROM events
),
box AS (
  SELECT event_id, string_split(CASE
    WHEN event_id % 11 = 0 THEN 'a,b,c,d'
    ELSE concat_ws(',', west || '.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0'), south || '.5', (west + 1) || '.25',
      CASE WHEN event_id % 7 = 0 THEN NULL ELSE (south + 2) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') END)
    END, ',') AS c
  FROM part
),
corner AS (
  SELECT event_id, TRY_CAST(c[1] AS DOUBLE) AS lon0, TRY_CAST(c[2] AS DOUBLE) AS lat0,
         TRY_CAST(c[3] AS DOUBLE) AS lon1, TRY_CAST(c[4] AS DOUBLE) AS lat1 FROM box
)
SELECT event_id, 'grid_' || i || '_' || j AS grid_id,
       {r9('lat0 + j * ((lat1 - lat0) / 3) + (lat1 - lat0) / 3 / 2')} AS lat,
       {r9('lon0 + i * ((lon1 - lon0) / 3) + (lon1 - lon0) / 3 / 2')} AS lon
FROM corner CROSS JOIN range(3) a(i) CROSS JOIN range(3) b(j)
WHERE lon0 IS NOT NULL AND lat0 IS NOT NULL AND lon1 IS NOT NULL AND lat1 IS NOT NULL"""


def oracle_sql() -> dict[str, str]:
    gold_all = f"{GOLD} SELECT {WIDE_OUT} FROM gold"
    closed = f"{gold_all} WHERE {CLOSED}"
    departures = f"{FIXTURE} SELECT {D_COLS} FROM transit"
    traffic_rows = f"{FIXTURE} SELECT {T_COLS} FROM traffic"
    late_floor = f"(SELECT {bucket('edge')} FROM arrived)"
    hourly = f"""{GOLD} SELECT hour_of_day, meta_city, {r9('avg(grid_0_0_congestion)')} AS avg_congestion,
        {r9('avg(rail_stress_index)')} AS avg_rail_stress FROM gold WHERE {_since('30 days')}
        GROUP BY 1, 2 ORDER BY 1, 2"""
    heatmap = f"""{GOLD} SELECT hour_of_day, day_of_week, {r9(f"avg({_known('congestion')})")} AS avg_congestion
        FROM gold GROUP BY 1, 2 ORDER BY 1, 2"""
    bounds = " UNION ALL ".join(
        f"SELECT '{s}' AS source, count(*) AS rows, CAST(0 AS BIGINT) AS rows_without_time, max(ts) AS newest, "
        f"{bucket('max(ts)')} AS newest_bucket FROM {s}"
        for s in ("traffic", "weather", "transit")
    )
    cycle = "time_bucket(INTERVAL '10 minutes', ts) AS cycle"
    cycle_parts = " UNION ALL ".join(
        f"SELECT '{s}' AS source, {cycle}, meta_city, event_id AS doc FROM {s}"
        for s in ("traffic", "weather", "transit")
    )
    per_bucket = "time_bucket AS time, meta_city"
    return {
        "bronze_route": f"""{FIXTURE}
            SELECT 'raw-traffic' AS topic, meta_city, meta_scraped_at, CAST(NULL AS VARCHAR) AS line,
                   CAST(count(*) AS INTEGER) AS sample_count FROM traffic GROUP BY event_id, meta_city, meta_scraped_at
            UNION ALL SELECT 'raw-weather', meta_city, meta_scraped_at, NULL, CAST(count(*) AS INTEGER)
                   FROM weather GROUP BY event_id, meta_city, meta_scraped_at
            UNION ALL SELECT 'raw-db', meta_city, meta_scraped_at, line, NULL FROM transit""",
        "bronze_provenance": """SELECT 'raw-db' AS topic, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
            TRUE AS has_source_file, TRUE AS has_ingested_at FROM events WHERE event_type = 'view'""",
        "bronze_dead_letter": f"""SELECT 'raw-db' AS topic, {RAW_LINE} AS raw, TRUE AS has_source_file,
            FALSE AS has_ingested_at FROM events WHERE event_type <> 'view'""",
        "landing_json_roundtrip": departures,
        "parse_traffic": f"""{FIXTURE} SELECT meta_city, meta_scraped_at, CAST(count(*) AS INTEGER) AS sample_count,
            CAST(sum(coalesce(current_speed, 0)) AS INTEGER) AS speed_sum
            FROM traffic GROUP BY event_id, meta_city, meta_scraped_at""",
        "parse_weather": f"""{FIXTURE} SELECT meta_city, meta_scraped_at, CAST(count(*) AS INTEGER) AS sample_count,
            {r9('max(temp)')} AS max_temp FROM weather GROUP BY event_id, meta_city, meta_scraped_at""",
        "parse_transit": departures,
        "explode_samples": traffic_rows,
        "nest_samples": f"""{FIXTURE}, idx AS ({INDEX})
            SELECT t.event_id, t.meta_city, t.meta_scraped_at, 'tomtom_grid_flow' AS meta_type, '3x3' AS grid_size,
                   round_even(ratio * 100, 0) / 100 AS average_congestion_ratio,
                   {STATUS.format(r='ratio')} AS status_label, 0 AS part, 1 AS part_count,
                   CAST(sample_count AS INTEGER) AS sample_count, grid_id, lat, lon, current_speed, free_flow_speed,
                   congestion_ratio, confidence FROM traffic t JOIN idx USING (event_id)""",
        "nest_weather": f"""{FIXTURE} SELECT event_id, 'owm_grid_weather' AS meta_type, '3x3' AS grid_size,
            3 AS part_count, {W_COLS} FROM weather""",
        "normalise_flat": f"""{traffic_rows} WHERE current_speed IS NOT NULL
            AND NOT (current_speed = 0 AND free_flow_speed = 0 AND confidence = 0)""",
        "payload_traffic": f"""{FIXTURE} SELECT meta_city, meta_scraped_at, grid_id, lat, lon, current_speed,
            free_flow_speed, congestion_ratio, confidence FROM traffic WHERE confidence IS NOT NULL""",
        "payload_weather": f"""{FIXTURE} SELECT meta_city, meta_scraped_at, grid_id, lat, lon,
            {r9('value / 10 + n')} AS temp, CAST(40 + k % 60 AS INTEGER) AS humidity,
            CASE WHEN k % 4 = 0 THEN 'Rain' ELSE 'Clear' END AS weather_main,
            CASE WHEN k % 4 = 0 THEN 'light rain' ELSE 'clear sky' END AS description,
            CAST(k % 30 AS DOUBLE) / 2 AS wind_speed,
            {r9("CASE WHEN k % 4 = 0 THEN value / 100 ELSE CAST(0 AS DOUBLE) END")} AS rain_1h_mm,
            CAST(1000 + k % 9000 AS INTEGER) AS visibility
            FROM probe WHERE event_type = 'signup' AND answered""",
        "payload_transit": f"""{FIXTURE}
            SELECT meta_city, meta_scraped_at, line, direction, planned_time, delay,
                   CAST(event_id % 12 AS VARCHAR) AS platform, 't' || CAST(event_id AS VARCHAR) AS raw_id FROM transit
            WHERE event_id % 29 <> 0
            UNION ALL
            SELECT meta_city, meta_scraped_at, NULL, 'depot', NULL, 0, NULL, 'u' || CAST(event_id AS VARCHAR)
            FROM transit WHERE event_id % 29 <> 0""",
        "congestion_ratio": f"""SELECT event_id,
            {ratio('CAST(FLOOR(value) AS INT)', '(event_id % 120)')} AS congestion_ratio,
            CASE WHEN event_id % 120 = 0 THEN 'flowing' ELSE
              {STATUS.format(r='CAST(CAST(FLOOR(value) AS INT) AS DOUBLE) / nullif(event_id % 120, 0)')} END
              AS status_label FROM events""",
        "grid_points": GRID_POINTS,
        "silver_traffic_stream": traffic_rows,
        "silver_weather_stream": f"{FIXTURE} SELECT {W_COLS} FROM weather",
        "silver_transit_stream": departures,
        "silver_partition_roundtrip": f"""{FIXTURE} SELECT CAST(length(meta_city) AS VARCHAR) AS meta_city,
            meta_scraped_at, line, delay, direction, planned_time FROM transit""",
        "silver_replay_idempotent": departures,
        "silver_compacted": departures,
        "silver_span": f"""SELECT * FROM ({departures}) WHERE CAST(meta_scraped_at AS TIMESTAMP) >= TIMESTAMP '2024-01-10'
            AND CAST(meta_scraped_at AS TIMESTAMP) < TIMESTAMP '2024-01-20'""",
        "silver_quarantine": f"""{FIXTURE} SELECT CASE event_id % 10 WHEN 0 THEN 'no_time' WHEN 1 THEN 'no_time'
            WHEN 2 THEN 'ahead' WHEN 3 THEN 'no_city' WHEN 4 THEN 'malformed' ELSE 'none' END AS reason,
            count(*) AS values FROM transit GROUP BY 1""",
        "silver_retried": f"""{FIXTURE} SELECT CASE event_id % 10 WHEN 0 THEN 'no_time' WHEN 1 THEN 'no_time'
            WHEN 2 THEN 'ahead' WHEN 3 THEN 'no_city' ELSE 'none' END AS reason,
            count(*) AS values FROM transit GROUP BY 1""",
        "bucket_30min": f"""{FIXTURE} SELECT event_id, meta_city, grid_id, ts, {bucket('ts')} AS time_bucket
            FROM traffic""",
        "bucket_bounds": f"{FIXTURE} {bounds}",
        "bucket_bounds_committed": f"{FIXTURE} {bounds}",
        "calendar_features": f"""{FIXTURE} SELECT event_id, {bucket('ts')} AS time_bucket,
            CAST(hour({bucket('ts')}) AS INTEGER) AS hour_of_day,
            CAST(dayofweek({bucket('ts')}) + 1 AS INTEGER) AS day_of_week FROM transit""",
        "transit_mode_split": f"""{FIXTURE} SELECT event_id, line,
            CASE WHEN {ROAD} THEN 'bus' WHEN NOT {ROAD} THEN 'rail' END AS mode FROM transit""",
        "transit_stats": f"{GOLD} SELECT meta_city, time_bucket, "
        + ", ".join(f"{r9(c)} AS {c}" for c in TRANSIT) + " FROM d",
        "traffic_pivot": f"{GOLD} SELECT meta_city, time_bucket, "
        + ", ".join(f"{r9(c)} AS {c}" for c in GRID_TRAFFIC) + " FROM t",
        "weather_pivot": f"{GOLD} SELECT meta_city, time_bucket, "
        + ", ".join(f"{r9(c)} AS {c}" for c in GRID_WEATHER) + " FROM w",
        "master_keys": f"{GOLD} SELECT meta_city, time_bucket FROM spine",
        "gold_wide_join": gold_all,
        "gold_wide": gold_all,
        "gold_closed_buckets": closed,
        "gold_incremental_two_runs": closed,
        "gold_scheduled": closed,
        "gold_compacted": closed,
        "gold_amended": closed,
        "gold_late_data": f"""{FIXTURE}{LATE_CTES}
            {gold_ctes('_early', EARLY, 'FALSE')}{gold_ctes('_all')}
            SELECT {WIDE_OUT} FROM gold_early WHERE time_bucket < {late_floor}
            UNION ALL SELECT {WIDE_OUT} FROM gold_all WHERE {CLOSED}
            AND time_bucket > (SELECT max(time_bucket) FROM gold_early WHERE time_bucket < {late_floor})""",
        "gold_stream": closed,
        "publish_incremental": closed,
        "city_congestion_index": f"""{FIXTURE}, idx AS ({INDEX})
            SELECT event_id, meta_city, meta_scraped_at, round_even(ratio * 100, 0) / 100 AS average_congestion_ratio,
                   {STATUS.format(r='ratio')} AS status_label FROM idx""",
        "cycle_summary": f"""{FIXTURE}, part AS ({cycle_parts})
            SELECT source, cycle, count(DISTINCT meta_city) AS cities_processed,
                   count(DISTINCT doc) AS records_collected, count(*) AS total_samples
            FROM part GROUP BY 1, 2""",
        "q_congestion_by_hour": f"""{GOLD} SELECT CAST(hour_of_day AS VARCHAR) AS hour,
            {r9(f"avg({_sum_cells('congestion', CELLS, '0')}) / 9")} AS avg_congestion
            FROM gold GROUP BY hour_of_day ORDER BY hour_of_day""",
        "q_temp_over_time": f"""{GOLD} SELECT {per_bucket}, {r9(_sum_cells('temp', DIAGONAL) + ' / 3')} AS avg_temp
            FROM gold WHERE {SPAN} ORDER BY 1, 2""",
        "q_speed_over_time": f"""{GOLD} SELECT {per_bucket},
            {r9(_sum_cells('speed', DIAGONAL) + ' / 3')} AS avg_speed_kmh FROM gold WHERE {SPAN} ORDER BY 1, 2""",
        "q_congestion_over_time": f"""{GOLD} SELECT {per_bucket},
            {r9(_sum_cells('congestion', CELLS) + ' / 9')} AS avg_congestion FROM gold WHERE {SPAN} ORDER BY 1, 2""",
        "q_congestion_avg": f"""{GOLD} SELECT {per_bucket}, {r9('avg(grid_0_0_congestion)')} AS avg_congestion
            FROM gold WHERE {_since('7 days')} AND grid_0_0_congestion IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
        "q_rail_stress": f"""{GOLD} SELECT {per_bucket}, {r9('rail_stress_index * 100')} AS stress_percentage
            FROM gold WHERE {_since('24 hours')} AND rail_stress_index IS NOT NULL ORDER BY 1, 2""",
        "q_weather_vs_traffic": f"""{GOLD} SELECT {per_bucket}, {r9('avg(grid_0_0_rain)')} AS rainfall_mm,
            {r9('avg(grid_0_0_congestion)')} AS congestion_ratio FROM gold WHERE {_since('7 days')}
            AND grid_0_0_rain IS NOT NULL AND grid_0_0_congestion IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
        "q_rain_correlation": f"""{GOLD} SELECT meta_city, count(*) AS buckets,
            {r9('covar_pop(grid_0_0_rain, grid_0_0_congestion) / nullif(stddev_pop(grid_0_0_rain) * stddev_pop(grid_0_0_congestion), 0)')} AS correlation FROM gold WHERE {_since('30 days')}
            AND grid_0_0_rain IS NOT NULL AND grid_0_0_congestion IS NOT NULL GROUP BY 1 ORDER BY 1""",
        "q_bus_vs_rail": f"""{GOLD} SELECT {per_bucket}, {r9('bus_avg_delay / 60.0')} AS bus_delay_minutes,
            {r9('rail_avg_delay / 60.0')} AS rail_delay_minutes FROM gold WHERE {_since('24 hours')}
            AND bus_avg_delay IS NOT NULL AND rail_avg_delay IS NOT NULL ORDER BY 1, 2""",
        "q_hourly_patterns": hourly,
        "q_first_rows": f"{gold_all} ORDER BY time_bucket, meta_city LIMIT 5",
        "q_row_count": f"{GOLD} SELECT count(*) AS rows FROM gold",
        "q_city_rows": f"""{GOLD} SELECT meta_city, time_bucket, {r9('grid_0_0_speed')} AS grid_0_0_speed,
            {r9('rail_stress_index')} AS rail_stress_index FROM gold WHERE meta_city = 'Hamburg' ORDER BY 2""",
        "q_heatmap": heatmap,
        "rollup_hourly_patterns": hourly,
        "rollup_heatmap": heatmap,
        "q_city_comparison": f"{GOLD} SELECT meta_city, count(*) AS buckets, "
        + ", ".join(f"{r9(f'avg({_known(m)})')} AS avg_{m}" for m in ("congestion", "speed", "rain", "temp"))
        + ", " + ", ".join(f"{r9(f'avg({c})')} AS mean_{c}" for c in TRANSIT)
        + " FROM gold GROUP BY 1 ORDER BY 1",
        "q_peak_hours": f"""{GOLD} SELECT hour_of_day, {r9('x')} AS avg_congestion FROM (
            SELECT hour_of_day, avg({_known('congestion')}) AS x FROM gold GROUP BY 1)
            ORDER BY x, hour_of_day LIMIT 3""",
        "q_delay_trend": f"""{GOLD} SELECT CAST(time_bucket AS DATE) AS day,
            {r9('avg(bus_avg_delay) / 60.0')} AS bus_delay_minutes,
            {r9('avg(rail_avg_delay) / 60.0')} AS rail_delay_minutes FROM gold GROUP BY 1 ORDER BY 1""",
    }
