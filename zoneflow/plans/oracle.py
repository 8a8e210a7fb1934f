"""DuckDB SQL for every registered query, over the same tables."""

from __future__ import annotations

from zoneflow.defaults import TIME_PATTERNS, ZONES, ZonesConfig
from zoneflow.operators.time_patterns import AVAILABLE_SHARE
from zoneflow.params import PricingParams
from zoneflow.plans.tables import DAILY, HOURLY, MOVED, TUMBLING

FEED = f"""
feed AS (
  SELECT event_id, ts AS event_time, user_id, props,
    CASE WHEN event_type IN ('click', 'view') THEN 'ride_requests' ELSE 'driver_updates' END AS topic,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'available'
         WHEN event_type = 'error' THEN 'busy' END AS status,
    printf('Customer#%09d', user_id) AS h3_zone,
    CASE WHEN props NOT LIKE '%0}}' THEN {ZONES.area.center_lat}::DOUBLE + ("value" - 50) / 1000 END AS lat,
    CASE WHEN props NOT LIKE '%0}}'
      THEN {ZONES.area.center_lon}::DOUBLE + (event_id % 1000 - 500)::DOUBLE / 10000 END AS lon
  FROM events)"""

CELLS = f"""
cells AS (
  SELECT c_name AS h3_zone,
    {ZONES.area.center_lat}::DOUBLE + ((c_custkey * 7919) % 2001 - 1000)::DOUBLE / 10000 AS center_lat,
    {ZONES.area.center_lon}::DOUBLE + ((c_custkey * 104729) % 2003 - 1001)::DOUBLE / 10000 AS center_lon
  FROM customer)"""

HOUR = "date_trunc('hour', event_time)::TIMESTAMP AS event_time"
PRICE_COLUMNS = "h3_zone, window_start, window_end, demand_count, available_driver_count, pressure, price_multiplier"


def pressure(d: str, s: str) -> str:
    return f"CASE WHEN {d} <= 0 AND {s} <= 0 THEN 0.0::DOUBLE WHEN {s} > 0 THEN {d}::DOUBLE / {s}::DOUBLE - 1 END"


def multiplier(d: str, s: str, p: PricingParams = DAILY) -> str:
    return (f"CASE WHEN {d} <= 0 AND {s} <= 0 THEN 1.0::DOUBLE WHEN {s} <= 0 THEN {p.max_multiplier}::DOUBLE "
            f"ELSE least({p.max_multiplier}::DOUBLE, greatest({p.min_multiplier}::DOUBLE, "
            f"1 + {p.pressure_weight}::DOUBLE * tanh({d}::DOUBLE / {s}::DOUBLE - 1))) END")


def priced(source: str) -> str:
    d, s = "demand_count", "available_driver_count"
    return (f"SELECT h3_zone, window_start, window_end, {d}, {s}, {pressure(d, s)} AS pressure, "
            f"{multiplier(d, s)} AS price_multiplier FROM {source}")


def windows(p: PricingParams) -> str:
    slide, count = f"INTERVAL {p.slide_seconds} SECOND", p.window_seconds // p.slide_seconds
    return f"""{FEED},
spread AS (
  SELECT h3_zone, event_time, topic, status,
    time_bucket({slide}, event_time, TIMESTAMP '1970-01-01') - k * {slide} AS window_start
  FROM feed, generate_series(0, {count - 1}) AS g(k)),
counts AS (
  SELECT h3_zone, window_start, window_start + INTERVAL {p.window_seconds} SECOND AS window_end,
    count(*) FILTER (topic = 'ride_requests')::INTEGER AS demand_count,
    count(*) FILTER (topic = 'driver_updates' AND status = 'available')::INTEGER AS available_driver_count
  FROM spread GROUP BY h3_zone, window_start),
prices AS ({priced('counts')})"""


def latest(source: str, where: str = "") -> str:
    return f"""
latest AS (
  SELECT {PRICE_COLUMNS} FROM {source} {where}
  QUALIFY row_number() OVER (PARTITION BY h3_zone ORDER BY window_end DESC) = 1)"""


# props 1 and 5 lose the message, 2 its zone; 3 its time, 4 and 6 change the zone
DECODED = f"""{FEED}
SELECT topic, event_id::VARCHAR AS event_id, lat, lon,
  CASE props WHEN '{{"k": 4}}' THEN '' WHEN '{{"k": 6}}' THEN event_id::VARCHAR ELSE h3_zone END AS h3_zone,
  status,
  CASE WHEN props = '{{"k": 3}}' THEN TIMESTAMP '2024-02-01' ELSE event_time END AS event_time
FROM feed WHERE props NOT IN ('{{"k": 1}}', '{{"k": 2}}', '{{"k": 5}}')"""

RECENT = f"""{FEED},
recent AS (SELECT * FROM feed WHERE event_time >= (SELECT max(event_time) FROM feed) - INTERVAL 259200 SECOND)"""


def points(topic: str) -> str:
    color = "[20, 70, 255, 245]::INTEGER[]" if topic == "ride_requests" else (
        "CASE WHEN status = 'available' THEN [35, 170, 85, 180]::INTEGER[] ELSE [120, 120, 120, 150]::INTEGER[] END")
    return f"""WITH {RECENT}
SELECT lat, lon, h3_zone, coalesce(status, 'request') AS status,
  {color} AS color
FROM recent WHERE topic = '{topic}' AND lat IS NOT NULL AND lon IS NOT NULL"""


def _slots() -> str:
    """Config rows in list order; a (day type, hour) belongs to the first pattern that covers it."""
    owned: dict[tuple[str, int], dict[str, tuple[float, float]]] = {}
    for _, day, hours, factors in TIME_PATTERNS:
        for hour in hours:
            owned.setdefault((day, hour), factors)
    rows = [f"('{day}', {hour}, '{kind}', {demand}::DOUBLE, {supply}::DOUBLE)"
            for (day, hour), factors in owned.items() for kind, (demand, supply) in factors.items()]
    return f"slots(s_day, s_hour, s_type, s_demand, s_supply) AS (VALUES {', '.join(rows)})"


def enriched(source: str) -> str:
    return f"""
keyed AS (
  SELECT *, CASE WHEN isodow(event_time) < 6 THEN 'weekday' ELSE 'weekend' END AS day_type,
    hour(event_time)::INTEGER AS hour FROM {source}),
{_slots()},
enriched AS (
  SELECT keyed.*, coalesce(s_demand, 1.0::DOUBLE) AS demand_factor, coalesce(s_supply, 1.0::DOUBLE) AS supply_factor
  FROM keyed LEFT JOIN slots ON s_day = day_type AND s_hour = hour AND s_type = type)"""


def typed(source: str, config: ZonesConfig, name: str = "typed") -> str:
    bounds, reached = [], 0.0
    for zone_type in config.zone_types[:-1]:
        reached += zone_type.probability
        bounds.append(reached)
    pick = " + ".join(f"(u >= {bound}::DOUBLE)::INTEGER" for bound in bounds)
    profiles = ", ".join(
        f"({i}, '{t.zone_type_id}', '{t.type}', {t.base_demand}, {t.base_supply}, {t.price_sensitivity}::DOUBLE, "
        f"{t.avg_distance}, {t.probability}::DOUBLE)" for i, t in enumerate(config.zone_types))
    return f"""
{name}_drawn AS (
  SELECT *, ('0x' || substr(md5('{config.random_seed}|' || h3_zone), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM {source}),
{name}_profiles(pick, zone_type_id, type, base_demand, base_supply, price_sensitivity, avg_distance,
  selection_probability) AS (VALUES {profiles}),
{name} AS (
  SELECT d.* EXCLUDE (u), p.* EXCLUDE (pick) FROM {name}_drawn d JOIN {name}_profiles p ON p.pick = {pick})"""


def inside(config: ZonesConfig, name: str = "inside") -> str:
    a = config.area
    half = lambda column, center: f"radians({column} - {center}::DOUBLE) / 2"
    lat, lon = half("center_lat", a.center_lat), half("center_lon", a.center_lon)
    return f"""
{name}_chords AS (
  SELECT *, sin({lat}) * sin({lat})
    + cos(radians({a.center_lat}::DOUBLE)) * cos(radians(center_lat)) * (sin({lon}) * sin({lon})) AS chord
  FROM cells),
{name}_distances AS (
  SELECT *, 2 * 6371.0088::DOUBLE * atan2(sqrt(chord), sqrt(1 - chord)) AS km FROM {name}_chords),
{name} AS (
  SELECT h3_zone, round(center_lat, 7) AS center_lat, round(center_lon, 7) AS center_lon,
    round(km, 4) AS distance_from_center_km
  FROM {name}_distances WHERE km <= {a.radius_km})"""


ZONE_COLUMNS = """zone_id, h3_zone, center_lat, center_lon, distance_from_center_km, zone_type_id, type,
  base_demand, base_supply, price_sensitivity, avg_distance, selection_probability, created_at, updated_at,
  h3_resolution"""


def dimension(config: ZonesConfig, stamp: str, name: str) -> str:
    return f"""{inside(config, name + '_inside')},
{typed(name + '_inside', config, name + '_typed')},
{name} AS (
  SELECT {ZONE_COLUMNS} FROM (
    SELECT *, printf('zone_%04d', row_number() OVER (ORDER BY h3_zone)) AS zone_id,
      TIMESTAMP '{stamp}' AS created_at, TIMESTAMP '{stamp}' AS updated_at, {config.h3_resolution} AS h3_resolution
    FROM {name}_typed))"""


TWICE = f"{CELLS}, {dimension(ZONES, '2024-01-01', 'first')}, {dimension(MOVED, '2024-02-01', 'second')}"
TYPED_COLUMNS = """h3_zone, center_lat, center_lon, distance_from_center_km, zone_type_id, type, base_demand,
  base_supply, price_sensitivity, avg_distance, selection_probability, h3_resolution"""

RATES = f"""{FEED}, {CELLS},
{typed("(SELECT h3_zone FROM cells)", ZONES)},
active AS (SELECT DISTINCT h3_zone, {HOUR} FROM feed),
ticks AS (SELECT * FROM active JOIN typed USING (h3_zone)),
{enriched('ticks')},
rates AS (
  SELECT *, base_demand * demand_factor AS expected_requests,
    greatest(1, trunc(base_supply * supply_factor)::INTEGER) AS expected_driver_updates,
    greatest(1, trunc(base_supply * supply_factor)::INTEGER) * {AVAILABLE_SHARE}::DOUBLE AS expected_available,
    1 / (1 + price_sensitivity) AS generosity_center
  FROM enriched)"""

SEGMENT_TYPES = """
segment_types AS (
  SELECT c_name AS h3_zone, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'downtown' WHEN 'BUILDING' THEN 'residential'
    WHEN 'FURNITURE' THEN 'airport' WHEN 'HOUSEHOLD' THEN 'suburb' WHEN 'MACHINERY' THEN 'industrial' END AS type
  FROM customer)"""

MAXIMA = """
SELECT coalesce(max(demand_count), 0) AS max_demand, coalesce(max(available_driver_count), 0) AS max_supply,
  coalesce(max(abs(pressure)), 0.0::DOUBLE) AS max_pressure FROM latest"""


def zone_board(color: str) -> str:
    """``color`` computes the four channels from ``m``, or from a value ``v`` and its maximum ``vmax``."""
    if color == "multiplier":
        share = "least(1.0::DOUBLE, greatest(0.0::DOUBLE, (price_multiplier - 0.9::DOUBLE) / 0.6::DOUBLE))"
        fill = "[trunc(70 + n * 185)::INTEGER, trunc(180 - n * 130)::INTEGER, 80, 150]::INTEGER[]"
    else:
        value, largest = {"demand": ("demand_count", "max_demand"), "supply": ("available_driver_count", "max_supply"),
                          "pressure": ("abs(pressure)", "max_pressure")}[color]
        share = (f"CASE WHEN {largest} <= 0 THEN 0.0::DOUBLE "
                 f"ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, {value}::DOUBLE / {largest})) END")
        fill = "[50, trunc(120 + n * 90)::INTEGER, trunc(150 + n * 90)::INTEGER, 145]::INTEGER[]"
    return f"""{windows(DAILY)}, {latest('prices')}, {CELLS}, {inside(ZONES)},
maxima AS ({MAXIMA}),
neutral AS (
  SELECT h3_zone, center_lat, center_lon, coalesce(price_multiplier, 1.0::DOUBLE) AS price_multiplier,
    coalesce(demand_count, 0) AS demand_count, coalesce(available_driver_count, 0) AS available_driver_count,
    coalesce(pressure, 0.0::DOUBLE) AS pressure
  FROM inside LEFT JOIN latest USING (h3_zone)),
shares AS (SELECT neutral.*, {share} AS n FROM neutral, maxima),
board AS (
  SELECT * EXCLUDE (n), [center_lon, center_lat] AS label_position, {fill} AS fill_color,
    [35, 35, 35, 190]::INTEGER[] AS line_color,
    printf('%.2f', price_multiplier) || 'x' || chr(10) || 'D ' || demand_count || ' / S ' || available_driver_count
      AS label
  FROM shares)"""


# Customers' configs are wrong by construction: each rule is stated on the customer itself.
VIOLATIONS = """
docs AS (SELECT c_name AS config, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance FROM customer)
SELECT config, 0::INTEGER AS pattern_index, 'unknown_day_type' AS rule, 'furniture' AS detail
FROM docs WHERE segment = 'FURNITURE'
UNION ALL SELECT config, 0, 'missing_field', 'day_type' FROM docs WHERE segment = 'HOUSEHOLD'
UNION ALL SELECT config, 0, 'hours_not_list', NULL FROM docs WHERE segment = 'MACHINERY'
UNION ALL SELECT config, 0, 'multipliers_not_object', NULL FROM docs WHERE segment = 'MACHINERY'
UNION ALL SELECT config, 0, 'invalid_hour', (nation + k)::VARCHAR
FROM docs, (VALUES (0), (3)) AS later(k) WHERE segment <> 'MACHINERY' AND nation + k > 23
UNION ALL SELECT config, 0, 'factor_not_positive', 'downtown.demand_factor'
FROM docs WHERE segment <> 'MACHINERY' AND balance <= 0"""

UPSERTED = f"""WITH {TWICE}
SELECT * FROM first WHERE h3_zone NOT IN (SELECT h3_zone FROM second) UNION ALL SELECT * FROM second"""

UPSERTED_KEEPING_CREATED = f"""WITH {TWICE}
SELECT * FROM first WHERE h3_zone NOT IN (SELECT h3_zone FROM second)
UNION ALL SELECT second.* REPLACE (coalesce(first.created_at, second.created_at) AS created_at)
FROM second LEFT JOIN first USING (h3_zone)"""

ORACLE: dict[str, str] = {
    "zone_window_pricing": f"WITH {windows(DAILY)} SELECT * FROM prices",
    "zone_window_pricing_spread": f"WITH {windows(DAILY)} SELECT * FROM prices",
    "zone_hourly_pricing": f"WITH {windows(HOURLY)} SELECT * FROM prices",
    "zone_tumbling_pricing": f"WITH {windows(TUMBLING)} SELECT * FROM prices",
    "latest_zone_pricing": f"WITH {windows(DAILY)}, {latest('prices')} SELECT * FROM latest",
    "latest_closed_zone_pricing":
        f"WITH {windows(DAILY)}, {latest('prices', 'WHERE window_end <= (SELECT max(ts) FROM events)')} "
        "SELECT * FROM latest",
    "pricing_update_log_compacted": f"WITH {windows(DAILY)} SELECT * FROM prices",
    "latest_of_update_log": f"WITH {windows(DAILY)}, {latest('prices')} SELECT * FROM latest",
    "pricing_message_round_trip":
        f"WITH {windows(DAILY)} SELECT *, TIMESTAMP '2024-02-01' AS calculated_at FROM prices",
    "events_decoded": f"WITH {DECODED}",
    "events_replayed": f"""WITH {DECODED} AND props <> '{{"k": 3}}'""",
    "event_indicators": f"""WITH {FEED}
SELECT event_id, event_time, topic, status, h3_zone, (topic = 'ride_requests')::INTEGER AS demand_increment,
  (coalesce(status, '') = 'available')::INTEGER AS available_driver_increment FROM feed""",
    "union_topic_events": f"WITH {FEED} SELECT event_id, event_time, h3_zone, lat, lon, topic, status FROM feed",
    "recent_events": f"WITH {RECENT} SELECT event_id, event_time, topic, status, h3_zone, lat, lon FROM recent",
    "recent_received_events": f"""WITH {FEED},
received AS (
  SELECT * REPLACE (CASE WHEN props NOT IN ('{{"k": 3}}', '{{"k": 7}}') THEN event_time END AS event_time),
    event_time + INTERVAL 1 HOUR AS received_at FROM feed)
SELECT * EXCLUDE (props, user_id) FROM received
WHERE coalesce(event_time, received_at) >= (SELECT max(event_time) FROM feed) - INTERVAL 259200 SECOND""",
    "request_points": points("ride_requests"),
    "driver_points": points("driver_updates"),
    "event_counts": f"""WITH {RECENT}
SELECT count(*) FILTER (topic = 'ride_requests') AS request_count,
  count(*) FILTER (topic = 'driver_updates') AS driver_count FROM recent""",
    "tick_totals": f"""WITH {FEED}, ticks AS (SELECT {HOUR}, topic FROM feed)
SELECT event_time, count(*) FILTER (topic = 'ride_requests') AS request_count,
  count(*) FILTER (topic = 'driver_updates') AS driver_count FROM ticks GROUP BY event_time""",
    "tail_events": f"""WITH {FEED},
log AS (SELECT topic, (user_id % 4)::INTEGER AS "partition", event_id AS "offset", h3_zone, status FROM feed),
ends AS (SELECT topic, "partition", max("offset") - 5000 AS before FROM log GROUP BY ALL)
SELECT log.* FROM log JOIN ends USING (topic, "partition") WHERE "offset" > before""",
    "stream_tail_after_restart": f"""WITH {FEED},
log AS (SELECT topic, (user_id % 4)::INTEGER AS "partition", event_id AS "offset", h3_zone AS "key", status AS "value" FROM feed),
half AS (SELECT max("offset") // 2 AS middle FROM log),
ends AS (SELECT topic, "partition", max("offset") + 1 - 500 AS begin FROM log, half WHERE "offset" <= middle GROUP BY ALL)
SELECT log.* FROM log CROSS JOIN half LEFT JOIN ends USING (topic, "partition")
WHERE "offset" > middle OR "offset" >= begin""",
    "events_with_time_factors": f"""WITH {FEED}, {SEGMENT_TYPES},
timed AS (SELECT event_id, event_time, h3_zone, type FROM feed LEFT JOIN segment_types USING (h3_zone)),
{enriched('timed')} SELECT * FROM enriched""",
    "events_with_loaded_factors": f"""WITH {FEED}, {SEGMENT_TYPES},
timed AS (SELECT event_id, event_time, h3_zone, type FROM feed LEFT JOIN segment_types USING (h3_zone)),
{enriched('timed')} SELECT * FROM enriched""",
    "expected_zone_rates": f"WITH {RATES} SELECT * FROM rates",
    "expected_zone_multiplier": f"""WITH {RATES}
SELECT h3_zone, event_time, expected_requests, expected_available,
  {pressure('expected_requests', 'expected_available')} AS pressure,
  {multiplier('expected_requests', 'expected_available')} AS price_multiplier FROM rates""",
    "pattern_violations": f"WITH {VIOLATIONS}",
    "zones_within_radius": f"WITH {CELLS}, {inside(ZONES)} SELECT * FROM inside ORDER BY h3_zone",
    "indexed_zones_within_radius": f"""WITH {CELLS}, {inside(ZONES)},
grid AS (SELECT h3_zone, floor((center_lon + 180) / 360 * 1048576)::BIGINT AS x, floor((center_lat + 90) / 180 * 1048576)::BIGINT AS y
  FROM cells)
SELECT inside.*, list_sum([((x >> i) & 1) * (1::BIGINT << (2 * i)) + ((y >> i) & 1) * (2::BIGINT << (2 * i)) FOR i IN range(20)])::BIGINT
  AS curve FROM inside JOIN grid USING (h3_zone)""",
    "configured_zones": f"""WITH {CELLS}, {inside(ZONES)}, zones_only AS (SELECT h3_zone FROM inside),
{typed('zones_only', ZONES, 'kinds')} SELECT * FROM kinds""",
    "zone_config_sums": """WITH totals AS (
  SELECT c_name AS config, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 3 END AS types,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 0.1::DOUBLE + 0.2::DOUBLE + c_nationkey / 10 END::DOUBLE AS total FROM customer)
SELECT *, abs(total - 1) <= 1e-9 AS valid FROM totals""",
    "zone_dimension": f"WITH {CELLS}, {dimension(ZONES, '2024-01-01', 'zones')} SELECT * FROM zones",
    "zones_read": f"""WITH {CELLS}, {dimension(MOVED, '2024-02-01', 'zones')}
SELECT zone_id, h3_zone, type, base_demand, base_supply, avg_distance, price_sensitivity, center_lat, center_lon
FROM zones ORDER BY h3_zone""",
    "map_zones_read": f"""WITH {CELLS}, {dimension(MOVED, '2024-02-01', 'zones')}
SELECT zone_id, h3_zone, type, center_lat, center_lon FROM zones ORDER BY h3_zone""",
    "zone_upsert": UPSERTED,
    "zone_upsert_keeping_created": UPSERTED_KEEPING_CREATED,
    "zone_table_upsert": UPSERTED,
    "zone_table_upsert_keeping_created": UPSERTED_KEEPING_CREATED,
    "zone_table_upsert_stats": f"""WITH {TWICE},
known AS (SELECT count(*) AS n FROM first JOIN second USING (h3_zone))
SELECT known.n AS matched, known.n AS modified, (SELECT count(*) FROM second) - known.n AS upserted,
  (SELECT count(*) FROM first) + (SELECT count(*) FROM second) - known.n AS total FROM known""",
    "zone_upsert_stats": f"""WITH {TWICE},
old AS (SELECT {TYPED_COLUMNS} FROM first), new AS (SELECT {TYPED_COLUMNS} FROM second),
same AS (SELECT count(*) AS n FROM (SELECT * FROM old INTERSECT SELECT * FROM new)),
known AS (SELECT count(*) AS n FROM old JOIN new USING (h3_zone))
SELECT known.n AS matched, known.n - same.n AS modified, (SELECT count(*) FROM new) - known.n AS upserted,
  (SELECT count(*) FROM old) + (SELECT count(*) FROM new) - known.n AS total FROM known, same""",
    "duplicate_zone_keys":
        f'WITH {FEED} SELECT h3_zone, count(*) AS "rows" FROM feed GROUP BY h3_zone HAVING count(*) > 1',
    "zone_field_gaps": """SELECT count(*) AS zones, 0::BIGINT AS h3_zone,
  count(*) FILTER (c_mktsegment = 'MACHINERY') AS type, 0::BIGINT AS center_lat, count(*) AS avg_distance
FROM customer""",
    "zone_board": f"WITH {zone_board('multiplier')} SELECT * FROM board",
    "zone_board_by_demand": f"WITH {zone_board('demand')} SELECT * FROM board",
    "zone_board_by_supply": f"WITH {zone_board('supply')} SELECT * FROM board",
    "zone_board_by_pressure": f"WITH {zone_board('pressure')} SELECT * FROM board",
    "board_maxima": f"WITH {windows(DAILY)}, {latest('prices')} {MAXIMA}",
    "board_kpis": f"""WITH {zone_board('multiplier')}
SELECT count(*) AS tracked_zones, coalesce(sum(demand_count), 0)::BIGINT AS total_demand,
  coalesce(sum(available_driver_count), 0)::BIGINT AS total_supply,
  round(coalesce(avg(price_multiplier), 1.0), 9) AS average_multiplier,
  round(avg(center_lat), 9) AS center_lat, round(avg(center_lon), 9) AS center_lon FROM board""",
    "stream_zone_pricing": f"WITH {windows(DAILY)} SELECT * FROM prices",
    "stream_closed_windows":
        f"WITH {windows(DAILY)} SELECT * FROM prices "
        f"WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {DAILY.window_seconds} SECOND",
    "stream_open_windows":
        f"WITH {windows(DAILY)} SELECT * FROM prices "
        f"WHERE window_end > (SELECT max(ts) FROM events) - INTERVAL {DAILY.window_seconds} SECOND",
    "stream_closed_window_rows":
        f"WITH {windows(DAILY)} SELECT count(*) AS rows_written FROM prices "
        f"WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {DAILY.window_seconds} SECOND",
    # blocks of six windows: a block ends with its last window
    "stream_closed_windows_by_panes":
        f"WITH {windows(HOURLY)} SELECT * FROM prices "
        f"WHERE time_bucket(INTERVAL {6 * HOURLY.slide_seconds} SECOND, window_start, TIMESTAMP '1970-01-01') "
        f"+ INTERVAL {HOURLY.window_seconds + 5 * HOURLY.slide_seconds} SECOND "
        f"<= (SELECT max(ts) FROM events) - INTERVAL {HOURLY.window_seconds} SECOND",
    "stream_records_read": f"""WITH {FEED}
SELECT topic, count(*) + count(*) FILTER (event_time < (SELECT min(ts) + INTERVAL 1 DAY FROM events)) AS records_read
FROM feed GROUP BY topic""",
    "stream_latest_pricing": f"WITH {windows(DAILY)}, {latest('prices')} SELECT * FROM latest",
}
