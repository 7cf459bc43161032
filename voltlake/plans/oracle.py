"""The same results in SQL over the given tables, for checking the registered queries."""

from __future__ import annotations

import math

from voltlake.constants import (
    BUFFER_METRES,
    CITY_POI_NAMES,
    DEFAULT_BUFFER_METRES,
    POI_TAGS,
)
from voltlake.plans.bindings import CITIES

STATUS = (
    "CASE event_type WHEN 'view' THEN 'AVAILABLE' WHEN 'click' THEN 'RESERVED' "
    "WHEN 'purchase' THEN 'CHARGING' WHEN 'error' THEN 'OUTOFORDER' "
    "WHEN 'signup' THEN 'UNKNOWN' END"
)
N_SUPPLIERS = "(SELECT count(*) FROM supplier)"
POLLED = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(600 * (event_id // 1000))"


def lon(key: str) -> str:
    return f"(6.0::DOUBLE + ({key} * 104729 % 1000003) * 9e-6::DOUBLE)"


def lat(key: str) -> str:
    return f"(47.3::DOUBLE + ({key} * 7919 % 1000003) * 7.5e-6::DOUBLE)"


def key_hash(entity: str, time: str) -> str:
    return f"md5({entity} || strftime({time}, '%Y-%m-%d %H:%M:%S.%f'))"


def status_num(status: str) -> str:
    return (
        f"CASE {status} WHEN 'AVAILABLE' THEN 0.0::DOUBLE WHEN 'RESERVED' THEN 0.5::DOUBLE "
        "WHEN 'CHARGING' THEN 1.0::DOUBLE WHEN 'OUTOFORDER' THEN -1.0::DOUBLE END"
    )


EVENTS = f"""ev AS (
  SELECT event_id, ts, user_id, event_type, {STATUS} AS status,
    json_extract_string(props, '$.k') AS k, event_id // 1000 AS no,
    strftime({POLLED}, '%Y%m%d_%H%M%S') || '_cp_data_cities' AS snapshot,
    CAST(s_suppkey AS INTEGER) AS id_cs, s_name, n_name AS city
  FROM events
  JOIN supplier ON s_suppkey = user_id % {N_SUPPLIERS}
  JOIN nation ON n_nationkey = s_nationkey
), evt AS (
  SELECT ev.*, city_ts,
    CASE event_type WHEN 'signup' THEN '-' WHEN 'error' THEN NULL ELSE k END AS sensor,
    CASE WHEN event_id % 2 = 0 THEN 'curb; north' END AS place,
    CASE WHEN user_id % 2 = 0 THEN 'left' ELSE 'right' END AS side,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE CAST(user_id % 3 AS VARCHAR) END AS floor
  FROM ev JOIN (SELECT no, city, min(ts) AS city_ts FROM ev GROUP BY no, city) USING (no, city)
)"""

CONNECTORS_SEEN = """lastp AS (
  SELECT * FROM evt
  QUALIFY row_number() OVER (PARTITION BY no, user_id ORDER BY event_id DESC) = 1
), conn AS (
  SELECT 'CP' || user_id AS id_cp, 'C' || user_id || '-0' AS id, status, 'SOCKET' AS format,
    user_id, event_id, city_ts, snapshot FROM lastp WHERE event_id % 5 <> 0
  UNION ALL
  SELECT 'CP' || user_id, 'C' || user_id || '-1', 'AVAILABLE', 'CABLE', user_id, event_id, city_ts, snapshot
  FROM lastp WHERE event_id % 5 <> 0 AND user_id % 2 = 0
)"""

POSTAL = "CAST(10000 + s_suppkey * 37 % 90000 AS VARCHAR)"
STATIONS = f"""stations AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, 'Street ' || s_suppkey AS address,
    n_name AS city,
    CASE WHEN s_suppkey % 2 = 0 THEN ' ' || {POSTAL} || ' ' ELSE {POSTAL} END AS postal_code,
    'DE' AS country, s_acctbal AS distance_in_m,
    CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'Owner' END AS owner,
    s_suppkey % 2 = 0 AS roaming, {lat('s_suppkey')} AS latitude, {lon('s_suppkey')} AS longitude,
    'Operator ' || (s_suppkey % 7) AS operator_name,
    CASE WHEN s_suppkey % 2 = 0 THEN '0800' ELSE '-' END AS operator_hotline,
    (s_suppkey % 4 = 0 OR s_suppkey % 8 = 1) AS open_24_7
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
)"""

POINTS = f"""points AS (
  SELECT CAST(c_custkey % {N_SUPPLIERS} AS INTEGER) AS id_cs,
    '-' AS charging_station_position, c_custkey % 2 = 0 AS roaming,
    'ref ' || (c_custkey % 5) AS physical_reference,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey % 4 AS VARCHAR) END
      AS cp_parking_space_numbers,
    CASE WHEN c_custkey % 2 = 0 THEN 'left' ELSE 'right' END AS cp_position,
    '-' AS cp_public_comment, 'CP' || c_custkey AS id, c_mktsegment AS vehicle_type,
    CAST(c_custkey % 3 AS VARCHAR) AS floor_level, CAST(c_custkey AS INTEGER) AS uid
  FROM customer
)"""

CONNECTORS = """connectors AS (
  SELECT 'CP' || o_custkey AS id_cp,
    CASE WHEN side = 0 THEN 'SOCKET' ELSE 'CABLE' END AS format,
    CASE WHEN f % 3 = 0 THEN 'DC' ELSE 'AC_3_PHASE' END AS power_type,
    'C' || o_custkey || '-' || side AS id, CAST(f % 9 AS VARCHAR) AS tariff_id,
    CAST(f % 64 AS INTEGER) AS ampere, CAST(f % 395 + 3 AS INTEGER) AS max_power,
    230 AS voltage, 'IEC_62196_T2' AS standard
  FROM (SELECT o_custkey, o_orderkey % 2 AS side, min(o_orderkey) AS f FROM orders GROUP BY 1, 2)
)"""

FACTS = f"""facts AS (
  SELECT 'CP' || user_id AS id_cp, 'C' || user_id || '-' || (event_id % 2) AS id_connector,
    {STATUS} AS status, ts, json_extract_string(props, '$.k') AS sensor FROM events
)"""


def _in(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


ALLOWED = [v for values in POI_TAGS.values() for v in values]
CATEGORY = (
    f"coalesce(CASE WHEN {_in('amenity', ALLOWED)} THEN amenity END, "
    f"CASE WHEN {_in('shop', ALLOWED)} THEN shop END)"
)
RADIUS = (
    "CASE poi_cat "
    + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in BUFFER_METRES.items())
    + f" ELSE {DEFAULT_BUFFER_METRES}::DOUBLE END"
)

FEATURES = f"""tagged AS (
  SELECT p_partkey AS osmid,
    CASE p_partkey % 3 WHEN 0 THEN 'point' WHEN 1 THEN 'polygon' ELSE 'multipolygon' END
      AS geom_type,
    CASE p_partkey % 3 WHEN 0 THEN 'node/' WHEN 1 THEN 'way/' ELSE 'relation/' END || p_partkey
      AS id_poi,
    CASE p_size % 7 WHEN 0 THEN 'supermarket' WHEN 1 THEN 'fuel' WHEN 2 THEN 'bench' END AS amenity,
    CASE p_size % 5 WHEN 0 THEN 'mall' WHEN 1 THEN 'bakery' END AS shop,
    {lon(f'(p_partkey % {N_SUPPLIERS})')} + (p_partkey * 29 % 37 - 18) * 4e-5::DOUBLE AS lon,
    {lat(f'(p_partkey % {N_SUPPLIERS})')} + (p_partkey * 13 % 41 - 20) * 3e-5::DOUBLE AS lat,
    (p_partkey % 5 + 1) * 1e-4::DOUBLE AS a, (p_partkey % 4 + 1) * 1e-4::DOUBLE AS b
  FROM part
), features AS (SELECT *, {CATEGORY} AS poi_cat FROM tagged
), placed AS (
  SELECT *,
    round(CASE geom_type WHEN 'point' THEN lon WHEN 'polygon' THEN lon + 0.625 * a
      ELSE lon + 3.5 * a END, 9) AS longitude,
    round(CASE geom_type WHEN 'point' THEN lat WHEN 'polygon' THEN lat - b / 8
      ELSE lat - b / 4 END, 9) AS latitude
  FROM features
)"""


def utm(source: str, name: str) -> str:
    """CTEs adding x, y in metres (UTM zone 32, GRS80) to ``source`` with lon, lat."""
    f = 1 / 298.257222101
    n = f / (2 - f)
    e = 2 * math.sqrt(n) / (1 + n)
    radius = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    east = " + ".join(
        f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)"
        for j, a in enumerate(alpha, 1)
    )
    north = " + ".join(
        f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)"
        for j, a in enumerate(alpha, 1)
    )
    return f"""{name}_t AS (
  SELECT *, sinh(atanh(sin(radians(lat))) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(radians(lat)))) AS t,
    radians(lon - 9) AS dlon FROM {source}
), {name}_s AS (
  SELECT *, atan2(t, cos(dlon)) AS xi, atanh(sin(dlon) / sqrt(1 + t * t)) AS eta FROM {name}_t
), {name} AS (
  SELECT *, 500000 + {radius!r}::DOUBLE * (eta + {east}) AS x,
    {radius!r}::DOUBLE * (xi + {north}) AS y FROM {name}_s
)"""


def _box(ring: int, x0: str, y0: str, x1: str, y1: str, kind: str) -> str:
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return " UNION ALL ".join(
        f"SELECT id_poi, poi_cat, {ring} AS ring, {i} AS i, lon + {x} AS lon, lat + {y} AS lat "
        f"FROM wanted WHERE geom_type = '{kind}'"
        for i, (x, y) in enumerate(corners)
    )


def matches(where: str = "true") -> str:
    """CTE ``matches``: every POI against every station, edge by edge."""
    corners = " UNION ALL ".join(
        [
            "SELECT id_poi, poi_cat, 0 AS ring, 0 AS i, lon, lat FROM wanted "
            "WHERE geom_type = 'point'",
            _box(0, "-a", "-b", "a", "b", "polygon"),
            _box(1, "-a / 2", "-b / 2", "a / 4", "b / 4", "polygon"),
            _box(0, "-a", "-b", "a", "b", "multipolygon"),
            _box(1, "a * 2", "-b", "a * 5", "b / 2", "multipolygon"),
        ]
    )
    return f"""{FEATURES}, wanted AS (SELECT * FROM features WHERE {where}), corners AS (
  SELECT *, {RADIUS} AS r FROM ({corners})
), {utm('corners', 'cxy')}, edges AS (
  SELECT id_poi, r, x AS ax, y AS ay,
    lead(x) OVER w AS bx, lead(y) OVER w AS by_, count(*) OVER (PARTITION BY id_poi) AS n_corners
  FROM cxy WINDOW w AS (PARTITION BY id_poi, ring ORDER BY i)
), spots AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id_cs, {lon('s_suppkey')} AS lon, {lat('s_suppkey')} AS lat
  FROM supplier
), {utm('spots', 'sxy')}, tested AS (
  SELECT id_poi, id_cs, r, x, y, ax, ay, bx, by_, n_corners,
    CASE WHEN n_corners = 1 THEN 0.0 ELSE greatest(0.0, least(1.0,
      ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay))
      / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)))) END AS t
  FROM edges, sxy WHERE n_corners = 1 OR bx IS NOT NULL
), matches AS (
  SELECT id_poi, id_cs FROM tested GROUP BY id_poi, id_cs
  HAVING bool_or(
    CASE WHEN n_corners = 1 THEN (x - ax) * (x - ax) + (y - ay) * (y - ay)
    ELSE (ax + t * (bx - ax) - x) * (ax + t * (bx - ax) - x)
      + (ay + t * (by_ - ay) - y) * (ay + t * (by_ - ay) - y) END <= r * r)
  OR count(*) FILTER (WHERE n_corners > 1 AND (ay > y) <> (by_ > y)
    AND x < ax + (y - ay) / (by_ - ay) * (bx - ax)) % 2 = 1
)"""


def city_case(key: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(CITIES))
    return f"CASE {key} % {len(CITIES)} {whens} END"


def city_poi_case(city: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CITY_POI_NAMES.items())
    return f"CASE {city} {whens} ELSE {city} END"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


STATION_COLUMNS = (
    "id AS id_cs, name, address, city, trim(postal_code) AS postal_code, country, owner, "
    "roaming, latitude, longitude, operator_name, operator_hotline, open_24_7"
)
POINT_COLUMNS = (
    "id AS id_cp, id_cs, charging_station_position, roaming, physical_reference, "
    "cp_parking_space_numbers, cp_position, vehicle_type, floor_level"
)
CONNECTOR_COLUMNS = (
    "id AS id_connector, id_cp, format, power_type, ampere, max_power, voltage, standard"
)
HAS_CATEGORY = "poi_cat IS NOT NULL"

ALL_TABLES = {
    "staging_connectors": "connectors",
    "staging_charging_points": "points",
    "staging_charging_stations": "stations",
    "staging_status_cp": "facts",
    "staging_status_connectors": "facts",
    "status_chargingpoints": "facts",
    "status_connectors": "facts",
    "charging_station": "stations",
    "charging_point": "points",
    "connector": "connectors",
    "time": "(SELECT DISTINCT ts FROM events)",
    "mapping_poi_cs": "matches",
    "poi": "(SELECT * FROM features WHERE poi_cat IS NOT NULL)",
}
ALL_CTES = with_(STATIONS, POINTS, CONNECTORS, FACTS, matches(HAS_CATEGORY))
ROW_COUNTS = ALL_CTES + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {s}" for t, s in ALL_TABLES.items()
)


def file_load_counts() -> str:
    """Rows per table when the star schema is loaded from the snapshot files."""
    last = "snapshot = (SELECT max(snapshot) FROM ev)"
    wanted = (
        f"({_in('amenity', POI_TAGS['amenity'])} OR {_in('shop', POI_TAGS['shop'])})"
    )
    seen = f"SELECT DISTINCT id_cs FROM ev WHERE {last}"
    counts = {
        "charging_stations": f"({seen})",
        "charging_points": f"(SELECT * FROM ev WHERE {last})",
        "connectors": f"(SELECT * FROM conn WHERE {last})",
        "status_cp": "ev",
        "status_connectors": "conn",
        "time": "(SELECT DISTINCT city_ts FROM evt)",
        "mapping_poi_cs": f"(SELECT * FROM matches WHERE id_cs IN ({seen}))",
        "poi": f"(SELECT * FROM features WHERE {wanted})",
    }
    tables = {
        "staging_connectors": "connectors", "staging_charging_points": "charging_points",
        "staging_charging_stations": "charging_stations", "staging_status_cp": "status_cp",
        "staging_status_connectors": "status_connectors", "status_chargingpoints": "status_cp",
        "status_connectors": "status_connectors", "charging_station": "charging_stations",
        "charging_point": "charging_points", "connector": "connectors", "time": "time",
        "mapping_poi_cs": "mapping_poi_cs", "poi": "poi",
    }
    return with_(EVENTS, CONNECTORS_SEEN, matches(wanted)) + union(
        [
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {counts[c]}"
            for t, c in tables.items()
        ]
    )


def rule(name: str, predicate: str, source: str, how: str = "all") -> str:
    passed = f"count(*) FILTER (WHERE coalesce({predicate}, false))"
    held = f"{passed} = count(*)" if how == "all" else f"{passed} > 0"
    return (
        f"SELECT '{name}' AS rule, count(*) AS n_rows, {passed} AS n_passed, "
        f"count(*) > 0 AND {held} AS passed FROM {source}"
    )


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def not_null_counts() -> str:
    columns = {
        ("staging_connectors", "id_cp"): ("connectors", "id_cp"),
        ("staging_charging_points", "id_cs"): ("points", "id_cs"),
        ("staging_charging_points", "uid"): ("points", "uid"),
        ("staging_status_cp", "status_cp"): ("facts", "status"),
        ("staging_status_cp", "id_cp"): ("facts", "id_cp"),
        ("staging_status_cp", "ts"): ("facts", "ts"),
        ("staging_status_connectors", "status_connector"): ("facts", "status"),
        ("staging_status_connectors", "id_connector"): ("facts", "id_connector"),
        ("staging_status_connectors", "ts"): ("facts", "ts"),
        ("status_chargingpoints", "id_status_cp"): ("facts", key_hash("id_cp", "ts")),
        ("status_chargingpoints", "id_chargingpoint"): ("facts", "id_cp"),
        ("status_chargingpoints", "query_time"): ("facts", "ts"),
        ("status_connectors", "id_status_connector"): ("facts", key_hash("id_connector", "ts")),
        ("status_connectors", "id_connector"): ("facts", "id_connector"),
        ("status_connectors", "query_time"): ("facts", "ts"),
        ("charging_point", "id_cp"): ("points", "id"),
        ("charging_point", "id_cs"): ("points", "id_cs"),
        ("connector", "id_connector"): ("connectors", "id"),
        ("connector", "id_cp"): ("connectors", "id_cp"),
        ("time", "query_time"): ("facts", "ts"),
        ("mapping_poi_cs", "id_poi"): ("matches", "id_poi"),
        ("mapping_poi_cs", "id_cs"): ("matches", "id_cs"),
        ("poi", "longitude"): ("placed", "longitude"),
        ("poi", "latitude"): ("placed", "latitude"),
        ("poi", "id_poi"): ("placed", "id_poi"),
        ("poi", "poi_category"): ("(SELECT * FROM placed WHERE poi_cat IS NOT NULL)", "poi_cat"),
    }
    return ALL_CTES + union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {expr} IS NULL) AS n_null FROM {source}"
            for (t, c), (source, expr) in columns.items()
        ]
    )


def unique_keys() -> str:
    keys = {
        "status_chargingpoints": ("facts", key_hash("id_cp", "ts")),
        "status_connectors": ("facts", key_hash("id_connector", "ts")),
        "charging_station": ("stations", "id"),
        "charging_point": ("points", "id"),
        "connector": ("connectors", "id"),
        "time": ("(SELECT DISTINCT ts FROM events)", "ts"),
        "poi": ("(SELECT * FROM features WHERE poi_cat IS NOT NULL)", "id_poi"),
    }
    return with_(STATIONS, POINTS, CONNECTORS, FACTS, FEATURES) + union(
        [key_counts(table, source, key) for table, (source, key) in keys.items()]
    )


def key_counts(table: str, source: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, "
        "count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_repeated_keys "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"
    )


def orphan_counts() -> str:
    references = [
        ("status_chargingpoints", "id_chargingpoint", "charging_point", "facts", "id_cp", "points", "id"),
        ("status_chargingpoints", "query_time", "time", "facts", "ts", "events", "ts"),
        ("status_connectors", "id_connector", "connector", "facts", "id_connector", "connectors", "id"),
        ("status_connectors", "query_time", "time", "facts", "ts", "events", "ts"),
        ("charging_point", "id_cs", "charging_station", "points", "id_cs", "stations", "id"),
        ("connector", "id_cp", "charging_point", "connectors", "id_cp", "points", "id"),
        ("mapping_poi_cs", "id_poi", "poi", "matches", "id_poi",
         "(SELECT * FROM features WHERE poi_cat IS NOT NULL)", "id_poi"),
        ("mapping_poi_cs", "id_cs", "charging_station", "matches", "id_cs", "stations", "id"),
    ]
    return ALL_CTES + union(
        [
            f"SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent, "
            f"count(DISTINCT c.{ck}) AS n_orphan_keys, count(*) AS n_orphan_rows "
            f"FROM {cs} c WHERE c.{ck} NOT IN (SELECT p.{pk} FROM {ps} p)"
            for child, column, parent, cs, ck, ps, pk in references
        ]
    )


def shares(id_column: str, source_id: str, ordered: str = "") -> str:
    return (
        with_(FACTS)
        + f"SELECT {source_id} AS {id_column}, status, count(*) AS n, "
        "round_even(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY "
        f"{source_id}) * 100, 0) / 100 AS share FROM facts WHERE status IS NOT NULL "
        f"GROUP BY {source_id}, status{ordered}"
    )


CITY_FEATURES = (
    FEATURES
    + f""", in_cities AS (
  SELECT id_poi, geom_type, {city_case('(osmid % 25)')} AS code FROM features
  UNION ALL
  SELECT id_poi, geom_type, {city_case('(osmid % 25 + 1)')} FROM features WHERE osmid % 10 = 0
)"""
)

POINT_MASTER = (
    "id_cs, coalesce(place, '-') AS charging_station_position, event_id % 2 = 0 AS roaming, "
    "'-' AS physical_reference, '-' AS cp_parking_space_numbers, side AS cp_position, "
    "'-' AS cp_public_comment, 'CP' || user_id AS id, '-' AS vehicle_type, "
    "floor AS floor_level, CAST(event_id AS INTEGER) AS uid"
)
CONNECTOR_MASTER = (
    with_(EVENTS, CONNECTORS_SEEN)
    + "SELECT id_cp, format, '-' AS power_type, id, '-' AS tariff_id, "
    "CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 64 AS INTEGER) END AS ampere, "
    "CAST(user_id % 395 + 3 AS INTEGER) AS max_power, 230 AS voltage, '-' AS standard FROM conn"
)
CP_STATUS = (
    "SELECT 'CP' || user_id AS id, status, sensor AS parkingsensor_status, "
    'city_ts AS "timestamp" FROM evt'
)
CONNECTOR_STATUS = 'SELECT id, status, city_ts AS "timestamp" FROM conn'
ALL_STATUS = (
    with_(EVENTS, CONNECTORS_SEEN)
    + "SELECT 'CP' || user_id AS id, status, sensor AS parkingsensor_status, "
    "city_ts AS \"timestamp\", 'point' AS level FROM evt UNION ALL "
    "SELECT id, status, NULL, city_ts, 'connector' FROM conn"
)
ALL_MATCHES = with_(matches()) + "SELECT id_poi, id_cs FROM matches"
CATEGORY_MATCHES = with_(matches(HAS_CATEGORY)) + "SELECT id_poi, id_cs FROM matches"

FACT_ROWS = (
    with_(EVENTS, CONNECTORS_SEEN)
    + "SELECT 'point' AS level, 'CP' || user_id AS id, city_ts AS query_time, status FROM evt UNION ALL "
    "SELECT 'connector', id, city_ts, status FROM conn"
)
PUBLISHED_COUNTS = ALL_CTES + union(
    [
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, 2 AS manifest FROM {s}"
        for t, s in ALL_TABLES.items()
        if not t.startswith("staging_")
    ]
)


def polls(id_column: str, where: str = "true") -> str:
    """CTE ``polls``: each id's polls with the next one's time and the number of the run."""
    return f"""single AS (
  SELECT {id_column} AS id, ts, bool_or(coalesce(status = 'CHARGING', false)) AS active
  FROM facts WHERE {where} GROUP BY 1, 2
), polls AS (
  SELECT *, lead(ts) OVER w AS following,
    row_number() OVER w - row_number() OVER (PARTITION BY id, active ORDER BY ts) AS run
  FROM single WINDOW w AS (PARTITION BY id ORDER BY ts)
)"""


def events_of(id_column: str, source_id: str) -> str:
    return with_(FACTS, polls(source_id)) + (
        f"SELECT id AS {id_column}, min(ts) AS event_start, max(ts) AS event_end, "
        "CASE WHEN max(following) > max(ts) THEN max(following) END AS ended, count(*) AS n_polls "
        "FROM polls WHERE active GROUP BY id, run"
    )


def times_of(start: str, end: str) -> list[str]:
    """CTEs up to ``times``: each id's active and observed microseconds in a period."""
    low, high = f"TIMESTAMP '{start}'", f"TIMESTAMP '{end}'"
    times = f"""times AS (
  SELECT id, sum(us) FILTER (WHERE active) AS active_us, sum(us) AS observed_us FROM (
    SELECT id, active, greatest(0, epoch_us(least(coalesce(following, {high}), {high})) - epoch_us(greatest(ts, {low}))) AS us
    FROM polls) GROUP BY id
)"""
    return [FACTS, POINTS, STATIONS, polls("id_cp", f"ts < {high}"), times]


SHARES = (
    "count(*) AS n_points, CAST(coalesce(sum(active_us), 0) AS DOUBLE) / 1e6 AS active_seconds, "
    "CAST(sum(observed_us) AS DOUBLE) / 1e6 AS observed_seconds, "
    "CASE WHEN sum(observed_us) > 0 THEN round_even(CAST(coalesce(sum(active_us), 0) AS DOUBLE) "
    "/ CAST(sum(observed_us) AS DOUBLE) * 100, 0) / 100 END AS utilization "
)


def rollup_of(start: str, end: str) -> str:
    return with_(*times_of(start, end)) + (
        "SELECT operator_name, city, s.id AS id_cs, CAST(grouping(operator_name, city, s.id) AS INTEGER) AS level, "
        f"{SHARES}FROM times t LEFT JOIN points p ON p.id = t.id LEFT JOIN stations s ON s.id = p.id_cs "
        "GROUP BY ROLLUP (operator_name, city, s.id)"
    )


def by_poi(start: str, end: str) -> str:
    near = """near AS (
  SELECT DISTINCT id_cs, poi_cat FROM matches JOIN (SELECT id_poi, poi_cat FROM features) USING (id_poi)
)"""
    return with_(*times_of(start, end), matches(HAS_CATEGORY), near) + (
        "SELECT poi_cat AS poi_category, count(DISTINCT p.id_cs) AS n_stations, "
        f"{SHARES}FROM times t LEFT JOIN points p ON p.id = t.id LEFT JOIN near n ON n.id_cs = p.id_cs GROUP BY poi_cat"
    )


STATION_HISTORY = f"WITH {EVENTS}, " + """states AS (
  SELECT id_cs, city, city_ts AS ts, CAST(count(*) AS INTEGER) AS n_points FROM evt GROUP BY id_cs, city, no, city_ts
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY id_cs ORDER BY ts)
    - row_number() OVER (PARTITION BY id_cs, city, n_points ORDER BY ts) AS run FROM states
), stretches AS (
  SELECT id_cs, city, n_points, min(ts) AS valid_from, max(ts) AS last_seen FROM numbered GROUP BY id_cs, city, n_points, run
) SELECT *, lead(valid_from) OVER (PARTITION BY id_cs ORDER BY valid_from) AS valid_to FROM stretches"""

#: Keys of the fixture's points: type, and which records have the key.
POINT_KEYS_SEEN = {
    "id": ("STRING", "true"), "uid": ("BIGINT", "true"), "status": ("STRING", "true"),
    "parkingsensor_status": ("STRING", "event_type <> 'signup'"), "roaming": ("BOOLEAN", "true"),
    "charging_station_position": ("STRING", "event_id % 2 = 0"), "cp_position": ("STRING", "true"),
    "floor_level": ("STRING", "true"), "capabilities": ("ARRAY<STRING>", "true"),
    "connectors": (
        "ARRAY<OBJECT<ampere: BIGINT, format: STRING, id: STRING, max_power: BIGINT, status: STRING, voltage: BIGINT>>",
        "event_id % 5 <> 0",
    ),
}
DISCOVERED = with_(EVENTS) + union(
    [
        f"SELECT '{key}' AS key, '{kind}' AS type, count(*) FILTER (WHERE {has}) AS n_records FROM ev"
        for key, (kind, has) in POINT_KEYS_SEEN.items()
    ]
)

ORACLE: dict[str, str] = {
    "raw_snapshot_scan": with_(EVENTS)
    + "SELECT snapshot, CAST(count(DISTINCT city) AS INTEGER) AS n_cities FROM ev GROUP BY snapshot",
    "snapshot_time": f"SELECT DISTINCT strftime({POLLED}, '%Y%m%d_%H%M%S') || '_cp_data_cities' "
    f"AS snapshot, {POLLED} AS polled_at FROM events",
    "station_rows": with_(EVENTS)
    + "SELECT DISTINCT snapshot, city AS city_key, id_cs AS id, s_name AS name FROM ev",
    "station_columns": with_(EVENTS)
    + "SELECT DISTINCT snapshot, CAST(id_cs AS VARCHAR) AS id, 'DE' AS country, "
    'city_ts AS "timestamp" FROM evt',
    "station_rows_ts": with_(EVENTS)
    + 'SELECT snapshot, id_cs AS id, city_ts AS "timestamp", CAST(count(*) AS INTEGER) AS n_evses '
    "FROM evt GROUP BY snapshot, id_cs, city_ts",
    "latest_snapshot": with_(EVENTS)
    + f"SELECT id_cs, id, uid FROM (SELECT {POINT_MASTER} FROM evt "
    "WHERE snapshot = (SELECT max(snapshot) FROM ev))",
    "raw_archive": with_(EVENTS)
    + f"SELECT snapshot, CAST(CAST({POLLED} AS DATE) AS VARCHAR) AS snapshot_date, "
    "CAST(count(DISTINCT city) AS INTEGER) AS n_cities FROM ev GROUP BY 1, 2",
    "quarantine": with_(EVENTS)
    + "SELECT DISTINCT snapshot AS path, true AS readable FROM ev UNION ALL "
    "SELECT 'page ' || page_id, false FROM pages",
    "quarantine_parts": with_(EVENTS)
    + "SELECT path, city, CAST(station AS INTEGER) AS station, reason FROM "
    "(SELECT DISTINCT snapshot AS path FROM ev), (VALUES ('broken', NULL, 'city'), "
    "('late', NULL, 'time'), ('odd', 0, 'station'), ('odd', 1, 'points')) "
    "AS parts(city, station, reason) "
    "UNION ALL SELECT 'page ' || page_id, NULL, NULL, 'document' FROM pages",
    "stream_intake": ALL_STATUS,
    "intake_load": FACT_ROWS,
    "intake_compacted": ALL_STATUS,
    "explode_children": with_(EVENTS) + "SELECT snapshot, id_cs, event_id AS uid FROM evt",
    "dynamic_columns": with_(EVENTS)
    + "SELECT CAST(id_cs AS VARCHAR) AS id_cs, '[\"RFID\"]' AS capabilities, "
    "coalesce(place, '-') AS charging_station_position, side AS cp_position, "
    "floor AS floor_level, 'CP' || user_id AS id, sensor AS parkingsensor_status, "
    "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS roaming, "
    "CAST(event_id AS VARCHAR) AS uid FROM evt",
    "discovered_schema": DISCOVERED,
    "fill_missing_scalar": with_(EVENTS)
    + "SELECT CAST(event_id AS VARCHAR) AS uid, sensor AS parkingsensor_status, "
    "'-' AS physical_reference FROM evt",
    "fill_missing_per_column": with_(EVENTS)
    + "SELECT CAST(event_id AS VARCHAR) AS uid, "
    "coalesce(place, 'unknown') AS charging_station_position, floor AS floor_level, "
    "CAST(NULL AS VARCHAR) AS physical_reference FROM evt",
    "attach_parent_ts": with_(EVENTS)
    + 'SELECT id_cs, event_id AS uid, city_ts AS "timestamp" FROM evt',
    "last_wins_parent": with_(EVENTS)
    + "SELECT snapshot, id_cs, event_id AS uid FROM evt "
    "QUALIFY event_id % 2 = max(event_id % 2) OVER (PARTITION BY no, id_cs)",
    "last_wins_table": "SELECT event_id, user_id, event_type, ts FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "station_master": with_(EVENTS, STATIONS)
    + "SELECT id, name, address, city, postal_code, country, distance_in_m, "
    "CASE WHEN id % 3 = 1 THEN 'Owner' END AS owner, roaming, latitude, longitude, "
    "operator_name, operator_hotline, open_24_7 "
    "FROM stations JOIN (SELECT DISTINCT no, id_cs FROM ev) ON id_cs = id",
    "charging_point_master": with_(EVENTS) + f"SELECT {POINT_MASTER} FROM evt",
    "connector_master": CONNECTOR_MASTER,
    "cp_status": with_(EVENTS) + CP_STATUS,
    "connector_status": with_(EVENTS, CONNECTORS_SEEN) + CONNECTOR_STATUS,
    "status_all_snapshots": ALL_STATUS,
    "csv_scan": with_(STATIONS)
    + "SELECT * REPLACE (nullif(owner, '') AS owner) FROM stations",
    "empty_as_null": with_(POINTS)
    + "SELECT * REPLACE (nullif(cp_parking_space_numbers, '') AS cp_parking_space_numbers) "
    "FROM points",
    "csv_round_trip": with_(EVENTS)
    + "SELECT 'CP' || user_id AS id_cp, status AS status_cp, "
    "coalesce(sensor, '') AS parkingsensor_status, city_ts AS ts FROM evt",
    "text_round_trip": "SELECT CAST(conv_id AS INTEGER) AS conv_id, CAST(turn AS INTEGER) AS turn, "
    "coalesce(role, '') AS role, coalesce(text || chr(10) || '\"quoted\"; ' || chr(13) || chr(10) "
    "|| 'last' || chr(92) || 'n', '') AS text FROM conversations",
    "staging_cast": CONNECTOR_MASTER,
    "poi_tag_filter": with_(FEATURES)
    + f"SELECT osmid, amenity, shop FROM features WHERE {_in('amenity', POI_TAGS['amenity'])} "
    f"OR {_in('shop', POI_TAGS['shop'])}",
    "poi_id": with_(FEATURES) + "SELECT id_poi, osmid FROM features",
    "poi_category": with_(FEATURES) + "SELECT id_poi, poi_cat FROM features",
    "poi_point": with_(FEATURES) + "SELECT osmid, longitude, latitude FROM placed",
    "project_utm32": with_(FEATURES, utm("features", "fxy"))
    + "SELECT osmid, round(x, 3) AS x, round(y, 3) AS y FROM fxy",
    "poi_by_geom_type": with_(FEATURES) + "SELECT id_poi, poi_cat, geom_type FROM features",
    "poi_scan_union": with_(FEATURES)
    + "SELECT id_poi, poi_cat, CASE geom_type WHEN 'point' THEN 1 ELSE 10 END AS n_vertices "
    "FROM features",
    "poi_all_cities": with_(CITY_FEATURES)
    + f"SELECT {city_poi_case('code')} AS city, id_poi FROM in_cities",
    "city_lookup": f"SELECT s_suppkey, city, {city_poi_case('city')} AS city_poi FROM "
    f"(SELECT s_suppkey, {city_case('s_nationkey')} AS city FROM supplier)",
    "buffer_distance": with_(FEATURES)
    + f"SELECT id_poi, poi_cat, {RADIUS} AS radius FROM features",
    "poi_station_match": ALL_MATCHES,
    "poi_station_files": ALL_MATCHES,
    "poi_station_pipeline": with_(matches(), STATIONS)
    + "SELECT m.id_poi, m.id_cs, w.poi_cat, s.city FROM matches m "
    "JOIN wanted w ON w.id_poi = m.id_poi JOIN stations s ON s.id = m.id_cs",
    "load_from_files": file_load_counts(),
    "mapping_load": CATEGORY_MATCHES,
    "fact_status_cp": with_(FACTS)
    + f"SELECT {key_hash('id_cp', 'ts')} AS id_status_cp, id_cp AS id_chargingpoint, "
    "ts AS query_time, status AS status_cp, sensor AS status_parkingsensor FROM facts",
    "fact_status_connector": with_(FACTS)
    + f"SELECT {key_hash('id_connector', 'ts')} AS id_status_connector, id_connector, "
    "ts AS query_time, status AS status_connector FROM facts",
    "dim_station": with_(STATIONS) + f"SELECT {STATION_COLUMNS} FROM stations",
    "dim_scan": with_(STATIONS) + f"SELECT {STATION_COLUMNS} FROM stations",
    "dim_charging_point": with_(POINTS) + f"SELECT {POINT_COLUMNS} FROM points",
    "dim_connector": with_(CONNECTORS) + f"SELECT {CONNECTOR_COLUMNS} FROM connectors",
    "dim_time": 'SELECT DISTINCT ts AS query_time, CAST(extract(hour FROM ts) AS INTEGER) AS "hour", '
    'CAST(extract(day FROM ts) AS INTEGER) AS "day", '
    "CAST(extract(week FROM ts) AS INTEGER) AS week, "
    'CAST(extract(month FROM ts) AS INTEGER) AS "month", '
    'CAST(extract(year FROM ts) AS INTEGER) AS "year", '
    "CAST(extract(dayofweek FROM ts) AS INTEGER) AS weekday FROM events",
    "dim_poi": with_(FEATURES)
    + "SELECT id_poi, poi_cat AS poi_category, longitude, latitude, "
    "CASE geom_type WHEN 'point' THEN 1 ELSE 10 END AS n_vertices FROM placed "
    "WHERE poi_cat IS NOT NULL",
    "star_schema_rowcounts": ROW_COUNTS,
    "warehouse_load": ROW_COUNTS,
    "incremental_load": ALL_CTES
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {s}"
        for t, s in ALL_TABLES.items()
        if not t.startswith("staging_")
    ),
    "published_tables": PUBLISHED_COUNTS,
    "parameterised_sql": with_(STATIONS)
    + "SELECT city, count(*) AS n_stations FROM stations WHERE roaming GROUP BY city",
    "dq_row_count": ALL_CTES
    + union([rule(f"row_count_{t}", "true", s) for t, s in ALL_TABLES.items()]),
    "dq_length": with_(STATIONS)
    + rule("postal_code_length", "length(trim(postal_code)) = 5", "stations")
    + " UNION ALL "
    + rule("raw_postal_code_length", "length(postal_code) = 5", "stations"),
    "dq_range": with_(CONNECTORS)
    + rule("power_limits_connectors", "max_power > 2 AND max_power < 400", "connectors")
    + " UNION ALL "
    + rule("ampere_limits_connectors", "ampere > 2 AND ampere < 400", "connectors"),
    "dq_quantifier": with_(FACTS)
    + union(
        [
            rule("all_charging", "status = 'CHARGING'", "facts"),
            rule("any_charging", "status = 'CHARGING'", "facts", "any"),
            rule("all_sensors", "TRY_CAST(sensor AS INTEGER) >= 0", "facts"),
            rule("any_null", "CAST(NULL AS BOOLEAN)", "facts", "any"),
        ]
    ),
    "dq_not_null": not_null_counts(),
    "dq_unique_key": unique_keys(),
    "dq_orphans": orphan_counts(),
    "dq_one_to_one": with_(CITY_FEATURES)
    + key_counts("features", "features", "id_poi")
    + " UNION ALL "
    + key_counts("features of all cities", "in_cities", "id_poi"),
    "status_series_cp": with_(FACTS)
    + "SELECT id_cp AS id_chargingpoint, ts AS query_time, status, "
    f"{status_num('status')} AS status_num FROM facts",
    "status_series_connector": with_(FACTS)
    + f"SELECT id_connector, ts AS query_time, status, {status_num('status')} AS status_num "
    "FROM facts",
    "status_numeric": with_(FACTS)
    + f"SELECT status AS status_cp, {status_num('status')} AS status_num, count(*) AS n "
    "FROM facts GROUP BY 1, 2",
    "status_share": shares("id_chargingpoint", "id_cp", " ORDER BY id_cp, n DESC, status"),
    "status_share_connector": shares("id_connector", "id_connector"),
    "points_of_station": with_(STATIONS, POINTS)
    + "SELECT p.id_cs, s.name, p.id AS id_cp, vehicle_type FROM points p "
    "JOIN stations s ON s.id = p.id_cs",
    "connectors_of_point": with_(CONNECTORS)
    + "SELECT id_cp, id AS id_connector, format, max_power FROM connectors",
    "drilldown": with_(STATIONS, POINTS, CONNECTORS, FACTS)
    + "SELECT f.id_connector, f.ts AS query_time, f.status AS status_connector, s.id AS id_cs, "
    "p.id AS id_cp, c.max_power, s.city FROM facts f JOIN connectors c ON c.id = f.id_connector "
    "JOIN points p ON p.id = c.id_cp JOIN stations s ON s.id = p.id_cs",
    "charging_events": events_of("id_chargingpoint", "id_cp"),
    "charging_events_connector": events_of("id_connector", "id_connector"),
    "utilization_rollup": rollup_of("2024-01-05 06:00:00", "2024-01-20 18:30:00"),
    "utilization_by_poi": by_poi("2024-01-05 06:00:00", "2024-01-20 18:30:00"),
    "station_history": STATION_HISTORY,
    "station_history_grown": STATION_HISTORY,
    "station_header": with_(STATIONS)
    + "SELECT id AS id_cs, operator_name, address, trim(postal_code) AS postal_code, city "
    "FROM stations",
    "station_positions": with_(STATIONS) + "SELECT id AS id_cs, latitude, longitude FROM stations",
}
