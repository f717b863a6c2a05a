"""DuckDB SQL oracles for the registered queries.

Each oracle recomputes the same answer from the driver tables with plain SQL,
from the rules of the products and in another shape than the Spark plans
(aggregates of structs, numbered hour sets, counted ranks). The fixture derivations mirror
``wxmesh.sources.fixtures``; decimal literals are written as doubles so both
engines do the same floating-point operations.
"""

from __future__ import annotations

D = "::DOUBLE"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Haversine in metres, same operation order as ``functions.geo.haversine_m``."""
    s_lat = f"sin(radians({lat2} - {lat1}) / 2.0{D})"
    s_lon = f"sin(radians({lon2} - {lon1}) / 2.0{D})"
    a = f"{s_lat} * {s_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {s_lon} * {s_lon}"
    return f"(12742000.0{D} * asin(sqrt({a})))"


def wmo(key: str) -> str:
    return f"CASE WHEN {key} % 20 <> 19 THEN 'W' || lpad(CAST({key} // 2 AS VARCHAR), 5, '0') END"


def newest(columns: str) -> str:
    """Newest first, in a total order of the given columns."""
    return ", ".join(f"{c.strip()} DESC NULLS LAST" for c in columns.split(","))


BASE = {
    "raw_stations": f"""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS id,
       CAST(NULL AS VARCHAR) AS dwd_station_id,
       {wmo('s_suppkey')} AS wmo_station_id,
       s_name AS station_name,
       CASE WHEN s_suppkey % 2 = 0 THEN 'historical' ELSE 'forecast' END AS observation_type,
       52.52{D} + ((kk * 53) % 97 - 48) / 400.0{D} AS lat,
       13.4{D} + ((kk * 37) % 101 - 50) / 250.0{D} + (s_suppkey % 2) / 100000.0{D} AS lon,
       CASE WHEN s_suppkey % 10 = 7 OR k % 9 = 4 THEN TIMESTAMP '2023-05-03 00:00:00'
            ELSE TIMESTAMP '2025-12-01 00:00:00' END AS last_record
FROM (SELECT s_suppkey, s_name, s_suppkey // 2 AS k,
             s_suppkey // 2 - CASE WHEN (s_suppkey // 2) % 11 = 3 THEN 1 ELSE 0 END AS kk
      FROM supplier)""",
    "raw_postal": f"""
SELECT plz, plz AS name, x0, y0, x0 + 0.005{D} * 1.5{D} AS cx, y0 + 0.005{D} * 1.0{D} AS cy
FROM (SELECT (CASE WHEN n_nationkey % 6 = 5 THEN '14' WHEN n_nationkey % 3 = 0 THEN '10'
                   WHEN n_nationkey % 3 = 1 THEN '12' ELSE '13' END)
             || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS plz,
             13.4{D} + ((n_nationkey * 29) % 51 - 25) / 100.0{D}
               + CASE WHEN n_nationkey = 24 THEN 2.0{D} ELSE 0.0{D} END AS x0,
             52.52{D} + ((n_nationkey * 31) % 41 - 20) / 100.0{D} AS y0
      FROM nation)""",
    "raw_obs": f"""
SELECT event_id,
       date_trunc('hour', ts) AS "timestamp",
       lpad(CAST(user_id AS VARCHAR), 6, '0') AS station_id,
       {wmo('user_id')} AS wmo_station_id,
       CASE WHEN event_type <> 'error' THEN value - 20.0{D} END AS temperature,
       CASE WHEN event_id % 7 <> 0 THEN value * 0.125{D} END AS precipitation,
       CASE WHEN event_id % 23 <> 0 THEN (event_id * 13) % 104 END AS relative_humidity,
       (event_id % 40) * 0.25{D} AS wind_speed,
       CAST(NULL AS BIGINT) AS wind_direction,
       ts AS ingested_at
FROM events""",
    "raw_fc": f"""
SELECT l_orderkey * 10 + l_linenumber AS id,
       lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS station_id,
       {wmo('l_suppkey')} AS wmo_station_id,
       TIMESTAMP '2024-02-01 00:00:00' + h * INTERVAL 1 HOUR AS forecast_timestamp,
       l_partkey AS source_id,
       CASE WHEN l_partkey % 50 = 0 THEN 99.0{D}
            WHEN h % 24 IN (3, 4) THEN NULL
            WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN NULL
            ELSE l_quantity * 1.5{D} - 20.0{D} END AS temperature,
       l_discount * 10.0{D} AS precipitation,
       l_linenumber * 15.0{D} - 2.0{D} AS relative_humidity,
       l_quantity * 0.5{D} AS wind_speed,
       CAST(NULL AS DOUBLE) AS wind_direction,
       CAST(NULL AS VARCHAR) AS condition,
       l_extendedprice AS tie,
       l_shipdate AS ingested_at
FROM (SELECT *, (l_orderkey * 7 + l_linenumber) % 240 AS h FROM lineitem)""",
    "stg_stations": """
SELECT id AS station_id, station_name, wmo_station_id, dwd_station_id,
       first_value(lon) OVER w AS geom_x, first_value(lat) OVER w AS geom_y
FROM raw_stations
WHERE wmo_station_id IS NOT NULL AND last_record >= TIMESTAMP '2025-09-01 00:00:00'
WINDOW w AS (PARTITION BY wmo_station_id ORDER BY id)""",
    "stg_areas": """
SELECT plz AS postal_code, x0, y0, cx, cy FROM raw_postal
WHERE starts_with(plz, '10') OR starts_with(plz, '12') OR starts_with(plz, '13')""",
    "stg_observations": f"""
SELECT "timestamp", station_id, wmo_station_id, temperature, precipitation,
       relative_humidity, wind_speed, wind_direction, ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY wmo_station_id, "timestamp"
                                   ORDER BY {newest("ingested_at, station_id, temperature, precipitation, relative_humidity, wind_speed")}) AS rn
      FROM raw_obs)
WHERE rn = 1""",
    "stg_forecasts": f"""
SELECT forecast_timestamp, station_id, wmo_station_id, temperature, precipitation,
       relative_humidity, wind_speed, wind_direction, condition, ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY wmo_station_id, forecast_timestamp
                                   ORDER BY {newest("ingested_at, id, station_id, source_id, temperature, precipitation, relative_humidity, wind_speed")}) AS rn
      FROM raw_fc)
WHERE rn = 1""",
    "active_ids": """
SELECT wmo_station_id FROM stg_observations WHERE temperature IS NOT NULL
UNION
SELECT wmo_station_id FROM stg_forecasts WHERE temperature IS NOT NULL""",
    "station_pts": """
SELECT DISTINCT wmo_station_id, geom_y AS lat, geom_x AS lon FROM stg_stations
WHERE wmo_station_id IN (SELECT wmo_station_id FROM active_ids)""",
    # Rank of a station = how many different distances of its area are not greater.
    "near": f"""
SELECT * FROM (
  SELECT wmo_station_id, postal_code, round({hav('cy', 'cx', 'lat', 'lon')}, 3) AS dist FROM station_pts, stg_areas)
WHERE dist <= 15000.0""",
    "ranked": """
SELECT n.wmo_station_id, n.postal_code, n.dist, CAST(count(DISTINCT o.dist) AS INTEGER) AS station_rank
FROM near n JOIN near o ON o.postal_code = n.postal_code AND o.dist <= n.dist
GROUP BY ALL""",
    "station_map": "SELECT * FROM ranked WHERE station_rank <= 10",
}

_VALUES = "temperature, precipitation, relative_humidity, wind_speed"
_STRUCT = ", ".join(f"{c} := {c}" for c in _VALUES.replace(",", "").split())


def fact_ctes(prefix: str, staged: str, ts: str, hour: str) -> dict:
    """Cleaning, hours, best station and fill of one fact table.

    Best station: the least (rank, id) struct of an area and hour, which carries
    the values. Fill: the hours are numbered, and an area's value of an hour is
    taken from the best row of that hour's number, else of the number before.
    """
    value = ", ".join(f"coalesce(now.b.{c}, before.b.{c}) AS {c}" for c in _VALUES.replace(",", "").split())
    return {
        f"cleaned_{prefix}": f"""
SELECT f.wmo_station_id, m.postal_code, f.{ts}, date_trunc('hour', f.{ts}) AS {hour}, {_VALUES}, m.station_rank
FROM station_map m JOIN {staged} f USING (wmo_station_id)
WHERE coalesce(f.temperature, 0) BETWEEN -50 AND 60 AND coalesce(f.relative_humidity, 0) BETWEEN 0 AND 100""",
        f"{prefix}_hours": f"SELECT {hour} FROM cleaned_{prefix} GROUP BY {hour}",
        f"{prefix}_numbered": f"SELECT {hour}, row_number() OVER (ORDER BY {hour}) AS k FROM {prefix}_hours",
        f"{prefix}_choice": f"""
SELECT postal_code, k, min(struct_pack(station_rank := station_rank, wmo := wmo_station_id, {_STRUCT})) AS b
FROM cleaned_{prefix} JOIN {prefix}_numbered USING ({hour})
WHERE temperature IS NOT NULL GROUP BY postal_code, k""",
        f"{prefix}_best": f"""
SELECT postal_code, {hour}, {", ".join(f"b.{c} AS {c}" for c in _VALUES.replace(",", "").split())}
FROM {prefix}_choice JOIN {prefix}_numbered USING (k)""",
        f"{prefix}_spine": f"SELECT DISTINCT postal_code, {hour}, k FROM stg_areas, {prefix}_numbered",
        f"{prefix}_mart": f"""
SELECT s.postal_code, s.{hour}, {value}
FROM {prefix}_spine s
LEFT JOIN {prefix}_choice now ON now.postal_code = s.postal_code AND now.k = s.k
LEFT JOIN {prefix}_choice before ON before.postal_code = s.postal_code AND before.k = s.k - 1""",
    }


CTES = dict(BASE)
CTES.update(fact_ctes("obs", "stg_observations", '"timestamp"', "observation_hour"))
CTES.update(fact_ctes("fc", "stg_forecasts", "forecast_timestamp", "forecast_hour"))


def with_ctes(body: str, extra: dict | None = None) -> str:
    """Prefix ``body`` with every CTE it (transitively) references, in order.

    ``extra`` adds query-specific CTEs after the shared ones.
    """
    import re

    ctes = dict(CTES)
    ctes.update(extra or {})
    names = list(ctes)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in needed and re.search(rf"\b{n}\b", text):
                needed.add(n)
                visit(ctes[n])

    visit(body)
    parts = [f"{n} AS ({ctes[n]}\n)" for n in names if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
