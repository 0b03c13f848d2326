"""DuckDB SQL equal in meaning to each registered query (the correctness oracle).

The oracle deliberately takes the textbook route -- join at row grain, then
aggregate; window ``row_number`` for de-duplication -- so a match also
checks that the Spark plans' rewrites (aggregate before join, partial
``min(struct)`` de-duplication, grid-cell proximity join) change nothing.
"""

from __future__ import annotations

from entryclime.functions.dates import STAY_PATTERN_LOOSE as LOOSE
from entryclime.functions.dates import STAY_PATTERN_STRICT as STRICT
from entryclime.functions.geo import MEAN_RADIUS_KM, WGS84_A_KM, WGS84_F


def _lat(k: str) -> str:
    return f"(CAST(24.5 AS DOUBLE) + CAST({k} % 26 AS DOUBLE))"


def _lon(k: str) -> str:
    return f"(-(CAST(125.5 AS DOUBLE) - CAST({k} % 59 AS DOUBLE)))"


def _d(x: float) -> str:
    """Double literal parsed from text (exactly the Python float)."""
    return f"CAST('{x!r}' AS DOUBLE)"


def _terms(lat: str, lon: str, reduced: bool) -> dict[str, str]:
    b = f"atan({_d(1 - WGS84_F)} * tan(radians({lat})))" if reduced else f"radians({lat})"
    lo = f"radians({lon})"
    return {"sb": f"sin({b} / 2)", "cb": f"cos({b} / 2)", "cosb": f"cos({b})",
            "sl": f"sin({lo} / 2)", "cl": f"cos({lo} / 2)"}


def _pair(t1: dict[str, str], t2: dict[str, str]) -> tuple[str, str, str, str, str]:
    sq = f"({t2['sb']} * {t1['cb']} - {t2['cb']} * {t1['sb']})"
    cq = f"({t2['cb']} * {t1['cb']} + {t2['sb']} * {t1['sb']})"
    sdl = f"({t2['sl']} * {t1['cl']} - {t2['cl']} * {t1['sl']})"
    h = f"least(1.0, {sq} * {sq} + {t1['cosb']} * {t2['cosb']} * ({sdl} * {sdl}))"
    sp = f"({t1['sb']} * {t2['cb']} + {t1['cb']} * {t2['sb']})"
    cp = f"({t1['cb']} * {t2['cb']} - {t1['sb']} * {t2['sb']})"
    return h, sq, cq, sp, cp


def _lambert(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Lambert's formula, same algebra and evaluation order as geo.lambert_from_terms."""
    h, sq, cq, sp, cp = _pair(_terms(lat1, lon1, True), _terms(lat2, lon2, True))
    s = f"(2.0 * asin(sqrt({h})))"
    sin_s = f"(2.0 * sqrt({h} * (1.0 - {h})))"
    x = f"(({s} - {sin_s}) * ({sp} * {sp}) * ({cq} * {cq}) / NULLIF(1.0 - {h}, 0.0))"
    y = f"(({s} + {sin_s}) * ({cp} * {cp}) * ({sq} * {sq}) / NULLIF({h}, 0.0))"
    return f"(CASE WHEN {h} = 0 THEN 0.0 ELSE {_d(WGS84_A_KM)} * ({s} - {_d(WGS84_F / 2)} * ({x} + {y})) END)"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = _pair(_terms(lat1, lon1, False), _terms(lat2, lon2, False))[0]
    return f"({_d(MEAN_RADIUS_KM)} * (2.0 * asin(sqrt({h}))))"


FACT = """fact AS (
  SELECT o.o_orderkey, o.o_custkey, CAST(c.c_nationkey AS BIGINT) AS port,
         CAST(o.o_orderdate AS DATE) AS entry_date,
         year(o.o_orderdate) AS entry_year, month(o.o_orderdate) AS entry_month
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

PORT = """port AS (
  SELECT CAST(n_nationkey AS BIGINT) AS i94port_code, lower(n_name) AS city,
         CAST(n_regionkey AS BIGINT) AS state_code FROM nation)"""


def _temp(where: str = "") -> str:
    return f"""temp AS (
  SELECT lower(n.n_name) AS city, CAST(n.n_regionkey AS BIGINT) AS state_id, month(l.l_shipdate) AS month,
         avg(l.l_quantity) AS average_temperature, count(l.l_quantity) AS n_samples
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  {where}
  GROUP BY 1, 2, 3)"""


def _analytical_from(fact: str, port: str, temp: str, port_col: str, port_key: str) -> str:
    """Row-grain join of fact x port x temperature, then count and rank (the reference order)."""
    return f"""joined AS (
  SELECT f.{port_col} AS port, p.city, p.state_code, t.average_temperature, f.entry_year, f.entry_month
  FROM {fact} f JOIN {port} p ON f.{port_col} = p.{port_key}
  JOIN {temp} t ON p.city = lower(t.city) AND p.state_code = t.state_id AND f.entry_month = t.month),
grouped AS (
  SELECT port, city, state_code, average_temperature, entry_year, entry_month, count(*) AS cnt
  FROM joined GROUP BY ALL),
analytical AS (
  SELECT port AS i94port_city_code, city, state_code, average_temperature, entry_year, entry_month, cnt,
         row_number() OVER (PARTITION BY entry_year, entry_month ORDER BY cnt DESC, port) AS rnk
  FROM grouped)"""


ANALYTICAL = f"WITH {FACT}, {PORT}, {_temp()}, {_analytical_from('fact', 'port', 'temp', 'port', 'i94port_code')}"

ANALYTICAL_SELECT = """SELECT CAST(i94port_city_code AS BIGINT) AS i94port_city_code, city,
  CAST(state_code AS BIGINT) AS state_code, round(average_temperature, 6) AS average_temperature,
  CAST(entry_year AS BIGINT) AS entry_year, CAST(entry_month AS BIGINT) AS entry_month,
  CAST(cnt AS BIGINT) AS "count", CAST(rnk AS BIGINT) AS "rank" FROM analytical"""


def _climate(where: str) -> str:
    return f"""SELECT n.n_name AS city, CAST(n.n_regionkey AS BIGINT) AS state_id,
  CAST(month(l.l_shipdate) AS BIGINT) AS month, round(avg(l.l_quantity), 6) AS average_temperature,
  CAST(count(l.l_quantity) AS BIGINT) AS n_samples
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE {where}
GROUP BY 1, 2, 3"""


MONTHS = range(1, 13)
MATRIX = f"""{ANALYTICAL},
matrix AS (
  SELECT CAST(i94port_city_code AS BIGINT) AS i94port_city_code, city, CAST(state_code AS BIGINT) AS state_code,
         CAST(entry_year AS BIGINT) AS entry_year,
         {", ".join(f"max(CASE WHEN entry_month = {m} THEN round(average_temperature, 6) END) AS average_temperature_{m:02d}" for m in MONTHS)},
         {", ".join(f"CAST(sum(CASE WHEN entry_month = {m} THEN cnt END) AS BIGINT) AS count_{m:02d}" for m in MONTHS)}
  FROM analytical GROUP BY 1, 2, 3, 4
  HAVING {" AND ".join(f"average_temperature_{m:02d} IS NOT NULL AND count_{m:02d} IS NOT NULL" for m in MONTHS)})"""

SERIES = f"""{MATRIX},
series AS (
  SELECT CAST(a.i94port_city_code AS BIGINT) AS i94port_city_code, a.city, CAST(a.state_code AS BIGINT) AS state_code,
         CAST(a.entry_year AS BIGINT) AS entry_year, CAST(a.entry_month AS BIGINT) AS entry_month,
         round(a.average_temperature, 6) AS average_temperature, CAST(a.cnt AS BIGINT) AS "count"
  FROM analytical a JOIN matrix m
    ON a.i94port_city_code = m.i94port_city_code AND a.city = m.city AND a.state_code = m.state_code
   AND a.entry_year = m.entry_year)"""


def _nation_region() -> str:
    return """nr AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _parse(cs: str) -> tuple[str, str]:
    """(city, state_code) SQL of ``jobs.parse_city_state`` for the text expression ``cs``."""
    city0 = f"regexp_replace(regexp_extract(regexp_replace(trim({cs}), '\\s+', ' ', 'g'), '^(.*) \\S+$', 1), ',$', '')"
    state0 = f"string_split_regex(trim({cs}), '\\s+')[-1]"
    pos = f"instr({city0}, ', ')"
    tail = f"substr({city0}, {pos} + 2)"
    state2 = f"(CASE WHEN {pos} > 0 AND length({tail}) = 2 THEN {tail} END)"
    use2 = f"({state0} IN ('(BPS)', '#ARPT') AND length({state2}) = 2)"
    city = f"(CASE WHEN {use2} THEN split_part({city0}, ', ', 1) ELSE {city0} END)"
    state = f"(CASE WHEN {use2} THEN {state2} ELSE {state0} END)"
    return city, state


def _after_dash(x: str) -> str:
    return f"(CASE WHEN contains({x}, ' - ') THEN string_split({x}, ' - ')[2] ELSE {x} END)"


def _port_dim_ctes() -> str:
    st = "upper(substr(r_name, 1, 2))"
    body = f"""CASE n_regionkey WHEN 0 THEN n_name || ', ' || {st}
             WHEN 1 THEN n_name || ', ' || {st} || ' (BPS)'
             WHEN 2 THEN 'X - ' || n_name || ', ' || {st}
             WHEN 3 THEN 'Collapsed ' || n_name
             ELSE n_name || ', MX' END"""
    city, state = _parse("cs")
    return f"""{_nation_region()},
book AS (SELECT 'P' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, {body} AS cs FROM nr),
book_kept AS (SELECT code, cs FROM book WHERE NOT (starts_with(cs, 'No PORT Code') OR starts_with(cs, 'Collapsed'))),
parsed AS (SELECT code, {city} AS city, {state} AS state_code FROM book_kept),
ports AS (
  SELECT DISTINCT q.i94port_code, q.city, q.state_code, r.r_name AS state_name
  FROM (SELECT code AS i94port_code, {_after_dash('city')} AS city, state_code FROM parsed
        WHERE length(state_code) = 2 AND state_code NOT IN ('MX')) q
  JOIN region r ON q.state_code = upper(substr(r.r_name, 1, 2)))"""


def _airport_ctes() -> str:
    return f"""{_port_dim_ctes()},
air AS (
  SELECT s.s_name AS ident, CASE WHEN s.s_acctbal > 0 THEN 'large_airport' ELSE 'small_airport' END AS type,
         CASE WHEN s.s_suppkey % 3 = 0 THEN 'International ' || s.s_name ELSE 'Field ' || s.s_name END AS name,
         CASE WHEN s.s_acctbal > 5000 THEN NULL ELSE CAST(CAST(floor(s.s_acctbal) AS BIGINT) AS VARCHAR) END AS elevation_ft,
         lower(n.n_name) AS municipality, upper(substr(n.r_name, 1, 2)) AS state_code,
         CASE WHEN s.s_nationkey = 0 THEN 0.0 ELSE CAST(-125 + s.s_suppkey % 59 AS DOUBLE) END AS longitude,
         CASE WHEN s.s_nationkey = 0 THEN 0.0 ELSE CAST(24 + s.s_suppkey % 26 AS DOUBLE) END AS latitude
  FROM supplier s JOIN nr n ON s.s_nationkey = n.n_nationkey),
air_port AS (
  SELECT a.ident, a.type, a.name, p.i94port_code, a.state_code, lower(p.city) AS city,
         COALESCE(TRY_CAST(a.elevation_ft AS DOUBLE), 13.12) AS elevation_ft,
         CASE WHEN a.longitude = 0 THEN -73.778889 ELSE a.longitude END AS longitude,
         CASE WHEN a.latitude = 0 THEN 40.639722 ELSE a.latitude END AS latitude
  FROM air a JOIN ports p ON a.municipality = lower(p.city) AND a.state_code = p.state_code
  WHERE a.type = 'large_airport'
    AND (contains(a.name, 'International') OR a.ident IN ('Supplier#000000001', 'Supplier#000000002'))
    AND a.ident NOT IN ('Supplier#000000003')),
air_dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ident ORDER BY i94port_code) AS rn FROM air_port)
  WHERE rn = 1)"""


def _city_temp_ctes() -> str:
    dist = _lambert("g.lat", "g.lng", "c.latitude", "c.longitude")
    return f"""clim AS (
  SELECT n.n_name AS city, month(l.l_shipdate) AS month, avg(l.l_quantity) AS average_temperature,
         {_lat('n.n_nationkey')} AS latitude, {_lon('n.n_nationkey')} AS longitude
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nr n ON s.s_nationkey = n.n_nationkey
  WHERE n.n_regionkey <> 4 AND l.l_shipdate >= TIMESTAMP '1996-09-01' AND l.l_shipdate < TIMESTAMP '2000-09-01'
  GROUP BY n.n_name, month(l.l_shipdate), n.n_nationkey),
gaz AS (
  SELECT DISTINCT n.n_name AS city, upper(substr(n.r_name, 1, 2)) AS state_id, n.r_name AS state_name,
         {_lat('n.n_nationkey')} + CAST(c.c_custkey % 5 AS DOUBLE) * 0.5 AS lat, {_lon('n.n_nationkey')} AS lng
  FROM customer c JOIN nr n ON c.c_nationkey = n.n_nationkey),
city_temp AS (
  SELECT DISTINCT city, month, average_temperature, state_id, state_name, lat, lng FROM (
    SELECT g.city, c.month, c.average_temperature, g.state_id, g.state_name, g.lat, g.lng, {dist} AS d
    FROM gaz g JOIN clim c ON g.city = c.city) WHERE d < 180)"""


def _sas(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} = 0 THEN NULL ELSE DATE '1960-01-01' + CAST(floor({x}) AS INTEGER) END)"


def _stay(status: str, d: str) -> str:
    shifted = f"({d} + INTERVAL 252 MONTH)"
    return (f"(CASE WHEN {status} = 'O' THEN 'D/S' WHEN {status} = 'F' THEN strftime({shifted}, '%m%d%Y')"
            f" ELSE strftime({shifted}, '%d%m%Y') END)")


FACT_COLS = ["cicid", "admission_number", "i94port_city_code", "destination_state_code", "allow_to_stay_date",
             "airline_code", "flight_number", "visa_type", "arrival_date", "departure_date", "add_to_file_date",
             "entry_year", "entry_month", "citizenship_of_country_id", "resident_of_country_id",
             "visa_category_id", "entry_mode_id", "age"]


def _fact_clean_ctes() -> str:
    return f"""raw AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, c.c_nationkey, c.c_mktsegment,
         CAST(o.o_orderdate AS DATE) AS od
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
raw2 AS (
  SELECT *, CAST(date_diff('day', DATE '1960-01-01', od) AS DOUBLE) AS arr, {_stay('o_orderstatus', 'od')} AS dtaddto,
         strftime(od, '%Y%m%d') AS dtadfile FROM raw),
kept AS (
  SELECT * FROM raw2 WHERE dtaddto IS NOT NULL AND dtaddto <> '' AND COALESCE(regexp_matches(dtaddto, '{STRICT}'), false)
    AND dtadfile IS NOT NULL),
fact0 AS (
  SELECT CAST(o_orderkey AS BIGINT) AS cicid, CAST(o_orderkey * 100000 + o_custkey AS BIGINT) AS admission_number,
         'P' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS i94port_city_code, c_mktsegment AS destination_state_code,
         dtaddto AS allow_to_stay_date, 'AL' || substr(o_orderpriority, 1, 1) AS airline_code,
         CAST(o_custkey AS VARCHAR) AS flight_number, CASE WHEN o_orderstatus = 'F' THEN 'F1' ELSE 'B2' END AS visa_type,
         {_sas('arr')} AS arrival_date,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {_sas('arr + 10')} END AS departure_date,
         CAST(try_strptime(dtadfile, '%Y%m%d') AS DATE) AS add_to_file_date,
         CAST(year(od) AS BIGINT) AS entry_year, CAST(month(od) AS BIGINT) AS entry_month,
         CAST(c_nationkey AS BIGINT) AS citizenship_of_country_id, CAST(c_nationkey + 100 AS BIGINT) AS resident_of_country_id,
         CAST(2 AS BIGINT) AS visa_category_id, CAST(1 AS BIGINT) AS entry_mode_id,
         CAST(o_custkey % 80 + 18 AS BIGINT) AS age
  FROM kept),
fact_clean AS (SELECT * FROM fact0 WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FACT_COLS)})"""


NULL_AUDIT_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
PROFILE_KEYS = ["n_name", "c_mktsegment", "o_orderstatus", "o_orderpriority"]

_hemi_lat = "(n_nationkey * 7) % 120 - 60"
_hemi_lon = "(n_nationkey * 13) % 340 - 170"


def _strict_hemi(x: str, pos: str, neg: str) -> str:
    body = f"left({x}, length({x}) - 1)"
    return (f"round(TRY_CAST(CASE WHEN suffix({x}, '{pos}') THEN {body} WHEN suffix({x}, '{neg}') THEN '-' || {body} END"
            f" AS DOUBLE), 6)")


def _lenient_hemi(x: str, pos: str, neg: str) -> str:
    body = f"left({x}, length({x}) - 1)"
    sfx = f"upper(right({x}, 1))"
    return (f"round(TRY_CAST(CASE WHEN {sfx} = '{pos}' THEN {body} WHEN {sfx} = '{neg}' THEN '-' || {body}"
            f" ELSE {x} END AS DOUBLE), 6)")


_city_split, _state_split = _parse("city_state")
_reparse_city, _reparse_state = _parse("city_state")

ORACLE_SQL: dict[str, str] = {
    "analytical_table": f"{ANALYTICAL} {ANALYTICAL_SELECT}",
    "climatology": _climate("l.l_shipdate >= TIMESTAMP '1996-09-01' AND l.l_shipdate < TIMESTAMP '2000-09-01'"),
    "recent_window_mean": _climate("l.l_shipdate > TIMESTAMP '1999-09-01'"),
    "month_matrix": f"{MATRIX} SELECT * FROM matrix",
    "matrix_to_series": f"{SERIES} SELECT * FROM series",
    "port_regression": f"""{SERIES},
fit AS (SELECT i94port_city_code, count(*) AS n, avg(average_temperature) AS mx, avg(CAST("count" AS DOUBLE)) AS my,
               var_pop(average_temperature) AS vx, var_pop(CAST("count" AS DOUBLE)) AS vy,
               covar_pop(average_temperature, CAST("count" AS DOUBLE)) AS cxy
        FROM series GROUP BY 1)
SELECT i94port_city_code, CAST(n AS BIGINT) AS n_points,
       round(cxy / NULLIF(vx, 0.0), 6) AS slope,
       round(my - cxy / NULLIF(vx, 0.0) * mx, 6) AS intercept,
       round(cxy * cxy / (NULLIF(vx, 0.0) * NULLIF(vy, 0.0)), 6) AS r2,
       round(cxy / sqrt(NULLIF(vx, 0.0) * NULLIF(vy, 0.0)), 6) AS corr
FROM fit""",
    "geo_join": f"""WITH c AS (SELECT c_custkey, c_nationkey AS nation, {_lat('c_custkey')} AS lat, {_lon('c_custkey')} AS lon FROM customer),
s AS (SELECT s_suppkey, s_nationkey AS nation, {_lat('s_suppkey')} AS lat, {_lon('s_suppkey')} AS lon FROM supplier),
p AS (SELECT c.c_custkey, s.s_suppkey, c.nation, {_lambert('c.lat', 'c.lon', 's.lat', 's.lon')} AS d
      FROM c JOIN s ON c.nation = s.nation)
SELECT c_custkey, CAST(nation AS BIGINT) AS nationkey, count(*) AS n_suppliers, round(min(d), 6) AS nearest_km,
       round(max(d), 6) AS farthest_km
FROM p WHERE d < 180 GROUP BY c_custkey, nation""",
    "geo_distance_haversine": f"""WITH c AS (SELECT c_custkey, c_nationkey, {_lat('c_custkey')} AS lat, {_lon('c_custkey')} AS lon FROM customer),
n AS (SELECT n_nationkey, {_lat('n_nationkey')} AS lat, {_lon('n_nationkey')} AS lon FROM nation)
SELECT CAST(c.c_custkey AS BIGINT) AS c_custkey, CAST(n.n_nationkey AS BIGINT) AS n_nationkey,
       round({_haversine('c.lat', 'c.lon', 'n.lat', 'n.lon')}, 6) AS distance_km
FROM c JOIN n ON c.c_nationkey = n.n_nationkey""",
    "hemisphere_parse": f"""WITH t AS (SELECT n_nationkey, n_regionkey, {_hemi_lat} AS lat_i, {_hemi_lon} AS lon_i
      FROM (SELECT c_custkey AS n_nationkey, c_nationkey % 5 AS n_regionkey FROM customer)),
u AS (SELECT n_nationkey,
        CAST(abs(lat_i) AS VARCHAR) || '.5' || CASE WHEN lat_i >= 0 THEN 'N' ELSE 'S' END AS lat_text,
        CASE WHEN n_regionkey = 3 THEN CAST(abs(lon_i) AS VARCHAR) || '.25' || lower(CASE WHEN lon_i >= 0 THEN 'E' ELSE 'W' END)
             WHEN n_regionkey = 4 THEN CAST(abs(lon_i) AS VARCHAR) || '.25'
             ELSE CAST(abs(lon_i) AS VARCHAR) || '.25' || CASE WHEN lon_i >= 0 THEN 'E' ELSE 'W' END END AS lon_text
      FROM t)
SELECT CAST(n_nationkey AS BIGINT) AS c_custkey, lat_text, lon_text,
       {_strict_hemi('lat_text', 'N', 'S')} AS latitude, {_strict_hemi('lon_text', 'E', 'W')} AS longitude,
       {_lenient_hemi('lower(lat_text)', 'N', 'S')} AS latitude_ci, {_lenient_hemi('lon_text', 'E', 'W')} AS longitude_ci
FROM u""",
    "coordinate_split": """WITH t AS (SELECT n_nationkey,
    CASE WHEN n_regionkey = 3 THEN '0, 0'
         WHEN n_regionkey = 4 THEN CAST(-125 + n_nationkey % 59 AS VARCHAR) || '.5' || ' ' || CAST(24 + n_nationkey % 26 AS VARCHAR) || '.5'
         ELSE CAST(-125 + n_nationkey % 59 AS VARCHAR) || '.5, ' || CAST(24 + n_nationkey % 26 AS VARCHAR) || '.5' END AS coordinates
  FROM (SELECT c_custkey AS n_nationkey, c_nationkey % 5 AS n_regionkey FROM customer))
SELECT CAST(n_nationkey AS BIGINT) AS c_custkey, coordinates,
       round(TRY_CAST(trim(string_split(coordinates, ',')[1]) AS DOUBLE), 6) AS longitude,
       round(TRY_CAST(trim(string_split(coordinates, ',')[2]) AS DOUBLE), 6) AS latitude
FROM t""",
    "fill_and_replace": f"""WITH t AS (SELECT c_custkey,
    CASE WHEN c_nationkey = 0 THEN CAST(0.0 AS DOUBLE) ELSE {_lon('c_custkey')} END AS lon,
    CASE WHEN c_nationkey = 0 THEN CAST(0.0 AS DOUBLE) ELSE {_lat('c_custkey')} END AS lat,
    COALESCE(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, CAST(13.12 AS DOUBLE)) AS elev
  FROM customer)
SELECT c_custkey, round(CASE WHEN lon = 0 THEN CAST(-73.778889 AS DOUBLE) ELSE lon END, 6) AS longitude,
       round(CASE WHEN lat = 0 THEN CAST(40.639722 AS DOUBLE) ELSE lat END, 6) AS latitude,
       round(elev, 6) AS elevation_ft
FROM t""",
    "city_state_split": f"""WITH t AS (SELECT p_partkey, upper(p_name) || ', ' || upper(substr(p_type, 1, 2)) || '  ' AS city_state FROM part),
u AS (SELECT p_partkey, city_state,
        regexp_extract(regexp_replace(trim(city_state), '\\s+', ' ', 'g'), '^(.*) \\S+$', 1) AS city,
        string_split_regex(trim(city_state), '\\s+')[-1] AS state FROM t)
SELECT p_partkey, city_state, city, state, CASE WHEN city = '' THEN '' ELSE city || ' ' END AS city_with_space FROM u""",
    "city_state_reparse": f"""WITH t AS (SELECT p_partkey, upper(p_name) || ', ' || upper(substr(p_type, 1, 2))
      || CASE p_type WHEN 'PROMO' THEN ' (BPS)' WHEN 'LARGE' THEN ' #ARPT' ELSE '' END AS city_state FROM part)
SELECT p_partkey, city_state, {_reparse_city} AS city, {_reparse_state} AS state_code FROM t""",
    "trim_suffix": f"""WITH t AS (SELECT p_partkey,
    '''' || p_name || ''' ' AS quoted,
    CASE WHEN p_size > 25 THEN p_brand || ' - ' || p_name ELSE p_name END AS dashed,
    p_name || CASE WHEN p_size % 2 = 0 THEN ',' ELSE ' ' END AS ended,
    ' ' || p_name AS lead
  FROM part)
SELECT p_partkey, trim(replace(quoted, '''', '')) AS unquoted, {_after_dash('dashed')} AS after_dash,
       regexp_replace(ended, ',$', '') AS no_comma, regexp_replace(ended, '[, ]$', '') AS no_comma_space,
       substr(lead, 2) AS no_lead
FROM t""",
    "substr_codes": """SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS mode_code,
       substr(o_orderpriority, 3, length(o_orderpriority) - 3) AS mode_name,
       right(o_orderpriority, 2) AS last_two, lower(o_orderstatus) AS status
FROM orders""",
    "sas_date_roundtrip": f"""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN CAST(0.0 AS DOUBLE)
    ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) + 0.5 END AS sas_day FROM orders)
SELECT o_orderkey, sas_day, {_sas('sas_day')} AS arrival_date FROM t""",
    "compact_date_parse": """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END AS compact FROM orders)
SELECT o_orderkey, compact, CAST(try_strptime(compact, '%Y%m%d') AS DATE) AS add_to_file_date,
       strftime(CAST(try_strptime(compact, '%Y%m%d') AS DATE), '%Y-%m-%d') AS iso_text
FROM t""",
    "stay_date_normalise": f"""WITH t AS (SELECT o_orderkey, {_stay('o_orderstatus', 'CAST(o_orderdate AS DATE)')} AS dtaddto FROM orders)
SELECT o_orderkey, dtaddto,
       CASE WHEN dtaddto = 'D/S' THEN 'D/S'
            WHEN strftime(try_strptime(dtaddto, '%m%d%Y'), '%m%d%Y') = dtaddto
            THEN strftime(try_strptime(dtaddto, '%m%d%Y'), '%Y-%m-%d') END AS allow_to_stay,
       COALESCE(regexp_matches(dtaddto, '{STRICT}'), false) AS pattern_ok
FROM t""",
    "month_token": """SELECT lower(strftime(o_orderdate, '%b%y')) AS month_token, strftime(o_orderdate, '%Y-%m') AS year_month,
       count(*) AS "count"
FROM orders GROUP BY 1, 2""",
    "bulk_cast": """SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supp_key,
       CAST(l_linenumber AS BIGINT) AS line_number, TRY_CAST(l_quantity AS BIGINT) AS quantity,
       l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax, l_returnflag AS return_flag,
       l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem""",
    "regex_filter": f"""WITH t AS (SELECT o_orderstatus, {_stay('o_orderstatus', 'CAST(o_orderdate AS DATE)')} AS dtaddto FROM orders),
u AS (SELECT o_orderstatus, COALESCE(regexp_matches(dtaddto, '{STRICT}'), false) AS ok,
             COALESCE(regexp_matches(dtaddto, '{LOOSE}'), false) AS loose FROM t)
SELECT o_orderstatus, count(*) AS n_rows, CAST(count_if(ok) AS BIGINT) AS n_kept,
       CAST(count_if(NOT ok) AS BIGINT) AS n_rejected, CAST(count_if(loose) AS BIGINT) AS n_kept_loose
FROM u GROUP BY 1""",
    "prefix_exclude": """WITH t AS (SELECT c_custkey,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'No PORT Code (' || CAST(c_custkey AS VARCHAR) || ')'
         WHEN c_mktsegment = 'FURNITURE' THEN 'Collapsed (' || c_name || ')'
         ELSE c_name || ', ' || CASE WHEN c_nationkey = 0 THEN 'MX' ELSE 'US' END END AS city_state
  FROM customer)
SELECT c_custkey, city_state FROM t
WHERE NOT (starts_with(city_state, 'No PORT Code') OR starts_with(city_state, 'Collapsed'))
  AND right(city_state, 2) NOT IN ('MX')""",
    "contains_any_exclude": """SELECT p_partkey, p_name, contains(p_name, 'gear') AS has_gear FROM part
WHERE NOT (contains(p_name, 'ring') OR contains(p_name, 'bolt'))""",
    "allow_deny_list": """WITH k AS (SELECT p_brand, p_type, p_partkey, p_name FROM part
  WHERE COALESCE(contains(p_name, 'gear') OR p_brand IN ('Brand#1', 'Brand#2'), false)
    AND NOT COALESCE(p_type IN ('PROMO'), false))
SELECT p_brand, p_type, p_partkey, p_name FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey, p_name) AS rn FROM k) WHERE rn = 1""",
    "length_branches": """WITH t AS (SELECT p_partkey, string_split_regex(trim(p_name), '\\s+')[-1] AS tok FROM part)
SELECT p_partkey, CASE WHEN length(tok) = 4 THEN tok ELSE upper(tok) END AS token,
       CASE WHEN length(tok) = 4 THEN 'a' ELSE 'b' END AS branch FROM t""",
    "drop_null_rows": """WITH li AS (SELECT year(l_shipdate) AS ship_year, NULLIF(l_returnflag, 'R') AS flag,
    NULLIF(l_discount, CAST(0.0 AS DOUBLE)) AS disc, CASE WHEN l_linestatus = 'O' THEN '' ELSE l_linestatus END AS status
  FROM lineitem)
SELECT CAST(ship_year AS BIGINT) AS ship_year, count(*) AS n_rows, CAST(count_if(flag IS NULL) AS BIGINT) AS n_null_flag,
       CAST(count_if(flag IS NOT NULL AND disc IS NOT NULL AND status IS NOT NULL AND status <> '') AS BIGINT) AS n_kept
FROM li GROUP BY 1""",
    "dropped_rows": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag AS flag, l_discount AS disc,
       l_linestatus AS status
FROM lineitem WHERE l_returnflag <> 'R' AND l_discount <> 0 AND l_linestatus <> 'O' AND l_linestatus <> ''""",
    "two_key_join": """SELECT c.c_custkey, s.s_suppkey, CAST(c.c_nationkey AS BIGINT) AS nationkey,
       lower(regexp_extract(c.c_name, '#(\\d+)$', 1)) AS name_number
FROM customer c JOIN supplier s
  ON lower(regexp_extract(c.c_name, '#(\\d+)$', 1)) = lower(regexp_extract(s.s_name, '#(\\d+)$', 1))
 AND c.c_nationkey = s.s_nationkey""",
    "role_lookup": """SELECT cn.n_name AS cust_nation, sn.n_name AS supp_nation, count(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
GROUP BY 1, 2""",
    "code_lookup": """SELECT c.c_custkey, n.n_name, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "unmatched_codes": """SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "unmatched_states": """WITH codes AS (SELECT DISTINCT CASE WHEN p_size > 25 THEN upper(substr(p_type, 1, 2))
    ELSE ['AF', 'AM', 'AS', 'NO', 'ZZ'][p_size % 5 + 1] END AS state_code FROM part)
SELECT state_code FROM codes WHERE state_code NOT IN (SELECT upper(substr(r_name, 1, 2)) FROM region)""",
    "join_recovery": f"""WITH {FACT}, {PORT},
{_temp("WHERE n.n_regionkey <> 4 AND NOT (n.n_regionkey = 3 AND month(l.l_shipdate) % 2 = 0)")},
fp AS (SELECT f.entry_month, p.city, p.state_code FROM fact f JOIN port p ON f.port = p.i94port_code),
m AS (SELECT EXISTS (SELECT 1 FROM temp t WHERE t.city = fp.city AND t.state_id = fp.state_code AND t.month = fp.entry_month) AS hit FROM fp)
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if(hit) AS BIGINT) AS n_recovered,
       round(count_if(hit) / count(*), 6) AS recovery FROM m""",
    "null_audit": "WITH li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                  "NULLIF(l_discount, CAST(0.0 AS DOUBLE)) AS l_discount, NULLIF(l_tax, CAST(0.0 AS DOUBLE)) AS l_tax, "
                  "NULLIF(l_returnflag, 'R') AS l_returnflag, NULLIF(l_linestatus, 'O') AS l_linestatus, l_shipdate "
                  "FROM lineitem) "
                  + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM li"
                                       for c in NULL_AUDIT_COLS),
    "distinct_rows": "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer",
    "dedup_by_key": """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
WHERE rn = 1""",
    "value_profile": """SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       round(count(*) / (SELECT count(*) FROM events), 6) AS share, CAST(count_if(value > 10) AS BIGINT) AS n_high
FROM events GROUP BY 1""",
    "top_n": """WITH c AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1),
t AS (SELECT o_custkey, n_orders, row_number() OVER (ORDER BY n_orders DESC, o_custkey) AS rnk FROM c)
SELECT cu.c_custkey, cu.c_name, t.n_orders, CAST(t.rnk AS BIGINT) AS "rank"
FROM t JOIN customer cu ON t.o_custkey = cu.c_custkey WHERE t.rnk <= 25""",
    "top_n_share": f"""WITH {FACT},
g AS (SELECT n.n_name, count(*) AS cnt FROM fact f JOIN nation n ON f.port = n.n_nationkey GROUP BY 1),
r AS (SELECT n_name, cnt, row_number() OVER (ORDER BY cnt DESC, n_name) AS rnk FROM g)
SELECT n_name, CAST(cnt AS BIGINT) AS "count", CAST(rnk AS BIGINT) AS "rank",
       round((SELECT sum(cnt) FROM r WHERE rnk <= 10) / (SELECT sum(cnt) FROM g), 6) AS top_share
FROM r WHERE rnk <= 10""",
    "category_share": """SELECT o_orderstatus, count(*) AS n_rows, CAST(count_if(o_orderpriority = '1-URGENT') AS BIGINT) AS n_token,
       round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END), 6) AS token_share
FROM orders GROUP BY 1""",
    "demographics_mean": """SELECT n.n_name, c.c_mktsegment, round(avg(c.c_custkey), 6) AS avg_c_custkey,
       round(avg(c.c_acctbal), 6) AS avg_c_acctbal, count(*) AS n_customers
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2""",
    "missing_departure_profile": """SELECT CAST(c.c_nationkey AS BIGINT) AS c_nationkey, count(*) AS n_no_departure
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'O' GROUP BY 1""",
    "keyed_override": """SELECT CAST(c.c_custkey AS BIGINT) AS c_custkey, COALESCE(s.s_name, c.c_name) AS c_name,
       CAST(c.c_nationkey AS BIGINT) AS c_nationkey
FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""",
    "quality_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) >= 1 AS passed FROM {t}" for t in ALL_TABLES),
    "port_dimension": f"WITH {_port_dim_ctes()} SELECT i94port_code, city, state_code, state_name FROM ports",
    "fact_clean": f"WITH {_fact_clean_ctes()} SELECT {', '.join(FACT_COLS)} FROM fact_clean",
    "retention_audit": f"""WITH {_fact_clean_ctes()}
SELECT (SELECT count(*) FROM raw) AS n_in, (SELECT count(*) FROM fact_clean) AS n_out,
       round((SELECT count(*) FROM fact_clean) / (SELECT count(*) FROM raw), 6) AS retention""",
    "missing_histogram": """WITH t AS (SELECT CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS dep
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT dep IS NULL AS is_null, count(*) AS n_rows,
       CAST(count(DISTINCT dep) + max(CASE WHEN dep IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct
FROM t GROUP BY 1""",
    "airport_port_join": f"""WITH {_airport_ctes()}
SELECT ident AS airport_id, type AS airport_type, name AS airport_name, i94port_code, state_code,
       round(elevation_ft, 6) AS elevation_ft, round(longitude, 6) AS airport_longitude,
       round(latitude, 6) AS airport_latitude
FROM air_dedup""",
    "city_temperature_dim": f"""WITH {_nation_region()}, {_city_temp_ctes()}
SELECT city, CAST(month AS BIGINT) AS month, round(average_temperature, 6) AS average_temperature, state_id, state_name,
       round(lat, 6) AS lat, round(lng, 6) AS lng
FROM city_temp""",
    "entity_profiles": """WITH j AS (SELECT n.n_name, c.c_mktsegment, o.o_orderstatus, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
u AS (""" + " UNION ALL ".join(
        f"SELECT '{k}' AS dimension, CAST({k} AS VARCHAR) AS value, count(*) AS cnt FROM j GROUP BY 2"
        for k in PROFILE_KEYS) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY cnt DESC, value) AS rnk FROM u)
SELECT dimension, value, CAST(cnt AS BIGINT) AS "count", CAST(rnk AS BIGINT) AS "rank" FROM r WHERE rnk <= 20""",
    "us_cities": f"""WITH {_nation_region()}, {_city_temp_ctes()}
SELECT DISTINCT city, state_id, state_name, round(lat, 6) AS latitude, round(lng, 6) AS longitude FROM city_temp""",
    "airport_concentration": """WITH j AS (
  SELECT CAST(c.c_nationkey AS VARCHAR) AS port, c.c_mktsegment AS state
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON s.s_nationkey = c.c_nationkey),
u AS (SELECT 'port' AS dimension, port AS value, count(*) AS cnt FROM j GROUP BY port
      UNION ALL SELECT 'state', state, count(*) FROM j GROUP BY state),
r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY cnt DESC, value) AS rnk,
             sum(cnt) OVER (PARTITION BY dimension) AS total FROM u)
SELECT dimension, value, CAST(cnt AS BIGINT) AS "count", CAST(rnk AS BIGINT) AS "rank",
       round(sum(cnt) OVER (PARTITION BY dimension) / total, 6) AS top_share
FROM r WHERE rnk <= 25""",
    "sorted_head": """SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(rn AS BIGINT) AS position FROM (
  SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 50""",
    "drifting_month_scan": """SELECT lower(strftime(o.o_orderdate, '%b%y')) AS month_token,
       CAST(year(o.o_orderdate) AS BIGINT) AS i94yr, CAST(month(o.o_orderdate) AS BIGINT) AS i94mon, count(*) AS n_rows,
       CAST(sum(o.o_orderkey) AS BIGINT) AS sum_cicid
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3""",
    "gate_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, count(*) >= 1 AS passed FROM {t}"
        for n, t in (("customer.csv", "customer"), ("orders", "orders"), ("supplier", "supplier"))),
    "csv_roundtrip": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "delimited_scan": " UNION ALL ".join(
        f"SELECT '{f}' AS fmt, CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM supplier"
        for f in ("tab_eq_tab", "eq", "semicolon")),
    "partitioned_roundtrip": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
       o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS entry_year, CAST(month(o_orderdate) AS BIGINT) AS entry_month
FROM orders""",
    "multi_file_month_scan": f"""{ANALYTICAL}
SELECT strftime(make_date(CAST(entry_year AS INTEGER), CAST(entry_month AS INTEGER), 1), '%Y-%m') AS year_month,
       CAST(row_number() OVER (PARTITION BY entry_year, entry_month ORDER BY cnt DESC, i94port_city_code) - 1 AS BIGINT)
           AS index,
       CAST(i94port_city_code AS BIGINT) AS i94port_city_code, CAST(entry_month AS BIGINT) AS entry_month,
       CAST(cnt AS BIGINT) AS "count", CAST(rnk AS BIGINT) AS "rank"
FROM analytical""",
    "incremental_month_load": """SELECT CAST(year(o_orderdate) AS BIGINT) AS entry_year, CAST(month(o_orderdate) AS BIGINT) AS entry_month,
       count(*) AS n_rows
FROM orders GROUP BY 1, 2""",
    "json_stage_load": """SELECT event_type, count(*) AS n_rows, round(sum(value), 6) AS total_value, count(DISTINCT user_id) AS n_users,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM events GROUP BY 1""",
    "insert_fact": """SELECT CAST(c.c_nationkey AS BIGINT) AS port, CAST(year(o.o_orderdate) AS BIGINT) AS entry_year,
       CAST(month(o.o_orderdate) AS BIGINT) AS entry_month, count(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3""",
    "insert_dimension": """SELECT CAST(s.s_suppkey AS BIGINT) AS s_suppkey, s.s_name, n.n_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "ordered_month_export": """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, row_number() OVER (
       PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_totalprice DESC, o_orderkey) - 1 AS index, o_orderkey
FROM orders""",
    "quarantined_scan": """SELECT CASE o_orderkey % 10 WHEN 0 THEN 'value' WHEN 1 THEN 'fields' ELSE 'good' END AS kind,
       count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_orderkey FROM orders GROUP BY 1""",
    "distinct_sketch": """SELECT CAST(year(o_orderdate) AS BIGINT) AS entry_year, count(DISTINCT o_custkey) AS n_customers,
       true AS within FROM orders GROUP BY 1""",
    "sliced_load": " UNION ALL ".join(
        f"""SELECT '{grain}' AS grain, strftime(ts, '{form}') AS slice, count(*) AS n_rows,
       CAST(sum(event_id) AS BIGINT) AS sum_event_id, bool_or(event_id % 7 = 0) AS replaced
FROM events GROUP BY strftime(ts, '{form}')""" for grain, form in (("month", "%Y-%m"), ("day", "%Y-%m-%d"))),
    "observed_fact_load": f"""WITH {_fact_clean_ctes()}
SELECT (SELECT count(*) FROM raw) AS n_in, count(*) AS n_out, count(*) FILTER (WHERE visa_type = 'F1') AS n_f1,
       round(count(*) / (SELECT count(*) FROM raw), 6) AS retention FROM fact_clean""",
    "file_row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ALL_TABLES),
    "published_release": f"""WITH {_fact_clean_ctes()}
SELECT i94port_city_code, CAST(entry_year AS BIGINT) AS entry_year, count(*) AS n_rows, CAST(1 AS BIGINT) AS release
FROM fact_clean GROUP BY ALL""",
    "full_pipeline": f"""WITH {_airport_ctes()}, {_city_temp_ctes()}, {_fact_clean_ctes()},
ports2 AS (SELECT DISTINCT i94port_code, city, state_code FROM air_dedup),
temp2 AS (SELECT city, state_id, month, average_temperature FROM city_temp),
{_analytical_from('fact_clean', 'ports2', 'temp2', 'i94port_city_code', 'i94port_code')}
SELECT i94port_city_code, city, state_code, round(average_temperature, 6) AS average_temperature,
       CAST(entry_year AS BIGINT) AS entry_year, CAST(entry_month AS BIGINT) AS entry_month,
       CAST(cnt AS BIGINT) AS "count", CAST(rnk AS BIGINT) AS "rank"
FROM analytical""",
}
