"""Plain SQL counterparts of the queries, written by hand and run by another engine.

They share no text with the Spark side, so a wrong rule cannot agree with itself. Each query
names the relations it builds on; ``_with`` puts them in front in dependency order.
Sampling and model queries have no counterpart: their rows are not determined by SQL.
"""

from __future__ import annotations

_RELATIONS: dict[str, str] = {}

# Portable derivation of the raw requests from the order tables.
_RELATIONS["raw_requests"] = """
WITH sr_types(k, sr_type, sr_short_code) AS (SELECT * FROM (VALUES
    (0,'311 INFORMATION ONLY CALL','311IOC'),(1,'Aircraft Noise Complaint','AVN'),(2,'Graffiti Removal Request','GRAF'),
    (3,'Pothole in Street Complaint','PHF'),(4,'Street Light Out Complaint','SFD'),(5,'Rodent Baiting/Rat Complaint','SGA'),
    (6,'Garbage Cart Maintenance','SIE'),(7,'Abandoned Vehicle Complaint','SKA'),(8,'Tree Emergency','SEL'),
    (9,'Water Lead Test Kit Request','AAE'),(10,'Building Violation','BBA'),(11,'Sanitation Code Violation','SCB'),
    (12,'Gas Leak Hazard',NULL),(13,' Pothole in Street Complaint ','PHF'),(14,'   ','UNKX'),(15,NULL,NULL)) v(a,b,c)),
depts(k, dept) AS (SELECT * FROM (VALUES
    (0,'CDOT - Department of Transportation'),(1,'Streets and Sanitation'),(2,'Aviation'),(3,'DOB - Buildings'),
    (4,'311 City Services'),(5,'DWM - Department of Water Management'),(6,'Health'),(7,'OEMC'),(8,NULL),(9,' ')) v(a,b)),
base AS (
  SELECT l.*, o.o_orderstatus, o.o_orderpriority, c.c_custkey, c.c_nationkey,
         CAST(c.c_custkey % 400 AS INT) AS a,
         l.l_shipdate + INTERVAL '1' MINUTE * CAST((l.l_partkey * 7 + l.l_suppkey) % 1440 AS INT) AS cts,
         l.l_shipdate + INTERVAL '1' MINUTE * CAST((l.l_partkey * 7 + l.l_suppkey) % 1440 + CAST(l.l_quantity AS INT) * 997 - 2400 AS INT) AS xts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT
  'SR' || CAST(b.l_orderkey AS STRING) || '-' || CAST(b.l_linenumber AS STRING) AS sr_number,
  t.sr_type, t.sr_short_code, w.dept AS owner_department,
  CASE WHEN b.l_suppkey % 5 < 2 THEN NULL ELSE w2.dept END AS created_department,
  CASE b.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'Canceled' END AS status,
  CASE b.o_orderpriority WHEN '1-URGENT' THEN 'Phone Call' WHEN '2-HIGH' THEN 'Internet' WHEN '3-MEDIUM' THEN 'Mobile Device' WHEN '5-LOW' THEN '' ELSE NULL END AS origin,
  left(CAST(b.cts AS STRING), 10) || 'T' || substring(CAST(b.cts AS STRING), 12, 8) || '.000' AS created_date,
  left(CAST(b.xts AS STRING), 10) || 'T' || substring(CAST(b.xts AS STRING), 12, 8) || '.000' AS last_modified_date,
  CASE WHEN b.l_returnflag = 'A' AND b.l_linestatus = 'O' THEN NULL
       ELSE left(CAST(b.xts AS STRING), 10) || 'T' || substring(CAST(b.xts AS STRING), 12, 8) || '.000' END AS closed_date,
  CASE WHEN b.a % 11 = 0 THEN NULL ELSE CAST(100 + b.a % 50 AS STRING) || ' W ADDISON ST' END AS street_address,
  CASE WHEN b.a % 3 = 0 THEN NULL ELSE 'CHICAGO' END AS city,
  CASE WHEN b.a % 3 = 0 THEN NULL ELSE 'IL' END AS state,
  CASE WHEN b.a % 15 = 0 THEN NULL ELSE CAST(60600 + b.c_nationkey AS STRING) END AS zip_code,
  CASE WHEN b.a % 11 = 0 THEN NULL ELSE CAST(100 + b.a % 50 AS STRING) END AS street_number,
  CASE WHEN b.a % 11 = 0 THEN ' ' ELSE 'W' END AS street_direction,
  CASE WHEN b.a % 22 = 0 THEN NULL ELSE 'ADDISON' END AS street_name,
  CASE WHEN b.a % 9 = 0 THEN '' ELSE 'ST' END AS street_type,
  b.l_discount = 0.0 AS duplicate,
  b.l_tax = 0.0 AS legacy_record,
  CASE WHEN b.l_tax = 0.0 THEN 'CSR-' || CAST(b.l_orderkey AS STRING) ELSE NULL END AS legacy_sr_number,
  CASE WHEN b.l_linenumber >= 6 THEN 'SR' || CAST(b.l_orderkey AS STRING) || '-1' ELSE NULL END AS parent_sr_number,
  CASE WHEN b.a % 17 = 0 THEN NULL ELSE CAST(1 + b.a % 77 AS STRING) END AS community_area,
  CASE b.a % 54 WHEN 0 THEN NULL WHEN 51 THEN '' WHEN 52 THEN 'x' WHEN 53 THEN ' 7 ' ELSE CAST(b.a % 54 AS STRING) END AS ward,
  CASE WHEN b.a % 4 = 0 THEN NULL ELSE CAST(b.a % 29 AS STRING) END AS electrical_district,
  CASE WHEN b.a % 6 = 0 THEN NULL ELSE 'F0' || CAST(b.a % 20 AS STRING) END AS electricity_grid,
  CAST(b.a % 3 AS STRING) AS police_sector,
  CASE WHEN b.a % 17 = 0 THEN NULL ELSE CAST(1 + b.a % 25 AS STRING) END AS police_district,
  CAST(1700 + b.a % 40 AS STRING) || CASE WHEN b.l_linenumber = 7 THEN ' ' ELSE '' END AS police_beat,
  CASE WHEN b.c_custkey % 8 = 0 THEN '' ELSE CAST(b.c_custkey % 61 AS STRING) END AS precinct,
  CASE b.a % 5 WHEN 0 THEN 'Thursday' WHEN 1 THEN 'MON' WHEN 2 THEN 'Monday' ELSE NULL END AS sanitation_division_days,
  substring(CAST(b.cts AS STRING), 12, 2) AS created_hour,
  CAST(1 + b.a % 7 AS STRING) AS created_day_of_week,
  CAST(NULL AS STRING) AS created_month,
  CASE WHEN b.a % 13 = 0 THEN NULL ELSE CAST(1110000 + b.a * 137 AS STRING) || '.621' END AS x_coordinate,
  CASE WHEN b.a % 13 = 0 THEN NULL ELSE CAST(1810000 + b.a * 211 AS STRING) || '.942' END AS y_coordinate,
  CASE WHEN b.a % 13 = 0 THEN NULL ELSE '41.' || CAST(600000 + (b.a % 50) * 4217 AS STRING) END AS latitude,
  CASE WHEN b.a % 13 = 0 THEN NULL ELSE '-87.' || CAST(500000 + (b.a % 50) * 7211 AS STRING) END AS longitude,
  CASE WHEN b.a % 13 = 0 THEN NULL ELSE {'latitude': '41.' || CAST(600000 + (b.a % 50) * 4217 AS STRING),
    'longitude': '-87.' || CAST(500000 + (b.a % 50) * 7211 AS STRING)} END AS location
FROM base b
JOIN sr_types t ON t.k = b.l_partkey % 16
JOIN depts w ON w.k = b.l_suppkey % 10
JOIN depts w2 ON w2.k = (b.l_partkey + b.l_suppkey) % 10"""

_RELATIONS["requests"] = """
SELECT r.*, 1 AS rn FROM raw_requests r
QUALIFY row_number() OVER (PARTITION BY sr_number ORDER BY created_date NULLS LAST) = 1"""

# --- rule fragments; regular expressions over lower-cased text ---------------------------
# The keywords, ward lists, ranges and labels of the published rules.

_TYPE = "lower(coalesce(sr_type, ''))"
_OWNER = "lower(coalesce(owner_department, ''))"

_CATEGORY = f"""CASE
    WHEN regexp_matches({_TYPE}, 'graffiti|litter|garbage|refuse|waste|debris|dumping') THEN 'Sanitation'
    WHEN regexp_matches({_TYPE}, 'pothole|street|traffic|sidewalk|curb|pavement|road') THEN 'Transportation'
    WHEN regexp_matches({_TYPE}, 'tree|vegetation|park|landscape|green') THEN 'Environment'
    WHEN regexp_matches({_TYPE}, 'light|electrical|power|utility|signal') THEN 'Infrastructure'
    WHEN regexp_matches({_TYPE}, 'water|sewer|drain|flood|leak|pipe') THEN 'Utilities'
    WHEN regexp_matches({_TYPE}, 'animal|rodent|pest|stray|wildlife') THEN 'Animal Services'
    WHEN regexp_matches({_TYPE}, 'abandon|building|property|vacant|structure|housing') THEN 'Property'
    WHEN regexp_matches({_TYPE}, 'noise|police|crime|safety|security') THEN 'Public Safety'
    WHEN regexp_matches({_TYPE}, 'permit|license|violation|inspection|code') THEN 'Regulatory'
    WHEN regexp_matches({_TYPE}, 'health|medical|food|restaurant') THEN 'Health Services'
    ELSE 'Other' END"""
_SUBCATEGORY = f"""CASE
    WHEN contains({_TYPE}, 'graffiti') THEN 'Graffiti Removal' WHEN contains({_TYPE}, 'pothole') THEN 'Road Maintenance'
    WHEN contains({_TYPE}, 'tree') THEN 'Tree Services' WHEN contains({_TYPE}, 'light') THEN 'Street Lighting'
    WHEN contains({_TYPE}, 'water') THEN 'Water Services' ELSE 'General' END"""
_PRIORITY = f"""CASE WHEN regexp_matches({_TYPE}, 'emergency|urgent|danger|hazard|leak') THEN 'High'
    WHEN regexp_matches({_TYPE}, 'safety|traffic|signal|water') THEN 'Medium' ELSE 'Standard' END"""
_EMERGENCY = f"regexp_matches({_TYPE}, 'emergency|urgent|danger|hazard')"
_DAYS = f"""CASE WHEN regexp_matches({_TYPE}, 'emergency|urgent|danger|hazard') THEN 1
    WHEN regexp_matches({_TYPE}, 'graffiti|litter|light') THEN 3
    WHEN regexp_matches({_TYPE}, 'pothole|tree|water') THEN 7
    WHEN regexp_matches({_TYPE}, 'building|property') THEN 14 ELSE 7 END"""
_DEPARTMENT_TYPE = f"""CASE
    WHEN regexp_matches({_OWNER}, 'water|sewer|utility') THEN 'Utilities'
    WHEN regexp_matches({_OWNER}, 'transport|street|traffic|cdot') THEN 'Transportation'
    WHEN regexp_matches({_OWNER}, 'sanitation|environment|fleet|waste') THEN 'Environmental'
    WHEN regexp_matches({_OWNER}, 'police|fire|emergency|oemc') THEN 'Public Safety'
    WHEN regexp_matches({_OWNER}, 'building|housing|planning|zoning') THEN 'Development'
    WHEN regexp_matches({_OWNER}, 'health|family|social|human') THEN 'Health & Human Services'
    WHEN regexp_matches({_OWNER}, 'park|recreation|cultural') THEN 'Parks & Recreation'
    WHEN trim({_OWNER}) IN ('', 'unknown department') AND
         trim(coalesce(owner_department, '')) IN ('', 'Unknown Department') THEN 'Missing Data'
    ELSE 'Administrative' END"""
_HIERARCHY = f"""CASE WHEN regexp_matches({_OWNER}, 'commissioner|director|chief') THEN 'Executive'
    WHEN regexp_matches({_OWNER}, 'manager|supervisor|coordinator') THEN 'Management'
    WHEN regexp_matches({_OWNER}, 'officer|inspector|specialist') THEN 'Operational' ELSE 'Standard' END"""
_CAPACITY = f"""CASE WHEN regexp_matches({_OWNER}, 'police|fire|water|transport') THEN 'High'
    WHEN regexp_matches({_OWNER}, 'health|building|environment') THEN 'Medium' ELSE 'Standard' END"""
_HOURS = f"""CASE WHEN regexp_matches({_OWNER}, 'police|fire|emergency|water') THEN '24/7'
    WHEN regexp_matches({_OWNER}, 'sanitation|transport|street') THEN 'Extended Hours' ELSE 'Business Hours' END"""

_WARD = "TRY_CAST(ward AS INTEGER)"
_CLUSTER = f"""CASE WHEN {_WARD} >= 1 AND {_WARD} <= 17 THEN 'North Side Cluster'
    WHEN {_WARD} >= 18 AND {_WARD} <= 34 THEN 'Central Cluster'
    WHEN {_WARD} >= 35 AND {_WARD} <= 50 THEN 'South Side Cluster'
    WHEN community_area IS NULL THEN 'Unassigned Cluster' ELSE 'Community Based Cluster' END"""
_AREA = f"""coalesce('Police District ' || police_district,
    'Ward Service Area ' || CAST({_WARD} AS VARCHAR), 'Unassigned Service Area')"""
_DENSITY = f"""CASE WHEN list_contains([1,2,8,32,42,43], {_WARD}) THEN 'High Density'
    WHEN list_contains([19,23,38,44,46,47,48,49,50], {_WARD}) THEN 'Low Density' ELSE 'Medium Density' END"""
_INCOME = f"""CASE WHEN list_contains([1,2,18,19,38,39,40,41,43], {_WARD}) THEN 'Higher Income'
    WHEN list_contains([15,16,17,20,24,28,29,34], {_WARD}) THEN 'Lower Income' ELSE 'Mixed Income' END"""

_E, _G, _S = "electrical_district", "electricity_grid", "sanitation_division_days"
_UTILITY = f"""CASE WHEN {_E} IS NULL AND {_S} IS NULL THEN 'General Utility'
    WHEN {_E} IS NOT NULL AND {_G} IS NOT NULL THEN 'Electrical'
    WHEN {_S} IS NULL THEN 'Power Distribution' ELSE 'Sanitation' END"""
_RELIABILITY = f"""CASE WHEN {_E} IS NOT NULL AND {_G} IS NOT NULL THEN 'High Reliability'
    WHEN regexp_matches(coalesce({_S}, ''), 'DAILY|MON') THEN 'High Frequency'
    WHEN coalesce({_E}, {_G}) IS NOT NULL THEN 'Standard Reliability' ELSE 'Variable' END"""
_SCHEDULE = f"""CASE WHEN {_S} IS NOT NULL THEN 'Sanitation: ' || {_S}
    WHEN {_E} IS NOT NULL THEN 'Electrical: Scheduled Maintenance' ELSE 'Standard Schedule' END"""
_AGE = f"""CASE WHEN TRY_CAST({_E} AS INTEGER) > 20 THEN 'Older Infrastructure'
    WHEN TRY_CAST({_E} AS INTEGER) > 10 THEN 'Mature Infrastructure'
    WHEN TRY_CAST({_E} AS INTEGER) > 0 THEN 'Newer Infrastructure' ELSE 'Mixed Age' END"""
_LEVEL = f"""CASE WHEN {_E} IS NULL AND {_S} IS NULL THEN 'Limited Capacity'
    WHEN {_E} IS NULL OR {_G} IS NULL THEN 'Standard Capacity'
    WHEN {_S} IS NULL THEN 'Medium Capacity' ELSE 'High Capacity' END"""

_LOCATED = "(latitude IS NOT NULL AND longitude IS NOT NULL)"
_COMPLETENESS = f"""CASE WHEN street_address IS NOT NULL AND zip_code IS NOT NULL AND {_LOCATED} THEN 'Complete'
    WHEN street_address IS NOT NULL AND (zip_code IS NOT NULL OR {_LOCATED}) THEN 'Good'
    WHEN street_name IS NULL AND latitude IS NULL THEN 'Poor' ELSE 'Partial' END"""
_REGION = """CASE WHEN ward >= 1 AND ward <= 50 THEN
      list_extract(['North Chicago', 'Northwest Chicago', 'Central Chicago', 'Southwest Chicago', 'South Chicago'],
                   CAST((ward - 1) // 10 + 1 AS INTEGER))
    WHEN community_area IS NOT NULL THEN 'Chicago (Community Based)'
    WHEN latitude >= 41.6 AND latitude <= 42.1 AND longitude >= -87.9 AND longitude <= -87.5
      THEN 'Chicago (Coordinate Based)'
    ELSE 'Unknown Region' END"""
_SCORE = f"""CAST(CASE WHEN NOT {_LOCATED} THEN
        CASE WHEN street_address IS NULL THEN 0.0 WHEN ward IS NULL THEN 0.2 ELSE 0.4 END
      ELSE CASE WHEN street_address IS NULL THEN 0.6 WHEN ward IS NULL THEN 0.8 ELSE 1.0 END END AS DOUBLE)"""
_PRECISION = f"""CASE WHEN NOT {_LOCATED} THEN 'No Coordinates' WHEN street_address IS NOT NULL THEN 'Address Level'
    WHEN street_name IS NOT NULL THEN 'Street Level' ELSE 'Area Level' END"""


def _hash(*columns: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce(trim({c}), '')" for c in columns) + ")"


_SERVICE_HASH = _hash("sr_type", "sr_short_code", "origin")
_DEPARTMENT_HASH = _hash("owner_department", "created_department")
_GEOGRAPHY_HASH = _hash("community_area", "ward", "police_district", "police_beat", "police_sector", "precinct")
_INFRASTRUCTURE_HASH = _hash(_E, _G, _S)
_CLEAN_WARD = "TRY_CAST(nullif(trim(ward), '') AS INTEGER)"
_LOCATION_HASH = f"""md5(coalesce(nullif(trim(street_address), ''), 'NO_ADDRESS') || '|'
    || coalesce(nullif(trim(city), ''), 'Chicago') || '|'
    || coalesce(nullif(trim(zip_code), ''), 'NO_ZIP') || '|'
    || coalesce(CAST(TRY_CAST(latitude AS DOUBLE) AS VARCHAR), 'NO_LAT') || '|'
    || coalesce(CAST(TRY_CAST(longitude AS DOUBLE) AS VARCHAR), 'NO_LON') || '|'
    || coalesce(CAST({_CLEAN_WARD} AS VARCHAR), 'NO_WARD'))"""

_SERVICE_NAME = "coalesce(nullif(trim(sr_type), ''), 'Unknown Service')"
_SERVICE_CODE = "coalesce(nullif(trim(sr_short_code), ''), 'UNK')"
_SERVICE_ORIGIN = "coalesce(nullif(trim(origin), ''), 'Unknown Origin')"
_DEPARTMENT_NAME = "coalesce(nullif(trim(owner_department), ''), 'Unknown Department')"
_DEPARTMENT_CREATOR = "coalesce(nullif(trim(created_department), ''), 'Unknown Creator')"

_RELATIONS["dim_service"] = f"""
SELECT row_number() OVER (ORDER BY coalesce(sr_type, ''), coalesce(sr_short_code, ''), coalesce(origin, ''),
         sr_type NULLS LAST, sr_short_code NULLS LAST, origin NULLS LAST) AS service_id,
       {_SERVICE_NAME} AS service_name, {_SERVICE_CODE} AS service_short_code, {_SERVICE_ORIGIN} AS service_origin,
       {_CATEGORY} AS service_category, {_SUBCATEGORY} AS service_subcategory, {_PRIORITY} AS priority_level,
       {_EMERGENCY} AS is_emergency, {_DAYS} AS typical_resolution_days, {_SERVICE_HASH} AS service_hash
FROM (SELECT DISTINCT sr_type, sr_short_code, origin FROM requests
      WHERE coalesce(sr_type, sr_short_code, origin) IS NOT NULL)"""

_RELATIONS["dim_department"] = f"""
SELECT row_number() OVER (ORDER BY {_DEPARTMENT_NAME}, {_DEPARTMENT_CREATOR},
         owner_department NULLS LAST, created_department NULLS LAST) AS department_id,
       {_DEPARTMENT_NAME} AS department_name, {_DEPARTMENT_CREATOR} AS created_department,
       {_DEPARTMENT_TYPE} AS department_type, {_HIERARCHY} AS department_hierarchy,
       trim(coalesce(owner_department, '')) = '' AS is_missing_data, {_CAPACITY} AS agency_capacity,
       {_HOURS} AS operating_hours, {_DEPARTMENT_HASH} AS department_hash
FROM (SELECT DISTINCT owner_department, created_department FROM requests)"""

_FIXED_DAYS = "strftime(d, '%m-%d')"
_FLOATING = """CASE
    WHEN month(d) = 1 AND dayofweek(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Martin Luther King Jr Day'
    WHEN month(d) = 2 AND dayofweek(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Presidents Day'
    WHEN month(d) = 5 AND dayofweek(d) = 1 AND day(d) > 24 THEN 'Memorial Day'
    WHEN month(d) = 9 AND dayofweek(d) = 1 AND day(d) < 8 THEN 'Labor Day'
    WHEN month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving' END"""
_SEASON = """CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Spring'
    WHEN {m} IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""
_CALENDAR = f"""CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month", CAST(day(d) AS INTEGER) AS "day",
    CAST(quarter(d) AS INTEGER) AS "quarter", CAST(dayofweek(d) AS INTEGER) AS day_of_week,
    dayname(d) AS day_name, monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend,
    {_FIXED_DAYS} IN ('01-01', '07-04', '12-25', '11-11', '02-14', '10-31') OR {_FLOATING} IS NOT NULL AS is_holiday,
    NOT (dayofweek(d) IN (0, 6) OR {_FIXED_DAYS} IN ('01-01', '07-04', '12-25', '11-11')
         OR coalesce({_FLOATING}, '') = 'Thanksgiving') AS is_business_day,
    {_SEASON.format(m="month(d)")} AS season,
    CASE WHEN month(d) IN (11, 12, 1, 2, 3) THEN 'Winter Service Peak'
         WHEN month(d) IN (6, 7, 8) THEN 'Summer Service Peak' ELSE 'Regular Season' END AS service_season,
    CAST(year(d + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_year,
    CAST(CASE quarter(d) WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter,
    CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST((day(d) + 6) // 7 AS INTEGER) AS week_of_month,
    CAST(dayofyear(d) AS INTEGER) AS day_of_year, day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
    d = date_trunc('quarter', d) AS is_quarter_start,
    d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end,
    {_FIXED_DAYS} = '01-01' AS is_year_start, {_FIXED_DAYS} = '12-31' AS is_year_end,
    coalesce(CASE {_FIXED_DAYS} WHEN '01-01' THEN 'New Years Day' WHEN '07-04' THEN 'Independence Day'
             WHEN '12-25' THEN 'Christmas Day' WHEN '11-11' THEN 'Veterans Day' END, {_FLOATING}) AS holiday_name,
    CASE WHEN month(d) = 2 THEN 20 WHEN day(last_day(d)) = 31 THEN 23 ELSE 22 END AS business_days_in_month"""

_RELATIONS["dim_time"] = f"""
SELECT d AS date_id, {_CALENDAR}
FROM (SELECT DISTINCT CAST(TRY_CAST(created_date AS TIMESTAMP) AS DATE) AS d FROM requests) WHERE d IS NOT NULL"""

_RELATIONS["dim_geography"] = f"""
SELECT row_number() OVER (ORDER BY coalesce(community_area, 'Unknown'), coalesce(ward, 'Unknown'),
         coalesce(police_district, 'Unknown'), community_area NULLS LAST, ward NULLS LAST, police_district NULLS LAST,
         police_beat NULLS LAST, police_sector NULLS LAST, precinct NULLS LAST) AS geography_id,
       nullif(trim(community_area), '') AS community_area,
       'Community Area ' || nullif(trim(community_area), '') AS community_area_name,
       {_CLEAN_WARD} AS ward, 'Ward ' || CAST({_WARD} AS VARCHAR) AS ward_name,
       nullif(trim(police_district), '') AS police_district, nullif(trim(police_beat), '') AS police_beat,
       nullif(trim(police_sector), '') AS police_sector, nullif(trim(precinct), '') AS precinct,
       'Alderman Ward ' || CAST({_WARD} AS VARCHAR) AS alderman_name, {_CLUSTER} AS geographic_cluster,
       {_AREA} AS service_area, {_DENSITY} AS population_density, {_INCOME} AS socioeconomic_level,
       {_GEOGRAPHY_HASH} AS geography_hash
FROM (SELECT DISTINCT community_area, ward, police_district, police_beat, police_sector, precinct FROM requests
      WHERE coalesce(community_area, ward, police_district) IS NOT NULL)"""

_INFRA_COLUMNS = f"""{_UTILITY} AS utility_type, {_RELIABILITY} AS service_reliability,
       {_SCHEDULE} AS maintenance_schedule, {_AGE} AS infrastructure_age, {_LEVEL} AS capacity_level"""
_RELATIONS["dim_infrastructure"] = f"""
SELECT row_number() OVER (ORDER BY coalesce({_E}, 'Unknown'), coalesce({_G}, 'Unknown'), coalesce({_S}, 'Unknown'),
         {_E} NULLS LAST, {_G} NULLS LAST, {_S} NULLS LAST) AS infrastructure_id,
       nullif(trim({_E}), '') AS {_E}, nullif(trim({_G}), '') AS {_G}, nullif(trim({_S}), '') AS {_S},
       {_INFRA_COLUMNS}, {_INFRASTRUCTURE_HASH} AS infrastructure_hash
FROM (SELECT DISTINCT {_E}, {_G}, {_S} FROM requests WHERE coalesce({_E}, {_G}, {_S}) IS NOT NULL)"""

_PLACE_COLUMNS = (
    "street_number", "street_name", "street_type", "street_direction", "street_address", "city", "state", "zip_code",
    "community_area", "ward", "police_district", "police_beat", "police_sector", "precinct",
    "sanitation_division_days", "electrical_district", "electricity_grid", "latitude", "longitude", "x_coordinate",
    "y_coordinate",
)
_PLACE_SQL = {c: f"nullif(trim({c}), '')" for c in _PLACE_COLUMNS}
_PLACE_SQL |= {c: f"TRY_CAST({c} AS DOUBLE)" for c in ("latitude", "longitude", "x_coordinate", "y_coordinate")}
_PLACE_SQL |= {"ward": _CLEAN_WARD, "city": "coalesce(nullif(trim(city), ''), 'Chicago')",
               "state": "coalesce(nullif(trim(state), ''), 'IL')"}
_PLACES = ", ".join(f"{sql} AS {c}" for c, sql in _PLACE_SQL.items())
_PLACE_ORDER = ", ".join(f"{c} NULLS LAST" for c in _PLACE_COLUMNS)
_RELATIONS["dim_location"] = f"""
WITH places AS (SELECT DISTINCT {_LOCATION_HASH} AS h, {_PLACES} FROM requests),
ranked AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY {_PLACE_ORDER}) AS n FROM places)
SELECT row_number() OVER (ORDER BY h, n) AS location_id, {", ".join(_PLACE_COLUMNS)},
       h || '_' || CAST(n AS VARCHAR) AS location_key, {_COMPLETENESS} AS address_completeness,
       {_REGION} AS geographic_region, {_SCORE} AS spatial_quality_score, {_LOCATED} AS is_geocoded,
       {_PRECISION} AS coordinate_precision
FROM ranked"""

_RELATIONS["fact_requests"] = """
SELECT row_number() OVER (ORDER BY CAST(r.created_date AS DATE) NULLS LAST, r.sr_number NULLS LAST) AS fact_id,
       r.sr_number, CAST(r.created_date AS TIMESTAMP) AS created_date, CAST(r.closed_date AS TIMESTAMP) AS closed_date,
       r.status, coalesce(s.id, -1) AS service_id, coalesce(d.id, -1) AS department_id,
       coalesce(l.id, -1) AS location_id, CAST(r.created_date AS DATE) AS date_id, 1 AS request_count
FROM requests r
LEFT JOIN (SELECT service_name AS name, min(service_id) AS id FROM dim_service GROUP BY 1) s ON trim(r.sr_type) = s.name
LEFT JOIN (SELECT department_name AS name, min(department_id) AS id FROM dim_department GROUP BY 1) d
       ON trim(r.created_department) = d.name
LEFT JOIN (SELECT location_key AS k, min(location_id) AS id FROM dim_location GROUP BY 1) l
       ON l.k = md5(coalesce(trim(r.street_number), '') || coalesce(trim(r.street_name), '')
                    || coalesce(trim(r.zip_code), ''))"""

_NULLSAFE_GEOGRAPHY = f"""nullif(trim(r.community_area), '') IS NOT DISTINCT FROM g.community_area
   AND {_CLEAN_WARD.replace("ward", "r.ward")} IS NOT DISTINCT FROM g.ward
   AND nullif(trim(r.police_district), '') IS NOT DISTINCT FROM g.police_district
   AND nullif(trim(r.police_beat), '') IS NOT DISTINCT FROM g.police_beat
   AND nullif(trim(r.police_sector), '') IS NOT DISTINCT FROM g.police_sector
   AND nullif(trim(r.precinct), '') IS NOT DISTINCT FROM g.precinct"""
_NULLSAFE_INFRASTRUCTURE = f"""nullif(trim(r.{_E}), '') IS NOT DISTINCT FROM i.{_E}
   AND nullif(trim(r.{_G}), '') IS NOT DISTINCT FROM i.{_G}
   AND nullif(trim(r.{_S}), '') IS NOT DISTINCT FROM i.{_S}"""


def _of_request(sql: str, *columns: str) -> str:
    for column in columns:
        sql = sql.replace(column, f"r.{column}")
    return sql


_ON_SERVICE = f"""{_of_request(_SERVICE_NAME, "sr_type")} = s.service_name
   AND {_of_request(_SERVICE_CODE, "sr_short_code")} = s.service_short_code
   AND {_of_request(_SERVICE_ORIGIN, "origin")} = s.service_origin"""
_ON_DEPARTMENT = f"""{_of_request(_DEPARTMENT_NAME, "owner_department")} = d.department_name
   AND {_of_request(_DEPARTMENT_CREATOR, "created_department")} = d.created_department"""
_FIRST_LOCATIONS = """(SELECT left(location_key, 32) AS h, location_id FROM dim_location
                       WHERE regexp_matches(location_key, '_1$'))"""

_RELATIONS["fact_star"] = f"""
SELECT r.sr_number, r.status, TRY_CAST(r.created_date AS TIMESTAMP) AS created_ts,
       TRY_CAST(r.last_modified_date AS TIMESTAMP) AS last_modified_ts, TRY_CAST(r.closed_date AS TIMESTAMP) AS closed_ts,
       r.duplicate, r.legacy_record, r.legacy_sr_number, r.parent_sr_number, s.service_id, d.department_id,
       t.date_id AS created_date_id, l.location_id, g.geography_id, i.infrastructure_id
FROM (SELECT *, {_LOCATION_HASH} AS h FROM requests) r
LEFT JOIN (SELECT service_name, service_short_code, service_origin, min(service_id) AS service_id
           FROM dim_service GROUP BY ALL) s ON {_ON_SERVICE}
LEFT JOIN (SELECT department_name, created_department, min(department_id) AS department_id
           FROM dim_department GROUP BY ALL) d ON {_ON_DEPARTMENT}
LEFT JOIN dim_time t ON CAST(TRY_CAST(r.created_date AS TIMESTAMP) AS DATE) = t.date_id
LEFT JOIN {_FIRST_LOCATIONS} l ON r.h = l.h
LEFT JOIN (SELECT community_area, ward, police_district, police_beat, police_sector, precinct,
                  min(geography_id) AS geography_id FROM dim_geography GROUP BY ALL) g ON {_NULLSAFE_GEOGRAPHY}
LEFT JOIN (SELECT {_E}, {_G}, {_S}, min(infrastructure_id) AS infrastructure_id
           FROM dim_infrastructure GROUP BY ALL) i ON {_NULLSAFE_INFRASTRUCTURE}"""

_ENCODED = ("service_category", "priority_level", "department_type")
_CODES = "\n".join(
    f"""LEFT JOIN (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c} NULLS LAST) - 1 AS INTEGER) AS code
           FROM featured GROUP BY 1) c{n} ON f.{c} = c{n}.v"""
    for n, c in enumerate(_ENCODED)
)
_RELATIONS["features"] = f"""
WITH featured AS (
  SELECT f.sr_number, f.created_date_id AS created_day,
         (epoch_us(f.closed_ts) - epoch_us(f.created_ts)) / 1e6 / 3600 AS hours_to_close,
         CASE WHEN f.closed_ts IS NULL THEN 0 ELSE 1 END AS is_closed, CAST(hour(f.created_ts) AS INTEGER) AS created_hour,
         t.day_of_week, t."month", CAST(coalesce(t.is_weekend, false) AS INTEGER) AS is_weekend,
         CAST(coalesce(t.is_business_day, false) AS INTEGER) AS is_business_day,
         CAST(coalesce(s.is_emergency, false) AS INTEGER) AS is_emergency,
         CASE WHEN f.location_id IS NULL THEN 0 ELSE 1 END AS is_located,
         CASE WHEN f.parent_sr_number IS NULL THEN 0 ELSE 1 END AS is_child,
         coalesce(s.service_category, 'Unknown') AS service_category,
         coalesce(s.priority_level, 'Unknown') AS priority_level,
         coalesce(d.department_type, 'Unknown') AS department_type
  FROM fact_star f LEFT JOIN dim_service s ON f.service_id = s.service_id
  LEFT JOIN dim_department d ON f.department_id = d.department_id
  LEFT JOIN dim_time t ON f.created_date_id = t.date_id)
SELECT f.*, {", ".join(f"c{n}.code AS {c}_code" for n, c in enumerate(_ENCODED))}
FROM featured f
{_CODES}"""

_RELATIONS["batches"] = """
SELECT *, CASE WHEN created_date < '1995-01-01' THEN 1 ELSE 2 END AS load FROM raw_requests
UNION ALL
SELECT * REPLACE (CAST(CAST(left(created_date, 10) AS DATE) - 40 AS VARCHAR) || substring(created_date, 11) AS created_date), 3
FROM raw_requests WHERE left(created_date, 7) = '1996-03'"""
_RELATIONS["merged"] = """
SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY sr_number ORDER BY created_date NULLS LAST) = 1"""

_NEEDS = {
    "raw_requests": (),
    "batches": ("raw_requests",),
    "merged": ("batches",),
    "requests": ("raw_requests",),
    "dim_service": ("requests",),
    "dim_department": ("requests",),
    "dim_time": ("requests",),
    "dim_geography": ("requests",),
    "dim_infrastructure": ("requests",),
    "dim_location": ("requests",),
    "fact_requests": ("requests", "dim_service", "dim_department", "dim_location"),
    "fact_star": (
        "requests", "dim_service", "dim_department", "dim_time", "dim_geography", "dim_infrastructure", "dim_location",
    ),
    "features": ("fact_star", "dim_service", "dim_department", "dim_time"),
}


def _with(body: str, *relations: str) -> str:
    """The query with its relations, and theirs, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in relations:
        add(name)
    blocks = ",\n".join(f"{name} AS ({_RELATIONS[name]})" for name in ordered)
    return f"WITH {blocks}\n{body}"


def _raw(body: str) -> str:
    return _with(body, "raw_requests")


def _requests(body: str) -> str:
    return _with(body, "requests")


def _fact(body: str) -> str:
    return _with(body, "fact_requests")


def _rule(keys: str, columns: str) -> str:
    return _requests(f"SELECT {keys}, {columns}, count(*) AS cnt FROM requests GROUP BY ALL")


_DATED = "TRY_CAST(created_date AS TIMESTAMP)"
_HOURS_TO_CLOSE = """(epoch_us(CAST(closed_date AS TIMESTAMP)) - epoch_us(CAST(created_date AS TIMESTAMP))) / 1e6 / 3600"""
_DAYS_TO_CLOSE = """CAST(floor((epoch_us(TRY_CAST(closed_date AS TIMESTAMP)) - epoch_us(TRY_CAST(created_date AS TIMESTAMP)))
    / 1e6 / 86400) AS BIGINT)"""

_RAW_TYPES = {
    "sr_number": "string", "sr_type": "string", "sr_short_code": "string", "owner_department": "string",
    "created_department": "string", "status": "string", "origin": "string", "created_date": "string",
    "last_modified_date": "string", "closed_date": "string", "street_address": "string", "city": "string",
    "state": "string", "zip_code": "string", "street_number": "string", "street_direction": "string",
    "street_name": "string", "street_type": "string", "duplicate": "boolean", "legacy_record": "boolean",
    "legacy_sr_number": "string", "parent_sr_number": "string", "community_area": "string", "ward": "string",
    "electrical_district": "string", "electricity_grid": "string", "police_sector": "string",
    "police_district": "string", "police_beat": "string", "precinct": "string", "sanitation_division_days": "string",
    "created_hour": "string", "created_day_of_week": "string", "created_month": "string", "x_coordinate": "string",
    "y_coordinate": "string", "latitude": "string", "longitude": "string",
}


def _per_raw_column(select: str) -> str:
    parts = [
        select.format(column=c, position=n, type=t) + " FROM raw_requests"
        for n, (c, t) in enumerate((_RAW_TYPES | {"location": "struct<latitude:string,longitude:string>"}).items(), start=1)
    ]
    return " UNION ALL ".join(parts)


def _histogram(value: str, bins: int) -> str:
    return _raw(f"""
SELECT b.bin, round(lo + b.bin * w, 6) AS lower_edge, round(lo + (b.bin + 1) * w, 6) AS upper_edge,
       coalesce(c.cnt, 0) AS cnt
FROM (SELECT range AS bin FROM range({bins})) b
CROSS JOIN (SELECT lo, (hi - lo) / {bins} AS w FROM (
    SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
           CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
    FROM (SELECT CAST({value} AS DOUBLE) AS x FROM raw_requests))) e
LEFT JOIN (
  SELECT least(CAST(floor((x - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS bin, count(*) AS cnt
  FROM (SELECT x, min(x) OVER () AS lo, max(x) OVER () AS hi
        FROM (SELECT CAST({value} AS DOUBLE) AS x FROM raw_requests) WHERE x IS NOT NULL)
  GROUP BY 1) c ON c.bin = b.bin""")


# The request types that the derived table has.
_PIVOT_TYPES = (
    "311 INFORMATION ONLY CALL", "Aircraft Noise Complaint", "Graffiti Removal Request", "Pothole in Street Complaint",
    "Street Light Out Complaint", "Rodent Baiting/Rat Complaint", "Garbage Cart Maintenance",
    "Abandoned Vehicle Complaint", "Tree Emergency", "Water Lead Test Kit Request", "Building Violation",
    "Sanitation Code Violation", "Gas Leak Hazard", " Pothole in Street Complaint ", "   ",
)


def _pivot(index: str, name: str) -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE sr_type = '{t}') AS \"{t}\"" for t in _PIVOT_TYPES)
    return _raw(f"""SELECT {index} AS {name}, {cells} FROM raw_requests
        WHERE sr_type IS NOT NULL AND {index} IS NOT NULL GROUP BY 1""")


_DIM_KEYS = {
    "dim_service": "service_id", "dim_department": "department_id", "dim_location": "location_id",
    "dim_time": "date_id", "dim_geography": "geography_id", "dim_infrastructure": "infrastructure_id",
}
_ALL_TABLES = (*_DIM_KEYS, "fact_requests")
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _ALL_TABLES)
_REFERENCES = " UNION ALL ".join(
    f"""SELECT '{k}' AS key_column, count(*) AS missing_refs FROM fact_requests f
        WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{k} = f.{k})"""
    for t, k in _DIM_KEYS.items()
    if k in ("service_id", "department_id", "location_id", "date_id")
)
_NULL_CHECKS = ", ".join(
    f"count(*) - count({k}) AS null_{k}" for k in ("fact_id", "service_id", "department_id", "location_id", "date_id")
)
_DROPS = """SELECT r.n AS raw_rows, f.n AS fact_rows, r.n - f.n AS dropped_rows, (r.n - f.n) / CAST(r.n AS DOUBLE) AS dropped_ratio
FROM (SELECT count(*) AS n FROM raw_requests) r, (SELECT count(*) AS n FROM fact_requests) f"""
_PROFILED = {
    "dim_service": ("service_name", "service_category"),
    "dim_department": ("department_name", "department_type"),
    "dim_location": ("street_address", "ward"),
    "dim_time": ("year", "month", "season"),
    "dim_geography": ("ward", "police_district"),
    "dim_infrastructure": ("electrical_district", "utility_type"),
}
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_records,
        count(*) - count(DISTINCT {_DIM_KEYS[t]}) AS pk_duplicates,
        count(*) FILTER (WHERE coalesce(trim(CAST("{c}" AS VARCHAR)), '') IN ('', 'Unknown')) / CAST(count(*) AS DOUBLE)
          AS null_rate FROM {t}"""
    for t, columns in _PROFILED.items()
    for c in columns
)
_CARDINALITIES = ", ".join(
    f"count(DISTINCT coalesce(nullif(trim({c}), ''), 'Unknown')) AS {n}"
    for n, c in (
        ("unique_service_types", "sr_type"), ("unique_short_codes", "sr_short_code"), ("unique_origins", "origin"),
        ("unique_created_depts", "created_department"), ("unique_owner_depts", "owner_department"),
        ("unique_community_areas", "community_area"), ("unique_wards", "ward"),
        ("unique_police_districts", "police_district"), ("unique_police_sectors", "police_sector"),
        ("unique_police_beats", "police_beat"), ("unique_electrical_districts", "electrical_district"),
        ("unique_electricity_grids", "electricity_grid"), ("unique_addresses", "street_address"),
        ("unique_zip_codes", "zip_code"), ("unique_cities", "city"),
    )
)
_PLACE = {c: _PLACE_SQL[c] for c in ("street_address", "street_name", "zip_code", "ward", "latitude", "longitude")}


def _place_rule(rule: str, columns: tuple[str, ...]) -> str:
    cleaned = ", ".join(f"{_PLACE[c]} AS {c}" for c in columns)
    return _requests(
        f"SELECT {', '.join(columns)}, {rule}, count(*) AS cnt FROM (SELECT {cleaned} FROM requests) GROUP BY ALL"
    )


_INGESTED = f"SELECT {', '.join(_RAW_TYPES)}, left(created_date, 7) AS ingest_month FROM raw_requests"
_FLAT = ", ".join(f"nullif({c}, '') AS {c}" if t == "string" else c for c, t in _RAW_TYPES.items())
_BY_CONTENT = ", ".join(f"{c} NULLS LAST" for c in _RAW_TYPES)
_SAMPLE_HASH = "md5(concat_ws('|', sr_number, created_date, '42'))"
_GEO_SAMPLE = f"""SELECT sr_number, sr_type, created_date, latitude, longitude FROM raw_requests
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY {_SAMPLE_HASH}, 1, 2, 3, 4, 5 LIMIT """

_SERVICE_ORDER = """coalesce(sr_type, ''), coalesce(sr_short_code, ''), coalesce(origin, ''),
    sr_type NULLS LAST, sr_short_code NULLS LAST, origin NULLS LAST"""
_STABLE_KEYS = f""", services AS (
    SELECT sr_type, sr_short_code, origin, min(load) AS load FROM batches
    WHERE coalesce(sr_type, sr_short_code, origin) IS NOT NULL AND load < 3 GROUP BY ALL
), numbered AS (
    SELECT 'dim_service' AS dimension, row_number() OVER (ORDER BY load, {_SERVICE_ORDER}) AS member_id,
        {_SERVICE_HASH} AS member_key, load FROM services
), places AS (
    SELECT {_LOCATION_HASH} AS h, {_PLACES}, load FROM batches WHERE load < 3
), located AS (
    SELECT h, {", ".join(_PLACE_COLUMNS)}, min(load) AS load FROM places GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY h ORDER BY load, {_PLACE_ORDER}) AS n FROM located
), every AS (
    SELECT * FROM numbered UNION ALL
    SELECT 'dim_location', row_number() OVER (ORDER BY load, h, n), h || '_' || CAST(n AS VARCHAR), load FROM ranked
)
SELECT dimension, member_id, member_key, seen.load
FROM every JOIN (VALUES (1), (2)) seen(load) ON every.load <= seen.load"""


ORACLE: dict[str, str] = {
    "count_requests_per_service": _fact("SELECT service_id, count(*) AS cnt FROM fact_requests GROUP BY 1"),
    "top_10_services": _fact(
        "SELECT service_id, count(*) AS cnt FROM fact_requests GROUP BY 1 ORDER BY cnt DESC, service_id LIMIT 10"
    ),
    "requests_per_department": _fact("SELECT department_id, count(*) AS cnt FROM fact_requests GROUP BY 1"),
    "requests_per_location": _fact(
        "SELECT location_id, count(*) AS cnt FROM fact_requests GROUP BY 1 ORDER BY cnt DESC, location_id LIMIT 10"
    ),
    "requests_by_month": _fact(
        "SELECT strftime(date_id, '%Y-%m') AS month, count(*) AS cnt FROM fact_requests GROUP BY 1 ORDER BY 1"
    ),
    "join_service_department": _fact("""SELECT s.service_name, d.department_name, count(*) AS cnt FROM fact_requests f
        LEFT JOIN dim_service s ON f.service_id = s.service_id LEFT JOIN dim_department d ON f.department_id = d.department_id
        GROUP BY 1, 2 ORDER BY cnt DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 10"""),
    "fact_service_lookup": _fact("""SELECT fact_id, sr_number, service_name FROM fact_requests JOIN dim_service USING (service_id)
        ORDER BY fact_id LIMIT 10"""),
    "window_extract": _raw("""SELECT sr_number, created_date, sr_type, status FROM raw_requests
        WHERE created_date >= '1995-03-01T00:00:00.000' AND created_date <= '1996-02-29T23:59:59.999'"""),
    "month_calendar": _raw("""SELECT CAST(m AS DATE) AS month_start, last_day(CAST(m AS DATE)) AS month_end FROM (
        SELECT unnest(generate_series(min(date_trunc('month', CAST(created_date AS TIMESTAMP))),
                                      max(date_trunc('month', CAST(created_date AS TIMESTAMP))), INTERVAL 1 MONTH)) AS m
        FROM raw_requests)"""),
    "ingest_append": _raw(_INGESTED),
    "resumable_ingest": _raw(_INGESTED),
    "incremental_dedup": _with("SELECT sr_number, created_date, sr_type, left(created_date, 7) AS ingest_month FROM merged", "merged"),
    "stable_keys": _with("", "batches").rstrip() + _STABLE_KEYS,
    "incremental_fact": _with(f"""SELECT row_number() OVER (ORDER BY CAST(created_date AS DATE) NULLS LAST, sr_number) AS fact_id, sr_number,
        CAST(created_date AS TIMESTAMP) AS created_date, status, s.name AS service_name, d.name AS department_name,
        CAST(created_date AS DATE) AS date_id, CAST(year(CAST(created_date AS DATE)) AS INTEGER) AS "year",
        CAST(month(CAST(created_date AS DATE)) AS INTEGER) AS "month"
        FROM merged
        LEFT JOIN (SELECT DISTINCT {_SERVICE_NAME} AS name FROM batches) s ON trim(sr_type) = s.name
        LEFT JOIN (SELECT DISTINCT {_DEPARTMENT_NAME} AS name FROM batches) d ON trim(created_department) = d.name""", "merged"),
    "schema_evolution": _raw("""SELECT sr_number, sr_type, created_date,
        CASE WHEN legacy_record THEN legacy_sr_number END AS legacy_sr_number,
        CASE WHEN NOT coalesce(legacy_record, false) THEN created_department END AS created_department,
        CASE WHEN NOT coalesce(legacy_record, false) THEN parent_sr_number END AS parent_sr_number FROM raw_requests"""),
    "aligned_append": _raw("""SELECT sr_number, sr_type, created_date, left(created_date, 7) AS ingest_month,
        CASE WHEN legacy_record THEN legacy_sr_number END AS legacy_sr_number,
        CASE WHEN NOT coalesce(legacy_record, false) THEN created_department END AS created_department,
        CASE WHEN NOT coalesce(legacy_record, false) THEN parent_sr_number END AS parent_sr_number FROM raw_requests"""),
    "csv_roundtrip": _raw(f"SELECT {_FLAT} FROM raw_requests"),
    "debug_sample": _raw(f"SELECT {', '.join(_RAW_TYPES)} FROM raw_requests ORDER BY {_BY_CONTENT} LIMIT 10"),
    "closure_sample": _raw(f"""SELECT {_HOURS_TO_CLOSE} AS closure_time FROM (SELECT sr_number, created_date, closed_date
        FROM raw_requests WHERE closed_date IS NOT NULL ORDER BY {_SAMPLE_HASH}, 1, 2, 3 LIMIT 500000)"""),
    "geo_point_sample": _raw(f"{_GEO_SAMPLE} 500000"),
    "geo_sample": _raw(f"{_GEO_SAMPLE} 500"),
    "pending_months": _raw("""SELECT left(created_date, 7) AS ingest_month, count(*) AS cnt FROM raw_requests
        GROUP BY 1 HAVING left(created_date, 7) >= '1996-01'"""),
    "location_key": _requests("""SELECT sr_number, md5(coalesce(trim(street_number), '') || coalesce(trim(street_name), '')
        || coalesce(trim(zip_code), '')) AS location_key FROM requests"""),
    "clean_strings": _raw(f"""SELECT sr_number, created_date, {_SERVICE_NAME} AS service_name,
        {_SERVICE_CODE} AS service_short_code, {_SERVICE_ORIGIN} AS service_origin, {_DEPARTMENT_NAME} AS department_name,
        {_DEPARTMENT_CREATOR} AS created_department, coalesce(nullif(trim(city), ''), 'Chicago') AS city,
        coalesce(nullif(trim(state), ''), 'IL') AS state, coalesce(nullif(trim(zip_code), ''), 'Unknown') AS zip_code,
        nullif(trim(street_direction), '') AS street_direction, nullif(trim(street_name), '') AS street_name,
        nullif(trim(street_type), '') AS street_type, nullif(trim(ward), '') AS ward,
        nullif(trim(police_beat), '') AS police_beat, nullif(trim(precinct), '') AS precinct FROM raw_requests"""),
    "safe_casts": _raw(f"""SELECT sr_number, created_date, {_DATED} AS created_ts,
        TRY_CAST(closed_date AS TIMESTAMP) AS closed_ts, TRY_CAST(left(created_date, 10) AS DATE) AS created_day,
        TRY_CAST(created_hour AS INTEGER) AS created_hour, TRY_CAST(ward AS INTEGER) AS ward,
        TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(x_coordinate AS DOUBLE) AS x_coordinate FROM raw_requests"""),
    "service_category": _rule("sr_type", f"{_CATEGORY} AS service_category"),
    "service_subcategory": _rule("sr_type", f"{_SUBCATEGORY} AS service_subcategory"),
    "service_priority": _rule("sr_type", f"{_PRIORITY} AS priority_level"),
    "service_emergency": _rule("sr_type", f"{_EMERGENCY} AS is_emergency"),
    "service_resolution_days": _rule("sr_type", f"{_DAYS} AS typical_resolution_days"),
    "department_type": _rule("owner_department", f"{_DEPARTMENT_TYPE} AS department_type"),
    "department_hierarchy": _rule("owner_department", f"{_HIERARCHY} AS department_hierarchy"),
    "department_capacity": _rule("owner_department", f"{_CAPACITY} AS agency_capacity"),
    "department_hours": _rule("owner_department", f"{_HOURS} AS operating_hours"),
    "ward_region": _requests(f"""SELECT ward, {_REGION} AS geographic_region, count(*) AS cnt FROM (
        SELECT {_CLEAN_WARD} AS ward, nullif(trim(community_area), '') AS community_area,
               TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude FROM requests)
        GROUP BY ALL"""),
    "ward_cluster": _rule("ward, community_area", f"{_CLUSTER} AS geographic_cluster"),
    "ward_density": _rule("ward", f"{_DENSITY} AS population_density"),
    "ward_income": _rule("ward", f"{_INCOME} AS socioeconomic_level"),
    "infra_age": _rule("electrical_district", f"{_AGE} AS infrastructure_age"),
    "infra_profile": _rule(f"{_E}, {_G}, {_S}", _INFRA_COLUMNS),
    "service_area": _rule("police_district, ward", f"{_AREA} AS service_area"),
    "geo_bbox": _rule(
        "latitude, longitude",
        """coalesce(TRY_CAST(latitude AS DOUBLE) BETWEEN 41.6 AND 42.1
           AND TRY_CAST(longitude AS DOUBLE) BETWEEN -87.9 AND -87.5, false) AS inside_city""",
    ),
    "geo_labels": _rule(
        "community_area, ward, police_district, sanitation_division_days",
        f"""'Community Area ' || nullif(trim(community_area), '') AS community_area_name,
        'Ward ' || CAST({_WARD} AS VARCHAR) AS ward_name, 'Alderman Ward ' || CAST({_WARD} AS VARCHAR) AS alderman_name,
        'Police District ' || police_district AS police_label,
        'Sanitation: ' || sanitation_division_days AS sanitation_label""",
    ),
    "address_completeness": _place_rule(
        f"{_COMPLETENESS} AS address_completeness",
        ("street_address", "street_name", "zip_code", "latitude", "longitude"),
    ),
    "spatial_quality": _place_rule(
        f"{_SCORE} AS spatial_quality_score, {_LOCATED} AS is_geocoded",
        ("street_address", "ward", "latitude", "longitude"),
    ),
    "coordinate_precision": _place_rule(
        f"{_PRECISION} AS coordinate_precision", ("street_address", "street_name", "latitude", "longitude")
    ),
    "month_slice": _fact("SELECT * FROM fact_requests WHERE year(date_id) = 1995 AND month(date_id) = 3"),
    "geo_points": _raw("""SELECT sr_number, sr_type, created_date, latitude, longitude FROM raw_requests
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""),
    "rename_columns": _raw("""SELECT sr_number AS service_request_number, sr_type AS service_request_type, status,
        origin AS how_reported, created_date AS creation_date, closed_date AS completion_date, zip_code, ward,
        police_district, community_area FROM raw_requests"""),
    "distinct_months": _requests(f"""SELECT DISTINCT CAST(year({_DATED}) AS INTEGER) AS "year",
        CAST(month({_DATED}) AS INTEGER) AS "month" FROM requests"""),
    "star_join_service": _with(
        f"SELECT r.sr_number, min(s.service_id) AS service_id FROM requests r LEFT JOIN dim_service s ON {_ON_SERVICE} GROUP BY 1", "dim_service"
    ),
    "star_join_department": _with(
        f"SELECT r.sr_number, min(d.department_id) AS department_id FROM requests r LEFT JOIN dim_department d ON {_ON_DEPARTMENT} GROUP BY 1",
        "dim_department",
    ),
    "star_join_geography": _with(
        f"SELECT r.sr_number, min(g.geography_id) AS geography_id FROM requests r LEFT JOIN dim_geography g ON {_NULLSAFE_GEOGRAPHY} GROUP BY 1",
        "dim_geography",
    ),
    "star_join_infrastructure": _with(
        f"""SELECT r.sr_number, min(i.infrastructure_id) AS infrastructure_id FROM requests r
            LEFT JOIN dim_infrastructure i ON {_NULLSAFE_INFRASTRUCTURE} GROUP BY 1""",
        "dim_infrastructure",
    ),
    "star_join_time": _with(
        f"""SELECT r.sr_number, t.date_id AS created_date_id FROM requests r
            LEFT JOIN dim_time t ON CAST(TRY_CAST(r.created_date AS TIMESTAMP) AS DATE) = t.date_id""",
        "dim_time",
    ),
    "star_join_location": _with(
        f"""SELECT r.sr_number, l.location_id FROM (SELECT sr_number, {_LOCATION_HASH} AS h FROM requests) r
            LEFT JOIN {_FIRST_LOCATIONS} l ON r.h = l.h""",
        "dim_location",
    ),
    "dim_unique": _with(
        """SELECT 'dim_service' AS table_name, service_name AS member_name, min(service_id) AS member_id
           FROM dim_service GROUP BY 2
           UNION ALL SELECT 'dim_department', department_name, min(department_id) FROM dim_department GROUP BY 2
           UNION ALL SELECT 'dim_location', location_key, min(location_id) FROM dim_location GROUP BY 2""",
        "dim_service", "dim_department", "dim_location",
    ),
    "ref_integrity": _with(_REFERENCES, "fact_requests", "dim_time"),
    "top_complaint_types": _raw("""SELECT sr_type, count(*) AS cnt FROM raw_requests GROUP BY 1
        ORDER BY cnt DESC, sr_type NULLS LAST LIMIT 20"""),
    "top_zip": _raw("""SELECT zip_code, count(*) AS cnt FROM raw_requests WHERE zip_code IS NOT NULL GROUP BY 1
        ORDER BY cnt DESC, zip_code LIMIT 10"""),
    "complaints_per_month": _raw("""SELECT strftime(CAST(created_date AS TIMESTAMP), '%Y-%m') AS month, count(*) AS cnt
        FROM raw_requests GROUP BY 1 ORDER BY 1"""),
    "complaints_by_zip": _raw("""SELECT zip_code, count(*) AS cnt FROM raw_requests WHERE zip_code IS NOT NULL GROUP BY 1
        ORDER BY cnt DESC, zip_code"""),
    "duplicate_keys": _raw(
        "SELECT sr_number, count(*) AS cnt FROM raw_requests GROUP BY 1 HAVING count(*) > 1"
    ),
    "top_duplicate_keys": _raw("""SELECT sr_number, count(*) AS cnt FROM raw_requests GROUP BY 1 HAVING count(*) > 1
        ORDER BY cnt DESC, sr_number LIMIT 20"""),
    "duplicate_key_total": _raw("""SELECT count(*) AS duplicated_keys FROM (
        SELECT sr_number FROM raw_requests GROUP BY 1 HAVING count(*) > 1)"""),
    "critical_field_nulls": _requests("""SELECT count(*) AS total_records,
        count(*) FILTER (WHERE coalesce(trim(sr_number), '') = '') AS missing_sr_number,
        count(*) FILTER (WHERE created_date IS NULL) AS missing_created_date,
        count(*) FILTER (WHERE coalesce(trim(sr_type), '') = '') AS missing_sr_type,
        count(*) FILTER (WHERE coalesce(trim(status), '') = '') AS missing_status,
        count(*) FILTER (WHERE coalesce(trim(created_department), '') = '') AS missing_created_dept FROM requests"""),
    "fact_null_checks": _fact(f"SELECT {_NULL_CHECKS} FROM fact_requests"),
    "missing_values": _raw(_per_raw_column("""SELECT '{column}' AS column_name, count(*) - count({column}) AS missing_cnt,
        100.0 * (count(*) - count({column})) / count(*) AS missing_pct""")),
    "dimension_cardinality": _requests(f"""SELECT {_CARDINALITIES},
        count(DISTINCT CASE WHEN x_coordinate IS NULL OR y_coordinate IS NULL THEN 'Unknown'
              ELSE x_coordinate || ',' || y_coordinate END) AS unique_coordinate_pairs,
        count(DISTINCT TRY_CAST(left(created_date, 10) AS DATE)) AS unique_dates,
        count(DISTINCT TRY_CAST(substring(created_date, 12, 2) AS INTEGER)) AS unique_hours FROM requests"""),
    "date_range": _requests(f"""SELECT min({_DATED}) AS earliest_date, max({_DATED}) AS latest_date,
        count(DISTINCT TRY_CAST(left(created_date, 4) AS INTEGER)) AS unique_years,
        count(DISTINCT left(created_date, 7)) AS unique_months FROM requests WHERE {_DATED} IS NOT NULL"""),
    "closure_stats": _raw(f"""SELECT round(avg(h), 6) AS avg_hours, round(min(h), 6) AS min_hours,
        round(max(h), 6) AS max_hours FROM (SELECT {_HOURS_TO_CLOSE} AS h FROM raw_requests WHERE closed_date IS NOT NULL)"""),
    "closure_histogram": _histogram(_HOURS_TO_CLOSE, 100),
    "days_histogram": _histogram(_DAYS_TO_CLOSE, 10),
    "channel_usage": _raw("""SELECT origin, count(*) AS cnt FROM raw_requests WHERE origin IS NOT NULL GROUP BY 1
        ORDER BY cnt DESC, origin"""),
    "weekday_counts": _raw(f"""SELECT w.position, w.weekday, c.cnt FROM (VALUES (1, 'Monday'), (2, 'Tuesday'),
        (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) w(position, weekday)
        LEFT JOIN (SELECT dayname({_DATED}) AS weekday, count(*) AS cnt FROM raw_requests GROUP BY 1) c
        ON c.weekday = w.weekday"""),
    "monthly_type_pivot": _pivot(f"strftime({_DATED}, '%Y-%m')", "month"),
    "season_type_pivot": _pivot(f"({_SEASON.format(m=f'month({_DATED})')})", "season"),
    "season_of_month": _raw(f"""SELECT CAST(month({_DATED}) AS INTEGER) AS "month",
        {_SEASON.format(m=f"month({_DATED})")} AS season, count(*) AS cnt FROM raw_requests GROUP BY 1, 2"""),
    "efficiency_by_type": _raw(f"""SELECT sr_type, round(avg({_DAYS_TO_CLOSE}), 6) AS avg_days_to_close FROM raw_requests
        WHERE sr_type IS NOT NULL GROUP BY 1 ORDER BY 2 NULLS LAST, 1 LIMIT 10"""),
    "days_to_close": _raw(f"SELECT sr_number, created_date, {_DAYS_TO_CLOSE} AS days_to_close FROM raw_requests"),
    "time_features": _raw(f"""SELECT sr_number, created_date, strftime({_DATED}, '%Y-%m') AS year_month,
        dayname({_DATED}) AS weekday, CAST(hour({_DATED}) AS INTEGER) AS "hour" FROM raw_requests"""),
    "table_counts": _with(_COUNTS, *_ALL_TABLES),
    "drop_ratio": _fact(_DROPS),
    "overview": _raw(_per_raw_column("""SELECT {position} AS position, '{column}' AS column_name, '{type}' AS data_type,
        count({column}) AS non_null, count(*) AS n_rows, 39 AS n_columns""")),
    "dedup_requests": _requests("SELECT * EXCLUDE (location) FROM requests"),
    "fact_id_dense": _fact("SELECT fact_id, date_id, sr_number FROM fact_requests"),
    "dim_service": _with("SELECT * FROM dim_service", "dim_service"),
    "dim_department": _with("SELECT * FROM dim_department", "dim_department"),
    "dim_time": _with("SELECT * FROM dim_time", "dim_time"),
    "dim_geography": _with("SELECT * FROM dim_geography", "dim_geography"),
    "dim_infrastructure": _with("SELECT * FROM dim_infrastructure", "dim_infrastructure"),
    "dim_location": _with("SELECT * FROM dim_location", "dim_location"),
    "fact_star": _with("SELECT * FROM fact_star", "fact_star"),
    "fact_requests": _fact("SELECT * FROM fact_requests"),
    "column_validation": _raw(
        _per_raw_column("SELECT '{column}' AS column_name, 'present' AS column_status, count({column}) AS non_null")
    ),
    "validation_report": _with(
        f"""SELECT 'row_count' AS check_name, table_name AS subject, CAST(n_rows AS DOUBLE) AS value FROM ({_COUNTS})
        UNION ALL SELECT 'missing_refs', key_column, CAST(missing_refs AS DOUBLE) FROM ({_REFERENCES})
        UNION ALL SELECT 'null_check', name, CAST(n AS DOUBLE)
            FROM (UNPIVOT (SELECT {_NULL_CHECKS} FROM fact_requests) ON COLUMNS(*) INTO NAME name VALUE n)
        UNION ALL SELECT 'row_drop', name, n FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM ({_DROPS}))
            ON COLUMNS(*) INTO NAME name VALUE n)""",
        *_ALL_TABLES,
    ),
    "dim_profile": _with(_PROFILE, *_DIM_KEYS),
    "calendar_attributes": _raw(f"""SELECT d AS day_id, cnt, {_CALENDAR} FROM (
        SELECT CAST({_DATED} AS DATE) AS d, count(*) AS cnt FROM raw_requests GROUP BY 1)"""),
    "content_hashes": _requests(f"""SELECT sr_number, {_SERVICE_HASH} AS service_hash,
        {_DEPARTMENT_HASH} AS department_hash, {_GEOGRAPHY_HASH} AS geography_hash,
        {_INFRASTRUCTURE_HASH} AS infrastructure_hash, {_LOCATION_HASH} AS location_hash FROM requests"""),
    "feature_table": _with("SELECT * REPLACE (round(hours_to_close, 6) AS hours_to_close) FROM features", "features"),
    "time_split": _with(
        """SELECT sr_number, created_day, is_closed,
           CASE WHEN created_day <= DATE '1999-12-31' THEN 'train' WHEN created_day > DATE '1999-12-31' THEN 'test' END
             AS split FROM features""",
        "features",
    ),
    "model_input": _with(
        """SELECT CASE WHEN created_day <= DATE '1999-12-31' THEN 'train' WHEN created_day > DATE '1999-12-31' THEN 'test' END
             AS split, count(*) AS n_rows, sum(CAST(is_closed AS BIGINT))::BIGINT AS n_closed,
             round(avg(hours_to_close), 4) AS avg_hours_to_close FROM features GROUP BY 1""",
        "features",
    ),
    "reduction_funnel": _requests("""
        SELECT 1 AS step, 'raw' AS stage, count(*) AS n_rows FROM raw_requests
        UNION ALL SELECT 2, 'deduplicated', count(*) FROM requests WHERE NOT duplicate
        UNION ALL SELECT 3, 'closed', count(*) FROM requests WHERE NOT duplicate AND status IN ('Completed', 'Closed')
        UNION ALL SELECT 4, 'non_legacy', count(*) FROM requests
            WHERE NOT duplicate AND status IN ('Completed', 'Closed') AND NOT legacy_record
        UNION ALL SELECT 5, 'parent_merged', count(DISTINCT coalesce(parent_sr_number, sr_number)) FROM requests
            WHERE NOT duplicate AND status IN ('Completed', 'Closed') AND NOT legacy_record
        UNION ALL SELECT 6, 'located', count(DISTINCT coalesce(parent_sr_number, sr_number)) FROM requests
            WHERE NOT duplicate AND status IN ('Completed', 'Closed') AND NOT legacy_record
              AND trim(street_address) <> '' AND TRY_CAST(latitude AS DOUBLE) IS NOT NULL
              AND TRY_CAST(longitude AS DOUBLE) IS NOT NULL"""),
}
