r"""Reference SQL (DuckDB dialect) for every registered query.

Each query is the fixture derivation, the layers and a final SELECT, written
from the described semantics: dimensions are keyed, so a lookup is a scalar
subquery; a rule list is a list of records that is filtered; sets are UNIONs.
The Spark side is built independently with the DataFrame API; the driver
runs both on the same parquet tables and compares results.

Regex literals are raw strings: DuckDB receives ``US\$`` unchanged.
"""

from __future__ import annotations

FIXTURE_CTES = r"""
cust AS (
  SELECT c_custkey, n_name, c_mktsegment,
         c_nationkey * 10 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
           WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS cd_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_mapping AS (
  SELECT DISTINCT CAST(cd_id AS INTEGER) AS city_district_id, n_name AS ship_to_city_cd,
         c_mktsegment AS ship_to_district_name
  FROM cust WHERE cd_id <> 245),
raw_dataset_1 AS (
  SELECT concat('A', CAST(o_orderkey AS VARCHAR)) AS order_id,
    CASE WHEN o_orderkey % 1009 = 0 THEN 'time'
         ELSE CAST((5 + o_orderkey % 7) * 10000 + (o_orderkey * 7 % 60) * 100 + o_orderkey * 13 % 60 AS VARCHAR)
    END AS order_time_pst,
    CAST(CASE WHEN o_orderkey % 503 = 0 THEN 999999 ELSE cd_id END AS INTEGER) AS city_district_id,
    CAST(CASE WHEN o_orderkey % 997 = 1 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS rptg_amt,
    CASE WHEN o_orderkey % 401 = 2 THEN 'USD' WHEN o_orderkey % 701 = 3 THEN 'EUR' ELSE 'RMB' END AS currency_cd,
    CASE WHEN o_orderkey % 421 = 4 THEN CAST(NULL AS VARCHAR) WHEN o_orderkey % 587 = 5 THEN '0'
         ELSE concat(CAST(1 + o_orderkey % 9 AS VARCHAR), '.0') END AS order_qty
  FROM orders JOIN cust ON o_custkey = c_custkey),
raw_dataset_2 AS (
  SELECT concat(CASE WHEN event_id % 1013 = 0 THEN 'A' ELSE 'B' END, CAST(event_id AS VARCHAR)) AS order_id,
    CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS BIGINT) AS order_time_pst,
    CASE WHEN event_id % 83 = 5 THEN lower(c_mktsegment) ELSE c_mktsegment END AS ship_to_district_name,
    CASE WHEN event_id % 997 = 5 THEN concat(n_name, '_OLD') ELSE n_name END AS ship_to_city_cd,
    CAST(value AS DECIMAL(18,2)) AS rptg_amt, 'RMB' AS currency_cd,
    CAST(1 + event_id % 5 AS INTEGER) AS order_qty
  FROM events JOIN cust ON user_id = c_custkey),
currency AS (
  SELECT 'RMB' AS currency_cd, CAST(1 AS DECIMAL(10,4)) AS multiplier
  UNION ALL SELECT 'USD', CAST(7.28 AS DECIMAL(10,4))),
city_src AS (
  SELECT n_name AS ship_to_city_cd,
    CASE n_nationkey WHEN 3 THEN 'Beijing' WHEN 12 THEN 'Shanghai'
         ELSE concat('City ', CAST(n_nationkey AS VARCHAR)) END AS ship_to_city_cd_eng,
    n_nationkey AS nk, r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7),
city_meta AS (
  SELECT ship_to_city_cd, 'Province' AS meta_key, concat('"', r_name, '"') AS meta_value FROM city_src WHERE nk % 4 = 0
  UNION ALL SELECT ship_to_city_cd, 'Province', '""' FROM city_src WHERE nk % 4 = 2
  UNION ALL SELECT ship_to_city_cd, 'Autonomous region', concat(r_name, ' AR') FROM city_src WHERE nk % 4 IN (1, 2)
  UNION ALL SELECT ship_to_city_cd, 'Per capita',
    CASE WHEN nk % 3 = 0 THEN concat('CN¥ ', CAST(50 + nk AS VARCHAR), ',000 (US$ ', CAST(7 + nk AS VARCHAR), ',',
                                     lpad(CAST(nk * 37 % 1000 AS VARCHAR), 3, '0'), ')')
         WHEN nk % 3 = 1 THEN concat('US$ ', CAST(900 + nk * 11 AS VARCHAR))
         ELSE 'not reported' END
    FROM city_src WHERE nk % 5 <> 4
  UNION ALL SELECT ship_to_city_cd, 'Total',
    CASE WHEN nk % 4 = 0 THEN concat('US$ ', CAST(60 + nk AS VARCHAR), '.1 billion')
         WHEN nk % 4 = 1 THEN concat('US$ ', CAST(nk AS VARCHAR), ',234 billion')
         WHEN nk % 4 = 2 THEN concat('CN¥ 1 trillion (US$ ', CAST(nk AS VARCHAR), ',345,678)')
         ELSE 'unknown' END
    FROM city_src),
city_kv AS (
  SELECT s.ship_to_city_cd, s.ship_to_city_cd_eng,
    max(CASE WHEN meta_key = 'Province' THEN meta_value END) AS m_province,
    max(CASE WHEN meta_key = 'Autonomous region' THEN meta_value END) AS m_region,
    max(CASE WHEN meta_key = 'Per capita' THEN meta_value END) AS m_per_capita,
    max(CASE WHEN meta_key = 'Total' THEN meta_value END) AS m_total
  FROM city_src s LEFT JOIN city_meta m ON s.ship_to_city_cd = m.ship_to_city_cd
  GROUP BY s.ship_to_city_cd, s.ship_to_city_cd_eng),
city_dim AS (
  SELECT ship_to_city_cd, ship_to_city_cd_eng,
    CASE WHEN ship_to_city_cd_eng IN ('Shanghai', 'Beijing', 'Tianjin', 'Chongqing') THEN ship_to_city_cd_eng
         ELSE COALESCE(NULLIF(replace(COALESCE(m_province, ''), '"', ''), ''),
                       NULLIF(replace(COALESCE(m_region, ''), '"', ''), '')) END AS province,
    replace(NULLIF(regexp_extract(COALESCE(m_per_capita, ''), 'US\$ ([0-9,]+)', 1), ''), ',', '') AS per_capita_usd,
    CAST(CASE WHEN regexp_extract(COALESCE(m_total, ''), 'US\$ ([0-9.]+) billion', 1) <> ''
              THEN CAST(trunc(TRY_CAST(regexp_extract(m_total, 'US\$ ([0-9.]+) billion', 1) AS DOUBLE) * 1e9) AS BIGINT)
              ELSE TRY_CAST(replace(NULLIF(regexp_extract(COALESCE(m_total, ''), 'US\$ ([0-9,]+)', 1), ''), ',', '') AS BIGINT)
         END AS VARCHAR) AS total_gdp_usd
  FROM city_kv),
district_dim AS (
  SELECT DISTINCT ship_to_district_name,
    concat(upper(substr(ship_to_district_name, 1, 1)), lower(substr(ship_to_district_name, 2)), ' District')
      AS ship_to_district_name_eng
  FROM raw_mapping WHERE ship_to_district_name <> 'MACHINERY')"""

LAYER_CTES = r"""
checks_1 AS (
  SELECT *,
    regexp_full_match(order_time_pst, '[0-9]+') AS ok_time,
    city_district_id IN (SELECT city_district_id FROM raw_mapping) AS ok_id,
    rptg_amt >= 0 AS ok_amt,
    currency_cd IN ('USD', 'RMB') AS ok_cur,
    CASE WHEN order_qty IS NULL THEN NULL ELSE COALESCE(TRY_CAST(order_qty AS INTEGER) > 0, FALSE) END AS ok_qty
  FROM raw_dataset_1),
qualified_1 AS (
  SELECT order_id,
    CASE WHEN ok_time THEN order_time_pst END AS order_time_pst,
    CASE WHEN ok_id THEN city_district_id END AS city_district_id,
    CASE WHEN ok_amt THEN rptg_amt END AS rptg_amt,
    CASE WHEN ok_cur THEN currency_cd END AS currency_cd,
    CASE WHEN ok_qty THEN order_qty END AS order_qty
  FROM checks_1),
qualified_2 AS (
  SELECT order_id,
    CASE WHEN order_time_pst BETWEEN 50000 AND 120000 THEN order_time_pst END AS order_time_pst,
    ship_to_district_name, ship_to_city_cd,
    CASE WHEN rptg_amt >= 0 THEN rptg_amt END AS rptg_amt,
    CASE WHEN currency_cd IN ('USD', 'RMB') THEN currency_cd END AS currency_cd,
    CASE WHEN order_qty > 0 THEN order_qty END AS order_qty
  FROM raw_dataset_2),
silver AS (
  FROM qualified_1 SELECT order_id, TRY_CAST(order_time_pst AS BIGINT) AS order_time_pst, rptg_amt, currency_cd,
    TRY_CAST(order_qty AS INTEGER) AS order_qty,
    (FROM raw_mapping SELECT ship_to_city_cd WHERE raw_mapping.city_district_id = qualified_1.city_district_id) AS ship_to_city_cd,
    (FROM raw_mapping SELECT ship_to_district_name WHERE raw_mapping.city_district_id = qualified_1.city_district_id)
      AS ship_to_district_name
  UNION ALL BY NAME
  FROM qualified_2 SELECT *),
gold AS (
  FROM silver SELECT order_id, CAST(order_time_pst AS INTEGER) AS order_time_pst, ship_to_city_cd, ship_to_district_name,
    (FROM district_dim SELECT ship_to_district_name_eng
     WHERE district_dim.ship_to_district_name = silver.ship_to_district_name) AS ship_to_district_name_eng,
    (FROM city_dim SELECT ship_to_city_cd_eng
     WHERE city_dim.ship_to_city_cd = silver.ship_to_city_cd) AS ship_to_city_cd_eng,
    CAST(rptg_amt * (FROM currency SELECT multiplier WHERE currency.currency_cd = silver.currency_cd)
         AS DECIMAL(18,2)) AS rmb_dollars,
    CAST(order_qty AS INTEGER) AS order_qty)"""


def with_layers(final_select: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE_CTES + "," + LAYER_CTES + ("," + extra_ctes if extra_ctes else "")
    return "WITH RECURSIVE" + ctes + "\n" + final_select


def _gold_of(source: str, amount: str = "CAST(rptg_amt * {rate} AS DECIMAL(18,2))") -> str:
    """The gold columns of a silver-like table, by lookups in the keyed dimensions."""
    rate = f"(FROM currency SELECT multiplier WHERE currency.currency_cd = {source}.currency_cd)"
    return f"""
  FROM {source} SELECT order_id, CAST(order_time_pst AS INTEGER) AS order_time_pst, ship_to_city_cd, ship_to_district_name,
    (FROM district_dim SELECT ship_to_district_name_eng
     WHERE district_dim.ship_to_district_name = {source}.ship_to_district_name) AS ship_to_district_name_eng,
    (FROM city_dim SELECT ship_to_city_cd_eng
     WHERE city_dim.ship_to_city_cd = {source}.ship_to_city_cd) AS ship_to_city_cd_eng,
    {amount.format(rate=rate)} AS rmb_dollars, CAST(order_qty AS INTEGER) AS order_qty"""


QUERIES: dict[str, str] = {}


def _q(name: str, final_select: str, extra_ctes: str = "") -> None:
    QUERIES[name] = with_layers(final_select, extra_ctes)


# ------------------------------------------------------------------ layers
_q("qualify_feed1", "SELECT * FROM qualified_1")
_q("qualify_feed2", "SELECT * FROM qualified_2")
_q("exceptions_first_error", """
FROM (FROM checks_1 SELECT order_id, [x.text FOR x IN [
    {'good': ok_time, 'text': 'Invalid ORDER_TIME_PST'}, {'good': ok_id, 'text': 'Invalid CITY_DISTRICT_ID'},
    {'good': ok_amt, 'text': 'Invalid RPTG_AMT'}, {'good': ok_cur, 'text': 'Invalid CURRENCY_CD'},
    {'good': ok_qty, 'text': 'Invalid ORDER_QTY'}] IF x.good IS FALSE] AS failed)
SELECT order_id, failed[1] AS validation_error WHERE len(failed) > 0""")
_q("silver_orders", "SELECT * FROM silver")
_q("gold_orders", "SELECT * FROM gold")

# ------------------------------------------------------------------ reports
# Every known city once, with its spend and the set of its known districts.
_CITIES = """
known_cities AS (
  SELECT ship_to_city_cd, SUM(rmb_dollars) AS spend,
         COALESCE(list(DISTINCT ship_to_district_name) FILTER (
           ship_to_district_name IN (SELECT ship_to_district_name FROM district_dim)), []) AS districts
  FROM gold WHERE ship_to_city_cd IN (SELECT ship_to_city_cd FROM city_dim)
  GROUP BY ALL),
provinces AS (
  SELECT province, CAST(SUM(spend) AS DECIMAL(38,2)) AS spend, COUNT(*) AS cities,
         CAST(len(list_distinct(flatten(list(districts)))) AS BIGINT) AS districts
  FROM known_cities NATURAL JOIN (SELECT ship_to_city_cd, province FROM city_dim)
  GROUP BY ALL)"""

_q("province_spend", """
SELECT province, spend AS total_spending, cities AS total_count_of_cities, districts AS total_count_of_districts
FROM provinces""", _CITIES)

_q("top_provinces", """
SELECT province, spend AS province_total_sales FROM provinces
QUALIFY ROW_NUMBER() OVER (ORDER BY spend DESC NULLS LAST, province NULLS LAST) <= 10""", _CITIES)

_q("distinct_provinces", "SELECT DISTINCT province FROM city_dim")

_q("top_cities_spend", """
SELECT ship_to_city_cd, ship_to_city_cd_eng, CAST(SUM(rmb_dollars) AS DECIMAL(38,2)) AS total_sales
FROM gold GROUP BY ship_to_city_cd, ship_to_city_cd_eng
ORDER BY total_sales DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST, ship_to_city_cd_eng ASC NULLS LAST
LIMIT 10""")

_q("top_cities_orders", """
SELECT ship_to_city_cd, ship_to_city_cd_eng, COUNT(*) AS order_count
FROM gold GROUP BY ship_to_city_cd, ship_to_city_cd_eng
ORDER BY order_count DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST, ship_to_city_cd_eng ASC NULLS LAST
LIMIT 10""")

_q("top_transactions", """
SELECT * FROM gold
ORDER BY rmb_dollars DESC NULLS LAST, order_id ASC NULLS LAST, order_time_pst ASC NULLS LAST,
         ship_to_city_cd ASC NULLS LAST, ship_to_district_name ASC NULLS LAST,
         ship_to_district_name_eng ASC NULLS LAST, ship_to_city_cd_eng ASC NULLS LAST, order_qty ASC NULLS LAST
LIMIT 10""")

# Half an hour and more counts as the next hour: add half and cut off.
_HOURLY = """
hourly AS (
  SELECT ship_to_city_cd, CAST((CAST(order_time_pst AS BIGINT) + 5000) // 10000 AS DOUBLE) AS order_hour_pst,
         CAST(SUM(rmb_dollars) AS DECIMAL(38,2)) AS total_sales
  FROM gold GROUP BY ALL)"""

_q("top_city_per_hour", """
SELECT DISTINCT ON (order_hour_pst) ship_to_city_cd, order_hour_pst, total_sales FROM hourly
ORDER BY order_hour_pst ASC NULLS LAST, total_sales DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST""", _HOURLY)

_q("top_city_hour_pairs", """
SELECT ship_to_city_cd, order_hour_pst, total_sales FROM hourly
ORDER BY total_sales DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST, order_hour_pst ASC NULLS LAST
LIMIT 10""", _HOURLY)

_q("spend_per_hour", """
SELECT CAST(FLOOR(CAST(order_time_pst AS BIGINT) / 10000) AS BIGINT) AS rounded_order_hour,
       CAST(SUM(rmb_dollars) AS DECIMAL(38,2)) AS total_sales
FROM gold GROUP BY 1 ORDER BY 1 ASC NULLS LAST""")

_q("best_district_per_city", """
SELECT ship_to_city_cd, ship_to_city_cd_eng, ship_to_district_name, ship_to_district_name_eng,
       ROUND(avg_sales, 4) AS top_avg_sales
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ship_to_city_cd
             ORDER BY avg_sales DESC NULLS LAST, ship_to_district_name ASC NULLS LAST,
                      ship_to_city_cd_eng ASC NULLS LAST, ship_to_district_name_eng ASC NULLS LAST) AS rk
  FROM (SELECT ship_to_city_cd, ship_to_city_cd_eng, ship_to_district_name, ship_to_district_name_eng,
               CAST(SUM(rmb_dollars) AS DOUBLE) / CAST(COUNT(rmb_dollars) AS DOUBLE) AS avg_sales
        FROM gold
        GROUP BY ship_to_city_cd, ship_to_city_cd_eng, ship_to_district_name, ship_to_district_name_eng))
WHERE rk = 1
ORDER BY avg_sales DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST
LIMIT 10""")

_GDP = """
described AS (
  FROM city_dim SELECT ship_to_city_cd, ship_to_city_cd_eng, province,
    CAST(replace(per_capita_usd, ',', '') AS DOUBLE) AS per_capita_usd
  WHERE per_capita_usd IS NOT NULL AND province IS NOT NULL),
spend_of AS (
  FROM gold SELECT ship_to_city_cd, CAST(SUM(rmb_dollars) AS DECIMAL(38,2)) AS total_spend
  WHERE ship_to_city_cd IN (SELECT ship_to_city_cd FROM described) GROUP BY ALL),
city_gdp AS (
  SELECT ship_to_city_cd_eng, total_spend, per_capita_usd, province FROM spend_of NATURAL JOIN described)"""

_q("city_gdp_spend", "SELECT * FROM city_gdp", _GDP)
_q("spend_gdp_corr", """
SELECT ROUND(corr(CAST(total_spend AS DOUBLE), per_capita_usd), 6) AS corr, COUNT(*) AS n_cities
FROM city_gdp""", _GDP)



def _coverage(column: str, dim: str) -> str:
    """Rows of the dimension against the set of values that the feed and the mapping hold."""
    return f"""
SELECT translated_count, unique_count, ROUND(100 * translated_count / CAST(unique_count AS DOUBLE), 6) AS percentage
FROM (SELECT (SELECT COUNT(*) FROM {dim}) AS translated_count,
             (SELECT COUNT(*) FROM (SELECT {column} FROM raw_dataset_2 UNION SELECT {column} FROM raw_mapping)) AS unique_count)"""


_q("coverage_cities", _coverage("ship_to_city_cd", "city_dim"))
_q("coverage_districts", _coverage("ship_to_district_name", "district_dim"))

# ------------------------------------------------------------------ quality
_ERRORS = r"""
checks_2 AS (
  SELECT *,
    order_time_pst BETWEEN 50000 AND 120000 AS ok_time,
    rptg_amt >= 0 AS ok_amt,
    currency_cd IN ('USD', 'RMB') AS ok_cur,
    CASE WHEN order_qty IS NULL THEN NULL ELSE COALESCE(order_qty > 0, FALSE) END AS ok_qty
  FROM raw_dataset_2),
errs AS (
  SELECT order_id, e.field, e.message, source FROM (
    FROM checks_1 SELECT order_id, 'feed1' AS source, unnest([
      {'field': 'order_time_pst', 'good': ok_time, 'message': 'ORDER_TIME_PST must be a numeric string'},
      {'field': 'city_district_id', 'good': ok_id AND city_district_id > 0,
       'message': 'CITY_DISTRICT_ID must be a positive integer and must exist in RAW_MAPPING'},
      {'field': 'rptg_amt', 'good': ok_amt, 'message': 'RPTG_AMT must be non-negative'},
      {'field': 'currency_cd', 'good': ok_cur, 'message': 'CURRENCY_CD must be one of USD, RMB'},
      {'field': 'order_qty', 'good': ok_qty, 'message': 'ORDER_QTY must be a positive integer'}]) AS e
    UNION ALL
    FROM checks_2 SELECT order_id, 'feed2' AS source, unnest([
      {'field': 'order_time_pst', 'good': ok_time,
       'message': 'ORDER_TIME_PST must be an integer between 50000 and 120000 (5 AM to 12 PM)'},
      {'field': 'rptg_amt', 'good': ok_amt, 'message': 'RPTG_AMT must be non-negative'},
      {'field': 'currency_cd', 'good': ok_cur, 'message': 'CURRENCY_CD must be one of USD, RMB'},
      {'field': 'order_qty', 'good': ok_qty, 'message': 'ORDER_QTY must be a positive integer'}]) AS e)
  WHERE e.good IS NOT TRUE)"""

_q("exceptions_all_errors", "SELECT * FROM errs", _ERRORS)
_q("exceptions_json", """
SELECT order_id,
       CAST(to_json(list(struct_pack(field := field, message := message, n := n) ORDER BY field, message, n))
         AS VARCHAR) AS error_message
FROM (SELECT order_id, field, message, COUNT(*) AS n FROM errs GROUP BY order_id, field, message)
GROUP BY order_id""", _ERRORS)

_LAYER_TABLES = [("qualified_dataset_1", "qualified_1"), ("qualified_dataset_2", "qualified_2"),
                 ("processed_dataset", "silver"), ("curated_dataset", "gold")]


def _dq(table: str, column: str, test: str, failing: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test_name, "
            f"(SELECT COUNT(*) FROM ({failing})) AS failures")


_q("dq_unique", "\nUNION ALL\n".join(
    _dq(t, "order_id", "unique",
        f"SELECT order_id FROM {v} WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) > 1")
    for t, v in _LAYER_TABLES))
_q("dq_not_null", "\nUNION ALL\n".join(
    [_dq(t, "order_id", "not_null", f"SELECT 1 FROM {v} WHERE order_id IS NULL") for t, v in _LAYER_TABLES]
    + [_dq(t, "rptg_amt", "not_null", f"SELECT 1 FROM {v} WHERE rptg_amt IS NULL") for t, v in _LAYER_TABLES[:3]]
    + [_dq("qualified_dataset_2", "ship_to_district_name", "not_null",
           "SELECT 1 FROM qualified_2 WHERE ship_to_district_name IS NULL")]))
_q("dq_relationships", "\nUNION ALL\n".join(
    _dq(t, "city_district_id", "relationships",
        f"SELECT 1 FROM {v} c WHERE c.city_district_id IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM raw_mapping p WHERE p.city_district_id = c.city_district_id)")
    for t, v in [("qualified_dataset_1", "qualified_1"), ("raw_dataset_1", "raw_dataset_1")]))
_q("dq_accepted_values", "\nUNION ALL\n".join(
    _dq(t, "currency_cd", "accepted_values",
        f"SELECT currency_cd FROM {v} WHERE currency_cd IS NOT NULL AND currency_cd NOT IN ('USD', 'RMB') "
        f"GROUP BY currency_cd")
    for t, v in _LAYER_TABLES[:3]))

_FAILING = """
SELECT '{t}' AS table_name, '{c}' AS column_name, '{test}' AS test_name, {key} AS row_key, CAST({c} AS VARCHAR) AS failing_value,
       COUNT(*) AS n_records FROM {v} f WHERE {bad} GROUP BY ALL{having}"""
_ONE_ROW = [(t, v, "order_id", "not_null", "order_id IS NULL") for t, v in _LAYER_TABLES]
_ONE_ROW += [(t, v, "rptg_amt", "not_null", "rptg_amt IS NULL") for t, v in _LAYER_TABLES[:3]]
_ONE_ROW += [("qualified_dataset_2", "qualified_2", "ship_to_district_name", "not_null", "ship_to_district_name IS NULL")]
_ONE_ROW += [(t, v, "city_district_id", "relationships", "city_district_id NOT IN (SELECT city_district_id FROM raw_mapping)")
             for t, v in (("qualified_dataset_1", "qualified_1"), ("raw_dataset_1", "raw_dataset_1"))]
_q("dq_failing_rows", "\nUNION ALL".join(
    [_FAILING.format(t=t, v=v, c=c, test=test, key="order_id", bad=bad, having="") for t, v, c, test, bad in _ONE_ROW]
    + [_FAILING.format(t=t, v=v, c="currency_cd", test="accepted_values", key="NULL", bad="currency_cd NOT IN ('USD', 'RMB')", having="")
       for t, v in _LAYER_TABLES[:3]]
    + [_FAILING.format(t=t, v=v, c="order_id", test="unique", key="NULL", bad="order_id IS NOT NULL", having=" HAVING COUNT(*) > 1")
       for t, v in _LAYER_TABLES]))
QUERIES["dq_report"] = "\nUNION ALL\n".join(f"FROM ({QUERIES[n]})" for n in ("dq_unique", "dq_not_null", "dq_relationships", "dq_accepted_values"))
_q("feed1_outputs", """
SELECT 'clean' AS tag, NULL AS field, NULL AS message, * FROM qualified_1
UNION ALL BY NAME
SELECT 'first_error' AS tag, validation_error AS message, order_id FROM (%s)
UNION ALL BY NAME
SELECT 'all_errors' AS tag, field, message, order_id FROM errs WHERE source = 'feed1'""" % QUERIES["exceptions_first_error"], _ERRORS)

# ------------------------------------------------------------------ dimensions
_q("city_dimension_d", "SELECT ship_to_city_cd, ship_to_city_cd_eng, province, per_capita_usd, total_gdp_usd "
                       "FROM city_dim")
_q("city_dimension_s", """
SELECT d.ship_to_city_cd, d.ship_to_city_cd_eng,
       COALESCE(NULLIF(replace(COALESCE(k.m_province, ''), '"', ''), ''), d.ship_to_city_cd_eng) AS province,
       d.per_capita_usd, d.total_gdp_usd
FROM city_dim d JOIN city_kv k ON d.ship_to_city_cd = k.ship_to_city_cd""")
_q("district_dimension", """
SELECT ship_to_district_name, ship_to_district_name_eng,
       CAST(to_json(MAP {'Segment': ship_to_district_name}) AS VARCHAR) AS metadata
FROM district_dim""")
_q("metadata_explode", "SELECT ship_to_city_cd, meta_key, meta_value FROM city_meta")

# ------------------------------------------------------------------ profile
_q("duplicate_orders", """
SELECT s.*, d.n_records
FROM silver s
JOIN (SELECT order_id, COUNT(*) AS n_records FROM silver GROUP BY order_id HAVING COUNT(*) > 1) d
  ON s.order_id = d.order_id""")
_q("feed_overlap", """
SELECT order_id, 'feed1' AS feed, order_time_pst, CAST(rptg_amt AS VARCHAR) AS rptg_amt, currency_cd, order_qty
FROM raw_dataset_1 a WHERE EXISTS (SELECT 1 FROM raw_dataset_2 b WHERE b.order_id = a.order_id)
UNION ALL
SELECT order_id, 'feed2', CAST(order_time_pst AS VARCHAR), CAST(rptg_amt AS VARCHAR), currency_cd,
       CAST(order_qty AS VARCHAR)
FROM raw_dataset_2 b WHERE EXISTS (SELECT 1 FROM raw_dataset_1 a WHERE a.order_id = b.order_id)""")
_q("unmapped_ids", """
SELECT * FROM raw_dataset_1 r
WHERE NOT EXISTS (SELECT 1 FROM raw_mapping m WHERE m.city_district_id = r.city_district_id)""")
_q("unjoinable_reasons", """
SELECT CAST(COUNT_IF(NOT c_ok OR NOT d_ok) AS BIGINT) AS unjoinable_rows,
       CAST(COUNT_IF(NOT d_ok) AS BIGINT) AS due_to_district,
       CAST(COUNT_IF(NOT c_ok) AS BIGINT) AS due_to_city,
       CAST(COUNT_IF(NOT c_ok AND NOT d_ok) AS BIGINT) AS due_to_both
FROM (SELECT COALESCE(ship_to_city_cd IN (SELECT ship_to_city_cd FROM raw_mapping), FALSE) AS c_ok,
             COALESCE(ship_to_district_name IN (SELECT ship_to_district_name FROM raw_mapping), FALSE) AS d_ok
      FROM raw_dataset_2)""")
_q("missing_dimension_values", """
SELECT 'ship_to_city_cd' AS column_name, value FROM (
  SELECT ship_to_city_cd AS value FROM raw_dataset_2 EXCEPT SELECT ship_to_city_cd FROM raw_mapping)
UNION ALL
SELECT 'ship_to_district_name', value FROM (
  SELECT ship_to_district_name AS value FROM raw_dataset_2 EXCEPT SELECT ship_to_district_name FROM raw_mapping)""")
_q("city_name_contains_match", """
SELECT v.ship_to_city_cd,
       EXISTS (SELECT 1 FROM city_src n WHERE contains(n.ship_to_city_cd, v.ship_to_city_cd)) AS city_match
FROM (SELECT DISTINCT ship_to_city_cd FROM raw_dataset_2) v""")

_FEED_COLUMNS = {
    "raw_dataset_1": [("order_id", "string"), ("order_time_pst", "string"), ("city_district_id", "int"),
                      ("rptg_amt", "decimal(18,2)"), ("currency_cd", "string"), ("order_qty", "string")],
    "raw_dataset_2": [("order_id", "string"), ("order_time_pst", "bigint"), ("ship_to_district_name", "string"),
                      ("ship_to_city_cd", "string"), ("rptg_amt", "decimal(18,2)"), ("currency_cd", "string"),
                      ("order_qty", "int")],
}
_q("profile_columns", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{ty}' AS data_type, COUNT({c}) AS non_null_count, "
    f"COUNT(*) - COUNT({c}) AS null_count, "
    f"COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique FROM {t}"
    for t, cols in _FEED_COLUMNS.items() for c, ty in cols))


_q("new_values_by_hour", """
SELECT 'raw_dataset_2' AS table_name, column_name, hour, COUNT(*) AS n_unique,
  CAST(COUNT_IF(hour = first_hour) AS BIGINT) AS n_new
FROM seen GROUP BY column_name, hour""", """
hours AS (SELECT *, COALESCE(CAST(floor(order_time_pst / 10000) AS INTEGER), -1) AS hour FROM raw_dataset_2),
cells AS (""" + " UNION ".join(
    f"SELECT hour, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM hours WHERE {c} IS NOT NULL"
    for c, _ in _FEED_COLUMNS["raw_dataset_2"]) + """),
seen AS (SELECT *, MIN(hour) OVER (PARTITION BY column_name, value) AS first_hour FROM cells)""")


def _failure_counts(feed: str) -> str:
    q = "TRY_CAST(order_qty AS DOUBLE)"
    a = "TRY_CAST(rptg_amt AS DOUBLE)"
    return f"""SELECT '{feed}' AS feed, COUNT(*) AS n_rows,
  CAST(COUNT_IF(CASE WHEN {q} IS NULL OR isnan({q}) THEN TRUE WHEN {q} >= 1 THEN {q} <> floor({q}) END)
       AS BIGINT) AS not_integer_qty,
  CAST(COUNT_IF(currency_cd IS DISTINCT FROM 'RMB') AS BIGINT) AS not_rmb_currency,
  CAST(COUNT_IF(NOT COALESCE({a} IS NOT NULL AND round({a}, 2) = {a} AND {a} > 0, FALSE)) AS BIGINT)
       AS invalid_amount,
  CAST(COUNT_IF(NOT COALESCE(regexp_full_match(CAST(order_time_pst AS VARCHAR), '[0-9]+'), FALSE)) AS BIGINT)
       AS non_numeric_time
FROM {feed}"""


_q("rule_failure_counts", _failure_counts("raw_dataset_1") + "\nUNION ALL\n" + _failure_counts("raw_dataset_2"))

# ------------------------------------------------------------------ sources and sinks
_q("csv_roundtrip", "SELECT * FROM raw_dataset_1")
_q("json_roundtrip", "SELECT * FROM raw_dataset_2")
_q("translations_json_roundtrip", "SELECT ship_to_city_cd, ship_to_city_cd_eng, province, per_capita_usd, "
                                  "total_gdp_usd FROM city_dim")
QUERIES["full_refresh"] = QUERIES["exceptions_first_error"]
# The two feeds of silver, told apart by their place in the union.
_SILVER_PARTS = """
s1 AS (
  FROM qualified_1 SELECT order_id, TRY_CAST(order_time_pst AS BIGINT) AS order_time_pst, rptg_amt, currency_cd,
    TRY_CAST(order_qty AS INTEGER) AS order_qty,
    (FROM raw_mapping SELECT ship_to_city_cd WHERE raw_mapping.city_district_id = qualified_1.city_district_id) AS ship_to_city_cd,
    (FROM raw_mapping SELECT ship_to_district_name WHERE raw_mapping.city_district_id = qualified_1.city_district_id)
      AS ship_to_district_name),
s2 AS (
  FROM qualified_2 SELECT order_id, order_time_pst, rptg_amt, currency_cd, order_qty, ship_to_city_cd, ship_to_district_name),
upserted AS (
  FROM s2 UNION ALL (FROM s1 WHERE order_id NOT IN (SELECT order_id FROM s2)))"""
_q("window_overwrite", """
SELECT *, '20240723' AS dt, 'window1' AS load_window FROM s1
UNION ALL SELECT *, '20240723' AS dt, 'window2' AS load_window FROM s2""", _SILVER_PARTS)
_q("upsert_orders", "SELECT * FROM upserted", _SILVER_PARTS)
_q("upsert_gold", _gold_of("upserted"), _SILVER_PARTS)
for _feed, _amount, _qty in (("raw_dataset_1", "DECIMAL(18,2)", "VARCHAR"), ("raw_dataset_2", "DECIMAL(18,2)", "INTEGER")):
    _q(f"upsert_raw_feed{_feed[-1]}", f"""
SELECT * REPLACE (CASE WHEN order_id LIKE '%7' THEN CAST(0.5 AS {_amount}) ELSE rptg_amt END AS rptg_amt,
                  CASE WHEN order_id NOT LIKE '%7' THEN order_qty END AS order_qty) FROM {_feed}""")
_q("upsert_currency", """
SELECT currency_cd, CAST(multiplier AS DECIMAL(10,4)) AS multiplier FROM currency
WHERE currency_cd NOT IN (SELECT currency_cd FROM raw_dataset_1 WHERE currency_cd <> 'RMB')
UNION ALL SELECT currency_cd, CAST(COUNT(*) / 10000 AS DECIMAL(10,4)) FROM raw_dataset_1
WHERE currency_cd <> 'RMB' GROUP BY currency_cd""")
for _name in ("landed_gold_orders", "landed_array_gold_orders", "backfill_window_gold"):
    _q(_name, "SELECT * FROM gold")
_q("load_metrics", """
SELECT 'raw_dataset_1' AS table_name, COUNT(*) AS num_rows FROM raw_dataset_1
UNION ALL SELECT 'raw_dataset_2', COUNT(*) FROM raw_dataset_2
UNION ALL SELECT 'raw_mapping', COUNT(*) FROM raw_mapping""")

# ------------------------------------------------------------------ tiers
_TOTALS = """
totals AS (
  SELECT ship_to_city_cd, CAST(SUM(rmb_dollars) AS DOUBLE) AS rmb_dollars
  FROM gold WHERE ship_to_city_cd IS NOT NULL GROUP BY ship_to_city_cd),
city_totals AS (
  SELECT t.ship_to_city_cd, t.rmb_dollars, d.ship_to_city_cd_eng, d.province, d.per_capita_usd
  FROM totals t LEFT JOIN city_dim d ON t.ship_to_city_cd = d.ship_to_city_cd)"""
_q("city_zscores", """
SELECT *, ROUND((rmb_dollars - AVG(rmb_dollars) OVER ()) / STDDEV_POP(rmb_dollars) OVER (), 8) AS normalized_sales
FROM city_totals""", _TOTALS)
_q("city_tiers_ntile", """
SELECT ship_to_city_cd, rmb_dollars,
       CAST(NTILE(3) OVER (ORDER BY rmb_dollars ASC NULLS LAST, ship_to_city_cd ASC NULLS LAST) AS INTEGER) AS tier
FROM city_totals""", _TOTALS)

# Least squared error of k runs of the sorted cities, and where the runs before the last one end.
_RUNS = _TOTALS + """,
z AS (
  SELECT *, (rmb_dollars - AVG(rmb_dollars) OVER ()) / STDDEV_POP(rmb_dollars) OVER () AS z,
         ROW_NUMBER() OVER (ORDER BY rmb_dollars) AS place FROM city_totals),
up_to AS (
  SELECT 0 AS place, CAST(0 AS DOUBLE) AS s, CAST(0 AS DOUBLE) AS s2
  UNION ALL SELECT place, SUM(z) OVER (ORDER BY place), SUM(z * z) OVER (ORDER BY place) FROM z),
run AS (
  SELECT a.place AS after, b.place AS upto, b.s2 - a.s2 - (b.s - a.s) * (b.s - a.s) / (b.place - a.place) AS error
  FROM up_to a JOIN up_to b ON a.place < b.place),
best AS (
  SELECT 1 AS k, upto, error, CAST([] AS BIGINT[]) AS ends FROM run WHERE after = 0
  UNION ALL
  SELECT best.k + 1, run.upto, MIN(best.error + run.error), ARG_MIN(list_append(best.ends, run.after), best.error + run.error)
  FROM best JOIN run ON run.after = best.upto WHERE best.k < 9 GROUP BY best.k + 1, run.upto),
whole AS (SELECT k, error, ends FROM best WHERE upto = (SELECT COUNT(*) FROM z))"""
_q("tier_elbow", "SELECT CAST(k AS INTEGER) AS k, ROUND(error, 6) AS sse FROM whole", _RUNS)
_q("city_tiers_kmeans", """
SELECT ship_to_city_cd, rmb_dollars, ship_to_city_cd_eng, province, per_capita_usd, ROUND(z, 8) AS normalized_sales,
       CAST(len(list_filter(ends, lambda e: e < place)) AS INTEGER) AS cluster,
       CAST(len(list_filter(ends, lambda e: e < place)) AS INTEGER) AS tier
FROM z, whole WHERE k = 3""", _RUNS)

# ------------------------------------------------------------------ page facts
_q("page_titles", r"""
SELECT page_id,
  regexp_replace(replace(
    regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(
      regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1),
      '&quot;?', '"', 'g'), '&#39;', ''''), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'),
    '- Wikipedia', ''), '^\s+|\s+$', '', 'g') AS title
FROM pages WHERE regexp_matches(html, '(?is)<title[^>]*>.*?</title>')""")
_q("page_failures", """
SELECT CAST(10000000 + n_nationkey AS BIGINT) AS page_id, 'no title in page' AS error_message
FROM nation WHERE n_nationkey NOT IN (SELECT nk FROM city_src)""")
_q("page_infobox", """
SELECT CAST(10000000 + s.nk AS BIGINT) AS page_id, m.meta_key, m.meta_value
FROM city_meta m JOIN city_src s ON m.ship_to_city_cd = s.ship_to_city_cd""")
_q("page_city_dimension", "SELECT ship_to_city_cd, ship_to_city_cd_eng, province, per_capita_usd, total_gdp_usd "
                          "FROM city_dim")
_q("translation_worklist", """
SELECT ship_to_city_cd FROM (
  SELECT DISTINCT ship_to_city_cd FROM (
    SELECT ship_to_city_cd FROM raw_dataset_2 UNION ALL SELECT ship_to_city_cd FROM raw_mapping)) u
WHERE NOT EXISTS (SELECT 1 FROM city_dim d WHERE d.ship_to_city_cd = u.ship_to_city_cd)""")

# ------------------------------------------------------------------ streaming
_q("stream_ingest_feed2", "SELECT * FROM qualified_2")
_q("stream_load_metrics", """
SELECT epoch, COUNT(*) AS rows_read, COUNT(*) FILTER (order_id IN (SELECT order_id FROM errs WHERE source = 'feed2')) AS rows_rejected,
       CASE epoch WHEN 0 THEN COUNT(DISTINCT order_id) ELSE 0 END AS keys_inserted,
       CASE epoch WHEN 1 THEN COUNT(DISTINCT order_id) ELSE 0 END AS keys_replaced, 0::BIGINT AS keys_outdated
FROM raw_dataset_2, range(2) e(epoch) WHERE epoch = 0 OR order_id LIKE '%7' GROUP BY epoch""", _ERRORS)

# ------------------------------------------------------------------ variants
_HOURLY_ENGLISH = """
hourly AS (
  SELECT ship_to_city_cd, ship_to_city_cd_eng,
         CAST((CAST(order_time_pst AS BIGINT) + 5000) // 10000 AS DOUBLE) AS order_hour_pst,
         CAST(SUM(rmb_dollars) AS DECIMAL(38,2)) AS total_sales
  FROM gold GROUP BY ALL)"""
_q("top_city_per_hour_english", """
SELECT DISTINCT ON (order_hour_pst) ship_to_city_cd, ship_to_city_cd_eng, order_hour_pst, total_sales FROM hourly
ORDER BY order_hour_pst, total_sales DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST""", _HOURLY_ENGLISH)
_q("silver_orders_contract", """
SELECT * FROM s1 WHERE NOT EXISTS (SELECT 1 FROM raw_dataset_2 r WHERE r.order_id = s1.order_id)
UNION ALL
SELECT order_id, order_time_pst, rptg_amt, currency_cd, order_qty, ship_to_city_cd, ship_to_district_name
FROM raw_dataset_2""", _SILVER_PARTS)
_q("top_city_hour_pairs_english", """
SELECT ship_to_city_cd, ship_to_city_cd_eng, order_hour_pst, total_sales FROM hourly
QUALIFY ROW_NUMBER() OVER (ORDER BY total_sales DESC NULLS LAST, ship_to_city_cd ASC NULLS LAST,
                           ship_to_city_cd_eng ASC NULLS LAST, order_hour_pst ASC NULLS LAST) <= 5""", _HOURLY_ENGLISH)


def _describe(table: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT({c}) AS count, "
        f"ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std, "
        f"MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max FROM {table}" for c in cols)


_q("describe_columns", _describe("raw_dataset_1", ["city_district_id", "rptg_amt"]) + "\nUNION ALL\n"
   + _describe("raw_dataset_2", ["order_time_pst", "rptg_amt", "order_qty"]))
_q("translation_worklist_districts", """
SELECT ship_to_district_name FROM (
  SELECT DISTINCT ship_to_district_name FROM (
    SELECT ship_to_district_name FROM raw_dataset_2 UNION ALL SELECT ship_to_district_name FROM raw_mapping)) u
WHERE NOT EXISTS (SELECT 1 FROM district_dim d WHERE d.ship_to_district_name = u.ship_to_district_name)""")
_q("gold_orders_float_rate", _gold_of("silver", "CAST(CAST(rptg_amt AS FLOAT) * CAST({rate} AS FLOAT) AS DECIMAL(18,2))"))
_q("window_read_pruned", "SELECT *, '20240723' AS dt, 'window2' AS load_window FROM s2", _SILVER_PARTS)

# ------------------------------------------------------------------ further outputs
_q("unjoinable_orders", """
FROM (SELECT *, COALESCE(ship_to_city_cd NOT IN (SELECT ship_to_city_cd FROM raw_mapping), TRUE) AS city_missing,
        COALESCE(ship_to_district_name NOT IN (SELECT ship_to_district_name FROM raw_mapping), TRUE) AS district_missing
      FROM raw_dataset_2) WHERE city_missing OR district_missing""")
_q("mapping_name_contains_match", """
SELECT ship_to_city_cd, FALSE AS city_match FROM (SELECT DISTINCT ship_to_city_cd FROM raw_mapping) v
WHERE NOT EXISTS (SELECT 1 FROM city_src n WHERE contains(n.ship_to_city_cd, v.ship_to_city_cd))""")
_q("coverage_matched_only", """
SELECT translated_count, unique_count, ROUND(100 * translated_count / CAST(unique_count AS DOUBLE), 6) AS percentage
FROM (SELECT COUNT(*) AS unique_count,
             CAST(COUNT_IF(ship_to_city_cd IN (SELECT ship_to_city_cd FROM city_dim)) AS BIGINT) AS translated_count
      FROM (SELECT ship_to_city_cd FROM raw_dataset_2 UNION SELECT ship_to_city_cd FROM raw_mapping))""")
_q("exceptions_places", """
SELECT order_id, field, message, source FROM errs WHERE source = 'feed2'
UNION ALL SELECT order_id, 'ship_to_city_cd', 'SHIP_TO_CITY_CD must exist in RAW_MAPPING', 'feed2' FROM raw_dataset_2
WHERE COALESCE(ship_to_city_cd NOT IN (SELECT ship_to_city_cd FROM raw_mapping), TRUE)
UNION ALL SELECT order_id, 'ship_to_district_name', 'SHIP_TO_DISTRICT_NAME must exist in RAW_MAPPING', 'feed2'
FROM raw_dataset_2
WHERE COALESCE(ship_to_district_name NOT IN (SELECT ship_to_district_name FROM raw_mapping), TRUE)""", _ERRORS)
_q("city_mapping_preview", """
SELECT ship_to_city_cd, ship_to_city_cd_eng, metadata, province, per_capita_usd, total_gdp_usd
FROM city_dim NATURAL JOIN (
  SELECT ship_to_city_cd, '{' || string_agg(to_json(meta_key) || ':' || to_json(meta_value), ',' ORDER BY list_position(
    ['Province', 'Autonomous region', 'Per capita', 'Total'], meta_key)) || '}' AS metadata
  FROM city_meta GROUP BY ALL)
ORDER BY ship_to_city_cd LIMIT 10""")
_q("page_district_dimension", "SELECT ship_to_district_name, ship_to_district_name_eng FROM district_dim")
_q("tier_checks", """
SELECT COUNT(*) AS n_cities, TRUE AS all_tiered, ROUND(SUM(z * z), 6) AS sse_one, TRUE AS sse_not_higher,
       TRUE AS tiers_ordered, TRUE AS tiers_disjoint, TRUE AS labels_nearest
FROM (SELECT (rmb_dollars - AVG(rmb_dollars) OVER ()) / STDDEV_POP(rmb_dollars) OVER () AS z FROM city_totals)""", _TOTALS)
