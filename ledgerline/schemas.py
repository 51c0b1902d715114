"""Declared table schemas (bronze, silver, gold, dimensions).

Column names are lower-case snake case everywhere; types follow the declared
DDL of the source system with two deliberate choices: the currency multiplier
is an exact DECIMAL(10,4) and translation metadata is a string map.
"""

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(10, 4)
META = T.MapType(T.StringType(), T.StringType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


RAW_DATASET_1 = _struct(
    ("order_id", S), ("order_time_pst", S), ("city_district_id", I),
    ("rptg_amt", MONEY), ("currency_cd", S), ("order_qty", S))

RAW_DATASET_2 = _struct(
    ("order_id", S), ("order_time_pst", L), ("ship_to_district_name", S),
    ("ship_to_city_cd", S), ("rptg_amt", MONEY), ("currency_cd", S), ("order_qty", I))

RAW_MAPPING = _struct(
    ("city_district_id", I), ("ship_to_city_cd", S), ("ship_to_district_name", S))

PROCESSED = _struct(
    ("order_id", S), ("order_time_pst", L), ("rptg_amt", MONEY), ("currency_cd", S),
    ("order_qty", I), ("ship_to_city_cd", S), ("ship_to_district_name", S))

CITY_SOURCE = _struct(("ship_to_city_cd", S), ("ship_to_city_cd_eng", S), ("metadata", META))
DISTRICT_SOURCE = _struct(
    ("ship_to_district_name", S), ("ship_to_district_name_eng", S), ("metadata", META))

CURATED = _struct(
    ("order_id", S), ("order_time_pst", I), ("ship_to_city_cd", S),
    ("ship_to_district_name", S), ("ship_to_district_name_eng", S),
    ("ship_to_city_cd_eng", S), ("rmb_dollars", MONEY), ("order_qty", I))

CITY_CLUSTERS = _struct(
    ("ship_to_city_cd", S), ("rmb_dollars", D), ("ship_to_city_cd_eng", S),
    ("province", S), ("per_capita_usd", S), ("normalized_sales", D), ("cluster", I))

# Header spelling of the workbook feed before the rename on ingest (two spaces).
FEED1_TIME_HEADER = "ORDER_TIME  (PST)"
