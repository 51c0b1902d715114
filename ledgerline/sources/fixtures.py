"""Raw feeds and dimension sources derived from the driver tables.

The source system's order feeds and translation files are not available, so
they are derived from the TPC-H-like tables with planted defects:
city = nation, district = customer market segment, province = region.
Every frame here is lazy and grows with the input tables; nothing is made up
on the driver except the two-row currency table, which is a fixed constant of
the source system.

The same derivation is written as SQL in ``ledgerline.plans.oracle`` and the
two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.sources.tables import Tables

# District code per market segment (any other segment is 5), and
# the mapping id left out of the dimension (dimension out of date).
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}
OTHER_SEGMENT_CODE = 5
MISSING_MAPPING_ID = 245
UNKNOWN_DISTRICT_ID = 999999
UNTRANSLATED_NATION = 7
UNTRANSLATED_DISTRICT = "MACHINERY"
# English names that exercise the municipality rule of the city dimension.
MUNICIPALITY_NAMES = {3: "Beijing", 12: "Shanghai"}


def _segment_code(segment: Column) -> Column:
    expr = None
    for name, code in SEGMENT_CODES.items():
        expr = (F.when(segment == name, F.lit(code)) if expr is None
                else expr.when(segment == name, F.lit(code)))
    return expr.otherwise(F.lit(OTHER_SEGMENT_CODE))


def _nations(t: Tables) -> DataFrame:
    return bounded_broadcast(t.nation.select("n_nationkey", "n_name"), basis=t.nation)


def customer_geo(t: Tables) -> DataFrame:
    """customer -> (c_custkey, n_name, c_mktsegment, cd_id); nation is broadcast."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return (c.join(_nations(t), c.c_nationkey == F.col("n_nationkey"))
            .select("c_custkey", "n_name", "c_mktsegment",
                    (F.col("c_nationkey") * 10 + _segment_code(F.col("c_mktsegment"))).alias("cd_id")))


def raw_mapping(t: Tables) -> DataFrame:
    """City-district dimension (RAW_MAPPING).

    The distinct (nation, segment) pairs are found on the customer table
    before the nation join, so the partial aggregate shrinks the scan to a
    handful of rows per task and the join touches only those.
    """
    pairs = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    cd_id = F.col("c_nationkey") * 10 + _segment_code(F.col("c_mktsegment"))
    return (pairs.join(_nations(t), pairs.c_nationkey == F.col("n_nationkey"))
            .select(cd_id.cast("int").alias("city_district_id"),
                    F.col("n_name").alias("ship_to_city_cd"),
                    F.col("c_mktsegment").alias("ship_to_district_name"))
            .where(F.col("city_district_id") != MISSING_MAPPING_ID))


def raw_dataset_1(t: Tables) -> DataFrame:
    """Normalised feed: one row per order, string time and quantity, mapping id."""
    k = F.col("o_orderkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    cust = customer_geo(t).select("c_custkey", "cd_id")
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    clock = ((5 + k % 7) * 10000 + (k * 7 % 60) * 100 + k * 13 % 60).cast("string")
    return j.select(
        F.concat(F.lit("A"), k.cast("string")).alias("order_id"),
        F.when(k % 1009 == 0, F.lit("time")).otherwise(clock).alias("order_time_pst"),
        F.when(k % 503 == 0, F.lit(UNKNOWN_DISTRICT_ID)).otherwise(F.col("cd_id")).cast("int")
        .alias("city_district_id"),
        F.when(k % 997 == 1, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
        .cast(schemas.MONEY).alias("rptg_amt"),
        F.when(k % 401 == 2, F.lit("USD")).when(k % 701 == 3, F.lit("EUR")).otherwise(F.lit("RMB"))
        .alias("currency_cd"),
        F.when(k % 421 == 4, F.lit(None).cast("string"))
        .when(k % 587 == 5, F.lit("0"))
        .otherwise(F.concat((1 + k % 9).cast("string"), F.lit(".0"))).alias("order_qty"),
    )


def raw_dataset_2(t: Tables) -> DataFrame:
    """Denormalised feed from events.

    Planted defects: some ids collide with feed 1 (``A`` prefix), some
    district names are lower-cased and some city codes carry an ``_OLD``
    suffix, so they miss the mapping.
    """
    e = t.events.select("event_id", "ts", "user_id", "value")
    cust = customer_geo(t).select("c_custkey", "n_name", "c_mktsegment")
    j = e.join(cust, e.user_id == cust.c_custkey)
    eid = F.col("event_id")
    return j.select(
        F.concat(F.when(eid % 1013 == 0, F.lit("A")).otherwise(F.lit("B")), eid.cast("string"))
        .alias("order_id"),
        (F.hour("ts") * 10000 + F.minute("ts") * 100 + F.second("ts")).cast("bigint")
        .alias("order_time_pst"),
        F.when(eid % 83 == 5, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
        .alias("ship_to_district_name"),
        F.when(eid % 997 == 5, F.concat("n_name", F.lit("_OLD"))).otherwise(F.col("n_name"))
        .alias("ship_to_city_cd"),
        F.col("value").cast(schemas.MONEY).alias("rptg_amt"),
        F.lit("RMB").alias("currency_cd"),
        (1 + eid % 5).cast("int").alias("order_qty"),
    )


def currency_rates(spark: SparkSession) -> DataFrame:
    """CURRENCY_CODE_MAPPING; the rates are fixed values of the source system."""
    rows = spark.sql(
        "SELECT * FROM VALUES ('RMB', 1), ('USD', 7.28) AS v(currency_cd, multiplier)")
    return rows.select("currency_cd", F.col("multiplier").cast(schemas.RATE).alias("multiplier"),
                       F.current_date().alias("date_recorded"))


def _meta_entry(key: str, value: Column, present: Column) -> Column:
    return F.when(present, F.struct(F.lit(key).alias("key"), value.alias("value")))


def city_translation_source(t: Tables) -> DataFrame:
    """Scraped city translations: (city code, English name, metadata map).

    Metadata covers the shapes the dimension build must handle: quoted
    province, empty province with an autonomous-region fallback, no province,
    per-capita text with and without thousands separators, totals in billions
    (decimal and comma) and plain totals, and text without a number.
    """
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    nk = F.col("n_nationkey")
    eng = F.concat(F.lit("City "), nk.cast("string"))
    for key, name in MUNICIPALITY_NAMES.items():
        eng = F.when(nk == key, F.lit(name)).otherwise(eng)
    per_capita = (F.when(nk % 3 == 0, F.concat(
        F.lit("CN¥ "), (50 + nk).cast("string"), F.lit(",000 (US$ "), (7 + nk).cast("string"),
        F.lit(","), F.lpad((nk * 37 % 1000).cast("string"), 3, "0"), F.lit(")")))
        .when(nk % 3 == 1, F.concat(F.lit("US$ "), (900 + nk * 11).cast("string")))
        .otherwise(F.lit("not reported")))
    total = (F.when(nk % 4 == 0, F.concat(F.lit("US$ "), (60 + nk).cast("string"), F.lit(".1 billion")))
             .when(nk % 4 == 1, F.concat(F.lit("US$ "), nk.cast("string"), F.lit(",234 billion")))
             .when(nk % 4 == 2, F.concat(F.lit("CN¥ 1 trillion (US$ "), nk.cast("string"), F.lit(",345,678)")))
             .otherwise(F.lit("unknown")))
    entries = F.array(
        _meta_entry("Province", F.concat(F.lit('"'), F.col("r_name"), F.lit('"')), nk % 4 == 0),
        _meta_entry("Province", F.lit('""'), nk % 4 == 2),
        _meta_entry("Autonomous region", F.concat(F.col("r_name"), F.lit(" AR")), (nk % 4).isin(1, 2)),
        _meta_entry("Per capita", per_capita, nk % 5 != 4),
        _meta_entry("Total", total, F.lit(True)),
    )
    metadata = F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))
    return (n.where(nk != UNTRANSLATED_NATION)
            .join(bounded_broadcast(r, basis=t.region), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("ship_to_city_cd"), eng.alias("ship_to_city_cd_eng"),
                    metadata.alias("metadata")))


def district_translation_source(mapping: DataFrame) -> DataFrame:
    """Scraped district translations, keyed by district name (one segment missing)."""
    name = F.col("ship_to_district_name")
    eng = F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))),
                   F.lit(" District"))
    return (mapping.select("ship_to_district_name").distinct()
            .where(name != UNTRANSLATED_DISTRICT)
            .select(name, eng.alias("ship_to_district_name_eng"),
                    F.create_map(F.lit("Segment"), name).alias("metadata")))


# Page ids of the rendered city pages start here (clear of the driver's page ids).
CITY_PAGE_ID_BASE = 10_000_000


def _html_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def city_pages(t: Tables) -> DataFrame:
    """Encyclopedia-style pages rendered from the city translation records.

    Each page has a ``<title>`` with the site suffix and an infobox table
    whose rows carry the metadata, written the way scraped pages look: keys
    behind list bullets, non-breaking and repeated spaces in values, and a
    decoy ``Total`` row (an area) before the GDP one, which must win.
    A city without a translation record gets an empty page (a failed fetch).
    Returns (page_id, url, html) plus the city code for the id mapping.
    """
    nations = t.nation.select(F.col("n_name").alias("ship_to_city_cd"), "n_nationkey")
    src = nations.join(city_translation_source(t), "ship_to_city_cd", "left")

    html = _page(F.col("ship_to_city_cd_eng"), F.col("metadata"))
    # A city without a translation record stands for a failed fetch: empty page.
    html = F.when(F.col("ship_to_city_cd_eng").isNull(), F.lit("")).otherwise(html)
    return src.select((F.lit(CITY_PAGE_ID_BASE) + F.col("n_nationkey")).cast("bigint").alias("page_id"),
                      F.concat(F.lit("https://pages.example/wiki/"), F.col("ship_to_city_cd")).alias("url"),
                      html.alias("html"), "ship_to_city_cd")


def _page(title: Column, metadata: Column) -> Column:
    """The HTML of a page with ``metadata`` in its infobox."""
    def row(key: Column, value: Column) -> Column:
        return F.concat(F.lit("<tr><th scope=\"row\">"), key, F.lit("</th><td>"), value, F.lit("</td></tr>"))

    cells = F.transform(F.map_entries(metadata), lambda e: row(
        F.when(e["key"] == "Per capita", F.lit("• Per capita")).otherwise(_html_escape(e["key"])),
        F.regexp_replace(_html_escape(e["value"]), " ", " \u00a0 ")))
    decoy = row(F.lit("Total"), F.lit("<span>1,234 km<sup>2</sup></span>"))
    return F.concat(F.lit("<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>"),
                    _html_escape(title), F.lit(" - Wikipedia</title></head><body><h1>"), _html_escape(title),
                    F.lit("</h1><table class=\"infobox ib-settlement vcard\"><tbody>"), decoy,
                    F.array_join(cells, ""), F.lit("</tbody></table><p>Text of the article.</p></body></html>"))


# Page ids of the rendered district pages start here.
DISTRICT_PAGE_ID_BASE = 20_000_000


def district_pages(mapping: DataFrame) -> DataFrame:
    """Pages rendered from the district translation records: (page_id, url, html, ship_to_district_name)."""
    src = district_translation_source(mapping)
    name = F.col("ship_to_district_name")
    return src.select((F.lit(DISTRICT_PAGE_ID_BASE) + F.pmod(F.xxhash64(name), F.lit(1 << 40))).alias("page_id"),
                      F.concat(F.lit("https://pages.example/wiki/"), name).alias("url"),
                      _page(F.col("ship_to_district_name_eng"), F.col("metadata")).alias("html"), name)
