"""Analyst questions over the curated fact table.

Every report aggregates first (partial aggregation before the shuffle, so a
city holding a large share of the orders costs one row per task) and only
then joins, ranks or sorts the small aggregate.  Top-k reports end in
``orderBy(...).limit(k)``, which Spark runs as a per-partition top-k.
Ties are broken by key columns so results are deterministic; NULLs sort last
in both directions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.clock import clock_hour, hour_of
from ledgerline.functions.text import number_text_to_double, percent
from ledgerline.operators.joins import bounded_broadcast

TOTAL = "decimal(38,2)"


def _sum_money(c: str = "rmb_dollars") -> Column:
    return F.sum(c).cast(TOTAL)


def _avg_double(c: str = "rmb_dollars") -> Column:
    """Mean as DOUBLE from the exact decimal sum (engine-independent)."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def _top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def _city_province(city_dim: DataFrame) -> DataFrame:
    return bounded_broadcast(city_dim.select("ship_to_city_cd", "province"), basis=city_dim)


# ---------------------------------------------------------------- A1, A2, A8


def province_spend(gold: DataFrame, city_dim: DataFrame, district_dim: DataFrame) -> DataFrame:
    """A1: spend, distinct cities and distinct translated districts per province.

    Orders are restricted to translated cities (inner join) and districts are
    counted from the district translation (left join), as in the source
    report.  Written as two aggregation levels: (province, city, district)
    sums first, then the distinct counts on that small frame, so no Expand of
    the fact rows is needed.
    """
    cities = _city_province(city_dim)
    districts = bounded_broadcast(district_dim.select(F.col("ship_to_district_name").alias("d_name")),
                                  basis=district_dim)
    c = gold.select("ship_to_city_cd", "ship_to_district_name", "rmb_dollars")
    joined = (c.join(cities, "ship_to_city_cd")
              .join(districts, F.col("ship_to_district_name") == F.col("d_name"), "left"))
    pairs = joined.groupBy("province", "ship_to_city_cd", "d_name").agg(F.sum("rmb_dollars").alias("s"))
    out = pairs.groupBy("province").agg(
        F.sum("s").cast(TOTAL).alias("total_spending"),
        F.countDistinct("ship_to_city_cd").alias("total_count_of_cities"),
        F.countDistinct("d_name").alias("total_count_of_districts"))
    return out.orderBy(F.desc_nulls_last("total_spending"), F.asc_nulls_last("province"))


def top_provinces(gold: DataFrame, city_dim: DataFrame, k: int = 10) -> DataFrame:
    """A2: top-k provinces by spend, summed city by city."""
    per_city = (gold.select("ship_to_city_cd", "rmb_dollars")
                .join(_city_province(city_dim), "ship_to_city_cd")
                .groupBy("ship_to_city_cd", "province").agg(F.sum("rmb_dollars").alias("total_sales")))
    per_province = per_city.groupBy("province").agg(F.sum("total_sales").cast(TOTAL).alias("province_total_sales"))
    return _top(per_province, k, F.desc_nulls_last("province_total_sales"), F.asc_nulls_last("province"))


def distinct_provinces(city_dim: DataFrame) -> DataFrame:
    """The distinct provinces of the city dimension (NULL included)."""
    return city_dim.select("province").distinct()


# ---------------------------------------------------------------- A3, A4, O4


def top_cities_spend(gold: DataFrame, k: int = 10) -> DataFrame:
    """A3: top-k (city, English name) by spend."""
    agg = gold.groupBy("ship_to_city_cd", "ship_to_city_cd_eng").agg(_sum_money().alias("total_sales"))
    return _top(agg, k, F.desc_nulls_last("total_sales"), F.asc_nulls_last("ship_to_city_cd"),
                F.asc_nulls_last("ship_to_city_cd_eng"))


def top_cities_orders(gold: DataFrame, k: int = 10) -> DataFrame:
    """A4: top-k (city, English name) by number of orders."""
    agg = gold.groupBy("ship_to_city_cd", "ship_to_city_cd_eng").agg(F.count(F.lit(1)).alias("order_count"))
    return _top(agg, k, F.desc_nulls_last("order_count"), F.asc_nulls_last("ship_to_city_cd"),
                F.asc_nulls_last("ship_to_city_cd_eng"))


def top_transactions(gold: DataFrame, k: int = 10) -> DataFrame:
    """The k largest single orders, full rows."""
    order = [F.desc_nulls_last("rmb_dollars")] + [F.asc_nulls_last(c) for c in gold.columns if c != "rmb_dollars"]
    return _top(gold, k, *order)


# ---------------------------------------------------------------- W1, O5, A5


def city_hour_sales(gold: DataFrame, hour: str = "round") -> DataFrame:
    """Spend per (city, hour); hour is ROUND(t/10000) by default (see F1)."""
    return (gold.select("ship_to_city_cd", hour_of(F.col("order_time_pst"), hour).alias("order_hour_pst"),
                        "rmb_dollars")
            .groupBy("ship_to_city_cd", "order_hour_pst").agg(_sum_money().alias("total_sales")))


def top_city_per_hour(gold: DataFrame, hour: str = "round") -> DataFrame:
    """The best city in every hour (the NULL hour and NULL city are groups too)."""
    sales = city_hour_sales(gold, hour)
    w = Window.partitionBy("order_hour_pst").orderBy(F.desc_nulls_last("total_sales"),
                                                     F.asc_nulls_last("ship_to_city_cd"))
    ranked = sales.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == 1)
    return (ranked.select("ship_to_city_cd", "order_hour_pst", "total_sales")
            .orderBy(F.asc_nulls_last("order_hour_pst")))


def top_city_hour_pairs(gold: DataFrame, k: int = 10, hour: str = "round") -> DataFrame:
    """Top-k (city, hour) pairs by spend."""
    return _top(city_hour_sales(gold, hour), k, F.desc_nulls_last("total_sales"),
                F.asc_nulls_last("ship_to_city_cd"), F.asc_nulls_last("order_hour_pst"))


def top_city_hour_pairs_english(gold: DataFrame, k: int = 5, hour: str = "round") -> DataFrame:
    """O5 with the English city name: top-k (city, English name, hour) by spend."""
    sales = (gold.select("ship_to_city_cd", "ship_to_city_cd_eng",
                         hour_of(F.col("order_time_pst"), hour).alias("order_hour_pst"), "rmb_dollars")
             .groupBy("ship_to_city_cd", "ship_to_city_cd_eng", "order_hour_pst")
             .agg(_sum_money().alias("total_sales")))
    return _top(sales, k, F.desc_nulls_last("total_sales"), F.asc_nulls_last("ship_to_city_cd"),
                F.asc_nulls_last("ship_to_city_cd_eng"), F.asc_nulls_last("order_hour_pst"))


def top_city_per_hour_english(gold: DataFrame, hour: str = "round") -> DataFrame:
    """W1 with the English city name carried through the aggregate."""
    sales = (gold.select("ship_to_city_cd", "ship_to_city_cd_eng",
                         hour_of(F.col("order_time_pst"), hour).alias("order_hour_pst"), "rmb_dollars")
             .groupBy("ship_to_city_cd", "ship_to_city_cd_eng", "order_hour_pst")
             .agg(_sum_money().alias("total_sales")))
    w = Window.partitionBy("order_hour_pst").orderBy(F.desc_nulls_last("total_sales"),
                                                     F.asc_nulls_last("ship_to_city_cd"))
    return (sales.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")
            .orderBy(F.asc_nulls_last("order_hour_pst")))


def spend_per_hour(gold: DataFrame) -> DataFrame:
    """A5: spend per clock hour FLOOR(t/10000), ordered by hour."""
    return (gold.select(clock_hour(F.col("order_time_pst")).alias("rounded_order_hour"), "rmb_dollars")
            .groupBy("rounded_order_hour").agg(_sum_money().alias("total_sales"))
            .orderBy(F.asc_nulls_last("rounded_order_hour")))


# ---------------------------------------------------------------- W2


def best_district_per_city(gold: DataFrame, k: int = 10) -> DataFrame:
    """Each city's district with the highest average order, then the top-k cities."""
    keys = ["ship_to_city_cd", "ship_to_city_cd_eng", "ship_to_district_name", "ship_to_district_name_eng"]
    avg = gold.groupBy(*keys).agg(_avg_double().alias("avg_sales"))
    w = Window.partitionBy("ship_to_city_cd").orderBy(
        F.desc_nulls_last("avg_sales"), F.asc_nulls_last("ship_to_district_name"),
        F.asc_nulls_last("ship_to_city_cd_eng"), F.asc_nulls_last("ship_to_district_name_eng"))
    best = avg.withColumn("rank", F.row_number().over(w)).where("rank = 1")
    top = _top(best, k, F.desc_nulls_last("avg_sales"), F.asc_nulls_last("ship_to_city_cd"))
    return top.select(*keys, F.round("avg_sales", 4).alias("top_avg_sales"))


# ---------------------------------------------------------------- A10, A11


def city_gdp_spend(gold: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Spend of translated cities that have both a per-capita GDP and a province."""
    dim = bounded_broadcast(city_dim.where(F.col("per_capita_usd").isNotNull() & F.col("province").isNotNull())
                            .select("ship_to_city_cd", "ship_to_city_cd_eng", "per_capita_usd", "province"),
                            basis=city_dim)
    per_city = (gold.select("ship_to_city_cd", "rmb_dollars")
                .groupBy("ship_to_city_cd").agg(F.sum("rmb_dollars").alias("total_spend")))
    joined = per_city.join(dim, "ship_to_city_cd")
    return joined.select("ship_to_city_cd_eng", F.col("total_spend").cast(TOTAL).alias("total_spend"),
                         number_text_to_double(F.col("per_capita_usd")).alias("per_capita_usd"), "province")


def spend_gdp_corr(gold: DataFrame, city_dim: DataFrame) -> DataFrame:
    """A10: Pearson correlation of city spend with per-capita GDP (pairwise complete)."""
    a = city_gdp_spend(gold, city_dim)
    return a.agg(F.round(F.corr(F.col("total_spend").cast("double"), "per_capita_usd"), 6).alias("corr"),
                 F.count(F.lit(1)).alias("n_cities"))


# ---------------------------------------------------------------- A17


def translation_coverage(identifiers: DataFrame, translations: DataFrame, key: str,
                         matched_only: bool = False) -> DataFrame:
    """Translated rows / distinct identifiers * 100 in one aggregation pass.

    ``identifiers`` holds every occurrence of the identifier (all feeds and
    the mapping).  The numerator counts all translation rows, matched or not
    (``matched_only``: those whose identifier occurs), and the denominator
    counts a NULL identifier as one value, as in the source report.
    """
    tagged = (identifiers.select(F.col(key).alias("_id"), F.lit(1).alias("_seen"), F.lit(0).alias("_tr"))
              .unionByName(translations.select(F.col(key).alias("_id"), F.lit(0).alias("_seen"), F.lit(1).alias("_tr"))))
    per_id = tagged.groupBy("_id").agg(F.max("_seen").alias("_seen"), F.sum("_tr").alias("_tr"))
    translated = F.when((F.col("_seen") == 1) & F.col("_id").isNotNull(), F.col("_tr")).otherwise(0) if matched_only else F.col("_tr")
    counts = per_id.agg(F.coalesce(F.sum(translated), F.lit(0)).cast("bigint").alias("translated_count"),
                        F.coalesce(F.sum("_seen"), F.lit(0)).cast("bigint").alias("unique_count"))
    return counts.select("translated_count", "unique_count",
                         F.round(percent(F.col("translated_count"), F.col("unique_count")), 6).alias("percentage"))
