"""Translation dimensions built set-wise from scraped records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.sources.sinks import latest_per_key


def city_dimension(source: DataFrame, province_policy: str = "region",
                   order_cols: Sequence[str] = ()) -> DataFrame:
    """TRANSLATIONS_CITY_MAPPING from (city code, English name, metadata map).

    ``province_policy='region'``: municipality, else Province, else
    Autonomous region, else NULL.  ``'city'``: Province, else the English name.
    Per-capita and total GDP are read from their metadata texts.  One row
    per city code: the record with the highest ``order_cols`` (load order; empty:
    one load, told apart by content), so the gold join never duplicates orders.
    """
    src = latest_per_key(source, ["ship_to_city_cd"], order_cols)
    eng, meta = F.col("ship_to_city_cd_eng"), F.col("metadata")
    if province_policy == "region":
        province = text.province_by_region(eng, meta)
    elif province_policy == "city":
        province = text.province_or_city(eng, meta)
    else:
        raise ValueError(f"province_policy must be 'region' or 'city', not {province_policy!r}")
    return src.select(
        "ship_to_city_cd", "ship_to_city_cd_eng", "metadata",
        province.alias("province"),
        text.per_capita_usd(text.meta_get(meta, "Per capita")).alias("per_capita_usd"),
        text.total_gdp_usd(text.meta_get(meta, "Total")).cast("string").alias("total_gdp_usd"))


def district_dimension(source: DataFrame, order_cols: Sequence[str] = ()) -> DataFrame:
    """TRANSLATIONS_DISTRICT_MAPPING: one row per district name."""
    src = latest_per_key(source, ["ship_to_district_name"], order_cols)
    return src.select("ship_to_district_name", "ship_to_district_name_eng", "metadata")


def metadata_json(dim: DataFrame) -> DataFrame:
    """metadata map serialised as a JSON object string."""
    return dim.withColumn("metadata", F.to_json("metadata"))


def explode_metadata(dim: DataFrame, key_col: str = "ship_to_city_cd") -> DataFrame:
    """One row per (dimension key, metadata key, value)."""
    return dim.select(key_col, F.explode("metadata").alias("meta_key", "meta_value"))


def preview(dim: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a dimension by its key."""
    return dim.orderBy(dim.columns[0]).limit(n)
