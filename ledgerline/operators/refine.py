"""Silver layer: resolve feed-1 places and fuse both feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import quantity_value
from ledgerline.operators.joins import bounded_broadcast

SILVER_COLUMNS = ("order_id", "order_time_pst", "rptg_amt", "currency_cd", "order_qty",
                  "ship_to_city_cd", "ship_to_district_name")


def resolve_places(qualified_1: DataFrame, mapping: DataFrame) -> DataFrame:
    """LEFT JOIN the mapping on city_district_id; every order is kept.

    The mapping is a dimension; it is broadcast after a size check, so the
    order feed is streamed through a hash join without a shuffle.
    """
    dim = bounded_broadcast(mapping.select("city_district_id", "ship_to_city_cd", "ship_to_district_name"),
                            basis=mapping)
    q = qualified_1.alias("q")
    joined = q.join(dim.alias("m"), F.col("q.city_district_id") == F.col("m.city_district_id"), "left")
    return joined.select("q.*", "m.ship_to_city_cd", "m.ship_to_district_name").drop("city_district_id")


def silver_types(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Explicit casts before the union: validated digit text -> BIGINT time, quantity -> INT; columns ``keep`` stay."""
    return df.select(
        *keep,
        "order_id",
        F.col("order_time_pst").try_cast("bigint").alias("order_time_pst"),
        F.col("rptg_amt").cast("decimal(18,2)").alias("rptg_amt"),
        "currency_cd",
        quantity_value(F.col("order_qty")).alias("order_qty"),
        "ship_to_city_cd", "ship_to_district_name")


def silver_parts(qualified_1: DataFrame, qualified_2: DataFrame,
                 mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both feeds in one schema, for a UNION ALL by name or for keyed loads (no shuffle)."""
    return silver_types(resolve_places(qualified_1, mapping)), silver_types(qualified_2)
