"""Gold layer: translations and currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.joins import bounded_broadcast

GOLD_COLUMNS = ("order_id", "order_time_pst", "ship_to_city_cd", "ship_to_district_name",
                "ship_to_district_name_eng", "ship_to_city_cd_eng", "rmb_dollars", "order_qty")


def to_rmb(amount, multiplier, rate_type: str = "decimal"):
    """Amount * rate as DECIMAL(18,2).

    ``rate_type='decimal'`` multiplies exactly; ``'float'`` reproduces a
    single-precision rate column (both sides in FLOAT, then rounded).
    """
    if rate_type == "decimal":
        return (amount * multiplier).cast(schemas.MONEY)
    if rate_type == "float":
        return (amount.cast("float") * multiplier.cast("float")).cast(schemas.MONEY)
    raise ValueError(f"rate_type must be 'decimal' or 'float', not {rate_type!r}")


def gold(silver: DataFrame, city_dim: DataFrame, district_dim: DataFrame, currency: DataFrame,
         rate_type: str = "decimal", keep: tuple[str, ...] = ()) -> DataFrame:
    """CURATED_DATASET: three LEFT JOINs on checked, broadcast dimensions; columns ``keep`` of silver stay.

    Every dimension is keyed (one row per key), so no order row is duplicated;
    an unknown currency gives a NULL amount.  The whole layer is one
    map-only stage over the silver rows.
    """
    city = bounded_broadcast(city_dim.select(
        F.col("ship_to_city_cd").alias("_c_key"), "ship_to_city_cd_eng"), basis=city_dim)
    district = bounded_broadcast(district_dim.select(
        F.col("ship_to_district_name").alias("_d_key"), "ship_to_district_name_eng"), basis=district_dim)
    rates = bounded_broadcast(currency.select(F.col("currency_cd").alias("_r_key"), "multiplier"), basis=currency)
    p = silver
    merged = (p.join(city, p.ship_to_city_cd == city._c_key, "left")
              .join(district, p.ship_to_district_name == district._d_key, "left")
              .join(rates, p.currency_cd == rates._r_key, "left"))
    return merged.select(
        *keep, "order_id",
        F.col("order_time_pst").try_cast("int").alias("order_time_pst"),
        "ship_to_city_cd", "ship_to_district_name", "ship_to_district_name_eng", "ship_to_city_cd_eng",
        to_rmb(F.col("rptg_amt"), F.col("multiplier"), rate_type).alias("rmb_dollars"),
        F.col("order_qty").try_cast("int").alias("order_qty"))
