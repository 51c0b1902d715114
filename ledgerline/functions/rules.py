"""Row validation rules as column expressions.

A rule is (field, check, message).  ``check`` is a boolean column: TRUE means
valid, FALSE invalid and NULL unknown (SQL three-valued logic).  The same rule
list drives null replacement (P1), the first-error log (P8) and the all-errors
log (P9/P10), so all of them are single projections over the feed, with no
per-row Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Allowed currencies, trading window (HHMMSS, inclusive) and the
# messages of the first-error log.
ALLOWED_CURRENCIES = ("USD", "RMB")
WINDOW_START, WINDOW_END = 50000, 120000
MSG_TIME = "Invalid ORDER_TIME_PST"
MSG_ID = "Invalid CITY_DISTRICT_ID"
MSG_AMT = "Invalid RPTG_AMT"
MSG_CURRENCY = "Invalid CURRENCY_CD"
MSG_QTY = "Invalid ORDER_QTY"

# Messages of the all-errors log (row-contract variant).
MSG_S_TIME_DIGITS = "ORDER_TIME_PST must be a numeric string"
MSG_S_TIME_WINDOW = "ORDER_TIME_PST must be an integer between 50000 and 120000 (5 AM to 12 PM)"
MSG_S_ID = "CITY_DISTRICT_ID must be a positive integer and must exist in RAW_MAPPING"
MSG_S_AMT = "RPTG_AMT must be non-negative"
MSG_S_CURRENCY = "CURRENCY_CD must be one of USD, RMB"
MSG_S_QTY = "ORDER_QTY must be a positive integer"
MSG_S_CITY = "SHIP_TO_CITY_CD must exist in RAW_MAPPING"
MSG_S_DISTRICT = "SHIP_TO_DISTRICT_NAME must exist in RAW_MAPPING"

# Flag columns that a feed must carry for the membership rules (set by
# ``ledgerline.operators.quality.with_membership``).
ID_KNOWN = "_id_known"
CITY_KNOWN = "_city_known"
DISTRICT_KNOWN = "_district_known"


@dataclass(frozen=True)
class Rule:
    field: str
    check: Callable[[], Column]
    message: str

    def valid(self) -> Column:
        return self.check()


def digits_only(c: Column) -> Column:
    """Non-empty ASCII digit string (``\\z``: no trailing newline accepted)."""
    return c.rlike(r"^[0-9]+\z")


def in_window(c: Column) -> Column:
    """HHMMSS inside the trading window, bounds included."""
    return c.between(WINDOW_START, WINDOW_END)


def non_negative(c: Column) -> Column:
    """P5."""
    return c >= 0


def allowed_currency(c: Column) -> Column:
    """P6."""
    return c.isin(*ALLOWED_CURRENCIES)


def quantity_value(c: Column) -> Column:
    """Integer value of a quantity given as text ('3.0') or number; NULL if not numeric.

    Text is read as a double and rounded half away from zero, like an SQL
    string-to-integer cast; out-of-range values give NULL instead of failing.
    """
    return F.round(c.try_cast("double")).try_cast("int")


def positive_quantity(c: Column) -> Column:
    """Quantity > 0.  Non-numeric text is invalid (FALSE), a NULL input unknown."""
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(quantity_value(c) > 0, F.lit(False)))


def membership(flag: str, key: str) -> Column:
    """Key exists in the dimension; NULL key is unknown, like ``x IN (subquery)``."""
    return F.when(F.col(key).isNull(), F.lit(None).cast("boolean")).otherwise(F.col(flag))


def feed1_rules() -> list[Rule]:
    """Rules of the normalised feed, in log order."""
    return [
        Rule("order_time_pst", lambda: digits_only(F.col("order_time_pst")), MSG_TIME),
        Rule("city_district_id", lambda: membership(ID_KNOWN, "city_district_id"), MSG_ID),
        Rule("rptg_amt", lambda: non_negative(F.col("rptg_amt")), MSG_AMT),
        Rule("currency_cd", lambda: allowed_currency(F.col("currency_cd")), MSG_CURRENCY),
        Rule("order_qty", lambda: positive_quantity(F.col("order_qty")), MSG_QTY),
    ]


def feed2_rules() -> list[Rule]:
    """Rules of the denormalised feed (it has no mapping id)."""
    return [
        Rule("order_time_pst", lambda: in_window(F.col("order_time_pst")), MSG_TIME),
        Rule("rptg_amt", lambda: non_negative(F.col("rptg_amt")), MSG_AMT),
        Rule("currency_cd", lambda: allowed_currency(F.col("currency_cd")), MSG_CURRENCY),
        Rule("order_qty", lambda: positive_quantity(F.col("order_qty")), MSG_QTY),
    ]


def feed1_contract() -> list[Rule]:
    """Row-contract variant of the feed-1 rules (positive id, own messages)."""
    return [
        Rule("order_time_pst", lambda: digits_only(F.col("order_time_pst")), MSG_S_TIME_DIGITS),
        Rule("city_district_id",
             lambda: (F.col("city_district_id") > 0) & membership(ID_KNOWN, "city_district_id"),
             MSG_S_ID),
        Rule("rptg_amt", lambda: non_negative(F.col("rptg_amt")), MSG_S_AMT),
        Rule("currency_cd", lambda: allowed_currency(F.col("currency_cd")), MSG_S_CURRENCY),
        Rule("order_qty", lambda: positive_quantity(F.col("order_qty")), MSG_S_QTY),
    ]


def feed2_contract(check_places: bool = False) -> list[Rule]:
    """Row-contract variant of the feed-2 rules; place checks are off by default."""
    rules = [
        Rule("order_time_pst", lambda: in_window(F.col("order_time_pst")), MSG_S_TIME_WINDOW),
        Rule("rptg_amt", lambda: non_negative(F.col("rptg_amt")), MSG_S_AMT),
        Rule("currency_cd", lambda: allowed_currency(F.col("currency_cd")), MSG_S_CURRENCY),
        Rule("order_qty", lambda: positive_quantity(F.col("order_qty")), MSG_S_QTY),
    ]
    if check_places:
        rules[1:1] = [
            Rule("ship_to_city_cd", lambda: membership(CITY_KNOWN, "ship_to_city_cd"), MSG_S_CITY),
            Rule("ship_to_district_name",
                 lambda: membership(DISTRICT_KNOWN, "ship_to_district_name"), MSG_S_DISTRICT),
        ]
    return rules
