"""String, number-from-text and map helpers.

All are built-in column expressions (JVM side, inside whole-stage codegen).
Java regular expressions are ASCII by default; patterns use ``[0-9]`` for
digits and ``(?U)`` where Unicode whitespace must match (F10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four municipalities that are their own province, and the
# patterns of the GDP texts.
MUNICIPALITIES = ("Shanghai", "Beijing", "Tianjin", "Chongqing")
PER_CAPITA_PATTERN = r"US\$ ([0-9,]+)"
BILLION_PATTERN = r"US\$ ([0-9.]+) billion"
PLAIN_USD_PATTERN = r"US\$ ([0-9,]+)"
BULLET_PATTERN = r"^[-•]\s*"
TITLE_SUFFIX = "- Wikipedia"


def _first_group(text: Column, pattern: str) -> Column:
    """First match group of ``pattern`` or NULL when it does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def strip_thousands(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def number_text_to_double(text: Column) -> Column:
    """'12,345' -> 12345.0; text that is not a number -> NULL."""
    return strip_thousands(text).try_cast("double")


def per_capita_usd(text: Column) -> Column:
    """first ``US$ <digits/commas>`` amount without commas, as text; else NULL."""
    return strip_thousands(_first_group(text, PER_CAPITA_PATTERN))


def total_gdp_usd(text: Column) -> Column:
    """``US$ x.y billion`` -> x.y * 1e9 truncated; else plain ``US$ 1,234``; else NULL.

    An amount that cannot be read as a number gives NULL instead of failing.
    """
    billions = _first_group(text, BILLION_PATTERN)
    plain = _first_group(text, PLAIN_USD_PATTERN)
    scaled = (billions.try_cast("double") * F.lit(1e9)).try_cast("bigint")
    return F.when(billions.isNotNull(), scaled).otherwise(strip_thousands(plain).try_cast("bigint"))


def meta_get(metadata: Column, key: str, default: str = "") -> Column:
    """F8: ``metadata.get(key, default)`` on a string map."""
    return F.coalesce(F.try_element_at(metadata, F.lit(key)), F.lit(default))


def _unquoted(metadata: Column, key: str) -> Column:
    return F.nullif(F.replace(meta_get(metadata, key), F.lit('"'), F.lit("")), F.lit(""))


def province_by_region(english_name: Column, metadata: Column) -> Column:
    """municipality -> itself; else Province; else Autonomous region; else NULL.

    Double quotes are removed and an empty result counts as missing.
    """
    return F.when(english_name.isin(*MUNICIPALITIES), english_name).otherwise(
        F.coalesce(_unquoted(metadata, "Province"), _unquoted(metadata, "Autonomous region")))


def province_or_city(english_name: Column, metadata: Column) -> Column:
    """Province without quotes, else the city's English name."""
    return F.coalesce(_unquoted(metadata, "Province"), english_name)


def clean_text(text: Column) -> Column:
    """NBSP and any run of (Unicode) whitespace -> one space, then trim."""
    return py_strip(F.regexp_replace(text, r"(?U)[\u00a0\s]+", " "))


def strip_bullet(key: Column) -> Column:
    """remove a leading '-' or '•' and the whitespace after it."""
    return F.regexp_replace(key, "(?U)" + BULLET_PATTERN, "")


def clean_title(title: Column) -> Column:
    """drop the site suffix and trim."""
    return py_strip(F.replace(title, F.lit(TITLE_SUFFIX), F.lit("")))


def py_strip(s: Column) -> Column:
    """Strip leading and trailing (Unicode) whitespace, like Python's ``str.strip()``."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def percent(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator * 100 in DOUBLE; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * F.lit(100.0)
