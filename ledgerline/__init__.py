"""ledgerline: a Spark-native sales-performance analytics engine.

Two order feeds are validated row by row against a declared rule list, fused,
enriched with geography, translations and currency into a curated fact table,
and analysed (best city per hour, best district per city, province spend, GDP
correlation, translation coverage, spend tiers).  Every operator is a
``DataFrame -> DataFrame`` function on built-in Spark expressions.
"""

from ledgerline.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
