"""Silver and gold kept by load window, so that one window can be loaded again.

Each feed has a silver and a gold table with a partition per ``dt`` and
``load_window`` that holds what this window delivered.  ``reload`` reads the
landed files of the given windows only, refines them and replaces their
partitions; no other window is read or written.

Which delivery of an order counts is settled when gold is read: the one of the
latest window that holds the order.  If a window that is loaded again no longer
holds it, the next older delivery counts again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import rules as R
from ledgerline.operators import enrich, quality, refine
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources import files, sinks
from ledgerline.sources.files import WINDOW

FEEDS = ("feed1", "feed2")


class WindowedLayers:
    """The window tables under ``store``; mapping, dimensions and landed files come from a warehouse of ``LandedFeeds``."""

    def __init__(self, warehouse: Warehouse, store: str):
        self.w, self.store, self.spark = warehouse, store.rstrip("/"), warehouse.spark

    def landed(self, feed: str, windows: Sequence[tuple[str, str]]) -> DataFrame:
        """The delivered rows of some windows; only their files are listed and read."""
        read = self.w.feeds.landed_feed1 if feed == "feed1" else self.w.feeds.landed_feed2
        return read(windows)

    def refined(self, feed: str, landed: DataFrame) -> DataFrame:
        """Silver rows with their window: of an order that a window delivers twice, the later row."""
        rows = sinks.latest_per_key(landed, ["order_id", *WINDOW], files.LOAD_ORDER[2:]).drop(
            *[c for c in files.LOAD_ORDER if c not in WINDOW])
        if feed == "feed1":
            flagged = quality.with_membership(rows, self.w.raw_mapping, "city_district_id", R.ID_KNOWN)
            return refine.silver_types(refine.resolve_places(quality.qualify(flagged, R.feed1_rules()), self.w.raw_mapping), WINDOW)
        return refine.silver_types(quality.qualify(rows, R.feed2_rules()), WINDOW)

    def reload(self, windows: Sequence[tuple[str, str]], feeds: Sequence[str] = FEEDS) -> None:
        """Recompute and replace the partitions of ``windows``; one that has no files any more is cleared."""
        for feed in feeds:
            landed = self.landed(feed, windows)
            sinks.overwrite_windows(self.refined(feed, landed), f"{self.store}/silver/{feed}", WINDOW, windows, landed)
            silver = self.read("silver", feed).where(files.in_windows(windows))
            gold = enrich.gold(silver, self.w.city_dim, self.w.district_dim, self.w.currency, self.w.rate_type, WINDOW)
            sinks.overwrite_windows(gold, f"{self.store}/gold/{feed}", WINDOW, windows, silver)

    def read(self, layer: str, feed: str) -> DataFrame:
        """All deliveries of a feed in a layer, with their window."""
        path = f"{self.store}/{layer}/{feed}"
        schema = self.spark.read.option("basePath", path).parquet(path).schema
        for c in WINDOW:
            schema[c].dataType = files.T.StringType()  # else a date-like name is read as a number
        return self.spark.read.schema(schema).parquet(path)

    def current(self, layer: str = "gold") -> DataFrame:
        """The layer's rows that count now, without their window.

        Only the ids are shuffled, to find the orders that several windows hold;
        these are written, and the rows are anti-joined with them by what the size
        of those files suggests.
        """
        out = None
        for feed in FEEDS:
            rows = files.with_window_number(self.read(layer, feed))
            window = F.struct("dt", "window_no", "load_window")
            again = (rows.select("order_id", window.alias("_w")).groupBy(F.col("order_id").alias("_id"))
                     .agg(F.max("_w").alias("_last"), F.min("_w").alias("_first")).where("_first < _last").drop("_first"))
            again = sinks.materialize(again, "redelivered")
            older = rows["order_id"].eqNullSafe(again["_id"]) & (window < again["_last"])
            one = rows.join(again, older, "left_anti").drop("dt", "window_no", "load_window")
            out = one if out is None else out.unionByName(one)
        return out
