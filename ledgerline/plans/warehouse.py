"""The layered plan (bronze -> silver -> gold) over one input directory.

Each layer is a DataFrame; Catalyst fuses the chain between two written
layers into one plan.  Bronze (the landed feeds and the mapping, which is
derived from the large customer table), silver and gold are written once to
the shared checkpoint folder and read back, as a medallion pipeline stores
them: reports scan the gold files
(only the columns they need) instead of re-running the feed joins, the
lineage is cut (a lost executor does not re-run upstream stages), and
broadcast size checks on dimensions are cheap reads.  The qualified feeds
and the translation dimensions (built from small record sets) are
projections that stay lazy.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerline.functions import rules as R
from ledgerline.operators import dimensions, enrich, quality, refine
from ledgerline.operators.joins import fits
from ledgerline.sources import files, fixtures
from ledgerline.sources.sinks import latest_per_key, materialize
from ledgerline.sources.tables import Tables

#: The latest warehouse of each (application, input directory, options), with the state of the input it was built from.
_LATEST: dict[tuple[str, str, tuple], tuple[object, "Warehouse"]] = {}


class DerivedFeeds:
    """The feeds derived from the given tables (``ledgerline.sources.fixtures``)."""

    translation_order = ()

    def __init__(self, tables: Tables):
        self.t = tables

    def mapping(self) -> DataFrame:
        return fixtures.raw_mapping(self.t)

    def feed1(self) -> DataFrame:
        return fixtures.raw_dataset_1(self.t)

    def feed2(self) -> DataFrame:
        return fixtures.raw_dataset_2(self.t)

    def cities(self, mapping: DataFrame) -> DataFrame:
        return fixtures.city_translation_source(self.t)

    def districts(self, mapping: DataFrame) -> DataFrame:
        return fixtures.district_translation_source(mapping)


class LandedFeeds:
    """Feeds as they land under one folder.

    ``feed1`` (CSV) and ``feed2`` (JSON) hold ``dt=.../load_window=...`` folders,
    ``mapping`` a headed CSV, ``cities`` and ``districts`` translation records
    (JSON).  JSON files hold a record a line or, with ``array_records``, one array.
    Of rows delivered twice the later load wins.
    """

    translation_order = ("loaded_at", "load_file", "load_block", "load_row")

    def __init__(self, spark: SparkSession, root: str, array_records: bool = False):
        self.spark, self.root, self.array_records = spark, root, array_records

    def mapping(self) -> DataFrame:
        return files.read_mapping(self.spark, f"{self.root}/mapping")

    def landed_feed1(self, windows: Sequence[tuple[str, str]] | None = None) -> DataFrame:
        return files.read_landed_feed1(self.spark, f"{self.root}/feed1", windows)

    def landed_feed2(self, windows: Sequence[tuple[str, str]] | None = None) -> DataFrame:
        return files.read_landed_feed2(self.spark, f"{self.root}/feed2", self.array_records, windows)

    def feed1(self) -> DataFrame:
        rows = latest_per_key(self.landed_feed1(), ["order_id"], files.LOAD_ORDER)
        return rows.drop(*files.LOAD_ORDER)

    def feed2(self) -> DataFrame:
        rows = latest_per_key(self.landed_feed2(), ["order_id"], files.LOAD_ORDER)
        return rows.drop(*files.LOAD_ORDER)

    def cities(self, mapping: DataFrame) -> DataFrame:
        return files.read_translations(self.spark, f"{self.root}/cities", "city", self.array_records, ordered=True)

    def districts(self, mapping: DataFrame) -> DataFrame:
        return files.read_translations(self.spark, f"{self.root}/districts", "district", self.array_records, ordered=True)


#: The tables that the stored layers are made from.
INPUTS = ("region", "nation", "customer", "orders", "events")


class Warehouse:
    """Bronze, silver and gold frames with their dimensions.

    Options select the source-system variant: ``rate_type`` ('decimal' exact
    or 'float'), ``province_policy`` ('region' or 'city').
    """

    def __init__(self, spark: SparkSession, root: str, rate_type: str = "decimal",
                 province_policy: str = "region", materialize_layers: bool = True,
                 feeds: DerivedFeeds | LandedFeeds | None = None):
        self.spark = spark
        self.root = root
        self.t = Tables(spark, root)
        self.rate_type = rate_type
        self.province_policy = province_policy
        self.materialize_layers = materialize_layers
        self.feeds = feeds or DerivedFeeds(self.t)

    @classmethod
    def of(cls, spark: SparkSession, root: str, **options) -> "Warehouse":
        """The warehouse of a directory; a new one if any of its input files has changed since."""
        key = (spark.sparkContext.applicationId, root.rstrip("/"), tuple(sorted(options.items())))
        state = Tables(spark, root).state(INPUTS)
        if key not in _LATEST or _LATEST[key][0] != state:
            _LATEST[key] = (state, cls(spark, root, **options))
        return _LATEST[key][1]

    def build(self) -> "Warehouse":
        """Write the stored layers: mapping; then both feeds and the dimension size checks as
        concurrent jobs; then silver and gold."""
        _ = self.raw_mapping
        with ThreadPoolExecutor(max_workers=5) as pool:
            tasks = [pool.submit(getattr, self, "raw_dataset_1"), pool.submit(getattr, self, "raw_dataset_2")]
            tasks += [pool.submit(fits, dim)
                      for dim in (self.city_dim, self.district_dim, self.currency)]
            for task in tasks:
                task.result()
        _ = self.silver_parts
        _ = self.gold
        return self

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.materialize_layers else df

    # ------------------------------------------------------------ bronze
    @cached_property
    def raw_mapping(self) -> DataFrame:
        return self._stored(self.feeds.mapping(), "raw_mapping")

    @cached_property
    def raw_dataset_1(self) -> DataFrame:
        return self._stored(self.feeds.feed1(), "raw_dataset_1")

    @cached_property
    def raw_dataset_2(self) -> DataFrame:
        return self._stored(self.feeds.feed2(), "raw_dataset_2")

    @cached_property
    def currency(self) -> DataFrame:
        return fixtures.currency_rates(self.spark)

    @cached_property
    def city_source(self) -> DataFrame:
        return self.feeds.cities(self.raw_mapping)

    @cached_property
    def district_source(self) -> DataFrame:
        return self.feeds.districts(self.raw_mapping)

    # ------------------------------------------------------------ dimensions
    @cached_property
    def city_dim(self) -> DataFrame:
        # Built from the (small) translation records on each use; its broadcast check is memoised.
        return dimensions.city_dimension(self.city_source, self.province_policy, self.feeds.translation_order)

    @cached_property
    def district_dim(self) -> DataFrame:
        return dimensions.district_dimension(self.district_source, self.feeds.translation_order)

    # ------------------------------------------------------------ qualified
    @cached_property
    def flagged_1(self) -> DataFrame:
        """Feed 1 with the mapping-membership flag used by the id rule."""
        return quality.with_membership(self.raw_dataset_1, self.raw_mapping, "city_district_id", R.ID_KNOWN)

    @cached_property
    def qualified_1(self) -> DataFrame:
        return quality.qualify(self.flagged_1, R.feed1_rules())

    @cached_property
    def qualified_2(self) -> DataFrame:
        return quality.qualify(self.raw_dataset_2, R.feed2_rules())

    @cached_property
    def exceptions(self) -> DataFrame:
        return quality.exceptions_first(self.flagged_1, R.feed1_rules())

    # ------------------------------------------------------------ silver, gold
    @cached_property
    def silver_parts(self) -> tuple[DataFrame, DataFrame]:
        """PROCESSED_DATASET stored as its two feed parts (the keyed loads use them separately)."""
        part1, part2 = refine.silver_parts(self.qualified_1, self.qualified_2, self.raw_mapping)
        with ThreadPoolExecutor(max_workers=2) as pool:  # two independent writes, concurrent jobs
            stored = list(pool.map(lambda p: self._stored(*p), [(part1, "processed_feed1"),
                                                                (part2, "processed_feed2")]))
        return stored[0], stored[1]

    @cached_property
    def silver(self) -> DataFrame:
        part1, part2 = self.silver_parts
        return part1.unionByName(part2)

    @cached_property
    def gold(self) -> DataFrame:
        return self._stored(enrich.gold(self.silver, self.city_dim, self.district_dim, self.currency,
                                        self.rate_type), "curated_dataset")
