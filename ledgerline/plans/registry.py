"""Named queries: ``name -> (spark, data_dir) -> DataFrame``.

Each query takes the layered plan of one input directory (``Warehouse``) and
returns a lazy DataFrame; queries that exercise a sink write their data first
and return what they read back.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.functions import rules as R
from ledgerline.operators import dimensions, enrich, pagefacts, profile, quality, refine, reports, tiers
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.plans.warehouse import LandedFeeds, Warehouse
from ledgerline.plans.windows import WindowedLayers
from ledgerline.session import scratch_path
from ledgerline.sources import files, fixtures, sinks
from ledgerline.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
#: The same queries on a warehouse that the caller holds.
ON_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {}

ACCEPTED_CURRENCIES = ["USD", "RMB"]
LOAD_DATE = "20240723"


def register(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        ON_WAREHOUSE[name] = fn
        REGISTRY[name] = lambda spark, root: fn(Warehouse.of(spark, root))
        return fn
    return deco


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ layers
register("qualify_feed1")(lambda w: w.qualified_1)
register("qualify_feed2")(lambda w: w.qualified_2)
register("exceptions_first_error")(lambda w: w.exceptions)
register("silver_orders")(lambda w: w.silver)
register("gold_orders")(lambda w: w.gold)
register("gold_orders_float_rate")(lambda w: enrich.gold(w.silver, w.city_dim, w.district_dim, w.currency, "float"))


@register("silver_orders_contract")
def _silver_contract(w: Warehouse) -> DataFrame:
    """Row-contract variant of silver: feed 1 repaired by its contract rules, feed 2 only
    validated (values kept), both upserted by order id with the feed-2 load winning."""
    q1 = quality.qualify(w.flagged_1, R.feed1_contract())
    q2 = quality.qualify(w.raw_dataset_2, R.feed2_contract(), mode="log")
    part1, part2 = refine.silver_parts(q1, q2, w.raw_mapping)
    return sinks.upsert(part1, part2, ["order_id"], ())


# ------------------------------------------------------------------ analyst reports
register("province_spend")(lambda w: reports.province_spend(w.gold, w.city_dim, w.district_dim))
register("top_provinces")(lambda w: reports.top_provinces(w.gold, w.city_dim))
register("distinct_provinces")(lambda w: reports.distinct_provinces(w.city_dim))
register("top_cities_spend")(lambda w: reports.top_cities_spend(w.gold))
register("top_cities_orders")(lambda w: reports.top_cities_orders(w.gold))
register("top_transactions")(lambda w: reports.top_transactions(w.gold))
register("top_city_per_hour")(lambda w: reports.top_city_per_hour(w.gold))
register("top_city_per_hour_english")(lambda w: reports.top_city_per_hour_english(w.gold))
register("top_city_hour_pairs")(lambda w: reports.top_city_hour_pairs(w.gold))
register("top_city_hour_pairs_english")(lambda w: reports.top_city_hour_pairs_english(w.gold, 5))
register("spend_per_hour")(lambda w: reports.spend_per_hour(w.gold))
register("best_district_per_city")(lambda w: reports.best_district_per_city(w.gold))
register("city_gdp_spend")(lambda w: reports.city_gdp_spend(w.gold, w.city_dim))
register("spend_gdp_corr")(lambda w: reports.spend_gdp_corr(w.gold, w.city_dim))


def _identifiers(w: Warehouse, key: str) -> DataFrame:
    """Every occurrence of an identifier in feed 2 and the mapping (U2 input)."""
    return w.raw_dataset_2.select(key).unionByName(w.raw_mapping.select(key))


register("coverage_cities")(lambda w: reports.translation_coverage(
    _identifiers(w, "ship_to_city_cd"), w.city_dim, "ship_to_city_cd"))
register("coverage_districts")(lambda w: reports.translation_coverage(
    _identifiers(w, "ship_to_district_name"), w.district_dim, "ship_to_district_name"))
register("coverage_matched_only")(lambda w: reports.translation_coverage(
    _identifiers(w, "ship_to_city_cd"), w.city_dim, "ship_to_city_cd", matched_only=True))

# ------------------------------------------------------------------ exception logs and table tests


def _all_errors(w: Warehouse) -> DataFrame:
    """Every failing rule of both feeds (row-contract variant)."""
    e1 = quality.exceptions_all(w.flagged_1, R.feed1_contract(), source="feed1")
    e2 = quality.exceptions_all(w.raw_dataset_2, R.feed2_contract(), source="feed2")
    return e1.unionByName(e2)


register("exceptions_all_errors")(_all_errors)
@register("exceptions_places")
def _exceptions_places(w: Warehouse) -> DataFrame:
    """Feed 2 under its contract with the place rules on."""
    flagged = quality.with_membership(
        quality.with_membership(w.raw_dataset_2, w.raw_mapping, "ship_to_city_cd", R.CITY_KNOWN),
        w.raw_mapping, "ship_to_district_name", R.DISTRICT_KNOWN)
    return quality.exceptions_all(flagged, R.feed2_contract(True), source="feed2")


register("exceptions_json")(lambda w: quality.exceptions_json(_all_errors(w)))


def _layers(w: Warehouse) -> list[tuple[str, DataFrame]]:
    return [("qualified_dataset_1", w.qualified_1), ("qualified_dataset_2", w.qualified_2),
            ("processed_dataset", w.silver), ("curated_dataset", w.gold)]


register("dq_unique")(lambda w: _union([quality.dq_unique(df, n, "order_id") for n, df in _layers(w)]))
register("dq_not_null")(lambda w: _union([
    quality.dq_not_null(df, n, "order_id", *(["rptg_amt"] if "rptg_amt" in df.columns else []),
                        *(["ship_to_district_name"] if n == "qualified_dataset_2" else []))
    for n, df in _layers(w)]))
register("dq_relationships")(lambda w: _union([
    quality.dq_relationships(w.qualified_1, "qualified_dataset_1", "city_district_id", w.raw_mapping,
                             "city_district_id"),
    quality.dq_relationships(w.raw_dataset_1, "raw_dataset_1", "city_district_id", w.raw_mapping,
                             "city_district_id")]))
register("dq_accepted_values")(lambda w: _union(
    [quality.dq_accepted_values(df, n, "currency_cd", ACCEPTED_CURRENCIES) for n, df in _layers(w)[:3]]))

#: The tests that the tables declare.
DECLARED_TESTS = [
    *[quality.Test(t, "order_id", kind) for t in ("qualified_dataset_1", "qualified_dataset_2", "processed_dataset", "curated_dataset")
      for kind in ("unique", "not_null")],
    *[quality.Test(t, c, kind, None, tuple(values)) for t in ("qualified_dataset_1", "qualified_dataset_2", "processed_dataset")
      for c, kind, values in (("rptg_amt", "not_null", ()), ("currency_cd", "accepted_values", ACCEPTED_CURRENCIES))],
    quality.Test("qualified_dataset_2", "ship_to_district_name", "not_null"),
    *[quality.Test(t, "city_district_id", "relationships", ("raw_mapping", "city_district_id"))
      for t in ("qualified_dataset_1", "raw_dataset_1")]]


def _tested(w: Warehouse) -> dict[str, DataFrame]:
    return {**dict(_layers(w)), "raw_dataset_1": w.raw_dataset_1, "raw_mapping": w.raw_mapping}


register("dq_report")(lambda w: quality.test_report(_tested(w), DECLARED_TESTS))
register("dq_failing_rows")(lambda w: quality.failing_rows(_tested(w), DECLARED_TESTS))


@register("feed1_outputs")
def _feed1_outputs(w: Warehouse) -> DataFrame:
    """The three outputs of feed 1, written in one pass and read back."""
    read = sinks.write_tagged(quality.tagged(w.flagged_1, R.feed1_rules(), R.feed1_contract()), scratch_path(w.spark, "feed1_outputs"))
    return _union([read(tag).withColumn("tag", F.lit(tag)) for tag in (quality.CLEAN, quality.FIRST_ERROR, quality.ALL_ERRORS)])

# ------------------------------------------------------------------ dimensions
register("city_dimension_d")(lambda w: w.city_dim.drop("metadata"))
register("city_dimension_s")(lambda w: dimensions.city_dimension(w.city_source, "city").drop("metadata"))
register("district_dimension")(lambda w: dimensions.metadata_json(w.district_dim))
register("metadata_explode")(lambda w: dimensions.explode_metadata(w.city_dim))
register("city_mapping_preview")(lambda w: dimensions.preview(dimensions.metadata_json(w.city_dim), 10))


def _worklist(w: Warehouse, key: str, dim: DataFrame) -> DataFrame:
    """H2: distinct identifiers of feed 2 and the mapping that have no translation yet."""
    ids = _identifiers(w, key).distinct()
    done = bounded_broadcast(dim.select(F.col(key).alias("_done")), basis=dim)
    return ids.join(done, ids[key] == done["_done"], "left_anti")


register("translation_worklist")(lambda w: _worklist(w, "ship_to_city_cd", w.city_dim))
register("translation_worklist_districts")(lambda w: _worklist(w, "ship_to_district_name", w.district_dim))

# ------------------------------------------------------------------ profiling
register("duplicate_orders")(lambda w: profile.duplicate_rows(w.silver, "order_id"))
register("feed_overlap")(lambda w: profile.feed_overlap(w.raw_dataset_1, w.raw_dataset_2))
register("unmapped_ids")(lambda w: profile.unmapped_rows(w.raw_dataset_1, w.raw_mapping, "city_district_id"))
register("unjoinable_reasons")(lambda w: profile.unjoinable_reasons(w.raw_dataset_2, w.raw_mapping))
register("missing_dimension_values")(lambda w: profile.missing_values(
    w.raw_dataset_2, w.raw_mapping, ["ship_to_city_cd", "ship_to_district_name"]))
register("unjoinable_orders")(lambda w: profile.unjoinable_rows(w.raw_dataset_2, w.raw_mapping))
register("mapping_name_contains_match")(lambda w: profile.contains_match(
    w.raw_mapping, w.city_source, "ship_to_city_cd", "ship_to_city_cd").where("NOT city_match"))
register("city_name_contains_match")(lambda w: profile.contains_match(
    w.raw_dataset_2, w.city_source, "ship_to_city_cd", "ship_to_city_cd"))
register("profile_columns")(lambda w: profile.column_profile(w.raw_dataset_1, "raw_dataset_1")
                            .unionByName(profile.column_profile(w.raw_dataset_2, "raw_dataset_2")))
register("new_values_by_hour")(lambda w: profile.new_values(
    w.raw_dataset_2.withColumn("hour", F.coalesce(F.floor(F.col("order_time_pst") / 10000).cast("int"), F.lit(-1))),
    "raw_dataset_2", "hour", w.raw_dataset_2.columns))
register("describe_columns")(lambda w: profile.describe_numeric(
    w.raw_dataset_1, "raw_dataset_1", ["city_district_id", "rptg_amt"]).unionByName(profile.describe_numeric(
        w.raw_dataset_2, "raw_dataset_2", ["order_time_pst", "rptg_amt", "order_qty"])))
register("rule_failure_counts")(lambda w: profile.rule_failure_counts(w.raw_dataset_1, "raw_dataset_1")
                                .unionByName(profile.rule_failure_counts(w.raw_dataset_2, "raw_dataset_2")))

# ------------------------------------------------------------------ sources and sinks


@register("csv_roundtrip")
def _csv_roundtrip(w: Warehouse) -> DataFrame:
    """Feed 1 written as a headed CSV export and read back typed."""
    path = scratch_path(w.spark, "feed1_csv")
    files.write_feed1_csv(w.raw_dataset_1, path)
    return files.read_feed1_csv(w.spark, path)


@register("json_roundtrip")
def _json_roundtrip(w: Warehouse) -> DataFrame:
    """S3: feed 2 written as JSON records and read back with the declared schema."""
    path = scratch_path(w.spark, "feed2_json")
    files.write_feed2_json(w.raw_dataset_2, path)
    return files.read_feed2_json(w.spark, path)


@register("translations_json_roundtrip")
def _translations_roundtrip(w: Warehouse) -> DataFrame:
    """S4 + F5-F8: city records through JSON (metadata as a map), then the dimension."""
    path = scratch_path(w.spark, "city_translations_json")
    files.write_translations(w.city_source, path)
    src = files.read_translations(w.spark, path, "city")
    return dimensions.city_dimension(src, w.province_policy).drop("metadata")


@register("full_refresh")
def _full_refresh(w: Warehouse) -> DataFrame:
    """The exception table rebuilt twice; the second version replaces the first."""
    path = scratch_path(w.spark, "exceptions_table")
    sinks.full_refresh(w.exceptions, path)
    return sinks.full_refresh(w.exceptions, path)


def _with_window(df: DataFrame, window: str) -> DataFrame:
    return df.withColumn("dt", F.lit(LOAD_DATE)).withColumn("load_window", F.lit(window))


def _write_windows(w: Warehouse, path: str) -> None:
    part1, part2 = w.silver_parts
    both = _with_window(part1, "window1").unionByName(_with_window(part2, "window2"))
    sinks.overwrite_windows(both, path, WINDOW, [(LOAD_DATE, "window1"), (LOAD_DATE, "window2")])


WINDOW = files.WINDOW
WINDOWED_SCHEMA = T.StructType([*schemas.PROCESSED.fields, *[T.StructField(c, T.StringType()) for c in WINDOW]])


@register("window_overwrite")
def _window_overwrite(w: Warehouse) -> DataFrame:
    """Load both windows, then re-run window1 (backfill); the table must be unchanged."""
    path = scratch_path(w.spark, "silver_windows")
    _write_windows(w, path)
    sinks.overwrite_windows(_with_window(w.silver_parts[0], "window1"), path, WINDOW, [(LOAD_DATE, "window1")])
    return w.spark.read.schema(WINDOWED_SCHEMA).parquet(path)


@register("window_read_pruned")
def _window_read(w: Warehouse) -> DataFrame:
    """S14 read side: only the files of one (dt, load_window) partition are listed and scanned."""
    path = scratch_path(w.spark, "silver_windows_read")
    _write_windows(w, path)
    return (w.spark.read.schema(WINDOWED_SCHEMA).parquet(path)
            .where((F.col("dt") == LOAD_DATE) & (F.col("load_window") == "window2")))


@register("upsert_orders")
def _upsert_orders(w: Warehouse) -> DataFrame:
    """Feed-2 rows upserted on order_id into the feed-1 rows (later load wins)."""
    part1, part2 = w.silver_parts
    return sinks.upsert(part1, part2, ["order_id"], ())


def _redelivered(feed: DataFrame) -> DataFrame:
    """The feed in two loads: all rows, and a second delivery of the orders whose id ends in 7 with a smaller
    amount and no quantity."""
    again = feed.where(F.col("order_id").endswith("7")).withColumn(
        "rptg_amt", F.lit(0.5).cast(feed.schema["rptg_amt"].dataType)).withColumn(
        "order_qty", F.lit(None).cast(feed.schema["order_qty"].dataType))
    return feed.withColumn("load_seq", F.lit(1)).unionByName(again.withColumn("load_seq", F.lit(2)))


@register("upsert_raw_feed1")
def _upsert_raw_feed1(w: Warehouse) -> DataFrame:
    """Feed 1 with orders delivered twice, both loads in one batch; the corrections must win."""
    path = scratch_path(w.spark, "raw_dataset_1_keyed")
    return sinks.upsert_table(w.spark, path, _redelivered(w.raw_dataset_1), ["order_id"], ["load_seq"]).drop("load_seq")


@register("upsert_raw_feed2")
def _upsert_raw_feed2(w: Warehouse) -> DataFrame:
    """Feed 2 the same way, but loaded in two calls, the later load first."""
    path = scratch_path(w.spark, "raw_dataset_2_keyed")
    both = _redelivered(w.raw_dataset_2)
    sinks.upsert_table(w.spark, path, both.where("load_seq = 2"), ["order_id"], ["load_seq"])
    return sinks.upsert_table(w.spark, path, both.where("load_seq = 1"), ["order_id"], ["load_seq"]).drop("load_seq")


@register("upsert_currency")
def _upsert_currency(w: Warehouse) -> DataFrame:
    """Rates by code, updated by a sheet made from the feed (orders per code in units of 10,000)."""
    path = scratch_path(w.spark, "currency_keyed")
    known = w.currency.select("currency_cd", "multiplier").withColumn("load_seq", F.lit(1))
    sheet = (w.raw_dataset_1.where("currency_cd <> 'RMB'").groupBy("currency_cd")
             .agg((F.count(F.lit(1)) / 10000).cast("decimal(10,4)").alias("multiplier")).withColumn("load_seq", F.lit(2)))
    sinks.upsert_table(w.spark, path, known, ["currency_cd"], ["load_seq"])
    return sinks.upsert_table(w.spark, path, sheet, ["currency_cd"], ["load_seq"]).drop("load_seq")


@register("upsert_gold")
def _upsert_gold(w: Warehouse) -> DataFrame:
    """S9d: gold keyed by order, feed 1 and feed 2 as two loads; feed 2 wins an id that both hold."""
    path = scratch_path(w.spark, "curated_keyed")
    out = None
    for seq, part in enumerate(w.silver_parts):
        rows = enrich.gold(part, w.city_dim, w.district_dim, w.currency).withColumn("load_seq", F.lit(seq))
        out = sinks.upsert_table(w.spark, path, rows, ["order_id"], ["load_seq"])
    return out.drop("load_seq")


def _wrong_amounts(rows: DataFrame, which: Column) -> DataFrame:
    """``rows`` with a wrong amount where ``which`` holds."""
    wrong = F.lit(99999999.99).cast(schemas.MONEY)
    return rows.withColumn("rptg_amt", F.when(which, wrong).otherwise(F.col("rptg_amt")))


def _land_window(w: Warehouse, root: str, window: str, make: Callable[[DataFrame], DataFrame], array_records: bool = False) -> None:
    """Both feeds as one window delivers them: the rows that ``make`` gives of a feed."""
    folder = f"dt={LOAD_DATE}/load_window={window}"
    files.write_feed1_csv(make(w.raw_dataset_1), f"{root}/feed1/{folder}")
    files.write_feed2_json(make(w.raw_dataset_2), f"{root}/feed2/{folder}", array_records)


def _land_dimensions(w: Warehouse, root: str, array_records: bool = False) -> None:
    files.write_mapping(w.raw_mapping, f"{root}/mapping")
    files.write_translations(w.city_source, f"{root}/cities", array_records)
    files.write_translations(w.district_source, f"{root}/districts", array_records)


@register("landed_gold_orders")
def _landed_gold(w: Warehouse) -> DataFrame:
    """All feeds written as they land (two windows, one re-delivery each), read back, refined to gold."""
    root, late = scratch_path(w.spark, "landing"), F.col("order_id").endswith("7")
    # The first window delivers late orders wrongly; the second has them right.
    _land_window(w, root, "window1", lambda rows: _wrong_amounts(rows, late))
    _land_window(w, root, "window2", lambda rows: rows.where(late))
    _land_dimensions(w, root)
    return Warehouse(w.spark, w.root, feeds=LandedFeeds(w.spark, root)).gold


@register("landed_array_gold_orders")
def _landed_array_gold(w: Warehouse) -> DataFrame:
    """S3: the same with feed 2 and the translations as JSON arrays, each file read by several tasks."""
    root, late = scratch_path(w.spark, "landing_arrays"), F.col("order_id").endswith("7")
    _land_window(w, root, "window2", lambda rows: _wrong_amounts(rows, late), True)
    _land_window(w, root, "window10", lambda rows: rows.where(late), True)
    _land_dimensions(w, root, True)
    return Warehouse(w.spark, w.root, feeds=LandedFeeds(w.spark, root, array_records=True)).gold


@register("backfill_window_gold")
def _backfill_window(w: Warehouse) -> DataFrame:
    """window10 first delivers right corrections and, wrongly, orders that end in 3; it is landed and loaded again
    without the latter, which then count as window2 delivered them."""
    root = scratch_path(w.spark, "landing_windows")
    late, stray = F.col("order_id").endswith("7"), F.col("order_id").endswith("3")
    _land_window(w, root, "window2", lambda rows: _wrong_amounts(rows, late))
    _land_window(w, root, "window10", lambda rows: _wrong_amounts(rows.where(late | stray), stray))
    _land_dimensions(w, root)
    layers = WindowedLayers(Warehouse(w.spark, w.root, feeds=LandedFeeds(w.spark, root)), scratch_path(w.spark, "window_layers"))
    layers.reload([(LOAD_DATE, "window2"), (LOAD_DATE, "window10")])
    _land_window(w, root, "window10", lambda rows: rows.where(late))
    layers.reload([(LOAD_DATE, "window10")])
    return layers.current()


@register("load_metrics")
def _load_metrics(w: Warehouse) -> DataFrame:
    """Bronze tables written once, row counts observed during the write."""
    root = scratch_path(w.spark, "bronze")
    return sinks.write_with_metrics({"raw_dataset_1": w.raw_dataset_1, "raw_dataset_2": w.raw_dataset_2,
                                     "raw_mapping": w.raw_mapping}, root)


@register("stream_ingest_feed2")
def _stream_ingest(w: Warehouse) -> DataFrame:
    """Feed 2 landed as two window folders, ingested by the streaming job, read back."""
    landing = scratch_path(w.spark, "landing_feed2")
    even = F.floor(F.col("order_time_pst") / 10000) % 2 == 0
    for k, part in enumerate((even, ~even | F.col("order_time_pst").isNull()), 1):
        files.write_feed2_json(w.raw_dataset_2.where(part), f"{landing}/dt={LOAD_DATE}/load_window=window{k}")
    table = scratch_path(w.spark, "feed2_streamed")
    q = ingest.start_feed2_ingest(w.spark, landing, table, scratch_path(w.spark, "feed2_stream_ckpt"),
                                  exceptions_path=table + "_exceptions")
    q.awaitTermination()
    return sinks.read_table(w.spark, table).drop(*files.LOAD_ORDER)


@register("stream_load_metrics")
def _stream_metrics(w: Warehouse) -> DataFrame:
    """S13 of a streamed load: feed 2 in two windows, a file a trigger; the second delivers some orders again."""
    landing, table = scratch_path(w.spark, "landing_metrics"), scratch_path(w.spark, "feed2_metered")
    files.write_feed2_json(w.raw_dataset_2.coalesce(1), f"{landing}/dt={LOAD_DATE}/load_window=window1")
    ckpt, metrics = scratch_path(w.spark, "metered_ckpt"), table + "_metrics"

    def run() -> None:
        ingest.start_feed2_ingest(w.spark, landing, table, ckpt, metrics_path=metrics).awaitTermination()
    run()
    again = w.raw_dataset_2.where(F.col("order_id").endswith("7"))
    files.write_feed2_json(again, f"{landing}/dt={LOAD_DATE}/load_window=window2")
    run()
    return w.spark.read.parquet(metrics).select(F.col("epoch").cast("bigint").alias("epoch"), "rows_read", "rows_rejected",
                                                "keys_inserted", "keys_replaced", "keys_outdated")


# ------------------------------------------------------------------ spend tiers
def _totals(w: Warehouse) -> DataFrame:
    return tiers.city_totals(w.gold, w.city_dim)


register("city_zscores")(lambda w: tiers.zscores(_totals(w)).withColumn(
    "normalized_sales", F.round("normalized_sales", 8)))
register("city_tiers_kmeans")(lambda w: tiers.kmeans_tiers(_totals(w), 3).withColumn(
    "normalized_sales", F.round("normalized_sales", 8)))
register("tier_checks")(lambda w: tiers.tier_checks(_totals(w), 3))
register("tier_elbow")(lambda w: tiers.elbow(tiers.zscores(_totals(w))))
register("city_tiers_ntile")(lambda w: tiers.ntile_tiers(_totals(w), 3))

# ------------------------------------------------------------------ page facts


def _all_pages(w: Warehouse) -> DataFrame:
    """The driver's raw pages plus the rendered city pages."""
    return w.t.pages.select("page_id", "url", "html").unionByName(
        fixtures.city_pages(w.t).select("page_id", "url", "html"))


def _page_city_dimension(w: Warehouse) -> DataFrame:
    """H1 end to end: city pages -> parsed records -> city dimension (must equal the direct build)."""
    pages = fixtures.city_pages(w.t)
    parsed = sinks.materialize(pagefacts.parse_pages(pages), "parsed_city_pages")
    records = pagefacts.translation_records(parsed, pages.select("page_id", "ship_to_city_cd"))
    return dimensions.city_dimension(records, w.province_policy).drop("metadata")


def _page_district_dimension(w: Warehouse) -> DataFrame:
    """H1 for the second identifier: district pages -> parsed records -> district dimension."""
    pages = fixtures.district_pages(w.raw_mapping)
    parsed = sinks.materialize(pagefacts.parse_pages(pages), "parsed_district_pages")
    records = pagefacts.translation_records(parsed, pages.select("page_id", "ship_to_district_name"), "ship_to_district_name")
    return dimensions.district_dimension(records).drop("metadata")


register("page_district_dimension")(_page_district_dimension)
register("page_titles")(lambda w: pagefacts.page_titles(pagefacts.parse_pages(w.t.pages, titles_only=True)))
register("page_failures")(lambda w: pagefacts.page_failures(pagefacts.parse_pages(_all_pages(w))))
register("page_infobox")(lambda w: pagefacts.infobox_facts(pagefacts.parse_pages(_all_pages(w))))
register("page_city_dimension")(_page_city_dimension)
