"""Physical-plan properties that matter at scale (read from ``explain`` output)."""

import contextlib
import io
import re

import __spark_entry__ as E
from ledgerline.plans.registry import ON_WAREHOUSE, REGISTRY
from ledgerline.plans.warehouse import Warehouse

from conftest import SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def q(spark, name):
    return E.queries()[name](spark, SMALL)


def test_gold_joins_dimensions_by_broadcast(spark):
    from ledgerline.operators import enrich
    from ledgerline.plans.warehouse import Warehouse
    w = Warehouse.of(spark, SMALL)
    p = plan(enrich.gold(w.silver, w.city_dim, w.district_dim, w.currency))
    assert "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") >= 3


def test_reports_scan_only_needed_gold_columns(spark):
    p = plan(q(spark, "top_cities_spend"))
    schemas = re.findall(r"curated_dataset[^\n]*\n(?:.*\n)*?ReadSchema: (struct<[^\n]*>)", p)
    assert schemas and all(s.count(":") == 3 for s in schemas), schemas
    assert "TakeOrderedAndProject" in p


def test_ranking_limits_groups_before_the_shuffle(spark):
    for name in ["top_city_per_hour", "best_district_per_city"]:
        p = plan(q(spark, name))
        assert "WindowGroupLimit" in p, name
        # partial aggregation below the first shuffle
        assert p.count("HashAggregate") >= 2, name


def test_overlap_and_duplicates_emit_no_pairs(spark):
    p = plan(q(spark, "feed_overlap"))
    assert "LeftSemi" in p
    p = plan(q(spark, "duplicate_orders"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def _top_level_groups(args: str) -> int:
    depth, groups = 0, 0
    for ch in args:
        if ch == "[":
            if depth == 0:
                groups += 1
            depth += 1
        elif ch == "]":
            depth -= 1
    return groups


def global_windows(p: str) -> list[str]:
    """Window nodes without a partition spec (their Arguments have only [exprs], [order])."""
    out = []
    for m in re.finditer(r"\(\d+\) Window\n(?:.*\n)*?Arguments: (.*)\n", p):
        if _top_level_groups(m.group(1)) < 3:
            out.append(m.group(1))
    return out


def test_no_single_partition_windows_in_registered_queries(spark):
    skip = {"tier_elbow", "city_tiers_kmeans", "stream_ingest_feed2"}  # iterative / streaming on build
    for name in sorted(set(REGISTRY) - skip):
        assert global_windows(plan(q(spark, name))) == [], name


def test_global_window_detector(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("t", F.ntile(3).over(Window.orderBy("id")))
    assert len(global_windows(plan(df))) == 1


def test_window_read_prunes_partitions(spark):
    p = plan(q(spark, "window_read_pruned"))
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", p)
    assert filters and "load_window" in filters[0] and "dt" in filters[0]


def test_no_pairs_and_no_single_task_over_key_sets(spark):
    """Nested loops only meet one-row frames; key sets are not counted or gathered in one task."""
    one_row = {"tier_checks", "city_zscores"}  # joins with frames of one row
    skip = {"tier_elbow", "city_tiers_kmeans", "stream_ingest_feed2"}
    for name in sorted(set(REGISTRY) - skip - one_row):
        p = plan(q(spark, name))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name
    for name in ("duplicate_orders", "feed_overlap", "upsert_orders", "silver_orders_contract", "city_name_contains_match"):
        assert "SinglePartition" not in plan(q(spark, name)), name


def test_profiles_and_table_tests_read_what_they_need(spark):
    p = plan(q(spark, "profile_columns"))
    assert "Expand" not in p and p.count("Generate") <= 2 * 2  # only the one-row results are unpivoted
    assert plan(q(spark, "dq_not_null")).count("Scan parquet") <= 2 * 6  # each scan is listed in the tree and below it
    w = Warehouse.of(spark, SMALL)
    assert plan(ON_WAREHOUSE["page_city_dimension"](w)).count("MapInPandas") == 0  # reads the stored parse
