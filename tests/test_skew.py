"""Hot keys: one city / order id holding a third of all rows, checked against pandas brute force."""

import decimal
import random

import pandas as pd
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import profile, quality, reports
from ledgerline.sources import sinks

N = 3000


def _gold(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(N):
        city = "HOT" if i % 3 == 0 else f"C{rnd.randint(0, 20)}"
        district = f"D{rnd.randint(0, 4)}"
        t = rnd.choice([None, rnd.randint(50000, 115959)])
        amt = decimal.Decimal(rnd.randint(0, 100000)) / 100
        rows.append((f"O{i}", t, city, district, district.lower(), city.lower(), amt, rnd.randint(1, 9)))
    return spark.createDataFrame(rows, schemas.CURATED)


def test_hot_city_hour_winner_matches_pandas(spark):
    gold = _gold(spark)
    got = {(r.order_hour_pst, r.ship_to_city_cd, r.total_sales) for r in reports.top_city_per_hour(gold).collect()}
    pdf = gold.toPandas()
    pdf["h"] = (pdf["order_time_pst"].astype("float") / 10000).map(lambda x: None if pd.isna(x) else float(int(x + 0.5)))
    sums = pdf.groupby(["h", "ship_to_city_cd"], dropna=False)["rmb_dollars"].sum().reset_index()
    want = set()
    for h, grp in sums.groupby("h", dropna=False):
        best = sorted(grp.itertuples(), key=lambda r: (-r.rmb_dollars, r.ship_to_city_cd))[0]
        want.add((None if pd.isna(h) else h, best.ship_to_city_cd, best.rmb_dollars))
    assert got == want


def test_hot_city_district_average_matches_pandas(spark):
    gold = _gold(spark)
    got = {(r.ship_to_city_cd, r.ship_to_district_name): r.top_avg_sales
           for r in reports.best_district_per_city(gold, k=100).collect()}
    pdf = gold.toPandas()
    pdf["x"] = pdf["rmb_dollars"].astype(float)
    avg = pdf.groupby(["ship_to_city_cd", "ship_to_district_name"])["x"].mean().reset_index()
    want = {}
    for city, grp in avg.groupby("ship_to_city_cd"):
        best = sorted(grp.itertuples(), key=lambda r: (-r.x, r.ship_to_district_name))[0]
        want[(city, best.ship_to_district_name)] = best.x
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.5e-4 + 1e-9 for k in want)  # rounded to 4 decimals


def test_hot_key_duplicates_and_dedupe(spark):
    rows = [("HOT", i, f"v{i}") for i in range(1000)] + [(f"K{i}", 0, "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "order_id string, seq int, v string")
    dups = profile.duplicate_rows(df, "order_id")
    assert dups.count() == 1000 and {r.n_records for r in dups.select("n_records").distinct().collect()} == {1000}
    latest = {r.order_id: r.v for r in sinks.latest_per_key(df, ["order_id"], ["seq"]).collect()}
    assert len(latest) == 2001 and latest["HOT"] == "v999"


def test_hot_order_error_array_stays_bounded(spark):
    errors = spark.createDataFrame([("HOT", "rptg_amt", "bad")] * 1000 + [("HOT", "order_qty", "bad")] * 5
                                   + [("A1", "rptg_amt", "bad")], "order_id string, field string, message string")
    out = {r.order_id: r.error_message for r in quality.exceptions_json(errors).collect()}
    assert out["HOT"] == '[{"field":"order_qty","message":"bad","n":5},{"field":"rptg_amt","message":"bad","n":1000}]'
    assert out["A1"] == '[{"field":"rptg_amt","message":"bad","n":1}]'


def test_pipeline_with_a_customer_holding_a_third_of_orders(spark, tmp_path):
    """Skewed inputs: one customer owns every third order and event; Spark matches the SQL oracle."""
    import os
    import sys

    import duckdb

    import __spark_entry__ as E
    from conftest import SMALL
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import canon, duck

    out = str(tmp_path)
    con = duckdb.connect()
    hot = con.execute(f"SELECT min(c_custkey) FROM '{SMALL}/customer.parquet'").fetchone()[0]
    for name in ["region", "nation", "customer", "pages"]:
        con.execute(f"COPY (SELECT * FROM '{SMALL}/{name}.parquet') TO '{out}/{name}.parquet' (FORMAT PARQUET)")
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN {hot} ELSE o_custkey END AS o_custkey)"
                f" FROM '{SMALL}/orders.parquet') TO '{out}/orders.parquet' (FORMAT PARQUET)")
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN {hot} ELSE user_id END AS user_id)"
                f" FROM '{SMALL}/events.parquet') TO '{out}/events.parquet' (FORMAT PARQUET)")
    oracle = duck(out)
    for name in ["gold_orders", "top_city_per_hour", "province_spend", "best_district_per_city",
                 "duplicate_orders", "upsert_orders", "coverage_cities", "city_tiers_ntile"]:
        df = E.queries()[name](spark, out)
        res = oracle.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall()), name
