"""Property tests: operators against small Python models of their semantics."""

import decimal
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.operators import quality, reports
from ledgerline.sources import sinks

MAPPING_IDS = {11, 12, 13}

times = st.sampled_from(["time", "50000", "123456", "", "12a", None, "0", "115959"])
ids = st.sampled_from([11, 12, 999999, 0, None])
amounts = st.sampled_from(["1.50", "-0.01", "0.00", None])
currencies = st.sampled_from(["USD", "RMB", "EUR", None])
quantities = st.sampled_from(["3.0", "0", "abc", None, "2.7", "-1.0"])
rows = st.lists(st.tuples(times, ids, amounts, currencies, quantities), min_size=1, max_size=25)


def py_first_error(t, i, a, c, q):
    """SQL three-valued logic: a NULL check is neither valid nor an error."""
    def check_qty(v):
        if v is None:
            return None
        try:
            x = float(v)
        except ValueError:
            return False
        return math.copysign(math.floor(abs(x) + 0.5), x) > 0  # text read as a number, half away from zero
    checks = [
        (None if t is None else (t.isdigit() and t.isascii()), rules.MSG_TIME),
        (None if i is None else i in MAPPING_IDS, rules.MSG_ID),
        (None if a is None else decimal.Decimal(a) >= 0, rules.MSG_AMT),
        (None if c is None else c in ("USD", "RMB"), rules.MSG_CURRENCY),
        (check_qty(q), rules.MSG_QTY),
    ]
    for ok, msg in checks:
        if ok is False:
            return msg
    return None


@settings(max_examples=15, deadline=None)
@given(rows)
def test_first_error_matches_three_valued_model(spark, data):
    keyed = [(f"A{n}",) + r for n, r in enumerate(data)]
    df = spark.createDataFrame(keyed, "order_id string, order_time_pst string, city_district_id int, "
                                      "rptg_amt string, currency_cd string, order_qty string")
    df = df.withColumn("rptg_amt", F.col("rptg_amt").cast("decimal(18,2)"))
    mapping = spark.createDataFrame([(i,) for i in sorted(MAPPING_IDS)], "city_district_id int")
    flagged = quality.with_membership(df, mapping, "city_district_id", rules.ID_KNOWN)
    got = {r.order_id: r.validation_error for r in quality.exceptions_first(flagged, rules.feed1_rules()).collect()}
    want = {k[0]: py_first_error(*k[1:]) for k in keyed}
    assert got == {k: v for k, v in want.items() if v is not None}


updates_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.text("abc", max_size=2)), max_size=20)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.text("xyz", max_size=2)), max_size=10, unique_by=lambda r: r[0]),
       updates_st)
def test_upsert_matches_dict_model(spark, target, updates):
    t = spark.createDataFrame(target, "k int, v string")
    u = spark.createDataFrame(updates, "k int, seq int, v string")
    dedup = sinks.latest_per_key(u, ["k"], ["seq", "v"]).drop("seq")
    got = sorted(tuple(r) for r in sinks.upsert(t, dedup, ["k"], ()).collect())
    model = dict(target)
    best = {}
    for k, seq, v in updates:
        if k not in best or (seq, v) > best[k]:
            best[k] = (seq, v)
    model.update({k: v for k, (seq, v) in best.items()})
    assert got == sorted(model.items())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=20),
       st.lists(st.sampled_from(["a", "b", "z", None]), max_size=6))
def test_coverage_counts_null_identifier_once(spark, idents, translated):
    ids_df = spark.createDataFrame([(x,) for x in idents], "k string")
    tr_df = spark.createDataFrame([(x,) for x in translated], "k string")
    r = reports.translation_coverage(ids_df, tr_df, "k").first()
    unique = len(set(idents))  # a set keeps None as one value, like SELECT DISTINCT
    assert (r.translated_count, r.unique_count) == (len(translated), unique)
    assert r.percentage == round(len(translated) / unique * 100, 6)
