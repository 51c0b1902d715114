"""Edge cases of the column functions and operators on small literal frames."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import clock, rules, text
from ledgerline.operators import pagefacts, quality


def _col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def _apply(spark, fn, values, dtype="string"):
    return [r[0] for r in _col(spark, values, dtype).select(fn(F.col("v"))).collect()]


# ---------------------------------------------------------------- hours (F1, F2)

def test_rounded_hour_rounds_minutes_up(spark):
    assert _apply(spark, clock.rounded_hour, [55000, 54959, 115959, None], "int") == [6.0, 5.0, 12.0, None]


def test_clock_hour_floors(spark):
    assert _apply(spark, clock.clock_hour, [55000, 54959, 115959], "int") == [5, 5, 11]


# ---------------------------------------------------------------- quantity

def test_quantity_value_reads_float_text(spark):
    assert _apply(spark, rules.quantity_value, ["3.0", "2.7", "abc", None, "99999999999"]) == [3, 3, None, None, None]


def test_positive_quantity_three_valued(spark):
    assert _apply(spark, rules.positive_quantity, ["3.0", "0", "abc", None]) == [True, False, False, None]


def test_digits_only_rejects_trailing_newline(spark):
    assert _apply(spark, rules.digits_only, ["123", "12a", "", "123\n", None]) == [True, False, False, False, None]


# ---------------------------------------------------------------- exception logs

def _feed(spark):
    rows = [("A1", "time", 1, "-1.00", "RMB", "3.0", True),
            ("A2", "50000", 999, "1.00", "EUR", None, False),
            ("A3", "60000", 1, "2.00", "RMB", "1.0", True),
            ("A4", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "order_id string, order_time_pst string, city_district_id int, "
                                     "rptg_amt string, currency_cd string, order_qty string, _id_known boolean")
    return df.withColumn("rptg_amt", F.col("rptg_amt").cast("decimal(18,2)"))


def test_first_error_in_rule_order_and_nulls_not_flagged(spark):
    got = {r.order_id: r.validation_error for r in quality.exceptions_first(_feed(spark), rules.feed1_rules()).collect()}
    assert got == {"A1": rules.MSG_TIME, "A2": rules.MSG_ID}


def test_all_errors_counts_nulls_in_contract_mode(spark):
    errs = quality.exceptions_all(_feed(spark), rules.feed1_contract()).collect()
    fields = {(r.order_id, r.field) for r in errs}
    assert ("A1", "order_time_pst") in fields and ("A1", "rptg_amt") in fields
    assert {("A2", "city_district_id"), ("A2", "currency_cd"), ("A2", "order_qty")} <= fields
    assert {f for o, f in fields if o == "A4"} == {"order_time_pst", "city_district_id", "rptg_amt",
                                                  "currency_cd", "order_qty"}
    assert not any(o == "A3" for o, _ in fields)


def test_qualify_replaces_only_failing_values(spark):
    q = {r.order_id: r for r in quality.qualify(_feed(spark), rules.feed1_rules()).collect()}
    assert q["A1"].order_time_pst is None and q["A1"].rptg_amt is None and q["A1"].order_qty == "3.0"
    assert q["A2"].city_district_id is None and q["A2"].currency_cd is None and q["A2"].order_time_pst == "50000"
    assert "_id_known" not in quality.qualify(_feed(spark), rules.feed1_rules()).columns


# ---------------------------------------------------------------- GDP text

# text, per-capita digits, total
GDP_CASES = [
    ("US$ 64.1 billion", "64", 64099999999), ("CN¥ 1 trillion (US$ 1,234 billion)", "1234", 1234),
    ("US$ 12,345,678", "12345678", 12345678), ("no data", None, None), ("US$ ,", "", None),
    ("CN¥ 80,000 (US$ 11,037)", "11037", 11037), ("US$ 1.2.3 billion", "1", None),
    ("US$ 0.5 billion US$ 7", "0", 500000000), ("US$7", None, None), ("", None, None)]


def test_gdp_parsing_of_literal_cases(spark):
    samples = [c[0] for c in GDP_CASES]
    assert _apply(spark, text.per_capita_usd, samples) == [c[1] for c in GDP_CASES]
    assert _apply(spark, text.total_gdp_usd, samples) == [c[2] for c in GDP_CASES]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="US$ 0123456789,.bilon¥", max_size=30), min_size=1, max_size=8))
def test_gdp_parsing_property(spark, samples):
    per_capita, total = _apply(spark, text.per_capita_usd, samples), _apply(spark, text.total_gdp_usd, samples)
    for s, p, t in zip(samples, per_capita, total):
        assert p is None or set(p) <= set("0123456789") and (p == "" or p[0] in s)
        assert t is None or t >= 0
        if "US$ " not in s:
            assert p is None and t is None


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 10 ** 12), min_size=1, max_size=6))
def test_gdp_of_grouped_digits_is_the_number(spark, numbers):
    samples = [f"about US$ {n:,} then" for n in numbers]
    assert _apply(spark, text.per_capita_usd, samples) == [str(n) for n in numbers]
    assert _apply(spark, text.total_gdp_usd, samples) == numbers


# ---------------------------------------------------------------- province

def test_province_policies(spark):
    rows = [("Beijing", {"Province": '"X"'}), ("City 1", {"Province": '"ASIA"'}),
            ("City 2", {"Province": '""', "Autonomous region": "Tibet AR"}), ("City 3", {}),
            ("City 4", {"Autonomous region": '"Inner"'})]
    df = spark.createDataFrame(rows, "eng string, m map<string,string>")
    d = [r[0] for r in df.select(text.province_by_region(F.col("eng"), F.col("m"))).collect()]
    s = [r[0] for r in df.select(text.province_or_city(F.col("eng"), F.col("m"))).collect()]
    assert d == ["Beijing", "ASIA", "Tibet AR", None, "Inner"]
    assert s == ["X", "ASIA", "City 2", "City 3", "City 4"]


# ---------------------------------------------------------------- whitespace

def test_clean_text_of_literal_cases(spark):
    cases = {"a\xa0b": "a b", "  a \t\n b ": "a b", "\xa0\xa0": "", "": "", "-\n•": "- •", "a b": "a b"}
    assert _apply(spark, text.clean_text, list(cases)) == list(cases.values())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\xa0　ab-•", max_size=20), min_size=1, max_size=8))
def test_clean_text_property(spark, samples):
    once = _apply(spark, text.clean_text, samples)
    assert _apply(spark, text.clean_text, once) == once
    for raw, clean in zip(samples, once):
        assert clean == clean.strip() and "  " not in clean and "\xa0" not in clean
        assert "".join(clean.split()) == "".join(raw.split())


def test_strip_bullet(spark):
    assert _apply(spark, text.strip_bullet, ["• Per capita", "-  Total", "Total", "x- y"]) == \
        ["Per capita", "Total", "Total", "x- y"]


# ---------------------------------------------------------------- page parsing (H1, Q20)

PAGE = ("<html><head><title>Foo &amp; Bar - Wikipedia</title></head><body>"
        "<table class='wikitable'><tr><th>Ignored</th><td>x</td></tr></table>"
        "<table class='infobox vcard'><tr><th>• Total</th><td>first</td></tr>"
        "<tr><th>Area</th><td>1<sup>2</sup>\xa0 km</td></tr>"
        "<tr><th>Total</th><td>second</td></tr>"
        "<tr><th>• Total</th><td>third</td></tr>"
        "<tr><td>no header</td></tr></table></body></html>")


def test_parse_page_pairs_and_title():
    title, has_title, pairs = pagefacts.parse_page(PAGE)
    assert has_title and title == "Foo & Bar - Wikipedia"
    assert pairs == [("• Total", "first"), ("Area", "12\xa0 km"), ("Total", "second"), ("• Total", "third")]


def test_rows_and_cells_that_are_not_closed():
    box = "<title>T</title><table class=infobox>{}</table>"
    parse = lambda rows: pagefacts.parse_page(box.format(rows) + "<table><tr><th>n</th><td>m</td></tr></table>x")[2]
    assert parse("<tr><th>A<td>1<tr><th>B<td>2") == [("A", "1"), ("B", "2")]
    assert parse("<tr><th>A</th><td>1<td>other</tr><tr><td>no header") == [("A", "1")]
    assert parse("<tr><th>A<td>1<table><tr><th>in<td>2</table>after<tr><th>B<td>3") == [("A", "1in2after"), ("in", "2"), ("B", "3")]
    assert pagefacts.parse_page("<title>T</title><table class='x infobox'><tr><th>A<td>1")[2] == [("A", "1")]


def test_titles_only_and_empty_titles():
    assert pagefacts.parse_page("<title>a &amp; b</title><table class=infobox><tr><th>k<td>v", True) == ("a & b", True, [])
    assert pagefacts.parse_page("<title> \n</title>")[1] is False
    assert pagefacts.parse_page("<p>none</p>")[:2] == (None, False)


def test_infobox_facts_follow_dict_semantics(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "page_id long, html string")
    parsed = pagefacts.parse_pages(pages)
    facts = {r.meta_key: r.meta_value for r in pagefacts.infobox_facts(parsed).collect()}
    assert facts == {"Total": "second", "Area": "12 km"}  # the key first seen last, with its last value
    failures = sorted(r.page_id for r in pagefacts.page_failures(parsed).collect())
    assert failures == [2, 3]


def test_place_rules_are_optional_and_flag_unknown_places(spark):
    assert [r.field for r in rules.feed2_contract()] == ["order_time_pst", "rptg_amt", "currency_cd", "order_qty"]
    feed = spark.createDataFrame(
        [("B1", 60000, "D1", "C1", 1.0, "RMB", 1), ("B2", 60000, "Dx", "Cx", 1.0, "RMB", 1)],
        "order_id string, order_time_pst bigint, ship_to_district_name string, ship_to_city_cd string, "
        "rptg_amt double, currency_cd string, order_qty int")
    mapping = spark.createDataFrame([(1, "C1", "D1")], "city_district_id int, ship_to_city_cd string, "
                                                       "ship_to_district_name string")
    flagged = quality.with_membership(quality.with_membership(feed, mapping, "ship_to_city_cd", rules.CITY_KNOWN),
                                      mapping, "ship_to_district_name", rules.DISTRICT_KNOWN)
    errs = {(r.order_id, r.field) for r in quality.exceptions_all(flagged, rules.feed2_contract(True)).collect()}
    assert errs == {("B2", "ship_to_city_cd"), ("B2", "ship_to_district_name")}
