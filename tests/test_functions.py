import math
from html import unescape
from html.entities import html5
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketframe.functions import codes, normalize as n, pricing, timefmt as tf
from marketframe.schemas import raw_schema, raw_tables


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_map_values(spark):
    got = column(spark, ["0", "I", "zz", None, ""], lambda c: codes.map_values(c, codes.RULE_80A))
    assert got == [None, "Individual", "UNKNOWN(zz)", None, None]
    assert column(spark, [3, 9], lambda c: codes.map_values(c, codes.OCA_TYPE), "int") == ["ReduceNonBlock", "UNKNOWN(9)"]


def test_order_codes_are_named_in_place(spark):
    df = spark.createDataFrame([(1, 8, "C", "x")], "OcaType int, TriggerMethod int, OpenClose string, Other string")
    assert tuple(codes.name_order_codes(df).first()) == ("CancelWithBlock", "MidPoint", "Close", "x")


def test_special_conditions(spark):
    got = column(spark, ["T I", "", None, "T T ?"], n.special_conditions)
    assert got == [["Extended Hours Trade", "Odd Lot Trade"], None, None, ["Extended Hours Trade", "UNKNOWN(?)"]]


def test_sets(spark):
    assert column(spark, ["b,a,b", "", None], lambda c: n.split_set(c, ",")) == [["a", "b"], [""], None]
    assert column(spark, ["x;y"], lambda c: n.split_set(c, ";")) == [["x", "y"]]
    df = spark.createDataFrame([([("ISIN", "1"), ("CUSIP", "2")],), ([],)], "v array<struct<tag string, value string>>")
    assert [r.o for r in df.select(n.tag_value_set(F.col("v")).alias("o")).collect()] == [["CUSIP=2", "ISIN=1"], None]


def test_blank_strings_only_outside_sets(spark):
    df = spark.createDataFrame([("", [""], 0)], "s string, a array<string>, i int")
    assert tuple(n.blank_to_null(df).first()) == (None, [""], 0)


def test_sentinels(spark):
    assert column(spark, [2147483647, 5, None], n.unset_int, "long") == [None, 5, None]
    assert column(spark, [1.7976931348623157e308, 5.0], n.unset_double, "double") == [None, 5.0]
    assert column(spark, [0.0, -1.0, 5.0, None], n.positive_or_null, "double") == [None, None, 5.0, None]
    assert column(spark, [0.0, 1.5, None], n.tick_price, "double") == [None, 1.5, None]
    assert column(spark, ["?", "C", None], n.option_right) == [None, "C", None]
    assert column(spark, [None, "", "100"], n.multiplier) == [1.0, 1.0, 100.0]


def test_decimals_become_doubles(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(10,2)) AS d, 1 AS i")
    assert [f.dataType.simpleString() for f in n.decimals_to_double(df).schema] == ["double", "int"]


def test_yield_date(spark):
    assert column(spark, [0, 20301231, None], n.yield_date, "int") == [None, "2030-12-31", None]


def test_lenient_double(spark):
    got = column(spark, ["1e3", "", "abc", None, " 1.5 ", "1.0d", "1_000", "-.5", "5.", "inf"], n.lenient_double)
    assert got == [1000.0, None, None, None, 1.5, None, None, -0.5, 5.0, math.inf]


def test_notes(spark):
    note = '{"account": "All", "model_code": ""}'
    assert column(spark, [note, None], lambda c: n.note_value(c, "account")) == ["All", None]
    assert column(spark, [note], lambda c: n.note_value(c, "missing")) == [None]
    assert column(spark, [5], lambda c: n.note_json({"a": c, "b": F.lit("x")}), "int") == ['{"a":"5","b":"x"}']


def test_html_unescape(spark):
    assert column(spark, ["a &amp; b &lt;c&gt; &eacute;", None, "plain"], n.html_unescape) == ["a & b <c> é", None, "plain"]


def test_html_unescape_decodes_all_that_html_5_does(spark):
    names = "".join(f"&{k} &{k}x&{k[:-1]}=" for k in html5)
    codes = [*range(0x500), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 10**12]
    numbers = "".join(f"&#{c};&#{c} &#x{c:x};&#X{c:X}&#000000000000{c};" for c in codes)
    odd = "&amp&copy<p>&notanentity; &notit; &amp;amp; & &; &# &#; &#x &#x; &apos; &#146; &\u00e9\U0001f600; &AMP;&Amp;&" + "a" * 40 + ";&lt&gt\r\n&amp"
    texts = [names, numbers, odd, "", None]
    assert column(spark, texts, n.html_unescape) == [t if t is None else unescape(t) for t in texts]


def test_headline(spark):
    assert column(spark, ["BRF{A:1}b}c", "plain", None], n.clean_headline) == ["b}c", "plain", None]


def test_rounding(spark):
    assert column(spark, [2.5, -2.5, 2.4], n.round_half_up, "double") == [3, -2, 2]


def test_feed_times(spark):
    texts = [
        "20210104 09:30:00",
        "2021-01-04 09:30:00.0",
        "20210704 09:30:00",
        "20210104 09:30:00 US/Eastern",
        "20210104 09:30:00.25",
        "bad",
        None,
        "20211304 09:30:00",
    ]
    at = lambda *a: datetime(*a)
    winter = at(2021, 1, 4, 14, 30)
    got = column(spark, texts, lambda c: tf.parse_feed_time(c).cast("timestamp_ntz"))
    assert got == [winter, winter, at(2021, 7, 4, 13, 30), winter, at(2021, 1, 4, 14, 30, 0, 250000), None, None, None]


def test_unreadable_time_is_an_error(spark):
    assert column(spark, [None], tf.parse_feed_time_strict) == [None]
    with pytest.raises(Exception, match="Unable to parse time"):
        column(spark, ["bad"], tf.parse_feed_time_strict)


def test_format_feed_time_reads_back(spark):
    texts = ["20210104 09:30:00.005 US/Eastern", "20210704 23:59:59.120 US/Eastern"]
    assert column(spark, texts, lambda c: tf.format_feed_time(tf.parse_feed_time(c))) == texts
    assert column(spark, [None], lambda c: tf.format_feed_time(tf.parse_feed_time(c))) == [""]
    got = column(spark, texts, lambda c: tf.format_feed_time(tf.parse_feed_time(c), sub_sec=False))
    assert got == ["20210104 09:30:00 US/Eastern", "20210704 23:59:59 US/Eastern"]


def test_bar_dates(spark):
    got = column(spark, ["20210104", "1609770600"], lambda c: tf.parse_bar_date(c).cast("timestamp_ntz"))
    assert got == [datetime(2021, 1, 5, 4, 59, 59), datetime(2021, 1, 4, 14, 30)]


def test_expiry_and_years(spark):
    got = column(spark, ["20210104", "20210704", None], lambda c: tf.expiry_instant(c).cast("timestamp_ntz"))
    assert got == [datetime(2021, 1, 4, 19), datetime(2021, 7, 4, 18), None]
    years = column(spark, ["20210104"], lambda c: tf.years_365(F.lit(datetime(2020, 1, 5, 19)), tf.expiry_instant(c)))
    assert years == [pytest.approx(1.0)]


def _cdf(d):
    return 0.5 * (1 + math.erf(d / math.sqrt(2)))


def test_normal_cdf_is_close_to_the_exact_one(spark):
    points = [-4.0, -1.0, 0.0, 0.5, 3.0]
    got = column(spark, points, lambda _: pricing.normal_cdf("v"), "double")
    assert got == pytest.approx([_cdf(d) for d in points], abs=1e-7)


def test_option_price_matches_the_closed_form(spark):
    rng = random.Random(7)
    rows = [(rng.uniform(50, 150), rng.uniform(50, 150), rng.uniform(0.05, 2), 0.04, rng.uniform(0.1, 0.6), i % 2 == 0) for i in range(50)]
    df = spark.createDataFrame(rows, "s double, x double, t double, r double, v double, c boolean")
    for row in pricing.with_option_price(df, "price", "s", "x", "t", "r", "v", "c").collect():
        s, x, t, r, v, call = row[:6]
        d1 = (math.log(s / x) + (r + v * v / 2) * t) / (v * math.sqrt(t))
        d2 = d1 - v * math.sqrt(t)
        sign = 1 if call else -1
        exact = sign * (s * _cdf(sign * d1) - x * math.exp(-r * t) * _cdf(sign * d2))
        assert row.price == pytest.approx(exact, abs=5e-5)


def test_option_price_is_null_where_undefined(spark):
    rows = [(100.0, 100.0, None, 0.04, 0.2, True), (100.0, 100.0, 1.0, 0.04, 0.0, True), (100.0, 0.0, 1.0, 0.04, 0.2, True), (100.0, 100.0, -1.0, 0.04, 0.2, True)]
    df = spark.createDataFrame(rows, "s double, x double, t double, r double, v double, c boolean")
    assert [r.price for r in pricing.with_option_price(df, "price", "s", "x", "t", "r", "v", "c").collect()] == [None] * 4


def test_raw_schemas():
    assert len(raw_tables()) == 35
    sizes = {"orders_submitted": 161, "contracts_details": 57, "requests": 20, "ticks_price": 6}
    for table, width in sizes.items():
        assert len(raw_schema(table)) == width + 2, table
    for table in raw_tables():
        names = raw_schema(table).names
        assert names[0] == "ReceiveTime" and names[-1] == "Seq" and len(set(names)) == len(names)
