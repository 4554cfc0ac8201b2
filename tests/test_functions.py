"""Expression helpers: rounding, parsing, classification (X*, M1-M4)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import (
    avg_2dp, cents, complete_flag, normalise_header, parse_double, pct, safe_bigint, size_class,
    year_of,
)


def py_pct(a, b):
    if a is None or b is None or b == 0:
        return None
    q = (Decimal(a) / Decimal(b) * 100)
    return float(q.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


pairs = st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-10**6, 10**6)),
                 min_size=50, max_size=300)


@settings(max_examples=5, deadline=None)
@given(pairs)
def test_pct_matches_decimal_half_up(spark, rows):
    rows = rows + [(1, 8), (-1, 8), (5, 4000), (-5, 4000), (1, 0), (0, 7), (1005, 100000)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = df.select("a", "b", pct("a", "b").alias("p")).collect()
    for r in got:
        assert r.p == py_pct(r.a, r.b), (r.a, r.b, r.p)


def test_half_cent_cases(spark):
    df = spark.createDataFrame([(1, 8), (1005, 100000), (-1, 8), (2, 3)], "a long, b long")
    got = [r.p for r in df.select(pct("a", "b").alias("p")).collect()]
    assert got == [12.5, 1.01, -12.5, 66.67]


def test_parse_and_sentinels(spark):
    df = spark.createDataFrame(
        [("12.5", "None", "2021-12-31"), ("abc", "123", "20x1-01-01"), ("NaN", " 9000000000 ", None),
         (None, "", "1999")], "x string, y string, d string")
    got = df.select(parse_double("x").alias("x"), safe_bigint("y").alias("y"),
                    year_of("d").alias("d")).collect()
    assert [tuple(r) for r in got] == [(12.5, None, 2021), (None, 123, None),
                                       (None, 9000000000, None), (None, None, 1999)]


def test_cents_and_avg(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", 0.125)], "k string, v double")
    got = {r.k: (r.c, r.avg) for r in df.groupBy("k").agg(
        F.sum(cents("v")).alias("c"), avg_2dp("v").alias("avg")).collect()}
    assert got["a"] == (30, 0.15)
    assert got["b"] == (13, 0.13)


def test_size_class_boundaries(spark):
    caps = [200e9, 199.99e9, 10e9, 2e9, 1.99e9, 0.0]
    df = spark.createDataFrame([(c,) for c in caps], "m double")
    got = [r.s for r in df.select(size_class("m").alias("s")).collect()]
    assert got == ["Mega Cap", "Large Cap", "Large Cap", "Mid Cap", "Small Cap", "Small Cap"]


def test_complete_flag_null_is_false(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0), (1.0, None, 1.0), (None, 1.0, 1.0), (1.0, 1.0, None), (1.0, 1.0, -1.0)],
        "m double, e double, p double")
    got = [r.f for r in df.select(complete_flag("m", "e", "p").alias("f")).collect()]
    assert got == [True, False, False, False, False]


@given(st.text(alphabet="AbC /xy_9", max_size=20))
def test_normalise_header_idempotent(name):
    once = normalise_header(name)
    assert normalise_header(once) == once
    assert " " not in once and "/" not in once


def test_normalise_header_examples():
    assert normalise_header("Price/Earnings") == "price_per_earnings"
    assert normalise_header("52 Week Low") == "52_week_low"
    assert normalise_header("SEC Filings") == "sec_filings"


def test_size_shuffles_for_100tb(spark):
    from ledgerlake.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        n = size_shuffles(spark, 100 * 1024 ** 4)
        assert n == 100 * 1024 ** 4 // (128 * 1024 ** 2)
        assert int(spark.conf.get(key)) == n
    finally:
        spark.conf.unset(key)
        if before:
            spark.conf.set(key, before)


def test_huge_and_infinite_amounts_never_fail(spark):
    rows = [("a", "Infinity"), ("a", "-Infinity"), ("a", "1e400"), ("a", "NaN"), ("a", "x"), ("a", "1e17"),
            ("b", "9e16"), ("b", "9e16"), ("c", "1e26"), ("c", "-0.125")]
    df = spark.createDataFrame(rows, "k string, t string").select("k", parse_double("t").alias("v"))
    assert df.filter("v is null").count() == 5
    got = {r.k: r.m for r in df.groupBy("k").agg(avg_2dp("v").alias("m")).collect()}
    assert got == {"a": 1e17, "b": 9e16, "c": -0.13}
    assert df.select(pct(cents("v"), F.lit(10000)).alias("p")).filter("p = 1e17").count() == 1


def test_input_bytes(spark, tmp_path):
    from ledgerlake.session import input_bytes

    (tmp_path / "a.txt").write_text("12345")
    assert input_bytes(spark, str(tmp_path / "a.txt"), str(tmp_path / "none")) == 5
