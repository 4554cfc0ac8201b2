"""Filing facts: S7, S8, N1-N3, N5-N7, F5-F9, W1, W1b, A2, Q1."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import FILINGS, python_top5, write_filings
from ledgerlake import schemas as S
from ledgerlake.operators import nested, quality, staging, topk
from ledgerlake.sources import files as sources


@pytest.fixture(scope="module")
def filings(spark, tmp_path_factory):
    folder = write_filings(str(tmp_path_factory.mktemp("sec")))
    return sources.usable_filings(sources.read_filings(spark, folder))


@pytest.fixture(scope="module")
def km(filings):
    return filings.select(nested.key_metrics_document(F.col("doc"), F.col("ticker")).alias("km"))


def test_empty_documents_skipped(filings):
    assert sorted(r.ticker for r in filings.collect()) == ["AAA", "BBB", "CCC"]


def _as_dicts(facts):
    return [{k: v for k, v in f.asDict().items() if v is not None} for f in facts]


def test_array_top5_equals_source_behaviour(km):
    doc = {r.km.ticker: r.km for r in km.collect()}["AAA"]
    src = FILINGS["AAA.json"]["facts"]["us-gaap"]
    for m in S.FACT_METRICS:
        if m not in src:
            assert m not in doc.metrics                       # missing metric -> no key
            continue
        expected = [{k: v for k, v in f.items() if k in S.FACT_KEYS and v is not None}
                    for f in python_top5(src[m]["units"].get("USD", []))]
        assert _as_dicts(doc.metrics[m]) == expected, m
    assert doc.metrics["Liabilities"] == []                   # only EUR values
    assert doc.metrics["StockholdersEquity"] == []            # only 10-Q values
    assert doc.company_name == "Alpha, Inc."


def test_documents_without_taxonomy(km):
    docs = {r.km.ticker: r.km for r in km.collect()}
    assert docs["BBB"].metrics == {} and docs["CCC"].metrics == {}
    assert docs["CCC"].company_name == "Gamma"


def _long_from_filings(filings):
    """Every USD fact of the allow-listed metrics as a long row with its list position."""
    listed = F.array(*[F.struct(F.lit(m).alias("metric_name"),
                                nested.metric_values(F.col("doc"), m).alias("xs")) for m in S.FACT_METRICS])
    rows = filings.select("ticker", F.lit("x").alias("company_name"), F.inline(listed)).select(
        "ticker", "company_name", "metric_name", F.posexplode("xs").alias("pos", "f"))
    return rows.select("ticker", "company_name", "metric_name",
                       F.col("f.end").alias("period_end"), F.col("f.val").alias("value"),
                       F.col("f.form").alias("form"), "pos")


def test_window_top5_equals_array_top5(filings, km):
    w1 = topk.latest_annual(_long_from_filings(filings), tie_break=["pos"])
    a = sorted((r.ticker, r.metric_name, r.period_end or "", r.value, r.period_rank)
               for r in w1.collect())
    exploded = nested.explode_key_metrics(km)
    b = sorted((r.ticker, r.metric_name, r.period_end, r.value, r.pos + 1)
               for r in exploded.collect())
    assert a == b


def test_distinct_period_option(filings):
    out = topk.latest_annual(_long_from_filings(filings), tie_break=["pos"], distinct_period=True)
    ni = [(r.period_end, r.value) for r in
          out.filter("metric_name = 'NetIncomeLoss'").orderBy("period_rank").collect()]
    assert ni == [("2023-12-31", 130), ("2022-12-31", 120), ("2021-12-31", 110),
                  ("2020-12-31", 100), ("2019-12-31", 90)]


def test_explode_and_pivot(km):
    long = nested.explode_key_metrics(km)
    rows = long.collect()
    assert all(r.currency == "USD" for r in rows)
    assert {r.metric_name for r in rows} == {"NetIncomeLoss", "Revenues", "Assets"}
    piv = staging.stg_sec_facts(long.drop("pos")).collect()
    by_year = {r.fiscal_year: r for r in piv}
    assert by_year[2023].net_income == 131                    # MAX wins on restatement
    assert by_year[2023].total_assets == 5000
    assert by_year[2023].revenue == 1000
    assert 2022 in by_year and by_year[2022].revenue is None  # NULL value filtered


def test_coverage_from_documents(km):
    cov = {(r.ticker, r.metric_name): (r.records_found, r.missing)
           for r in quality.coverage_from_documents(km).collect()}
    assert cov[("AAA", "NetIncomeLoss")] == (5, False)
    assert cov[("AAA", "Liabilities")] == (0, False)
    assert cov[("AAA", "OperatingIncomeLoss")] == (0, True)
    assert cov[("BBB", "Assets")] == (0, True)


def test_coverage_from_filings_equals_that_of_the_cut_documents(filings, km):
    a = sorted(map(tuple, quality.coverage_from_filings(filings).collect()))
    assert a == sorted(map(tuple, quality.coverage_from_documents(km).collect()))


def test_metric_coverage_long(spark):
    rows = [("T", "NetIncomeLoss", "10-K")] * 7 + [("T", "Assets", "10-Q"), ("U", "Revenues", "10-K")]
    df = spark.createDataFrame(rows, "ticker string, metric_name string, form string")
    cov = {(r.ticker, r.metric_name): (r.records_found, r.missing)
           for r in quality.metric_coverage(df).collect()}
    assert cov[("T", "NetIncomeLoss")] == (5, False)
    assert cov[("T", "Assets")] == (0, False)
    assert cov[("T", "Revenues")] == (0, True)
    assert len(cov) == 12


fact = st.fixed_dictionaries({
    "end": st.one_of(st.none(), st.sampled_from(["2019-12-31", "2020-12-31", "2021-06-30",
                                                 "2021-12-31", "2022-12-31"])),
    "val": st.integers(-10**12, 10**12),
    "form": st.sampled_from(["10-K", "10-Q", "8-K"]),
})


@settings(max_examples=8, deadline=None)
@given(st.lists(fact, max_size=14))
def test_array_top5_property(spark, values):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("xs", S.FACT_LIST)])
    rows = [([{"end": v["end"], "val": v["val"], "form": v["form"]} for v in values],)]
    df = spark.createDataFrame(rows, schema)
    got = df.select(nested.latest_annual_in_array(F.col("xs")).alias("t")).collect()[0].t
    clean = [{k: x for k, x in v.items() if x is not None} for v in values]
    assert _as_dicts(got) == python_top5(clean)


long_fact = st.tuples(
    st.sampled_from(["A", "B"]),
    st.sampled_from(["NetIncomeLoss", "Assets", "Goodwill"]),
    st.one_of(st.none(), st.sampled_from(["2020-12-31", "2021-12-31", "2022-12-31"])),
    st.one_of(st.none(), st.integers(-50, 50)),
    st.sampled_from(["10-K", "10-K", "10-Q"]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(long_fact, max_size=40))
def test_window_top5_property(spark, facts):
    rows = [(t, "n", m, e, v, f, pos) for pos, (t, m, e, v, f) in enumerate(facts)]
    df = spark.createDataFrame(rows, "ticker string, company_name string, metric_name string, "
                                     "period_end string, value bigint, form string, pos long")
    got = sorted((r.ticker, r.metric_name, r.pos, r.period_rank)
                 for r in topk.latest_annual(df, tie_break=["pos"]).collect())
    want = []
    for t in ("A", "B"):
        for m in S.FACT_METRICS:
            group = [{"end": e, "pos": p} if e is not None else {"pos": p}
                     for (tt, _, mm, e, _v, f, p) in rows if tt == t and mm == m and f == "10-K"]
            ranked = sorted(group, key=lambda x: x.get("end", ""), reverse=True)[:5]
            want += [(t, m, x["pos"], i + 1) for i, x in enumerate(ranked)]
    assert got == sorted(want)


@settings(max_examples=5, deadline=None)
@given(st.lists(long_fact, min_size=1, max_size=40))
def test_case_pivot_equals_builtin_pivot(spark, facts):
    rows = [(t, "n", m, e, v, f) for (t, m, e, v, f) in facts]
    df = spark.createDataFrame(rows, "ticker string, company_name string, metric_name string, "
                                     "period_end string, value bigint, form string")
    keys = ["ticker", "period_end"]
    case_form = staging.pivot_metrics(df, keys)
    builtin = df.groupBy(*keys).pivot("metric_name", S.FACT_METRICS).max("value")
    builtin = builtin.select(*keys, *[F.col(m).alias(c) for m, c in S.METRIC_COLUMNS.items()])
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, case_form.collect()), key=key) == \
        sorted(map(tuple, builtin.select(*case_form.columns).collect()), key=key)


def test_coverage_without_ansi(spark, km):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        cov = {(r.ticker, r.metric_name): r.records_found
               for r in quality.coverage_from_documents(km).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert cov[("BBB", "Assets")] == 0 and cov[("AAA", "OperatingIncomeLoss")] == 0
    assert min(cov.values()) == 0
