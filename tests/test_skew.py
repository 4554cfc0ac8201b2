"""Hot keys: one ticker holds two thirds of all facts. Results are compared with a
brute-force pandas computation, and the plans must cut the hot group before the shuffle."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators import quality, staging, topk

N = 120_000


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(N).repartition(8)
    metric = F.element_at(F.array(*[F.lit(m) for m in S.FACT_METRICS + ["Other"]]),
                          (F.col("id") % 7 + 1).cast("int"))
    return ids.select(
        F.when(F.col("id") % 3 != 0, F.lit("HOT"))
         .otherwise(F.concat(F.lit("T"), (F.col("id") % 11).cast("string"))).alias("ticker"),
        F.lit("Co").alias("company_name"),
        metric.alias("metric_name"),
        F.date_format(F.date_add(F.lit("2000-01-01"), (F.col("id") * 7919 % 3000).cast("int")),
                      "yyyy-MM-dd").alias("period_end"),
        F.when(F.col("id") % 13 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("id") * 31 % 1000).alias("value"),
        F.when(F.col("id") % 4 == 0, F.lit("10-Q")).otherwise(F.lit("10-K")).alias("form"),
        F.floor(F.col("id") / 5).cast("bigint").alias("doc_id"),
        (F.col("id") % 5).alias("line_no"),
    ).cache()


def _pdf(df):
    return df.toPandas()


def test_top5_hot_key_matches_brute_force(spark, skewed):
    got = topk.latest_annual(skewed, tie_break=["doc_id", "line_no", "value"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    g = _pdf(got.select("ticker", "metric_name", "doc_id", "line_no", "period_rank"))
    p = _pdf(skewed)
    p = p[(p.form == "10-K") & p.metric_name.isin(S.FACT_METRICS)].copy()
    p["k"] = p.period_end.fillna("")
    p["v"] = p.value.fillna(-1)
    p = p.sort_values(["ticker", "metric_name", "k", "doc_id", "line_no", "v"],
                      ascending=[True, True, False, True, True, True], kind="mergesort")
    p["period_rank"] = p.groupby(["ticker", "metric_name"]).cumcount() + 1
    p = p[p.period_rank <= 5]
    key = ["ticker", "metric_name", "period_rank"]
    a = g.sort_values(key).reset_index(drop=True)[key + ["doc_id", "line_no"]]
    b = p.sort_values(key).reset_index(drop=True)[key + ["doc_id", "line_no"]]
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_distinct_period_hot_key(spark, skewed):
    got = _pdf(topk.latest_annual(skewed, tie_break=["doc_id", "line_no", "value"],
                                  distinct_period=True))
    assert got.groupby(["ticker", "metric_name", "period_end"]).size().max() == 1
    hot = got[(got.ticker == "HOT") & (got.metric_name == "Assets")].sort_values("period_rank")
    p = _pdf(skewed)
    p = p[(p.ticker == "HOT") & (p.metric_name == "Assets") & (p.form == "10-K")]
    top = sorted(p.period_end.unique(), reverse=True)[:5]
    assert list(hot.period_end) == top


def test_pivot_and_coverage_hot_key(spark, skewed):
    piv = _pdf(staging.stg_sec_facts(skewed))
    p = _pdf(skewed)
    p = p[p.value.notna()].copy()
    p["fiscal_year"] = p.period_end.str[:4].astype(int)
    exp = (p[p.metric_name == "NetIncomeLoss"].groupby(["ticker", "fiscal_year"]).value.max())
    got = piv.set_index(["ticker", "fiscal_year"]).net_income.dropna()
    assert got.astype(int).sort_index().equals(exp.astype(int).sort_index())
    cov = _pdf(quality.metric_coverage(skewed))
    hot = cov[cov.ticker == "HOT"].set_index("metric_name")
    assert (hot.records_found == 5).all() and not hot.missing.any()
