"""Sector summary (A1) and the four dashboard chart queries.

All are one hash aggregate with map-side partials: a sector holding a third of all
companies collapses to one partial row per input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import avg_2dp, pct


def sector_summary(metrics: DataFrame, ordered: bool = True) -> DataFrame:
    """A1 + O1: companies, average price, P/E and EBITDA share per sector."""
    out = metrics.groupBy("sector").agg(
        F.count("ticker").alias("company_count"),
        avg_2dp("stock_price").alias("avg_price"),
        avg_2dp("pe_ratio").alias("avg_pe_ratio"),
        avg_2dp("ebitda_to_market_cap").alias("avg_ebitda_pct"),
    )
    if ordered:
        out = out.orderBy(F.desc("company_count"), F.asc_nulls_last("sector"))
    return out


def avg_market_cap_by_sector(companies: DataFrame) -> DataFrame:
    """A5."""
    return companies.groupBy("sector").agg(avg_2dp("market_cap").alias("avg_market_cap"))


def avg_pe_by_sector(companies: DataFrame) -> DataFrame:
    """A6 (NULL P/E values are not counted)."""
    return companies.groupBy("sector").agg(avg_2dp("pe_ratio").alias("avg_pe_ratio"))


def sector_distribution(companies: DataFrame) -> DataFrame:
    """Companies per sector and their share of all companies.

    The share needs the grand total: a window over the already aggregated rows,
    whose count is the number of sectors, not the number of companies.
    """
    counts = companies.groupBy("sector").agg(F.count(F.lit(1)).alias("company_count"))
    total = F.sum("company_count").over(Window.partitionBy())
    return counts.select("sector", "company_count",
                         pct(F.col("company_count"), total).alias("share_pct"))


def ebitda_vs_market_cap(companies: DataFrame) -> DataFrame:
    """Scatter points."""
    return companies.select("ticker", "sector", "ebitda", "market_cap")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """L1: the first `n` rows of an ordered result (a sample for inspection)."""
    return df.limit(n)
