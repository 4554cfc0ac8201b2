"""Per-company derived metrics (X1-X5). Pure projections: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import cents, normalise_header, pct, size_class, sum_2dp
from ledgerlake.operators import clean

METRIC_NAMES = [
    "ebitda_to_market_cap", "price_range_pct", "price_position_in_range",
    "company_size", "value_score",
]


def metric_columns(only: list[str] | None = None) -> dict:
    low, high, price = cents("week_52_low"), cents("week_52_high"), cents("stock_price")
    exprs = {
        # EBITDA as a share of market cap
        "ebitda_to_market_cap": pct(cents("ebitda"), cents("market_cap")),
        # Width of the 52-week range relative to the low; NULL when low = 0
        "price_range_pct": pct(high - low, low),
        # Where the price sits in the range; NULL when high = low
        "price_position_in_range": pct(price - low, high - low),
        # Size class
        "company_size": size_class("market_cap"),
        # P/E + P/B
        "value_score": sum_2dp("pe_ratio", "pb_ratio"),
    }
    keep = only or METRIC_NAMES
    return {k: v for k, v in exprs.items() if k in keep}


def company_metrics(df: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Append the metric columns to a cleaned company frame in one projection."""
    return df.select("*", *[e.alias(n) for n, e in metric_columns(only).items()])


def company_metrics_normalised(raw: DataFrame) -> DataFrame:
    """G2 transform: normalised header names (P2), three required columns (F1),
    positive market cap (F2) and the two ratios X1, X2."""
    typed = clean.typed_company(raw)
    kept = clean.positive_market_cap(clean.drop_incomplete(typed, ["ticker", "market_cap", "ebitda"]))
    out = company_metrics(kept, only=["ebitda_to_market_cap", "price_range_pct"])
    back = {c: normalise_header(h) for h, c in S.COMPANY_HEADER_TO_CANONICAL.items()}
    return out.select(*[F.col(c).alias(back.get(c, c)) for c in out.columns])
