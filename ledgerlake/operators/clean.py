"""Company snapshot cleaning: renames (P1/P2), typing (P3), required-column and
market-cap filters (F1/F2). One `select` per step so analysis stays cheap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import finite_sql, normalise_header


def _typed_select(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename raw text columns via `mapping` and type the numeric ones in one projection.

    Missing source columns become typed NULLs (schema union over differing files).
    """
    present = set(df.columns)
    text, out = [], []
    for src, dst in mapping.items():
        c = f"CAST(`{src}` AS STRING)" if src in present else "CAST(NULL AS STRING)"
        number = dst in S.COMPANY_NUMERIC
        text.append(f"try_cast(trim({c}) AS DOUBLE) AS `{dst}`" if number else f"{c} AS `{dst}`")
        out.append(f"{finite_sql(dst)} AS `{dst}`" if number
                   else f"nullif(trim(`{dst}`), '') AS `{dst}`" if dst == "ticker" else f"`{dst}`")
    # Two projections: each number is parsed once, then tested.
    return df.selectExpr(*text).selectExpr(*out)


def typed_company(raw: DataFrame) -> DataFrame:
    """Raw CSV-header frame -> canonical names and types (P1 + P3), no rows removed."""
    return _typed_select(raw, S.COMPANY_HEADER_TO_CANONICAL)


def raw_financials(raw: DataFrame) -> DataFrame:
    """The loaded raw table: normalised headers (P2), numbers typed, nothing dropped."""
    typed = _typed_select(raw, S.COMPANY_HEADER_TO_CANONICAL)
    return typed.toDF(*[normalise_header(h) for h in S.COMPANY_HEADER_TO_CANONICAL])


def drop_incomplete(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """drop rows with NULL (or NaN) in any required column."""
    return df.dropna(how="any", subset=required or S.COMPANY_REQUIRED)


def positive_market_cap(df: DataFrame, col: str = "market_cap") -> DataFrame:
    """keep `market_cap > 0`."""
    return df.filter(F.col(col) > 0)


def company_clean(raw: DataFrame, required: list[str] | None = None) -> DataFrame:
    """P1, P3, F1, F2 over the raw company frame."""
    return positive_market_cap(drop_incomplete(typed_company(raw), required))
