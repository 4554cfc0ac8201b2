"""Explicit schemas and canonical names for every relation the engine reads or writes.

Nothing is ever inferred in a production read: each source is declared here once and
passed to the reader, so a drifting file cannot silently change a column type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for right results.
# ---------------------------------------------------------------------------

# Company snapshot CSV header, in file order, and the canonical column each maps to.
COMPANY_HEADER_TO_CANONICAL = {
    "Symbol": "ticker",
    "Name": "company_name",
    "Sector": "sector",
    "Price": "stock_price",
    "Price/Earnings": "pe_ratio",
    "Dividend Yield": "dividend_yield",
    "Earnings/Share": "eps",
    "52 Week Low": "week_52_low",
    "52 Week High": "week_52_high",
    "Market Cap": "market_cap",
    "EBITDA": "ebitda",
    "Price/Sales": "ps_ratio",
    "Price/Book": "pb_ratio",
    "SEC Filings": "sec_filings_url",
}

# Normalised header (lower-case, "/" -> "_per_", " " -> "_") to canonical name.
NORMALISED_TO_CANONICAL = {
    "symbol": "ticker",
    "name": "company_name",
    "sector": "sector",
    "price": "stock_price",
    "price_per_earnings": "pe_ratio",
    "dividend_yield": "dividend_yield",
    "earnings_per_share": "eps",
    "52_week_low": "week_52_low",
    "52_week_high": "week_52_high",
    "market_cap": "market_cap",
    "ebitda": "ebitda",
    "price_per_sales": "ps_ratio",
    "price_per_book": "pb_ratio",
    "sec_filings": "sec_filings_url",
}

# The ten numeric company columns (canonical names).
COMPANY_NUMERIC = [
    "stock_price", "pe_ratio", "dividend_yield", "eps", "week_52_low",
    "week_52_high", "market_cap", "ebitda", "ps_ratio", "pb_ratio",
]

# Columns whose NULL/NaN drops a company row before ratios are computed.
COMPANY_REQUIRED = ["ticker", "market_cap", "ebitda", "stock_price"]

# Filing-fact metrics kept from the us-gaap taxonomy, and their wide column names.
FACT_METRICS = [
    "NetIncomeLoss",
    "Revenues",
    "Assets",
    "Liabilities",
    "StockholdersEquity",
    "OperatingIncomeLoss",
]
METRIC_COLUMNS = {
    "NetIncomeLoss": "net_income",
    "Revenues": "revenue",
    "Assets": "total_assets",
    "Liabilities": "total_liabilities",
    "StockholdersEquity": "stockholders_equity",
    "OperatingIncomeLoss": "operating_income",
}
TAXONOMY = "us-gaap"
UNIT = "USD"
ANNUAL_FORM = "10-K"
TOP_K_PERIODS = 5

# Company size classes: (lower bound in dollars, label), checked from the top.
SIZE_CLASSES = [
    (200_000_000_000, "Mega Cap"),
    (10_000_000_000, "Large Cap"),
    (2_000_000_000, "Mid Cap"),
]
SIZE_FLOOR = "Small Cap"

# Statement kinds and the file-name suffix each is landed under.
STATEMENT_KINDS = {
    "income_statement": "_income_statement.json",
    "balance_sheet": "_balance_sheet.json",
    "cash_flow": "_cash_flow.json",
}
FACTS_DOC_SUFFIX = "_sec_facts.json"
NONE_SENTINEL = "None"
DEFAULT_CURRENCY = "USD"

# ---------------------------------------------------------------------------
# D1 company snapshot
# ---------------------------------------------------------------------------

# Raw zone: every column as text, exactly as the file carries it.
RAW_COMPANY = T.StructType(
    [T.StructField(h, T.StringType(), True) for h in COMPANY_HEADER_TO_CANONICAL]
)

# ---------------------------------------------------------------------------
# D2 statement documents (all amounts are text in the source)
# ---------------------------------------------------------------------------

INCOME_REPORT_FIELDS = [
    "fiscalDateEnding", "reportedCurrency", "totalRevenue", "netIncome",
    "operatingIncome", "stockholdersEquity", "grossProfit", "ebitda",
    "researchAndDevelopment",
]
BALANCE_REPORT_FIELDS = [
    "fiscalDateEnding", "reportedCurrency", "totalAssets", "totalLiabilities",
    "totalShareholderEquity",
]
CASH_FLOW_REPORT_FIELDS = [
    "fiscalDateEnding", "reportedCurrency", "operatingCashflow", "capitalExpenditures",
]

REPORT_FIELDS = {
    "income_statement": INCOME_REPORT_FIELDS,
    "balance_sheet": BALANCE_REPORT_FIELDS,
    "cash_flow": CASH_FLOW_REPORT_FIELDS,
}


# `{symbol, annualReports: [ {key: text} ]}` of every statement kind. Reports are maps, so
# that no key of the source is lost; the fields above are those that later steps name.
STATEMENT_DOC = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("annualReports", T.ArrayType(T.MapType(T.StringType(), T.StringType())), True),
    ]
)

# Every statement field of every kind, for one scan over all statement documents.
ALL_REPORT_FIELDS = list(dict.fromkeys(f for fields in REPORT_FIELDS.values() for f in fields))

# ---------------------------------------------------------------------------
# D3 / D4 filing facts
# ---------------------------------------------------------------------------

# All keys of a filing fact, as the public filing documents name them (fixed values); the
# first three are those that later steps use.
FACT_KEYS = {"end": T.StringType(), "val": T.LongType(), "form": T.StringType(), "fy": T.IntegerType(),
             "fp": T.StringType(), "start": T.StringType(), "filed": T.StringType(),
             "accn": T.StringType(), "frame": T.StringType()}
FACT = T.StructType([T.StructField(k, kind, True) for k, kind in FACT_KEYS.items()])
FACT_LIST = T.ArrayType(FACT, True)


def _one(name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True)])


# facts -> taxonomy -> metric -> units -> unit -> [fact], of the allow-listed metrics and the
# one unit only: the parser skips the rest of a filing, which is most of it. A metric that
# the filing lacks is NULL, one without that unit is a struct with a NULL list.
FILING_DOC = T.StructType(
    [
        T.StructField("entityName", T.StringType(), True),
        T.StructField("facts", _one(TAXONOMY, T.StructType(
            [T.StructField(m, _one("units", _one(UNIT, FACT_LIST)), True) for m in FACT_METRICS])), True),
    ]
)

# Holds the text of a document that is no (complete) JSON.
CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


KEY_METRICS_DOC = T.StructType(
    [
        T.StructField("ticker", T.StringType(), True),
        T.StructField("company_name", T.StringType(), True),
        T.StructField("metrics", T.MapType(T.StringType(), FACT_LIST), True),
    ]
)
