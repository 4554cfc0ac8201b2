"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query shapes the test tables through `proxies` and then runs the same library
operators a user runs on the real sources. Nothing is kept between calls: each call lists
its tables anew. Keys follow SURVEY section 7.4; the
operator IDs each one covers are in its docstring.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas as S
from ledgerlake.operators import clean, large_documents, lattice, mart, metrics, nested, quality, reports, staging, topk
from ledgerlake.plans import proxies as P
from ledgerlake.sinks import files as sinks
from ledgerlake.sources import files as sources

Query = Callable[[SparkSession, str], DataFrame]

FACT_OUT = ["ticker", "company_name", "metric_name", "period_end", "value", "form"]
TIE_BREAK = ["doc_id", "line_no", "value"]


# -- company side -----------------------------------------------------------

def company_clean(spark, d):
    """P1, P3, F1, F2 (M2 malformed price, M4/M5 NaN cap, M18)."""
    return clean.company_clean(P.raw_companies(spark, d))


def company_metrics(spark, d):
    """X1-X5 (M1 zero divisors, M3 rounding)."""
    return metrics.company_metrics(company_clean(spark, d))


def company_metrics_normalised(spark, d):
    """G2 transform: P2, F1 (three columns), F2, X1, X2."""
    return metrics.company_metrics_normalised(P.raw_companies(spark, d))


def sector_summary(spark, d):
    """A1, O1."""
    return reports.sector_summary(company_metrics(spark, d))


def raw_financials(spark, d):
    return clean.raw_financials(P.raw_companies(spark, d))


def stg_financials(spark, d):
    """P2, P4, F3, X11 (M4)."""
    return staging.stg_financials(raw_financials(spark, d))


def chart_avg_market_cap(spark, d):
    """A5."""
    return reports.avg_market_cap_by_sector(stg_financials(spark, d))


def chart_avg_pe(spark, d):
    """A6."""
    return reports.avg_pe_by_sector(stg_financials(spark, d))


def chart_distribution(spark, d):
    """A7."""
    return reports.sector_distribution(stg_financials(spark, d))


def chart_scatter(spark, d):
    """A8."""
    return reports.ebitda_vs_market_cap(stg_financials(spark, d))


def clean_counts(spark, d):
    """Q3."""
    return quality.clean_counts(clean.typed_company(P.raw_companies(spark, d)))


def parse_rejects(spark, d):
    """Q3 / M2: malformed numbers per column, counted on the raw text."""
    return quality.parse_rejects(P.raw_companies(spark, d))


def source_company_lines(spark, d):
    """S1 on landed text: company rows as CSV lines, parsed with the reader's schema and
    quoting, then cleaned."""
    raw = P.raw_companies(spark, d)
    lines = raw.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns]),
                                {"quote": '"', "escape": '"'}).alias("value"))
    return clean.company_clean(sources.company_lines(lines))


def source_view(spark, d):
    """A relation registered as a view and read by its name."""
    sinks.register_views({"company_source": raw_financials(spark, d)})
    return staging.stg_financials(sources.read_table(spark, "company_source"))


# -- statements -------------------------------------------------------------

def stg_income_statements(spark, d):
    """P5, P6, F4, X12-X14."""
    return staging.stg_income_statements(P.raw_income_statements(spark, d))


def statements_explode(spark, d):
    """S4 parse, N4, P7: JSON statement documents -> report rows."""
    docs = nested.parse_documents(P.income_documents(spark, d), S.STATEMENT_DOC)
    return nested.explode_statements(docs, S.INCOME_REPORT_FIELDS)


def statements_all_keys(spark, d):
    """Report rows with every key of the documents, named or not."""
    docs = nested.parse_documents(P.income_documents(spark, d), S.STATEMENT_DOC)
    return nested.explode_statements(docs, S.INCOME_REPORT_FIELDS, others=True)


def statements_union(spark, d):
    """The three statement kinds over the union of their fields, in one pass."""
    return P.statement_rows(spark, d)


def statements_union_docs(spark, d):
    """S5 + U1 from documents: the three statement kinds as JSON files, parsed in one
    pass, `kind` from the file name, then exploded over the union of their fields."""
    kinds = "|".join(S.STATEMENT_KINDS)
    parsed = nested.parse_documents(P.statement_documents(spark, d), S.STATEMENT_DOC).select(
        F.regexp_extract("file_name", rf"_({kinds})\.json$", 1).alias("kind"), "doc")
    return nested.explode_statements(parsed, S.ALL_REPORT_FIELDS, keep=("kind",))


# -- filing facts -----------------------------------------------------------

def _facts(spark, d):
    return P.raw_sec_facts(spark, d)


def facts_annual(spark, d):
    """F5, F6, F7."""
    return topk.annual_facts(P.raw_sec_facts(spark, d, with_order=False))


def _top5(spark, d, distinct_period=False):
    return topk.latest_annual(_facts(spark, d), tie_break=TIE_BREAK,
                              distinct_period=distinct_period)


def facts_top5(spark, d):
    """W1 (M7 records, M8 ties, M9)."""
    return _top5(spark, d).select(*FACT_OUT, "period_rank")


def facts_top5_distinct_period(spark, d):
    """W1 with the M7 distinct-period option."""
    return _top5(spark, d, distinct_period=True).select(*FACT_OUT, "period_rank")


def _key_metrics(spark, d):
    docs = nested.parse_documents(P.filing_documents(spark, d), S.FILING_DOC)
    return docs.select("doc_id", nested.key_metrics_document(F.col("doc"), F.col("ticker")).alias("km"))


def _merged_top5(rows):
    return topk.top_k(rows, ["ticker", "metric_name"], topk.period_order(["doc_id", "pos"]),
                      S.TOP_K_PERIODS, "period_rank")


def facts_top5_array(spark, d):
    """S7 parse, N1-N3, F6, F7, F9, W1b, N5: per-document top 5 inside the arrays,
    then the exact merge of the per-document winners with W1."""
    rows = nested.explode_key_metrics(_key_metrics(spark, d), keep=("doc_id",))
    return _merged_top5(rows).select(*FACT_OUT, "period_rank")


def facts_top5_pieces(spark, d):
    """S7, F6, F7, F9, W1b for documents of any length: the filing documents cut into pieces
    that are parsed in parallel, then the same top 5."""
    facts = large_documents.facts(large_documents.pieces_of(P.filing_documents(spark, d), "file_name"))
    doc_id = F.regexp_extract("doc", r"/(\d+)\.json$", 1).cast("bigint").alias("doc_id")
    rows = large_documents.key_metric_rows(facts, F.split_part("doc", F.lit("/"), F.lit(1)), keep=(doc_id,))
    return _merged_top5(rows).select(*FACT_OUT, "period_rank")


def facts_explode_full(spark, d):
    """K9 shape and S6 parse with all keys of the facts: key-metric documents as JSON text
    and back, then W1 over their rows."""
    landed = _key_metrics(spark, d).select("doc_id", F.to_json("km").alias("body"))
    parsed = nested.parse_documents(landed, S.KEY_METRICS_DOC, alias="km")
    more = ("fy", "fp", "filed", "accn")
    rows = nested.explode_key_metrics(parsed, keep=("doc_id",), more=more)
    return _merged_top5(rows).select(*FACT_OUT, *more, "period_rank")


def metric_coverage_documents(spark, d):
    """Q1 per filing document (S7 parse, then counts in the arrays): records kept and
    missing metrics for each (ticker, document)."""
    docs = nested.parse_documents(P.filing_documents(spark, d), S.FILING_DOC)
    return quality.coverage_from_filings(docs, keep=("doc_id",))


def document_rejects(spark, d):
    """Filing documents by status; some came in damaged."""
    docs = P.damaged_filing_documents(spark, d)
    return quality.document_rejects(nested.parse_documents(docs, S.FILING_DOC))


def facts_explode(spark, d):
    """N6 rebuild, K9 document shape, N5, N7, P8: top-5 facts -> key-metric JSON
    documents -> long rows again."""
    docs = nested.key_metric_documents(_top5(spark, d))
    landed = docs.select(F.to_json("km").alias("body"))
    parsed = nested.parse_documents(landed, S.KEY_METRICS_DOC, alias="km")
    return nested.explode_key_metrics(parsed).select(*FACT_OUT, "currency")


def stg_sec_facts(spark, d):
    """F5, X13, A2."""
    return staging.stg_sec_facts(P.raw_sec_facts(spark, d, with_order=False))


def metric_coverage(spark, d):
    """Q1."""
    return quality.metric_coverage(P.raw_sec_facts(spark, d, with_order=False))


# -- mart -------------------------------------------------------------------

def mart_combined(spark, d):
    """J1, P9."""
    return mart.combine(stg_income_statements(spark, d), stg_sec_facts(spark, d))


def mart_ratios(spark, d):
    """X6-X10, X15, X16, F8."""
    return mart.ratios(mart_combined(spark, d))


def mart_financials(spark, d):
    """J2, P10, O2."""
    return mart.mart(stg_income_statements(spark, d), stg_sec_facts(spark, d),
                     stg_financials(spark, d))


def mart_preview(spark, d):
    """L1 over O2: the first 20 rows of the ordered mart."""
    return reports.preview(mart_financials(spark, d), 20)


def stg_sec_facts_ordered(spark, d):
    """A2 with the O3 ordering option."""
    return staging.stg_sec_facts(P.raw_sec_facts(spark, d, with_order=False), ordered=True)


def mart_after_top5(spark, d):
    """G3 + G5: the mart over facts cut to the latest five annual records."""
    kept = _top5(spark, d).select(*FACT_OUT)
    return mart.mart(stg_income_statements(spark, d), staging.stg_sec_facts(kept),
                     stg_financials(spark, d))


def statements_wide(spark, d):
    """Reports of all kinds over the keys that their documents have, typed."""
    parsed = nested.parse_documents(P.statement_documents(spark, d), S.STATEMENT_DOC).select(
        F.regexp_extract("file_name", r"_(income_statement|balance_sheet|cash_flow)\.json$", 1).alias("kind"), "doc")
    return nested.statements_wide(parsed, keep=("kind",))


# -- checks and inventory ---------------------------------------------------

def key_uniqueness(spark, d):
    """Q2 over the staging keys and the long-fact period key."""
    return quality.key_uniqueness({
        "stg_financials": (stg_financials(spark, d), ["ticker"]),
        "stg_income_statements": (stg_income_statements(spark, d), ["ticker", "fiscal_year"]),
        "stg_sec_facts": (stg_sec_facts(spark, d), ["ticker", "fiscal_year"]),
        "raw_sec_facts": (P.raw_sec_facts(spark, d, with_order=False),
                          ["ticker", "metric_name", "period_end"]),
    })


def source_profile(spark, d):
    """Kinds, types and ends of the text columns of two sources, one pass each."""
    out = None
    for name, raw in (("companies", P.raw_companies(spark, d)), ("income_statements", P.raw_income_statements(spark, d))):
        part = lattice.source_profile(raw).select(F.lit(name).alias("source"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def table_counts(spark, d):
    """A3."""
    return quality.table_counts(spark, {
        "raw_financials": raw_financials(spark, d),
        "raw_income_statements": P.raw_income_statements(spark, d),
        "raw_sec_facts": P.raw_sec_facts(spark, d, with_order=False),
    })


PROPS = T.StructType([T.StructField("k", T.LongType(), True)])


def json_props(spark, d):
    """N1 on JSON text: `props.k` per event, missing -> NULL, summed per event type."""
    ev = P.table(spark, d, "events").select(
        "event_type", F.from_json("props", PROPS)["k"].alias("k"))
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("k").alias("n_with_k"),
        F.sum("k").alias("sum_k"),
    )


QUERIES: dict[str, Query] = {
    "company_clean": company_clean,
    "company_metrics": company_metrics,
    "company_metrics_normalised": company_metrics_normalised,
    "sector_summary": sector_summary,
    "source_company_lines": source_company_lines,
    "source_view": source_view,
    "stg_financials": stg_financials,
    "stg_income_statements": stg_income_statements,
    "statements_explode": statements_explode,
    "statements_all_keys": statements_all_keys,
    "statements_union": statements_union,
    "statements_wide": statements_wide,
    "statements_union_docs": statements_union_docs,
    "facts_annual": facts_annual,
    "facts_top5": facts_top5,
    "facts_top5_distinct_period": facts_top5_distinct_period,
    "facts_top5_array": facts_top5_array,
    "facts_top5_pieces": facts_top5_pieces,
    "facts_explode": facts_explode,
    "facts_explode_full": facts_explode_full,
    "document_rejects": document_rejects,
    "stg_sec_facts": stg_sec_facts,
    "stg_sec_facts_ordered": stg_sec_facts_ordered,
    "mart_combined": mart_combined,
    "mart_ratios": mart_ratios,
    "mart_financials": mart_financials,
    "mart_after_top5": mart_after_top5,
    "mart_preview": mart_preview,
    "chart_avg_market_cap": chart_avg_market_cap,
    "chart_avg_pe": chart_avg_pe,
    "chart_distribution": chart_distribution,
    "chart_scatter": chart_scatter,
    "metric_coverage": metric_coverage,
    "metric_coverage_documents": metric_coverage_documents,
    "key_uniqueness": key_uniqueness,
    "clean_counts": clean_counts,
    "parse_rejects": parse_rejects,
    "table_counts": table_counts,
    "source_profile": source_profile,
    "json_props": json_props,
}
