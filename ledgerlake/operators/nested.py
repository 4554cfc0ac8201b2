"""Nested documents: parsing, path lookup, in-array top-k, explode and rebuild.

Per-document work (N1-N3, W1b) is a projection over each row, so it runs where the
document is, with no shuffle. Documents are parsed from landed text with
`from_json` and an explicit schema; fields a document lacks become NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators import lattice


def parse_documents(landed: DataFrame, schema, body: str = "body", alias: str = "doc",
                    strict: bool = False) -> DataFrame:
    """Text documents -> typed struct column `alias` and its `status`.

    `status` is `ok`, `empty` (no text) or `corrupt` (no complete JSON); other than `ok`
    gives a NULL struct, so half a document never passes for a whole one, and
    `quality.document_rejects` counts them. With `strict` a corrupt document fails the job.
    A single value of the wrong type is no corruption: it is NULL and the rest is kept.
    The parsed value and the status pass an `explode`, which no filter is moved through, so that
    a text is parsed once, however often later steps name the document.
    """
    text = F.col(body)
    parsed = landed.select("*", F.explode(F.array(F.from_json(
        text, S.with_corrupt(schema), {"columnNameOfCorruptRecord": S.CORRUPT}))).alias("_parsed"))
    # Only what the parser complained about is checked as a whole.
    bad = F.col("_parsed")[S.CORRUPT].isNotNull() & F.try_parse_json(text).isNull()
    if strict:
        bad = F.when(bad, F.raise_error(F.concat(F.lit("corrupt document: "), F.left(text, F.lit(80)))).cast("boolean")).otherwise(bad)
    status = (F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty"))
              .when(bad, F.lit("corrupt")).otherwise(F.lit("ok")))
    return (parsed.withColumn("status", F.explode(F.array(status)))
            .withColumn(alias, F.when(F.col("status") == "ok", F.col("_parsed").dropFields(S.CORRUPT)))
            .drop("_parsed"))


def ticker_from_file(file_name: Column, suffix: str) -> Column:
    """`.../AAPL_sec_facts.json` -> `AAPL` (documents that carry no ticker of their own)."""
    pattern = r"([^/]+?)" + re.escape(suffix) + "$"
    return F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit(""))


# ---------------------------------------------------------------------------
# statements
# ---------------------------------------------------------------------------

def explode_statements(docs: DataFrame, fields: list[str], doc: str = "doc",
                       keep: tuple[str, ...] = (), others: bool = False) -> DataFrame:
    """`{symbol, annualReports:[...]}` -> one row per report with the parent ticker.

    A missing or empty report list yields no rows; a missing `symbol` gives a NULL
    ticker (the source would give '', which then slips past NOT NULL filters). `keep`
    names document-level columns (e.g. `kind`) carried onto every report row. With
    `others` the keys beside `fields` are kept in `other_fields`, a JSON object with sorted
    keys: documents may differ in their keys, and a table needs columns known beforehand.
    """
    d = F.col(doc)
    rows = docs.select(*keep, F.nullif(F.trim(d["symbol"]), F.lit("")).alias("ticker"),
                       F.explode(d["annualReports"]).alias("r"))
    r = F.col("r")
    out = [r[f].alias(f) for f in fields]
    if others:
        known = F.array(*[F.lit(f) for f in fields])
        rest = F.filter(F.array_sort(F.map_entries(r)), lambda e: ~F.array_contains(known, e["key"]))
        out.append(F.to_json(F.map_from_entries(rest)).alias("other_fields"))
    return rows.select(*keep, "ticker", *out)


def statements_wide(docs: DataFrame, doc: str = "doc", keep: tuple[str, ...] = (),
                    most_keys: int = lattice.MOST_KEYS) -> DataFrame:
    """P11 + U1 without a list of fields: one row per report of any kind, one typed column per
    key that any document has (`lattice.widened`), NULL where a report lacks it."""
    d = F.col(doc)
    rows = docs.select(*keep, F.nullif(F.trim(d["symbol"]), F.lit("")).alias("ticker"),
                       F.explode(d["annualReports"]).alias("report"))
    return lattice.widened(rows, "report", [*keep, "ticker"], most_keys)


def union_statements(frames: dict[str, DataFrame]) -> DataFrame:
    """Bag union of statement kinds over the union of their columns (+ `kind`)."""
    out = None
    for kind, df in frames.items():
        tagged = df.select(F.lit(kind).alias("kind"), "*")
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def stack_kinds(df: DataFrame, kinds: dict[str, dict[str, Column]], fields: list[str]) -> DataFrame:
    """U1 for kinds that are computed from the same rows: one pass, each row unfolds into
    one row per kind over the union `fields`; a field that a kind lacks is NULL."""
    none = F.lit(None).cast("string")
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), *[columns.get(f, none).alias(f) for f in fields])
        for kind, columns in kinds.items()])))


# ---------------------------------------------------------------------------
# Key metrics from one filing document
# ---------------------------------------------------------------------------

def metric_values(doc: Column, metric: str) -> Column:
    """facts[taxonomy][metric].units[USD], NULL when any level is missing."""
    return doc["facts"][S.TAXONOMY][metric]["units"][S.UNIT]


def has_metric(doc: Column, metric: str) -> Column:
    return F.coalesce(doc["facts"][S.TAXONOMY][metric].isNotNull(), F.lit(False))


def latest_annual_in_array(values: Column, k: int = S.TOP_K_PERIODS) -> Column:
    """N2 + N3: keep annual entries, order by period end descending, first k.

    Each kept entry is keyed `(end or '', -position)` and the keys are sorted
    descending with the built-in struct ordering (no comparator lambda), so equal
    periods keep document order and a missing period sorts last.
    """
    vals = F.coalesce(values, F.array())
    keyed = F.transform(vals, lambda x, i: F.struct(
        F.coalesce(x["end"], F.lit("")).alias("k"), (-i).alias("n"), x.alias("f")))
    annual = F.filter(keyed, lambda e: e["f"]["form"] == F.lit(S.ANNUAL_FORM))
    ordered = F.sort_array(annual, asc=False)
    return F.transform(F.slice(ordered, 1, k), lambda e: e["f"])


def key_metrics_document(doc: Column, ticker: Column, k: int = S.TOP_K_PERIODS) -> Column:
    """D3 document -> D4 `{ticker, company_name, metrics}`.

    The document schema holds the allow-listed metrics only (F7) and their USD list (F9),
    which is cut per metric (N2, N3). A metric absent from the document is absent from
    `metrics`; a metric present with no annual USD values maps to an empty list. Facts keep
    all keys of the filing.
    """
    entries = F.array(*[
        F.struct(F.lit(m).alias("key"),
                 latest_annual_in_array(metric_values(doc, m), k).alias("value"),
                 has_metric(doc, m).alias("present"))
        for m in S.FACT_METRICS])
    present = F.transform(F.filter(entries, lambda e: e["present"]),
                          lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return F.struct(ticker.alias("ticker"),
                    F.coalesce(doc["entityName"], F.lit("")).alias("company_name"),
                    F.map_from_entries(present).alias("metrics"))


# ---------------------------------------------------------------------------
# Key-metric documents -> long facts
# ---------------------------------------------------------------------------

def explode_key_metrics(docs: DataFrame, doc: str = "km", keep: tuple[str, ...] = (),
                        more: tuple[str, ...] = ()) -> DataFrame:
    """D4 -> D5 rows: explode the metric map, then each metric's list.

    `pos` is the position in the list, kept so later ordering can honour it; `keep`
    names document-level columns carried onto every row, `more` further keys of the facts.
    The outer forms keep the optimizer from asking each document first whether its map is empty,
    which would make the map twice.
    """
    d = F.col(doc)
    per_metric = docs.select(
        *keep,
        F.nullif(F.trim(d["ticker"]), F.lit("")).alias("ticker"),
        F.coalesce(d["company_name"], F.lit("")).alias("company_name"),
        F.explode_outer(d["metrics"]).alias("metric_name", "vals")).where("metric_name is not null")
    rows = per_metric.select(*keep, "ticker", "company_name", "metric_name",
                             F.posexplode_outer("vals").alias("pos", "v")).where("pos is not null")
    return rows.select(
        *keep, "ticker", "company_name", "metric_name",
        F.coalesce(F.col("v.end"), F.lit("")).alias("period_end"),
        F.col("v.val").alias("value"),
        F.coalesce(F.col("v.form"), F.lit("")).alias("form"),
        F.lit(S.DEFAULT_CURRENCY).alias("currency"),
        "pos", *[F.col("v")[m].alias(m) for m in more],
    )


# ---------------------------------------------------------------------------
# Rebuild key-metric documents from selected long facts
# ---------------------------------------------------------------------------

def key_metric_documents(selected: DataFrame, rank_col: str = "period_rank") -> DataFrame:
    """Long facts already cut to k per (ticker, metric) -> one D4 struct per ticker.

    Input groups are bounded by the top-k cut (k per metric, six metrics), so the
    collected lists are bounded too. Fact keys that the rows have are kept.
    """
    columns = {"end": "period_end", "val": "value"}
    fact = F.struct(*[F.col(columns.get(k, k)).alias(k) for k in S.FACT_KEYS
                      if columns.get(k, k) in selected.columns])
    per_metric = selected.groupBy("ticker", "company_name", "metric_name").agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"), fact.alias("f"))))
         .alias("xs"))
    per_ticker = per_metric.groupBy("ticker", "company_name").agg(
        F.map_from_entries(F.collect_list(F.struct("metric_name", F.col("xs.f"))))
         .alias("metrics"))
    return per_ticker.select(
        F.struct("ticker", "company_name", "metrics").alias("km"))
