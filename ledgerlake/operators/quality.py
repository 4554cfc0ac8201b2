"""Data-quality reports as DataFrames (Q1-Q3, A3, A4).

Each is an aggregate with map-side partials; none collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas as S
from ledgerlake.operators import nested


def metric_coverage(facts: DataFrame, k: int = S.TOP_K_PERIODS) -> DataFrame:
    """Q1: per (ticker, allow-listed metric) the annual records kept (at most k) and
    whether the metric is missing from the ticker's facts altogether.

    One grouped aggregate per ticker with a conditional count per metric, then the six
    counts are unpacked into rows: no ticker x metric cross join is needed.
    """
    aggs = []
    for i, m in enumerate(S.FACT_METRICS):
        is_m = F.col("metric_name") == m
        aggs.append(F.count_if(is_m).alias(f"n{i}"))
        aggs.append(F.count_if(is_m & (F.col("form") == S.ANNUAL_FORM)).alias(f"a{i}"))
    per_ticker = facts.groupBy("ticker").agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric_name"),
                 F.least(F.col(f"a{i}"), F.lit(k)).cast("bigint").alias("records_found"),
                 (F.col(f"n{i}") == 0).alias("missing"))
        for i, m in enumerate(S.FACT_METRICS)
    ])
    return per_ticker.select("ticker", F.inline(rows))


def coverage_from_documents(km: DataFrame, doc: str = "km",
                            keep: tuple[str, ...] = ()) -> DataFrame:
    """Q1 straight from key-metric documents: records kept per allow-listed metric and
    whether the metric was absent from the filing. Per row, no shuffle; `keep` names
    document-level columns carried onto the rows."""
    d = F.col(doc)
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric_name"),
                 # size() of NULL is -1 when ANSI mode is off, so test for NULL first
                 F.when(d["metrics"][m].isNull(), F.lit(0))
                  .otherwise(F.size(d["metrics"][m])).cast("bigint").alias("records_found"),
                 d["metrics"][m].isNull().alias("missing"))
        for m in S.FACT_METRICS
    ])
    return km.select(*keep, d["ticker"].alias("ticker"), F.inline(rows))


def coverage_from_filings(docs: DataFrame, doc: str = "doc", ticker: str = "ticker",
                          k: int = S.TOP_K_PERIODS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Q1 straight from filing documents, without cutting their lists: annual records kept
    (at most k) per allow-listed metric, and whether the filing lacks it. Per row."""
    d = F.col(doc)
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric_name"),
                 F.least(F.size(F.filter(F.coalesce(nested.metric_values(d, m), F.array()),
                                         lambda x: x["form"] == F.lit(S.ANNUAL_FORM))), F.lit(k))
                  .cast("bigint").alias("records_found"),
                 (~nested.has_metric(d, m)).alias("missing"))
        for m in S.FACT_METRICS
    ])
    return docs.filter(d.isNotNull()).select(*keep, F.col(ticker).alias("ticker"), F.inline(rows))


def document_rejects(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """S8 + Q3: how many documents came in by status: `ok`, `corrupt`, `empty` (no text or
    `{}`), `without_facts` (kept, but yields nothing). `docs` as `parse_documents` of filing
    documents gives them."""
    d = F.col(doc)
    status = (F.when(F.col("status") != "ok", F.col("status"))
              .when(d["entityName"].isNull() & d["facts"].isNull(), F.lit("empty"))
              .when(d["facts"].isNull(), F.lit("without_facts")).otherwise(F.lit("ok")))
    return docs.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_documents"))


def key_uniqueness(relations: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Q2: for each relation and key, rows, distinct keys, keys seen more than once and
    the largest multiplicity.

    Keys are counted by fingerprints, two independent 64-bit hashes of the key's columns: what
    is shuffled are three numbers per key and task, no texts, and a key that very many rows
    share is one row per task. (Two of a trillion keys share a fingerprint with a
    probability of 1e-15.) All relations go through one two-level aggregate, partial on
    both levels; a relation without rows has no row in the report."""
    names = list(relations)
    keyed = None
    for i, (df, keys) in enumerate(relations.values()):
        # Hashes skip NULLs: which columns are NULL is hashed too.
        cols = [F.col(k).cast("string") for k in keys]
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
        part = df.select(F.lit(i).alias("r"), F.xxhash64(nulls, *cols).alias("a"),
                         F.xxhash64(F.lit(i), *cols, nulls).alias("b"))
        keyed = part if keyed is None else keyed.unionByName(part)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("r") + 1)
    per_key = keyed.groupBy("r", "a", "b").agg(F.count(F.lit(1)).alias("n")).select(
        pick(names).alias("relation"), pick([",".join(keys) for _, keys in relations.values()]).alias("key_columns"), "n")
    return per_key.groupBy("relation", "key_columns").agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.max("n").alias("max_rows_per_key"),
    )


def clean_counts(typed: DataFrame, required: list[str] | None = None,
                 cap_col: str = "market_cap") -> DataFrame:
    """Q3: before/after counts of the cleaning rules in a single pass."""
    required = required or S.COMPANY_REQUIRED
    complete = None
    for c in required:
        cond = F.col(c).isNotNull()
        complete = cond if complete is None else complete & cond
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    aggs += [
        F.count_if(~complete).alias("rows_incomplete"),
        F.count_if(complete & ~(F.col(cap_col) > 0)).alias("rows_non_positive_cap"),
        F.count_if(complete & (F.col(cap_col) > 0)).alias("rows_out"),
    ]
    return typed.agg(*aggs)


def parse_rejects(raw: DataFrame) -> DataFrame:
    """Q3 for M2: per numeric company column, values that were present in the raw text
    but could not be read as a number (NaN included), and the rows with any such value.
    One pass over the raw frame; empty fields are missing data, not rejects."""
    from ledgerlake.functions import parse_double

    bad = {}
    for header, canonical in S.COMPANY_HEADER_TO_CANONICAL.items():
        if canonical in S.COMPANY_NUMERIC:
            text = F.trim(F.col(f"`{header}`"))
            bad[canonical] = (text.isNotNull() & (text != "")) & parse_double(text).isNull()
    any_bad = None
    for cond in bad.values():
        any_bad = cond if any_bad is None else any_bad | cond
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(cond).alias(f"rejected_{c}") for c, cond in bad.items()],
        F.count_if(any_bad).alias("rows_with_rejects"),
    )


def table_counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """A3: `(table_name, row_count, present)`; an absent source is reported, not fatal."""
    schema = T.StructType([
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("present", T.BooleanType(), False),
    ])
    out = None
    for name, df in tables.items():
        if df is None:
            part = spark.createDataFrame([(name, None, False)], schema)
        else:
            part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.lit(True).alias("present"))
        out = part if out is None else out.unionByName(part)
    return out


def lake_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """A4 per file: path, bytes, KB. `binaryFile` with only `path`/`length` selected
    never reads file contents (the content column is pruned from the scan)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root))
    return files.select(
        F.col("path"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(1024.0), 1).alias("size_kb"),
    )


def lake_totals(files: DataFrame) -> DataFrame:
    """A4 totals: file count and MB."""
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.sum("size_bytes").alias("total_bytes"),
        F.round(F.sum("size_bytes") / F.lit(1024.0 * 1024.0), 2).alias("total_mb"),
    )
