"""Composite, user-level jobs (G1-G6) over real file inputs.

Each job is a short chain of library operators that ends in a write; downstream jobs
read what upstream jobs wrote (raw tables, curated Parquet), so lineage is cut at
every zone boundary and a lost executor only recomputes from the last written table.
Counts that the source system printed are gathered with `observe` during the write,
not with extra `count()` passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators import clean, mart, metrics, nested, quality, reports, staging
from ledgerlake.session import checkpoint_dir
from ledgerlake.sinks import files as sinks
from ledgerlake.sources import files as sources


@dataclass(frozen=True)
class Lake:
    """Zone layout under one root URI (any Hadoop file system)."""

    root: str

    def raw(self, source: str) -> str:
        return f"{self.root}/raw/{source}"

    def curated(self, name: str) -> str:
        return f"{self.root}/curated/{name}"

    @property
    def landed(self) -> str:
        return f"{self.root}/raw/landed"


# ---------------------------------------------------------------------------
# Company ETL
# ---------------------------------------------------------------------------

def company_etl(spark: SparkSession, csv_path: str, out_path: str,
                required: list[str] | None = None) -> tuple[DataFrame, dict]:
    """G1: CSV -> clean -> metrics -> curated Parquet; returns the sector summary
    (read back from the written table) and the before/after row counts."""
    typed = clean.typed_company(sources.read_company_csv(spark, csv_path))
    seen_in = Observation("rows_in")
    seen_out = Observation("rows_out")
    cleaned = clean.positive_market_cap(clean.drop_incomplete(
        typed.observe(seen_in, F.count(F.lit(1)).alias("n")), required))
    out = metrics.company_metrics(cleaned).observe(seen_out, F.count(F.lit(1)).alias("n"))
    sinks.write_parquet(out, out_path)
    summary = reports.sector_summary(spark.read.parquet(out_path))
    return summary, {"rows_in": seen_in.get["n"], "rows_out": seen_out.get["n"],
                     "columns": len(typed.columns)}


def company_etl_normalised(spark: SparkSession, csv_path: str, out_path: str) -> dict:
    """The normalised-header variant (3 required columns, two ratios) -> CSV."""
    seen = Observation("rows")
    out = metrics.company_metrics_normalised(sources.read_company_csv(spark, csv_path)) \
        .observe(seen, F.count(F.lit(1)).alias("n"))
    sinks.write_csv(out, out_path)
    return {"rows": seen.get["n"]}


# ---------------------------------------------------------------------------
# Key metrics from full filing documents
# ---------------------------------------------------------------------------

def facts_extraction(spark: SparkSession, filings_dir: str, out_dir: str,
                     k: int = S.TOP_K_PERIODS) -> DataFrame:
    """Filing JSON -> per-document top-k annual USD facts of the six metrics ->
    one key-metric JSON document per ticker; returns the coverage report (Q1).

    Everything is a per-row projection over the documents: no shuffle until the
    partitioned write."""
    filings = sources.usable_filings(sources.read_filings(spark, filings_dir))
    km = filings.select(nested.key_metrics_document(F.col("doc"), F.col("ticker"), k).alias("km"))
    sinks.write_key_metric_docs(km, out_dir)
    written = sources.read_key_metrics(spark, out_dir)
    return quality.coverage_from_documents(written)


def facts_extraction_from_landed(spark: SparkSession, landed_path: str, out_dir: str,
                                 source: str = "sec", suffix: str = ".json",
                                 k: int = S.TOP_K_PERIODS) -> DataFrame:
    """G3 from the raw zone: filing bodies landed as Parquet rows (K7) are parsed per row
    with `from_json`, so many or very large filings parse in parallel across rows
    instead of one multi-line file scan per task; the rest is as `facts_extraction`."""
    landed = sources.read_landed(spark, landed_path, source, S.FILING_DOC, suffix=suffix)
    filings = sources.usable_filings(landed.select(
        nested.ticker_from_file(F.col("file_name"), suffix).alias("ticker"), "doc"))
    km = filings.select(nested.key_metrics_document(F.col("doc"), F.col("ticker"), k).alias("km"))
    sinks.write_key_metric_docs(km, out_dir)
    written = sources.read_key_metrics(spark, out_dir)
    return quality.coverage_from_documents(written)


# ---------------------------------------------------------------------------
# Raw table load
# ---------------------------------------------------------------------------

RAW_TABLES = ["raw_financials", "raw_income_statements", "raw_sec_facts"]


def raw_table_load(spark: SparkSession, csv_path: str, api_dir: str, sec_dir: str,
                   write=None, read=None, strict: bool = True, landed: str | None = None) -> DataFrame:
    """Load the three raw tables (full refresh) and report their row counts.

    A missing source is skipped and reported as absent; an empty one leaves its table
    untouched; a corrupt document fails the load before anything of its table is replaced,
    unless `strict` is off (then `quality.document_rejects` counts it). `write(df, name)`
    defaults to a refresh without a window of missing data (K4); pass a writer and
    `read(name)`, which gives the written table or None, to load another target, e.g. a
    database. With `landed` the statements come from the raw zone (K7), not from `api_dir`.
    """
    if (write is None) != (read is None):
        raise ValueError("pass `read` with `write`: counts are those of the target")
    write = write or (lambda df, name: sinks.swap_refresh(spark, df, name, keep=3))
    read = read or (lambda name: spark.table(name) if spark.catalog.tableExists(name) else None)
    frames: dict[str, DataFrame | None] = {}

    company, ok = sources.optional(spark, lambda: sources.read_company_csv(spark, csv_path),
                                   S.RAW_COMPANY)
    frames["raw_financials"] = clean.raw_financials(company) if ok else None

    def statements() -> DataFrame:
        if landed:
            return sources.read_landed(spark, landed, "api", S.STATEMENT_DOC,
                                       suffix=S.STATEMENT_KINDS["income_statement"], strict=strict)
        return sources.read_statements(spark, api_dir, strict=strict)

    stmts, ok = sources.optional(spark, statements, S.STATEMENT_DOC)
    frames["raw_income_statements"] = (
        nested.explode_statements(stmts, S.INCOME_REPORT_FIELDS, others=True) if ok else None)

    kms, ok = sources.optional(spark, lambda: sources.read_key_metrics(spark, sec_dir, strict), S.KEY_METRICS_DOC)
    frames["raw_sec_facts"] = (
        nested.explode_key_metrics(kms).drop("pos") if ok else None)

    for name, df in frames.items():
        if df is not None:
            sinks.write_if_rows(df, lambda d, n=name: write(d, n))
    return quality.table_counts(spark, {name: read(name) for name in frames})


DOCUMENT_KEY = ["file_name", "digest"]


def delta_load(spark: SparkSession, name: str, landed: DataFrame, parse, keep: int = 3) -> dict:
    """G4 by change: only documents whose content is new are parsed, and their rows replace
    those of the documents that changed or went; the result equals a full refresh.

    `landed` are rows of the raw zone (K7), which must not be landed anew meanwhile;
    `parse(documents)` gives rows that keep `file_name` and `digest`, which the table has too.
    What was loaded is kept as (file_name, digest, n) in `name__documents`, written after
    the table: a load that fails in between parses its documents once more. Files that share
    a name and a content count as changed when their number does. Bodies are read for
    changed documents only; without any change nothing is written.
    Returns how many documents were parsed and how many went or were replaced.
    """
    if "digest" not in landed.columns:
        landed = landed.withColumn("digest", sinks.body_digest(F.col("body")))
    current = landed.groupBy(*DOCUMENT_KEY).agg(F.count(F.lit(1)).alias("n"))
    manifest = f"{name}__documents"
    known = spark.table(manifest) if spark.catalog.tableExists(name) and spark.catalog.tableExists(manifest) else None
    if known is None:
        todo, gone = current, 0
    else:
        todo = current.join(known, [*DOCUMENT_KEY, "n"], "left_anti")
        gone = known.join(current, [*DOCUMENT_KEY, "n"], "left_anti").agg(F.sum("n")).first()[0] or 0
    parsed = todo.agg(F.sum("n")).first()[0] or 0
    if known is None or parsed or gone:
        rows = parse(landed.join(todo, DOCUMENT_KEY, "left_semi"))
        if known is not None:
            same = current.join(known, [*DOCUMENT_KEY, "n"], "left_semi")
            rows = spark.table(name).join(same, DOCUMENT_KEY, "left_semi").unionByName(rows)
        sinks.swap_refresh(spark, rows, name, keep=keep)
        sinks.swap_refresh(spark, current, manifest, keep=keep)
    return {"parsed": parsed, "gone": gone}


def load_landed_statements(spark: SparkSession, landed: str, name: str = "raw_income_statements_delta",
                           kind: str = "income_statement", strict: bool = True) -> dict:
    """`delta_load` of the landed statements of one kind, all keys kept."""
    docs = spark.read.parquet(landed).where((F.col("source") == "api") & F.col("file_name").endswith(S.STATEMENT_KINDS[kind]))
    return delta_load(spark, name, docs, lambda changed: nested.explode_statements(
        nested.parse_documents(changed, S.STATEMENT_DOC, strict=strict), S.INCOME_REPORT_FIELDS,
        keep=tuple(DOCUMENT_KEY), others=True))


# ---------------------------------------------------------------------------
# Staging views and the mart
# ---------------------------------------------------------------------------

def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder the cluster names in
    `spark.checkpoint.dir` (survives executor loss; `localCheckpoint` would not)."""
    if not checkpoint_dir(spark):
        raise ValueError("spark.checkpoint.dir is not set: name a folder every executor "
                         "and the driver can reach, or write the result to a table")
    return df.checkpoint(eager=True)


def build_mart(spark: SparkSession, out_path: str | None = None,
               raw: dict[str, DataFrame] | None = None, checkpoint: bool = False) -> DataFrame:
    """Staging views over the raw tables, then the mart; optionally written as
    Parquet partitioned by fiscal year and sorted within files (O2 on write), or
    checkpointed when several exports will read it."""
    raw = raw or {n: spark.table(n) for n in RAW_TABLES}
    stg = {
        "stg_financials": staging.stg_financials(raw["raw_financials"]),
        "stg_income_statements": staging.stg_income_statements(raw["raw_income_statements"]),
        "stg_sec_facts": staging.stg_sec_facts(raw["raw_sec_facts"]),
    }
    sinks.register_views(stg)
    m = mart.mart(spark.table("stg_income_statements"), spark.table("stg_sec_facts"),
                  spark.table("stg_financials"), ordered=False)
    if out_path:
        sinks.write_parquet(m, out_path, partition_by=["fiscal_year"],
                            sort_within=[F.col("ticker").asc_nulls_last()])
        # Reading a partitioned table puts the partition column last.
        m = spark.read.parquet(out_path).select(*mart.MART_COLUMNS)
    elif checkpoint:
        m = materialize(spark, m)
    m.createOrReplaceTempView("mart_financials")
    return m


# ---------------------------------------------------------------------------
# Lake publish
# ---------------------------------------------------------------------------

def land_raw(spark: SparkSession, lake: Lake, csv_path: str, api_dir: str, sec_dir: str) -> None:
    """K1 + K7: the raw zone, before anything else runs. The company file is copied as
    text; statement and filing documents are kept unparsed as rows of the landed table."""
    sinks.write_raw_csv(sources.read_company_csv(spark, csv_path), lake.raw("company"))
    # Each source replaces only its own partition, so re-running a day never duplicates.
    sinks.land_documents(spark, api_dir, "*.json", "api", lake.landed, mode="overwrite")
    sinks.land_documents(spark, sec_dir, "*.json", "sec", lake.landed, mode="overwrite")


def publish_curated(spark: SparkSession, lake: Lake, curated_financials: str | None = None,
                    mart_name: str = "mart_financials") -> DataFrame:
    """K8 + K5 + K6, then the inventory (A4): company Parquet, mart CSV (in the mart's
    order) and the loaded company table as CSV in the curated zone; a missing input is
    skipped (S3). A company table that is in its place already is not copied."""
    if curated_financials and curated_financials != lake.curated("financials"):
        company, ok = sources.optional(spark, lambda: spark.read.parquet(curated_financials), S.RAW_COMPANY)
        if ok:
            sinks.write_parquet(company, lake.curated("financials"))
    if spark.catalog.tableExists(mart_name):
        ordered = spark.table(mart_name).select(*mart.MART_COLUMNS).orderBy(*mart.mart_order())
        sinks.write_csv(ordered, lake.curated("mart_financials"))
    if spark.catalog.tableExists("raw_financials"):
        # K6: the loaded company table as curated CSV (available even before the mart)
        sinks.write_raw_csv(spark.table("raw_financials"), lake.curated("financials_csv"))
    return quality.lake_files(spark, lake.root)


def lake_publish(spark: SparkSession, lake: Lake, csv_path: str, api_dir: str, sec_dir: str,
                 curated_financials: str | None = None, mart_name: str = "mart_financials") -> DataFrame:
    """Raw zone (CSV copy + landed JSON documents), curated zone (company Parquet
    and mart CSV), then the lake inventory."""
    land_raw(spark, lake, csv_path, api_dir, sec_dir)
    return publish_curated(spark, lake, curated_financials, mart_name)


# ---------------------------------------------------------------------------
# The daily refresh, in dependency order
# ---------------------------------------------------------------------------

def daily_refresh(spark: SparkSession, lake: Lake, csv_path: str, api_dir: str,
                  filings_dir: str) -> dict[str, DataFrame]:
    """Run the jobs in dependency order: land the raw zone (K1, K7) first; then company
    ETL (G1) from the raw copy and key-metric extraction (G3) from the landed filing
    bodies; raw table load (G4) from the raw copy, the landed statements and the extracted
    metrics; staging and mart (G5); curated publish and inventory
    (G6). Each step reads what the previous one wrote, and an exception in any step
    stops the run (nothing downstream runs on stale inputs)."""
    land_raw(spark, lake, csv_path, api_dir, filings_dir)
    summary, counts = company_etl(spark, lake.raw("company"), lake.curated("financials"))
    coverage = facts_extraction_from_landed(spark, lake.landed, lake.curated("key_metrics"))
    tables = raw_table_load(spark, lake.raw("company"), api_dir, lake.curated("key_metrics"), landed=lake.landed)
    mart_df = build_mart(spark, lake.curated("mart_parquet"))
    inventory = publish_curated(spark, lake)
    return {"sector_summary": summary, "coverage": coverage, "table_counts": tables,
            "mart": mart_df, "inventory": inventory,
            "clean_counts": spark.createDataFrame([counts])}
