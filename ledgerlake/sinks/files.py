"""Writers for the raw and curated zones, catalog tables and JDBC targets.

No writer coalesces to one file: a single-file write runs in one task. Output file
size is bounded with `maxRecordsPerFile` instead, and partitioned layouts let later
reads prune directories.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1/K6: untouched copy as CSV with header, every column as text."""
    as_text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    as_text.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3/K5: curated CSV with header."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None,
                  sort_within: list | None = None,
                  replace_partitions_only: bool = False) -> None:
    """K2/K8: Parquet write straight to the target URI (the committer writes `_SUCCESS`).

    With `partition_by` rows are first rebalanced on those columns, so a directory gets a
    few files rather than one per task, and a large one is split; rows are sorted by them
    first, as the writer needs.

    `sort_within` orders rows inside each output file without a global sort (O2 on
    write); `partition_by` gives directory pruning to later reads. An overwrite is a full
    refresh (partitions no longer produced are removed) unless `replace_partitions_only`.
    """
    keys = [F.col(c) for c in partition_by or []]
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_within:
        out = out.sortWithinPartitions(*keys, *sort_within)
    w = out.write.mode(mode).option(
        "partitionOverwriteMode", "dynamic" if replace_partitions_only else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> None:
    """K4 (catalog form): full-refresh load of a managed table."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


_VERSION_KEY, _TIME_KEY = "refresh.version", "refresh.time"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _versions(spark: SparkSession, name: str) -> dict[int, str]:
    prefix = f"{name}__v"
    found = [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    return {int(t[len(prefix):]): t for t in found if t[len(prefix):].isdigit()}


def swap_refresh(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet",
                 keep: int | None = None, min_age_seconds: float = 3600.0) -> str:
    """K4 without a window of missing data: write the new content to a fresh versioned
    table `name__vN`, then repoint the view `name` at it in one catalog statement.
    Returns the new table's name.

    A version is claimed by creating its empty table, which the catalog grants to one writer
    only: of two refreshes at a time each gets a version of its own. The view remembers its
    version, and a refresh that ends after a later one leaves the view alone. Readers of an
    earlier version keep reading it; with `keep`, versions before the `keep` newest are dropped
    (`drop_old_versions`) once they are published over."""
    if spark.catalog.tableExists(name) and not any(
            t.name == name and t.tableType == "VIEW" for t in spark.catalog.listTables()):
        raise ValueError(f"{name} exists and is not a view; refusing to replace a table")
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    version = max(_versions(spark, name), default=0) + 1
    while True:
        table = f"{name}__v{version}"
        try:
            spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} "
                      f"TBLPROPERTIES ('{_VERSION_KEY}' = '{version}', '{_TIME_KEY}' = '{time.time()}')")
            break
        except AnalysisException as e:  # another writer has it
            if "ALREADY_EXISTS" not in str(e):
                raise
            version += 1
    df.write.mode("append").format(fmt).saveAsTable(table)
    shown = int(_properties(spark, name).get(_VERSION_KEY, 0)) if spark.catalog.tableExists(name) else 0
    if version > shown:
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_VERSION_KEY}' = '{version}') AS SELECT * FROM {table}")
    if keep is not None:
        drop_old_versions(spark, name, keep, min_age_seconds)
    return table


def drop_old_versions(spark: SparkSession, name: str, keep: int = 2, min_age_seconds: float = 3600.0) -> list[str]:
    """Drop the versions of `swap_refresh` that came before the view's `keep` newest (its own
    included) and are older than `min_age_seconds`, the longest that a reader may take: a
    plan that was made from the view before it moved still reads them until then. Versions
    above the view's are being written and stay. Returns the dropped tables."""
    shown = int(_properties(spark, name).get(_VERSION_KEY, 0))
    published = sorted((v for v in _versions(spark, name) if v <= shown), reverse=True)
    dropped = []
    for v in published[max(1, keep):]:
        table = f"{name}__v{v}"
        if time.time() - float(_properties(spark, table).get(_TIME_KEY, 0)) >= min_age_seconds:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            dropped.append(table)
    return dropped


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batchsize: int = 500, num_partitions: int | None = None,
               mode: str = "overwrite", truncate: bool = True) -> None:
    """K4 (JDBC form): full refresh in batches of `batchsize` rows per statement;
    `num_partitions` caps concurrent connections to the target. An existing table is
    truncated, not dropped, so the database's views, grants and indexes on it survive
    the refresh (a drop would take dependent views with it)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    props.setdefault("truncate", "true" if truncate else "false")
    out.write.jdbc(url, table, mode=mode, properties=props)


def body_digest(body: Column) -> Column:
    return F.coalesce(F.sha2(body, 256), F.lit(""))


def land_documents(spark: SparkSession, src: str, glob: str, source: str, out: str,
                   mode: str = "append") -> DataFrame:
    """K7: raw-zone landing. Documents are kept unparsed as rows `(source, file_name,
    body, digest)` of a Parquet table partitioned by source; parsing later runs per row with
    `from_json`, so one large document is one row, not one serial multi-line scan. Later
    loads tell by the digest, without reading bodies, which documents changed."""
    # `wholetext` must go through `text()`: its keyword default overrides an option.
    docs = (spark.read.option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).text(src, wholetext=True)
            .select(F.lit(source).alias("source"),
                    F.col("_metadata.file_name").alias("file_name"),
                    F.col("value").alias("body"), body_digest(F.col("value")).alias("digest")))
    # Dynamic overwrite on this write: re-landing one source replaces only its own
    # partition, whatever the session's default overwrite mode is.
    (docs.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("source").parquet(out))
    return docs


def write_key_metric_docs(docs: DataFrame, path: str, mode: str = "overwrite",
                          max_records_per_file: int | None = 100_000) -> None:
    """K9: key-metric documents as JSON Lines, one `{ticker, company_name, metrics}`
    document per line. No directory per ticker (thousands of tiny files at scale);
    `maxRecordsPerFile` bounds each file instead."""
    flat = docs.select(F.col("km.ticker").alias("ticker"),
                       F.col("km.company_name").alias("company_name"),
                       F.col("km.metrics").alias("metrics"))
    w = flat.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.json(path)


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Serve curated files as an external catalog table over `path`.

    Partition folders (`col=value/`) are registered too, so readers prune them. Only an
    external table of that name is replaced (its files stay); any other entry is refused."""
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{name} exists and is {kind}, not an external table; refusing to drop it")
        spark.sql(f"DROP TABLE {name}")
    table = spark.catalog.createTable(name, path=path, source=fmt)
    if table.schema and spark.sql(f"DESCRIBE TABLE {name}").filter(
            "col_name = '# Partition Information'").count() > 0:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Models as temp views, created in dependency order by the caller."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_if_rows(df: DataFrame, write) -> bool:
    """Call `write(df)` only when `df` has rows; an empty result leaves the
    target untouched."""
    if df.isEmpty():
        return False
    write(df)
    return True
