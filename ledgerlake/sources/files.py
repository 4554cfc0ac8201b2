"""File and table readers (S1-S11). Every reader takes an explicit schema.

All readers are lazy: they return a DataFrame whose scan Catalyst prunes and filters.
Folder scans are one distributed job over all matching files, not a driver loop.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas as S
from ledgerlake.operators.nested import parse_documents, ticker_from_file


def read_company_csv(spark: SparkSession, path: str,
                     schema: T.StructType = S.RAW_COMPANY) -> DataFrame:
    """Company CSV with header; every column read as text (raw zone semantics),
    typed later by `operators.clean` with `try_cast`. Quoted commas are honoured.

    The header is checked against the schema's names (`enforceSchema=false`): a file
    whose columns are renamed or reordered fails instead of loading shifted values."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(path))


def profile_csv(spark: SparkSession, path: str, sample: int = 2) -> dict:
    """Row count, column list and a small sample, with inferred types.

    A profiling helper only (inference costs an extra pass); production reads use S1.
    Only the count and `sample` rows reach the driver.
    """
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return {"rows": df.count(), "columns": df.columns,
            "types": dict(df.dtypes), "sample": [r.asDict() for r in df.limit(sample).collect()]}


def optional(spark: SparkSession, read, schema: T.StructType) -> tuple[DataFrame, bool]:
    """S3: run `read()`; a missing path gives an empty frame with `schema` and False,
    so the rest of a load goes on and the absence is reported (A3)."""
    try:
        df = read()
        df.schema  # noqa: B018 - forces path resolution
        return df, True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema), False
        raise


def _json_docs(spark: SparkSession, folder: str, schema: T.StructType, glob: str,
               whole: bool = True, strict: bool = False) -> DataFrame:
    """`doc`, `status` and `file_name` of each document: one per file, or one per line.
    Files take the same path as landed bodies (`nested.parse_documents`)."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    # `wholetext` must go through `text()`: its keyword default overrides an option.
    texts = reader.text(folder, wholetext=whole).select(
        F.col("value").alias("body"), F.col("_metadata.file_name").alias("file_name"))
    if not whole:
        texts = texts.filter(F.trim("body") != "")
    return parse_documents(texts, schema, strict=strict).drop("body")


def read_statements(spark: SparkSession, folder: str, kind: str = "income_statement",
                    strict: bool = False) -> DataFrame:
    """All `{ticker}_{kind}.json` documents of a folder -> column `doc`
    (struct `{symbol, annualReports}`) plus `file_name` and `status`; `strict` fails on a
    corrupt document."""
    return _json_docs(spark, folder, S.STATEMENT_DOC, "*" + S.STATEMENT_KINDS[kind], strict=strict)


def read_all_statements(spark: SparkSession, folder: str) -> DataFrame:
    """S4 + S5 in one scan: every `{ticker}_{kind}.json` under `folder`; `kind` comes from
    the file name. Files of no known kind are ignored."""
    kinds = "|".join(k for k in S.STATEMENT_KINDS)
    df = _json_docs(spark, folder, S.STATEMENT_DOC, "*.json")
    kind = F.regexp_extract(F.col("file_name"), rf"_({kinds})\.json$", 1)
    return df.select(kind.alias("kind"), "doc", "file_name", "status").filter(F.col("kind") != "")


def read_key_metrics(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """Key-metric documents -> column `km`: one pretty-printed document per
    `{ticker}_sec_facts.json`, and the lines of the `part-*.json` files that
    `sinks.files.write_key_metric_docs` writes. A folder may hold both."""
    files = _json_docs(spark, folder, S.KEY_METRICS_DOC, "*" + S.FACTS_DOC_SUFFIX, strict=strict)
    lines = _json_docs(spark, folder, S.KEY_METRICS_DOC, "part-*.json", whole=False, strict=strict)
    return files.unionByName(lines).withColumnRenamed("doc", "km")


def read_filings(spark: SparkSession, folder: str, suffix: str = ".json") -> DataFrame:
    """Full filing documents `{ticker}.json` -> `ticker` (from the file name) + `doc`."""
    df = _json_docs(spark, folder, S.FILING_DOC, "*" + suffix)
    return df.select(ticker_from_file(F.col("file_name"), suffix).alias("ticker"), "doc", "file_name", "status")


def usable_filings(filings: DataFrame) -> DataFrame:
    """Skip documents that came back empty (`{}`, unreadable text).

    A document with a name but no `facts` is kept: it yields a key-metric document
    whose metric map is empty, as the source extraction does."""
    d = F.col("doc")
    return filings.filter(d.isNotNull() & (d["entityName"].isNotNull() | d["facts"].isNotNull()))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """S9 over JDBC. With a numeric partition column the read is parallel; bounds that are
    not given are asked of the database (one aggregate). Without one it is a single task,
    which suits small tables only."""
    props = dict(properties or {})
    if not partition_column:
        return spark.read.jdbc(url, table, properties=props)
    if lower is None or upper is None:
        ends = spark.read.jdbc(url, table, properties=props).agg(
            F.min(partition_column), F.max(partition_column)).first()
        lower = ends[0] if lower is None else lower
        upper = ends[1] if upper is None else upper
    if lower is None or upper is None:  # an empty table
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper + 1,
                           numPartitions=num_partitions or spark.sparkContext.defaultParallelism, properties=props)


def quantile_predicates(keys: DataFrame, column: str, num_partitions: int, accuracy: int = 10_000,
                        quote: str = '"') -> list[str]:
    """WHERE clauses that cut a table's rows into about equal parts by `column` (numeric):
    the quantiles of `keys`, by one sketch aggregate. The clauses cover every row once, the
    rows without a key in the first; a value that many rows share is never cut, so fewer
    clauses than asked for may come back."""
    name = f"{quote}{column}{quote}"
    shares = [i / num_partitions for i in range(1, num_partitions)]
    found = keys.agg(F.percentile_approx(column, shares, accuracy)).first()[0] if shares else []
    cuts = sorted(set(found or []))
    if not cuts:
        return ["1 = 1"]
    return [f"{name} < {cuts[0]} OR {name} IS NULL",
            *[f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:])], f"{name} >= {cuts[-1]}"]


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, partition_column: str,
                       num_partitions: int | None = None, properties: dict | None = None,
                       quote: str = '"') -> DataFrame:
    """S9 over JDBC for keys that are not spread evenly: a first query reads the key column
    alone (in parallel, by equal ranges) for its quantiles; the table is then read by ranges
    of about equally many rows, one task each. `quote` is the database's quote of names."""
    n = num_partitions or spark.sparkContext.defaultParallelism
    ranges = read_jdbc(spark, url, table, properties, partition_column, num_partitions=n)
    clauses = quantile_predicates(ranges.select(partition_column), partition_column, n, quote=quote)
    return spark.read.jdbc(url, table, predicates=clauses, properties=dict(properties or {}))


def has_rows(df: DataFrame) -> bool:
    """S11 guard: True when the frame has at least one row (reads at most one row)."""
    return not df.isEmpty()


def read_landed(spark: SparkSession, path: str, source: str, schema: T.StructType,
                alias: str = "doc", suffix: str = "", strict: bool = False) -> DataFrame:
    """Parse documents landed by `sinks.files.land_documents`: partition pruning on
    `source`, then `parse_documents` per row with an explicit schema."""
    landed = spark.read.parquet(path).filter((F.col("source") == source) & F.col("file_name").endswith(suffix))
    return parse_documents(landed, schema, alias=alias, strict=strict).select("file_name", alias, "status")


def company_lines(lines: DataFrame, column: str = "value", schema: T.StructType = S.RAW_COMPANY) -> DataFrame:
    """S1 for lines of text that are landed already (no header): the same schema and quoting
    as `read_company_csv`."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col(column), ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    # Unfolded as one row, so that a line is parsed once, not once per column.
    return lines.select(F.inline(F.array(parsed)))

