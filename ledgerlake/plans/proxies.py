"""Shape the driver's test tables into the reference's data model.

The reference's own inputs (a company CSV, statement JSON and filing JSON) are not
shipped, so every registered query first derives them from `part` and `lineitem`
with the rules below, then runs the library operators on the result. The shaping
rules only assign values (including edge values such as a malformed price, a NaN
market cap, a `'None'` amount or a missing fact value); they never drop rows, and the
work grows with the tables.

Scale: both derivations are one partial+final hash aggregate on the lineitem key,
followed by a sort-merge (or AQE broadcast) join with `part`; the aggregate output is
already hash-partitioned on the join key, so only `part` is shuffled for the join.

Every rule has a twin in `plans/oracle.py`, written independently in DuckDB SQL.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake import session
from ledgerlake.operators import nested


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as it is now: listed anew at each call, so rows appended since are seen."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money_text(c: Column) -> Column:
    """Integer cents -> text `d.cc`, as a CSV or API would carry it."""
    return (c.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)").cast("string")


def _cents(c: Column) -> Column:
    return F.round(c * F.lit(100.0)).cast("bigint")


def _pct_int(c: Column) -> Column:
    return F.round(c * F.lit(100.0)).cast("bigint")


# More cents than a 64-bit integer holds.
HUGE_CAP = "100000000000000000"


# ---------------------------------------------------------------------------
# Company snapshot (raw, all text, CSV header names)
# ---------------------------------------------------------------------------

def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        _cents(F.col("l_extendedprice")).alias("ext_c"),
        _pct_int(F.col("l_discount")).alias("disc"),
    )
    per_part = li.groupBy("l_partkey").agg(
        F.min("ext_c").alias("lo_c"),
        F.max("ext_c").alias("hi_c"),
        F.sum("ext_c").alias("total_c"),
        F.sum(F.col("ext_c") * (F.lit(100) - F.col("disc"))).alias("ebitda_c"),
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    j = part.join(per_part, part.p_partkey == per_part.l_partkey, "left")

    size = F.col("p_size")
    mult = (F.when(F.col("p_partkey") % 4 == 0, 5)
            .when(F.col("p_partkey") % 4 == 1, 30)
            .when(F.col("p_partkey") % 4 == 2, 200)
            .otherwise(2000))
    key = F.col("p_partkey")
    # Symbols: some missing (empty or NULL), some companies listed under their neighbour's
    # symbol too, which leaves their own unlisted (M13, both sides of J2). Names: some missing.
    symbol = (F.when(key % 43 == 0, F.lit("")).when(key % 47 == 0, F.lit(None).cast("string"))
              .when(key % 31 == 0, (key - 1).cast("string")).otherwise(key.cast("string")))
    name = F.when(key % 37 != 0, F.col("p_name"))
    price = F.when(size % 13 == 0, F.lit("n/a")).otherwise(
        money_text(_cents(F.col("p_retailprice"))))
    # Edge values: not a number, infinite (as a word, and beyond a double), zero, huge.
    market_cap = (F.when(size % 17 == 0, F.lit("NaN"))
                  .when(size % 11 == 0, F.lit("0"))
                  .when(size % 19 == 0, F.lit("Infinity"))
                  .when(size % 23 == 0, F.lit("1e400"))
                  .when(size % 29 == 0, F.lit(HUGE_CAP))
                  .otherwise((F.col("total_c").cast("decimal(33,0)") * mult).cast("string")))
    cols = {
        "Symbol": symbol,
        "Name": name,
        "Sector": F.col("p_type"),
        "Price": price,
        "Price/Earnings": F.when(size % 5 == 0, F.lit(None).cast("string"))
                           .otherwise(money_text(size * 50)),
        "Dividend Yield": money_text(size * 7),
        "Earnings/Share": money_text(size * 37),
        "52 Week Low": money_text(F.col("lo_c")),
        "52 Week High": money_text(F.col("hi_c")),
        "Market Cap": market_cap,
        "EBITDA": F.when(size % 7 == 0, F.lit(None).cast("string"))
                   .otherwise(money_text(F.col("ebitda_c"))),
        "Price/Sales": money_text(size * 21),
        "Price/Book": money_text(size * 13),
        "SEC Filings": F.concat(F.lit("filings/"), key.cast("string")),
    }
    return j.select(*[c.alias(n) for n, c in cols.items()])


# ---------------------------------------------------------------------------
# Statements, one report per (supplier, ship year)
# ---------------------------------------------------------------------------

def _supplier_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("yr"),
        _cents(F.col("l_extendedprice")).alias("ext_c"),
        _pct_int(F.col("l_discount")).alias("disc"),
        _pct_int(F.col("l_tax")).alias("tax"),
        F.col("l_linenumber").cast("bigint").alias("ln"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    return li.groupBy("l_suppkey", "yr").agg(
        F.sum("ext_c").alias("rev"),
        F.sum(F.col("ext_c") * (F.col("tax") - F.col("disc"))).alias("net"),
        F.sum(F.col("ext_c") * (F.lit(10) - F.col("disc"))).alias("opi"),
        F.sum(F.col("ext_c") * F.col("ln") * F.lit(10)).alias("equity"),
        F.sum(F.col("ext_c") * F.col("qty")).alias("assets"),
        F.sum(F.col("ext_c") * (F.col("qty") - F.col("ln"))).alias("liab"),
    )


def _statement_columns() -> dict[str, dict[str, Column]]:
    """Report fields of each statement kind, all text, over `_supplier_years`."""
    key, yr = F.col("l_suppkey"), F.col("yr")
    none = F.lit(S.NONE_SENTINEL)
    text = {c: F.col(c).cast("string") for c in ("net", "opi", "equity", "assets", "liab")}
    ticker = key.cast("string")
    date = F.concat(yr.cast("string"), F.lit("-12-31"))
    usd = F.lit("USD")
    return {
        "income_statement": {
            "ticker": ticker,
            # some reports carry no date
            "fiscalDateEnding": F.when((key + yr) % 11 != 0, date),
            "reportedCurrency": F.when(key % 3 != 0, usd),
            # no amount, zero and negative revenue
            "totalRevenue": F.when((key + yr) % 5 == 0, none)
                             .when((key + yr) % 7 == 0, F.lit("0"))
                             .when((key * 3 + yr) % 17 == 0, (F.col("rev") * -100).cast("string"))
                             .otherwise((F.col("rev") * 100).cast("string")),
            "netIncome": text["net"],
            "operatingIncome": text["opi"],
            "stockholdersEquity": F.when(yr % 4 == 0, none).otherwise(text["equity"]),
            "grossProfit": (F.col("rev") * 40).cast("string"),
        },
        "balance_sheet": {
            "ticker": ticker, "fiscalDateEnding": date, "reportedCurrency": usd,
            "totalAssets": text["assets"], "totalLiabilities": text["liab"],
            "totalShareholderEquity": text["equity"],
        },
        "cash_flow": {
            "ticker": ticker, "fiscalDateEnding": date, "reportedCurrency": usd,
            "operatingCashflow": (F.col("opi") + F.col("net")).cast("string"),
            "capitalExpenditures": (F.col("rev") - F.col("opi")).cast("string"),
        },
    }


# Keys of income reports that no later step names; a fourth of the reports lack the second.
def _more_income_keys() -> list[Column]:
    return [(F.col("rev") * 60).cast("string").alias("costOfRevenue"),
            F.when(F.col("yr") % 4 != 1, (F.col("liab") * 5).cast("string")).alias("interestExpense")]


def raw_income_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened statement rows (`ticker` + report fields, all text), as loaded."""
    columns = _statement_columns()["income_statement"]
    none = F.lit(None).cast("string")
    return _supplier_years(spark, sf_dir).select(
        *[columns.get(f, none).alias(f) for f in ["ticker", *S.INCOME_REPORT_FIELDS]])


def statement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all three kinds, from one pass over the supplier years."""
    return nested.stack_kinds(_supplier_years(spark, sf_dir), _statement_columns(),
                              ["ticker", *S.ALL_REPORT_FIELDS])


def statement_documents(spark: SparkSession, sf_dir: str,
                        kinds: tuple[str, ...] = tuple(S.STATEMENT_KINDS)) -> DataFrame:
    """D2 documents `{symbol, annualReports}` as JSON text, one per ticker and kind,
    named `{ticker}_{kind}.json`; all kinds of a ticker come from one grouped row.

    A ticker's document holds one report per year, so its size is bounded by the
    number of years, not by the data volume.
    """
    columns = _statement_columns()
    reports = []
    for kind in kinds:
        fields = [c.alias(f) for f, c in columns[kind].items() if f != "ticker"]
        fields += _more_income_keys() if kind == "income_statement" else []
        reports.append(F.struct(*fields).alias(kind))
    by_ticker = _supplier_years(spark, sf_dir).groupBy("l_suppkey").agg(
        F.sort_array(F.collect_list(F.struct("yr", *reports))).alias("reports"))
    ticker = F.col("l_suppkey").cast("string")
    return by_ticker.select(F.inline(F.array(*[
        F.struct(F.concat(ticker, F.lit(S.STATEMENT_KINDS[kind])).alias("file_name"),
                 F.to_json(F.struct(ticker.alias("symbol"),
                                    F.col(f"reports.{kind}").alias("annualReports"))).alias("body"))
        for kind in kinds])))


def income_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statement_documents(spark, sf_dir, ("income_statement",))


# ---------------------------------------------------------------------------
# Long filing facts, one per lineitem
# ---------------------------------------------------------------------------

# Return flag + line status -> filing metric (fixed proxy mapping).
FLAG_METRIC = {
    "AF": "NetIncomeLoss",
    "AO": "Revenues",
    "NF": "Assets",
    "NO": "Liabilities",
    "RF": "StockholdersEquity",
    "RO": "OperatingIncomeLoss",
}
# Metrics outside the allow-list that the proxy also emits.
OFF_LIST_LINE_METRIC = "EarningsPerShareBasic"
OFF_LIST_LIABILITIES = "LiabilitiesAndStockholdersEquity"


def _metric_expr() -> Column:
    combo = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    expr = F.when(F.col("l_linenumber") == 7, F.lit(OFF_LIST_LINE_METRIC))
    expr = expr.when((combo == "NO") & (F.col("l_suppkey") % 2 == 1), F.lit(OFF_LIST_LIABILITIES))
    for k, v in FLAG_METRIC.items():
        expr = expr.when(combo == k, F.lit(v))
    return expr


METRIC_NAMES = sorted({*FLAG_METRIC.values(), OFF_LIST_LINE_METRIC, OFF_LIST_LIABILITIES})


def _metric_number() -> Column:
    """The place in `METRIC_NAMES`, from 1, of a line's metric (`_metric_expr`), by one lookup."""
    number = {m: F.lit(i) for i, m in enumerate(METRIC_NAMES, 1)}
    combo = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    by_flag = F.create_map(*[x for k, m in FLAG_METRIC.items() for x in (F.lit(k), number[m])])
    return (F.when(F.col("l_linenumber") == 7, number[OFF_LIST_LINE_METRIC])
            .when((F.col("l_suppkey") % 2 == 1) & (combo == "NO"), number[OFF_LIST_LIABILITIES])
            .otherwise(by_flag[combo]))


# Consecutive order keys per filing document (fixed proxy parameter).
ORDERS_PER_FILING = 2048

# Table bytes per partition of lines: about half a million lines, some 100 MB in a sort.
DOCUMENT_PARTITION_BYTES = 8 * 1024 * 1024


def _document_partitions(spark: SparkSession, sf_dir: str) -> int:
    size = session.input_bytes(spark, f"{sf_dir}/lineitem.parquet")
    return max(3 * spark.sparkContext.defaultParallelism, -(-size // DOCUMENT_PARTITION_BYTES))


def _block() -> Column:
    return F.expr(f"l_orderkey div {ORDERS_PER_FILING}")


def _company_name(block: Column) -> Column:
    """Some companies spell their name another way in every second filing."""
    other = (F.col("l_suppkey") % 6 == 0) & (block % 2 == 1)
    return F.concat(F.when(other, F.lit("COMPANY ")).otherwise(F.lit("Company ")),
                    F.col("l_suppkey").cast("string"))


def _fact_value() -> Column:
    """Some facts lack a value."""
    return F.when(F.col("l_tax") != 0, _cents(F.col("l_extendedprice")))


def _fact_columns(order: Column, ln: Column, day: Column, value: Column) -> dict[str, Column]:
    """Keys of a filing fact; some facts lack `end` or `form`."""
    return {
        "end": F.when(~((ln == 5) & (F.col("l_suppkey") % 8 == 0)), day.cast("string")),
        "val": value,
        "form": F.when(ln != 6, F.when(ln % 2 == 1, F.lit(S.ANNUAL_FORM)).otherwise(F.lit("10-Q"))),
        "fy": F.year(day),
        "fp": F.when(ln % 2 == 1, F.lit("FY")).otherwise(F.concat(F.lit("Q"), F.quarter(day).cast("string"))),
        "filed": F.date_add(day, 30).cast("string"),
        "accn": F.concat_ws("-", order.cast("string"), ln.cast("string")),
    }


def raw_sec_facts(spark: SparkSession, sf_dir: str, with_order: bool = True) -> DataFrame:
    """D5 rows plus the position of each fact in its source: (`doc_id`, `line_no`)."""
    fact = _fact_columns(F.col("l_orderkey"), F.col("l_linenumber"), F.to_date("l_shipdate"), _fact_value())
    cols = [
        F.col("l_suppkey").cast("string").alias("ticker"),
        _company_name(_block()).alias("company_name"),
        _metric_expr().alias("metric_name"),
        F.coalesce(fact["end"], F.lit("")).alias("period_end"),
        fact["val"].alias("value"),
        F.coalesce(fact["form"], F.lit("")).alias("form"),
        F.lit(S.DEFAULT_CURRENCY).alias("currency"),
    ]
    if with_order:
        cols += [F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("bigint").alias("line_no")]
    return table(spark, sf_dir, "lineitem").select(*cols)


def filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 filing documents as JSON text, one per (company, block of consecutive orders).

    A document holds the lines of at most `ORDERS_PER_FILING` orders, so it stays
    bounded however the data grows. Array order is (order, line, value), so a
    document's array position is the source tie-break, and blocks of consecutive
    orders keep the global order `(doc_id, position)` equal to `(order, line, value)`.
    A ninth of the companies also report each metric in another currency (F9).
    """
    # One shuffle and one aggregate over numbers only: a line is its order, line number, value,
    # day and metric number (64 bytes a row); texts are made per document, after the lines are
    # together. A document holds few facts, so a map-side partial aggregate could not shrink
    # much: the lines are hash-partitioned first and grouped where they are. Partitions are as
    # many as keep their sort in memory, whatever the session's settings coalesce to. The text
    # passes an `explode`, which no projection or filter is moved through: it is made once,
    # however often later steps name it.
    line = F.struct("l_orderkey", "l_linenumber", "v", "day", "metric")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", _block().alias("doc_id"), "l_orderkey", "l_linenumber", _fact_value().alias("v"),
        F.to_date("l_shipdate").alias("day"), _metric_number().alias("metric"))
    per_doc = (lines.filter(F.col("metric").isNotNull())
               .repartition(_document_partitions(spark, sf_dir), "l_suppkey", "doc_id")
               .groupBy("l_suppkey", "doc_id").agg(F.sort_array(F.collect_list(line)).alias("xs")))

    def units(metric: Column) -> Column:
        own = F.filter("xs", lambda x: x["metric"] == metric)

        def listed(times: int) -> Column:
            return F.transform(own, lambda x: F.struct(*[
                c.alias(k) for k, c in _fact_columns(x["l_orderkey"], x["l_linenumber"], x["day"], x["v"] * times).items()]))

        usd = F.create_map(F.lit(S.UNIT), listed(1))
        return F.when(F.col("l_suppkey") % 9 == 0, F.map_concat(F.create_map(F.lit("EUR"), listed(2)), usd)).otherwise(usd)

    metrics = F.array_sort(F.array_distinct(F.transform("xs", lambda x: x["metric"])))
    entries = F.transform(metrics, lambda m: F.struct(
        F.element_at(F.array(*[F.lit(n) for n in METRIC_NAMES]), m).alias("key"), F.struct(units(m).alias("units")).alias("value")))
    ticker = F.col("l_suppkey").cast("string")
    body = F.to_json(F.struct(
        _company_name(F.col("doc_id")).alias("entityName"),
        F.create_map(F.lit(S.TAXONOMY), F.map_from_entries(entries)).alias("facts")))
    return per_doc.select(
        F.concat(ticker, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_name"),
        ticker.alias("ticker"), F.col("doc_id"), F.explode(F.array(body)).alias("body"))


def damaged_filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filing documents, some of them damaged on their way: cut in half, without any
    field, without facts, or without text, by the company's number."""
    key = F.col("ticker").cast("bigint")
    body = (F.when(key % 10 == 1, F.left("body", F.expr("length(body) div 2")))
            .when(key % 10 == 2, F.lit("{}"))
            .when(key % 10 == 3, F.to_json(F.struct(F.concat(F.lit("Company "), F.col("ticker")).alias("entityName"))))
            .when(key % 10 == 4, F.lit("")).otherwise(F.col("body")))
    return filing_documents(spark, sf_dir).withColumn("body", body)
