"""Loads by change equal full loads and parse only what is new."""

import json
import os

from pyspark.sql import functions as F

from fixtures import write_statements
from ledgerlake import schemas as S
from ledgerlake.operators import nested
from ledgerlake.plans import jobs
from ledgerlake.sinks import files as sinks

NAME = "delta_statements"


def drop(spark):
    for t in spark.catalog.listTables():
        if t.name.startswith(NAME):
            spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS {t.name}")


def statement(ticker, years):
    return json.dumps({"symbol": ticker, "annualReports": [
        {"fiscalDateEnding": f"{y}-12-31", "totalRevenue": str(y), "extra": ticker} for y in years]})


def test_only_changed_documents_are_parsed(spark, tmp_path):
    drop(spark)
    api, landed = write_statements(str(tmp_path / "api")), str(tmp_path / "landed")

    def land():
        sinks.land_documents(spark, api, "*.json", "api", landed, mode="overwrite")
        return jobs.load_landed_statements(spark, landed, NAME)

    def same_as_full():
        docs = spark.read.parquet(landed).where(F.col("file_name").endswith(S.STATEMENT_KINDS["income_statement"]))
        full = nested.explode_statements(nested.parse_documents(docs, S.STATEMENT_DOC), S.INCOME_REPORT_FIELDS, others=True)
        got = spark.table(NAME).select(*full.columns)
        return sorted(map(str, got.collect())) == sorted(map(str, full.collect())) and got.count() > 0

    suffix = S.STATEMENT_KINDS["income_statement"].lstrip("*")
    first = land()
    assert first["parsed"] > 1 and first["gone"] == 0 and same_as_full()
    versions = len(sinks._versions(spark, NAME))
    assert land() == {"parsed": 0, "gone": 0} and same_as_full()
    assert len(sinks._versions(spark, NAME)) == versions  # equal bytes: nothing written

    new = os.path.join(api, "NEW" + (suffix if suffix.startswith("_") else "_" + suffix))
    with open(new, "w") as f:
        f.write(statement("NEW", [2020, 2021]))
    assert land() == {"parsed": 1, "gone": 0} and same_as_full()
    with open(new, "w") as f:
        f.write(statement("NEW", [2021, 2022, 2023]))
    assert land() == {"parsed": 1, "gone": 1} and same_as_full()
    assert spark.table(NAME).where("ticker = 'NEW'").count() == 3
    os.makedirs(os.path.join(api, "again"))
    with open(os.path.join(api, "again", os.path.basename(new)), "w") as f:  # same name, same bytes
        f.write(statement("NEW", [2021, 2022, 2023]))
    assert land() == {"parsed": 2, "gone": 1} and same_as_full()
    assert spark.table(NAME).where("ticker = 'NEW'").count() == 6
    os.remove(new)
    assert land() == {"parsed": 1, "gone": 2} and same_as_full()

    # A load that ended between its two writes parses its document once more.
    spark.sql(f"CREATE OR REPLACE VIEW {NAME}__documents AS SELECT * FROM {NAME}__documents__v1 WHERE false")
    again = land()
    assert again["parsed"] > 1 and same_as_full()
    drop(spark)
