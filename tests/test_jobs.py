"""Composite jobs G1-G6 and sinks K1-K12 on temporary folders."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from fixtures import write_company_csv, write_filings, write_statements
from ledgerlake import schemas as S
from ledgerlake.operators import mart, quality
from ledgerlake.plans import jobs
from ledgerlake.sinks import files as sinks
from ledgerlake.sources import files as sources


def drop_raw(spark):
    for t in jobs.RAW_TABLES:
        spark.sql(f"DROP VIEW IF EXISTS {t}")


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    csv = write_company_csv(str(base / "company"))
    api = write_statements(str(base / "api"))
    sec = write_filings(str(base / "sec_full"))
    return {"base": base, "csv": csv, "api": api, "sec_full": sec}


def test_g1_company_etl(spark, inputs, tmp_path):
    out = str(tmp_path / "financials_transformed")
    summary, counts = jobs.company_etl(spark, inputs["csv"], out)
    assert counts == {"rows_in": 13, "rows_out": 7, "columns": 14}
    assert summary.collect()[0].sector == "Tech"
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) >= 1
    assert os.path.exists(os.path.join(out, "_SUCCESS"))


def test_g2_normalised_variant(spark, inputs, tmp_path):
    out = str(tmp_path / "pandas_variant")
    counts = jobs.company_etl_normalised(spark, inputs["csv"], out)
    assert counts["rows"] == 8                               # DDD kept: price not required
    back = spark.read.option("header", True).csv(out)
    assert "52_week_low" in back.columns and "ebitda_to_market_cap" in back.columns


def test_g3_to_g5(spark, inputs, tmp_path):
    sec_dir = str(tmp_path / "facts")
    cov = jobs.facts_extraction(spark, inputs["sec_full"], sec_dir)
    assert cov.filter("missing").count() == 1 + 6 + 6        # AAA op. income, BBB, CCC
    km = spark.read.json(sec_dir)                            # JSON Lines, ticker inside
    assert sorted(r.ticker for r in km.select("ticker").collect()) == ["AAA", "BBB", "CCC"]
    drop_raw(spark)
    counts = {r.table_name: (r.row_count, r.present) for r in
              jobs.raw_table_load(spark, inputs["csv"], inputs["api"], sec_dir).collect()}
    assert counts["raw_financials"] == (13, True)
    assert counts["raw_income_statements"] == (9, True)
    assert counts["raw_sec_facts"] == (9, True)              # 5 + 2 + 2 facts of AAA
    m = jobs.build_mart(spark, str(tmp_path / "mart"))
    rows = m.collect()
    assert len(rows) == 8                                    # 4 positive-revenue AAA rows x 2 companies
    a23 = [r for r in rows if r.fiscal_year == 2023]
    assert {r.net_profit_margin_pct for r in a23} == {12.5}
    assert {r.total_assets for r in a23} == {5000}
    sinks.register_external(spark, "mart_files", str(tmp_path / "mart"))
    assert spark.table("mart_files").count() == 8


def test_g4_missing_source_reported(spark, inputs, tmp_path):
    drop_raw(spark)
    counts = {r.table_name: r.present for r in jobs.raw_table_load(
        spark, inputs["csv"], inputs["api"], str(tmp_path / "absent")).collect()}
    assert counts["raw_sec_facts"] is False and counts["raw_financials"] is True


def test_g6_lake_publish(spark, inputs, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    curated = str(tmp_path / "curated_src")
    jobs.company_etl(spark, inputs["csv"], curated)
    inv = jobs.lake_publish(spark, lake, inputs["csv"], inputs["api"], inputs["sec_full"],
                            curated_financials=curated)
    paths = [r.path for r in inv.collect()]
    assert any("/raw/company/" in p for p in paths)
    assert any("/raw/landed/source=api/" in p for p in paths)
    assert any("/curated/financials/" in p for p in paths)
    landed = sources.read_landed(spark, lake.landed, "api", S.STATEMENT_DOC)
    assert landed.count() == 7


def test_k4_jdbc_embedded(spark, inputs):
    url = "jdbc:derby:memory:ledgerlake;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"n{i}") for i in range(1200)], "id int, name string")
    try:
        sinks.write_jdbc(df, url, "raw_t", props, batchsize=500)
    except Exception as e:  # pragma: no cover - driver class not on this classpath
        pytest.skip(f"embedded Derby unavailable: {type(e).__name__}")
    back = sources.read_jdbc(spark, url, "raw_t", props, "id", 0, 1200, 4)
    assert back.count() == 1200
    own_bounds = sources.read_jdbc(spark, url, "raw_t", props, "id", num_partitions=4)
    assert own_bounds.count() == 1200 and own_bounds.rdd.getNumPartitions() == 4
    # a view in the database over the table survives a second full refresh
    jvm = spark.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(url)
    conn.createStatement().execute(
        'CREATE VIEW raw_t_small AS SELECT "id" FROM raw_t WHERE "id" < 10')
    sinks.write_jdbc(df.filter("id < 100"), url, "raw_t", props)
    rs = conn.createStatement().executeQuery("SELECT COUNT(*) FROM raw_t_small")
    rs.next()
    assert rs.getInt(1) == 10
    conn.close()
    assert sources.read_jdbc(spark, url, "raw_t", props).count() == 100


def test_s11_empty_result_leaves_target(spark, tmp_path):
    target = str(tmp_path / "t")
    empty = spark.createDataFrame([], "a int")
    assert sinks.write_if_rows(empty, lambda d: sinks.write_parquet(d, target)) is False
    assert not os.path.exists(target)


def test_s2_profile_and_s9_table(spark, inputs):
    prof = sources.profile_csv(spark, inputs["csv"])
    assert prof["rows"] == 13 and len(prof["columns"]) == 14 and len(prof["sample"]) == 2
    assert prof["types"]["Market Cap"] in ("double", "string")
    sinks.register_views({"company_raw_view": sources.read_company_csv(spark, inputs["csv"])})
    assert sources.read_table(spark, "company_raw_view").count() == 13
    assert sources.has_rows(sources.read_table(spark, "company_raw_view"))


def test_k6_raw_company_export(spark, inputs, tmp_path):
    drop_raw(spark)
    jobs.raw_table_load(spark, inputs["csv"], inputs["api"], str(tmp_path / "none"))
    lake = jobs.Lake(str(tmp_path / "lake2"))
    jobs.lake_publish(spark, lake, inputs["csv"], inputs["api"], inputs["sec_full"])
    back = spark.read.option("header", True).csv(lake.curated("financials_csv"))
    assert back.count() == 13 and "price_per_earnings" in back.columns


def test_daily_refresh_order(spark, inputs, tmp_path):
    drop_raw(spark)
    lake = jobs.Lake(str(tmp_path / "daily"))
    out = jobs.daily_refresh(spark, lake, inputs["csv"], inputs["api"], inputs["sec_full"])
    counts = {r.table_name: r.row_count for r in out["table_counts"].collect()}
    assert counts == {"raw_financials": 13, "raw_income_statements": 9, "raw_sec_facts": 9}
    assert out["mart"].count() == 8
    paths = [r.path for r in out["inventory"].collect()]
    assert any("/curated/mart_financials/" in p for p in paths)
    assert any("/curated/financials/" in p for p in paths)
    assert out["clean_counts"].collect()[0].rows_out == 7


def test_swap_refresh_keeps_old_version(spark):
    first = spark.createDataFrame([(1,), (2,)], "a int")
    t1 = sinks.swap_refresh(spark, first, "refresh_demo")
    held = spark.table("refresh_demo")                       # a reader of version 1
    t2 = sinks.swap_refresh(spark, spark.createDataFrame([(3,)], "a int"), "refresh_demo")
    assert (t1, t2) == ("refresh_demo__v1", "refresh_demo__v2")
    assert [r.a for r in spark.table("refresh_demo").collect()] == [3]
    assert sorted(r.a for r in spark.table(t1).collect()) == [1, 2]
    assert held.count() in (1, 2)                            # never fails mid-swap


def test_concurrent_refreshes_get_versions_of_their_own(spark):
    from concurrent.futures import ThreadPoolExecutor

    frames = [spark.range(i * 100, i * 100 + 10).withColumnRenamed("id", "a") for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda f: sinks.swap_refresh(spark, f, "refresh_many"), frames))
    assert sorted(tables) == [f"refresh_many__v{v}" for v in range(1, 5)]
    for table, frame in zip(tables, frames):
        assert sorted(r.a for r in spark.table(table).collect()) == sorted(r.a for r in frame.collect())
    newest = frames[tables.index("refresh_many__v4")]
    assert sorted(r.a for r in spark.table("refresh_many").collect()) == sorted(r.a for r in newest.collect())


def test_old_versions_are_dropped_after_readers_are_done(spark):
    one = spark.createDataFrame([(1,)], "a int")
    for _ in range(4):
        sinks.swap_refresh(spark, one, "refresh_kept")
    held = spark.table("refresh_kept__v2")
    assert sinks.drop_old_versions(spark, "refresh_kept", keep=2) == []           # too young: may be read
    assert held.count() == 1
    assert sinks.drop_old_versions(spark, "refresh_kept", keep=2, min_age_seconds=0) == ["refresh_kept__v2", "refresh_kept__v1"]
    assert sinks.swap_refresh(spark, one, "refresh_kept", keep=1, min_age_seconds=0) == "refresh_kept__v5"
    left = {t.name for t in spark.catalog.listTables() if t.name.startswith("refresh_kept")}
    assert left == {"refresh_kept", "refresh_kept__v5"} and spark.table("refresh_kept").count() == 1


def test_jdbc_reads_of_a_skewed_key_are_balanced(spark):
    url = "jdbc:derby:memory:ledgerlake_skew;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    keys = spark.range(4000).select(F.when(F.col("id") % 97 != 0, F.pow(F.col("id"), F.lit(3)).cast("long")).alias("k"),
                                    F.col("id").alias("v"))
    sinks.write_jdbc(keys, url, "skewed", props)
    df = sources.read_jdbc_balanced(spark, url, "skewed", "k", 8, props)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert sorted(r.v for r in df.select("v").collect()) == list(range(4000))
    even = sources.read_jdbc(spark, url, "skewed", props, "k", num_partitions=8)
    worst = max(r["count"] for r in even.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert worst > 2 * 4000 / 8                                                   # what equal ranges give
    sinks.write_jdbc(keys.limit(0), url, "empty_skewed", props)
    assert sources.read_jdbc_balanced(spark, url, "empty_skewed", "k", 8, props).count() == 0


def test_mart_checkpoint_cuts_lineage(spark, inputs, tmp_path):
    drop_raw(spark)
    km_dir = str(tmp_path / "km")
    jobs.facts_extraction(spark, inputs["sec_full"], km_dir)
    jobs.raw_table_load(spark, inputs["csv"], inputs["api"], km_dir)
    m = jobs.build_mart(spark, checkpoint=True)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Join" not in plan      # reads the checkpoint, no recompute
    assert m.count() == 8


def test_g3_from_landed_raw_zone(spark, inputs, tmp_path):
    import json

    landed = str(tmp_path / "landed")
    sinks.land_documents(spark, inputs["sec_full"], "*.json", "sec", landed, mode="overwrite")
    a_dir, b_dir = str(tmp_path / "from_landed"), str(tmp_path / "direct")
    cov_a = jobs.facts_extraction_from_landed(spark, landed, a_dir)
    cov_b = jobs.facts_extraction(spark, inputs["sec_full"], b_dir)
    assert sorted(map(tuple, cov_a.collect())) == sorted(map(tuple, cov_b.collect()))

    def docs(d):
        rows = sources.read_key_metrics(spark, d).collect()
        return sorted(json.dumps(r.km.asDict(recursive=True), sort_keys=True) for r in rows)
    assert docs(a_dir) == docs(b_dir)


def test_command_line_daily(spark, inputs, tmp_path):
    from ledgerlake.__main__ import main

    drop_raw(spark)
    out = main(["daily", "--lake", str(tmp_path / "cli_lake"), "--csv", inputs["csv"],
                "--api", inputs["api"], "--filings", inputs["sec_full"]], spark=spark)
    tables = {r["table_name"]: r["row_count"] for r in out["tables"]}
    assert tables == {"raw_financials": 13, "raw_income_statements": 9, "raw_sec_facts": 9}
    assert out["totals"][0]["total_files"] > 5
    etl = main(["company-etl", "--csv", inputs["csv"], "--out", str(tmp_path / "etl")], spark=spark)
    assert etl["counts"]["rows_out"] == 7 and etl["sector_summary"]["sample"][0]["sector"] == "Tech"
    assert etl["sector_summary"]["rows"] >= 1
    ex = main(["extract-facts", "--filings", inputs["sec_full"], "--out", str(tmp_path / "kx")],
              spark=spark)
    assert ex["coverage"][0] == {"documents": 3, "missing_metric_pairs": 13, "records_kept": 9}


def test_relanding_one_source_keeps_the_others(spark, inputs, tmp_path):
    landed = str(tmp_path / "landed_multi")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        sinks.land_documents(spark, inputs["api"], "*.json", "api", landed, mode="overwrite")
        sinks.land_documents(spark, inputs["sec_full"], "*.json", "sec", landed, mode="append")
        sinks.land_documents(spark, inputs["api"], "*.json", "api", landed, mode="overwrite")
    finally:
        spark.conf.set(key, before)
    counts = {r.source: r["count"] for r in spark.read.parquet(landed).groupBy("source").count().collect()}
    assert counts == {"api": 7, "sec": 4}


def test_full_refresh_removes_stale_partitions(spark, tmp_path):
    target = str(tmp_path / "by_year")
    old = spark.createDataFrame([(2021, 1), (2022, 2)], "fiscal_year int, v int")
    sinks.write_parquet(old, target, partition_by=["fiscal_year"])
    new = spark.createDataFrame([(2022, 3)], "fiscal_year int, v int")
    sinks.write_parquet(new, target, partition_by=["fiscal_year"])
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(3, 2022)]
    sinks.write_parquet(old.filter("fiscal_year = 2021"), target, partition_by=["fiscal_year"],
                        replace_partitions_only=True)
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, 2021), (3, 2022)]


def test_land_raw_is_idempotent(spark, inputs, tmp_path):
    lake = jobs.Lake(str(tmp_path / "twice"))
    for _ in range(2):
        jobs.land_raw(spark, lake, inputs["csv"], inputs["api"], inputs["sec_full"])
    counts = {r.source: r["count"] for r in
              spark.read.parquet(lake.landed).groupBy("source").count().collect()}
    assert counts == {"api": 7, "sec": 4}
    assert sources.read_company_csv(spark, lake.raw("company")).count() == 13


def test_readme_library_example_runs(spark, inputs, tmp_path):
    from fixtures import write_filings as wf

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    text = open(os.path.join(root, "README.md")).read()
    code = text.split("## Library use")[1].split("```python")[1].split("```")[0]
    company = os.path.dirname(inputs["csv"])
    filings = wf(str(tmp_path / "filings"))
    code = (code.replace("hdfs:///data/raw/company/", company)
                .replace("hdfs:///data/raw/filings/", filings)
                .replace("hdfs:///data/raw/api/", inputs["api"])
                .replace(".show()", ".collect()"))
    ns = {"spark": spark}
    exec(code, ns)  # noqa: S102 - the documented example itself
    assert ns["the_mart"].count() == 8


def test_mart_columns_and_order_survive_the_write(spark, inputs, tmp_path):
    drop_raw(spark)
    lake = jobs.Lake(str(tmp_path / "ordered"))
    m = jobs.daily_refresh(spark, lake, inputs["csv"], inputs["api"], inputs["sec_full"])["mart"]
    assert m.columns == mart.MART_COLUMNS
    assert spark.table("mart_financials").columns == mart.MART_COLUMNS
    out = lake.curated("mart_financials")
    parts = sorted(f for f in os.listdir(out) if f.endswith(".csv"))
    lines = []
    for f in parts:
        with open(os.path.join(out, f), newline="") as h:
            header, *rows = csv.reader(h)
        assert header == mart.MART_COLUMNS
        lines += rows
    keys = [(r[0], -int(r[3]) if r[3] else float("-inf")) for r in lines]  # a missing year comes first
    assert len(keys) == 8 and keys == sorted(keys)
    assert not os.path.exists(os.path.join(lake.root, "curated", "financials_parquet"))  # one copy


def test_partitioned_write_makes_few_files(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 3 as fiscal_year", "id").repartition(16)
    sinks.write_parquet(df, str(tmp_path / "few"), partition_by=["fiscal_year"])
    for d in os.listdir(tmp_path / "few"):
        if "=" in d:
            assert len([f for f in os.listdir(tmp_path / "few" / d) if f.endswith(".parquet")]) == 1


def test_corrupt_documents_are_counted_or_fail(spark, inputs, tmp_path):
    api = write_statements(str(tmp_path / "api"))
    with open(os.path.join(api, "BAD_income_statement.json"), "w") as f:
        f.write('{"symbol": "BAD", "annualReports": [{"fiscalDateEnding": "2023-12-31", "totalRe')
    docs = sources.read_statements(spark, api)
    assert {r.status: r["count"] for r in docs.groupBy("status").count().collect()}["corrupt"] == 1
    drop_raw(spark)
    with pytest.raises(Exception, match="corrupt document"):
        jobs.raw_table_load(spark, inputs["csv"], api, str(tmp_path / "none"))
    counts = {r.table_name: r.row_count for r in jobs.raw_table_load(
        spark, inputs["csv"], api, str(tmp_path / "none"), strict=False).collect()}
    assert counts["raw_income_statements"] == 9
    sec = write_filings(str(tmp_path / "sec"))
    with open(os.path.join(sec, "EEE.json"), "w") as f:
        f.write('{"entityName": "Eps", "facts": {"us-gaap": {')
    rejects = {r.status: r.n_documents for r in
               quality.document_rejects(sources.read_filings(spark, sec)).collect()}
    assert rejects == {"ok": 2, "without_facts": 1, "empty": 1, "corrupt": 1}


def test_statements_keep_every_key(spark, inputs):
    drop_raw(spark)
    jobs.raw_table_load(spark, inputs["csv"], inputs["api"], inputs["sec_full"])
    assert "other_fields" in spark.table("raw_income_statements").columns


def test_counts_are_those_of_the_target(spark, inputs, tmp_path):
    """A writer that writes nothing must not be credited with an older catalog table."""
    drop_raw(spark)
    jobs.raw_table_load(spark, inputs["csv"], inputs["api"], str(tmp_path / "none"))
    report = jobs.raw_table_load(spark, inputs["csv"], inputs["api"], str(tmp_path / "none"),
                                 write=lambda df, name: None, read=lambda name: None)
    assert not any(r.present for r in report.collect())
    with pytest.raises(ValueError):
        jobs.raw_table_load(spark, inputs["csv"], inputs["api"], "x", write=lambda df, name: None)


def test_register_external_refuses_managed_tables(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS keep_me")
    spark.range(5).write.saveAsTable("keep_me")
    spark.range(2).write.parquet(str(tmp_path / "ext"))
    with pytest.raises(ValueError, match="refusing"):
        sinks.register_external(spark, "keep_me", str(tmp_path / "ext"))
    assert spark.table("keep_me").count() == 5
    for _ in range(2):
        assert sinks.register_external(spark, "ext_t", str(tmp_path / "ext")).count() == 2


def test_company_lines_parse_like_the_file(spark, inputs):
    path = inputs["csv"]
    lines = spark.read.text(path).filter("value not like 'Symbol,%'")
    from_lines = sorted(map(str, sources.company_lines(lines).collect()))
    assert from_lines == sorted(map(str, sources.read_company_csv(spark, path).collect()))
