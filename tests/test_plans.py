"""Plan shape: no Python UDFs, pruned scans, partial aggregation, top-k limit."""

import pytest

from conftest import SF0001
from ledgerlake.operators import quality
from ledgerlake.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    p = plan(QUERIES[name](spark, SF0001))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in p, (name, bad)


def test_topk_uses_group_limit(spark):
    p = plan(QUERIES["facts_top5"](spark, SF0001))
    assert "WindowGroupLimit" in p


def test_pivot_is_one_aggregate(spark):
    p = plan(QUERIES["stg_sec_facts"](spark, SF0001))
    assert p.count("HashAggregate") == 2                     # partial + final, no pivotfirst
    assert "pivotfirst" not in p.lower()


def test_scans_are_pruned(spark):
    p = plan(QUERIES["mart_financials"](spark, SF0001))
    assert "l_comment" not in p and "o_orderkey" not in p
    assert "l_shipmode" not in p
    inv = plan(quality.lake_files(spark, SF0001, "*.parquet"))
    assert "ReadSchema: struct<path:string,length:bigint>" in inv   # file bytes never read


def test_no_cartesian_products(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SF0001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def _scan_widths(p: str):
    """(table file, number of columns read) for every Parquet scan in a plan string."""
    import re
    out = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: [^\[]*\[([^\]]*)\]", p):
        cols, loc = m.group(1), m.group(2)
        out.append((loc.rsplit("/", 1)[-1], len([c for c in cols.split(",") if c.strip()])))
    return out


def test_every_scan_reads_a_column_subset(spark):
    full = {t: len(spark.read.parquet(f"{SF0001}/{t}.parquet").columns)
            for t in ("lineitem", "part", "events")}
    seen = 0
    for name, q in QUERIES.items():
        for table_file, width in _scan_widths(plan(q(spark, SF0001))):
            t = table_file.replace(".parquet", "")
            if t in full:
                seen += 1
                assert width < full[t], (name, t, width)
    assert seen > 30


def test_statement_unions_scan_once(spark):
    for name in ("statements_union", "statements_union_docs"):
        assert plan(QUERIES[name](spark, SF0001)).count("FileScan") == 1, name


def test_distinct_periods_are_cut_before_the_shuffle(spark):
    p = plan(QUERIES["facts_top5_distinct_period"](spark, SF0001))
    assert "SortAggregate" not in p and p.count("Exchange") == 1
    assert "dense_rank" in p and "WindowGroupLimit" in p


def test_filings_are_parsed_for_the_wanted_metrics_only(spark):
    p = QUERIES["facts_top5_array"](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert "us-gaap" in p and "EarningsPerShareBasic" not in p.split("from_json")[-1][:400]
