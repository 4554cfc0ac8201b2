"""Command line: `python -m ledgerlake <job> ...` (or through `spark-submit`).

One subcommand per composite job, plus `daily` for the ordered run. The session is
whatever `spark-submit` / the cluster provides; only unset engine defaults are filled.
Paths are any Hadoop file system URIs.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import quality
from ledgerlake.plans import jobs
from ledgerlake.session import apply_defaults, input_bytes, size_shuffles


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("company-etl", help="G1: company CSV -> cleaned metrics Parquet")
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("company-etl-normalised", help="G2: normalised-header variant -> CSV")
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("extract-facts", help="G3: filing JSON -> key-metric JSON Lines")
    s.add_argument("--filings", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("load-raw", help="G4: load the three raw tables (full refresh)")
    s.add_argument("--csv", required=True)
    s.add_argument("--api", required=True)
    s.add_argument("--facts", required=True,
                   help="key-metric documents: files of one each, or what extract-facts wrote")
    s.add_argument("--lenient", action="store_true", help="skip corrupt documents instead of failing")

    s = sub.add_parser("build-mart", help="G5: staging views and the mart")
    s.add_argument("--out", default=None)

    s = sub.add_parser("publish", help="G6: raw and curated zones, then the inventory")
    s.add_argument("--lake", required=True)
    s.add_argument("--csv", required=True)
    s.add_argument("--api", required=True)
    s.add_argument("--filings", required=True)
    s.add_argument("--curated-financials", default=None)

    s = sub.add_parser("daily", help="all jobs in dependency order")
    s.add_argument("--lake", required=True)
    s.add_argument("--csv", required=True)
    s.add_argument("--api", required=True)
    s.add_argument("--filings", required=True)
    return p


def _rows(df) -> list[dict]:
    """All rows of a report whose size does not depend on the data (a row per table)."""
    return [r.asDict(recursive=True) for r in df.collect()]


def _sample(df, n: int = 20) -> dict:
    """A report that grows with its groups: its row count, and named as such a sample."""
    return {"rows": df.count(), "sample": [r.asDict(recursive=True) for r in df.limit(n).collect()]}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = apply_defaults(spark or SparkSession.builder.appName("ledgerlake").getOrCreate())
    paths = [getattr(args, k, None) for k in ("csv", "api", "filings", "facts")]
    size_shuffles(spark, input_bytes(spark, *[p for p in paths if p]))
    out: dict = {"job": args.job}
    if args.job == "company-etl":
        summary, counts = jobs.company_etl(spark, args.csv, args.out)
        out.update(counts=counts, sector_summary=_sample(summary))
    elif args.job == "company-etl-normalised":
        out.update(counts=jobs.company_etl_normalised(spark, args.csv, args.out))
    elif args.job == "extract-facts":
        cov = jobs.facts_extraction(spark, args.filings, args.out)
        out.update(coverage=_rows(cov.agg(
            F.countDistinct("ticker").alias("documents"),
            F.count_if("missing").alias("missing_metric_pairs"),
            F.sum("records_found").alias("records_kept"))))
    elif args.job == "load-raw":
        out.update(tables=_rows(jobs.raw_table_load(spark, args.csv, args.api, args.facts,
                                                    strict=not args.lenient)))
    elif args.job == "build-mart":
        m = jobs.build_mart(spark, args.out)
        out.update(written=args.out, columns=m.columns)
    elif args.job == "publish":
        inv = jobs.lake_publish(spark, jobs.Lake(args.lake), args.csv, args.api, args.filings,
                                args.curated_financials)
        out.update(totals=_rows(quality.lake_totals(inv)))
    elif args.job == "daily":
        res = jobs.daily_refresh(spark, jobs.Lake(args.lake), args.csv, args.api, args.filings)
        out.update(tables=_rows(res["table_counts"]), clean_counts=_rows(res["clean_counts"]),
                   totals=_rows(quality.lake_totals(res["inventory"])))
    return out


if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1:]), default=str, indent=2))
