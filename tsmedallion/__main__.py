"""The daily run from a command line or ``spark-submit``."""

from __future__ import annotations

import argparse
import json
import sys
import traceback
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tsmedallion.plans.daily import DailyRun, run_daily, run_versions
from tsmedallion.schemas import CATALOGUE, DEFAULT_OBSERVATION_START
from tsmedallion.session import SESSION_CONF
from tsmedallion.sources.tables import LAYOUTS


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tsmedallion", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder of landed JSON documents")
    parser.add_argument("--lake", required=True, help="folder of bronze, silver and gold")
    parser.add_argument("--ingest-date", required=True, help="run date, YYYY-MM-DD")
    parser.add_argument("--observation-start", default=DEFAULT_OBSERVATION_START)
    parser.add_argument("--vintages", choices=("current", "all"), default="current")
    parser.add_argument("--layout", choices=LAYOUTS, default="folders")
    parser.add_argument("--json-lines", action="store_true", help="one document per line")
    parser.add_argument("--versions", action="store_true", help="publish a version of gold instead of rebuilding it")
    parser.add_argument(
        "--max-bad-share", type=float, help="share of unreadable documents to quarantine; none by default"
    )
    parser.add_argument("--catalogue", help="parquet of the expected series")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Exit code 0 when every data test passed, else 1 with the error printed.

    The master and all sizes come from the submitting side.
    """
    args = _arguments(argv)
    builder = SparkSession.builder.appName("tsmedallion")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        catalogue = None
        if args.catalogue:
            catalogue = spark.read.schema(CATALOGUE).parquet(args.catalogue)
        run = DailyRun(
            landing=args.landing,
            lake=args.lake,
            ingest_date=args.ingest_date,
            run_at=datetime.now(timezone.utc),
            observation_start=args.observation_start,
            vintages=args.vintages,
            layout=args.layout,
            multi_line=not args.json_lines,
            catalogue=catalogue,
            max_bad_share=args.max_bad_share,
        )
        print(json.dumps(run_versions(spark, run) if args.versions else run_daily(spark, run)))
        return 0
    except Exception:
        traceback.print_exc()
        return 1


if __name__ == "__main__":
    sys.exit(main())
