"""``python -m tabclean TABLE RAW CURATED [--reports DIR] [--rel-err X] [--on-bad-value null]``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import TABLES, run_table


def main() -> None:
    parser = argparse.ArgumentParser(prog="tabclean")
    parser.add_argument("table", choices=sorted(TABLES))
    parser.add_argument("raw", help="CSV file or folder")
    parser.add_argument("curated", help="Parquet folder to replace")
    parser.add_argument("--reports", help="folder for the profile and the listings")
    parser.add_argument("--rel-err", type=float, default=0.01, help="rank error of quartiles")
    parser.add_argument("--on-bad-value", choices=("error", "null"), default="error")
    parser.add_argument(
        "--multiline",
        action=argparse.BooleanOptionalAction,
        default=None,
        help="whether quoted fields hold line breaks; if so each file is one task (default: by table)",
    )
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"tabclean {args.table}").getOrCreate()
    run_table(
        spark,
        TABLES[args.table],
        args.raw,
        args.curated,
        reports=args.reports,
        rel_err=args.rel_err,
        on_bad_value=args.on_bad_value,
        multiline=args.multiline,
    )


if __name__ == "__main__":
    main()
