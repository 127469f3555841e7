"""Command line: ``python -m meterlake --csv DIR --target DIR [--table DB.NAME]``."""

from __future__ import annotations

import argparse

from meterlake.plans.load import load
from meterlake.session import build_session


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="meterlake", description="Load meter readings.")
    parser.add_argument("--csv", help="folder of raw CSV files")
    parser.add_argument("--parquet", help="folder of raw Parquet files, used first if it exists")
    parser.add_argument("--target", required=True, help="folder of the processed table")
    parser.add_argument("--table", help="catalog table to keep in step")
    parser.add_argument("--rebuild", action="store_true", help="replace the whole table")
    parser.add_argument("--extracts", help="folder for the materialised views")
    parser.add_argument("--lag-mode", choices=("elapsed", "boundary"), default="elapsed")
    parser.add_argument("--input-bytes", type=int, help="size of the delivery, to size splits and shuffles")
    args = vars(parser.parse_args(argv))
    spark = build_session(input_bytes=args.pop("input_bytes"))
    load(spark, **args).show(truncate=False)


if __name__ == "__main__":
    main()
