"""Run the job: ``python -m orderloom --order-files … --change-files … --base …``."""

from __future__ import annotations

import argparse
import os

from orderloom.operators.windows import DEFAULT_WINDOW_MINUTES
from orderloom.session import get_spark
from orderloom.streaming.pipeline import Job, run_available, start_all


def parse(args: list[str] | None = None) -> tuple[Job, bool]:
    parser = argparse.ArgumentParser(prog="orderloom", description=__doc__)
    parser.add_argument("--order-files", required=True, help="folder of CSV files or zip archives")
    parser.add_argument("--change-files", required=True, help="folder of product change rows (Parquet)")
    parser.add_argument("--base", required=True, help="shared folder for logs and checkpoints")
    parser.add_argument("--snapshot", help="folder of product rows before the first change (Parquet)")
    parser.add_argument("--spread", type=int, help="state groups per product (by measured heat)")
    parser.add_argument("--chunks", help="folder of a snapshot read in chunks, with log positions (Parquet)")
    parser.add_argument("--archive", help="folder that order files move to once they are read, or 'delete'")
    parser.add_argument("--max-files", type=int, help="files taken per trigger (all)")
    parser.add_argument("--zipped", action="store_true", help="order files are zip archives")
    parser.add_argument(
        "--window-minutes",
        type=int,
        default=int(os.environ.get("WINDOW_MINUTES", DEFAULT_WINDOW_MINUTES)),
    )
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    given = vars(parser.parse_args(args))
    once = given.pop("once")
    return Job(**given), once


def main(args: list[str] | None = None) -> None:
    job, once = parse(args)
    spark = get_spark()
    if once:
        run_available(spark, job)
    else:
        start_all(spark, job)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
