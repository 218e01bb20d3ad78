"""Command for spark-submit: register new files, then load what is pending."""

from __future__ import annotations

import argparse
import logging
from datetime import date

from tollbook import schemas as S
from tollbook.plans.batch import SUMMARY_MODES, BatchOptions, merge_months, run_all, run_batch
from tollbook.plans.registry import Manifest
from tollbook.session import build_session
from tollbook.sinks.store import TableStore
from tollbook.sources.files import list_files


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument("--input", help="folder to look for new files in before loading")
    parser.add_argument("--pattern", default="*.csv")
    parser.add_argument("--job-name", default=S.DEFAULT_JOB)
    parser.add_argument("--files", type=int, default=S.DEFAULT_CLAIM_SIZE, help="files claimed per batch")
    parser.add_argument("--all", action="store_true", help="run batches until nothing is pending")
    parser.add_argument("--same-header", action="store_true")
    parser.add_argument("--keep-staged", action="store_true", help="load records again that were staged before")
    parser.add_argument("--requeue", action="store_true", help="put failed files back to work first")
    parser.add_argument("--compact", action="store_true", help="compact the manifest first")
    parser.add_argument("--merge-months-before", type=date.fromisoformat, help="bring each earlier month of the fact into one version first")
    parser.add_argument("--salt-buckets", type=int)
    parser.add_argument("--summary-mode", choices=SUMMARY_MODES, default="accumulate")
    parser.add_argument("--processed-files", type=int)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse_arguments(arguments)
    spark = build_session()
    store = TableStore(spark, args.root)
    options = BatchOptions(
        job_name=args.job_name,
        files=args.files,
        same_header=args.same_header,
        skip_staged=not args.keep_staged,
        salt_buckets=args.salt_buckets,
        summary_mode=args.summary_mode,
        processed_files=args.processed_files,
    )
    if args.requeue:
        Manifest(store, args.job_name).requeue()
    if args.compact:
        Manifest(store, args.job_name).compact()
    if args.merge_months_before:
        merge_months(store, Manifest(store, args.job_name), args.merge_months_before)
    if args.input:
        Manifest(store, args.job_name).register(list_files(spark, args.input, args.pattern))
    (run_all if args.all else run_batch)(spark, store, options)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
