"""Runs jobs over a range of dates: ``spark-submit tallyboard/run_jobs.py`` or ``python -m tallyboard.run_jobs``.

The inputs are Parquet tables of the package's schemas below one folder: events, users, and where the tasks
need them membership, departments, user_dep and files. ``--dimensions`` rebuilds user_dep and files first, from
edges, files_current and files_legacy. A run with a name can be started again after it broke, with the same
arguments: dimensions and reports that it has stored are kept.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession

from tallyboard import schemas
from tallyboard.plans import jobs
from tallyboard.plans.journal import Journal
from tallyboard.plans.model import Workspace
from tallyboard.sources.readers import read_parquet
from tallyboard.sources.store import Store

TABLES = {"events": schemas.STORED_EVENT, "users": schemas.USERS, "membership": schemas.MEMBERSHIP,
          "departments": schemas.DEPARTMENTS, "user_dep": schemas.USER_DEP, "files": schemas.FILES}


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="run_jobs", description="Compute daily reports over a range of dates.")
    parser.add_argument("--input", required=True, help="folder of the input tables")
    parser.add_argument("--store", required=True, help="folder of roll-ups and results")
    parser.add_argument("--start", required=True, help="first report date, YYYY-MM-DD")
    parser.add_argument("--end", help="last report date; the first one by default")
    parser.add_argument("--tasks", type=lambda t: [x for x in t.split(",") if x], help="comma-separated; all by default")
    parser.add_argument("--run", help="name of the run, to go on with it after a break")
    for flag, what in (("dimensions", "rebuild user_dep and files first"), ("day-by-day", "one date after the other"),
                       ("refresh", "roll up all days again"), ("carry-spaces", "carry the last act per space"),
                       ("carry-masks", "carry active-day masks"), ("catch-up", "redo stored reports after late rows")):
        parser.add_argument(f"--{flag}", action="store_true", help=what)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> Store:
    store, root = Store(spark, args.store), args.input.rstrip("/")
    parts = {name: read_parquet(spark, f"{root}/{name}", schema) for name, schema in TABLES.items()
             if name in ("events", "users") or store.exists(f"{root}/{name}")}
    if args.dimensions:
        journal = Journal(store, args.run) if args.run else None
        if journal is None or journal.once("dimensions"):
            jobs.refresh_dimensions(store, read_parquet(spark, f"{root}/edges", schemas.EDGE),
                                    *(read_parquet(spark, f"{root}/{n}", schemas.FILE_SOURCE) for n in ("files_current", "files_legacy")))
            if journal is not None:
                journal.done("dimensions")
        parts |= {name: store.read_dimension(name) for name in ("user_dep", "files")}
    jobs.Backfill(Workspace(**parts), store, bulk=not args.day_by_day, refresh=args.refresh, carry_spaces=args.carry_spaces,
                  carry_masks=args.carry_masks, catch_up=args.catch_up, name=args.run).run(args.start, args.end, args.tasks)
    return store


if __name__ == "__main__":
    run(SparkSession.builder.appName("run_jobs").getOrCreate(), arguments())
