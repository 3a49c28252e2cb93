"""spark-submit entry point for the whole run (ingest -> transform -> publish).

  spark-submit jobs/run_all.py --crash <csv> --vehicles <csv> --people <csv> --root <shared dir> \
      [--job crash_summary|crash_vehicle_summary|vehicle_person_detail] [--table <name>] \
      [--external_table <name>] [--partition_by CRASH_YEAR] [--quarantine [--max_rejected N]] [--resume]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wreckline.plans.publish import JOBS, run_pipeline  # noqa: E402
from wreckline.session import build_session  # noqa: E402


def main(argv: list[str] | None = None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--crash", required=True)
    ap.add_argument("--vehicles", required=True)
    ap.add_argument("--people", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--job", default="crash_summary", choices=sorted(JOBS))
    ap.add_argument("--corrected", action="store_true")
    ap.add_argument("--external_table", default=None)
    ap.add_argument("--table", default=None)
    ap.add_argument("--quarantine", action="store_true", help="set bad rows aside instead of failing")
    ap.add_argument("--max_rejected", type=int, default=None, help="most rows of a dataset that may be set aside")
    ap.add_argument("--no_contract", action="store_true", help="do not enforce the output contract")
    ap.add_argument("--resume", action="store_true", help="keep the zones that an earlier run finished")
    ap.add_argument("--partition_by", action="append", default=None)
    args = ap.parse_args(argv)
    spark = build_session("wreckline-pipeline")
    return run_pipeline(
        spark, {"crash": args.crash, "vehicles": args.vehicles, "people": args.people}, args.root,
        job=args.job, compat=not args.corrected, external_table=args.external_table, table=args.table,
        partition_by=args.partition_by, enforce_contract=not args.no_contract, quarantine=args.quarantine,
        max_rejected=args.max_rejected, resume=args.resume,
    )


if __name__ == "__main__":
    main()
