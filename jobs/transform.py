"""spark-submit entry point for the batch transforms.

  spark-submit jobs/transform.py --input_crashes <parquet> --input_vehicles <parquet> \
      --input_people <parquet> --output <dir> [--job crash_summary|crash_vehicle_summary|vehicle_person_detail] \
      [--corrected] [--hot_list <raw zone>] [--num_files N]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wreckline.plans.publish import JOBS, transform  # noqa: E402
from wreckline.session import build_session  # noqa: E402
from wreckline.sources.hot_list import load_hot_keys  # noqa: E402
from wreckline.sources.sinks import write_parquet  # noqa: E402


def main(argv: list[str] | None = None) -> str:
    ap = argparse.ArgumentParser()
    ap.add_argument("--input_crashes", required=True)
    ap.add_argument("--input_vehicles", required=True)
    ap.add_argument("--input_people", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--job", default="crash_summary", choices=sorted(JOBS))
    ap.add_argument("--corrected", action="store_true", help="evident-intent semantics instead of compat")
    ap.add_argument("--hot_list", default=None, help="root of a raw zone with a list of hot crash ids")
    ap.add_argument("--num_files", type=int, default=None, help="only for small outputs")
    args = ap.parse_args(argv)
    spark = build_session(f"wreckline-{args.job}")
    out = transform(spark, args.input_crashes, args.input_vehicles, args.input_people,
                    job=args.job, compat=not args.corrected,
                    hot=load_hot_keys(spark, args.hot_list) if args.hot_list else None)
    return write_parquet(out, args.output, mode="overwrite", num_files=args.num_files)


if __name__ == "__main__":
    main()
