"""Timing probe on N copies of driver tables (the PLANS.md scaling section).

Copies ``events.parquet`` and ``orders.parquet`` of an sf folder N times into
a fresh scratch folder (``<name>.parquet/part-<i>.parquet``), then runs the
chosen headline queries through ``bench.py`` with ``BENCH_SF_DIR`` pointing
there. The copies repeat rows, so use the timings only; correctness is
checked on the driver tables themselves.

Usage: python scripts/scale_probe.py [--copies 64] [--sf-dir DIR] [--queries q1,q2]
"""

from __future__ import annotations

import argparse
import os
import shutil
import subprocess
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
EVENTS_AND_ORDERS_QUERIES = ("feature_matrix,feature_matrix_sources,daily_avg,join_inner_multikey,"
                             "join_band_left,label_7day,complete_requests,string_index,hash_split,"
                             "dedup_by_key,describe_stats,surrogate_key,sort_mixed")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--copies", type=int, default=64)
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--tables", default="events,orders")
    ap.add_argument("--queries", default=EVENTS_AND_ORDERS_QUERIES)
    ap.add_argument("--repeat", default="3")
    args = ap.parse_args()
    scratch = tempfile.mkdtemp(prefix="wrenchcast-probe-")
    for table in args.tables.split(","):
        target = os.path.join(scratch, f"{table}.parquet")
        os.makedirs(target)
        for i in range(args.copies):
            shutil.copyfile(os.path.join(args.sf_dir, f"{table}.parquet"), os.path.join(target, f"part-{i:04d}.parquet"))
    env = dict(os.environ, BENCH_SF_DIR=scratch, BENCH_QUERIES=args.queries, BENCH_REPEAT=args.repeat)
    print(f"scratch folder: {scratch}", file=sys.stderr)
    subprocess.run([sys.executable, os.path.join(HERE, "bench.py")], env=env, check=True)


if __name__ == "__main__":
    main()
