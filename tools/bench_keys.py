"""Times every registered query: median of 3 runs after one warm-up run.

Each query runs from the driver tables (mapping, labels, fact and the query
itself, whole tables) and its result is consumed with a no-op write, so the
timing covers the full plan without collecting rows to the driver.
Usage: python tools/bench_keys.py [sf_dir] > BENCH_KEYS.md
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farelens.plans.catalog import QUERIES, shared_frames  # noqa: E402
from farelens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2)
    rows = []
    for name, q in QUERIES.items():
        times = []
        for i in range(4):
            t0 = time.perf_counter()
            q(shared_frames(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            if i:  # the first run is the warm-up
                times.append(time.perf_counter() - t0)
        rows.append((name, statistics.median(times), min(times), max(times)))
        print(f"{name}: {rows[-1][1]:.2f}", file=sys.stderr, flush=True)
    print("# BENCH_KEYS\n")
    print(f"Every registered query on `{os.path.basename(sf_dir.rstrip('/'))}` (whole tables: mapping of the "
          f"driver tables, labels, fact, then the query), `local[{cpus}]`, median of 3 runs after one "
          "warm-up, result consumed by a no-op write. Generated by `python tools/bench_keys.py`.\n")
    print("| key | median s | min s | max s |\n| --- | --- | --- | --- |")
    for name, med, lo, hi in rows:
        print(f"| {name} | {med:.2f} | {lo:.2f} | {hi:.2f} |")
    print(f"\nSum of medians: {sum(r[1] for r in rows):.1f} s over {len(rows)} keys.")


if __name__ == "__main__":
    main()
