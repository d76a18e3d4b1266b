"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
(default 8) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Each query is executed in full with the no-op sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["rating_profile", "pagerank", "hits", "near_duplicates", "frequent_itemsets", "kmeans_fixed_iters",
            "user_cosine", "fallback_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.environ.setdefault("QUARRY_SCRATCH", scratch)
    from quarry.plans.registry import load_all
    from quarry.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="quarry-bench")
    reg = load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in reg]
    times: dict[str, float] = {}
    for n in names:
        t0 = time.time()
        reg[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "notes": {"pagerank_rounds": 20, "pagerank_sec_per_round": round(times.get("pagerank", 0) / 20, 3)}}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
