"""Benchmark the headline queries.

Runs each registered query in ``HEADLINE`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total_seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed in full through the ``noop`` sink (nothing is collected).
``$BENCH_QUERIES`` (comma separated) overrides the query list.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # section 2.A: the reference's own operators
    "validate_genes", "validate_interactome", "validate_gwas_common", "validate_gwas_rare",
    "validate_expression", "validate_diseases", "validate_cross",
    "harmonize_genes", "harmonize_interactome", "harmonize_gwas_common", "harmonize_gwas_rare",
    "harmonize_expression", "harmonize_diseases",
    "ledger_pending", "ledger_summary", "ledger_eta",
    # section 2.B: graph and analysis operators
    "interaction_graph", "trait_layers", "seed_scores", "node_metrics", "rank_genes",
    "propagate", "coreness", "hub_score", "communities",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from genenet_spark.plans.catalog import REGISTRY
    from genenet_spark.session import build_session

    spark = build_session(f"local[{cpus}]", max(8, cpus * 2), app_name="genenet_bench")
    spark.range(1).write.format("noop").mode("overwrite").save()  # JVM warm-up, not timed

    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
