"""Benchmark the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3).
Each run executes the full plan into the no-op sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from graphspark.plans import catalog  # noqa: E402
from graphspark.plans import kg_testdata  # noqa: E402
from graphspark.session import get_session  # noqa: E402

HEADLINE = ["vector_top_k", "anchor_candidates", "predicate_degree", "hub_anchor", "one_hop",
            "graph_rag", "vector_rag", "closure", "oracle_answers", "score_report",
            "hash_embed_docs", "seed_edges_any_column", "named_triples"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", max(cpus, 8), app_name="graphspark-bench")
    qs = catalog.queries()
    # The offline build (derive the graph from the driver tables and store it,
    # like loading edges and embedded nodes into tables) is timed on its own.
    t0 = time.perf_counter()
    graph = kg_testdata.stored(spark, sf_dir)
    build = round(time.perf_counter() - t0, 3)
    print(f"# graph_build: {build}s", file=sys.stderr, flush=True)
    work = {"items": graph.node_vectors.count(), "questions": graph.questions().count(),
            "cases": graph.cases().count(), "edges": graph.edges.count(), "dim": kg_testdata.VECTOR_DIM}
    times = {}
    for name in names:
        def once():
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
                      "graph_build_sec": build, "work": work}))
    spark.stop()


if __name__ == "__main__":
    main()
