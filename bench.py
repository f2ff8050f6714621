"""Bench: the reference's three jobs plus the derived graphs, at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: total seconds, seconds per query, and per rank round.
Each query is run to completion with the ``noop`` sink, so nothing is
collected to the driver beyond what the job itself needs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkgraph.operators.rank import prepare_graph, run_rank  # noqa: E402
from linkgraph.operators.topk import top_k  # noqa: E402
from linkgraph.plans.graphs import page_nav, trade_graph, wiki_lines  # noqa: E402
from linkgraph.plans.jobs import ingest_lines, ingest_pages  # noqa: E402
from linkgraph.operators.rank import rank_nodes  # noqa: E402
from linkgraph.session import build_session  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", partitions=cpus, app="linkgraph-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # warm-up: JVM, Python workers, parquet footers
    run(trade_graph(spark, sf_dir).edges.limit(1))

    # 1. ingest: strict dump lines and lenient page table, report + links
    def ingest_strict():
        ing = ingest_lines(wiki_lines(spark, sf_dir))
        run(ing.report())
        run(ing.links)
        return ing

    wiki = timed("ingest_strict", ingest_strict)
    timed("ingest_lenient", lambda: run(ingest_pages(page_nav(spark, sf_dir)).links))

    # 2. rank: graph preparation, then 10 rounds on the trade graph
    prep = timed("trade_prepare", lambda: prepare_graph(trade_graph(spark, sf_dir)))
    result = timed("rank_10_rounds", lambda: run_rank(prep))
    times["rank_round_avg"] = round(times["rank_10_rounds"] / max(result.iterations, 1), 3)

    # 3. top-100 over the final ranks
    timed("top_100", lambda: top_k(prep.named(result.ranks), 100).collect())
    sizes = {"trade_links": trade_graph(spark, sf_dir).edges.count(),
             "trade_compacted_links": prep.n_pairs,
             "trade_vertices": prep.n_nodes, "edge_buckets": prep.partitions,
             "dump_lines": wiki.extracted.count(), "dump_links": wiki.links.count()}
    prep.release()

    # the reference's whole program on the strict-mode dump
    timed("wiki_end_to_end", lambda: top_k(rank_nodes(wiki.graph), 100).collect())

    total = round(sum(v for k, v in times.items() if k != "rank_round_avg"), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "sizes": sizes}))
    spark.stop()


if __name__ == "__main__":
    main()
