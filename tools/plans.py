"""Print the physical plans of the main steps (the text of PLANS.md).

    python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().treeString()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from linkgraph.operators import graph as G
    from linkgraph.operators import rank as R
    from linkgraph.operators.topk import top_k
    from linkgraph.plans.graphs import trade_graph, wiki_lines
    from linkgraph.plans.jobs import ingest_lines
    from linkgraph.session import build_session

    spark = build_session("local[8]", 8)
    sections = []
    ing = ingest_lines(wiki_lines(spark, sf_dir), materialize=False)
    sections.append(("Ingest: split, name check and parse, next to the scan (no exchange)",
                     plan_text(ing.extracted)))
    sections.append(("Links of accepted pages: explode, decode, capture (JVM-side)", plan_text(ing.links)))
    g = trade_graph(spark, sf_dir)
    sections.append(("Merged links and vertex table (trade graph)", plan_text(G.node_table(g))))
    prep = R.prepare_graph(g)
    r0 = R.initial_ranks(prep, float(prep.n_nodes)).checkpoint()
    step = R.rank_step(prep, r0, float(prep.n_nodes), delta=0.0)
    sections.append(("One rank round: bucketed edges (cached) ⋈ ranks, partial sums, one exchange by id",
                     plan_text(step)))
    sections.append(("The same round with δ as a scalar subquery", plan_text(
        R.rank_step(prep, r0, float(prep.n_nodes)))))
    sections.append(("Top-k over named ranks", plan_text(top_k(prep.named(r0), 100))))
    prep.release()
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8]; adaptive plans before execution)\n")
    print("Generated by `python tools/plans.py`.\n")
    for title, text in sections:
        print(f"## {title}\n\n```\n{text.rstrip()}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
