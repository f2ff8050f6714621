"""Command line: the reference's program as one Spark application.

    python -m linkgraph INPUT GRAPH_OUT RANKS_OUT TOP_OUT [--iterations 10] [--k 100] [--alpha 0.15]
    spark-submit --py-files linkgraph.zip linkgraph/__main__.py INPUT GRAPH_OUT RANKS_OUT TOP_OUT

INPUT is a page dump (``name:html`` lines, plain or bz2). Writes the merged
graph (S2) to GRAPH_OUT, every round's ranks (S4) under RANKS_OUT/iter=<i>, and
the top K as ``name rank`` text (S5) to TOP_OUT; prints the ingest report and
the wall time of each step. With ``--state DIR`` a run that was ended is taken up
again by the same command: what GRAPH_OUT and DIR hold whole is not done anew.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkgraph.functions import (ALPHA, CONTAINER, ITERATIONS, LINK_TARGET_PATTERN, NAV_CONTAINER,  # noqa: E402
                                 NAV_LINK_PATTERN, TOP_K)
from linkgraph.operators.rank import DEFAULT_SPLIT, finish, prepare_graph, prepared, run_rank  # noqa: E402
from linkgraph.operators.topk import top_k  # noqa: E402
from linkgraph.plans.jobs import ingest_lines  # noqa: E402
from linkgraph.session import build_session  # noqa: E402
from linkgraph.sources import read_graph, read_lines, write_graph, write_ranked_text  # noqa: E402


def parse_container(text: str) -> tuple[str, str | None, str | None]:
    """``tag`` or ``tag:attribute=value`` → ``(tag, attribute, value)``."""
    tag, _, rest = text.partition(":")
    attribute, _, value = rest.partition("=")
    return (tag, attribute, value) if attribute else (tag, None, None)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="linkgraph", description=__doc__.split("\n\n")[0])
    ap.add_argument("input")
    ap.add_argument("graph_out")
    ap.add_argument("ranks_out")
    ap.add_argument("top_out")
    ap.add_argument("--iterations", type=int, default=ITERATIONS)
    ap.add_argument("--k", type=int, default=TOP_K)
    ap.add_argument("--alpha", type=float, default=ALPHA)
    ap.add_argument("--mode", choices=["strict", "lenient"], default="strict")
    ap.add_argument("--container", default=None, metavar="TAG[:ATTRIBUTE=VALUE]",
                    help="element whose anchors count (default: div:id=bodyContent, in lenient mode nav)")
    ap.add_argument("--link-pattern", default=None, help="links that count; group 1 is the target (Java regular expression)")
    ap.add_argument("--universe", choices=["all", "pages"], default="all", help="vertices in the top K")
    ap.add_argument("--n", choices=["all", "records"], default="all",
                    help="N in the formula: all vertices, or the accepted records (their total then grows from round to round)")
    ap.add_argument("--split", type=int, default=DEFAULT_SPLIT, help="most distinct targets of a vertex in one bucket of links")
    ap.add_argument("--state", default=None, metavar="DIR", help="folder that keeps the prepared graph and the last rounds, to resume from")
    ap.add_argument("--tol", type=float, default=None, help="stop after the round whose L1 change is below this")
    ap.add_argument("--active", action="store_true", help="with --tol: only vertices whose rank still changes send it on")
    ap.add_argument("--exclude", action="append", default=[], metavar="NAME", help="leave a name out of the top K (repeatable)")
    ap.add_argument("--drop-rejected-lines", action="store_true", help="keep no text of rejected lines")
    ap.add_argument("--decimals", type=int, default=None,
                    help="fixed decimals in the text output (default: Java double text)")
    args = ap.parse_args(argv)

    spark = build_session()
    t0 = time.perf_counter()
    lenient = args.mode == "lenient"
    container = parse_container(args.container) if args.container else (NAV_CONTAINER if lenient else CONTAINER)
    pattern = args.link_pattern or (NAV_LINK_PATTERN if lenient else LINK_TARGET_PATTERN)
    if args.state and prepared(spark, args.state):
        print(f"resuming from {args.state}")
    else:
        ing = ingest_lines(read_lines(spark, args.input), mode=args.mode, container=container, link_pattern=pattern,
                           keep_rejected_lines=not args.drop_rejected_lines)
        write_graph(ing.graph, args.graph_out)
        for r in ing.report().orderBy("reason").collect():
            print(f"{r['reason']}: {r['n']}")
    t1 = time.perf_counter()
    print(f"ingest took {t1 - t0:.3f} s")

    graph = read_graph(spark, args.graph_out)                   # as the snapshot has it: links merged once
    prep = prepare_graph(graph, split=args.split, state=args.state)
    try:
        run = run_rank(prep, alpha=args.alpha, iterations=args.iterations, trace=True, n=args.n,
                       n_records=graph.n_records() if args.n == "records" else None,
                       tol=args.tol, snapshots=args.ranks_out, state=args.state, active=args.active)
        ranks = finish(prep, run.ranks, args.universe)
    finally:
        prep.release()
    t2 = time.perf_counter()
    for row in run.trace:
        print(f"round {row['iteration']}: rank sum {row['rank_sum']:.12f}, "
              f"dangling mass {row['dangling_mass']:.12f}")
    print(f"{run.iterations} rounds took {t2 - t1:.3f} s")

    write_ranked_text(top_k(ranks, args.k, exclude=args.exclude), args.top_out, decimals=args.decimals)
    print(f"top {args.k} took {time.perf_counter() - t2:.3f} s")
    return 0


if __name__ == "__main__":
    sys.exit(main())
