"""linkgraph: link extraction, damped rank propagation and top-k reports on Spark.

Layout:

* ``linkgraph.sources``    scans and sinks (text dumps, parquet snapshots, text reports)
* ``linkgraph.functions``  column functions and the fixed patterns of the ingest
* ``linkgraph.operators``  records, link extraction, graph, rank, top-k
* ``linkgraph.plans``      whole jobs and the derived test graphs
* ``linkgraph.streaming``  the same ingest run incrementally on arriving dump files
"""

from .operators import Graph, rank_nodes, top_k
from .plans import ingest_lines, ingest_pages, run_dump
from .session import build_session, checkpoint_root

__all__ = ["Graph", "build_session", "checkpoint_root", "ingest_lines", "ingest_pages",
           "rank_nodes", "run_dump", "top_k"]
