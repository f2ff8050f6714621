"""DataFrame-in, DataFrame-out operators of the ingest, rank and top-k steps."""

from .extract import extract_links, link_rows
from .graph import Graph, dangling_nodes, edge_pairs, node_table, node_universe, out_degree
from .rank import (PreparedGraph, contribution_sums, contributions, dangling_mass, initial_ranks,
                   parity_step, prepare_graph, rank_nodes, rank_step, rank_trace, run_rank)
from .records import reject_report, split_records
from .topk import format_ranked, top_k

__all__ = [
    "Graph", "PreparedGraph", "contribution_sums", "contributions",
    "dangling_mass", "dangling_nodes", "edge_pairs", "extract_links",
    "format_ranked", "initial_ranks", "link_rows", "node_table", "node_universe",
    "out_degree", "parity_step", "prepare_graph", "rank_nodes", "rank_step", "rank_trace",
    "reject_report", "run_rank", "split_records", "top_k",
]
