"""Whole jobs and the derived test graphs built from the driver's tables."""

from .graphs import page_nav, trade_edges, trade_graph, wiki_lines
from .jobs import Ingested, ingest_lines, ingest_pages, run_dump

__all__ = ["Ingested", "ingest_lines", "ingest_pages", "page_nav", "run_dump", "trade_edges",
           "trade_graph", "wiki_lines"]
