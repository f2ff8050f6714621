"""Incremental ingest of arriving dump files (see :mod:`linkgraph.streaming.ingest`)."""

from .ingest import ingested_from, start_ingest

__all__ = ["ingested_from", "start_ingest"]
