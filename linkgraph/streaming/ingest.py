"""Incremental ingest: the batch ingest, run by Structured Streaming on dump files as they arrive.

The reference has no streaming; this is only another way to run its first job.
New ``name:html`` files in a folder are split, name-checked and parsed by the
same operators as the batch path (all stateless, so no state store, watermark
or shuffle is involved) and appended to a parquet table of extraction results.
The rank job then reads that table as a whole with :func:`ingested_from`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions import CONTAINER, LINK_TARGET_PATTERN
from ..operators.extract import extract_links
from ..operators.records import split_records
from ..plans.jobs import Ingested, from_extracted


def start_ingest(spark: SparkSession, source_dir: str, out_dir: str, mode: str = "strict",
                 container=CONTAINER, checkpoint_location: str | None = None,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream: ``source_dir`` (text files) → ``out_dir`` (parquet of
    ``(page, reason, hrefs, line)``). The query's own checkpoint lies in
    ``out_dir``, next to the rows it accounts for, unless given elsewhere: a
    later call goes on where the last one stopped, so each file is processed
    exactly once. Readers of the table pass over it, as its name begins with
    an underscore.

    ``available_now`` processes what is there and stops; otherwise the stream
    keeps running and picks up new files.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    extracted = extract_links(split_records(reader.load(source_dir)), mode, container)
    writer = (extracted.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint_location or f"{out_dir}/_ingest_checkpoint")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def ingested_from(spark: SparkSession, out_dir: str, link_pattern: str = LINK_TARGET_PATTERN,
                  decode: bool = True) -> Ingested:
    """The graph, report and rejects of everything the stream has written so far."""
    extracted: DataFrame = spark.read.parquet(out_dir)
    return from_extracted(extracted, link_pattern, decode, materialize=False)
