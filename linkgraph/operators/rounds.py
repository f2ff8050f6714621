"""Where the rank loop keeps its rounds: the last two, and no more.

``Checkpoints`` are for a run that lives and dies with its session: reliable
checkpoints, removed as soon as they are older than the round before. ``RoundLog``
is for a run that a later session may go on with: every round is a written table
that counts once its manifest, which holds the round's metrics (among them the
next round's dangling mass), is renamed into place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path
from ..sources import manifest

ROUND_SCHEMA = "vid bigint, nb bigint, rank double, prev double"


class Checkpoints:
    """Rounds as checkpoints; files are deleted here, whatever the session's
    cleaner is set to do."""

    def __init__(self):
        self.files: list[str] = []

    def last(self) -> None:
        return None

    def keep(self, number: int, ranks: DataFrame) -> DataFrame:
        out = ranks.checkpoint()
        self.files.append(out._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
        return out

    def commit(self, number: int, content: dict, spark: SparkSession) -> None:
        while len(self.files) > 2:
            remove_path(spark, self.files.pop(0))


class RoundLog:
    """Rounds as tables under ``path``, each committed with its metrics."""

    def __init__(self, spark: SparkSession, path: str, schema: str = ROUND_SCHEMA):
        self.spark, self.path, self.schema, self.folder = spark, path, schema, ""

    def last(self) -> tuple[int, dict, DataFrame] | None:
        """(round, what was committed with it, its ranks) of the last whole round."""
        found = manifest.read(self.spark, self.path)
        if found is None:
            return None
        return found["number"], found, self._read(found["folder"])

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")

    def keep(self, number: int, ranks: DataFrame) -> DataFrame:
        self.folder = f"round-{number:010d}-{uuid.uuid4().hex[:8]}"
        ranks.write.parquet(f"{self.path}/{self.folder}")
        return self._read(self.folder)

    def commit(self, number: int, content: dict, spark: SparkSession) -> None:
        manifest.commit(self.spark, self.path, number, {**content, "folder": self.folder})
        held = manifest.numbers(self.spark, self.path)
        for old in held[:-2]:
            remove_path(self.spark, manifest.file_of(self.path, old))
        named = {manifest.read(self.spark, self.path, n)["folder"] for n in held[-2:]}
        for name in manifest.listing(self.spark, self.path):     # also rounds that a killed run left uncommitted
            if name.startswith("round-") and name not in named:
                remove_path(self.spark, f"{self.path}/{name}")
