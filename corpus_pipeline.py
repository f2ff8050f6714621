"""From raw documents to token ids: five operators of ``linkgraph.llm`` in turn.

quality rules -> line dedup -> SimHash near-dedup -> mixing -> SentencePiece

Each stage takes what its predecessor kept and returns the columns of
``documents``; the last returns ids. A text that a stage changes gets a new
``n_chars``. Texts that line dedup leaves without a word stay as rows; they
hold no word for the mix to take.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkgraph.llm import lines, mixing, pieces, quality, simhash
from linkgraph.llm.common import saved_tables_removed, table
from linkgraph.llm.queries import tokenizer_path
from linkgraph.session import remove_path, written


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit_bands(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(lines.line_dedup(docs).drop("removed_lines"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(mixing.mixed_documents(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(docs, tokenizer_path()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("source_mix", source_mix), ("sentencepiece", sentencepiece)]

#: SQL has neither zstandard nor XXH64 nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again.

    A stage's own tables and its predecessor's result go once its result is
    written, so that the checkpoint folder holds two results at most.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with saved_tables_removed(spark):
            docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
