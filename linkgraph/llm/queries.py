"""One registered query per operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkgraph.llm import (chat, fingerprints, lines, mixing, pieces, quality, ranking, resampling, secrets, simhash,
                           substrings, topk, warc)
from linkgraph.llm.common import SPACES, WORD_GAP, table, word_count
from linkgraph.session import scratch_path


def tokenizer_path() -> str:
    """The model file of op10, from the installed tokenizer package."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(F.filter(spans, lambda s: s["kind"] != "pair")).cast("binary"), 256).alias("base_sha256"), text(spans).alias("spans"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.round(F.get("copies", F.lit(0))["t"], 6)
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", first.alias("first_t"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_fitted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose words come from the operator, as it left them; the
    others keep all their words, which are counted and hashed where they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = substrings.changed_documents(docs).select(
        F.col("doc_id").alias("id"), "th", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("sha"))
    words = F.regexp_replace(F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES)), WORD_GAP, " ")
    rows = docs.select("doc_id", F.xxhash64("text").alias("dh"), word_count(F.col("text")).alias("n_words"),
                       F.sha2(words.cast("binary"), 256).alias("whole"))
    return rows.join(gone, (F.col("doc_id") == F.col("id")) & (F.col("dh") == F.col("th")), "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The conversation that op7 adds: texts that are all control strings.
EXTRA = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.render(turns))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("before", F.col("text"))
    count = F.coalesce(F.size(F.split("before", "\n")), F.lit(0)).cast("long")
    return lines.line_dedup(docs).select(
        "doc_id", F.when(F.col("before").isNull(), F.lit(0).cast("long")).otherwise(count).alias("n_lines"),
        F.when(F.col("removed_lines").isNull(), 0).otherwise(F.size("removed_lines")).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).drop("payload")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for part in parts:
            ids = [np.asarray(x.values, "<u4") for x in part.column(1)]
            yield pa.record_batch([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([sha(x.tobytes()) for x in ids], pa.string()),
                                   pa.array([sha(x.as_py().encode()) for x in part.column(2)], pa.string())], schema=schema)

    return pieces.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(),
                                then=(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_edits(table(spark, sf_dir, "documents"))
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join(own, "").alias("fingerprint"), F.array_join(edited, "").alias("edited_fingerprint"),
        fingerprints.resemblance(own, edited).alias("near_edited"), fingerprints.resemblance(own, following).alias("near_next"),
        fingerprints.containment(own, edited).alias("in_edited"), F.round(fingerprints.distinct_shingles(own), 3).alias("distinct_shingles"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_topk_search, op2_secret_scan, op3_source_mix, op4_quality_rules, op5_substring_dedup, op6_simhash,
    op7_chat_format, op8_line_dedup, op9_warc, op10_sentencepiece, op11_importance_resampling, op12_ranked_search,
    op13_fingerprints, pipeline)}
