"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import table
from . import bpe, chosen_path, fm_index, host_rules, line_templates, mixing, oracle, recompression, secrets, sharding, surrogates, turns, warc, whitening

SHARDS = 8
SURROGATE_KEY = "registered-query-key"  # a caller keeps its own key secret


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_novel")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = recompression.dedup(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_templates.drop_recurring(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    ranks, pattern = str(tokenizers.path("byte_bpe_50k.tiktoken")), tokenizers.PATTERN
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), ranks, pattern)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = turns.damaged(table(spark, sf_dir, "conversations"))
    found = turns.digests(turns.prepared(rows), dropped)
    return found.withColumnRenamed("id", "conv_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_decontaminate, op3_jaccard_join, op4_secrets, op5_surrogates, op6_warc, op7_host_rules, op8_recompression, op9_line_templates, op10_byte_bpe, op11_whitening, op12_mixing, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
