"""A training-data pipeline over documents: each stage reads what the one before has written.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return
the columns of documents, with ``n_chars`` brought up to date where texts change.

Defined cases: a null text fails the quality rules, as a text of few words does;
a text that loses all its lines or words stays as an empty text until the join,
where equal texts are one group; repeated rows are copies of each other.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import bpe, chosen_path, fm_index, host_rules, line_templates
from quarrystone.storage import materialize, scope, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars as the text has it now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the verdicts on their hosts keep."""
    return host_rules.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of recurring templates."""
    return _counted(line_templates.without_recurring(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return chosen_path.thin_out(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of benchmark phrases."""
    return _counted(fm_index.without_benchmark(docs, table(spark, sf_dir, "benchmark")))


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    ranks, pattern = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs, ranks, pattern)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.col("ids").alias("token_ids"), F.sha2("decoded", 256).alias("text_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokenisation", tokenisation),
]

ORACLE_SQL = None  # byte-level BPE is not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the table that the one before has written; what a stage needs beside its result goes with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scope(spark):
            docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
