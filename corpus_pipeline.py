"""The corpus pipeline: stages over documents, each written and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, mixing, near_copies, token_files, toxicity
from tidemark.llm.queries import table, vocabulary
from tidemark.session import scratch_path, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7; the lexicon is learned from labelled documents that are not held out."""
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").where(toxicity.not_held_out())
    model = toxicity.train(docs, labels)
    return docs.where(toxicity.toxicity(F.col("text"), model) < 0.7)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 alike."""
    return near_copies.without_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files; their rows, read back."""
    path = scratch_path(spark, "pipeline-tokens")
    # Workers still hold what the stages before took, so this one caches less than by itself.
    token_files.write_token_files(docs, path, vocabulary("byte_bpe_50k.json"), cached_segments=300_000)
    return token_files.token_digests(token_files.read_token_files(spark, path))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: No stage's decision can be stated in SQL: learned scores, fingerprints and random rounding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
