"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the stage before it
kept.  All but the last return the columns they were given.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.llm import decontaminate, line_dedup, minhash, packing, toxicity
from dossier.llm.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose score is 0.5 or more; learned from the labelled ones of ``docs``."""
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score_toxicity(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return scored.filter("score < 0.5").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines of 10 documents and more out of all texts; every document stays."""
    lines = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        lines = lines.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return lines.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, the one of the smallest id.

    Documents without words are linked with nothing and stay, and so do rows without an id.
    """
    gone = minhash.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold an item of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with their tokens."""
    return packing.pack(docs, packing.default_tokenizer(), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer are not SQL; tests compare the run with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
