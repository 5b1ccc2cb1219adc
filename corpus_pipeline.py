"""A corpus from raw documents to packed sequences, in five written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import line_dedup, mixing, packing, quality, shingle_dedup
from chatloom.llm.queries import table, tokenizer_path
from chatloom.plans.staging import stage

#: SQL can't express fingerprints, quotas and tokenizers; tests compare with a brute-force version.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, folder, "labels"))


def without_common_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    lines = line_dedup.drop_common_lines(docs)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("doc.text"))
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return lines.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8.

    SimHash fingerprints within 3 bits, then MinHash bands for what these leave open; every
    link is verified.
    """
    return shingle_dedup.keep_one(docs, distance=3)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The sources in their target shares, repeats as rows of their own."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", good_documents),
    ("lines", without_common_lines),
    ("near_duplicates", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to ``documents``, each over what the one before has written."""
    docs = table(spark, folder, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
