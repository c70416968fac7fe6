"""A corpus pipeline of five operators; every stage reads what its predecessor kept.

1. quality_classifier: documents that the line model rejects go.
2. near_dedup: one document of each near-duplicate group stays (five-word shingles, similarity 0.8).
3. suffix_dedup: later occurrences of passages of 50 words and more are cut out of the texts.
4. decontamination: documents that hold ten consecutive words of a benchmark item go.
5. bpe: token ids, and the digest of what they decode to.

All stages but the last return the columns of documents; further columns, whatever their names, stay with their
rows. Rows with null or repeated ids, null, empty and very long texts, repeated rows and empty tables are taken as
the operators' own docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thermolake.llm import decontaminate, linecrf, suffixdedup, superminhash, wordbpe
from thermolake.session import Scratch, ship_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores a half or more; a null or empty text is scored as one empty line."""
    ship_path(spark)
    return linecrf.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; texts without words, and rows without an id, all stay."""
    ship_path(spark)
    return superminhash.keep_one(docs, percent=80, k=5)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences; one that was nothing else goes, null and empty ones and those without an id stay as they are."""
    ship_path(spark)
    return suffixdedup.drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark window; null and empty texts stay."""
    ship_path(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, decoded_sha256 of every row; null and empty texts have no ids."""
    ship_path(spark)
    return wordbpe.encode_documents(docs, ["doc_id", "lang", "source"])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]
#: SQL expresses none of the trained or hashed stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again; the last one's rows. What a stage has read is deleted."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
