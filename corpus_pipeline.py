"""The corpus pipeline over ``documents``: each stage is written as Parquet and read by the next.

Stages, in order: documents the quality classifier rejects go; of each group of near copies one document stays;
repeated passages are cut out of the documents that repeat them; the sources are mixed to their target weights;
the mixed documents are packed. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import chunking, minhash, mixing, packing, quality
from millrace.llm.common import table
from millrace.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject; it learns from all labels of the documents at hand."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more."""
    return minhash.dedupe(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; texts that were nothing else go."""
    return chunking.dedupe(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each source brought to its target weight."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of the mixed documents, piece by piece, with their sequences and step groups."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# Documents are classified, compared, cut and packed by code that SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{place}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
