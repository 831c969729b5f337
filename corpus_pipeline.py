"""A corpus pipeline: documents in, packed training sequences out, one operator a stage.

Every stage works on all that the stage before kept, read back from Parquet. All but the last return
the columns of ``documents``. The packed ids come from a tokenizer, so no SQL states the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlight.llm import doubling, exact_stream, language, packing, similar
from termlight.llm.registered import tokenizer
from termlight.llm.tables import drop_documents, read
from termlight.session import cut_lineage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in no learned language: nearest centroid (4)."""
    return language.recognised(docs, language.fit(docs.where(~language.held_out())))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts: keyed stream state (8)."""
    return exact_stream.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group linked by SimHash, or by 5-word similarity of 0.8 or more (1)."""
    found = similar.near_copies(docs, fingerprints=True)
    return drop_documents(docs, found.where(~F.col("stays")).select("doc_id", "version").distinct())


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that occurred before out of the texts: level-wise doubling (7)."""
    cut = doubling.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack what is left: bounded-space packing (9)."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
