"""Continuous ingest: analysis and index upkeep on file streams."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from termlight.operators.analyze import plain_tokens
from termlight.operators.index import (
    SearchIndex,
    corpus_stats,
    doc_lengths,
    merged_vocab_size,
    postings_from_tokens,
    text_partitions,
    tfidf_norms,
    vocabulary,
    vocabulary_sketch,
    with_dataset,
)
from termlight.operators.joins import fits_broadcast
from termlight.session import cut_lineage
from termlight.sources.collections import append_new, document_keys, not_yet_done, read_if_stored


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    pattern: str | None = None,
    files_per_batch: int = 100,
) -> DataFrame:
    """A stream of document files; ``files_per_batch`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(fmt).load(path)


def stream_processed(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the document's key and ``tokens`` of everything that has arrived."""
    tokens = plain_tokens(stream).select(*document_keys(stream), "tokens")
    return (
        tokens.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )


def _each_batch(stream: DataFrame, work: Callable, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_copies(batch: DataFrame, ordinal: str | None = None) -> DataFrame:
    """The document's key and ``tokens``, once per document of a batch.

    Of several copies the last one that has tokens counts, by ``ordinal`` or by arrival. Ids are
    counted first, on narrow rows; only the tokens of ids that come more than once are compared, and
    all other documents are analysed where they are read.
    """
    keys = document_keys(batch)
    several = batch.groupBy(keys).agg(F.count("*").alias("__copies")).where("__copies > 1")
    several = cut_lineage(several.select(*[F.col(k).alias(f"__{k}") for k in keys]), "several")
    if several.isEmpty():
        return plain_tokens(batch).select(*keys, "tokens")
    if fits_broadcast(several):
        several = F.broadcast(several)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    order = F.col(ordinal) if ordinal else F.monotonically_increasing_id()
    copies = batch.withColumn("__order", order).join(several, same, "left_semi")
    tokens = plain_tokens(copies).select(*keys, "tokens", "__order")
    last = F.max_by("tokens", F.struct(F.size("tokens") > 0, "__order")).alias("tokens")
    single = plain_tokens(batch.join(several, same, "left_anti")).select(*keys, "tokens")
    return single.unionByName(tokens.groupBy(keys).agg(last))


def stream_once_per_document(
    stream: DataFrame, out: str, checkpoint: str, ordinal: str | None = None
) -> StreamingQuery:
    """Process each document once, however often it arrives; equal ids of two datasets are two.

    The target table is the memory: an anti-join against it needs no state that grows with the
    stream, and a batch that is replayed after a failure finds its rows already there.
    """

    def work(batch: DataFrame, _: int) -> None:
        append_new(last_copies(batch, ordinal), out)

    return _each_batch(stream, work, checkpoint)


def stream_postings(
    stream: DataFrame, out: str, checkpoint: str, ordinal: str | None = None
) -> StreamingQuery:
    """Add the postings, lengths and vocabulary sketches of new documents, one folder per batch.

    Postings are additive per document; a replayed batch overwrites its own folders. Document
    frequencies and weights are derived at reading (``read_streamed_index``). The short table of
    lengths tells which documents are held.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # Raw text moves once, by document; counting its terms then needs no further exchange.
        docs = last_copies(with_dataset(batch).repartition(text_partitions(batch), "doc_id"), ordinal)
        fields = [StructField("dataset", StringType()), batch.schema["doc_id"]]
        ids = StructType([*fields, StructField("batch", LongType())])
        held = read_if_stored(spark, f"{out}/lengths", ids)
        if held is not None:
            docs = not_yet_done(docs, held.where(F.col("batch") != number))
        path = f"{out}/postings/batch={number}"
        postings_from_tokens(docs).write.mode("overwrite").parquet(path)
        lengths = doc_lengths(spark.read.parquet(path))
        lengths.write.mode("overwrite").parquet(f"{out}/lengths/batch={number}")
        sketch = vocabulary_sketch(spark.read.parquet(path))
        sketch.write.mode("overwrite").parquet(f"{out}/sketches/batch={number}")

    return _each_batch(stream, work, checkpoint)


def streamed_postings(spark: SparkSession, out: str) -> DataFrame:
    """The postings of every batch so far."""
    return spark.read.parquet(f"{out}/postings").drop("batch")


def streamed_vocab_size(spark: SparkSession, out: str) -> DataFrame:
    """``dataset, vocab_size`` of every batch so far, within a few percent, from the batches' sketches."""
    return merged_vocab_size(spark.read.parquet(f"{out}/sketches"))


def read_streamed_index(spark: SparkSession, out: str) -> SearchIndex:
    """The index over every batch so far; statistics are aggregated anew, once per call."""
    postings = streamed_postings(spark, out)
    lengths = spark.read.parquet(f"{out}/lengths").drop("batch")
    vocab = cut_lineage(vocabulary(postings), "vocab")
    stats = cut_lineage(corpus_stats(lengths, vocab), "stats")
    norms = cut_lineage(tfidf_norms(postings, vocab, stats), "norms")
    return SearchIndex(postings, lengths, vocab, stats, norms)


__all__ = [
    "last_copies",
    "read_documents",
    "read_streamed_index",
    "stream_once_per_document",
    "stream_postings",
    "stream_processed",
    "streamed_postings",
    "streamed_vocab_size",
]
