"""Exact deduplication as a stateful stream.

Texts are equal when they are the same after all white space is deleted. Arrivals, a narrow table of
digest, id, length and content locator, are written to the shared folder and read by Structured
Streaming. A streaming aggregate keyed by digest holds, in RocksDB on the executors' disks and
without expiry, the group's size and the stable identifier and locator of the row that stays. Each
micro-batch changes only the keys that it brings, and the state is checkpointed in the shared
folder, so the stream resumes where it stopped.

A digest that came more than once is a hit, and hits are held against the full bytes: the texts of
such rows are grouped by digest and normalised text, where each task sends one row per distinct text
whatever the number of copies. Different texts under one digest become groups of their own.

Of a group, the row with the most code points stays, then the one with the smallest id (a null id is
smallest), then the first arrived; so of repeated rows one stays. Null texts are empty texts, and
empty texts are equal. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from termlight.llm.tables import BLANK_CLASS, drop_documents, plain, sized_join, text_version
from termlight.session import cut_lineage, new_folder

#: Arrival files in a micro-batch.
FILES_PER_BATCH = 64
#: State on the executors' disks, with one bound on the memory of all state partitions of an
#: executor, and without pre-allocation, which takes megabytes for each however little it holds.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}


def _normalized(text: str) -> Column:
    return F.regexp_replace(text, f"{BLANK_CLASS}+", "")


def _sha256(text: str) -> Column:
    return F.unhex(F.sha2(_normalized(text), 256))


def _digest(sha: Column, digest_bytes: int) -> Column:
    return F.substring(sha, 1, digest_bytes)


def _order() -> list[Column]:
    return [(-F.col("n_chars")).alias("less"), F.col("doc_id"), F.col("row"), F.col("locator")]


def _arrivals(docs: DataFrame, digest_bytes: int) -> DataFrame:
    return docs.select(
        "doc_id",
        text_version().alias("version"),
        _sha256("text").alias("sha"),
        F.length("text").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
        F.input_file_name().alias("locator"),
    ).withColumn("digest", _digest(F.col("sha"), digest_bytes))


def _state(arrivals: DataFrame, files_per_batch: int) -> DataFrame:
    """Feed written arrivals through the keyed state; the last value of each digest."""
    spark, source = arrivals.sparkSession, arrivals.inputFiles()
    changes, marks = new_folder(spark, "dedup-state"), new_folder(spark, "dedup-marks")
    groups = (
        spark.readStream.schema(arrivals.schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source[0].rpartition("/")[0])
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct(*_order())).alias("best"))
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    # An empty table by expressions: rows given from Python would start workers of their own on the executors.
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in groups.schema.fields]
    spark.range(0, 0, 1, 1).select(nothing).write.parquet(f"{changes}/batch=-1")
    held = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        stream = groups.writeStream.outputMode("update").option("checkpointLocation", marks)
        stream.trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    finally:
        for key, value in held.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    schema = StructType([*groups.schema.fields, StructField("batch", IntegerType())])
    written = spark.read.schema(schema).parquet(changes)
    last = F.max_by(F.struct("n", "best"), "batch").alias("last")
    return written.groupBy("digest").agg(last).select("digest", "last.n", "last.best")


def dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest_bytes: int = 32,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of
    the text without white space, and ``locator``, the input file of the row that stays.

    ``version`` is the hash that tells rows of one id apart. ``digest_bytes`` shortens the digest that
    keys the state; the result doesn't depend on it.
    """
    docs = plain(docs, id_column, text_column)
    arrivals = cut_lineage(_arrivals(docs, digest_bytes), "arrivals")
    groups = cut_lineage(_state(arrivals, files_per_batch), "groups")
    hits = groups.where(F.col("n") > 1).select("digest")
    texts = docs.withColumn("digest", _digest(_sha256("text"), digest_bytes))
    texts = sized_join(texts, hits, ["digest"], "left_semi")
    bytes_of = texts.select("digest", _sha256("text").alias("sha"), _normalized("text").alias("bytes"))
    different = bytes_of.groupBy("digest", "bytes").agg(F.min("sha").alias("sha"))
    clashes = cut_lineage(different.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1"), "clashes")
    resolved = groups.select("digest", "n", "best")
    result = arrivals.join(resolved, "digest")
    if not clashes.isEmpty():
        result = _split(arrivals, docs, resolved, clashes.select("digest"), digest_bytes)
    return result.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("best.locator").alias("locator"),
        "version",
    )


def _split(arrivals: DataFrame, docs: DataFrame, groups: DataFrame, clashes: DataFrame, digest_bytes: int) -> DataFrame:
    """The rows with their groups where some digests stand for several texts.

    Rows of such digests are grouped by their full bytes, the others stay as they are.
    """
    plain_rows = arrivals.join(clashes, "digest", "left_anti").join(groups, "digest")
    rows = _arrivals_with_bytes(docs, digest_bytes).join(clashes, "digest", "left_semi")
    own = rows.groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.min(F.struct(*_order())).alias("best"))
    split = rows.join(own, ["digest", "bytes"]).select(*plain_rows.columns)
    return plain_rows.unionByName(split)


def _arrivals_with_bytes(docs: DataFrame, digest_bytes: int) -> DataFrame:
    rows = docs.select("*", F.monotonically_increasing_id().alias("row"), F.input_file_name().alias("locator"))
    return rows.select(
        "doc_id", text_version().alias("version"), _sha256("text").alias("sha"),
        F.length("text").alias("n_chars"), "row", "locator",
        _normalized("text").alias("bytes"),
    ).withColumn("digest", _digest(F.col("sha"), digest_bytes))


def kept_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows one stays."""
    rows = cut_lineage(dedup(docs, id_column, text_column).select("doc_id", "version", "kept"), "kept")
    keys = ["doc_id", "version"]
    dropped = rows.where(~F.col("kept")).select(keys).distinct()
    repeated = rows.where("kept").join(dropped.withColumn("again", F.lit(True)), keys, "left_semi").select(keys)
    repeated = cut_lineage(repeated, "repeated")
    rest = drop_documents(docs, dropped, id_column, text_column)
    if repeated.isEmpty():
        return rest
    one = drop_documents(docs, repeated, id_column, text_column, "left_semi")
    return rest.unionByName(one.dropDuplicates([id_column, text_column]))
