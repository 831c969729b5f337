"""Reading tables, row identity and small expression helpers shared by the operators here.

Operators take a table with an id column and a text column, look at these two alone (other columns
may have any name), and treat a null text as empty. A document is known by its id and a 32-bit hash
of its text: rows that agree in both are one document, rows with one id and different texts are
several, and a null id is an id like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlight.operators.joins import fits_broadcast

MAX_BROADCAST_ROWS = 400_000
MAX_BROADCAST_BYTES = 40 * 1024 * 1024
#: Texts that go to Python at a time; the session's default counts rows alone, whatever their length.
BATCH_BYTES = "1m"
#: Between words: space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, text`` alone, nulls in the text as empty."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return docs.select(F.col(f"`{id_column}`").alias("doc_id"), text.alias("text"))


def text_batches(table: DataFrame) -> None:
    """Bound the bytes of a batch on its way to Python, where the session has no bound of its own."""
    conf = table.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def discard(table: DataFrame) -> None:
    """Delete a table written by ``cut_lineage`` that nothing reads any more."""
    spark = table.sparkSession
    for name in {path.rpartition("/")[0] for path in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_version(text: str = "text") -> Column:
    """What tells rows of one id apart: a 32-bit hash of the text."""
    return F.hash(F.col(text))


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join to a table that holds each key once; ids are compared null-safe.

    The right side is broadcast where its measured size is below a bound; otherwise both sides are
    shuffled. Keys are documents, so none is hot. How: inner, left, left_semi or left_anti.
    """
    right = right.select(*[F.col(n).alias(f"__{n}") for n in on], *[n for n in right.columns if n not in on])
    if fits_broadcast(right, MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES):
        right = F.broadcast(right)
    condition = F.lit(True)
    for n in on:
        condition = condition & left[n].eqNullSafe(right[f"__{n}"])
    joined = left.join(right, condition, how)
    return joined.drop(*[f"__{n}" for n in on])


def drop_documents(
    docs: DataFrame, keys: DataFrame, id_column: str = "doc_id", text_column: str = "text", how: str = "left_anti"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is not (or, by left_semi, is) in ``keys``."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    marked = docs.select("*", F.col(f"`{id_column}`").alias("__key_id"), F.hash(text).alias("__key_version"))
    keys = keys.select(F.col("doc_id").alias("__key_id"), F.col("version").alias("__key_version"))
    return sized_join(marked, keys, ["__key_id", "__key_version"], how).select(*[f"`{c}`" for c in docs.columns])
