"""Vectors as a table with a recorded dimension and number.

The vectors are written by their partitions, and what the record needs is observed on the way, so
that nothing is read again. The record is written last and only if every row has a vector of one
length; a folder without it is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termlight.sources.collections import read_if_stored

RECORD = "dimension int, vectors long, id_type string"


def save_vectors(
    table: DataFrame, path: str, key: str = "doc_id", vector: str = "embedding", force: bool = False
) -> DataFrame:
    """Write ``doc_id, embedding`` with the vectors as 32-bit floats; returns the record.

    A folder that has a record stays as it is unless ``force`` replaces it. Rows without a vector,
    or vectors of several lengths, are an error. An empty table has the dimension 0.
    """
    spark = table.sparkSession
    held = None if force else read_record(spark, path)
    if held is not None:
        return held
    rows = table.select(F.col(key).alias("doc_id"), F.col(vector).cast("array<float>").alias("embedding"))
    seen, length = Observation(), F.size("embedding")
    rows = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count("embedding").alias("vectors"),
        F.min(F.when(F.col("embedding").isNotNull(), length)).alias("shortest"),
        F.max(length).alias("longest"),
    )
    rows.write.mode("overwrite").parquet(f"{path}/vectors")
    found = seen.get
    if found["rows"] and (found["vectors"] < found["rows"] or found["shortest"] != found["longest"]):
        missing = found["rows"] - found["vectors"]
        raise ValueError(f"{missing} rows without a vector, lengths from {found['shortest']} to {found['longest']}")
    kind = rows.schema["doc_id"].dataType.simpleString()
    record = spark.createDataFrame([(found["longest"] if found["rows"] else 0, found["rows"], kind)], RECORD)
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/record")
    return spark.read.schema(RECORD).parquet(f"{path}/record")


def read_record(spark: SparkSession, path: str) -> DataFrame | None:
    """``dimension, vectors, id_type`` of a folder, or nothing where no vectors were saved."""
    return read_if_stored(spark, f"{path}/record", RECORD)


def read_vectors(spark: SparkSession, path: str, dimension: int | None = None) -> DataFrame:
    """``doc_id, embedding`` of a folder, of this dimension if it is given.

    Another recorded dimension fails at once; a stored vector of another length than recorded fails
    the job that reads it.
    """
    record = read_record(spark, path)
    if record is None:
        raise ValueError(f"no vectors were saved at {path}")
    held = record.first()
    if dimension not in (None, held.dimension):
        raise ValueError(f"the vectors at {path} have dimension {held.dimension}, not {dimension}")
    schema = f"doc_id {held.id_type}, embedding array<float>"
    rows = spark.read.schema(schema).parquet(f"{path}/vectors")
    wrong = F.raise_error(F.concat(F.lit("a stored vector has length "), F.size("embedding").cast("string")))
    checked = F.when(F.size("embedding") == held.dimension, F.col("embedding")).otherwise(wrong.cast("array<float>"))
    return rows.select("doc_id", checked.alias("embedding"))
