"""Relevance judgments and metric reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlight import schemas


def to_trec(qrels: DataFrame) -> DataFrame:
    """``query_id, doc_id, relevance`` as tab-separated ``value`` lines."""
    return qrels.select(
        F.concat_ws(
            "\t",
            F.col("query_id").cast("string"),
            F.lit("0"),
            F.col("doc_id").cast("string"),
            F.col("relevance").cast("string"),
        ).alias("value")
    )


def write_trec(qrels: DataFrame, path: str, force: bool = False) -> None:
    to_trec(qrels).write.mode("overwrite" if force else "ignore").text(path)


def parse_trec(lines: DataFrame) -> DataFrame:
    """The distinct judgments with a relevance above 0, from ``value`` lines."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.select(
        parts.getItem(0).alias("query_id"),
        parts.getItem(2).alias("doc_id"),
        parts.getItem(3).cast("int").alias("relevance"),
    )
    return rows.where(F.col("relevance") > 0).select("query_id", "doc_id").distinct()


def read_trec(spark: SparkSession, path: str) -> DataFrame:
    return parse_trec(spark.read.text(path))


def write_metrics(table: DataFrame, path: str) -> None:
    names = [f.name for f in schemas.METRICS.fields]
    table.select(*[f"`{n}`" for n in names]).write.option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRICS).option("header", True).csv(path)
