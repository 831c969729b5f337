"""Explicit schemas of the stored tables; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Key names in the order of preference, and the columns of the metrics report.
ID_KEYS = ["doc_id", "id", "_id", "document_id"]
TEXT_KEYS = ["text", "contents", "content", "body", "passage"]

DOCUMENT = StructType([StructField("doc_id", StringType()), StructField("title", StringType()),
                       StructField("text", StringType())])

ALIASED_DOCUMENT = StructType(
    [StructField(name, StringType()) for name in [*ID_KEYS, "title", *TEXT_KEYS]]
)

QUERY = StructType([StructField("query_id", StringType()), StructField("text", StringType())])

JUDGMENT = StructType([StructField("query_id", StringType()), StructField("doc_id", StringType()),
                       StructField("relevance", IntegerType())])

PROCESSED = StructType([StructField("doc_id", StringType()),
                        StructField("tokens", ArrayType(StringType()))])

METRICS = StructType([StructField("Model", StringType()), StructField("MAP", DoubleType()),
                      StructField("Recall@10", DoubleType()), StructField("P@10", DoubleType()),
                      StructField("nDCG@10", DoubleType())])

ID_AND_TEXT = StructType(
    [StructField("doc_id", StringType()), StructField("text", StringType())]
)
