"""Collections, queries and processed tables: reading, resolving, writing, resuming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from termlight import schemas
from termlight.operators.index import keep_last

CORRUPT = "_corrupt"


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType, strict: bool = False
) -> DataFrame:
    """JSON lines with an explicit schema. Blank lines are ignored.

    A malformed line fails the job when ``strict``, otherwise it is dropped.
    """
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.schema(schema).option("mode", mode).json(path)


def count_malformed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``good, malformed``: what the tolerant scan keeps and drops."""
    kept = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Every column is read, else Spark would skip the parsing that finds the bad lines.
    rows = spark.read.schema(kept).options(**options).json(path)
    bad = F.col(CORRUPT).isNotNull()
    content = F.to_json(F.struct(*[f.name for f in schema.fields]))
    return rows.select(bad.alias("bad"), content.alias("content")).agg(
        F.count(F.when(~F.col("bad") & F.col("content").isNotNull(), 1)).alias("good"),
        F.count(F.when(F.col("bad"), 1)).alias("malformed"),
    )


def resolve_id(columns: list[str], ordinal: Column, prefix: str = "") -> Column:
    """The first id column that is set, as a string; else the prefix and the row's ordinal."""
    present = [F.col(c).cast("string") for c in schemas.ID_KEYS if c in columns]
    return F.coalesce(*present, F.concat(F.lit(prefix), ordinal.cast("string")))


def _stripped(column: str) -> Column:
    text = F.regexp_replace(F.col(column), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.when(text != "", text)


def resolve_text(columns: list[str], with_title: bool = True) -> Column:
    """The first text column that is not blank, trimmed, behind the title if there is one."""
    present = [_stripped(c) for c in schemas.TEXT_KEYS if c in columns]
    body = F.coalesce(*present) if present else F.lit(None).cast("string")
    title = [_stripped("title")] if with_title and "title" in columns else []
    return F.concat_ws(" ", *title, body)


def resolve_documents(raw: DataFrame, ordinal: str, prefix: str = "") -> DataFrame:
    """``doc_id, text`` of raw documents under any of the known key names."""
    return raw.select(
        resolve_id(raw.columns, F.col(ordinal), prefix).alias("doc_id"),
        resolve_text(raw.columns).alias("text"),
        F.col(ordinal),
    )


def first_n(rows: DataFrame, n: int, ordinal: str) -> DataFrame:
    """The first ``n`` rows by their (unique) ordinal; ``n = 0`` means all.

    Only ordinals are ordered; the rows themselves are filtered where they are.
    """
    if not n:
        return rows
    last = rows.select(ordinal).orderBy(ordinal).limit(n).agg(F.max(ordinal)).first()[0]
    return rows.where(F.col(ordinal) <= F.lit(last))


def sample_texts(raw: DataFrame, n: int, ordinal: str, prefix: str = "") -> DataFrame:
    """The first ``n`` documents, then without those that have no text."""
    return resolve_documents(first_n(raw, n, ordinal), ordinal, prefix).where(F.col("text") != "")


def scan_queries(raw: DataFrame, id_col: str = "query_id") -> DataFrame:
    """``query_id, text`` with string ids; null text becomes empty."""
    return raw.select(
        F.col(id_col).cast("string").alias("query_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def empty_documents(processed: DataFrame) -> DataFrame:
    """Ids of the documents that no token survived in."""
    return processed.where(F.size("tokens") == 0).select("doc_id")


def document_lookup(documents: DataFrame, ordinal: str, keys: list[str] | None = None) -> DataFrame:
    """``doc_id, text`` with blank texts left out; of equal ids the last document stays."""
    keys = keys or ["doc_id"]
    filled = documents.where(F.coalesce(_stripped("text"), F.lit("")) != "")
    return keep_last(filled.select(*keys, "text", ordinal), keys, ordinal).drop(ordinal)


def document_keys(*tables: DataFrame) -> list[str]:
    """``doc_id``, within its ``dataset`` where all of the tables have one."""
    return ["dataset", "doc_id"] if all("dataset" in table.columns for table in tables) else ["doc_id"]


def not_yet_done(rows: DataFrame, done: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The rows whose document a former run has not written."""
    keys = keys or document_keys(rows, done)
    return rows.join(done.select(keys).distinct(), keys, "left_anti")


def append_new(rows: DataFrame, path: str, keys: list[str] | None = None) -> DataFrame:
    """Append the rows that ``path`` does not hold yet and return the whole table."""
    spark = rows.sparkSession
    held = read_if_stored(spark, path, rows.schema)
    if held is not None:
        rows = not_yet_done(rows, held, keys)
    rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def read_if_stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """The table at ``path``, or nothing where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_once(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Write unless the table is there already; ``force`` replaces it."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def output_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """``name, rows`` of every table, counted in one job."""
    counts = None
    for name, table in tables.items():
        count = table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        counts = count if counts is None else counts.unionByName(count)
    return counts


def dataset_catalog(documents: DataFrame) -> DataFrame:
    """The collections of a table and the number of documents of each."""
    return documents.groupBy("dataset").agg(F.count("*").alias("docs"))
