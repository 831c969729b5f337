"""Exact inner-product search over stored vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from termlight.functions.vectors import l2_normalize
from termlight.operators.index import with_dataset
from termlight.operators.joins import fits_broadcast
from termlight.operators.ranking import SCORE_DIGITS, top_k
from termlight.session import cut_lineage, new_folder

QUERY_BLOCK = 50_000
#: Entries of all lists that a task holds.
BEST_CELLS = 5_000_000
PRODUCT_CELLS = 20_000_000


def unit_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    return table.withColumn(vector, l2_normalize(F.col(vector)))


def vector_stats(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """Number of vectors and their dimension."""
    return table.agg(
        F.count("*").alias("vectors"), F.max(F.size(vector)).cast("long").alias("dim")
    )


class Best:
    """The k best documents of each query so far, in memory of queries times k."""

    def __init__(self, queries: int, k: int):
        self.scores, self.names = np.full((queries, k), -np.inf), None
        self.k = k

    def least(self, rows: np.ndarray) -> np.ndarray:
        """The scores that a document must reach to be looked at."""
        return self.scores[rows, -1]

    def add(self, rows: np.ndarray, names: np.ndarray, scores: np.ndarray) -> None:
        """Merge documents with their scores for the queries in ``rows``; ties go to the smaller name."""
        if self.names is None:
            self.names = np.zeros(self.scores.shape, names.dtype)
        least = self.least(rows)
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        query, doc = np.nonzero(scores >= least[:, None])
        met = np.unique(query)
        if not len(met):
            return
        held, place = np.nonzero(self.scores[rows[met]] > -np.inf)
        held = met[held]
        row = np.concatenate([held, query])
        score = np.concatenate([self.scores[rows[held], place], scores[query, doc]])
        name = np.concatenate([self.names[rows[held], place], names[doc]])
        order = np.lexsort((np.unique(name, return_inverse=True)[1], -score, row))
        row, score, name = row[order], score[order], name[order]
        starts = np.searchsorted(row, row)
        rank = np.arange(len(row)) - starts
        kept = rank < self.k
        self.scores[rows[met]] = -np.inf
        self.scores[rows[row[kept]], rank[kept]] = score[kept]
        self.names[rows[row[kept]], rank[kept]] = name[kept]

    def frame(self, query_ids: np.ndarray) -> pd.DataFrame:
        row, place = np.nonzero(self.scores > -np.inf)
        names = self.names[row, place] if self.names is not None else []
        return pd.DataFrame({"query_id": query_ids[row], "doc_id": names, "score": self.scores[row, place]})


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _search(queries: pd.DataFrame, blocks: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Run all blocks past the queries of their collection and yield the k best together, once."""
    if not len(queries):
        return
    matrix, best = stacked(queries["embedding"]), Best(len(queries), k)
    rows_of = queries.reset_index(drop=True).groupby("dataset").indices
    for block in blocks:
        for dataset, docs in block.groupby("dataset"):
            rows = rows_of.get(dataset, np.zeros(0, int))
            vectors, names = stacked(docs["embedding"]).T, docs["doc_id"].to_numpy()
            step = max(1, PRODUCT_CELLS // len(docs))
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                best.add(some, names, np.round(matrix[some] @ vectors, SCORE_DIGITS))
    yield best.frame(queries["query_id"].to_numpy())


def vector_rows(table: DataFrame, key: str, vector: str, alias: str) -> DataFrame:
    picked = with_dataset(table).select(
        "dataset", F.col(key).alias(alias), F.col(vector).alias("embedding")
    )
    return picked.where(F.col(alias).isNotNull() & F.col("embedding").isNotNull())


def out_schema(queries: DataFrame, docs: DataFrame) -> t.StructType:
    return t.StructType(
        [
            t.StructField("query_id", queries.schema["query_id"].dataType),
            t.StructField("doc_id", docs.schema["doc_id"].dataType),
            t.StructField("score", t.DoubleType()),
        ]
    )


def in_query_blocks(
    queries: DataFrame, query_block: int, k: int, search: Callable[[pd.DataFrame], DataFrame]
) -> DataFrame:
    """``search`` for queries of any number, a bounded block of them after the other.

    A block has at most some ``query_block`` queries and their lists at most ``BEST_CELLS`` entries.
    Its best documents are final and are added to a table.
    """
    query_block = max(1, min(query_block, BEST_CELLS // k))
    if fits_broadcast(queries, max_rows=query_block):
        return search(queries.toPandas())
    spark, found = queries.sparkSession, new_folder(queries.sparkSession, "found")
    number = F.pmod(F.xxhash64("query_id"), F.lit(1 + 2 * queries.count() // query_block))
    dealt = cut_lineage(queries.withColumn("block", number).repartition("block"), "query-blocks")
    schema = None
    for row in dealt.select("block").distinct().orderBy("block").collect():
        best = search(dealt.where(F.col("block") == row.block).drop("block").toPandas())
        schema = best.schema
        best.write.mode("append").parquet(found)
    return spark.read.schema(schema).parquet(found)


def nearest(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    doc_key: str = "doc_id",
    query_key: str = "query_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Exact top ``k`` by inner product: ``query_id, doc_id, score, rank``; negative scores stay.

    Where both tables have a ``dataset`` column, a query meets the vectors of its own collection.

    A query table of a checked size goes to every task, which multiplies its documents block by
    block and emits only its own best ``k`` per query; those meet in one shuffle by query. A larger
    query table is searched in bounded blocks, one after the other; the documents are never copied.
    """
    if not ("dataset" in docs.columns and "dataset" in queries.columns):
        docs, queries = docs.drop("dataset"), queries.drop("dataset")
    docs = vector_rows(docs, doc_key, vector, "doc_id")
    queries = vector_rows(queries, query_key, vector, "query_id")
    spark, schema = docs.sparkSession, out_schema(queries, docs)

    def block(some: pd.DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(some)

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _search(shared.value, batches, k)

        return top_k(docs.mapInPandas(search, schema), ["query_id"], k)

    return in_query_blocks(queries, query_block, k, block)
