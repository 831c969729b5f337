"""Exact inner-product search that leaves out blocks of vectors which cannot reach the list.

Vectors are dealt to the nearest of some pivots and packed into blocks of bounded size. A block keeps
its centre and its radius, the largest distance of a member from it. For a query q no member x can
score more than ``<q, centre> + |q| * radius``, since ``<q, x - centre>`` is at most the product of
both lengths; for unit vectors this is the triangle inequality. A search scores the blocks with the
nearest centres, takes the k-th score of each query as its threshold, and then reads the blocks whose
bound reaches the threshold of some query. The run equals that of ``dense.nearest``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from termlight.operators.dense import QUERY_BLOCK, Best, in_query_blocks, nearest, out_schema, stacked, vector_rows
from termlight.operators.joins import lookup_join, wanted_rows
from termlight.operators.ranking import SCORE_DIGITS, top_k
from termlight.session import cut_lineage

#: Vectors drawn as pivots, by the hash of their ids. They shape the blocks; every vector is in one.
PIVOTS = 1024
BLOCK_VECTORS = 2048
FIRST_BLOCKS = 4
SLACK = 10.0**-SCORE_DIGITS


@dataclass(frozen=True)
class VectorBlocks:
    """``dataset, block, centre, radius, vectors, ids, packed``: one row a block."""

    table: DataFrame

    def outline(self) -> DataFrame:
        """The blocks without their vectors, which a scan of these columns does not read."""
        return self.table.select("dataset", "block", "centre", "radius", "vectors")


def build_vector_blocks(
    docs: DataFrame,
    doc_key: str = "doc_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    block_vectors: int = BLOCK_VECTORS,
) -> VectorBlocks:
    """Pack all vectors; rows without an id or a vector are left out.

    A pivot with more vectors than a block may have is split by a hash of the ids, so that no task
    gets more than a block, and copies of one vector, however many, fill blocks of radius 0.
    """
    docs = vector_rows(docs, doc_key, vector, "doc_id")
    spark, id_kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    drawn = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(pivots).select("embedding").collect()
    centres = np.unique(np.array([r.embedding for r in drawn], dtype=np.float64), axis=0)
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf(LongType())
    def cell(vectors: pd.Series) -> pd.Series:
        at, near = shared.value, []
        for start in range(0, len(vectors), 4096):
            some = stacked(vectors.iloc[start : start + 4096])
            near.append(((at * at).sum(axis=1) - 2 * some @ at.T).argmin(axis=1))
        return pd.Series(np.concatenate(near) if near else [], dtype="int64")

    dealt = cut_lineage(docs.withColumn("cell", cell("embedding")), "cells")
    parts = F.ceil(F.count("*") / block_vectors).alias("parts")
    sized = lookup_join(dealt, dealt.groupBy("dataset", "cell").agg(parts), ["dataset", "cell"])
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    placed = sized.withColumn("block", F.shiftleft("cell", 32) + part).select("dataset", "block", "doc_id", "embedding")

    def pack(members: pd.DataFrame) -> pd.DataFrame:
        vectors = stacked(members["embedding"])
        centre = vectors.mean(axis=0)
        radius = float(np.sqrt(((vectors - centre) ** 2).sum(axis=1).max()))
        return pd.DataFrame({
            "dataset": [members["dataset"].iat[0]], "block": [members["block"].iat[0]], "centre": [centre],
            "radius": [radius], "vectors": [len(members)], "ids": [members["doc_id"].to_numpy()], "packed": [vectors.ravel()],
        })

    schema = (
        f"dataset string, block long, centre array<double>, radius double, vectors long, ids array<{id_kind}>, packed array<double>"
    )
    packed = placed.groupBy("dataset", "block").applyInPandas(pack, schema)
    return VectorBlocks(cut_lineage(packed, "vector-blocks"))


def _asked(queries: pd.DataFrame, least: dict | None) -> tuple:
    """Vectors, lengths, thresholds and the rows of each collection."""
    matrix = stacked(queries["embedding"])
    bounds = np.array([-np.inf if least is None else least.get(q, -np.inf) for q in queries["query_id"]])
    return matrix, np.sqrt((matrix * matrix).sum(axis=1)), bounds, queries.reset_index(drop=True).groupby("dataset").indices


def _reaching(block, matrix, lengths, least, rows) -> np.ndarray:
    """The queries of the block's collection whose threshold its bound reaches."""
    if not len(rows):
        return rows
    bound = matrix[rows] @ np.asarray(block.centre) + lengths[rows] * block.radius
    return rows[bound + SLACK + 1e-9 * np.abs(bound) >= least[rows]]


def _best_of(table: DataFrame, queries: pd.DataFrame, k: int, least: dict | None, schema) -> DataFrame:
    """The k best in the blocks of a table; the thresholds rise with what a task has found."""
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast((queries, least))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, thresholds = shared.value
        if not len(asked):
            return
        matrix, lengths, floor, rows_of = _asked(asked, thresholds)
        best = Best(len(asked), k)
        for batch in batches:
            for block in batch.itertuples():
                rows = rows_of.get(block.dataset, np.zeros(0, int))
                rows = _reaching(block, matrix, lengths, np.maximum(floor, best.scores[:, -1]), rows)
                if len(rows):
                    names = np.asarray(block.ids)
                    vectors = np.asarray(block.packed).reshape(len(names), -1)
                    best.add(rows, names, np.round(matrix[rows] @ vectors.T, SCORE_DIGITS))
        yield best.frame(asked["query_id"].to_numpy())

    columns = table.select("dataset", "centre", "radius", "ids", "packed")
    return top_k(columns.mapInPandas(search, schema), ["query_id"], k)


def surviving_blocks(blocks: VectorBlocks, queries: pd.DataFrame, least: dict) -> DataFrame:
    """``dataset, block`` whose bound reaches the threshold of some query, from the outline alone."""
    shared = blocks.table.sparkSession.sparkContext.broadcast((queries, least))

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix, lengths, floor, rows_of = _asked(*shared.value)
        for batch in batches:
            alive = [
                bool(len(_reaching(b, matrix, lengths, floor, rows_of.get(b.dataset, np.zeros(0, int)))))
                for b in batch.itertuples()
            ]
            yield batch.loc[alive, ["dataset", "block"]]

    return cut_lineage(blocks.outline().mapInPandas(reached, "dataset string, block long"), "reached")


def nearest_in_blocks(
    blocks: VectorBlocks,
    queries: DataFrame,
    k: int = 10,
    query_key: str = "query_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    seen: list | None = None,
) -> DataFrame:
    """Exact top ``k`` by inner product: ``query_id, doc_id, score, rank``.

    Queries are searched in bounded blocks, and what a task holds is bounded by these and ``k``.
    ``seen`` is given the table of the blocks that each block of queries read.
    """
    queries = vector_rows(queries, query_key, vector, "query_id")
    schema = out_schema(queries, blocks.table.select(F.explode("ids").alias("doc_id")))

    def search(some: pd.DataFrame) -> DataFrame:
        spark = blocks.table.sparkSession
        if not len(some):
            return spark.createDataFrame([], schema).withColumn("rank", F.lit(1).cast("long"))
        asked = spark.createDataFrame(some, queries.schema)
        outline = blocks.outline().withColumnRenamed("centre", "embedding")
        near = nearest(outline, asked, FIRST_BLOCKS, doc_key="block")
        first = near.select(F.col("doc_id").alias("block")).distinct()
        opened = wanted_rows(blocks.table, cut_lineage(first, "first"), ["block"])
        found = _best_of(opened, some, k, None, schema).where(F.col("rank") == k)
        least = {r.query_id: r.score for r in found.collect()}  # one row a query of the block
        reached = surviving_blocks(blocks, some, least)
        if seen is not None:
            seen.append(reached)
        return _best_of(wanted_rows(blocks.table, reached, ["dataset", "block"]), some, k, least, schema)

    return in_query_blocks(queries, query_block, k, search)
