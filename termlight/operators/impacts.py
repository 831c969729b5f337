"""BM25 top-k that leaves out blocks of documents which cannot reach the list.

Documents are dealt to blocks of about ``BLOCK_DOCS`` that have similar lengths. For each term and
block the index keeps the highest frequency and the smallest length, which bound what the term can
add to any document there, whatever k1 and b a query has. A search adds up these bounds, scores the
most promising blocks of each query, takes the k-th score found as the query's threshold, and then
scores the blocks whose bound reaches it. The run is exact: it equals that of ``lexical.bm25``.

Postings, impacts and the bounds of a search are bucketed by block, so neither the first two nor the
candidates are ever exchanged; a term in every document is spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.operators.index import DOC, TERM, SearchIndex, save_buckets
from termlight.operators.joins import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    MAX_NAMED_KEYS,
    fits_broadcast,
    lookup_join,
)
from termlight.operators.lexical import (
    B,
    K1,
    Search,
    bm25_idf,
    bm25_part,
    bm25_search,
    bm25_terms,
    run_in_blocks,
    weigh_queries,
)
from termlight.operators.ranking import SCORE_DIGITS, top_k
from termlight.session import cut_lineage, new_folder

BLOCK_DOCS = 128
#: Blocks that are scored first for each query, besides those that hold k documents.
FIRST_BLOCKS = 4


@dataclass(frozen=True)
class BlockIndex:
    """A search index with its postings by block and the bounds of each term and block."""

    index: SearchIndex
    postings: DataFrame
    impacts: DataFrame
    buckets: int
    block_docs: int
    path: str


def _blocks(lengths: DataFrame, block_docs: int) -> DataFrame:
    """``dataset, class, cells``: how many blocks the documents of similar length make."""
    sizes = lengths.groupBy("dataset", _length_class().alias("class")).agg(F.count("*").alias("docs"))
    return sizes.select("dataset", "class", F.ceil(F.col("docs") / block_docs).alias("cells"))


def _length_class() -> Column:
    """Lengths of one class differ by a factor below the square root of two."""
    return F.floor(2 * F.log2("dl")).cast("long")


def build_blocks(
    index: SearchIndex, block_docs: int = BLOCK_DOCS, buckets: int | None = None, path: str | None = None
) -> BlockIndex:
    """Deal the postings of an index to blocks; one shuffle, by block."""
    spark = index.postings.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or new_folder(spark, "blocks")
    postings = index.postings.select(*DOC, "dl", "term", "tf").withColumn("class", _length_class())
    placed = lookup_join(postings, _blocks(index.lengths, block_docs), ["dataset", "class"])
    cell = F.pmod(F.xxhash64("doc_id"), F.col("cells"))
    placed = placed.withColumn("block", F.shiftleft("class", 40) + cell).drop("class", "cells")
    postings = save_buckets(placed, path, "block_postings", buckets, "block", ["block", "term"])
    impacts = postings.groupBy(*TERM, "block").agg(
        F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"), F.count("*").alias("docs")
    )
    impacts = save_buckets(impacts, path, "impacts", buckets, "block", ["block", "term"], move=False)
    return BlockIndex(index, postings, impacts, buckets, block_docs, path)


def _bounds(blocks: BlockIndex, weighted: DataFrame, keys: list[str], variant: str) -> DataFrame:
    """``keys, dataset, block, bound, docs``: the most that a document of the block can score, and
    the postings of the query there. Parameters outside their usual range give no bound."""
    usual = (F.col("k1") >= 0) & F.col("b").between(0, 1)
    part = F.greatest(bm25_part(variant, F.col("max_tf"), F.col("min_dl")), F.lit(0.0))
    met = blocks.impacts.join(F.broadcast(weighted), TERM)
    bound = F.sum(F.when(usual, part).otherwise(F.lit(float("inf"))))
    found = met.groupBy(*keys, "dataset", "block").agg(bound.alias("bound"), F.sum("docs").alias("docs"))
    folder = new_folder(met.sparkSession, "bounds")
    return save_buckets(found, folder, "bounds", blocks.buckets, "block", ["block"], move=False)


def _score(
    blocks: BlockIndex, weighted: DataFrame, bounds: DataFrame, keys: list[str], variant: str, few: bool
) -> DataFrame:
    """Scores in the given blocks of each query. ``few`` blocks are broadcast, others joined where they lie."""
    part = bm25_part(variant, F.col("tf"), F.col("dl"))
    wanted = bounds.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("dataset").alias("__set"), F.col("block").alias("__block"))
    postings = blocks.postings
    named = bounds.select("block").distinct().limit(MAX_NAMED_KEYS + 1).collect()
    if len(named) <= MAX_NAMED_KEYS:
        postings = postings.where(F.col("block").isin([r.block for r in named]))
    met = postings.join(F.broadcast(weighted), TERM)
    # Bucketed by block alone: as equalities the other columns would become join keys, for which all
    # rows would be shuffled again.
    same = F.col("block") == F.col("__block")
    for own, other in [*((k, f"__{k}") for k in keys), ("dataset", "__set")]:
        same &= F.col(own).eqNullSafe(F.col(other)) if few else (F.col(own) <= F.col(other)) & (F.col(own) >= F.col(other))
    met = met.join(F.broadcast(wanted) if few else wanted, same, "left_semi")
    scores = met.groupBy(*keys, *DOC, "block").agg(F.sum(part).alias("score")).drop("block")
    return scores.where(F.col("score") > 0) if variant == "okapi" else scores


def _surviving(bounds: DataFrame, found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The blocks whose bound reaches the k-th score found, which all do where fewer than k are found."""
    least = found.where(F.col("rank") == k).select(*keys, F.col("score").alias("least"))
    least = cut_lineage(least, "thresholds")
    slack = 10.0**-SCORE_DIGITS
    if fits_broadcast(least):
        least = F.broadcast(least)
    reached = bounds.join(least, keys, "left").where(
        F.col("least").isNull() | (F.col("bound") + slack >= F.col("least"))
    )
    return reached.select(*bounds.columns)


def _pruned(
    blocks: BlockIndex, queries: DataFrame, k: int, k1: float, b: float, variant: str, keys: list[str],
    max_rows: int, use: Callable[[BlockIndex, DataFrame, DataFrame, DataFrame], DataFrame], wide: Search | None = None,
) -> DataFrame:
    """Find the surviving blocks of all queries, in blocks of queries, and ``use`` them.

    A query whose own terms are more than may be broadcast goes the ``wide`` way, which prunes nothing.
    """
    idf = bm25_idf(variant)
    terms = bm25_terms(queries, keys, k1, b)
    columns = dict.fromkeys([*keys, *TERM, "qtf", "idf", "avg_dl", "k1", "b"])

    def search(index: SearchIndex, terms: DataFrame, few: bool) -> DataFrame:
        if not few and wide is None:
            raise ValueError("a query has more terms than may be broadcast, so that nothing is pruned")
        if not few:
            return wide(index, terms, few)
        weighted = cut_lineage(weigh_queries(terms, index, idf, True).select(*columns), "weighted")
        bounds = _bounds(blocks, weighted, keys, variant)
        ordered = bounds.withColumnsRenamed({"bound": "score", "block": "doc_id"})
        first = top_k(ordered, keys, FIRST_BLOCKS + -(-2 * k // blocks.block_docs))
        first = cut_lineage(first.withColumnRenamed("doc_id", "block").select(*keys, "dataset", "block"), "first")
        few_first = fits_broadcast(first, MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES)
        found = top_k(_score(blocks, weighted, first, keys, variant, few_first), keys, k)
        return use(blocks, weighted, bounds, _surviving(bounds, found, keys, k))

    return run_in_blocks(replace(blocks.index, shelves=1), terms, keys, max_rows, search)


def bm25_pruned(
    blocks: BlockIndex,
    queries: DataFrame,
    k: int = 10,
    k1: float = K1,
    b: float = B,
    variant: str = "okapi",
    keys: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The run of ``lexical.bm25``, by scoring only blocks that can reach it. Keys are not null."""
    keys = keys or ["query_id"]

    def score(blocks: BlockIndex, weighted: DataFrame, bounds: DataFrame, reached: DataFrame) -> DataFrame:
        scores = _score(blocks, weighted, reached, keys, variant, False)
        return top_k(scores, keys, k).select(*keys, "dataset", "doc_id", "score", "rank")

    wide = bm25_search(variant, keys, k, bm25_idf(variant))
    return _pruned(blocks, queries, k, k1, b, variant, keys, max_rows, score, wide)


def pruning_report(
    blocks: BlockIndex,
    queries: DataFrame,
    k: int = 10,
    k1: float = K1,
    b: float = B,
    variant: str = "okapi",
    keys: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``keys, blocks, blocks_read, postings, postings_read`` of each query's search."""
    keys = keys or ["query_id"]

    def report(blocks: BlockIndex, weighted: DataFrame, bounds: DataFrame, reached: DataFrame) -> DataFrame:
        count = lambda rows, names: rows.groupBy(keys).agg(F.count("*").alias(names[0]), F.sum("docs").alias(names[1]))
        whole = count(bounds, ("blocks", "postings"))
        return whole.join(count(reached, ("blocks_read", "postings_read")), keys, "left").na.fill(0)

    return _pruned(blocks, queries, k, k1, b, variant, keys, max_rows, report)
