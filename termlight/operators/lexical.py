"""BM25 and TF-IDF retrieval for a whole table of queries in one job.

A query table has ``query_id, tokens`` and may have ``dataset``, ``k1`` and ``b``. Further columns
named in ``keys`` identify the result lists, for instance in a parameter sweep.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from termlight.operators.index import (
    DOC,
    TERM,
    SearchIndex,
    okapi_idf,
    on_shelves,
    positive_idf,
    smooth_idf,
    with_dataset,
    with_norms,
)
from termlight.operators.joins import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    MAX_NAMED_KEYS,
    lookup_join,
    measure,
)
from termlight.operators.ranking import top_k
from termlight.session import cut_lineage, new_folder

K1 = 1.5
B = 0.75


def query_tf(queries: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``keys, dataset, term, qtf``: the terms of each query with their counts."""
    keys = keys or ["query_id"]
    queries = with_dataset(queries)
    extra = [c for c in ("k1", "b") if c in queries.columns and c not in keys]
    terms = queries.select(*keys, "dataset", *extra, F.explode_outer("tokens").alias("term"))
    terms = terms.where(F.col("term").isNotNull())
    return terms.groupBy(*keys, "dataset", *extra, "term").agg(F.count("*").alias("qtf"))


def with_stats(rows: DataFrame, index: SearchIndex) -> DataFrame:
    if index.few_collections:
        return rows.join(F.broadcast(index.stats), "dataset")
    return lookup_join(rows, index.stats, ["dataset"])


def weigh_queries(terms: DataFrame, index: SearchIndex, idf: Column, few: bool) -> DataFrame:
    """Query terms that occur in their collection, with ``df``, ``idf`` and the corpus statistics."""
    if few:
        known = index.vocab.join(F.broadcast(terms), TERM)
    else:
        known = lookup_join(terms, index.vocab, TERM)
    return with_stats(known, index).withColumn("idf", idf)


def score(
    index: SearchIndex, weighted: DataFrame, part: Column, keys: list[str], few: bool
) -> DataFrame:
    """``keys, dataset, doc_id, score``: the sum of ``part`` over the terms a document shares.

    Postings are partitioned by document, so a document's score is complete within one task and a
    frequent term has no partition of its own. ``few`` query terms (their size was checked) are
    broadcast. The terms of one query that alone is beyond the bound are copied to shards of
    documents, as many as there are shuffle partitions, and met there by a join that can spill: a
    term is then spread over all shards, and one more shuffle adds up each document's parts.
    """
    if few:
        matched = index.postings.join(F.broadcast(weighted), TERM)
        return matched.groupBy(*keys, *DOC).agg(F.sum(part).alias("score"))
    shards = int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards))
    postings = index.postings.withColumn("shard", shard)
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    copies = weighted.withColumn("shard", everywhere)
    matched = postings.join(copies, ["shard", *TERM])
    return matched.groupBy("shard", *keys, *DOC).agg(F.sum(part).alias("score")).drop("shard")


Search = Callable[[SearchIndex, DataFrame, bool], DataFrame]


def _narrowed(index: SearchIndex, terms: DataFrame) -> SearchIndex:
    """The index on the shelves of the query terms, and these named in the scan where they are few.

    Postings and vocabulary are sorted by term inside a file, so a few named terms leave most row
    groups unread.
    """
    index = replace(index, postings=on_shelves(index.postings, terms, index.shelves))
    named = terms.select("term").distinct().limit(MAX_NAMED_KEYS + 1).collect()
    if len(named) > MAX_NAMED_KEYS:
        return index
    known = F.col("term").isin([r.term for r in named])
    return replace(index, postings=index.postings.where(known), vocab=index.vocab.where(known))


def run_in_blocks(
    index: SearchIndex, terms: DataFrame, keys: list[str], max_rows: int, search: Search
) -> DataFrame:
    """``search(index, terms, few)`` for all query terms, which may be more than any broadcast.

    Query terms of a checked size are searched at once. More are dealt to blocks of whole queries,
    so that each block is below the bound; one after the other is broadcast to the postings where
    they lie, and adds its best documents to a table. As a query is in one block, what a block keeps
    is final, and nothing but these short lists is ever exchanged. A query whose own terms are
    beyond the bound goes by itself.
    """
    rows, size = measure(terms)
    if rows <= max_rows and size <= MAX_BROADCAST_BYTES:
        return search(_narrowed(index, terms), terms, True)
    terms = cut_lineage(terms, "query-terms")
    long = terms.groupBy(keys).agg(F.count("*").alias("__terms")).where(F.col("__terms") > max_rows)
    long = cut_lineage(long.select(keys), "long-queries")
    same = reduce(lambda a, b: a & b, [terms[k].eqNullSafe(long[k]) for k in keys])
    wide, terms = terms.join(long, same, "left_semi"), terms.join(long, same, "left_anti")
    share = max(2 * rows // max(max_rows, 1), 2 * size // MAX_BROADCAST_BYTES)
    block = F.pmod(F.xxhash64(*keys), F.lit(1 + share))
    spark, dealt, found = terms.sparkSession, new_folder(terms.sparkSession, "blocks"), new_folder(terms.sparkSession, "found")
    terms.withColumn("__block", block).write.partitionBy("__block").parquet(dealt)
    schema = None
    if not wide.isEmpty():
        best = search(index, wide, False)
        schema = best.schema
        best.write.mode("append").parquet(found)
    held = spark.read.schema(StructType([*terms.schema.fields, StructField("__block", LongType())])).parquet(dealt)
    numbers = sorted(r[0] for r in held.select("__block").distinct().collect())
    for number in numbers:
        some = held.where(F.col("__block") == number).drop("__block")
        best = search(_narrowed(index, some), some, True)
        schema = best.schema
        best.write.mode("append").parquet(found)
    return spark.read.schema(schema).parquet(found)


def _ranked(scores: DataFrame, keys: list[str], k: int) -> DataFrame:
    return top_k(scores, keys, k).select(*keys, "dataset", "doc_id", "score", "rank")


def bm25_part(variant: str, tf: Column, dl: Column) -> Column:
    """What a term with this frequency adds to the score of a document of this length."""
    k1, b = F.col("k1"), F.col("b")
    part = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / F.col("avg_dl")))
    return F.col("qtf") * part if variant == "okapi" else part


def bm25_terms(queries: DataFrame, keys: list[str], k1: float, b: float) -> DataFrame:
    """The terms of the queries with the parameters of their rows, or these where they have none."""
    for name, value in (("k1", k1), ("b", b)):
        if name not in queries.columns:
            queries = queries.withColumn(name, F.lit(float(value)))
    return query_tf(queries, keys)


def bm25_idf(variant: str) -> Column:
    if variant not in ("okapi", "plus_one"):
        raise ValueError(f"unknown BM25 variant {variant!r}; use 'okapi' or 'plus_one'")
    return okapi_idf() if variant == "okapi" else positive_idf()


def bm25_search(variant: str, keys: list[str], k: int, idf: Column) -> Search:
    """Score every candidate of the query terms and keep the best."""
    part = bm25_part(variant, F.col("tf"), F.col("dl"))
    columns = dict.fromkeys([*keys, *TERM, "qtf", "idf", "avg_dl", "k1", "b"])

    def search(index: SearchIndex, terms: DataFrame, few: bool) -> DataFrame:
        weighted = weigh_queries(terms, index, idf, few)
        scores = score(index, weighted.select(*columns), part, keys, few)
        if variant == "okapi":
            scores = scores.where(F.col("score") > 0)
        return _ranked(scores, keys, k)

    return search


def bm25(
    index: SearchIndex,
    queries: DataFrame,
    k: int = 10,
    k1: float = K1,
    b: float = B,
    variant: str = "okapi",
    keys: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """BM25 runs.

    ``okapi`` floors negative idfs, counts repeated query words and keeps positive scores only;
    ``plus_one`` uses ``ln(1 + ...)``, treats the query as a set and keeps every match. Columns
    ``k1`` and ``b`` of the queries override the arguments row by row.
    """
    idf = bm25_idf(variant)
    keys = keys or ["query_id"]
    terms = bm25_terms(queries, keys, k1, b)
    return run_in_blocks(index, terms, keys, max_rows, bm25_search(variant, keys, k, idf))


def tfidf_query(
    index: SearchIndex, terms: DataFrame, keys: list[str], few: bool
) -> DataFrame:
    """Unit-length TF-IDF query vectors over the indexed terms: ``keys, dataset, term, idf, wq``."""
    weighted = weigh_queries(terms, index, smooth_idf(), few)
    weight = F.col("qtf") * F.col("idf")
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy(*keys)))
    return weighted.withColumn("wq", weight / norm).select(*keys, *TERM, "idf", "wq")


def tfidf(
    index: SearchIndex,
    queries: DataFrame,
    k: int = 10,
    variant: str = "cosine",
    keys: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """TF-IDF runs: ``cosine`` of unit vectors, positive scores only, or the ``log_log`` product."""
    if variant not in ("cosine", "log_log"):
        raise ValueError(f"unknown TF-IDF variant {variant!r}; use 'cosine' or 'log_log'")
    keys = keys or ["query_id"]
    terms = query_tf(queries, keys)

    def search(index: SearchIndex, terms: DataFrame, few: bool) -> DataFrame:
        if variant == "log_log":
            idf = F.log(F.col("doc_count") / (1 + F.col("df")))
            weighted = weigh_queries(terms, index, idf, few).select(*keys, *TERM, "qtf", "idf")
            part = (1 + F.log("qtf")) * F.col("idf") * (1 + F.log("tf")) * F.col("idf")
            return _ranked(score(index, weighted, part, keys, few), keys, k)
        part = F.col("wq") * F.col("tf") * F.col("idf")
        dots = score(index, tfidf_query(index, terms, keys, few), part, keys, few)
        cosines = with_norms(dots, index.norms).withColumn("score", F.col("score") / F.col("norm"))
        return _ranked(cosines.where(F.col("score") > 0), keys, k)

    return run_in_blocks(index, terms, keys, max_rows, search)
