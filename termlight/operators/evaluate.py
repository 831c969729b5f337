"""Ranked-retrieval metrics against relevance judgments.

A run has ``keys, doc_id, rank``, where the last key is ``query_id``; judgments have ``query_id,
doc_id, relevance`` and count as relevant above 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.operators.ranking import number_rows

DEPTH = 10


def relevant_only(qrels: DataFrame) -> DataFrame:
    return qrels.where(F.col("relevance") > 0).select("query_id", "doc_id").distinct()


def _discounted(ranks: Column) -> Column:
    return F.aggregate(
        ranks, F.lit(0.0), lambda total, r: total + 1 / F.log2(r + F.lit(1))
    )


def _precision_sum(ranks: Column) -> Column:
    """The precision at each hit, summed; ``ranks`` are the ranks of the hits in order."""
    at_hits = F.transform(ranks, lambda r, i: (i + 1) / r)
    return F.aggregate(at_hits, F.lit(0.0), lambda total, p: total + p)


def query_metrics(
    run: DataFrame,
    qrels: DataFrame,
    keys: list[str] | None = None,
    k: int = DEPTH,
    full_ap: bool = False,
) -> DataFrame:
    """``keys, hits, precision, recall, ap, ndcg`` for each list of the run.

    Only the ``k`` first ranks of a list are looked at. ``full_ap`` takes the average precision
    down the whole list instead, numbering its hits without gathering them.
    """
    keys = keys or ["query_id"]
    relevant = relevant_only(qrels)
    totals = relevant.groupBy("query_id").agg(F.count("*").alias("relevant"))
    marked = relevant.withColumn("hit", F.lit(True))
    head = run.where(F.col("rank") <= k).select(*keys, "doc_id", "rank")
    head = head.join(marked, ["query_id", "doc_id"], "left")
    ranks = F.array_sort(F.collect_list(F.when(F.col("hit"), F.col("rank"))))
    rows = head.groupBy(keys).agg(ranks.alias("ranks")).join(totals, "query_id", "left")
    if full_ap:
        found = run.select(*keys, "doc_id", "rank").join(relevant, ["query_id", "doc_id"])
        found = number_rows(found, keys, [F.col("rank")], "nth")
        sums = found.groupBy(keys).agg(F.sum(F.col("nth") / F.col("rank")).alias("ap_sum"))
        rows = rows.join(sums, keys, "left")
    else:
        rows = rows.withColumn("ap_sum", _precision_sum(F.col("ranks")))
    judged = F.col("relevant").isNotNull()
    ideal = _discounted(F.sequence(F.lit(1), F.least(F.col("relevant").cast("int"), F.lit(k))))

    def share(value: Column, by: Column) -> Column:
        return F.when(judged, F.coalesce(value, F.lit(0.0)) / by).otherwise(0.0)

    hits = F.size("ranks")
    return rows.select(
        *keys,
        hits.cast("long").alias("hits"),
        (hits / k).alias("precision"),
        share(hits, F.col("relevant")).alias("recall"),
        share(F.col("ap_sum"), F.col("relevant")).alias("ap"),
        share(_discounted(F.col("ranks")), ideal).alias("ndcg"),
    )


def evaluate_models(
    runs: DataFrame,
    queries: DataFrame,
    qrels: DataFrame,
    models: list[str],
    k: int = DEPTH,
    order: str = "query_id",
    limit: int | None = None,
) -> DataFrame:
    """``Model, MAP, Recall@k, P@k, nDCG@k``: macro-averages over the judged queries.

    All queries with a relevant document count, or those among the first ``limit`` in ``order``
    where a limit is given; a query without results counts as 0. Without any such query every model gets zeros.
    """
    taken = queries.select("query_id", order) if order != "query_id" else queries.select(order)
    taken = taken.orderBy(order).limit(limit) if limit else taken
    judged = taken.join(relevant_only(qrels), "query_id", "left_semi").select("query_id")
    names = F.array(*[F.lit(m) for m in models])
    cells = judged.withColumn("model", F.explode(names))
    metrics = query_metrics(runs, qrels, ["model", "query_id"], k)
    values = ["precision", "recall", "ap", "ndcg"]
    rows = cells.join(metrics, ["model", "query_id"], "left").na.fill(0.0, values)
    table = rows.groupBy("model").agg(*[F.avg(v).alias(v) for v in values])
    every = runs.sparkSession.createDataFrame([(m,) for m in models], "model string")
    return every.join(table, "model", "left").na.fill(0.0, values).select(
        F.col("model").alias("Model"),
        F.col("ap").alias("MAP"),
        F.col("recall").alias(f"Recall@{k}"),
        F.col("precision").alias(f"P@{k}"),
        F.col("ndcg").alias(f"nDCG@{k}"),
    )


def compare_models(runs: DataFrame, qrels: DataFrame, k: int = DEPTH) -> DataFrame:
    """``model, MAP, P@k, Recall, nDCG`` of single lists against ``qrels(doc_id, relevance)``.

    ``runs(model, doc_id, rank)``. Precision and recall look at the first ``k``; the average
    precision goes down the whole list.
    """
    one = F.lit("all").alias("query_id")
    lists = runs.select("model", one, "doc_id", "rank")
    judged = qrels.select(one, "doc_id", "relevance")
    metrics = query_metrics(lists, judged, ["model", "query_id"], k, full_ap=True)
    return metrics.select(
        "model",
        F.col("ap").alias("MAP"),
        F.col("precision").alias(f"P@{k}"),
        F.col("recall").alias("Recall"),
        F.col("ndcg").alias(f"nDCG@{k}"),
    )
