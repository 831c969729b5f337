"""Ranks. A run is ``keys, doc_id, score, rank``; ties go to the smaller document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlight.session import cut_lineage

SCORE_DIGITS = 6


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc()]


def top_k(scored: DataFrame, keys: list[str], k: int, digits: int = SCORE_DIGITS) -> DataFrame:
    """The ``k`` best documents of each list.

    Scores are rounded first, so that the order of the additions behind them cannot change a rank.
    Spark trims every list to ``k`` in each task before the shuffle (``WindowGroupLimit``), so a
    list with very many candidates is never gathered.
    """
    scored = scored.withColumn("score", F.round("score", digits))
    window = Window.partitionBy(*keys).orderBy(*best_first())
    ranked = scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def number_rows(rows: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """Number the rows of each list from 1, without gathering a list in one task.

    The rows are range-partitioned in list order, so a long list spans many partitions. Rows are
    counted inside each partition and shifted by what the earlier partitions hold of the list.
    """
    ordered = rows.repartitionByRange(*[F.col(k) for k in keys], *order)
    # Range bounds come from a sample; writing the parts out makes both uses see the same ones.
    parts = cut_lineage(ordered.withColumn("__part", F.spark_partition_id()), "numbered")
    here = Window.partitionBy(*keys, "__part").orderBy(*order)
    earlier = (
        Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = parts.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    shift = shift.withColumn("__shift", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    local = parts.withColumn("__at", F.row_number().over(here))
    numbered = local.join(shift.drop("__n"), [*keys, "__part"])
    number = (F.col("__at") + F.col("__shift")).alias(out)
    return numbered.select(*rows.columns, number)


def rank_all(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Rank lists of any length at full depth."""
    return number_rows(scored, keys, best_first(), "rank")


def format_run(run: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The stored form of a run: ids as strings, score as double, rank as long."""
    keys = keys or ["query_id"]
    return run.select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("score").cast("double").alias("score"),
        F.col("rank").cast("long").alias("rank"),
    )


def merge_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """All runs in one long table with a ``model`` column."""
    merged = None
    for model, run in runs.items():
        run = run.withColumn("model", F.lit(model))
        merged = run if merged is None else merged.unionByName(run)
    if merged is None:
        raise ValueError("no runs to merge")
    return merged


def max_normalize(run: DataFrame, keys: list[str]) -> DataFrame:
    """Divide the scores of each list by its maximum; a maximum of 0 changes nothing.

    Negative scores stay negative, and a list whose maximum is negative changes its order.
    """
    tops = run.groupBy(keys).agg(F.max("score").alias("__top"))
    share = F.when(F.col("__top") == 0, F.col("score")).otherwise(F.col("score") / F.col("__top"))
    return run.join(tops, keys).withColumn("score", share).drop("__top")
