"""Rank and score fusion of a long table of runs (``model`` names the run)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.operators.ranking import max_normalize, top_k

RRF_K = 60
FUSED_DIGITS = 10


def reciprocal_rank(runs: DataFrame, keys: list[str], k: int = RRF_K) -> DataFrame:
    """``keys, doc_id, score``: the sum of ``1 / (k + rank)`` over the runs that found a document."""
    return runs.groupBy(*keys, "doc_id").agg(F.sum(1 / (k + F.col("rank"))).alias("score"))


def _weight(models: list[str], weights: dict[str, float] | None) -> Column:
    """Equal shares over all models asked, also those that found nothing for a query."""
    weights = weights or {m: 1.0 / len(models) for m in models}
    entries = [F.lit(part) for m in models for part in (m, float(weights[m]))]
    return F.element_at(F.create_map(*entries), F.col("model"))


def linear(
    runs: DataFrame,
    keys: list[str],
    models: list[str],
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Weighted sum of the max-normalised scores of the runs in ``models``."""
    shares = max_normalize(runs.where(F.col("model").isin(models)), [*keys, "model"])
    part = _weight(models, weights) * F.col("score")
    return shares.groupBy(*keys, "doc_id").agg(F.sum(part).alias("score"))


def fuse(
    runs: DataFrame,
    keys: list[str],
    models: list[str],
    method: str = "rrf",
    weights: dict[str, float] | None = None,
    k: int = 10,
) -> DataFrame:
    """The ``k`` best documents after fusion: ``rrf``, or ``linear``."""
    if method not in ("rrf", "linear"):
        raise ValueError(f"unknown fusion method {method!r}; use 'rrf' or 'linear'")
    if method == "rrf":
        fused = reciprocal_rank(runs.where(F.col("model").isin(models)), keys)
    else:
        fused = linear(runs, keys, models, weights)
    return top_k(fused, keys, k, FUSED_DIGITS)
