"""Hybrid retrieval, routing by model, and search responses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlight.functions.text import output_score
from termlight.functions.vectors import dot
from termlight.operators.dense import nearest
from termlight.operators.fusion import fuse
from termlight.operators.index import SearchIndex, with_dataset
from termlight.operators.joins import wanted_rows
from termlight.operators.lexical import B, K1, bm25, tfidf
from termlight.operators.ranking import merge_runs
from termlight.operators.refine import Speller, refine
from termlight.session import cut_lineage
from termlight.sources.collections import document_lookup

MODELS = ["tfidf", "bm25", "embedding", "hybrid_serial", "hybrid_parallel"]
FIRST_STAGE = 100
COLUMNS = ["query_id", "doc_id", "score", "rank"]


@dataclass(frozen=True)
class Corpus:
    """What a search reads: the term index, document vectors and document texts."""

    index: SearchIndex
    vectors: DataFrame  # doc_id, embedding
    documents: DataFrame  # doc_id, text

    # All of them, and the queries, may have a ``dataset`` column; without one there is a single
    # collection.


def _rerank(run: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = run.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= k)


def _shared(queries: DataFrame, asks: list[str], find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``find`` for queries of which many may ask the same (``asks``, and their collection).

    Equal queries are one search, under the smallest of their ids, whose list all of them get.
    """
    asks = [c for c in (*asks, "dataset") if c in queries.columns]
    first = F.min("query_id").over(Window.partitionBy(*asks))
    members = cut_lineage(queries.select("query_id", *asks, first.alias("__search")), "searches")
    run = find(members.where(F.col("query_id") == F.col("__search")).drop("__search"))
    run = run.withColumnRenamed("query_id", "__search")
    return run.join(members.select("query_id", "__search"), "__search").select(COLUMNS)


def lexical_run(corpus: Corpus, queries: DataFrame, k: int, model: str = "bm25", shared: bool = False) -> DataFrame:
    """The run of a lexical model; ``shared`` searches once for all queries that ask the same."""

    def find(some: DataFrame) -> DataFrame:
        return (bm25(corpus.index, some, k) if model == "bm25" else tfidf(corpus.index, some, k)).select(COLUMNS)

    asks = ["tokens", "k1", "b"] if model == "bm25" else ["tokens"]
    return _shared(queries, asks, find) if shared else find(queries)


def dense_run(corpus: Corpus, queries: DataFrame, k: int, shared: bool = False) -> DataFrame:
    """Nearest documents of the queries that have a vector (column ``embedding``); ``shared`` as in ``lexical_run``."""

    def find(some: DataFrame) -> DataFrame:
        return nearest(corpus.vectors, some, k).select(COLUMNS)

    return _shared(queries.where(F.col("embedding").isNotNull()), ["embedding"], find) if shared else find(queries)


def serial_from(lexical: DataFrame, dense: DataFrame, k: int = 10) -> DataFrame:
    """The dense run restricted to what the lexical run found, ranked again."""
    shared = dense.join(lexical.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_semi")
    return _rerank(shared, k).select(COLUMNS)


def hybrid_serial(
    corpus: Corpus,
    queries: DataFrame,
    k: int = 10,
    first_stage: int = FIRST_STAGE,
    rescore: bool = True,
) -> DataFrame:
    """BM25 finds ``first_stage`` candidates (at least ``k``), vectors score and rank all of them.

    Without ``rescore`` the dense top ``first_stage`` of the whole collection is kept where BM25
    found the document too, which can leave fewer than ``k``.
    """
    first_stage = max(first_stage, k)
    lexical = lexical_run(corpus, queries, first_stage)
    if not rescore:
        return serial_from(lexical, dense_run(corpus, queries, first_stage), k)
    return _rerank(rescored(corpus, queries, lexical), k).select(COLUMNS)


def rescored(corpus: Corpus, queries: DataFrame, lexical: DataFrame) -> DataFrame:
    """``query_id, doc_id, score``: the candidates of a lexical run by their vectors."""
    apart = "dataset" in queries.columns and "dataset" in corpus.vectors.columns
    keys = ["dataset", "doc_id"] if apart else ["doc_id"]
    asked = queries.where(F.col("embedding").isNotNull())
    asked = asked.select("query_id", *keys[:-1], F.col("embedding").alias("__q"))
    lexical = cut_lineage(lexical.select("query_id", "doc_id"), "candidates")
    pairs = lexical.join(asked, "query_id")
    vectors = corpus.vectors.select(*keys, F.col("embedding").alias("__d"))
    pairs = pairs.join(wanted_rows(vectors, pairs.select(keys).distinct(), keys), keys)
    scored = pairs.withColumn("score", F.round(dot(F.col("__q"), F.col("__d")), 6))
    return scored.select("query_id", "doc_id", "score")


def hybrid_parallel(
    corpus: Corpus,
    queries: DataFrame,
    k: int = 10,
    method: str = "rrf",
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """BM25, TF-IDF and vectors at twice the depth, fused."""
    runs = merge_runs(
        {
            "bm25": lexical_run(corpus, queries, 2 * k),
            "tfidf": lexical_run(corpus, queries, 2 * k, "tfidf"),
            "embedding": dense_run(corpus, queries, 2 * k),
        }
    )
    models = ["bm25", "tfidf", "embedding"]
    return fuse(runs, ["query_id"], models, method, weights, k).select(COLUMNS)


def run_model(
    corpus: Corpus, queries: DataFrame, model: str, k: int = 10, method: str = "rrf"
) -> DataFrame:
    """One query table through one model."""
    if model in ("bm25", "tfidf"):
        return lexical_run(corpus, queries, k, model)
    if model == "embedding":
        return dense_run(corpus, queries, k)
    if model == "hybrid_serial":
        return hybrid_serial(corpus, queries, k)
    if model == "hybrid_parallel":
        return hybrid_parallel(corpus, queries, k, method)
    raise ValueError(f"unknown model {model!r}; use one of {MODELS}")


def all_runs(corpus: Corpus, queries: DataFrame, k: int = 10, rescore: bool = True) -> DataFrame:
    """The runs of all five models. Each base model runs once, at the greatest depth needed."""
    queries = queries.drop("model")
    stage = max(FIRST_STAGE, k)
    deep = max(stage, 2 * k)
    base = merge_runs(
        {
            "bm25": lexical_run(corpus, queries, deep),
            "tfidf": lexical_run(corpus, queries, 2 * k, "tfidf"),
            "embedding": dense_run(corpus, queries, 2 * k if rescore else deep),
        }
    )
    base = cut_lineage(base, "runs")
    of = lambda m, depth: base.where((F.col("model") == m) & (F.col("rank") <= depth)).drop("model")
    bases = ["bm25", "tfidf", "embedding"]
    fused = fuse(base.where(F.col("rank") <= 2 * k), ["query_id"], bases, k=k).select(COLUMNS)
    candidates = of("bm25", stage)
    serial = (
        _rerank(rescored(corpus, queries, candidates), k).select(COLUMNS)
        if rescore
        else serial_from(candidates, of("embedding", stage), k)
    )
    return merge_runs(
        {
            **{m: of(m, k) for m in bases},
            "hybrid_serial": serial,
            "hybrid_parallel": fused,
        }
    )


def _defaults(requests: DataFrame, values: dict) -> DataFrame:
    """Fill missing columns and null values."""
    for name, value in values.items():
        held = F.coalesce(F.col(name), F.lit(value)) if name in requests.columns else F.lit(value)
        requests = requests.withColumn(name, held)
    return requests


#: The models that read each base run.
READERS = {
    "bm25": ["bm25", "hybrid_serial", "hybrid_parallel"],
    "tfidf": ["tfidf", "hybrid_parallel"],
    "embedding": ["embedding", "hybrid_serial", "hybrid_parallel"],
}


def route(corpus: Corpus, requests: DataFrame) -> DataFrame:
    """Answer each request with the model, depth and fusion method it asks for.

    ``requests(query_id, tokens, model[, top_k, k1, b, fusion_method, first_stage, rescore,
    embedding])``; missing and null values mean 10, ``K1``, ``B``, ``rrf``, ``FIRST_STAGE`` and true.
    ``first_stage``, at least ``top_k``, and ``rescore`` are those of ``hybrid_serial``. An unknown
    model or method fails the job. Requests are classed by the depth they need (to 100, 1000, and so
    on), so that a deep one does not make the others deep; each base run is computed once a class that
    needs it, at the class's greatest depth, and cut for each request before fusing. Requests that ask
    a base model the same are one search of it.
    """
    defaults = {"top_k": 10, "k1": K1, "b": B, "fusion_method": "rrf", "first_stage": FIRST_STAGE, "rescore": True}
    requests = _defaults(requests, defaults)
    requests = requests.withColumn("first_stage", F.greatest("first_stage", "top_k"))

    def one_of(name: str, known: list[str]):
        wrong = F.concat(F.lit(f"unknown {name} "), F.coalesce(F.col(name), F.lit("null")))
        return F.when(F.col(name).isin(known), F.col(name)).otherwise(F.raise_error(wrong))

    requests = requests.withColumn("model", one_of("model", MODELS))
    requests = requests.withColumn("fusion_method", one_of("fusion_method", ["rrf", "linear"]))
    requests = cut_lineage(requests, "requests")
    need = F.when(F.col("model") == "hybrid_serial", F.col("first_stage")).when(
        F.col("model") == "hybrid_parallel", 2 * F.col("top_k")
    ).otherwise(F.col("top_k"))
    limits = requests.select(
        "query_id", F.col("model").alias("asked"), "top_k", "fusion_method", "first_stage", "rescore", need.alias("__need")
    )
    depth_class = F.greatest(F.length((need - 1).cast("string")), F.lit(2)).alias("depth_class")
    most = [F.max("top_k").alias("k"), F.max(need).alias("depth"), F.collect_set("rescore").alias("rescore")]
    asked = requests.groupBy("model", depth_class).agg(*most).collect()
    deepest: dict[str, int] = {}
    for r in asked:
        deepest[r.model] = max(r.k, deepest.get(r.model, 0))
    serial = sorted({x for r in asked if r.model == "hybrid_serial" for x in r.rescore})
    bases: dict[str, DataFrame] = {}
    for base, readers in READERS.items():
        if base == "embedding" and False not in serial:
            readers = [m for m in readers if m != "hybrid_serial"]
        for number in sorted({r.depth_class for r in asked if r.model in readers}):
            depth = max(r.depth for r in asked if r.model in readers and r.depth_class == number)
            mine = requests.where(F.col("model").isin(readers) & (depth_class == number))
            if base == "embedding":  # rescoring reads the vectors of the candidates instead
                mine = mine.where((F.col("model") != "hybrid_serial") | ~F.col("rescore"))
            mine = mine.drop("model")
            find = dense_run if base == "embedding" else lexical_run
            options = {} if base == "embedding" else {"model": base}
            run = find(corpus, mine, depth, shared=True, **options)
            bases[base] = bases[base].unionByName(run) if base in bases else run
    if not bases:
        return limits.where("false").select(
            "query_id", F.col("asked").alias("model"), *[F.lit(None).cast("double").alias(c) for c in ("doc_id", "score", "rank")]
        )
    found = merge_runs(bases).join(limits, "query_id").where(F.col("rank") <= F.col("__need")).drop("__need")
    found = cut_lineage(found, "runs")
    return _assemble(corpus, requests, found, deepest, serial)


def _assemble(corpus: Corpus, requests: DataFrame, found: DataFrame, deepest: dict[str, int], serial: list[bool]) -> DataFrame:
    """The lists asked for, from base runs with ``asked`` and the options of their request."""
    cut = F.col("rank") <= F.col("top_k")
    parts = [found.where((F.col("model") == F.col("asked")) & cut).select("query_id", "model", *COLUMNS[1:])]
    limits = found.select("query_id", "top_k").distinct()

    def answered(run: DataFrame, model: str) -> DataFrame:
        run = run.join(limits, "query_id").where(cut)
        return run.select("query_id", F.lit(model).alias("model"), *COLUMNS[1:])

    stage = found.where((F.col("asked") == "hybrid_serial") & (F.col("rank") <= F.col("first_stage")))
    if True in serial:
        mine = requests.where((F.col("model") == "hybrid_serial") & F.col("rescore"))
        scored = rescored(corpus, mine, stage.where(F.col("rescore") & (F.col("model") == "bm25")))
        parts.append(answered(_rerank(scored, deepest["hybrid_serial"]).select(COLUMNS), "hybrid_serial"))
    if False in serial:
        lists = [stage.where(~F.col("rescore") & (F.col("model") == m)) for m in ("bm25", "embedding")]
        dense = lists[1].select(COLUMNS)
        parts.append(answered(serial_from(lists[0], dense, deepest["hybrid_serial"]), "hybrid_serial"))
    if "hybrid_parallel" in deepest:
        stage = found.where((F.col("asked") == "hybrid_parallel") & (F.col("rank") <= 2 * F.col("top_k")))
        for method in ("rrf", "linear"):
            lists = stage.where(F.col("fusion_method") == method).select("model", *COLUMNS)
            fused = fuse(lists, ["query_id"], list(READERS), method, None, deepest["hybrid_parallel"])
            parts.append(answered(fused, "hybrid_parallel"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def answer(
    corpus: Corpus, requests: DataFrame, dictionary: DataFrame | Speller, synonyms: DataFrame, history: DataFrame | None = None
) -> DataFrame:
    """The whole search: refine each request by its flags, route it, and attach the results."""
    refined = refine(requests, corpus.index, corpus.documents, dictionary, synonyms, history)
    refined = cut_lineage(refined, "refined")
    asked = refined.drop("tokens").withColumnRenamed("expanded_tokens", "tokens")
    return responses(refined, route(corpus, asked), corpus.documents)


def with_text(run: DataFrame, documents: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Add the document text as ``snippet``, null where there is none or it is empty.

    Of equal ids the last text by ``ordinal`` that is not blank is attached, the greatest text if
    there is no order, so that a result is never multiplied. Only ids travel until the lists are cut;
    the text joins last.
    """
    keys = ["dataset", "doc_id"] if "dataset" in run.columns else ["doc_id"]
    documents = with_dataset(documents) if "dataset" in keys else documents
    order = [ordinal] if ordinal else []
    run = cut_lineage(run, "results")
    texts = wanted_rows(documents.select(*keys, "text", *order), run.select(keys).distinct(), keys)
    if ordinal:
        texts = document_lookup(texts, ordinal, keys).select(*keys, F.col("text").alias("snippet"))
    else:
        filled = F.when(F.col("text") != "", F.col("text"))
        texts = texts.groupBy(keys).agg(F.max(filled).alias("snippet"))
    return run.join(texts, keys, "left")


def responses(requests: DataFrame, run: DataFrame, documents: DataFrame, ordinal: str | None = None) -> DataFrame:
    """One row per request: the query, its corrected and expanded form, and the results.

    ``results`` is an array in rank order; a request without results has an empty one.
    """
    entry = F.struct(
        F.col("rank"), F.col("doc_id"), output_score(F.col("score")).alias("score"), F.col("snippet")
    )
    run = run.select(COLUMNS)
    if "dataset" in requests.columns and "dataset" in documents.columns:
        run = run.join(requests.select("query_id", "dataset"), "query_id")
    found = with_text(run, documents, ordinal).groupBy("query_id").agg(
        F.array_sort(F.collect_list(entry)).alias("results"), F.count("*").alias("total_results")
    )
    optional = {
        "corrected": "corrected_query", "prf_query": "expanded_query", "suggestions": "suggestions", "model": "model_used",
    }
    shown = [F.col(c).alias(name) for c, name in optional.items() if c in requests.columns]
    rows = requests.select("query_id", F.col("text").alias("query"), *shown)
    return rows.join(found, "query_id", "left").withColumn(
        "total_results", F.coalesce("total_results", F.lit(0).cast("long"))
    )
