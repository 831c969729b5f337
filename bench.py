"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads). ``index_build`` is the offline half;
the searches read the index it wrote. Every query is run to the last row. A few queries on the
smallest tables go first, untimed: they start the Python workers and fill the JVM's code cache,
which would otherwise take most of the time at these scales.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termlight.plans import registered  # noqa: E402
from termlight.session import local_session  # noqa: E402

HEADLINE = [
    "processed_docs", "postings", "corpus_stats", "bm25_okapi", "bm25_plus_one", "bm25_param_sweep",
    "tfidf_cosine", "tfidf_loglog", "dense_topk", "hybrid_serial", "hybrid_parallel_rrf",
    "hybrid_parallel_linear", "search_response", "prf_expand", "spell_correct", "synonym_expand",
    "query_suggest", "entity_gazetteer", "sentiment_lexicon", "lemma_postings", "eval_models",
    "stream_index", "model_router", "query_refine", "search_pipeline", "tfidf_weights", "bm25_idf",
    "bm25_shelves", "bm25_pruned", "dense_pivots", "stem_vocabulary",
]
WARM_UP = ["processed_docs", "hybrid_parallel_rrf", "search_response", "sentiment_lexicon"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "termlight-bench")
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in WARM_UP:
        run(registered.QUERIES[name](spark, small if os.path.isdir(small) else folder))
    times = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)

    timed("index_build", lambda: registered.session_index(spark, folder))
    for name in HEADLINE:
        query = registered.QUERIES[name]
        timed(name, lambda: run(query(spark, folder)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
