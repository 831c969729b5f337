import pytest
from pyspark.sql import functions as F

from termlight.operators import evaluate, fusion, ranking
from termlight.plans.search import MODELS


def runs(spark, **lists):
    rows = [("q", m, d, float(s), i + 1) for m, items in lists.items() for i, (d, s) in enumerate(items)]
    return spark.createDataFrame(rows, "query_id string, model string, doc_id string, score double, rank long")


def scores(df):
    return {r.doc_id: round(r.score, 6) for r in df.collect()}


def test_reciprocal_rank_golden(spark):
    table = runs(spark, one=[("a", 9), ("b", 8)], two=[("b", 1), ("c", 0.5)])
    assert scores(fusion.reciprocal_rank(table, ["query_id"])) == {"b": 0.032522, "a": 0.016393, "c": 0.016129}
    swapped = runs(spark, two=[("b", 1), ("c", 0.5)], one=[("a", 9), ("b", 8)])
    first, second = (fusion.fuse(t, ["query_id"], ["one", "two"]).collect() for t in (table, swapped))
    assert [(r.doc_id, r.rank) for r in first] == [(r.doc_id, r.rank) for r in second]


def test_linear_golden(spark):
    table = runs(spark, one=[("a", 4), ("b", 2)], two=[("b", 3)])
    found = fusion.linear(table, ["query_id"], ["one", "two", "three"])
    assert scores(found) == {"b": 0.5, "a": 0.333333}
    weighted = fusion.linear(table, ["query_id"], ["one", "two"], {"one": 1.0, "two": 0.0})
    assert scores(weighted) == {"a": 1.0, "b": 0.5}


def test_unknown_fusion_is_an_error(spark):
    with pytest.raises(ValueError):
        fusion.fuse(runs(spark, one=[("a", 1)]), ["query_id"], ["one"], "other")


def test_normalize_and_rank_golden(spark):
    run = spark.createDataFrame([("q1", "doc1", 10.0), ("q1", "doc2", 5.0), ("q1", "doc3", 2.0)], "query_id string, doc_id string, score double")
    ranked = ranking.format_run(ranking.top_k(run, ["query_id"], 10))
    assert [(r.query_id, r.doc_id, r.rank) for r in ranked.orderBy("rank").collect()] == [("q1", "doc1", 1), ("q1", "doc2", 2), ("q1", "doc3", 3)]
    assert scores(ranking.max_normalize(run, ["query_id"])) == {"doc1": 1.0, "doc2": 0.5, "doc3": 0.2}
    zero = run.withColumn("score", F.lit(0.0))
    assert set(scores(ranking.max_normalize(zero, ["query_id"])).values()) == {0.0}
    negative = run.withColumn("score", -F.col("score"))
    assert scores(ranking.max_normalize(negative, ["query_id"])) == {"doc1": 5.0, "doc2": 2.5, "doc3": 1.0}


def test_full_depth_ranks_with_a_hot_list(spark):
    lists = spark.range(5000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 7)).alias("query_id"),
        F.col("id").alias("doc_id"), (F.col("id") * 7919 % 101).cast("double").alias("score"))
    from pyspark.sql import Window

    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    expected = lists.withColumn("rank", F.row_number().over(window))
    found = ranking.rank_all(lists, ["query_id"])
    both = found.join(expected.withColumnRenamed("rank", "r"), ["query_id", "doc_id"])
    assert both.count() == 5000 and both.where("rank <> r").count() == 0


def judged(spark, *pairs):
    return spark.createDataFrame([(*p, 1) for p in pairs], "query_id string, doc_id string, relevance int")


def test_metrics_golden(spark):
    run = runs(spark, one=[("d1", 3), ("d2", 2), ("d3", 1)]).drop("model")
    row = evaluate.query_metrics(run, judged(spark, ("q", "d1"), ("q", "d3"))).first()
    assert (row.precision, row.recall) == (0.2, 1.0)
    assert row.ap == pytest.approx(0.833333, abs=1e-6) and row.ndcg == pytest.approx(0.919721, abs=1e-6)
    empty = evaluate.query_metrics(run, judged(spark, ("other", "d1"))).first()
    assert (empty.recall, empty.ap, empty.ndcg) == (0.0, 0.0, 0.0)


def test_compare_models_golden(spark):
    lists = {"bm25": ["doc1", "doc2", "doc3"], "tfidf": ["doc2", "doc3", "doc1"]}
    rows = [(m, d, i + 1) for m, docs in lists.items() for i, d in enumerate(docs)]
    table = spark.createDataFrame(rows, "model string, doc_id string, rank long")
    qrels = spark.createDataFrame([("doc1", 1), ("doc2", 2), ("doc3", 0)], "doc_id string, relevance int")
    found = {r.model: r for r in evaluate.compare_models(table, qrels).collect()}
    assert found["bm25"]["MAP"] == 1.0 and found["tfidf"]["MAP"] == pytest.approx(0.833333, abs=1e-6)
    assert all(r["P@10"] == 0.2 and r["Recall"] == 1.0 for r in found.values())


def test_full_depth_average_precision(spark):
    run = runs(spark, one=[(f"d{i:02}", 100 - i) for i in range(30)]).drop("model")
    qrels = judged(spark, ("q", "d00"), ("q", "d20"))
    assert evaluate.query_metrics(run, qrels).first().ap == pytest.approx(0.5)
    assert evaluate.query_metrics(run, qrels, full_ap=True).first().ap == pytest.approx((1 + 2 / 21) / 2)


def test_models_average_over_judged_queries(spark):
    run = runs(spark, bm25=[("d1", 2.0)])
    asked = spark.createDataFrame([("q",), ("r",), ("s",)], "query_id string")
    table = evaluate.evaluate_models(run, asked, judged(spark, ("q", "d1"), ("r", "d9")), MODELS)
    found = {r.Model: r for r in table.collect()}
    assert found["bm25"]["MAP"] == 0.5 and found["tfidf"]["MAP"] == 0.0 and len(found) == 5
    limited = evaluate.evaluate_models(run, asked, judged(spark, ("r", "d9")), ["bm25"], limit=1)
    assert limited.first()["MAP"] == 0.0


def test_every_judged_query_counts(spark):
    asked = spark.range(5200).select(F.col("id").cast("string").alias("query_id"))
    late = judged(spark, *[(str(i), "d") for i in range(5001, 5200)])
    run = asked.select(F.lit("bm25").alias("model"), "query_id", F.lit("d").alias("doc_id"), F.lit(1).alias("rank"))
    assert evaluate.evaluate_models(run, asked, late, ["bm25"]).first()["MAP"] == 1.0
