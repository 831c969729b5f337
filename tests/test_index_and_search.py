import math

import pytest
from pyspark.sql import functions as F

from termlight.operators import dense, index, joins, lexical, ranking
from termlight.operators.analyze import plain_tokens
from termlight.plans import search

TEXTS = [
    (1, "alpha beta beta gamma", "x"),
    (2, "beta delta", "x"),
    (3, "gamma gamma gamma epsilon", "x"),
    (4, "the of", "x"),
    (5, "", "x"),
    (1, "alpha zeta", "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, dataset string")


@pytest.fixture(scope="module")
def built(docs):
    return index.build_index(docs)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_postings_and_statistics(built):
    found = rows(built.postings.where("dataset = 'x'"), "doc_id", "term", "tf", "dl")
    assert (1, "beta", 2, 4) in found and (4, "the", 1, 2) in found and len(found) == 9
    assert [r[:2] for r in rows(built.stats, "dataset", "doc_count", "avg_dl")] == [("x", 4), ("y", 1)]
    assert rows(built.vocab.where("term = 'alpha'"), "dataset", "df", "cf") == [("x", 1, 1), ("y", 1, 1)]


def test_saved_index_reopens(spark, built):
    again = index.open_index(spark, built.path)
    assert rows(again.postings, "dataset", "doc_id", "term") == rows(
        built.postings, "dataset", "doc_id", "term"
    )


def test_lookups(spark, built):
    terms = spark.createDataFrame([("beta",), ("nowhere",)], "term string")
    assert rows(index.lookup_postings(built.postings, terms), "doc_id", "tf") == [(1, 2), (2, 1)]
    ids = spark.createDataFrame([(2, "x"), (9, "x")], "doc_id long, dataset string")
    assert rows(index.lookup_doc_lengths(ids, built.lengths), "doc_id", "dl") == [(2, 2), (9, 0)]


def test_skip_list_and_reasons(spark, docs):
    listed = spark.createDataFrame([(2,)], "doc_id long")
    kept = index.build_postings(docs.where("dataset = 'x'"), skip_ids=listed)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {1, 3, 4}
    tokens = plain_tokens(docs.where("dataset = 'x'"))
    counts = rows(index.skip_counts(tokens, listed), "reason", "docs")
    assert counts == [("kept", 3), ("listed_empty", 1), ("no_tokens", 1)]


def test_keep_last(spark):
    rows_ = spark.createDataFrame([(1, "a", 0), (1, "b", 2), (1, "c", 1), (2, "d", 0)], "k int, t string, o int")
    assert rows(index.keep_last(rows_, ["k"], "o"), "k", "t") == [(1, "b"), (2, "d")]


def test_stemmed_postings_add_up(spark):
    docs = spark.createDataFrame([(1, "running runs run")], "doc_id int, text string")
    assert rows(index.build_postings(docs, mode="stem"), "term", "tf", "dl") == [("run", 3, 3)]


def test_positive_idf_golden(spark):
    found = spark.range(1).select(F.lit(3).alias("doc_count"), F.lit(1).alias("df"))
    idf = found.select(index.positive_idf()).first()[0]
    assert idf * (2 * 2.5) / (2 + 1.5) == pytest.approx(1.401185, abs=1e-6)


def queries(spark, *texts, dataset="x"):
    table = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    return plain_tokens(table.withColumn("dataset", F.lit(dataset)))


def okapi_by_hand(query, k1=1.5, b=0.75):
    docs = {1: ["alpha", "beta", "beta", "gamma"], 2: ["beta", "delta"],
            3: ["gamma"] * 3 + ["epsilon"], 4: ["of", "the"]}
    terms = {t for d in docs.values() for t in d}
    df = {t: sum(t in d for d in docs.values()) for t in terms}
    idf = {t: math.log(4 - df[t] + 0.5) - math.log(df[t] + 0.5) for t in terms}
    mean = sum(idf.values()) / len(idf)
    idf = {t: 0.25 * mean if v < 0 else v for t, v in idf.items()}
    avg = sum(len(d) for d in docs.values()) / 4
    scores = {
        i: sum(idf.get(t, 0) * d.count(t) * (k1 + 1) / (d.count(t) + k1 * (1 - b + b * len(d) / avg))
               for t in query)
        for i, d in docs.items()
    }
    ranked = sorted(((round(s, 6), i) for i, s in scores.items() if s > 0), key=lambda x: (-x[0], x[1]))
    return [(i, s) for s, i in ranked]


def run_of(run, query_id=0):
    found = run.where(F.col("query_id") == query_id).orderBy("rank").collect()
    return [(r.doc_id, r.score) for r in found]


def test_okapi_matches_the_formula(spark, built):
    asked = queries(spark, "alpha beta beta", "gamma delta", "unknown words", "")
    run = lexical.bm25(built, asked)
    for i, tokens in enumerate([["alpha", "beta", "beta"], ["gamma", "delta"], [], []]):
        assert run_of(run, i) == [(d, pytest.approx(s, abs=2e-6)) for d, s in okapi_by_hand(tokens)]


def test_collections_stay_apart(spark, built):
    assert [d for d, _ in run_of(lexical.bm25(built, queries(spark, "zeta", dataset="x")))] == []
    assert [d for d, _ in run_of(lexical.bm25(built, queries(spark, "zeta", dataset="y"), variant="plus_one"))] == [1]


@pytest.mark.parametrize("variant", ["okapi", "plus_one"])
def test_large_query_tables_give_the_same_run(spark, built, variant):
    asked = queries(spark, "alpha beta beta", "gamma delta", "epsilon of beta")
    small = lexical.bm25(built, asked, variant=variant)
    large = lexical.bm25(built, asked, variant=variant, max_rows=0)
    assert rows(small, "query_id", "doc_id", "score", "rank") == rows(large, "query_id", "doc_id", "score", "rank")
    for kind in ("cosine", "log_log"):
        small, large = (lexical.tfidf(built, asked, variant=kind, max_rows=m) for m in (1000, 0))
        assert rows(small, "query_id", "doc_id", "score") == rows(large, "query_id", "doc_id", "score")


def test_parameters_per_query(spark, built):
    asked = queries(spark, "alpha beta").withColumns({"k1": F.lit(0.5), "b": F.lit(0.0)})
    by_column = lexical.bm25(built, asked)
    by_argument = lexical.bm25(built, asked.drop("k1", "b"), k1=0.5, b=0.0)
    assert run_of(by_column) == run_of(by_argument)
    assert run_of(by_column) == [(d, pytest.approx(s, abs=2e-6)) for d, s in okapi_by_hand(["alpha", "beta"], 0.5, 0.0)]


def test_no_length_effect_without_b(spark):
    docs = spark.createDataFrame([(1, "apple pear"), (2, "apple " + "plum " * 50), (3, "fig"), (4, "kiwi"), (5, "lime")], "doc_id int, text string")
    run = lexical.bm25(index.build_index(docs), queries(spark, "apple", dataset="default"), b=0.0)
    assert len({s for _, s in run_of(run)}) == 1


def test_top_k_is_a_prefix(spark, built):
    asked = queries(spark, "alpha beta gamma")
    assert run_of(lexical.tfidf(built, asked, 2)) == run_of(lexical.tfidf(built, asked, 3))[:2]


def test_log_log_golden(spark):
    docs = spark.createDataFrame([(i, "apple") for i in range(4)], "doc_id int, text string")
    run = lexical.tfidf(index.build_index(docs), queries(spark, "apple", dataset="default"), variant="log_log")
    assert [s for _, s in run_of(run)] == [pytest.approx(0.049793, abs=1e-6)] * 4


def test_unknown_variants_are_errors(spark, built):
    asked = queries(spark, "alpha")
    with pytest.raises(ValueError):
        lexical.bm25(built, asked, variant="other")
    with pytest.raises(ValueError):
        lexical.tfidf(built, asked, variant="other")


def test_lookup_join_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_SHARE", 3)
    left = spark.range(300).select("id", F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"))
    left = left.unionByName(spark.createDataFrame([(999, None)], "id long, key string"))
    right = left.where("key is not null").select("key").distinct().withColumn("v", F.length("key"))
    for how in ("inner", "left"):
        plain = left.join(right, "key", how)
        assert rows(joins.lookup_join(left, right, ["key"], how, max_rows=0).fillna("-").fillna(0), "id", "key", "v") == rows(plain.fillna("-").fillna(0), "id", "key", "v")


def test_vectors_exact_on_both_paths(spark):
    docs = spark.createDataFrame([(i, [math.cos(i), math.sin(i), (i % 3) / 7.0]) for i in range(300)], "doc_id int, embedding array<double>")
    docs = docs.unionByName(docs.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 1000)).repartition(5)
    asked = spark.createDataFrame([(i, [1.0, i / 10.0, -0.5]) for i in range(30)], "query_id int, embedding array<double>")
    from termlight.functions.vectors import dot

    pairs = asked.join(docs.withColumnRenamed("embedding", "d"), how="cross")
    scored = pairs.withColumn("score", dot(F.col("embedding"), F.col("d"))).drop("embedding", "d")
    expected = rows(ranking.top_k(scored, ["query_id"], 7), "query_id", "doc_id", "rank")
    assert rows(dense.nearest(docs, asked, 7), "query_id", "doc_id", "rank") == expected
    assert rows(dense.nearest(docs, asked, 7, query_block=4), "query_id", "doc_id", "rank") == expected


def test_vector_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(f"d{i:02}", [1.0, 0.0]) for i in range(50)], "doc_id string, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    assert [r.doc_id for r in dense.nearest(docs.repartition(4), asked, 3).orderBy("rank").collect()] == ["d00", "d01", "d02"]


def test_zero_vector_stays(spark):
    rows_ = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<double>")
    assert [r[0] for r in dense.unit_vectors(rows_).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def run_table(spark, items, query_id="q"):
    return spark.createDataFrame([(query_id, d, float(s), i + 1) for i, (d, s) in enumerate(items)], "query_id string, doc_id string, score double, rank long")


def test_serial_hybrid_golden(spark):
    lexical_run = run_table(spark, [("a", 2), ("b", 1)])
    dense_run = run_table(spark, [("c", 0.9), ("b", 0.8)])
    assert rows(search.serial_from(lexical_run, dense_run), "doc_id", "score", "rank") == [("b", 0.8, 1)]


def test_router_rejects_unknown_models(spark, built, docs):
    vectors = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, embedding array<double>")
    where = search.Corpus(built, vectors, docs)
    asked = queries(spark, "alpha").withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0)))
    with pytest.raises(ValueError):
        search.run_model(where, asked, "other")
    with pytest.raises(Exception, match="unknown model"):
        search.route(where, asked.withColumn("model", F.lit("other"))).collect()


def test_router_honours_depth(spark, built, docs):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "doc_id long, embedding array<double>")
    where = search.Corpus(built, vectors, docs)
    asked = queries(spark, "alpha beta", "beta gamma").withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0)))
    asked = asked.withColumn("model", F.when(F.col("query_id") == 0, "bm25").otherwise("embedding"))
    run = search.route(where, asked.withColumn("top_k", F.lit(1)))
    assert rows(run, "query_id", "model", "rank") == [(0, "bm25", 1), (1, "embedding", 1)]


def test_response_keeps_queries_without_results(spark, built, docs):
    asked = queries(spark, "alpha", "nothing here")
    run = lexical.bm25(built, asked)
    found = search.responses(asked, run, docs.where("dataset = 'x'").drop("dataset")).orderBy("query_id").collect()
    assert [r.total_results for r in found] == [1, 0]
    assert found[0].results[0].snippet == "alpha beta beta gamma"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("reopened", [False, True])
def test_scores_are_complete_without_a_shuffle(spark, built, no_auto_broadcast, reopened):
    """Behind the query terms, only the trimmed lists are exchanged; the candidates never are."""
    used = index.open_index(spark, built.path) if reopened else built
    for run in (lexical.bm25, lexical.tfidf):
        plan = plan_of(run(used, queries(spark, "alpha beta")))
        above_scores = plan.split("partial_sum")[0]
        assert above_scores.count("Exchange hashpartitioning") == 1
        assert above_scores.count("WindowGroupLimit") == 2


def test_few_terms_are_named_in_the_scan(spark, built):
    assert "In(term" in plan_of(lexical.bm25(built, queries(spark, "alpha beta"))) or "EqualTo(term" in plan_of(
        lexical.bm25(built, queries(spark, "alpha beta")))


def test_duplicate_ids_keep_the_last(spark):
    docs = spark.createDataFrame([(1, "old words", 0), (1, "new text", 1)], "doc_id int, text string, at int")
    assert rows(index.build_postings(docs, ordinal="at"), "term") == [("new",), ("text",)]


def test_hybrids_stay_in_their_collection(spark, built, docs):
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "x"), (1, [0.6, 0.8], "y")],
        "doc_id long, embedding array<double>, dataset string")
    where = search.Corpus(built, vectors, docs)
    asked = queries(spark, "alpha beta", dataset="x").unionByName(
        queries(spark, "alpha zeta", dataset="y").withColumn("query_id", F.lit(1)))
    asked = asked.withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0)))
    assert rows(search.dense_run(where, asked, 5), "query_id", "doc_id", "score") == [(0, 1, 1.0), (0, 2, 0.0), (1, 1, 0.6)]
    for rescore in (False, True):
        # "beta" is in half of the texts of x, so its Okapi weight is 0 and text 2 is no candidate.
        run = search.hybrid_serial(where, asked, rescore=rescore)
        assert rows(run, "query_id", "doc_id", "score") == [(0, 1, 1.0)]
    runs = search.all_runs(where, asked)
    assert {r.model for r in runs.select("model").distinct().collect()} == set(search.MODELS)
    found = search.responses(asked, search.dense_run(where, asked, 5), docs).orderBy("query_id").collect()
    assert [[e.snippet for e in r.results] for r in found] == [["alpha beta beta gamma", "beta delta"], ["alpha zeta"]]


def test_requests_keep_their_depth_and_defaults(spark, docs, built):
    vectors = spark.createDataFrame([(i, [1.0, i / 10.0]) for i in range(1, 5)], "doc_id long, embedding array<double>")
    where = search.Corpus(built, vectors, docs)
    asked = queries(spark, *["gamma delta epsilon"] * 3).withColumn("embedding", F.array(F.lit(1.0), F.lit(0.5)))
    depth = F.when(F.col("query_id") == 0, 1).when(F.col("query_id") == 1, 25)
    method = F.when(F.col("query_id") == 1, "linear")
    asked = asked.withColumns({"model": F.lit("hybrid_parallel"), "top_k": depth, "fusion_method": method})
    run = search.route(where, asked)
    assert run_of(run, 0) == run_of(search.hybrid_parallel(where, asked.where("query_id = 0"), 1))
    assert run_of(run, 1) == run_of(search.hybrid_parallel(where, asked.where("query_id = 1"), 25, "linear"), 1)
    assert run_of(run, 2) == run_of(search.hybrid_parallel(where, asked.where("query_id = 2"), 10), 2)


def test_serial_requests_deeper_than_the_first_stage(spark):
    """140 are asked for and 150 found: all 140 come, by default as by request; the intersection is a choice."""
    docs = spark.createDataFrame([(i, "alpha beta" if i < 150 else "gamma delta") for i in range(400)], "doc_id long, text string")
    vectors = spark.createDataFrame([(i, [1.0, i / 100.0]) for i in range(400)], "doc_id long, embedding array<double>")
    where = search.Corpus(index.build_index(docs), vectors, docs)
    asked = queries(spark, *["alpha"] * 3).drop("dataset").withColumn("embedding", F.array(F.lit(0.0), F.lit(1.0)))
    best = [(139 - i, i + 1) for i in range(140)]
    run = search.hybrid_serial(where, asked.where("query_id = 0"), 140)
    assert sorted(rows(run, "doc_id", "rank"), key=lambda r: r[1]) == best
    requests = asked.withColumns({
        "model": F.lit("hybrid_serial"), "top_k": F.when(F.col("query_id") < 2, 140).otherwise(10),
        "first_stage": F.when(F.col("query_id") == 1, 150), "rescore": F.col("query_id") < 2,
    })
    run = search.route(where, requests)
    mine = [sorted(rows(run.where(F.col("query_id") == q), "doc_id", "rank"), key=lambda r: r[1]) for q in range(3)]
    assert mine == [best, [(149 - i, i + 1) for i in range(140)], []]


def test_skip_list_of_one_collection(spark):
    tokens = spark.createDataFrame([(1, "x", ["a"]), (1, "y", ["a"])], "doc_id long, dataset string, tokens array<string>")
    listed = spark.createDataFrame([(1, "x")], "doc_id long, dataset string")
    assert rows(index.skip_counts(tokens, listed), "reason", "docs") == [("kept", 1), ("listed_empty", 1)]


def test_the_last_text_of_an_id_is_attached(spark):
    docs = spark.createDataFrame(
        [(1, "z first", 0), (1, "a last", 2), (1, "m", 1), (2, "kept", 0), (2, " ", 1), (3, "", 0)], "doc_id long, text string, at int"
    )
    run = spark.createDataFrame([("q", d, 1.0, d) for d in (1, 2, 3, 4)], "query_id string, doc_id long, score double, rank long")
    found = rows(search.with_text(run, docs, "at").fillna("-"), "doc_id", "snippet")
    assert found == [(1, "a last"), (2, "kept"), (3, "-"), (4, "-")]
    assert dict(rows(search.with_text(run, docs).fillna("-"), "doc_id", "snippet"))[1] == "z first"


def test_a_deep_request_leaves_the_others_shallow(monkeypatch, spark, built, docs):
    """Base runs are made by depth class; every request still gets its own depth."""
    depths, run = [], search.lexical_run

    def watched(corpus, requests, k, **options):
        depths.append((requests.count(), k))
        return run(corpus, requests, k, **options)

    monkeypatch.setattr(search, "lexical_run", watched)
    asked = queries(spark, *["alpha delta epsilon"] * 4).withColumn("model", F.lit("bm25"))
    asked = asked.withColumn("top_k", F.element_at(F.array(F.lit(1), F.lit(2), F.lit(5000), F.lit(150)), F.col("query_id") + 1))
    corpus = search.Corpus(built, None, docs)
    found = search.route(corpus, asked).groupBy("query_id").count()
    assert sorted(depths) == [(1, 150), (1, 5000), (2, 2)]
    assert rows(found, "query_id", "count") == [(0, 1), (1, 2), (2, 3), (3, 3)]


def test_equal_requests_are_searched_once(monkeypatch, spark, built, docs):
    """Each base model meets a text, its parameters and a vector once; every request gets its list, cut to its depth."""
    met = {}
    for name in ("bm25", "tfidf", "nearest"):
        def watched(where, asked, *rest, name=name, run=getattr(search, name), **options):
            met[name] = met.get(name, 0) + asked.count()
            return run(where, asked, *rest, **options)

        monkeypatch.setattr(search, name, watched)
    vectors = spark.createDataFrame([(i, [1.0, i / 10.0]) for i in range(1, 5)], "doc_id long, embedding array<double>")
    where = search.Corpus(built, vectors, docs)
    asked = queries(spark, *["alpha delta epsilon"] * 6, "alpha beta").withColumn("embedding", F.array(F.lit(1.0), F.lit(0.5)))
    model = F.when(F.col("query_id") == 0, "bm25").when(F.col("query_id") == 1, "hybrid_serial").otherwise("hybrid_parallel")
    asked = asked.withColumns({"model": model, "top_k": F.when(F.col("query_id") == 3, 1).otherwise(10),
                               "k1": F.when(F.col("query_id") == 4, 0.5)})
    run = search.route(where, asked)
    assert met == {"bm25": 3, "tfidf": 2, "nearest": 1}
    plain = asked.drop("model", "top_k", "k1")
    assert run_of(run, 0) == run_of(search.run_model(where, plain, "bm25"), 0)
    assert run_of(run, 1) == run_of(search.run_model(where, plain, "hybrid_serial"), 1)
    for q, depth in ((2, 10), (3, 1), (5, 10), (6, 10)):
        assert run_of(run, q) == run_of(search.hybrid_parallel(where, plain, depth), q)


def test_results_are_not_multiplied(spark):
    run = run_table(spark, [("a", 2)])
    twice = spark.createDataFrame([("a", "one"), ("a", "two")], "doc_id string, text string")
    assert search.with_text(run, twice).count() == 1


def test_plain_projections_do_not_shuffle(spark, tiny):
    from termlight.plans import registered

    for name in ("processed_docs", "text_normalize", "text_tokens", "text_stopwords", "text_fallback", "empty_docs", "feedback_words"):
        assert "Exchange" not in plan_of(registered.QUERIES[name](spark, tiny)), name


def test_parts_follow_the_size_of_the_text(spark, monkeypatch):
    """A task or bucket holds a bounded amount of text, also beyond the session's number of partitions."""
    monkeypatch.setattr(index, "TEXT_BYTES", 200)
    docs = spark.createDataFrame([(i, "alpha beta gamma delta") for i in range(300)], "doc_id int, text string")
    assert index.text_partitions(docs) == 33 and index.text_partitions(docs, 40) == 40
    assert index.text_partitions(docs.where("doc_id < 0"), 4) == 4
    dealt = index.build_postings(docs)
    assert dealt.rdd.getNumPartitions() == 33
    built = index.build_index(docs)
    assert spark.read.parquet(f"{built.path}/layout").first().buckets == 33
    assert rows(built.postings, "doc_id", "term", "tf") == rows(dealt, "doc_id", "term", "tf")


def test_lookup_join_takes_known_counts(spark):
    """Known counts are not counted again, and beyond the broadcast bound no row is sorted."""
    left = spark.range(400).selectExpr("id", "IF(id < 200, 0, id) AS key")
    right = spark.range(500).selectExpr("id AS key", "id * 2 AS v")
    counts = spark.createDataFrame([(0, 200)], "key long, __n long")
    found = joins.lookup_join(left, right, ["key"], max_rows=0, counts=counts)
    assert rows(found, "id", "key", "v") == rows(left.join(right, "key"), "id", "key", "v")
    plan = plan_of(found)
    assert "ShuffledHashJoin" in plan and "HashAggregate" not in plan
