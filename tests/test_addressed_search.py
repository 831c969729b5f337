"""Searches that open only what they need: shelves of terms, blocks of queries, documents and vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from termlight.operators import dense, impacts, index, lexical, pivots
from termlight.operators.analyze import plain_tokens
from termlight.sources import vectors as files


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


RUN = ["query_id", "dataset", "doc_id", "score", "rank"]


def scans(df, relation="postings"):
    """Files and rows that the scans of a table read, by the metrics of the plan that was run."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "FileSourceScanExec" and f"_{relation}_" in node.toString():
            found.append((node.metrics().apply("numFiles").value(), node.metrics().apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return [sum(n) for n in zip(*found, strict=True)]


def corpus(n=600, seed=1):
    """Documents with many words in a few of them and a few words in most, of very unequal lengths."""
    r = random.Random(seed)
    word = lambda: f"w{'abcdefghij'[int(r.random() ** 3 * 10)]}{chr(97 + int(r.random() ** 2 * 26))}{chr(97 + r.randrange(26))}"
    out = []
    for i in range(n):
        words = [word() for _ in range(r.choice([3, 8, 20, 60, 150]))]
        out.append((i, " ".join(words + [words[0]] * r.choice([0, 0, 1, 9])), "xy"[i % 3 == 0]))
    return out + [(n, "", "x"), (n + 1, "of the", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, dataset string")


@pytest.fixture(scope="module")
def built(docs):
    return index.build_index(docs, buckets=4)


@pytest.fixture(scope="module")
def asked(spark):
    r = random.Random(2)
    texts = [" ".join(r.sample(t.split() or ["x"], min(4, len(t.split()) or 1))) for _, t, _ in r.sample(corpus(), 40)]
    table = spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in enumerate([*texts, "", "unknown words"])], "query_id int, text string, dataset string")
    return plain_tokens(table).cache()


@pytest.fixture(scope="module")
def expected(built, asked):
    return {v: rows(lexical.bm25(built, asked, variant=v), *RUN) for v in ("okapi", "plus_one")}


@pytest.mark.parametrize("reopened", [False, True])
def test_few_shelves_are_opened(spark, docs, built, asked, expected, reopened):
    """The 40 queries open a part of the files and read a part of the postings; one query much less."""
    shelved = index.build_index(docs, buckets=2, shelves=256)
    if reopened:
        shelved = index.open_index(spark, shelved.path)
    total = shelved.postings.count()
    assert total == built.postings.count()
    run = lexical.bm25(shelved, asked)
    assert rows(run, *RUN) == expected["okapi"]
    files_read, postings_read = scans(run)
    assert files_read < 0.5 * 2 * 256 and postings_read < 0.7 * total
    run = lexical.bm25(shelved, asked.where("query_id = 1"))
    files_read, postings_read = scans(run)
    assert files_read <= 4 * 2 and postings_read < 0.1 * total
    assert rows(run, *RUN) == [r for r in expected["okapi"] if r[0] == 1]


def test_postings_of_terms_by_shelf(spark, docs, built):
    shelved = index.build_index(docs, buckets=2, shelves=64)
    terms = built.vocab.select("term").distinct().orderBy("term").limit(3)
    terms = terms.unionByName(spark.createDataFrame([("nowhere",)], "term string"))
    found = index.lookup_postings(shelved.postings, terms, shelves=64)
    assert rows(found, "dataset", "doc_id", "term", "tf") == rows(index.lookup_postings(built.postings, terms), "dataset", "doc_id", "term", "tf")
    assert scans(found)[0] <= 3 * 2 + 2


def test_searches_on_shelves_do_not_shuffle_candidates(spark, docs, asked):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shelved = index.build_index(docs, buckets=4, shelves=8)
        plan = lexical.bm25(shelved, asked)._jdf.queryExecution().executedPlan().toString()
        assert plan.split("partial_sum")[0].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("variant, max_rows", [("okapi", 60), ("plus_one", 60), ("plus_one", 0)])
def test_blocks_of_queries(monkeypatch, built, asked, expected, variant, max_rows):
    """Queries in several blocks, with those that have more terms than may be broadcast, or all, apart."""
    seen, score = [], lexical.score

    def watched(index, weighted, part, keys, few):
        seen.append(few)
        return score(index, weighted, part, keys, few)

    monkeypatch.setattr(lexical, "score", watched)
    assert rows(lexical.bm25(built, asked, variant=variant, max_rows=max_rows), *RUN) == expected[variant]
    if max_rows == 60:
        assert len(seen) > 3 and all(seen)


def test_blocks_of_queries_by_cosine(built, asked):
    for kind in ("cosine", "log_log"):
        whole, cut = (lexical.tfidf(built, asked, variant=kind, max_rows=m) for m in (10**6, 60))
        assert rows(whole, *RUN) == rows(cut, *RUN)


@pytest.mark.parametrize("variant, block_docs, k", [("okapi", 4, 1), ("okapi", 128, 10), ("plus_one", 4, 10), ("okapi", 4, 700)])
def test_pruned_run(built, asked, variant, block_docs, k):
    blocks = impacts.build_blocks(built, block_docs, buckets=4)
    assert rows(impacts.bm25_pruned(blocks, asked, k, variant=variant), *RUN) == rows(lexical.bm25(built, asked, k, variant=variant), *RUN)


def test_pruned_run_in_blocks_of_queries_and_with_parameters(built, asked):
    blocks = impacts.build_blocks(built, 8, buckets=4)
    pairs = F.explode(F.array(*[F.struct(F.lit(k1).alias("k1"), F.lit(b).alias("b")) for k1, b in ((0.5, 0.0), (3.0, 1.0), (1.2, 1.5))]))
    swept = asked.withColumn("p", pairs).select("*", "p.*").drop("p")
    keys = ["query_id", "k1", "b"]
    for rows_at_once, some in ((10**6, swept), (200, swept), (3, swept.where("query_id < 3"))):
        found = impacts.bm25_pruned(blocks, some, keys=keys, max_rows=rows_at_once)
        assert rows(found, *keys, *RUN[1:]) == rows(lexical.bm25(built, some, keys=keys), *keys, *RUN[1:])


def test_what_pruning_reads(spark, built, asked):
    """Every query reads some of its postings and no more; together they read a part."""
    blocks = impacts.build_blocks(built, 4, buckets=4)
    report = impacts.pruning_report(blocks, asked, k=3).collect()
    assert all(0 < r.blocks_read <= r.blocks and 0 < r.postings_read <= r.postings for r in report)
    assert sum(r.postings_read for r in report) < 0.7 * sum(r.postings for r in report)


def test_blocks_are_not_exchanged(spark, built, asked):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = impacts.bm25_pruned(impacts.build_blocks(built, 8, buckets=4), asked)
        run.collect()
        plan = run._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def vector_table(spark, n=800, seed=3, kind="long"):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    out = []
    for i in range(n):
        c = r.choice(centres)
        v = [x + r.gauss(0, 0.1) for x in c]
        length = math.sqrt(sum(x * x for x in v))
        out.append((i, [x / length for x in v], "xy"[i % 4 == 0]))
    out += [(n + i, out[5][1], "x") for i in range(300)]
    out += [(5000, [0.0] * 8, "x"), (5001, [9.0] * 8, "y"), (5002, None, "x")]
    table = spark.createDataFrame(out, "doc_id long, embedding array<double>, dataset string")
    return table.withColumn("doc_id", F.col("doc_id").cast(kind)).repartition(5)


VECTOR_RUN = ["query_id", "doc_id", "score", "rank"]


@pytest.mark.parametrize("kind, k, block_vectors, query_block", [("long", 1, 16, 100), ("string", 10, 16, 7), ("long", 400, 64, 100)])
def test_vectors_in_blocks(spark, kind, k, block_vectors, query_block):
    docs = vector_table(spark, kind=kind)
    queries = docs.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    blocks = pivots.build_vector_blocks(docs, pivots=30, block_vectors=block_vectors)
    assert blocks.table.agg(F.sum("vectors")).first()[0] == docs.where("embedding is not null").count()
    assert blocks.table.agg(F.max("vectors")).first()[0] <= 2 * block_vectors + 16
    seen = []
    run = pivots.nearest_in_blocks(blocks, queries, k, query_block=query_block, seen=seen)
    assert rows(run, *VECTOR_RUN) == rows(dense.nearest(docs, queries, k), *VECTOR_RUN)
    if k == 1:
        one = pivots.nearest_in_blocks(blocks, queries.limit(1), k, seen=seen)
        assert one.count() == 1 and seen[-1].count() < 0.5 * blocks.table.count()


def test_no_vectors_and_no_queries(spark):
    docs = vector_table(spark, 50)
    queries = docs.limit(4).withColumnRenamed("doc_id", "query_id")
    for d, q in ((docs.limit(0), queries), (docs, queries.limit(0))):
        assert pivots.nearest_in_blocks(pivots.build_vector_blocks(d), q).count() == 0
        assert dense.nearest(d, q).count() == 0


def test_running_lists(spark):
    """Any order of blocks gives the k best with ties by name."""
    import numpy as np

    r = np.random.default_rng(1)
    scores, names = np.round(r.random((7, 90)), 1), r.permutation(90)
    best = dense.Best(7, 5)
    for start in range(0, 90, 13):
        best.add(np.arange(7), names[start : start + 13], scores[:, start : start + 13])
    for q in range(7):
        want = sorted(zip(-scores[q], names, strict=True))[:5]
        assert [(-s, n) for s, n in zip(best.scores[q], best.names[q], strict=True)] == want


def test_saved_vectors(spark, tmp_path):
    docs = vector_table(spark, 30).where("embedding is not null")
    path = str(tmp_path / "v")
    record = files.save_vectors(docs, path).first()
    assert (record.dimension, record.vectors, record.id_type) == (8, docs.count(), "bigint")
    wanted = docs.select("doc_id", F.col("embedding").cast("array<float>").alias("embedding"))
    assert rows(files.read_vectors(spark, path, 8), "doc_id", "embedding") == rows(wanted, "doc_id", "embedding")
    assert files.save_vectors(docs.limit(1), path).first().vectors == record.vectors
    assert files.save_vectors(docs.limit(1), path, force=True).first().vectors == 1
    with pytest.raises(ValueError, match="dimension 8, not 9"):
        files.read_vectors(spark, path, 9)
    with pytest.raises(ValueError, match="no vectors"):
        files.read_vectors(spark, str(tmp_path / "other"))


@pytest.mark.parametrize("bad", ["[(1, [1.0, 2.0]), (2, [1.0])]", "[(1, [1.0, 2.0]), (2, None)]"])
def test_vectors_that_do_not_fit(spark, tmp_path, bad):
    """No record is left, so that what was written cannot be read."""
    table = spark.createDataFrame(eval(bad), "doc_id long, embedding array<double>")
    with pytest.raises(ValueError, match="without a vector"):
        files.save_vectors(table, str(tmp_path / "v"))
    with pytest.raises(ValueError, match="no vectors"):
        files.read_vectors(spark, str(tmp_path / "v"))


def test_a_changed_file_fails_the_job(spark, tmp_path):
    path = str(tmp_path / "v")
    table = spark.createDataFrame([(1, [1.0, 2.0])], "doc_id long, embedding array<float>")
    files.save_vectors(table, path)
    spark.createDataFrame([(2, [1.0])], "doc_id long, embedding array<float>").write.mode("append").parquet(f"{path}/vectors")
    with pytest.raises(Exception, match="a stored vector has length 1"):
        files.read_vectors(spark, path).collect()
    assert files.save_vectors(table.limit(0), str(tmp_path / "none")).first().dimension == 0
