import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from termlight import schemas
from termlight.operators import index
from termlight.operators.analyze import plain_tokens
from termlight.session import cut_lineage, new_folder
from termlight.sources import collections, judgments
from termlight.streaming import ingest


def lines(spark, *texts):
    path = new_folder(spark, "lines")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)
    return path


def test_tolerant_and_strict_scan(spark):
    path = lines(spark, '{"doc_id": "1", "text": "a"}', "", "{broken", '{"doc_id": 2}', "   ")
    found = collections.read_jsonl(spark, path, schemas.ID_AND_TEXT).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in found] == [("1", "a"), ("2", None)]
    assert tuple(collections.count_malformed(spark, path, schemas.ID_AND_TEXT).first()) == (2, 1)
    with pytest.raises(Exception):
        collections.read_jsonl(spark, path, schemas.ID_AND_TEXT, strict=True).collect()


def test_id_and_text_resolution(spark):
    path = lines(
        spark, '{"id": 5, "title": " T ", "contents": " body "}', '{"_id": "x", "text": " ", "passage": "p"}',
        '{"title": "only"}', '{"document_id": "z", "doc_id": null}',
    )
    raw = collections.read_jsonl(spark, path, schemas.ALIASED_DOCUMENT).withColumn("n", F.monotonically_increasing_id())
    found = collections.resolve_documents(raw, "n", "DOC_").orderBy("n").collect()
    assert [(r.doc_id, r.text) for r in found] == [("5", "T body"), ("x", "p"), ("DOC_2", "only"), ("z", "")]


def test_trec_judgments(spark):
    path = lines(spark, "q1 0 d1 1", "q1\t0\td2\t0", "  q2 0 d3 0 ", "q1 0 d1 2")
    assert [tuple(r) for r in judgments.read_trec(spark, path).collect()] == [("q1", "d1")]
    qrels = spark.createDataFrame([("q", "d", 3)], "query_id string, doc_id string, relevance int")
    assert judgments.to_trec(qrels).first().value == "q\t0\td\t3"


def test_metrics_round_trip(spark):
    path = new_folder(spark, "metrics")
    table = spark.createDataFrame([("bm25", 0.5, 0.25, 0.1, 0.75)], schemas.METRICS)
    judgments.write_metrics(table, path)
    assert judgments.read_metrics(spark, path).collect() == table.collect()


def test_write_once_and_force(spark):
    path = new_folder(spark, "once")
    one, two = (spark.range(n) for n in (1, 2))
    assert collections.write_once(one, path).count() == 1
    assert collections.write_once(two, path).count() == 1
    assert collections.write_once(two, path, force=True).count() == 2


def test_append_new(spark):
    path = new_folder(spark, "append")
    table = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string")
    assert collections.append_new(table.where("doc_id = 1"), path).count() == 1
    assert collections.append_new(table, path).count() == 2
    assert collections.append_new(table, path).count() == 2


def test_document_lookup_keeps_the_last(spark):
    docs = spark.createDataFrame([("1", "a", 0), ("1", "b", 1), ("1", " ", 2), ("2", "", 3)], "doc_id string, text string, n int")
    assert [tuple(r) for r in collections.document_lookup(docs, "n").collect()] == [("1", "b")]


def test_cut_lineage_keeps_rows(spark):
    table = spark.range(100).withColumn("x", F.col("id") * 2)
    assert sorted(cut_lineage(table, "t").collect()) == sorted(table.collect())


def write_docs(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("append").parquet(path)


def test_stream_equals_batch_and_resumes(spark):
    source, out, offsets = (new_folder(spark, n) for n in ("in", "out", "offsets"))
    schema = spark.createDataFrame([], "doc_id long, text string").schema
    write_docs(spark, source, [(1, "alpha beta"), (2, "the")])

    def advance():
        stream = ingest.read_documents(spark, source, schema)
        ingest.stream_once_per_document(stream, out, offsets).awaitTermination()
        return {r.doc_id: r.tokens for r in spark.read.parquet(out).collect()}, spark.read.parquet(out).count()

    assert advance() == ({1: ["alpha", "beta"], 2: ["the"]}, 2)
    assert advance()[1] == 2
    write_docs(spark, source, [(2, "the"), (3, "gamma gamma")])
    assert advance() == ({1: ["alpha", "beta"], 2: ["the"], 3: ["gamma", "gamma"]}, 3)


def test_streamed_index_equals_rebuild(spark):
    source, out, offsets = (new_folder(spark, n) for n in ("in", "out", "offsets"))
    schema = spark.createDataFrame([], "doc_id long, text string").schema
    batches = [[(1, "alpha beta"), (2, "beta")], [(2, "beta"), (3, "gamma beta gamma")]]
    for batch in batches:
        write_docs(spark, source, batch)
        stream = ingest.read_documents(spark, source, schema)
        ingest.stream_postings(stream, out, offsets).awaitTermination()
    streamed = ingest.read_streamed_index(spark, out)
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta"), (3, "gamma beta gamma")], "doc_id long, text string")
    rebuilt = index.build_index(docs)
    for name, columns in (("postings", ["doc_id", "term", "tf", "dl"]), ("vocab", ["term", "df", "cf"]), ("norms", ["doc_id"])):
        a, b = (sorted(tuple(r) for r in getattr(i, name).select(columns).collect()) for i in (streamed, rebuilt))
        assert a == b
    a, b = (i.stats.first().asDict() for i in (streamed, rebuilt))
    assert a == {k: v if isinstance(v, str) else pytest.approx(v) for k, v in b.items()}


def test_collections_and_copies_in_a_stream(spark):
    source, out, offsets, index_out, index_offsets = (new_folder(spark, n) for n in ("in", "out", "offsets", "index", "more"))
    docs = spark.createDataFrame(
        [(1, "x", "alpha beta", 0), (1, "x", "", 1), (1, "y", "gamma", 2), (1, "y", "delta", 3)],
        "doc_id long, dataset string, text string, at long")
    docs.write.parquet(source)
    stream = ingest.read_documents(spark, source, docs.schema)
    ingest.stream_once_per_document(stream, out, offsets, "at").awaitTermination()
    found = {(r.dataset, r.doc_id): r.tokens for r in spark.read.parquet(out).collect()}
    assert found == {("x", 1): ["alpha", "beta"], ("y", 1): ["delta"]}
    ingest.stream_postings(stream, index_out, index_offsets, "at").awaitTermination()
    terms = ingest.streamed_postings(spark, index_out).select("dataset", "term").collect()
    assert sorted(map(tuple, terms)) == [("x", "alpha"), ("x", "beta"), ("y", "delta")]


def test_streamed_datasets_keep_every_document(spark, tiny):
    """The postings grow with the documents: each one is there in both of its collections."""
    found = contract.queries()["stream_index_every_id"](spark, tiny).select("dataset", "doc_id").distinct()
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    worded = plain_tokens(docs).where(F.size("tokens") > 0)
    want = docs.select(F.col("source").alias("dataset"), "doc_id").union(worded.select(F.lit("second"), "doc_id"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert found.count() > 100


@pytest.mark.parametrize("name", ["stream_preprocess", "stream_index"])
def test_streams_read_a_table_of_one_file_or_of_many(spark, tiny, name):
    """The documents as one file, and as a folder of three, give the same rows."""
    folder = new_folder(spark, "tables")
    spark.read.parquet(f"{tiny}/documents.parquet").repartition(3, "doc_id").write.parquet(f"{folder}/documents.parquet")
    one, many = (contract.queries()[name](spark, where) for where in (tiny, folder))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert many.count() >= 200
