"""Every operator bound to the given tables, as ``(spark, folder) -> DataFrame``.

The collection is ``documents``, the queries are the whole texts of ``benchmark``, the vectors are
``embeddings``, the history is ``conversations``, and ``labels`` judges documents. Dictionaries
(lemmas, synonyms, phrases, valences, spellings) are derived from the same tables by Spark. Arrays
are joined or exploded, so that a row is flat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlight import schemas
from termlight.functions import text as T
from termlight.functions.vectors import l2_normalize
from termlight.operators import annotate, dense, evaluate, fusion, impacts, index, lexical, pivots, ranking, refine
from termlight.operators.analyze import analyze, plain_tokens, stem_table
from termlight.plans import search
from termlight.session import cut_lineage, new_folder
from termlight.sources import collections, judgments
from termlight.sources import vectors as vector_files
from termlight.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
LIST = ["query_id", "doc_id", "score", "rank"]
KEYS = ["query_id"]

_indexes: dict[tuple[str, ...], index.SearchIndex] = {}
_spellers: dict[tuple[str, ...], refine.Speller] = {}


TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def queries_table(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def analyzed_queries(spark: SparkSession, folder: str) -> DataFrame:
    return plain_tokens(queries_table(spark, folder))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def hybrid_queries(spark: SparkSession, folder: str) -> DataFrame:
    """The analyzed queries with the stored vector of the same number, where there is one."""
    own = vectors(spark, folder).withColumnRenamed("doc_id", "query_id")
    return analyzed_queries(spark, folder).join(own, "query_id", "left")


def session_index(spark: SparkSession, folder: str) -> index.SearchIndex:
    """The index of the folder's documents, built once per session and list of files."""
    docs = documents(spark, folder)
    key = (spark.sparkContext.applicationId, *sorted(docs.inputFiles()))
    if key not in _indexes:
        _indexes[key] = index.build_index(docs)
    return _indexes[key]


def corpus(spark: SparkSession, folder: str) -> search.Corpus:
    return search.Corpus(
        session_index(spark, folder), vectors(spark, folder), documents(spark, folder)
    )


def joined(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, T.join_tokens(F.col("tokens")).alias("tokens"))


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Each sentence of each document as a text of its own; many hold stop words only."""
    parts = F.split("text", r"[.!?\n]+")
    docs = documents(spark, folder)
    return docs.select("doc_id", F.posexplode(parts).alias("sentence", "text")).withColumn(
        "sentence", F.col("sentence").cast("long")
    )


# --- sources ---------------------------------------------------------------------------------


def _under_other_names(docs: DataFrame, names: list[str], value: str) -> list:
    """The value under one of several column names, and under none for the last remainder."""
    slot = F.col("ordinal") % (len(names) + 1)
    return [F.when(slot == i, F.col(value)).alias(n) for i, n in enumerate(names)]


def scan_resolve_ids(spark, folder):
    docs = documents(spark, folder).withColumn("ordinal", F.col("doc_id"))
    raw = docs.select("ordinal", *_under_other_names(docs, schemas.ID_KEYS, "doc_id"))
    return raw.select(
        "ordinal", collections.resolve_id(raw.columns, F.col("ordinal"), "DOC_").alias("resolved")
    )


def _raw_documents(spark, folder):
    docs = table(spark, folder, "documents").withColumn("ordinal", F.col("doc_id"))
    slot = F.col("ordinal") % len(schemas.TEXT_KEYS)
    texts = [
        F.when(slot == i, F.col("text")).otherwise(F.lit(" ")).alias(n)
        for i, n in enumerate(schemas.TEXT_KEYS)
    ]
    title = F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit(" "), "source")).alias("title")
    return docs.select("ordinal", "doc_id", title, *texts)


def scan_resolve_text(spark, folder):
    return collections.resolve_documents(_raw_documents(spark, folder), "ordinal").drop("ordinal")


def sample_first_n(spark, folder):
    return collections.sample_texts(_raw_documents(spark, folder).drop("title"), 100, "ordinal").drop(
        "ordinal"
    )


def _json_lines(spark, folder) -> str:
    """Documents as JSON lines with the raw lines of the web pages, which are not JSON, between."""
    good = documents(spark, folder).select(
        F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "text")).alias("value")
    )
    path = new_folder(spark, "jsonl")
    good.unionByName(table(spark, folder, "pages").select(F.col("html").alias("value"))).write.text(path)
    return path


def scan_jsonl(spark, folder):
    path = _json_lines(spark, folder)
    return collections.read_jsonl(spark, path, schemas.ID_AND_TEXT).select("doc_id", "text")


def scan_malformed_counts(spark, folder):
    return collections.count_malformed(spark, _json_lines(spark, folder), schemas.ID_AND_TEXT)


def scan_queries(spark, folder):
    path = new_folder(spark, "queries")
    queries_table(spark, folder).write.json(path)
    raw = collections.read_jsonl(spark, path, schemas.QUERY, strict=True)
    return collections.scan_queries(raw)


def empty_docs(spark, folder):
    texts = plain_tokens(sentences(spark, folder))
    return texts.where(F.size("tokens") == 0).select("doc_id", "sentence")


def processed_docs(spark, folder):
    return joined(index.processed(documents(spark, folder)), "doc_id")


def processed_queries(spark, folder):
    return joined(analyzed_queries(spark, folder), "query_id", "text")


def resume_antijoin(spark, folder):
    todo = collections.not_yet_done(documents(spark, folder), table(spark, folder, "labels"))
    return joined(plain_tokens(todo), "doc_id")


def document_lookup(spark, folder):
    turns = table(spark, folder, "conversations").withColumnRenamed("conv_id", "doc_id")
    return collections.document_lookup(turns, "turn")


def output_summary(spark, folder):
    names = {"documents": "documents", "queries": "benchmark", "judgments": "labels",
             "vectors": "embeddings"}
    return collections.output_summary({k: table(spark, folder, v) for k, v in names.items()})


def dataset_catalog(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("source", "dataset")
    return collections.dataset_catalog(docs)


def index_tables(spark, folder):
    built = session_index(spark, folder)
    return index.open_index(spark, built.path).postings.select("doc_id", "term", "tf", "dl")


def qrels_trec(spark, folder):
    path = new_folder(spark, "qrels")
    labels = table(spark, folder, "labels").withColumn("query_id", F.lit("labels"))
    judgments.write_trec(labels.withColumnRenamed("quality", "relevance"), path)
    return judgments.read_trec(spark, path)


# --- text ------------------------------------------------------------------------------------


def text_normalize(spark, folder):
    docs = documents(spark, folder).select(
        F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text"
    )
    pages = table(spark, folder, "pages").select(
        F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    both = docs.unionByName(pages)
    return both.select("source", "id", T.normalize(F.col("text")).alias("normalized"))


def text_tokens(spark, folder):
    docs = documents(spark, folder)
    return joined(docs.withColumn("tokens", T.tokenize(T.normalize(F.col("text")))), "doc_id")


def text_stopwords(spark, folder):
    return joined(plain_tokens(documents(spark, folder), mode="lemma"), "doc_id")


def text_fallback(spark, folder):
    return joined(plain_tokens(sentences(spark, folder)), "doc_id", "sentence")


def feedback_words(spark, folder):
    docs = documents(spark, folder)
    return docs.select("doc_id", T.join_tokens(T.feedback_words(F.col("text"))).alias("words"))


# --- dictionaries ----------------------------------------------------------------------------


def lemma_dictionary(spark, folder) -> DataFrame:
    """``form, term``: corpus terms in ``s`` whose form without it is a corpus term too."""
    terms = session_index(spark, folder).vocab.select("term")
    plural = terms.where(F.col("term").endswith("s")).select(
        F.col("term").alias("form"), F.expr("left(term, length(term) - 1)").alias("term")
    )
    return plural.join(terms, "term", "left_semi").select("form", "term")


def lemma_join(spark, folder):
    docs = documents(spark, folder)
    return joined(analyze(docs, ["doc_id"], lemmas=lemma_dictionary(spark, folder)), "doc_id")


def lemma_postings(spark, folder):
    lemmas = lemma_dictionary(spark, folder)
    return index.build_postings(documents(spark, folder), lemmas=lemmas).select("doc_id", "term", "tf")


def stem_tokens(spark, folder):
    return joined(analyze(documents(spark, folder), ["doc_id"], mode="stem"), "doc_id")


def stem_vocabulary(spark, folder):
    tokens = plain_tokens(documents(spark, folder), mode="stem")
    return stem_table(tokens.select(F.explode_outer("tokens").alias("term")))


def phrase_table(spark, folder) -> DataFrame:
    """Long words and all neighbouring pairs and triples of the query texts."""
    texts = table(spark, folder, "benchmark").select(
        F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("w")
    )
    names = {1: "WORD", 2: "PAIR", 3: "TRIPLE"}
    phrases = None
    for n, label in names.items():
        groups = annotate.word_groups(F.col("w"), n)
        rows = texts.select(F.explode(groups).alias("g")).select(F.col("g.entity").alias("phrase"))
        rows = rows.distinct()
        if n == 1:
            rows = rows.where(F.length("phrase") >= 8)
        rows = rows.withColumn("label", F.lit(label))
        phrases = rows if phrases is None else phrases.unionByName(rows)
    return phrases


def entity_gazetteer(spark, folder):
    docs = documents(spark, folder)
    return annotate.entities(docs, phrase_table(spark, folder), 3)


def valence_lexicon(spark, folder) -> DataFrame:
    """A word's valence from the share of good documents among the labelled ones that use it."""
    found = F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit("[a-z][a-z'-]*"), F.lit(0))
    )
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    docs = documents(spark, folder).join(labels, "doc_id")
    words = docs.select("quality", F.explode(found).alias("word"))
    share = F.sum("quality") / F.count("*")
    return words.groupBy("word").agg((8.0 * share - 4).alias("valence"), F.count("*").alias("n")).where(
        F.col("n") >= 5
    )


def sentiment_lexicon(spark, folder):
    lexicon = cut_lineage(valence_lexicon(spark, folder), "lexicon")
    return annotate.sentiment(documents(spark, folder), lexicon)


# --- index -----------------------------------------------------------------------------------


def postings(spark, folder):
    return index.build_postings(documents(spark, folder)).select("doc_id", "term", "tf")


def index_skip_counts(spark, folder):
    listed = table(spark, folder, "labels").where("toxic = 1")
    return index.skip_counts(plain_tokens(sentences(spark, folder)), listed)


def index_skip_list(spark, folder):
    listed = table(spark, folder, "labels").where("toxic = 1")
    return index.build_postings(documents(spark, folder), skip_ids=listed).select(
        "doc_id", "term", "tf"
    )


def doc_lengths(spark, folder):
    return index.doc_lengths(session_index(spark, folder).postings).select("doc_id", "dl")


def _rounded_stats(found: DataFrame) -> DataFrame:
    stats = index.corpus_stats(index.doc_lengths(found), index.vocabulary(found))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_dl", "mean_idf")})


def corpus_stats(spark, folder):
    return _rounded_stats(session_index(spark, folder).postings).drop("dataset")


def dataset_indexes(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("source", "dataset")
    found = cut_lineage(index.build_postings(docs), "postings")
    return _rounded_stats(found).drop("mean_idf")


def doc_freq(spark, folder):
    return index.vocabulary(session_index(spark, folder).postings).drop("dataset")


def postings_lookup(spark, folder):
    terms = lexical.query_tf(analyzed_queries(spark, folder)).select("term")
    return index.lookup_postings(session_index(spark, folder).postings, terms).select(
        "doc_id", "term", "tf"
    )


def doc_length_lookup(spark, folder):
    ids = vectors(spark, folder).select("doc_id").distinct()
    return index.lookup_doc_lengths(ids, session_index(spark, folder).lengths)


def tfidf_weights(spark, folder):
    """Weights in millionths: whole numbers compare exactly, however many there are."""
    weights = index.tfidf_weights(session_index(spark, folder))
    return weights.select("doc_id", "term", F.round(F.col("weight") * 1_000_000).cast("long").alias("weight"))


def bm25_idf(spark, folder):
    """In millionths, as the weights."""
    built = session_index(spark, folder)
    weighed = index.weigh_vocabulary(built.vocab, built.stats, index.okapi_idf())
    return weighed.select("term", F.round(F.col("idf") * 1_000_000).cast("long").alias("idf"))


# --- retrieval -------------------------------------------------------------------------------


def bm25_okapi(spark, folder):
    return lexical.bm25(session_index(spark, folder), analyzed_queries(spark, folder)).select(LIST)


def shelved_index(spark: SparkSession, folder: str) -> index.SearchIndex:
    """The index of the folder's documents with its postings on 32 shelves in 4 buckets, or as many as the text needs."""
    docs = documents(spark, folder)
    key = (spark.sparkContext.applicationId, "shelves", *sorted(docs.inputFiles()))
    if key not in _indexes:
        _indexes[key] = index.build_index(docs, buckets=index.text_partitions(docs, 4), shelves=32)
    return _indexes[key]


def bm25_shelves(spark, folder):
    """The same run, from the shelves of the query terms alone."""
    return lexical.bm25(shelved_index(spark, folder), analyzed_queries(spark, folder)).select(LIST)


def postings_lookup_shelves(spark, folder):
    built = shelved_index(spark, folder)
    terms = lexical.query_tf(analyzed_queries(spark, folder)).select("term")
    return index.lookup_postings(built.postings, terms, built.shelves).select("doc_id", "term", "tf")


def bm25_query_blocks(spark, folder):
    """The same run, with so few query terms broadcast at a time that the queries go in several blocks."""
    built = session_index(spark, folder)
    return lexical.bm25(built, analyzed_queries(spark, folder), max_rows=600).select(LIST)


def bm25_pruned(spark, folder):
    """The same run, from the blocks of documents that can reach it."""
    blocks = impacts.build_blocks(session_index(spark, folder))
    return impacts.bm25_pruned(blocks, analyzed_queries(spark, folder)).select(LIST)


def bm25_plus_one(spark, folder):
    return lexical.bm25(
        session_index(spark, folder), analyzed_queries(spark, folder), variant="plus_one"
    ).select(LIST)


def bm25_param_sweep(spark, folder):
    settings = [(0.5, 0.0), (1.5, 0.75), (3.0, 1.0)]
    pairs = F.array(*[F.struct(F.lit(k1).alias("k1"), F.lit(b).alias("b")) for k1, b in settings])
    asked = analyzed_queries(spark, folder).withColumn("p", F.explode(pairs)).select("*", "p.*")
    run = lexical.bm25(session_index(spark, folder), asked, keys=["query_id", "k1", "b"])
    return run.select("query_id", "k1", "b", "doc_id", "score", "rank")


def tfidf_cosine(spark, folder):
    return lexical.tfidf(session_index(spark, folder), analyzed_queries(spark, folder)).select(LIST)


def tfidf_loglog(spark, folder):
    return lexical.tfidf(
        session_index(spark, folder), analyzed_queries(spark, folder), variant="log_log"
    ).select(LIST)


def _vector_queries(spark, folder):
    ids = queries_table(spark, folder).select("query_id")
    return ids.join(vectors(spark, folder).withColumnRenamed("doc_id", "query_id"), "query_id")


def dense_topk(spark, folder):
    return dense.nearest(vectors(spark, folder), _vector_queries(spark, folder)).select(LIST)


def dense_pivots(spark, folder):
    """The same run, from the blocks of vectors that can reach it."""
    blocks = pivots.build_vector_blocks(vectors(spark, folder), pivots=64)
    return pivots.nearest_in_blocks(blocks, _vector_queries(spark, folder)).select(LIST)


def vectors_saved(spark, folder):
    """The vectors after a round trip through a saved folder, beside its record."""
    path = new_folder(spark, "vectors")
    record = vector_files.save_vectors(vectors(spark, folder), path).first()
    stored = vector_files.read_vectors(spark, path)
    scaled = F.transform("embedding", lambda x: F.round(x.cast("double") * 100000).cast("long").cast("string"))
    return stored.select(
        "doc_id", F.lit(record.dimension).alias("dimension"), F.lit(record.vectors).alias("vectors"),
        F.array_join(scaled, " ").alias("scaled"),
    )


def vector_normalize(spark, folder):
    unit = table(spark, folder, "embeddings").withColumn("v", l2_normalize(F.col("embedding")))
    scaled = F.transform("v", lambda x: F.round(x * 100000).cast("long").cast("string"))
    return unit.select("vec_id", F.array_join(scaled, " ").alias("scaled"))


def query_tf(spark, folder):
    return lexical.query_tf(analyzed_queries(spark, folder)).drop("dataset")


def hybrid_serial(spark, folder):
    """The intersection of two lists, as its SQL states; ``hybrid_serial_rescored`` has the default."""
    return search.hybrid_serial(corpus(spark, folder), hybrid_queries(spark, folder), rescore=False)


def hybrid_serial_rescored(spark, folder):
    return search.hybrid_serial(corpus(spark, folder), hybrid_queries(spark, folder), rescore=True)


def hybrid_parallel_rrf(spark, folder):
    return search.hybrid_parallel(corpus(spark, folder), hybrid_queries(spark, folder))


def hybrid_parallel_linear(spark, folder):
    return search.hybrid_parallel(
        corpus(spark, folder), hybrid_queries(spark, folder), method="linear"
    )


def model_router(spark, folder):
    """Every query once through every model, the parallel hybrid also with linear fusion."""
    asked = hybrid_queries(spark, folder)
    wishes = [(m, "rrf", m) for m in search.MODELS] + [("hybrid_parallel", "linear", "linear")]
    options = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.lit(f).alias("fusion_method"), F.lit(n).alias("name"))
            for m, f, n in wishes
        ]
    )
    requests = asked.withColumn("wish", F.explode(options)).select("*", "wish.*").drop("wish")
    requests = requests.withColumn("query_id", F.concat_ws("/", "query_id", "name")).drop("name")
    return search.route(corpus(spark, folder), requests).select(
        "query_id", "model", "doc_id", "score", "rank"
    )


def router_mixed_requests(spark, folder):
    """Depths 3, 10 and 25 through every model, both fusion methods, and no method for depth 3."""
    wishes = [(m, f, k) for k in (3, 10, 25) for m, f in [*[(m, "rrf") for m in search.MODELS], ("hybrid_parallel", "linear")]]
    options = F.array(*[
        F.struct(
            F.lit(m).alias("model"), F.lit(k).alias("top_k"), F.lit(f"{f} {k}").alias("name"),
            F.lit(None if (f, k) == ("rrf", 3) else f).cast("string").alias("fusion_method"),
        )
        for m, f, k in wishes
    ])
    requests = hybrid_queries(spark, folder).withColumn("wish", F.explode(options)).select("*", "wish.*").drop("wish")
    requests = requests.withColumn("query_id", F.concat_ws("/", "query_id", "model", "name")).drop("name")
    return search.route(corpus(spark, folder), requests).select("query_id", "model", "doc_id", "score", "rank")


def router_deep_requests(spark, folder):
    """Serial hybrids by default, to depths 10, 150 and 250, with first stages of 100, 100 and 300."""
    options = F.array(*[
        F.struct(F.lit(k).alias("top_k"), F.lit(s).cast("int").alias("first_stage")) for k, s in ((10, None), (150, 100), (250, 300))
    ])
    requests = hybrid_queries(spark, folder).withColumn("wish", F.explode(options)).select("*", "wish.*").drop("wish")
    requests = requests.withColumn("query_id", F.concat_ws("/", "query_id", "top_k")).withColumn("model", F.lit("hybrid_serial"))
    return search.route(corpus(spark, folder), requests).select("query_id", "model", "doc_id", "score", "rank")


def search_datasets(spark, folder):
    """Each query in one of the collections that ``source`` makes of the documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text", F.col("source").alias("dataset"))
    collection = F.concat(F.lit("src"), (F.col("query_id") % 20).cast("string"))
    asked = analyzed_queries(spark, folder).withColumn("dataset", collection)
    return lexical.bm25(index.build_index(docs), asked).select("query_id", "dataset", *LIST[1:])


# --- fusion and output -----------------------------------------------------------------------


def lexical_runs(spark, folder) -> DataFrame:
    built, asked = session_index(spark, folder), analyzed_queries(spark, folder)
    runs = {"bm25": lexical.bm25(built, asked), "tfidf": lexical.tfidf(built, asked)}
    return ranking.merge_runs({m: r.select(LIST) for m, r in runs.items()})


def fusion_rrf(spark, folder):
    return fusion.fuse(lexical_runs(spark, folder), KEYS, ["bm25", "tfidf"]).select(LIST)


def fusion_linear(spark, folder):
    return fusion.fuse(lexical_runs(spark, folder), KEYS, ["bm25", "tfidf"], "linear").select(LIST)


def run_max_normalize(spark, folder):
    run = ranking.max_normalize(lexical_runs(spark, folder), ["model", "query_id"])
    return run.select("model", "query_id", "doc_id", F.round("score", 6).alias("score"))


def run_ranked(spark, folder):
    lists = table(spark, folder, "documents").select(
        F.col("source").alias("query_id"), "doc_id", F.col("n_chars").alias("score")
    )
    return ranking.format_run(ranking.rank_all(lists, KEYS))


def runs_merged(spark, folder):
    return lexical_runs(spark, folder).select("model", *LIST)


def results_with_text(spark, folder):
    run = dense.nearest(vectors(spark, folder), _vector_queries(spark, folder))
    return search.with_text(run, documents(spark, folder)).select(
        "query_id", "doc_id", "rank", "snippet"
    )


def search_response(spark, folder):
    asked = analyzed_queries(spark, folder).withColumn("model", F.lit("bm25"))
    run = search.run_model(corpus(spark, folder), asked, "bm25")
    answer = search.responses(asked, run, documents(spark, folder))
    rows = answer.withColumn("r", F.explode_outer("results"))
    return rows.select("query_id", "query", "model_used", "r.*", "total_results")


# --- refinement ------------------------------------------------------------------------------


def query_analyze(spark, folder):
    return joined(analyzed_queries(spark, folder), "query_id")


def spelling_dictionary(spark, folder) -> DataFrame:
    """Every word of the documents with its frequency."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    # An outer explode, as an inner one would also find all words in a filter below it.
    found = documents(spark, folder).select(F.explode_outer(words).alias("term")).where(F.col("term").isNotNull())
    return found.groupBy("term").agg(F.count("*").alias("cf"))


def session_speller(spark, folder) -> refine.Speller:
    """The dictionary of the folder's documents, built once per session as the index is."""
    key = (spark.sparkContext.applicationId, "speller", *sorted(documents(spark, folder).inputFiles()))
    if key not in _spellers:
        _spellers[key] = refine.build_speller(spelling_dictionary(spark, folder))
    return _spellers[key]


def spell_correct(spark, folder):
    dictionary = session_speller(spark, folder)
    return refine.correct_spelling(queries_table(spark, folder), dictionary).select(
        "query_id", "corrected"
    )


def thesaurus(spark, folder) -> DataFrame:
    """``term, ord, synonym``: terms of four letters or more and those that add one letter."""
    vocab = session_index(spark, folder).vocab
    longer = vocab.select(
        F.col("term").alias("synonym"), "cf", F.expr("left(term, length(term) - 1)").alias("term")
    )
    known = vocab.where(F.length("term") >= 4).select("term")
    return longer.join(known, "term", "left_semi").select("term", (-F.col("cf")).alias("ord"), "synonym")


def synonym_expand(spark, folder):
    asked = analyzed_queries(spark, folder)
    return refine.expand_synonyms(asked, thesaurus(spark, folder)).select(
        "query_id", F.array_join("expanded_tokens", " ").alias("expanded_tokens")
    )


def prf_expand(spark, folder):
    return refine.relevance_feedback(
        session_index(spark, folder), analyzed_queries(spark, folder), documents(spark, folder)
    ).select("query_id", "prf_query")


def user_history(spark, folder) -> DataFrame:
    turns = table(spark, folder, "conversations").where(F.col("role") == "user")
    return turns.select(
        F.col("conv_id").alias("user_id"), F.col("turn").alias("pos"), F.col("text").alias("query")
    )


def query_suggest(spark, folder):
    past = user_history(spark, folder)
    asked = past.select(
        F.concat_ws("-", "user_id", "pos").alias("query_id"), "user_id", F.col("query").alias("text")
    )
    return refine.suggest(asked, past)


def query_refine(spark, folder):
    dictionary = session_speller(spark, folder)
    asked = queries_table(spark, folder).withColumns(
        {"use_synonyms": F.lit(True), "use_prf": F.lit(True)}
    )
    rows = refine.refine(
        asked, session_index(spark, folder), documents(spark, folder), dictionary,
        thesaurus(spark, folder),
    )
    return rows.select(
        "query_id", "text", "corrected", F.array_join("tokens", " ").alias("tokens"),
        F.array_join("expanded_tokens", " ").alias("expanded_tokens"), "prf_query",
    )


def search_pipeline(spark, folder):
    """Refinement with flags for each row, routing by model and depth, and the results."""
    number = F.col("query_id")
    asked = queries_table(spark, folder).withColumns({
        "use_spell_correction": number % 4 != 3, "use_synonyms": number % 2 == 0, "use_prf": number % 3 == 0,
        "model": F.when(number % 3 == 1, "tfidf").otherwise("bm25"),
        "top_k": F.when(number % 2 == 0, 5).otherwise(10),
    })
    dictionary = session_speller(spark, folder)
    found = search.answer(corpus(spark, folder), asked, dictionary, thesaurus(spark, folder))
    rows = found.withColumn("r", F.explode_outer("results"))
    return rows.select("query_id", "query", "corrected_query", "expanded_query", "model_used", "r.*", "total_results")


def search_every_model(spark, folder):
    """The whole search through every model and both fusions, with vectors and each user's history."""
    number = F.col("query_id")
    models = ["bm25", "tfidf", "embedding", "hybrid_serial", "hybrid_parallel"]
    own = vectors(spark, folder).withColumnRenamed("doc_id", "query_id")
    asked = queries_table(spark, folder).join(own, "query_id", "left").withColumns({
        "use_spell_correction": number % 4 != 3, "use_synonyms": number % 2 == 0, "use_prf": number % 3 == 0,
        "model": F.element_at(F.array(*[F.lit(m) for m in models]), (number % 5 + 1).cast("int")),
        "top_k": F.when(number % 2 == 0, 5).otherwise(10), "user_id": number,
        "fusion_method": F.when(number % 2 == 0, "rrf").otherwise("linear"),
    })
    found = search.answer(
        corpus(spark, folder), asked, session_speller(spark, folder), thesaurus(spark, folder), user_history(spark, folder)
    )
    rows = found.withColumn("r", F.explode_outer("results"))
    return rows.select(
        "query_id", "corrected_query", "expanded_query", F.array_join("suggestions", "|").alias("suggestions"), "model_used", "r.*"
    )


def history_append(spark, folder):
    new = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("user_id"), F.col("turn").alias("pos"), F.col("text").alias("query")
    )
    return refine.append_history(user_history(spark, folder), new)


# --- evaluation ------------------------------------------------------------------------------


def pooled_judgments(spark, folder, runs: DataFrame) -> DataFrame:
    """The labelled documents among what the runs found for a query, judged by their label."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("relevance"))
    return runs.select("query_id", "doc_id").distinct().join(labels, "doc_id")


def _lexical_metrics(spark, folder) -> DataFrame:
    runs = cut_lineage(lexical_runs(spark, folder), "runs")
    qrels = pooled_judgments(spark, folder, runs)
    return evaluate.query_metrics(runs, qrels, ["model", "query_id"])


def _one_metric(name: str) -> Query:
    def query(spark, folder):
        return _lexical_metrics(spark, folder).select(
            "model", "query_id", F.round(name, 6).alias(name)
        )

    return query


def _rounded(metrics: DataFrame, name: str) -> DataFrame:
    values = [c for c in metrics.columns if c != name]
    return metrics.select(name, *[F.round(f"`{c}`", 6).alias(c) for c in values])


def eval_models(spark, folder):
    asked = hybrid_queries(spark, folder)
    runs = cut_lineage(search.all_runs(corpus(spark, folder), asked), "all-runs")
    qrels = pooled_judgments(spark, folder, runs)
    return _rounded(evaluate.evaluate_models(runs, asked, qrels, search.MODELS), "Model")


def metrics_report(spark, folder):
    runs = cut_lineage(lexical_runs(spark, folder), "runs")
    qrels = pooled_judgments(spark, folder, runs)
    asked = queries_table(spark, folder)
    path = new_folder(spark, "report")
    judgments.write_metrics(
        evaluate.evaluate_models(runs, asked, qrels, ["bm25", "tfidf"]), path
    )
    return _rounded(judgments.read_metrics(spark, path), "Model")


def eval_single_list(spark, folder):
    """Two rankings of all documents, by length, against the labels at full depth."""
    docs = table(spark, folder, "documents")
    sizes = {"shortest": -F.col("n_chars"), "longest": F.col("n_chars")}
    lists = [docs.select(F.lit(m).alias("model"), "doc_id", s.alias("score")) for m, s in sizes.items()]
    runs = ranking.rank_all(lists[0].unionByName(lists[1]), ["model"])
    labels = table(spark, folder, "labels").withColumnRenamed("quality", "relevance")
    return _rounded(evaluate.compare_models(runs, labels), "model")


# --- streaming -------------------------------------------------------------------------------


def _stream(spark, folder) -> DataFrame:
    """The documents as a stream, whether the table is one file or a folder of files."""
    schema = table(spark, folder, "documents").schema
    # A path without a pattern must be a folder, and a pattern for file names misses the files of one.
    return ingest.read_documents(spark, f"{folder}/{{documents.parquet}}", schema)


def stream_preprocess(spark, folder):
    out = new_folder(spark, "stream")
    ingest.stream_processed(_stream(spark, folder), out, new_folder(spark, "offsets")).awaitTermination()
    return joined(spark.read.schema(PROCESSED_LONG).parquet(out), "doc_id")


def stream_resume(spark, folder):
    """Two streams over the same files into one table; the second adds nothing."""
    out = new_folder(spark, "stream")
    for _ in range(2):
        ingest.stream_once_per_document(
            _stream(spark, folder), out, new_folder(spark, "offsets")
        ).awaitTermination()
    return joined(spark.read.schema(PROCESSED_LONG).parquet(out), "doc_id")


def stream_index(spark, folder):
    out = new_folder(spark, "stream")
    ingest.stream_postings(_stream(spark, folder), out, new_folder(spark, "offsets")).awaitTermination()
    return ingest.streamed_postings(spark, out).select("doc_id", "term", "tf")


def stream_vocab_size(spark, folder):
    """Distinct terms of each collection after several batches, and whether the merged sketches say
    nearly the same (five standard errors)."""
    source = new_folder(spark, "in")
    docs = table(spark, folder, "documents").select(F.col("source").alias("dataset"), "doc_id", "text")
    docs.repartition(4, "doc_id").write.parquet(source)
    out = new_folder(spark, "stream")
    stream = ingest.read_documents(spark, source, docs.schema, files_per_batch=1)
    ingest.stream_postings(stream, out, new_folder(spark, "offsets")).awaitTermination()
    exact = index.vocabulary(ingest.streamed_postings(spark, out)).groupBy("dataset").agg(F.count("*").alias("terms"))
    near = F.abs(F.col("vocab_size") - F.col("terms")) <= 0.04 * F.col("terms") + 1
    return exact.join(ingest.streamed_vocab_size(spark, out), "dataset").select("dataset", "terms", near.alias("near"))


def stream_index_every_id(spark, folder):
    """Every document under its own id in two collections, with an earlier copy and a later empty one.

    Copies of an id share a file, so that they arrive in one batch however many files there are.
    """
    source = new_folder(spark, "in")
    copies = F.array(*[
        F.struct(dataset.alias("dataset"), F.lit(at).cast("long").alias("at"), text.alias("text"))
        for dataset, at, text in (
            (F.col("source"), 1, F.col("text")), (F.lit("second"), 1, F.col("text")),
            (F.col("source"), 0, F.lit("superseded")), (F.col("source"), 2, F.lit("")),
        )
    ])
    docs = table(spark, folder, "documents").select("doc_id", F.explode(copies).alias("copy")).select("doc_id", "copy.*")
    docs.repartition(index.text_partitions(docs, 4), "doc_id").write.parquet(source)
    out = new_folder(spark, "stream")
    stream = ingest.read_documents(spark, source, docs.schema)
    ingest.stream_postings(stream, out, new_folder(spark, "offsets"), "at").awaitTermination()
    return ingest.streamed_postings(spark, out).select("dataset", "doc_id", "term", "tf")


def stream_search(spark, folder):
    """BM25 over an index that a stream has built."""
    out = new_folder(spark, "stream")
    ingest.stream_postings(_stream(spark, folder), out, new_folder(spark, "offsets")).awaitTermination()
    built = ingest.read_streamed_index(spark, out)
    return lexical.bm25(built, analyzed_queries(spark, folder)).select(LIST)


PROCESSED_LONG = "doc_id bigint, tokens array<string>"

QUERIES: dict[str, Query] = {
    **{
        f.__name__: f
        for f in (
            scan_resolve_ids, scan_resolve_text, sample_first_n, scan_jsonl, scan_malformed_counts,
            scan_queries, empty_docs, processed_docs, processed_queries, resume_antijoin,
            document_lookup, output_summary, dataset_catalog, index_tables, qrels_trec,
            metrics_report, text_normalize, text_tokens, text_stopwords, text_fallback,
            feedback_words, lemma_join, lemma_postings, stem_tokens, stem_vocabulary,
            entity_gazetteer, sentiment_lexicon, postings, index_skip_counts, index_skip_list,
            doc_lengths, corpus_stats, dataset_indexes, doc_freq, postings_lookup,
            doc_length_lookup, tfidf_weights, bm25_idf, bm25_okapi, bm25_plus_one,
            bm25_shelves, postings_lookup_shelves, bm25_query_blocks, bm25_pruned, dense_pivots, vectors_saved,
            bm25_param_sweep, tfidf_cosine, tfidf_loglog, dense_topk, vector_normalize, query_tf,
            hybrid_serial, hybrid_serial_rescored, hybrid_parallel_rrf, hybrid_parallel_linear,
            model_router, router_mixed_requests, router_deep_requests, search_datasets, search_pipeline, search_every_model, fusion_rrf, fusion_linear, run_max_normalize, run_ranked, runs_merged,
            results_with_text, search_response, query_analyze, spell_correct, synonym_expand,
            prf_expand, query_suggest, query_refine, history_append, eval_models,
            eval_single_list, stream_preprocess, stream_resume, stream_index,
            stream_index_every_id, stream_vocab_size, stream_search,
        )
    },
    "embedding_stats": lambda spark, folder: dense.vector_stats(table(spark, folder, "embeddings")),
    **{f"eval_{name}": _one_metric(name) for name in ("precision", "recall", "ap", "ndcg")},
}
