"""The term index: flat postings, document lengths, vocabulary and corpus statistics.

Everything carries a ``dataset`` column, so one job indexes any number of collections and equal
document ids of two collections stay apart. Postings are hash-partitioned by ``doc_id``: a
document's terms sit together, hence tf, lengths, norms and scores need no further shuffle and no
term, however frequent, makes a hot partition. Inside the buckets they can be cut once more by a hash
of the term into shelves, which are partitions of the table: a search opens the shelves of its terms
alone, however many terms it has.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from termlight.operators.analyze import analyze, changed_stems, plain_tokens
from termlight.operators.joins import fits_broadcast, lookup_join
from termlight.session import cut_lineage, new_folder

DEFAULT_DATASET = "default"
#: Text of one task or bucket; counting and sorting its terms needs some fifty times that.
TEXT_BYTES = 16 * 1024 * 1024
DOC = ["dataset", "doc_id"]
TERM = ["dataset", "term"]
STATS = t.StructType(
    [
        t.StructField("dataset", t.StringType()),
        t.StructField("doc_count", t.LongType()),
        t.StructField("avg_dl", t.DoubleType()),
        t.StructField("vocab_size", t.LongType()),
        t.StructField("mean_idf", t.DoubleType()),
    ]
)


def with_dataset(df: DataFrame) -> DataFrame:
    return df if "dataset" in df.columns else df.withColumn("dataset", F.lit(DEFAULT_DATASET))


def keep_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row per key: the one with the highest ordinal. Copies are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(ordinal)).alias("__last")
    return df.groupBy(keys).agg(last).select(*keys, "__last.*").select(*df.columns)


def text_partitions(docs: DataFrame, least: int | None = None) -> int:
    """How many parts leave some ``TEXT_BYTES`` of text in each, so that a task does not grow with the table.

    At least ``least``, or the number of shuffle partitions.
    """
    least = least or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(least, ceil(size / TEXT_BYTES))


def drop_skipped(docs: DataFrame, skip_ids: DataFrame | None) -> DataFrame:
    """Leave out the listed documents; the list may be larger than any broadcast."""
    if skip_ids is None:
        return docs
    keys = DOC if {"dataset"} <= set(docs.columns) & set(skip_ids.columns) else ["doc_id"]
    return docs.join(skip_ids.select(keys).distinct(), keys, "left_anti")


def indexable(tokens: DataFrame) -> DataFrame:
    """Rows with an id and at least one token."""
    named = F.trim(F.col("doc_id").cast("string")) != ""
    return tokens.where(named & (F.size("tokens") > 0))


def skip_counts(tokens: DataFrame, skip_ids: DataFrame) -> DataFrame:
    """How many rows are kept and how many are left out for each reason."""
    keys = DOC if {"dataset"} <= set(tokens.columns) & set(skip_ids.columns) else ["doc_id"]
    listed = skip_ids.select(keys).distinct().withColumn("__listed", F.lit(True))
    blank = F.coalesce(F.trim(F.col("doc_id").cast("string")), F.lit("")) == ""
    reason = (
        F.when(blank, "blank_id")
        .when(F.col("__listed"), "listed_empty")
        .when(F.coalesce(F.size("tokens"), F.lit(0)) <= 0, "no_tokens")
        .otherwise("kept")
    )
    reasons = tokens.join(listed, keys, "left").select(reason.alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("docs"))


def postings_from_tokens(tokens: DataFrame) -> DataFrame:
    """``dataset, doc_id, dl, term, tf`` from token arrays (document ids must be unique)."""
    # An outer explode, with the empty rows dropped behind it: Spark would copy a filter on the
    # tokens below the projection that computes them, and analyze every text twice.
    rows = with_dataset(tokens).select(
        *DOC, F.size("tokens").cast("long").alias("dl"), F.explode_outer("tokens").alias("term")
    )
    named = F.trim(F.col("doc_id").cast("string")) != ""
    rows = rows.where(F.col("term").isNotNull() & named)
    return rows.groupBy(*DOC, "dl", "term").agg(F.count("*").alias("tf"))


def merge_terms(postings: DataFrame, table: DataFrame) -> DataFrame:
    """Map the terms of counted postings through ``table(form, term)`` and add up what meets."""
    forms = table.select(
        F.col("form").alias("term"), F.lower("term").alias("__to")
    ).dropDuplicates(["term"])
    mapped = lookup_join(postings, forms, ["term"], how="left")
    mapped = mapped.withColumn("term", F.coalesce("__to", "term"))
    return mapped.groupBy(*DOC, "dl", "term").agg(F.sum("tf").alias("tf"))


def build_postings(
    docs: DataFrame,
    mode: str = "default",
    lemmas: DataFrame | None = None,
    skip_ids: DataFrame | None = None,
    partitions: int | None = None,
    ordinal: str | None = None,
) -> DataFrame:
    """Analyze ``docs(doc_id, text[, dataset])`` and count terms.

    Ids must be unique within a collection; with ``ordinal``, the last of equal ones is kept.
    The one shuffle moves the raw text by document id, which is smaller than the token arrays it
    becomes; analysis and counting follow in the same stage. Stems and lemmas are looked up after
    counting, once per document and form. The number of parts follows the measured size of the text.
    """
    docs = with_dataset(docs)
    partitions = partitions or text_partitions(docs)
    if ordinal:
        docs = keep_last(docs.select(*DOC, "text", ordinal), DOC, ordinal)
    docs = docs.select(*DOC, "text")
    docs = docs.repartition(partitions, "doc_id")
    postings = postings_from_tokens(plain_tokens(drop_skipped(docs, skip_ids), mode=mode))
    if mode == "stem":
        postings = cut_lineage(postings, "postings")
        return merge_terms(postings, changed_stems(postings))
    return merge_terms(postings, lemmas) if lemmas is not None else postings


def doc_lengths(postings: DataFrame) -> DataFrame:
    return postings.groupBy(DOC).agg(F.max("dl").alias("dl"))


def vocabulary(postings: DataFrame) -> DataFrame:
    """``dataset, term, df, cf``. Partial counts are combined before the shuffle by term."""
    return postings.groupBy(TERM).agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def corpus_stats(lengths: DataFrame, vocab: DataFrame) -> DataFrame:
    """``dataset, doc_count, avg_dl, vocab_size, mean_idf``; an empty collection gives no row.

    The vocabulary is reduced to counts per document frequency before it meets the sizes.
    """
    sizes = lengths.groupBy("dataset").agg(
        F.count("*").alias("doc_count"), F.avg("dl").alias("avg_dl")
    )
    by_df = vocab.groupBy("dataset", "df").agg(F.count("*").alias("terms"))
    idf = _raw_okapi_idf()
    return (
        by_df.join(sizes, "dataset")
        .groupBy("dataset", "doc_count", "avg_dl")
        .agg(
            F.sum("terms").alias("vocab_size"),
            (F.sum(F.col("terms") * idf) / F.sum("terms")).alias("mean_idf"),
        )
    )


def _raw_okapi_idf() -> Column:
    n, df = F.col("doc_count"), F.col("df")
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def approximate_vocab_size(postings: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Sketch-based vocabulary size for corpora where the exact count is not worth a shuffle."""
    return postings.groupBy("dataset").agg(
        F.approx_count_distinct("term", rsd).alias("vocab_size")
    )


#: Registers of a vocabulary sketch as a power of two; the standard error is 0.8 %.
SKETCH_SIZE = 14


def vocabulary_sketch(postings: DataFrame) -> DataFrame:
    """``dataset, sketch``: a mergeable sketch of the terms, combined in each task."""
    return postings.groupBy("dataset").agg(F.hll_sketch_agg("term", SKETCH_SIZE).alias("sketch"))


def merged_vocab_size(sketches: DataFrame) -> DataFrame:
    """``dataset, vocab_size`` of any number of sketches, whose documents may share terms."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("vocab_size")
    return sketches.groupBy("dataset").agg(union)


def okapi_idf(epsilon: float = 0.25) -> Column:
    """``ln(N-df+0.5) - ln(df+0.5)``; where negative, ``epsilon`` times the mean over all terms."""
    raw = _raw_okapi_idf()
    return F.when(raw < 0, epsilon * F.col("mean_idf")).otherwise(raw)


def positive_idf() -> Column:
    n, df = F.col("doc_count"), F.col("df")
    return F.log((n - df + 0.5) / (df + 0.5) + 1)


def smooth_idf() -> Column:
    return F.log((1 + F.col("doc_count")) / (1 + F.col("df"))) + 1


def weigh_vocabulary(vocab: DataFrame, stats: DataFrame, idf: Column) -> DataFrame:
    """``dataset, term, df, cf, idf``. ``stats`` has one row per collection."""
    weighed = lookup_join(vocab, stats, ["dataset"]).withColumn("idf", idf)
    return weighed.select(*vocab.columns, "idf")


def tfidf_parts(postings: DataFrame, vocab: DataFrame, stats: DataFrame) -> DataFrame:
    """Postings with the unnormalised weight ``w = tf * (ln((1+N)/(1+df)) + 1)``."""
    idf = weigh_vocabulary(vocab, stats, smooth_idf()).select(*TERM, "idf")
    counts = vocab.select(*TERM, F.col("df").alias("__n"))
    return lookup_join(postings, idf, TERM, counts=counts).withColumn("w", F.col("tf") * F.col("idf"))


def tfidf_norms(postings: DataFrame, vocab: DataFrame, stats: DataFrame) -> DataFrame:
    parts = tfidf_parts(postings, vocab, stats)
    return parts.groupBy(DOC).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def with_norms(rows: DataFrame, norms: DataFrame) -> DataFrame:
    """Join by document. Both sides are bucketed by ``doc_id``.

    The collections are compared by two inequalities: as an equality they would become a second
    join key, for which Spark would shuffle all rows again.
    """
    norms = norms.select(F.col("doc_id").alias("__doc"), F.col("dataset").alias("__set"), "norm")
    same = (F.col("dataset") <= F.col("__set")) & (F.col("dataset") >= F.col("__set"))
    return rows.join(norms, (F.col("doc_id") == F.col("__doc")) & same).drop("__doc", "__set")


def tfidf_weights(index: SearchIndex) -> DataFrame:
    """``dataset, doc_id, term, weight`` with unit-length documents, by the stored norms."""
    parts = tfidf_parts(index.postings, index.vocab, index.stats)
    return with_norms(parts, index.norms).select(
        *DOC, "term", (F.col("w") / F.col("norm")).alias("weight")
    )


def shelf_of(shelves: int) -> Column:
    """The shelf of a term."""
    return F.pmod(F.xxhash64("term"), F.lit(shelves)).cast("int")


def on_shelves(postings: DataFrame, terms: DataFrame, shelves: int) -> DataFrame:
    """The postings on the shelves of the given terms; all others are left out when files are listed.

    The numbers of the shelves go through the driver; they are no more than there are shelves.
    """
    if shelves <= 1 or "shelf" not in postings.columns:
        return postings
    wanted = terms.select(shelf_of(shelves).alias("shelf")).distinct().collect()
    return postings.where(F.col("shelf").isin([r.shelf for r in wanted]))


def lookup_postings(postings: DataFrame, terms: DataFrame, shelves: int = 1) -> DataFrame:
    """The postings of the given terms; a term that is not indexed gives no rows."""
    postings = on_shelves(postings, terms, shelves)
    keys = TERM if "dataset" in terms.columns else ["term"]
    return lookup_join(postings, terms.select(keys).distinct(), keys)


def lookup_doc_lengths(ids: DataFrame, lengths: DataFrame) -> DataFrame:
    """Length of each asked document, 0 where it is not indexed."""
    keys = DOC if "dataset" in ids.columns else ["doc_id"]
    found = ids.select(keys).join(lengths.select(*keys, "dl"), keys, "left")
    return found.withColumn("dl", F.coalesce("dl", F.lit(0)))


@dataclass(frozen=True)
class SearchIndex:
    """The tables that retrieval reads."""

    postings: DataFrame
    lengths: DataFrame
    vocab: DataFrame
    stats: DataFrame
    norms: DataFrame
    path: str | None = None
    shelves: int = 1
    few_collections: bool | None = None  # whether ``stats`` was found small enough to broadcast


LAYOUT = {
    "postings": ("doc_id", "term"),
    "lengths": ("doc_id", "doc_id"),
    "vocab": ("term", "term"),
    "norms": ("doc_id", "doc_id"),
}
LAYOUT_SCHEMA = "buckets int, shelves int"


def save_buckets(
    df: DataFrame, path: str, name: str, buckets: int, key: str, order: list[str], shelves: int = 1, move: bool = True
) -> DataFrame:
    """Write a bucketed table: later joins and aggregates on its key need no shuffle.

    Rows are cut into shelves while they are written, without a further shuffle. ``move=False`` is
    for rows that lie in the buckets of their key already.
    """
    spark = df.sparkSession
    table = f"termlight_{name}_{uuid.uuid4().hex}"
    if move:
        df = df.repartition(buckets, key)
    if shelves > 1:
        df = df.withColumn("shelf", shelf_of(shelves))
    writer = df.write.bucketBy(buckets, key).sortBy(*order)
    if shelves > 1:
        writer = writer.partitionBy("shelf")
    writer.option("path", f"{path}/{name}").saveAsTable(table)
    return spark.table(table)


def _save(df: DataFrame, path: str, name: str, buckets: int, shelves: int = 1) -> DataFrame:
    key, order = LAYOUT[name]
    return save_buckets(df, path, name, buckets, key, [order], shelves)


def _open(spark: SparkSession, path: str, name: str, buckets: int, shelves: int = 1) -> DataFrame:
    """Declare the files of a saved table again, with their buckets."""
    key, order = LAYOUT[name]
    table = f"termlight_{name}_{uuid.uuid4().hex}"
    fields = spark.read.parquet(f"{path}/{name}").schema.fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    partitions = "PARTITIONED BY (shelf) " if shelves > 1 else ""
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet {partitions}CLUSTERED BY ({key}) SORTED BY ({order}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/{name}'"
    )
    if shelves > 1:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def save_index(postings: DataFrame, buckets: int, path: str | None = None, shelves: int = 1) -> SearchIndex:
    """Write the index tables, each built from the ones already written."""
    spark = postings.sparkSession
    path = path or new_folder(spark, "index")
    postings = _save(postings, path, "postings", buckets, shelves)
    lengths = _save(doc_lengths(postings), path, "lengths", buckets)
    vocab = _save(vocabulary(postings), path, "vocab", buckets)
    corpus_stats(lengths, vocab).write.parquet(f"{path}/stats")
    stats = spark.read.schema(STATS).parquet(f"{path}/stats")
    norms = _save(tfidf_norms(postings, vocab, stats), path, "norms", buckets)
    spark.createDataFrame([(buckets, shelves)], LAYOUT_SCHEMA).write.parquet(f"{path}/layout")
    return SearchIndex(postings, lengths, vocab, stats, norms, path, shelves, fits_broadcast(stats))


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """Read a saved index from its folder, in this or a later session."""
    layout = spark.read.schema(LAYOUT_SCHEMA).parquet(f"{path}/layout").first()
    shelves = {"postings": layout.shelves or 1}
    tables = {name: _open(spark, path, name, layout.buckets, shelves.get(name, 1)) for name in LAYOUT}
    stats = spark.read.schema(STATS).parquet(f"{path}/stats")
    few = fits_broadcast(stats)
    return SearchIndex(**tables, stats=stats, path=path, shelves=shelves["postings"], few_collections=few)


def build_index(
    docs: DataFrame,
    mode: str = "default",
    lemmas: DataFrame | None = None,
    skip_ids: DataFrame | None = None,
    buckets: int | None = None,
    path: str | None = None,
    ordinal: str | None = None,
    shelves: int = 1,
) -> SearchIndex:
    """Analyze, count and write: the offline half of a search system.

    ``buckets`` is by default what leaves ``TEXT_BYTES`` of text in each, and the number of shuffle
    partitions at least. ``shelves`` cuts the postings of a bucket by term; a shelf of a bucket is a
    file and should keep some tens of MB, so that a large index has few hundred buckets and as many
    or more shelves.
    """
    buckets = buckets or text_partitions(docs)
    postings = build_postings(docs, mode, lemmas, skip_ids, buckets, ordinal)
    return save_index(postings, buckets, path, shelves)


def processed(docs: DataFrame, mode: str = "default", lemmas: DataFrame | None = None) -> DataFrame:
    """``doc_id, tokens`` for every document, empty ones included."""
    return analyze(docs, ["doc_id"], "text", mode, lemmas)
