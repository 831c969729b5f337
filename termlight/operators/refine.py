"""Query refinement: spelling, synonyms, feedback, suggestions, history."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlight.functions import text as T
from termlight.operators.analyze import analyze
from termlight.operators.index import SearchIndex, save_buckets, with_dataset
from termlight.operators.joins import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    fits_broadcast,
    lookup_join,
    wanted_rows,
)
from termlight.operators.lexical import B, K1, bm25
from termlight.session import cut_lineage, new_folder

MAX_SYNONYMS = 2
SUGGESTIONS = 5
FEEDBACK_DOCS = 5
FEEDBACK_TERMS = 5
PREFIX = 8
MAX_KEYS = 37
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$|^[+-]?(inf|infinity|nan)$"
SPACE = r"(?U)[\s\x1c-\x1f]+"


# --- spelling --------------------------------------------------------------------------------


def _deletions(words: DataFrame, column: str, distance: int) -> DataFrame:
    """Every string left of a word's first letters after up to ``distance`` deletions, as ``key``, with
    the least number of ``deletions`` that leave it.

    Two words within 1 or 2 edits of each other (a swap of neighbours counts as one) turn into the
    same string by as many deletions in each. The beginning of that string comes from the first
    ``PREFIX`` letters of both, again by no more deletions. So an equi-join on the key finds all
    candidates, and a word has at most ``MAX_KEYS`` keys, however long it is.
    """
    start = F.substring(column, 1, PREFIX)
    size = F.char_length(start)
    places = F.filter(F.sequence(F.lit(0), size), lambda i: i > 0)

    def cut(i: Column) -> Column:
        return F.concat(F.substring(start, F.lit(1), i - 1), F.substring(start, i + 1, size))

    keys = [F.array(start), F.array_distinct(F.transform(places, cut))]
    if distance == 2:
        keys.append(F.array_distinct(F.flatten(F.transform(places, lambda i: F.transform(
            F.filter(places, lambda j: j > i),
            lambda j: F.concat(
                F.substring(start, F.lit(1), i - 1),
                F.substring(start, i + 1, j - i - 1),
                F.substring(start, j + 1, size),
            ),
        )))))
    # Strings after one and after two deletions differ in length, so no key comes twice.
    def numbered(n: int) -> Column:
        return F.transform(keys[n], lambda x: F.struct(x.alias("key"), F.lit(n).alias("deletions")))

    entries = [numbered(n) for n in range(len(keys))]
    # An outer explode, as an inner one would also make all keys in a filter below it.
    found = words.withColumn("k", F.explode_outer(F.concat(*entries))).where(F.col("k").isNotNull())
    return found.select(*words.columns, "k.*")


def _swaps(word: Column) -> Column:
    """The word with each pair of neighbours swapped."""
    return F.when(F.char_length(word) > 1, F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(word) - 1, F.lit(1))),
        lambda i: F.concat(
            F.substring(word, F.lit(1), i - 1),
            F.substring(word, i + 1, F.lit(1)),
            F.substring(word, i, F.lit(1)),
            F.substring(word, i + 2, F.char_length(word)),
        ),
    )).otherwise(F.array(word))


def _edits(word: Column, other: Column) -> Column:
    """1 or 2 edits (insert, delete, replace, swap neighbours, one after the other), else null."""
    plain = F.levenshtein(word, other, 2)
    near = lambda w: F.levenshtein(w, other, 1)
    one = (plain == 1) | F.exists(_swaps(word), lambda w: w == other)
    two = (
        (plain == 2)
        | F.exists(_swaps(word), lambda w: near(w) >= 0)
        | F.exists(_swaps(other), lambda w: F.levenshtein(w, word, 1) >= 0)
        | F.arrays_overlap(_swaps(word), _swaps(other))
    )
    return F.when(one, 1).when(two, 2)


@dataclass(frozen=True)
class Speller:
    """A dictionary ``terms(term, cf)``. Few words meet its keys as its terms are read; for more words
    the ``keys(term, cf, key, deletions)`` are written once, when they are first asked for."""

    terms: DataFrame
    path: str
    buckets: int

    @cached_property
    def keys(self) -> DataFrame:
        keys = _deletions(self.terms, "term", 2)
        return save_buckets(keys, self.path, "keys", self.buckets, "key", ["deletions", "key"])


def build_speller(dictionary: DataFrame, buckets: int | None = None) -> Speller:
    """Write a dictionary once, for all later corrections."""
    spark = dictionary.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, "speller")
    terms = save_buckets(dictionary.select("term", "cf"), path, "terms", buckets, "term", ["term"])
    return Speller(terms, path, buckets)


def _candidates(unknown: DataFrame, speller: Speller, distance: int, few: bool) -> DataFrame:
    """``word, term, cf, edits`` for every pair within ``distance`` edits."""
    left = _deletions(unknown.select("word"), "word", distance).select("word", "key")
    if few:
        pairs = _deletions(speller.terms, "term", distance).join(F.broadcast(left), "key")
    else:
        right = speller.keys.where(F.col("deletions") <= distance).select("term", "cf", "key")
        pairs = lookup_join(left, right, ["key"])
    gap = F.abs(F.char_length("word") - F.char_length("term"))
    # A swap is two plain edits, so the plain distance bounds the other cheaply.
    close = (gap <= distance) & (F.levenshtein("word", "term", 2 * distance) > 0)
    pairs = pairs.where(close).select("word", "term", "cf").distinct()
    edits = _edits(F.col("word"), F.col("term"))
    return pairs.withColumn("edits", edits).where(F.col("edits") <= distance)


def corrections(words: DataFrame, dictionary: DataFrame | Speller) -> DataFrame:
    """``word, correction`` for the words that the dictionary lacks and can correct.

    ``dictionary(term, cf)`` is made a speller here, unless it is one. One edit beats two; then the
    more frequent term wins, then the smaller. The wider neighbourhood is searched only for words
    that have nothing at one edit. Numbers and single punctuation marks are never corrected.
    """
    speller = dictionary if isinstance(dictionary, Speller) else build_speller(dictionary)
    checked = words.select("word").distinct().where(
        ~F.col("word").rlike(NUMBER) & ~F.col("word").rlike(r"^\p{Punct}$")
    )
    known = speller.terms.select(F.col("term").alias("word"))
    if fits_broadcast(checked):
        present = known.join(F.broadcast(checked), "word").distinct()
    else:
        present = known
    unknown = checked.join(present, "word", "left_anti")
    unknown = cut_lineage(unknown, "unknown-words")
    # A word has at most MAX_KEYS keys of about its own size.
    few = fits_broadcast(
        unknown, MAX_BROADCAST_ROWS // MAX_KEYS, MAX_BROADCAST_BYTES // MAX_KEYS
    )
    close = cut_lineage(_candidates(unknown, speller, 1, few), "one-edit")
    rest = unknown.join(close.select("word").distinct(), "word", "left_anti")
    found = close.unionByName(_candidates(rest, speller, 2, few))
    best = F.min_by("term", F.struct("edits", (-F.col("cf")).alias("less"), "term"))
    return cut_lineage(found.groupBy("word").agg(best.alias("correction")), "corrections")


def correct_spelling(queries: DataFrame, dictionary: DataFrame | Speller, key: str = "query_id") -> DataFrame:
    """Add ``corrected``: the white-space separated words, each corrected where possible."""
    words = queries.select(
        key, F.posexplode_outer(F.filter(F.split("text", SPACE), lambda w: w != "")).alias("pos", "raw")
    ).withColumn("word", F.lower("raw"))
    fixed = corrections(words.where(F.col("word").isNotNull()), dictionary)
    joined = lookup_join(words, fixed, ["word"], how="left")
    entry = F.when(
        F.col("raw").isNotNull(), F.struct("pos", F.coalesce("correction", "raw").alias("w"))
    )
    lines = joined.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["w"]), " ").alias(
            "corrected"
        )
    )
    return queries.join(lines, key, "left")


# --- synonyms --------------------------------------------------------------------------------


def expand_synonyms(
    queries: DataFrame,
    synonyms: DataFrame,
    per_term: int = MAX_SYNONYMS,
    key: str = "query_id",
) -> DataFrame:
    """``key, expanded_tokens``: the tokens, then up to ``per_term`` synonyms of each in turn.

    ``synonyms(term, ord, synonym)``; underscores become spaces and the term itself is no synonym.
    """
    order = Window.partitionBy("term").orderBy("ord", "synonym")
    usable = synonyms.withColumn("synonym", F.translate("synonym", "_", " ")).where(
        F.col("synonym") != F.col("term")
    )
    picked = usable.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= per_term
    )
    listed = picked.groupBy("term").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "synonym"))), lambda e: e["synonym"]
        ).alias("more")
    )
    tokens = queries.select(key, F.posexplode_outer("tokens").alias("pos", "term"))
    joined = lookup_join(tokens, listed, ["term"], how="left")
    entry = F.when(F.col("term").isNotNull(), F.struct("pos", "term", "more"))
    entries = F.array_sort(F.collect_list(entry))
    none = F.array().cast("array<string>")
    return joined.groupBy(key).agg(
        F.concat(
            F.transform(entries, lambda e: e["term"]),
            F.flatten(F.transform(entries, lambda e: F.coalesce(e["more"], none))),
        ).alias("expanded_tokens")
    )


# --- feedback --------------------------------------------------------------------------------


def feedback_counts(docs: DataFrame) -> DataFrame:
    """``dataset, doc_id, word, n, first``: usable words of each text with their first position."""
    words = docs.select(
        "dataset", "doc_id", F.posexplode(T.feedback_words(F.col("text"))).alias("at", "word")
    )
    return words.groupBy("dataset", "doc_id", "word").agg(
        F.count("*").alias("n"), F.min("at").alias("first")
    )


def feedback_terms(
    run: DataFrame, documents: DataFrame, terms: int = FEEDBACK_TERMS, key: str = "query_id"
) -> DataFrame:
    """``key, words``: the most frequent words over the texts a query retrieved.

    Ties go to the word met first, reading the documents in rank order. Each retrieved text is
    counted once, however many queries retrieved it.
    """
    documents = with_dataset(documents).select("dataset", "doc_id", "text")
    wanted = run.select("dataset", "doc_id").distinct()
    texts = wanted_rows(documents, wanted, ["dataset", "doc_id"])
    hits = run.select(key, "dataset", "doc_id", "rank").join(
        feedback_counts(texts), ["dataset", "doc_id"]
    )
    totals = hits.groupBy(key, "word").agg(
        F.sum("n").alias("n"), F.min(F.struct("rank", "first")).alias("first")
    )
    order = Window.partitionBy(key).orderBy(F.desc("n"), "first")
    best = totals.withColumn("place", F.row_number().over(order)).where(F.col("place") <= terms)
    ordered = F.array_sort(F.collect_list(F.struct("place", "word")))
    return best.groupBy(key).agg(F.transform(ordered, lambda e: e["word"]).alias("words"))


def relevance_feedback(
    index: SearchIndex,
    queries: DataFrame,
    documents: DataFrame,
    docs: int = FEEDBACK_DOCS,
    terms: int = FEEDBACK_TERMS,
    k1: float = K1,
    b: float = B,
    key: str = "query_id",
) -> DataFrame:
    """Add ``prf_query``: the query ``text`` with the feedback words appended.

    ``queries`` need ``key, text, tokens``. A query that retrieves no usable word is unchanged.
    """
    run = cut_lineage(bm25(index, queries, docs, k1, b, keys=[key]), "feedback-run")
    words = feedback_terms(run, documents, terms, key)
    expanded = F.concat_ws(" ", "text", F.array_join("words", " "))
    return (
        queries.join(words, key, "left")
        .withColumn("prf_query", F.when(F.col("words").isNotNull(), expanded).otherwise(F.col("text")))
        .drop("words")
    )


# --- history ---------------------------------------------------------------------------------


def _token_set(text: str) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), SPACE), lambda w: w != ""))


def suggest(queries: DataFrame, history: DataFrame, k: int = SUGGESTIONS) -> DataFrame:
    """``query_id, suggestion_rank, suggestion``: the user's newest entries that share a word.

    ``queries(query_id, user_id, text)``, ``history(user_id, pos, query)``. An entry equal to the
    query is left out; repeated entries stay.

    For one word of one user, the newest ``k`` entries of each text and of those the newest ``2k``
    are enough: one text can be the query itself, which leaves at least ``k`` of the newest. So the
    join never meets more than ``2k`` entries per word, whatever the length of the history.
    """
    past = history.select("user_id", "pos", "query", F.explode(_token_set("query")).alias("word"))
    newest = F.col("pos").desc()
    same = Window.partitionBy("user_id", "word", "query").orderBy(newest)
    any_text = Window.partitionBy("user_id", "word").orderBy(newest)
    past = past.withColumn("__n", F.row_number().over(same)).where(F.col("__n") <= k)
    past = past.withColumn("__n", F.row_number().over(any_text)).where(F.col("__n") <= 2 * k)
    asked = queries.select(
        "query_id", "user_id", "text", F.explode(_token_set("text")).alias("word")
    )
    hits = (
        asked.join(past.drop("__n"), ["user_id", "word"])
        .where(F.col("query") != F.col("text"))
        .groupBy("query_id", "pos")
        .agg(F.first("query").alias("suggestion"))
    )
    order = Window.partitionBy("query_id").orderBy(newest)
    ranked = hits.withColumn("suggestion_rank", F.row_number().over(order))
    ranked = ranked.where(F.col("suggestion_rank") <= k)
    return ranked.select(
        "query_id", F.col("suggestion_rank").cast("long").alias("suggestion_rank"), "suggestion"
    )


def append_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """The history with the new entries behind it; of equal entries of a user the first stays."""
    shift = history.groupBy("user_id").agg(F.max("pos").alias("__last"))
    later = new.join(shift, "user_id", "left").withColumn(
        "pos", F.col("pos") + F.coalesce(F.col("__last") + 1, F.lit(0))
    )
    entries = history.select("user_id", "pos", "query").unionByName(
        later.select("user_id", "pos", "query")
    )
    return entries.groupBy("user_id", "query").agg(F.min("pos").alias("pos")).select(
        "user_id", "pos", "query"
    )


# --- the whole refinement --------------------------------------------------------------------


def refine(
    queries: DataFrame,
    index: SearchIndex,
    documents: DataFrame,
    dictionary: DataFrame | Speller,
    synonyms: DataFrame,
    history: DataFrame | None = None,
    mode: str = "default",
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """Spelling, analysis, synonyms, feedback, suggestions; each step is a flag of the row.

    ``queries(query_id, text)`` may have ``dataset``, ``user_id`` and the flags
    ``use_spell_correction`` (default true), ``use_synonyms`` (false) and ``use_prf`` (false).
    Adds ``corrected, tokens, expanded_tokens, prf_query, suggestions``. Feedback text is analysed
    again and takes the place of the expanded tokens.
    """
    defaults = {"use_spell_correction": True, "use_synonyms": False, "use_prf": False}
    for flag, value in defaults.items():
        if flag not in queries.columns:
            queries = queries.withColumn(flag, F.lit(value))
    queries = with_dataset(queries)
    to_correct = queries.where("use_spell_correction").select("query_id", "text")
    fixed = correct_spelling(to_correct, dictionary).select("query_id", "corrected")
    rows = queries.join(fixed, "query_id", "left").withColumn(
        "corrected", F.coalesce("corrected", "text", F.lit(""))
    )
    tokens = analyze(rows, ["query_id"], "corrected", mode, lemmas)
    rows = cut_lineage(rows.join(tokens, "query_id"), "refined")

    asked = rows.where("use_prf").select(
        "query_id", "dataset", F.col("corrected").alias("text"), "tokens"
    )
    fed = relevance_feedback(index, asked, documents).select("query_id", "prf_query")
    fed_tokens = analyze(fed, ["query_id"], "prf_query", mode, lemmas).withColumnRenamed(
        "tokens", "prf_tokens"
    )
    rows = rows.join(fed.join(fed_tokens, "query_id"), "query_id", "left")
    final = F.coalesce("prf_tokens", "tokens")
    wide = rows.where("use_synonyms").select("query_id", final.alias("tokens"))
    rows = rows.join(expand_synonyms(wide, synonyms), "query_id", "left").withColumn(
        "expanded_tokens", F.coalesce("expanded_tokens", final)
    ).drop("prf_tokens")
    if history is None or "user_id" not in rows.columns:
        return rows.withColumn("suggestions", F.array().cast("array<string>"))
    entry = F.struct("suggestion_rank", "suggestion")
    offers = suggest(rows, history).groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["suggestion"]).alias(
            "suggestions"
        )
    )
    return rows.join(offers, "query_id", "left").withColumn(
        "suggestions", F.coalesce("suggestions", F.array().cast("array<string>"))
    )
