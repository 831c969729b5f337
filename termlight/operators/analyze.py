"""Analyzer pipelines: raw text to index terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlight.functions import text as T
from termlight.functions.porter import stem_word
from termlight.operators.joins import lookup_join
from termlight.session import cut_lineage

MODES = ("default", "stem", "lemma")


def plain_tokens(
    df: DataFrame,
    text_col: str = "text",
    mode: str = "default",
    stop_words: list[str] | None = None,
    out: str = "tokens",
) -> DataFrame:
    """Add the filtered tokens of ``text_col``, before any stemming or lemma lookup.

    ``default`` keeps alphabetic words that are neither stop words nor number words; a text that
    has only stop words keeps those. ``stem`` and ``lemma`` split into words and drop stop words,
    punctuation and single characters.
    """
    if mode not in MODES:
        raise ValueError(f"unknown analyzer mode {mode!r}; use one of {MODES}")
    if mode == "default":
        return df.withColumn(out, T.content_words(F.col(text_col), stop_words))
    tokens = T.tokenize(T.normalize(F.col(text_col)))
    tokens = T.remove_punctuation_tokens(T.remove_stopwords(tokens, stop_words))
    return df.withColumn(out, T.min_length(tokens))


def explode_tokens(df: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """One row per token with its position; a row without tokens stays as one row of nulls."""
    return df.select(*keys, F.posexplode_outer(tokens).alias("pos", "term"))


def collect_tokens(exploded: DataFrame, keys: list[str], out: str = "tokens") -> DataFrame:
    """The token arrays again, in order. A group is one text, so it was one row before."""
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "term"))
    ordered = F.array_sort(F.collect_list(entry))
    return exploded.groupBy(keys).agg(F.transform(ordered, lambda e: e["term"]).alias(out))


def stem_table(terms: DataFrame) -> DataFrame:
    """``form, term`` for every distinct word, so that each is stemmed once.

    The words are few bytes and much work: with their number given, they stay dealt to all tasks.
    """
    tasks = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        terms.where(F.col("term").isNotNull())
        .select(F.col("term").alias("form"))
        .distinct()
        .repartition(tasks, "form")
        .withColumn("term", stem_word(F.col("form")))
    )


def changed_stems(terms: DataFrame) -> DataFrame:
    """The rows of ``stem_table`` that are not the word itself, written once for all that read them.

    They are chosen behind the written table: Spark would copy a filter on the stem below the
    distinct words, and stem every occurrence.
    """
    return cut_lineage(stem_table(terms), "stems").where(F.col("term") != F.col("form"))


def replace_terms(exploded: DataFrame, table: DataFrame) -> DataFrame:
    """Replace each ``term`` by the table's entry for that form; unknown forms pass through."""
    table = table.select(
        F.col("form").alias("__form"), F.lower("term").alias("__term")
    ).dropDuplicates(["__form"])
    joined = lookup_join(
        exploded.withColumnRenamed("term", "__form"), table, ["__form"], how="left"
    )
    return joined.withColumn("term", F.coalesce("__term", "__form")).drop("__form", "__term")


def analyze(
    df: DataFrame,
    keys: list[str],
    text_col: str = "text",
    mode: str = "default",
    lemmas: DataFrame | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """``keys, tokens`` for every row of ``df``; ``keys`` must identify the rows.

    ``lemmas(form, term)`` is the dictionary of the lemma modes. Without one, and when not
    stemming, the result is a plain projection with no shuffle.
    """
    tokens = plain_tokens(df, text_col, mode, stop_words).select(*keys, "tokens")
    if mode == "stem":
        # The tokens are read for the table and for each part of the join, and analysed once.
        exploded = explode_tokens(cut_lineage(tokens, "tokens"), keys)
        return collect_tokens(replace_terms(exploded, changed_stems(exploded)), keys)
    if lemmas is not None:
        return collect_tokens(replace_terms(explode_tokens(tokens, keys), lemmas), keys)
    return tokens
