"""Entity and sentiment annotation from dictionary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlight.functions.text import sentiment_label
from termlight.functions.wordlists import NEGATORS
from termlight.operators.joins import lookup_join

WORD = r"\p{L}[\p{L}\p{M}\p{Nd}'-]*"
NEGATION_FACTOR = -0.74
NEGATION_REACH = 3
NORMALIZER = 15


def word_groups(words: Column, n: int) -> Column:
    """Every run of ``n`` neighbouring words with its position."""
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0))),
        lambda i: i + n <= F.size(words),
    )
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("pos"),
            F.lit(n).alias("n"),
            F.array_join(F.slice(words, i + 1, F.lit(n)), " ").alias("entity"),
        ),
    )


def phrase_levels(gazetteer: DataFrame, max_words: int) -> list[DataFrame]:
    """The beginnings of all phrases, by their number of words: ``prefix``, the ``label`` of the phrase
    that ends there, if one does, and whether a phrase goes ``on``. Of several labels the smallest counts.
    """
    parts = F.split("phrase", " ")
    phrases = gazetteer.select("label", parts.alias("parts"), F.size(parts).alias("words"))
    phrases = phrases.where(F.col("words") <= max_words)
    levels = []
    for n in range(1, max_words + 1):
        begun = phrases.where(F.col("words") >= n)
        prefix = F.array_join(F.slice("parts", 1, n), " ").alias("prefix")
        own, on = F.when(F.col("words") == n, F.col("label")), F.col("words") > n
        levels.append(begun.groupBy(prefix).agg(F.min(own).alias("label"), F.max(on).alias("on")))
    return levels


def phrase_matches(docs: DataFrame, gazetteer: DataFrame, max_words: int, key: str) -> DataFrame:
    """``key, pos, n, entity, label`` for every phrase at every place, found word by word.

    A phrase of n words is put together only where its first n - 1 words begin one in the gazetteer,
    so nearly all places end with a look at one word.
    """
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    places = docs.select(key, words.alias("words")).select(key, "words", F.posexplode("words").alias("pos", "word"))
    near = F.slice("words", F.col("pos") + 1, F.lit(max_words)).alias("near")
    found = places.select(key, "pos", near, F.lower("word").alias("prefix"))
    ends = []
    for n, level in enumerate(phrase_levels(gazetteer, max_words), 1):
        if n > 1:
            longer = F.lower(F.array_join(F.slice("near", 1, n), " "))
            found = found.withColumn("prefix", F.when(F.col("on") & (F.size("near") >= n), longer)).drop("on")
        level = level.withColumnRenamed("label", f"label_{n}")
        found = lookup_join(found, level, ["prefix"], "inner" if n == 1 else "left")
        entity = F.array_join(F.slice("near", 1, n), " ").alias("entity")
        match = F.struct(F.lit(n).alias("n"), entity, F.col(f"label_{n}").alias("label"))
        ends.append(F.when(F.col(f"label_{n}").isNotNull(), match))
    matches = F.filter(F.array(*ends), lambda m: m.isNotNull())
    return found.select(key, "pos", F.explode(matches).alias("m")).select(key, "pos", "m.*")


def entities(
    docs: DataFrame, gazetteer: DataFrame, max_words: int, key: str = "doc_id"
) -> DataFrame:
    """``key, pos, entity, label``: the phrases of ``gazetteer(phrase, label)`` found in each text.

    Phrases are lower-case words joined by single spaces, ``max_words`` of them at most. Scanning
    from the left, the longest phrase at a position wins and the next one starts after it. Only
    matches are shuffled, and only matches that touch each other are resolved together.
    """
    found = phrase_matches(docs, gazetteer, max_words, key)
    found = found.withColumn("end", F.col("pos") + F.col("n"))
    # An island is a run of matches that overlap; a match beyond all earlier ends opens a new one.
    order = Window.partitionBy(key).orderBy("pos", F.desc("n"))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("pos") >= reach), 1).otherwise(0)
    found = found.withColumn("__opens", opens)
    found = found.withColumn("island", F.sum("__opens").over(order))
    match = F.struct("pos", (-F.col("n")).alias("size"), "end", "entity", "label")
    islands = found.groupBy(key, "island").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    nothing = F.struct(
        F.lit(0).alias("end"), F.slice("matches", F.lit(1), F.lit(0)).alias("kept")
    )
    chosen = F.aggregate(
        "matches",
        nothing,
        lambda state, m: F.when(
            m["pos"] >= state["end"],
            F.struct(m["end"].alias("end"), F.concat(state["kept"], F.array(m)).alias("kept")),
        ).otherwise(state),
        lambda state: state["kept"],
    )
    kept = islands.select(key, F.explode(chosen).alias("m"))
    return kept.select(
        key,
        F.col("m.pos").cast("long").alias("pos"),
        F.col("m.entity").alias("entity"),
        F.col("m.label").alias("label"),
    )


def sentiment(
    docs: DataFrame,
    lexicon: DataFrame,
    key: str = "doc_id",
    negators: list[str] | None = None,
) -> DataFrame:
    """``key, neg, neu, pos, compound, sentiment`` from ``lexicon(word, valence)``.

    Each negator among the three words before a lexicon word multiplies its valence by -0.74.
    ``compound`` is ``s / sqrt(s^2 + 15)``. The shares count a lexicon word by its absolute valence
    plus 1 and any other word as 1. Text without words is neutral. Intensity words, capitals and
    punctuation are not weighed. Only lexicon words and negators are shuffled.
    """
    turning = NEGATORS if negators is None else negators
    words = docs.select(
        key, F.regexp_extract_all(F.lower("text"), F.lit("[a-z][a-z'-]*"), F.lit(0)).alias("words")
    )
    words = words.withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    tokens = words.select(key, F.posexplode("words").alias("at", "word"))
    listed = lexicon.select("word", F.col("valence").cast("double").alias("valence"))
    turns = docs.sparkSession.createDataFrame([(w,) for w in turning], "word string")
    turns = turns.join(listed, "word", "left_anti").withColumn("valence", F.lit(None).cast("double"))
    marked = lookup_join(tokens, listed.unionByName(turns), ["word"])
    before = Window.partitionBy(key).orderBy("at").rangeBetween(-NEGATION_REACH, -1)
    turned = F.coalesce(F.sum(F.when(F.col("valence").isNull(), 1)).over(before), F.lit(0))
    marked = marked.withColumn("v", F.col("valence") * F.pow(F.lit(NEGATION_FACTOR), turned))
    sums = marked.where(F.col("v").isNotNull()).groupBy(key).agg(
        F.sum("v").alias("s"),
        F.sum(F.when(F.col("v") > 0, F.col("v") + 1).otherwise(0.0)).alias("p"),
        F.sum(F.when(F.col("v") < 0, 1 - F.col("v")).otherwise(0.0)).alias("m"),
        F.count(F.when(F.col("v") != 0, 1)).alias("valued"),
    )
    scored = words.select(key, F.size("words").alias("n")).join(sums, key, "left")
    zero = F.lit(0.0)
    s, p, m = (F.coalesce(c, zero) for c in ("s", "p", "m"))
    plain = F.col("n") - F.coalesce("valued", F.lit(0))
    total = p + m + plain
    share = lambda x, empty: F.when(F.col("n") > 0, F.round(x / total, 3)).otherwise(empty)
    scored = scored.select(
        key,
        share(m, 0.0).alias("neg"),
        share(plain, 1.0).alias("neu"),
        share(p, 0.0).alias("pos"),
        F.round(s / F.sqrt(s * s + NORMALIZER), 4).alias("compound"),
    )
    return scored.withColumn("sentiment", sentiment_label(F.col("compound")))
