"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once for each document and keeps the measurements and one bit for
each failed rule. What to do about it is a versioned policy, a mask of bits: ``judged`` applies one
to the ledger and ``ablation`` tells, from counts of the distinct masks alone, what each rule of a
policy is responsible for. A new policy or threshold study on the masks reads no text again.

All work is built-in expressions without a shuffle; ``ablation`` exchanges one row for each distinct
mask and task. A null or empty text has no words: all its measurements are 0 and it fails
``few_words``. Repeated rows are judged alike, once each. An empty table gives an empty ledger.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.llm.tables import BLANK_CLASS, BLANKS, let, plain

WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: The bit of each rule; a bit is never given to another rule.
BITS = {"few_words": 0, "repeated_windows": 1, "symbols": 2, "repeated_lines": 3,
        "short_words": 4, "long_words": 5}
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"),
}


def _conditions() -> dict[str, Column]:
    """When a rule fails. The first two are the base rules; the others keep wide margins."""
    words = F.col("n_words")
    return {
        "few_words": words < 10,
        "repeated_windows": F.col("n_repeat_words") * 100 > words * 20,
        "symbols": F.col("n_symbols") * 10 > words,
        "repeated_lines": F.col("n_dup_lines") * 2 > F.col("n_lines"),
        "short_words": F.col("word_chars") < words * 2,
        "long_words": F.col("word_chars") > words * 30,
    }


def policy_mask(policy: str) -> int:
    return sum(1 << BITS[name] for name in POLICIES[policy])


def _window_hashes(words: Column, n: Column) -> Column:
    """A 64-bit hash for each run of five words."""
    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)])
        )

    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur more than once, each word counted once."""
    def repeated(s: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))

        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(at, lambda i: F.get(s, i)["at"]))

    def total(p: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1),
            F.lit(0),
            lambda sum_, i: sum_ + F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - F.get(p, i), F.lit(WINDOW))),
        )

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return let(let(ordered, repeated), total)


def measurements(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and the measurements."""
    trimmed = F.btrim("text", F.lit(BLANKS))
    parts = plain(docs, id_column, text_column).select(
        "doc_id",
        "text",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_CLASS + "+")).alias("__words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("__lines"),
    )
    sized = parts.select(
        "doc_id", "__words", F.size("__words").alias("__n"),
        F.length(F.array_join("__words", "")).alias("__chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).alias("__symbols"),
        F.size("__lines").alias("__line_count"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("__dup"),
    )
    windows = sized.withColumn("__windows", _window_hashes(F.col("__words"), F.col("__n"))).drop("__words")
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    return windows.select(
        "doc_id",
        F.col("__n").cast("long").alias("n_words"),
        F.col("__chars").cast("long").alias("word_chars"),
        F.col("__symbols").cast("long").alias("n_symbols"),
        F.col("__line_count").cast("long").alias("n_lines"),
        F.col("__dup").cast("long").alias("n_dup_lines"),
        F.when(some, _covered(F.col("__windows"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The measurements and ``failed``, a long with a bit for each rule that the text fails."""
    bits = [F.when(c, F.lit(1 << BITS[rule])).otherwise(F.lit(0)) for rule, c in _conditions().items()]
    failed = reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long").alias("failed")
    return measurements(docs, id_column, text_column).select("*", failed)


def judged(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy, which always includes the base."""
    def fails(mask: int) -> Column:
        return F.col("failed").bitwiseAND(F.lit(mask)) != 0

    base = policy_mask("base")
    return entries.select("*", fails(base).alias("base_failed"), (~fails(base | policy_mask(policy))).alias("kept"))


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents it fails, fails alone, and kept without it.

    ``entries`` are aggregated to a count for each distinct mask first; there are at most 2 to the
    number of rules of them, so the rest works on a few rows.
    """
    mask = policy_mask(policy)
    counts = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << BITS[name]).cast("long").alias("bit")) for name in POLICIES[policy]]))
    each = counts.select("mask", "n", rules.alias("r")).select("mask", "n", "r.rule", "r.bit")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return each.groupBy("rule").agg(
        total(F.col("mask").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("mask") == F.col("bit")).alias("n_failed_alone"),
        total((F.col("mask") == 0) | (F.col("mask") == F.col("bit"))).alias("n_kept_without"),
    )
