"""Text normalisation and tokenisation as built-in column expressions (no Python per row)."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from termlight.functions.wordlists import (
    FEEDBACK_STOP_WORDS,
    FUSED_WORDS,
    NUMBER_WORDS,
    STOP_WORDS,
)

# Python counts the separators 0x1c-0x1f as white space, Java does not.
ASCII_SPACE = r"[\x09-\x0d\x1c-\x20]+"
URL = r"(?U)https?://[^\s\x1c-\x1f]+|www\.[^\s\x1c-\x1f]+"
TAG = r"<[^>]+>"
ENTITY = r"(?U)&\w+;"
STANDALONE_NUMBER = r"\b[0-9]+\b"
ALPHABETIC_WORD = r"(?<![0-9a-z])[a-z]{2,}+(?![0-9a-z])"


@lru_cache(maxsize=1)
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """What compatibility decomposition leaves of each non-ASCII character in ASCII.

    Returns the characters that become one character and those that become several. Punctuation is
    already a space here, since a later step of the normaliser would make it one. Characters that
    leave nothing are absent. The planes above 0x1ffff decompose to no ASCII.
    """
    one: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0x80, 0x20000):
        char = chr(code)
        ascii_part = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        folded = "".join(" " if c in string.punctuation else c for c in ascii_part)
        if folded:
            if not folded.strip():
                folded = " "
            (one if len(folded) == 1 else several)[char] = folded
    return one, several


def _ranges(chars: list[str], gap: int = 64) -> str:
    """A character class of a few ranges that covers ``chars`` (and some of what lies between)."""
    runs: list[list[str]] = []
    for char in sorted(chars):
        if runs and ord(char) - ord(runs[-1][1]) <= gap:
            runs[-1][1] = char
        else:
            runs.append([char, char])
    return "[" + "".join(f"{first}-{last}" for first, last in runs) + "]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _if(applies: Callable[[Column], Column], use: Callable[[Column], Column], value: Column) -> Column:
    """``use(value)`` where a cheap test says that it can change anything."""
    return bind(value, lambda v: F.when(applies(v), use(v)).otherwise(v))


def _fold_to_ascii(text: Column) -> Column:
    """Drop accents and all that has no ASCII form; punctuation among the results is a space."""
    one, several = _folds()
    rare = _ranges(list(several))
    entries = ",".join(f"{char}:{spelled}" for char, spelled in several.items())
    table = F.str_to_map(F.lit(entries), F.lit(","), F.lit(":"))

    def not_ascii(text: Column) -> Column:
        return F.char_length(text) != F.octet_length(text)

    def spell_out(text: Column) -> Column:
        chars = F.transform(F.split(text, ""), lambda c: F.coalesce(F.element_at(table, c), c))
        return F.array_join(chars, "")

    def drop_rest(text: Column) -> Column:
        spelled = _if(lambda t: t.rlike(rare), spell_out, text)
        return F.regexp_replace(spelled, r"[^\x00-\x7F]+", "")

    def fold(text: Column) -> Column:
        # The one-to-one table leaves most texts pure ASCII; the dear class is tried on the rest.
        folded = F.translate(text, "".join(one), "".join(one.values()))
        return _if(not_ascii, drop_rest, folded)

    return _if(not_ascii, fold, text)


def _clean(text: Column) -> Column:
    """Lower-case ASCII without URLs, tags and entities."""

    def blank(pattern: str) -> Callable[[Column], Column]:
        return lambda t: F.regexp_replace(t, pattern, " ")

    text = F.lower(text)
    text = _if(lambda t: t.contains("://") | t.contains("www."), blank(URL), text)
    text = _if(lambda t: t.contains("<"), blank(TAG), text)
    text = _if(lambda t: t.contains("&"), blank(ENTITY), text)
    return _fold_to_ascii(text)


def normalize(text: Column) -> Column:
    """Lower-case, drop URLs, tags, entities and accents, blank punctuation and lone numbers.

    Null and blank text give the empty string.
    """
    text = F.translate(_clean(text), string.punctuation, " " * len(string.punctuation))
    text = F.regexp_replace(text, STANDALONE_NUMBER, " ")
    text = F.trim(F.regexp_replace(text, ASCII_SPACE, " "))
    return F.coalesce(text, F.lit(""))


def tokenize(normalized: Column) -> Column:
    """Words of a normalised text; the fused forms (``cannot``, ``gonna``...) are taken apart."""
    for fused, parts in FUSED_WORDS.items():
        normalized = F.regexp_replace(normalized, rf"\b{fused}\b", parts)
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def without(tokens: Column, words: list[str], token: str = "t") -> Column:
    """The tokens that are not among ``words``; ``token`` says how one token ``t`` is compared."""
    if not words:
        return tokens
    # One parsed expression: several hundred literals would each cost a call to the JVM.
    listed = ", ".join('"' + w.replace("\\", "\\\\").replace('"', '\\"') + '"' for w in words)
    return F.call_function("filter", tokens, F.expr(f"t -> {token} NOT IN ({listed})"))


def remove_stopwords(tokens: Column, stop_words: list[str] | None = None) -> Column:
    return without(tokens, STOP_WORDS if stop_words is None else stop_words, "lower(t)")


def remove_punctuation_tokens(tokens: Column) -> Column:
    """Drop tokens made of ASCII punctuation only, and the empty token."""
    return F.filter(tokens, lambda t: ~t.rlike(r"^\p{Punct}*$"))


def min_length(tokens: Column, length: int = 2) -> Column:
    return F.filter(tokens, lambda t: F.char_length(t) >= length)


def content_words(text: Column, stop_words: list[str] | None = None) -> Column:
    """Words of two or more letters of a raw text that are neither stop words nor number words.

    A text with stop words only keeps those. The words are those of the normalised text:
    punctuation, blanks and lone numbers only separate words, so they need no clean-up here.
    """
    stop = STOP_WORDS if stop_words is None else stop_words
    text = F.lower(F.coalesce(_clean(text), F.lit("")))
    words = F.regexp_extract_all(text, F.lit(ALPHABETIC_WORD), F.lit(0))

    def choose(words: Column) -> Column:
        strict = without(words, [*stop, *NUMBER_WORDS])
        relaxed = without(words, NUMBER_WORDS)
        return bind(strict, lambda kept: F.when(F.size(kept) > 0, kept).otherwise(relaxed))

    return bind(words, choose)


def feedback_words(text: Column) -> Column:
    """Letter runs of the lower-cased text that may serve as feedback terms."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-zA-Z]+"), F.lit(0))
    return without(F.filter(words, lambda t: F.length(t) > 2), FEEDBACK_STOP_WORDS)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= 0.05, "POSITIVE").when(compound <= -0.05, "NEGATIVE").otherwise("NEUTRAL")
    )


def output_score(score: Column) -> Column:
    """The four digits a search response shows."""
    return F.round(score, 4)
