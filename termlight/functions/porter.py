"""Porter's suffix stripping (Program 14(3), 1980), with the usual later amendments, as one expression.

The amendments: short words and a few irregular forms are left alone, ``-ies``/``-ied`` keep the
``e`` in four-letter words, a final ``y`` changes only after a consonant that is not the first
letter, and step 2 knows ``-bli``, ``-fulli`` and ``-logi``.

The tables of suffixes are compiled to built-in expressions: a step looks up the first suffix that
fits, works out the shape of what is in front of it once, and tests it by a pattern.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from termlight.functions.text import bind

# Forms that the rules would get wrong.
IRREGULAR = {
    "skies": "sky", "sky": "sky",
    "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news",
    "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# The suffix tables of steps 2, 3 and 4; the first suffix that fits decides.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


#: Shapes: a vowel before a consonant once, and twice; the short endings of a stem.
ONCE, TWICE = "vc", "vc.*vc"


def shape(word: Column) -> Column:
    """The word as a string of ``c`` and ``v``; y is a vowel after a consonant."""
    letters = F.regexp_replace(F.regexp_replace(word, "(?s)[^aeiouy]", "c"), "[aeiou]", "v")
    # A run of y behind a consonant begins with a vowel; any other, and what is left, with a consonant.
    pairs = F.replace(F.replace(letters, F.lit("cy"), F.lit("cv")), F.lit("yy"), F.lit("cv"))
    return F.replace(pairs, F.lit("y"), F.lit("c"))


def _cut(word: Column, letters: int | Column) -> Column:
    return F.left(word, F.length(word) - letters)


def _ends(word: Column, *suffixes: str) -> Column:
    found = word.endswith(suffixes[0])
    for suffix in suffixes[1:]:
        found |= word.endswith(suffix)
    return found


def _short(word: Column, form: Column) -> Column:
    """Consonant, vowel, consonant at the end (the last not w, x or y), or just vowel, consonant."""
    return (form.endswith("cvc") & ~_ends(word, "w", "x", "y")) | (form == "vc")


def _rule(word: Column, table: list[tuple[str, str]], use: Callable[[Column, Column, Column], Column]) -> Column:
    """``use(stem, suffix, replacement)`` for the first suffix of the table that fits, else the word."""
    found = F
    for suffix, to in table:
        found = found.when(word.endswith(suffix), F.struct(F.lit(suffix).alias("suffix"), F.lit(to).alias("to")))
    return bind(found, lambda f: F.when(f.isNull(), word).otherwise(
        bind(_cut(word, F.length(f["suffix"])), lambda stem: use(stem, f["suffix"], f["to"]))
    ))


def _swap(word: Column, table: list[tuple[str, str]]) -> Column:
    def use(stem: Column, suffix: Column, to: Column) -> Column:
        measured = F.when(suffix == "logi", F.concat(stem, F.lit("l"))).otherwise(stem)
        return F.when(shape(measured).contains(ONCE), F.concat(stem, to)).otherwise(word)

    return _rule(word, table, use)


def _plurals(word: Column) -> Column:
    ies = F.when(F.length(word) == 4, _cut(word, 1)).otherwise(_cut(word, 2))
    plain = F.when(word.endswith("s") & ~word.endswith("ss"), _cut(word, 1)).otherwise(word)
    return F.when(word.endswith("ies"), ies).when(word.endswith("sses"), _cut(word, 2)).otherwise(plain)


def _mended(stem: Column) -> Column:
    """What is left of -ed and -ing, with its e again or without its double consonant."""
    def use(form: Column) -> Column:
        doubled = stem.rlike(r"(?s)(.)\1$") & form.endswith("c")
        single = F.when(_ends(stem, "l", "s", "z"), stem).otherwise(_cut(stem, 1))
        once = form.contains(ONCE) & ~form.rlike(TWICE) & _short(stem, form)
        with_e = F.concat(stem, F.lit("e"))
        return F.when(_ends(stem, "at", "bl", "iz"), with_e).when(doubled, single).when(once, with_e).otherwise(stem)

    return bind(shape(stem), use)


def _past_and_gerund(word: Column) -> Column:
    ied = F.when(F.length(word) == 4, _cut(word, 1)).otherwise(_cut(word, 2))
    eed = F.when(shape(_cut(word, 3)).contains(ONCE), _cut(word, 1)).otherwise(word)
    found = F.when(word.endswith("ied"), ied).when(word.endswith("eed"), eed)
    letters = F.when(word.endswith("ed"), 2).when(word.endswith("ing"), 3)
    dropped = bind(_cut(word, letters), lambda stem: F.when(shape(stem).contains("v"), _mended(stem)).otherwise(word))
    return found.when(letters.isNotNull(), dropped).otherwise(word)


def _final_y(word: Column) -> Column:
    behind = shape(_cut(word, 1)).endswith("c")
    changed = F.when(behind, F.concat(_cut(word, 1), F.lit("i"))).otherwise(word)
    return F.when(word.endswith("y") & (F.length(word) > 2), changed).otherwise(word)


def _alli(word: Column) -> Column:
    shorter = F.when(shape(_cut(word, 4)).contains(ONCE), _cut(word, 2)).otherwise(word)
    return F.when(word.endswith("alli"), shorter).otherwise(word)


def _residual(word: Column) -> Column:
    def use(stem: Column, suffix: Column, to: Column) -> Column:
        fits = shape(stem).rlike(TWICE) & ((suffix != "ion") | _ends(stem, "s", "t"))
        return F.when(fits, stem).otherwise(word)

    return _rule(word, [(suffix, "") for suffix in STEP_4], use)


def _final_e(word: Column) -> Column:
    def use(stem: Column, form: Column) -> Column:
        drop = form.rlike(TWICE) | (form.contains(ONCE) & ~_short(stem, form))
        return F.when(drop, stem).otherwise(word)

    cut = bind(_cut(word, 1), lambda stem: bind(shape(stem), lambda form: use(stem, form)))
    return F.when(word.endswith("e"), cut).otherwise(word)


def _double_l(word: Column) -> Column:
    shorter = F.when(shape(_cut(word, 1)).rlike(TWICE), _cut(word, 1)).otherwise(word)
    return F.when(word.endswith("ll"), shorter).otherwise(word)


STEPS = [
    _plurals, _past_and_gerund, _final_y, _alli, lambda w: _swap(w, STEP_2), lambda w: _swap(w, STEP_3),
    _residual, _final_e, _double_l,
]


def stem_word(word: Column) -> Column:
    """The stem of a word, in lower case; null stays null."""
    def stem(lowered: Column) -> Column:
        found = lowered
        for step in STEPS:
            found = bind(found, step)
        irregular = F
        for form, to in IRREGULAR.items():
            irregular = irregular.when(lowered == form, to)
        return irregular.when(F.length(lowered) <= 2, lowered).otherwise(found)

    return bind(F.lower(word), stem)
