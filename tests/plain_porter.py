"""Porter's rules word by word, to hold the expressions against."""

from termlight.functions.porter import IRREGULAR, STEP_2, STEP_3, STEP_4


def _shape(word: str) -> str:
    """The word as a string of ``c`` and ``v``; y is a vowel after a consonant."""
    shape = ""
    for char in word:
        vowel = char in "aeiou" or (char == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_short(word: str) -> bool:
    """Consonant, vowel, consonant at the end (the last not w, x or y), or just vowel, consonant."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("c")


def _swap(word: str, table: list[tuple[str, str]]) -> str:
    for suffix, replacement in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            measured = stem + "l" if suffix == "logi" else stem
            return stem + replacement if _measure(measured) > 0 else word
    return word


def _plurals(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _doubled(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _ends_short(stem) else stem
    return word


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1]).endswith("c"):
        return word[:-1] + "i"
    return word


def _derived(word: str) -> str:
    while word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    return _swap(word, STEP_2)


def _residual(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t")))
            return stem if fits else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        measure = _measure(word[:-1])
        if measure > 1 or (measure == 1 and not _ends_short(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def porter_stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past_and_gerund(_plurals(word)))
    return _tidy(_residual(_swap(_derived(word), STEP_3)))

