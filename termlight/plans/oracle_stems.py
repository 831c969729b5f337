"""Porter's rules in SQL, as one common table expression a step. Shapes are folded letter by letter."""

from __future__ import annotations

from termlight.functions.porter import IRREGULAR, STEP_2, STEP_3, STEP_4


def shape(word: str) -> str:
    return (
        f"list_reduce(list_prepend('', string_split({word}, '')), lambda s, c: s || CASE WHEN c = '' THEN '' "
        "WHEN c IN ('a', 'e', 'i', 'o', 'u') OR (c = 'y' AND ends_with(s, 'c')) THEN 'v' ELSE 'c' END)"
    )


def once(form: str) -> str:
    return f"contains({form}, 'vc')"


def twice(form: str) -> str:
    return f"regexp_matches({form}, 'vc.*vc')"


def short(stem: str, form: str) -> str:
    return f"((ends_with({form}, 'cvc') AND right({stem}, 1) NOT IN ('w', 'x', 'y')) OR {form} = 'vc')"


def cut(letters: int) -> str:
    return f"left(w, greatest(length(w) - {letters}, 0))"


def suffixes(name: str, before: str, table: list[tuple[str, str]], fits: str) -> str:
    """The first suffix of the table that fits decides, if what is in front of it does."""
    entries = ", ".join(f"{{'s': '{s}', 't': '{t}'}}" for s, t in table)
    return f"""{name}_f AS (SELECT form, w, list_filter([{entries}], lambda x: ends_with(w, x.s))[1] AS f FROM {before}),
{name}_g AS (SELECT *, left(w, length(w) - length(f.s)) AS stem FROM {name}_f),
{name} AS (SELECT form, CASE WHEN f IS NULL THEN w WHEN {fits} THEN stem || f.t ELSE w END AS w FROM {name}_g)"""


def stems(words: str) -> list[str]:
    """``stems(form, term)`` for the distinct ``term`` of a table, as common table expressions."""
    measured = shape("CASE WHEN f.s = 'logi' THEN stem || 'l' ELSE stem END")
    irregular = " ".join(f"WHEN '{form}' THEN '{to}'" for form, to in IRREGULAR.items())
    return [
        f"st0 AS (SELECT DISTINCT term AS form, lower(term) AS w FROM {words} WHERE term IS NOT NULL)",
        f"""st1 AS (SELECT form, CASE WHEN ends_with(w, 'ies') THEN (CASE length(w) WHEN 4 THEN {cut(1)} ELSE {cut(2)} END)
  WHEN ends_with(w, 'sses') THEN {cut(2)} WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {cut(1)} ELSE w END AS w
  FROM st0)""",
        f"""st2_f AS (SELECT *, CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
  WHEN ends_with(w, 'ed') THEN {cut(2)} WHEN ends_with(w, 'ing') THEN {cut(3)} END AS stem FROM st1)""",
        f"st2_g AS (SELECT *, {shape('stem')} AS sh, {shape(cut(3))} AS eed FROM st2_f)",
        f"""st2 AS (SELECT form, CASE WHEN ends_with(w, 'ied') THEN (CASE length(w) WHEN 4 THEN {cut(1)} ELSE {cut(2)} END)
  WHEN ends_with(w, 'eed') THEN (CASE WHEN {once('eed')} THEN {cut(1)} ELSE w END)
  WHEN stem IS NULL OR NOT contains(sh, 'v') THEN w WHEN regexp_matches(stem, '(at|bl|iz)$') THEN stem || 'e'
  WHEN length(stem) > 1 AND right(stem, 1) = left(right(stem, 2), 1) AND ends_with(sh, 'c')
    THEN (CASE WHEN right(stem, 1) IN ('l', 's', 'z') THEN stem ELSE left(stem, length(stem) - 1) END)
  WHEN {once('sh')} AND NOT {twice('sh')} AND {short('stem', 'sh')} THEN stem || 'e' ELSE stem END AS w FROM st2_g)""",
        f"""st3 AS (SELECT form, CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND ends_with({shape(cut(1))}, 'c')
  THEN {cut(1)} || 'i' ELSE w END AS w FROM st2)""",
        f"""st4 AS (SELECT form, CASE WHEN ends_with(w, 'alli') AND {once(shape(cut(4)))} THEN {cut(2)} ELSE w END AS w FROM st3)""",
        suffixes("st5", "st4", STEP_2, once(measured)),
        suffixes("st6", "st5", STEP_3, once(shape("stem"))),
        suffixes(
            "st7", "st6", [(s, "") for s in STEP_4],
            f"({twice(shape('stem'))} AND (f.s <> 'ion' OR right(stem, 1) IN ('s', 't')))",
        ),
        f"st8_f AS (SELECT *, {cut(1)} AS stem, {shape(cut(1))} AS sh FROM st7)",
        f"""st8 AS (SELECT form, CASE WHEN ends_with(w, 'e') AND ({twice('sh')} OR ({once('sh')} AND NOT {short('stem', 'sh')}))
  THEN stem ELSE w END AS w FROM st8_f)""",
        f"""stems AS (SELECT form, CASE lower(form) {irregular} ELSE CASE WHEN length(form) <= 2 THEN lower(form)
  WHEN ends_with(w, 'll') AND {twice(shape(cut(1)))} THEN {cut(1)} ELSE w END END AS term FROM st8)""",
    ]
