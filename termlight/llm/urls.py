"""URL rules and a tree of path templates for the rest.

``judge`` splits each url into host and path and applies the longest rule that fits. The verdicts of
the rules are labels, and what no rule fits is judged by its path template. Templates are built for
each host from counts of path shapes (paths with digit runs masked), level by level:

- a segment with many children of few pages each is variable: its children become one wildcard;
- of the others, statistically similar branches are merged: children with the same share, to a
  quarter, of pages that end there, go on to a number, a numbered file or a word, and the same
  smoothed share of blocked labels.

A shape that is alone at its branch keeps the rest of its path; the levels go on as deep as several
shapes share a branch.

A template is rejected if its smoothed purity, the share of blocked among its labelled pages drawn
towards ``PRIOR`` by ``WEIGHT`` pages, reaches ``REJECT``.

All work is built-in expressions. Pages are aggregated to one row for each host and shape within a
task before the first shuffle, so a hot host is as many rows as it has shapes; the tree is built on
these rows, and pages meet its result by a join that is broadcast below a measured size. A null url,
or one without ``://``, has empty host and path; repeated rows are judged alike, once each. An empty
table gives an empty result.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.llm.tables import sized_join
from termlight.session import cut_lineage

#: A segment is variable with more children than this, of fewer pages each than that in the mean.
CHILDREN, PAGES = 16, 4
PRIOR, WEIGHT, REJECT = 0.25, 4.0, 0.8
#: Host, path and verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def located(pages: DataFrame, url_column: str) -> DataFrame:
    """The pages with ``host`` and ``path``."""
    url = F.col(f"`{url_column}`")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def _ruled(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """The pages with ``rule`` and ``label``, both null where no rule fits."""
    def fits(host: str, path: str) -> Column:
        return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)

    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def first(value) -> Column:
        return F.coalesce(*[F.when(fits(r[0], r[1]), F.lit(value(r))) for r in longest])

    return pages.withColumns({"rule": first(lambda r: r[0] + r[1]), "label": first(lambda r: r[2])})


def _smoothed(blocked: str = "blocked", labelled: str = "labelled") -> Column:
    return (F.col(blocked) + PRIOR * WEIGHT) / (F.col(labelled) + WEIGHT)


def _signature(total: str) -> Column:
    """What branches must share to be merged."""
    shares = [F.round(F.col(c) * 4.0 / F.col(total)) for c in ("ends", "numbers", "files")]
    return F.concat_ws(",", *[s.cast("int").cast("string") for s in [*shares, F.round(_smoothed() * 4)]])


def _level(shapes: DataFrame, depth: int) -> DataFrame:
    """Extend ``template`` by the segment at ``depth``, generalised within its host and template."""
    def at(i: int) -> Column:
        return F.get("segments", F.lit(i))

    after = at(depth + 1)
    here = shapes.withColumns({"segment": at(depth), "ending": at(depth).isNull()})

    def pages(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    children = here.where(~F.col("ending")).groupBy("host", "template", "segment").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"),
        pages(after.isNull()).alias("ends"), pages(after == "#").alias("numbers"), pages(after.rlike(r"^#\.")).alias("files"),
    )
    parents = children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("pages"))
    variable = (F.col("children") > CHILDREN) & (F.col("pages") < F.col("children") * PAGES)
    kinds = children.join(parents, ["host", "template"]).withColumn("branch", F.when(variable, F.lit("*")).otherwise(_signature("n")))
    merged = kinds.groupBy("host", "template", "branch").agg(F.count("*").alias("members"), F.min("segment").alias("first"))
    name = F.when(F.col("branch") == "*", F.lit("*")).when(F.col("members") == 1, F.col("first")).otherwise(
        F.concat(F.lit("{"), F.col("first"), F.lit("+"), (F.col("members") - 1).cast("string"), F.lit("}")))
    named = kinds.join(merged, ["host", "template", "branch"]).select("host", "template", "segment", name.alias("name"))
    extended = F.when(F.col("name").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "name"))
    return here.join(named, ["host", "template", "segment"], "left").withColumn("template", extended).drop("name", "segment", "ending")


def templates(pages: DataFrame) -> DataFrame:
    """``host, shape, template, purity`` for every shape of ``pages(host, shape, label)``."""
    blocked = F.sum(F.when(F.col("label") == "block", F.lit(1)).otherwise(F.lit(0)))
    shapes = pages.groupBy("host", "shape").agg(F.count("*").alias("n"), blocked.alias("blocked"), F.count("label").alias("labelled"))
    parts = F.split(F.regexp_replace("shape", "^/", ""), "/")
    shapes = cut_lineage(shapes.withColumns({"segments": parts, "template": F.lit("")}), "shapes")
    found, depth = [], 0
    while True:
        longer = F.size("segments") > depth
        found.append(shapes.where(~longer))
        going = shapes.where(longer)
        shared = going.groupBy("host", "template").agg(F.count("*").alias("here"))
        going = going.join(shared, ["host", "template"])
        # A shape without others at its branch has nothing to be merged with further down.
        alone = F.concat_ws("/", "template", F.array_join(F.slice("segments", F.lit(depth + 1), F.size("segments")), "/"))
        found.append(going.where("here = 1").withColumn("template", alone).drop("here"))
        shapes = cut_lineage(_level(going.where("here > 1").drop("here"), depth), "templates")
        depth += 1
        if shapes.isEmpty():
            break
    shapes = cut_lineage(reduce(DataFrame.unionByName, found), "templates")
    totals = shapes.groupBy("host", "template").agg(F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled"))
    purity = _smoothed("all_blocked", "all_labelled").alias("purity")
    return shapes.join(totals, ["host", "template"]).select("host", "shape", "template", purity)


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every page."""
    own = pages.select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").alias("url"))
    ruled = _ruled(located(own, "url"), RULES if rules is None else rules)
    shaped = ruled.withColumn("shape", F.regexp_replace("path", "[0-9]+", "#"))
    known = cut_lineage(templates(shaped.select("host", "shape", "label")), "purities")
    method = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    joined = sized_join(shaped, known, ["host", "shape"], "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), "template", F.round("purity", 6).alias("purity"))
