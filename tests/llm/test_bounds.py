"""URL templates of any depth against a plain tree, and the rejection of language identification."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from termlight.llm import exact_stream, language, urls
from termlight.llm.tables import plain


def plain_templates(pages):
    """``(host, shape) -> (template, purity)`` by recursion over lists; pages are (host, shape, label)."""
    shapes = defaultdict(lambda: [0, 0, 0])
    for host, shape, label in pages:
        counts = shapes[host, shape]
        counts[0] += 1
        counts[1] += label == "block"
        counts[2] += label is not None
    smooth = lambda blocked, labelled: (blocked + urls.PRIOR * urls.WEIGHT) / (labelled + urls.WEIGHT)
    quarter = lambda x: int(x * 4 + 0.5)
    named = {}

    def build(host, members, template, depth):
        children = defaultdict(list)
        for shape, segments in members:
            if len(segments) > depth:
                children[segments[depth]].append((shape, segments))
            else:
                named[host, shape] = template
        if not children:
            return
        facts = {}
        for segment, own in children.items():
            total, blocked, labelled = (sum(shapes[host, s][i] for s, _ in own) for i in range(3))
            after = [(seg[depth + 1] if len(seg) > depth + 1 else None, shapes[host, s][0]) for s, seg in own]
            shares = [
                sum(n for a, n in after if a is None), sum(n for a, n in after if a == "#"),
                sum(n for a, n in after if a is not None and re.match(r"#\.", a)),
            ]
            facts[segment] = total, (*(quarter(x / total) for x in shares), quarter(smooth(blocked, labelled)))
        pages_here = sum(total for total, _ in facts.values())
        variable = len(children) > urls.CHILDREN and pages_here < len(children) * urls.PAGES
        branches = defaultdict(list)
        for segment, (_, signature) in facts.items():
            branches["*" if variable else signature].append(segment)
        for branch, segments in branches.items():
            name = "*" if branch == "*" else min(segments)
            if branch != "*" and len(segments) > 1:
                name = f"{{{name}+{len(segments) - 1}}}"
            build(host, [m for s in segments for m in children[s]], f"{template}/{name}", depth + 1)

    for host in {h for h, _ in shapes}:
        build(host, [(s, re.sub("^/", "", s).split("/")) for h, s in shapes if h == host], "", 0)
    totals = defaultdict(lambda: [0, 0])
    for key, template in named.items():
        totals[key[0], template][0] += shapes[key][1]
        totals[key[0], template][1] += shapes[key][2]
    return {k: (t, round(smooth(*totals[k[0], t]), 9)) for k, t in named.items()}


def some_pages(seed):
    r = random.Random(seed)
    pages = []
    for _ in range(900):
        host = r.choice(["a.test", "b.test", ""])
        depth = r.choice([0, 1, 2, 3, 6, 9])
        parts = [r.choice(["x", "y", "z", "#", "#.html", f"v{r.randrange(40)}", "é", ""]) for _ in range(depth)]
        pages.append((host, "/" + "/".join(parts), r.choice(["block", "allow", None, None])))
    return pages + [("a.test", "", None), ("a.test", "/" + "deep/" * 60 + "one", None), ("a.test", "/only/" + "deep/" * 300, "block")]


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_of_any_depth(spark, seed):
    pages = some_pages(seed)
    found = urls.templates(spark.createDataFrame(pages, "host string, shape string, label string")).collect()
    assert {(r.host, r.shape): (r.template, round(r.purity, 9)) for r in found} == plain_templates(pages)


def test_a_blocked_section_deep_down_leaves_its_neighbour(spark):
    rules = [("h.test", "/a/b/c/d/ads/", "block")]
    rows = [(i, f"http://h.test/a/b/c/d/{'ads' if i % 2 else 'news'}/{i}") for i in range(200)]
    judged = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert {r.page_id for r in judged if r.verdict == "block"} == {i for i, u in rows if "/ads/" in u}


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return language.fit(docs.where(~language.held_out()))


def test_noise_and_an_unlearned_language_are_rejected(model):
    r = random.Random(5)
    word = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    kinds = {"bcdfghjklmnpqrstvwxz": 6, "0123456789abcdef": 16, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789": 24}
    noise = [" ".join(word(letters, n) for _ in range(k)) for letters, n in kinds.items() for k in (5, 20, 200) for _ in range(20)]
    noise += [
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
        "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
    ]
    assert {language.classify(model, t)[0] for t in noise} == {"und"}


def test_documents_stay(spark, model):
    """Of documents not learned from nearly none is rejected or taken for another language."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    letters = docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language.predict(letters, model).join(letters.select("doc_id", "lang"), "doc_id")
    assert judged.where("lang_pred = lang").count() >= 0.995 * judged.count()


def test_every_label_is_learned(spark):
    """Also with more labels than any fixed number, each of few rows, and one very frequent one."""
    r = random.Random(9)
    rows = []
    for k in range(130):
        syllables = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(6)]
        rows += [(len(rows) + i, " ".join(r.choices(syllables, k=40)), f"l{k:03}") for i in range(2 if k else 400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n", F.lit("own"))
    model = language.fit(table)
    assert model.languages == sorted({lang for _, _, lang in rows})
    judged = language.predict(table, model).join(table.select("doc_id", "lang"), "doc_id")
    assert judged.where("lang = lang_pred").count() >= 0.99 * len(rows)
    none = table.where("false")
    assert language.predict(none, language.fit(none)).count() == 0


def test_few_python_workers(spark, monkeypatch):
    """Exact deduplication runs no Python in tasks, and neither it nor the fit sends rows from Python to workers."""
    rows = [(1, "a\u00a0b\t c\x0b\x0c\r\n", "x"), (2, "a\u00a0bc", "x"), (3, None, "y"), (4, " ", "y"), (5, "b ac", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = plain(table, "doc_id", "text")
    for step in (exact_stream._arrivals(texts, 32), exact_stream._arrivals_with_bytes(texts, 8)):
        assert "Python" not in step._jdf.queryExecution().executedPlan().toString()

    def refuse(*_):
        raise AssertionError("rows sent from Python")

    monkeypatch.setattr(spark.sparkContext, "parallelize", refuse)
    assert language.fit(table).languages == ["x"]
    groups = exact_stream.dedup(table).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(tuple(r) for r in groups) == [(1, 1, 2), (2, 1, 2), (3, 4, 2), (4, 4, 2), (5, 5, 1)]
