"""The manifest against a plain tree, over several superblocks and rounds."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from termlight.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, arity):
    """The top and, for each node, its siblings level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places, strict=True):
            first = at - at % arity
            path.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + arity])))
        places = [at // arity for at in places]
        nodes = [h("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0] if nodes else None, paths


def plainly(rows, arity):
    trees, found = {}, []
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    ordered = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    tops = []
    for lang in ordered:
        own = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        top, paths = climb([leaf_of(r) for r in own], arity)
        tops.append(top)
        found.append((own, paths))
    root, upper = climb(tops, arity)
    out = []
    for (own, paths), top, beyond in zip(found, tops, upper, strict=True):
        for row, path in zip(own, paths, strict=True):
            path = path + beyond
            claim = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                claim[3] += 1
            node = leaf_of(claim)
            for before, after in path:
                node = h(before + node + after)
            out.append((row[0], leaf_of(row), top, root, h("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def run(spark, table, arity=2, levels=12):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claims = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = merkle.manifest(table, COLUMNS, "lang", "doc_id", claims, arity, levels)
    found = found.withColumn("proof_sha256", F.sha2(merkle.proof_text(), 256))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=str)


def some_rows():
    rows = [(i * 3 % 101, f"s{i % 4}", ["en", None, "", "de", "é", "-"][i * i % 11 % 6], i, "text é" * (i % 5)) for i in range(101)]
    rows += [(500 + i, None, None, None, None) for i in range(9)]
    rows += [(None, "s", "en", 1, "null id"), (7, "a tie", "en", 2, "x"), (7, "a tie", "en", 2, "x"), (7, "s", "en", None, "y")]
    rows += [(900, "alone", "xx", 3, "long " * 200_000)]
    return rows


@pytest.mark.parametrize("arity, levels", [(2, 12), (2, 2), (3, 1), (5, 3)])
def test_manifest(spark, arity, levels):
    """Also with superblocks of a few leaves, so that groups and the forest take several rounds."""
    rows = some_rows()
    clash = {c: F.lit("own") for c in ("key", "at", "node", "claim", "total", "block", "root")}
    table = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(clash)
    assert run(spark, table, arity, levels) == plainly(rows, arity)


@pytest.mark.parametrize("rows", [[], [(1, None, None, 5, "one")], [(i, "s", "en", i, "t") for i in range(8)]])
def test_small_tables(spark, rows):
    assert run(spark, spark.createDataFrame(rows, SCHEMA), 2, 2) == plainly(rows, 2)


def test_what_is_claimed_fails_alone(spark):
    rows = some_rows()
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), COLUMNS, "lang", "doc_id").collect()
    assert all(r.verified for r in found) and len({r.root for r in found}) == 1
    claims = {"source": F.when(F.col("doc_id") == 900, "changed").otherwise(F.col("source"))}
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), COLUMNS, "lang", "doc_id", claims).collect()
    assert [r.doc_id for r in found if not r.verified] == [900]
