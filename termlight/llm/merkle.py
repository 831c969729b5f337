"""A Merkle manifest of a table: a leaf for each row, a tree for each group, one root, a proof a row.

H is the lower-case hex SHA-256 of its joined inputs, digests as hex text. A row's leaf is H of its
columns, each ``-`` where null, else the number of its UTF-8 bytes, ``:`` and the value. The leaves of
a group ascend by their order column; while several nodes remain, every ``ARITY`` neighbours become
their H, the last run also when it has fewer. What remains is the group's subroot; the subroots in
the order of their groups (null first, then by bytes) give the root in the same way.

The leaves of a group are numbered by range partitions, and ``ARITY ** LEVELS`` neighbours are a
superblock, whose node is made in one task. The nodes of superblocks are the leaves of the next
round, so a group of any size takes few rounds and no task ever has more than one superblock. Going
back, every superblock is cogrouped with the one row of outer nodes that its proofs need beyond it:
the task reduces the superblock again, puts the outer nodes behind the inner ones, and folds every
row's claimed leaf up to the root.

Rows of equal order go by their leaf, a null order comes first, repeated rows are leaves of their
own, other columns may have any name, long texts are hashed where they are read, and an empty table
gives no rows. A value may be claimed to be another one; its proof then fails.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.operators.joins import lookup_join
from termlight.operators.ranking import number_rows
from termlight.session import cut_lineage

ARITY = 2
LEVELS = 12

NODES = "key string, at long, total long, node string"
PATHS = "key string, at long, root string, lefts array<string>, rights array<string>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], total: int, arity: int, levels: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up, as long as its group has several nodes."""
    found = [nodes]
    while total > 1 and len(found) <= levels:
        below = found[-1]
        found.append([_hash("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
        total = -(-total // arity)
    return found


def _siblings(levels: list[list[str]], arity: int) -> list[tuple[list[str], list[str]]]:
    """For each node of the lowest level, what stands left and right of it in its run, level by level."""
    sides = []
    for nodes in levels[:-1]:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        sides.append([("".join(run[:i]), "".join(run[i + 1 :])) for run in runs for i in range(len(run))])
    paths = []
    for at in range(len(levels[0])):
        steps = []
        for level in sides:
            steps.append(level[at])
            at //= arity
        paths.append(([s[0] for s in steps], [s[1] for s in steps]))
    return paths


def _rounds(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The nodes, and the nodes of their superblocks again and again until each group has one."""
    width = arity**levels

    def reduced(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        key, at, total = block["key"].iat[0], int(block["at"].iat[0]), int(block["total"].iat[0])
        node = _levels(block["node"].tolist(), total, arity, levels)[-1][0]
        return pd.DataFrame({"key": [key], "at": [at // width], "total": [-(-total // width)], "node": [node]})

    rounds, most = [nodes], nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        block = F.floor(F.col("at") / width).alias("block")
        blocks = rounds[-1].select("key", "at", "total", "node").groupBy("key", block)
        rounds.append(cut_lineage(blocks.applyInPandas(reduced, NODES), "nodes"))
        most = -(-most // width)
    return rounds


def _paths(nodes: DataFrame, outer: DataFrame, arity: int, levels: int) -> DataFrame:
    """The path from each node to the root: inside its superblock, then the superblock's own."""
    width = arity**levels

    def joined(block: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        inner = _siblings(_levels(block["node"].tolist(), int(block["total"].iat[0]), arity, levels), arity)
        lefts, rights = list(beyond["lefts"].iat[0]), list(beyond["rights"].iat[0])
        block = block[["key", "at"]].assign(root=beyond["root"].iat[0])
        return block.assign(lefts=[a + lefts for a, _ in inner], rights=[b + rights for _, b in inner])

    blocks = nodes.select("key", "at", "total", "node").groupBy("key", F.floor(F.col("at") / width).alias("block"))
    return blocks.cogroup(outer.groupBy("key", "at")).applyInPandas(joined, PATHS)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, its place in its ``key``, and ``total``, how many the key has."""
    placed = number_rows(rows, ["key"], [F.col(c).asc_nulls_first() for c in order], "at")
    placed = cut_lineage(placed.withColumn("at", F.col("at").cast("long") - 1), "placed")
    totals = placed.groupBy("key").agg((F.max("at") + 1).alias("total"))
    return lookup_join(placed, totals, ["key"])


def manifest(
    table: DataFrame,
    columns: list[str],
    group: str,
    order: str,
    claims: dict[str, Column] | None = None,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """One row a row: ``doc_id`` (the order column), ``leaf``, ``subroot``, ``root``, ``lefts``, ``rights``,
    ``folded_root``, ``verified``.

    ``lefts`` and ``rights`` are the digests beside the row's node in each run, from the leaf to the
    root. ``claims`` names values that take the place of a column's own when the row is verified:
    ``folded_root`` is the root that the claimed row and the proof give.
    """
    own = {c: F.col(f"`{c}`") for c in columns}
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("key")
    leaves = table.select(
        key, F.col(f"`{order}`").alias("doc_id"), leaf(list(own.values())).alias("node"),
        leaf(list((own | (claims or {})).values())).alias("claim"),
    )
    leaves = _numbered(cut_lineage(leaves, "leaves"), ["doc_id", "node", "claim"])
    rounds = _rounds(leaves, arity, levels)

    subroots = rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("tree"), "node")
    subroots = _numbered(subroots, ["tree"])
    upper = _rounds(subroots, arity, levels)
    empty = F.array().cast("array<string>")
    paths = upper[-1].select("key", "at", F.col("node").alias("root"), empty.alias("lefts"), empty.alias("rights"))
    for nodes in reversed(upper[:-1]):
        paths = _paths(nodes, paths, arity, levels)
    trees = subroots.select("at", "tree", F.col("node").alias("subroot"))
    outer = paths.join(trees, "at").select(F.col("tree").alias("key"), F.lit(0).cast("long").alias("at"), "root", "lefts", "rights", "subroot")
    outer = cut_lineage(outer, "outer")
    subroot_of, outer_paths = outer.select("key", "subroot"), outer.drop("subroot")
    for nodes in reversed(rounds[1:-1]):
        outer_paths = cut_lineage(_paths(nodes, outer_paths, arity, levels), "outer")
    return _proofs(leaves, lookup_join(outer_paths, subroot_of, ["key"]), arity, levels)


def _proofs(leaves: DataFrame, outer: DataFrame, arity: int, levels: int) -> DataFrame:
    """Each superblock of leaves with its outer nodes: reduce, join the proofs, fold the claims."""
    width = arity**levels
    id_field = f"doc_id {leaves.schema['doc_id'].dataType.simpleString()}"
    names = ["doc_id", "leaf", "subroot", "root", "lefts", "rights", "folded_root", "verified"]

    def proved(block: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        inner = _siblings(_levels(block["node"].tolist(), int(block["total"].iat[0]), arity, levels), arity)
        root, subroot = beyond["root"].iat[0], beyond["subroot"].iat[0]
        outer_lefts, outer_rights = list(beyond["lefts"].iat[0]), list(beyond["rights"].iat[0])
        lefts, rights = [a + outer_lefts for a, _ in inner], [b + outer_rights for _, b in inner]
        folded = []
        for node, before, after in zip(block["claim"], lefts, rights, strict=True):
            for a, b in zip(before, after, strict=True):
                node = _hash(a + node + b)
            folded.append(node)
        found = block[["doc_id"]].assign(leaf=block["node"], subroot=subroot, root=root, lefts=lefts, rights=rights)
        return found.assign(folded_root=folded, verified=[f == root for f in folded])[names]

    blocks = leaves.groupBy("key", F.floor(F.col("at") / width).alias("block"))
    schema = (
        f"{id_field}, leaf string, subroot string, root string, lefts array<string>, rights array<string>, "
        "folded_root string, verified boolean"
    )
    return blocks.cogroup(outer.groupBy("key", "at")).applyInPandas(proved, schema)


def proof_text(lefts: str = "lefts", rights: str = "rights") -> Column:
    """The siblings of a proof from the leaf to the root, joined."""
    return F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), "")
