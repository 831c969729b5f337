"""Near-duplicates by the Jaccard similarity of word shingles, found exactly.

At similarity 0.8 two SimHashes are some ten bits apart, more than segments can index, so candidates
come from prefixes instead. The distinct shingle hashes of every text are put in one order; texts of
similarity t share a hash among the first n - ceil(t n) + 1 of their n. Rows that share one are
paired, pairs whose places cannot reach t are dropped, and the rest is verified on the whole sets.

Any order finds all pairs; the order decides only how many candidates there are. Hashes that are
frequent in all texts, by counts of their first bits, go last, so that a common passage makes no
crowded key. Of two similar sets the first hash they share must leave enough behind it in both; a
pair that meets at a later place than that is not made. The sets of a key are first linked to its
smallest set, and pairs are made only between groups that are still apart after that: a large group
of near copies makes no square of pairs. Before whole sets meet, pairs are held against the numbers
of hashes that begin with each byte: the sum of the lesser numbers is at least what two sets share,
which drops nearly all pairs that are not similar.

With ``fingerprints`` texts are linked by SimHash before all this, as ``simhash`` does it, and the
similarity adds what is further apart than its four bits.

Words are split at ASCII white space, A-Z lowered; a text of fewer words than a shingle is one
shingle, and so is an empty or null one. Equal sets are collapsed to one row before any of this;
shingles and sets are known by 64-bit hashes. Rows that agree in id and text are one document, a null
id is the smallest id, and an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from termlight.llm import simhash
from termlight.llm.components import components
from termlight.llm.simhash import fingerprint_of
from termlight.llm.tables import plain, sized_join, text_batches, text_version
from termlight.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
MAX_BUCKET = 64
#: Hashes are counted by their first bits, in blocks of so many numbers; numbers below ``FREQUENT`` are as
#: good as one. They change the number of candidates, not the result.
ORDER_BITS, BLOCK, FREQUENT = 22, 1 << 16, 8
FULL = 255
_SLACK = 1e-9


def hashes_of(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending."""
    words = text.encode().lower().split()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, 42)], "<u8").view("<i8")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    return np.unique(np.array(hashes, "<u8").view("<i8"))


def _hashes(shingle: int):
    @F.pandas_udf(ArrayType(LongType()))
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: hashes_of(t, shingle))

    return found


def _counts(shingle: int):
    """Counts of the texts' hashes by their first bits, as compressed blocks that can be added up."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << ORDER_BITS, np.uint8)
        for batch in batches:
            for text in batch["text"]:
                place, n = np.unique(hashes_of(text, shingle).view("<u8") >> np.uint64(64 - ORDER_BITS), return_counts=True)
                counts[place] = np.minimum(counts[place] + n, FULL)
        blocks = counts.reshape(-1, BLOCK)
        yield pd.DataFrame({"block": range(len(blocks)), "counts": [zlib.compress(b.tobytes(), 1) for b in blocks]})

    return found


def _levels_of(parts: pd.DataFrame) -> pd.DataFrame:
    """A block's counts over all tasks, as eighths of their logarithm."""
    total = np.zeros(BLOCK, np.int64)
    for part in parts["counts"]:
        total += np.frombuffer(zlib.decompress(part), np.uint8)
    levels = np.where(total < FREQUENT, 0, np.minimum(8 * np.log2(np.maximum(total, 1)), FULL)).astype(np.uint8)
    return pd.DataFrame({"block": parts["block"][:1], "levels": [levels.tobytes()]})


def _levels(table: DataFrame, shingle: int) -> np.ndarray:
    """How frequent the hashes with the same first bits are, by all texts; its size does not depend on the table."""
    counts = table.select("text").mapInPandas(_counts(shingle), "block int, counts binary")
    found = counts.groupBy("block").applyInPandas(_levels_of, "block int, levels binary").collect()
    levels = np.zeros(1 << ORDER_BITS, np.uint8)
    for r in found:
        levels[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.levels, np.uint8)
    return levels


def _sketch(shingle: int, similarity: float, shared):
    """``set`` (a hash of the whole set), ``n``, ``prefix``, ``bins`` and ``fp`` (the SimHash) of a text.

    ``bins`` has the number of hashes that begin with each byte, 255 standing for that or more.
    """

    @F.pandas_udf("set long, n int, prefix array<long>, bins binary, fp long")
    def found(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            hashes = hashes_of(text, shingle)
            n = len(hashes)
            whole = xxhash.xxh64_intdigest(hashes.tobytes(), 7)
            rank = shared.value[hashes.view("<u8") >> np.uint64(64 - ORDER_BITS)]
            first = n - ceil(similarity * n - _SLACK) + 1
            bins = np.minimum(np.bincount(hashes.view("<u8") >> np.uint64(56), minlength=256), FULL).astype(np.uint8)
            out.append((whole - (whole >> 63 << 64), n, hashes[np.argsort(rank, kind="stable")[:first]], bins.tobytes(),
                        fingerprint_of(text)))
        return pd.DataFrame(out, columns=["set", "n", "prefix", "bins", "fp"])

    return found


def _enough(common: Column, similarity: float) -> Column:
    return common * (1 + similarity) >= similarity * (F.col("n_a") + F.col("n_b")) - _SLACK


def _candidates(a: DataFrame, b: DataFrame, condition: Column, similarity: float) -> DataFrame:
    """Pairs of rows that share a key and, by size and by the places of the shared keys, can be similar.

    Shared keys have the same order in both. So the first must leave enough behind it, and where one
    does not, no later one does.
    """
    left = a.select(*[F.col(c).alias(f"{c}_a") for c in a.columns])
    right = b.select(*[F.col(c).alias(f"{c}_b") for c in b.columns])
    sizes = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - _SLACK)
    ahead = _enough(F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")), similarity)
    pairs = left.join(right.hint("merge"), (F.col("h_a") == F.col("h_b")) & condition & sizes & ahead)
    shared = pairs.groupBy("set_a", "set_b", "n_a", "n_b").agg(
        F.count("*").alias("c"), F.max("at_a").alias("last_a"), F.max("at_b").alias("last_b"))
    rest = F.least(F.col("n_a") - F.col("last_a"), F.col("n_b") - F.col("last_b")) - 1
    return shared.where(_enough(F.col("c") + rest, similarity)).select("set_a", "set_b", "n_a", "n_b")


@F.pandas_udf(LongType())
def _most_shared(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    """At least as many as two sets share, by their numbers of hashes for each first byte."""
    if not len(a):
        return pd.Series([], dtype="int64")
    left, right = (np.frombuffer(b"".join(bins), np.uint8).reshape(-1, 256) for bins in (a, b))
    both = np.minimum(left, right)
    bound = both.sum(axis=1, dtype=np.int64)
    return pd.Series(np.where((both == FULL).any(axis=1), np.minimum(n_a, n_b), bound))


class Texts(NamedTuple):
    """``table(doc_id, text, version)``, and ``firsts(set, doc_id, version, bins)`` with a document of each set."""

    table: DataFrame
    firsts: DataFrame


def _possible(pairs: DataFrame, texts: Texts, similarity: float) -> DataFrame:
    """The pairs that can be similar by their numbers of hashes for each first byte."""
    bins = texts.firsts.select("set", "bins")
    for side in "ab":
        pairs = pairs.join(bins.withColumnsRenamed({"set": f"set_{side}", "bins": f"bins_{side}"}), f"set_{side}")
    most = _most_shared("bins_a", "bins_b", "n_a", "n_b")
    return pairs.where(_enough(most, similarity)).select("set_a", "set_b", "n_a", "n_b")


def _verified(pairs: DataFrame, texts: Texts, shingle: int, similarity: float) -> DataFrame:
    """``a, b`` of the pairs that are similar.

    The texts are hashed where they are read; as long as the wanted documents are few enough to be
    broadcast, no text is shuffled, and what moves are the hashes of sets in pairs.
    """
    pairs = cut_lineage(_possible(pairs, texts, similarity), "pairs")
    wanted = pairs.select(F.col("set_a").alias("set")).unionByName(pairs.select(F.col("set_b").alias("set"))).distinct()
    keys = cut_lineage(texts.firsts.drop("bins").join(wanted, "set"), "wanted")
    found = sized_join(texts.table, keys, ["doc_id", "version"]).select("set", _hashes(shingle)("text").alias("own"))
    # A document in two equal rows gives its set twice. Both joins read the one shuffle by set.
    sets = found.groupBy("set").agg(F.first("own").alias("own"))
    both = pairs.join(sets.select(F.col("set").alias("set_a"), F.col("own").alias("own_a")), "set_a")
    both = both.join(sets.select(F.col("set").alias("set_b"), F.col("own").alias("own_b")), "set_b")
    common = F.size(F.array_intersect("own_a", "own_b"))
    return cut_lineage(both.where(_enough(common, similarity)).select(F.col("set_a").alias("a"), F.col("set_b").alias("b")), "links")


def _simhash_links(rows: DataFrame, max_bucket: int) -> DataFrame:
    """``a, b``: every set linked to the smallest set of its SimHash group, for ``rows(set, fp)``."""
    rows = cut_lineage(rows.distinct(), "fingerprints")
    roots = components(simhash.links(rows.select("fp").distinct(), max_bucket)).withColumnRenamed("node", "fp")
    rooted = rows.join(roots, "fp", "left").select("set", F.coalesce("root", "fp").alias("root")).distinct()
    least = rooted.groupBy("root").agg(F.min("set").alias("b"), F.max("set").alias("top")).where("b < top")
    linked = rooted.join(least, "root").where("set <> b").select(F.col("set").alias("a"), "b").distinct()
    return cut_lineage(linked, "simhash-links")


def linked(
    sketches: DataFrame, texts: Texts, shingle: int, similarity: float, max_bucket: int, known: DataFrame | None = None
) -> DataFrame:
    """``node, root``: the groups of the distinct sets in ``sketches(set, n, prefix)`` by similar pairs, as many as
    connect all, and by the links ``known`` already.

    Keys of up to ``max_bucket`` sets, and then the larger ones, are searched for pairs of sets that
    the smallest sets of their keys have not brought together. New pairs are added to the groups found before.
    """
    keys = sketches.select("set", "n", F.posexplode("prefix").alias("at", "h"))
    here = Window.partitionBy("h")
    sized = keys.withColumn("size", F.count("*").over(here)).where("size > 1")
    sized = cut_lineage(sized.withColumn("least", F.min("set").over(here)), "keys")
    columns = ["set", "n", "at", "h"]
    heads = sized.where("set = least").select(columns)
    starred = _candidates(heads, sized.where("set <> least").select(columns), F.lit(True), similarity)
    found = _verified(starred, texts, shingle, similarity)
    roots = components(found if known is None else found.unionByName(known))
    apart = (F.col("set_a") < F.col("set_b")) & (F.col("root_a") != F.col("root_b"))
    for crowded in (F.col("size") <= max_bucket, F.col("size") > max_bucket):
        own = sized.where(crowded).select(columns)
        own = own.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        groups = own.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
        mixed = cut_lineage(own.join(groups, "h").select(*columns, "root"), "mixed")
        if mixed.isEmpty():
            continue
        more = _verified(_candidates(mixed, mixed, apart, similarity), texts, shingle, similarity)
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    return roots


def near_copies(
    docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY,
    id_column: str = "doc_id", text_column: str = "text", max_bucket: int = MAX_BUCKET,
    fingerprints: bool = False,
) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest id of the group of linked documents; ``version``,
    which tells rows of one id apart, and ``stays``, true for the group's first document.
    """
    text_batches(docs)
    table = plain(docs, id_column, text_column)
    sketch = _sketch(shingle, similarity, table.sparkSession.sparkContext.broadcast(_levels(table, shingle)))
    rows = table.select("doc_id", text_version().alias("version"), sketch("text").alias("s")).select("doc_id", "version", "s.*")
    rows = cut_lineage(rows, "sketches")
    least = F.min(F.struct("doc_id", "version"))
    classes = rows.groupBy("set").agg(least.alias("least"), *[F.first(c).alias(c) for c in ("n", "prefix", "bins")])
    classes = cut_lineage(classes, "classes")
    firsts = classes.select("set", F.col("least.doc_id").alias("doc_id"), F.col("least.version").alias("version"), "bins")
    texts = Texts(table.withColumn("version", text_version()), firsts)
    known = _simhash_links(rows.select("set", "fp"), simhash.MAX_BUCKET) if fingerprints else None
    roots = linked(classes.select("set", "n", "prefix"), texts, shingle, similarity, max_bucket, known)
    rooted = classes.select("set", "least").join(roots.withColumnRenamed("node", "set"), "set", "left")
    rooted = rooted.select("set", "least", F.coalesce("root", "set").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    groups = rooted.join(smallest, "root").select("set", "first")
    return rows.select("doc_id", "version", "set").join(groups, "set").select(
        "doc_id", F.col("first.doc_id").alias("component_id"), "version",
        (F.struct("doc_id", "version") == F.col("first")).alias("stays"),
    )
