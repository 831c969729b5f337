"""Near-duplicates by 64-bit SimHash, linked at four or fewer differing bits.

Deletion-variant signatures: a fingerprint is cut into three segments, so that of two fingerprints
at most four bits apart some segment differs by at most one bit. Each distinct fingerprint is
indexed under 64 keys, its segments with one bit masked; two segments one bit or none apart share
such a key. Rows that share a key are joined and verified on all 64 bits, each pair under its first
common key only.

A key shared by more than ``MAX_BUCKET`` fingerprints is not joined, which would make pairs by the
square. Its fingerprints go by centres instead: two fingerprints are at most four bits apart exactly
if some value is at most two bits from both, so each is linked to the smallest fingerprint around
every value within two bits of it. That is a fixed number of rows for each fingerprint and finds the
same links up to connection. The links become groups by ``components``.

Equal fingerprints are collapsed to one row before any of this, so copies cost nothing further.
A null or empty text has fingerprint zero and is linked like any other. Each row gets the
fingerprint of its own text, also where ids repeat; a null id is the smallest id. Rows that agree in
id and text are one document, listed once per row. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from termlight.llm.components import components
from termlight.llm.tables import plain, text_batches, text_version
from termlight.session import cut_lineage

SHINGLE = 4
DISTANCE = 4
MAX_BUCKET = 64
#: First bit and width of the segments.
SEGMENTS = [(0, 21), (21, 21), (42, 22)]


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Words split at ASCII white space, A-Z lowered; a bit is set if it is in over half the hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    above = bits.sum(axis=0, dtype=np.int32) * 2 > len(hashes)
    return int(np.packbits(above, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint_of).astype("int64")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _mask(segment: tuple[int, int]) -> int:
    first, width = segment
    return _signed(((1 << width) - 1) << first)


def _variants(prints: DataFrame) -> DataFrame:
    """``key, slot, fp``: every fingerprint under the 64 masked values of its segments."""
    slots = []
    for first, width in SEGMENTS:
        for bit in range(width):
            value = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            slots.append(value.cast("int").bitwiseOR(F.lit((first + bit) << 22)))
    return prints.select("fp", F.explode(F.array(*slots)).alias("key"))


def _pairs(variants: DataFrame) -> DataFrame:
    """Verified links between the fingerprints of small buckets, each found under one key."""
    a, b = variants.alias("a"), variants.alias("b")
    apart = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    slot = F.shiftrightunsigned(F.col("a.key"), 22)
    first_common, earlier_apart = F.lit(False), F.lit(True)
    for segment in SEGMENTS:
        here = apart.bitwiseAND(F.lit(_mask(segment)))
        in_segment = (slot >= segment[0]) & (slot < sum(segment))
        place = F.when(here == 0, F.lit(segment[0])).otherwise(slot)
        first_common = first_common | (in_segment & earlier_apart & (slot == place))
        earlier_apart = earlier_apart & (F.bit_count(here) > 1)
    condition = (
        (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(apart) <= DISTANCE) & first_common
    )
    return a.join(b.hint("merge"), condition).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _by_centres(prints: DataFrame) -> DataFrame:
    """Links through the values within two bits: around each value, all go to the smallest."""
    flips = [0, *[1 << i for i in range(64)], *[(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]]
    flips = F.explode(F.array(*[F.lit(_signed(f)) for f in flips]))
    around = prints.select("fp", flips.alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    least = around.groupBy("centre").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top")
    # Sizes before the expansion say nothing about the join: it must not be planned as a broadcast.
    return around.join(least.hint("merge"), "centre").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(prints: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``a, b``: links of the distinct fingerprints in ``fp``, enough to connect all that are close."""
    variants = _variants(prints)
    sized = variants.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    small = sized.where((F.col("n") > 1) & (F.col("n") <= max_bucket)).select("fp", "key")
    crowded = cut_lineage(sized.where(F.col("n") > max_bucket).select("fp").distinct(), "crowded")
    found = _pairs(small)
    return found if crowded.isEmpty() else found.unionByName(_by_centres(crowded))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bucket: int = MAX_BUCKET
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of the group;
    ``version``, which tells rows of one id apart, and ``stays``, true for the group's first document.
    """
    text_batches(docs)
    table = plain(docs, id_column, text_column)
    rows = table.select("doc_id", text_version().alias("version"), _fingerprint("text").alias("fp"))
    rows = cut_lineage(rows, "fingerprints")
    classes = cut_lineage(rows.groupBy("fp").agg(F.min(F.struct("doc_id", "version")).alias("least")), "classes")
    roots = components(links(classes.select("fp"), max_bucket))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    groups = rooted.join(smallest, "root").select("fp", "first")
    return rows.join(groups, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        "version",
        (F.struct("doc_id", "version") == F.col("first")).alias("stays"),
    )
