"""Substring deduplication on words by level-wise doubling.

A window of ``length`` words is removed if the same words also start earlier: in a document with a
smaller id (then a smaller text hash), or earlier in the same document. Windows are judged on the
input. Three levels narrow the candidates, each twice as long as the one before:

1. A quarter of the length. The anchor of a window is the quarter-length run in it with the smallest
   hash, so that equal windows have equal anchors at equal places; about one word in nine starts an
   anchor. Anchors that occur once in the corpus are dropped. Of anchors whose surroundings (all
   windows that they are the anchor of) are equal too, all but the first are removed at once, and
   only the first goes on.
2. Half of the length. Where the first occurrences of an anchor differ in their surroundings, the
   anchor is extended to the left and to the right; it goes on if either extension occurs again.
3. The whole length. The windows of the anchors that are left are grouped; in each group all but the
   first are removed.

Each level is a partial aggregation by hash and a join, of rows that shrink from level to level; a
passage in very many documents is one row per task in the aggregation, and the join with it is dealt
anew by adaptive execution. Texts are met by positions through the document's id: the positions are
broadcast where their measured size allows, otherwise both sides are shuffled by document.

Hashes have 64 bits. Null and empty texts have no words, texts of fewer words than the length lose
none. Rows that agree in id and text are one document, listed once per row. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from termlight.llm.anchors import anchors_of, merge_runs, mix, shapes, slices
from termlight.llm.tables import discard, plain, sized_join, text_batches, text_version
from termlight.session import cut_lineage

LENGTH = 20
KEY = ["doc_id", "version"]


class Levels:
    """Hashes of the runs of one text's words, at a quarter, half and the whole of the length."""

    def __init__(self, words: list[bytes], length: int):
        single = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        quarter, rest = single, length // 4
        for i in range(1, rest):
            quarter = mix(quarter[:-1], single[i:])
        self.quarter = quarter
        self.half = mix(quarter[:-rest], quarter[rest:])
        self.whole = mix(self.half[: -2 * rest], self.half[2 * rest :])


def _words(text: str) -> list[bytes]:
    return text.encode().split()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def _typed(table: DataFrame, *fields: tuple) -> StructType:
    return StructType([StructField(n, t) for n, t in [*[(k, table.schema[k].dataType) for k in KEY], *fields]])


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, version, at, shape, h, c``: anchors with hashes of themselves and their surroundings."""
    part = length // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, columns = [], [[] for _ in range(4)]
            for i, text in enumerate(batch.column(2)):
                words = _words(text.as_py())
                if len(words) < length:
                    continue
                levels = Levels(words, length)
                at, first, last = anchors_of(levels.quarter, length - part + 1)
                shape = shapes(at, first, last)
                around = mix(mix(levels.whole[first], levels.whole[last]), shape.astype(np.uint64))
                rows.append(np.full(len(at), i))
                for column, values in zip(columns, (at, shape, levels.quarter[at], around), strict=True):
                    column.append(values)
            if rows:
                some = batch.select(KEY).take(pa.array(np.concatenate(rows)))
                at, shape, h, c = (np.concatenate(column) for column in columns)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(at, pa.int32()), pa.array(shape, pa.int32()), _signed(h), _signed(c)],
                    names=[*KEY, "at", "shape", "h", "c"],
                )

    fields = [("at", IntegerType()), ("shape", IntegerType()), ("h", LongType()), ("c", LongType())]
    return docs.select(*KEY, "text").mapInArrow(run, _typed(docs, *fields))


def _hashes(docs: DataFrame, places: DataFrame, length: int, half: bool) -> DataFrame:
    """``doc_id, version, place, start, hash`` at the ``place`` of each document, an anchor and its shape:
    of the half-length extensions to both sides, or of all windows of the anchor.
    """
    part = length // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, columns = [], [[] for _ in range(3)]
            for i, (text, own) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                levels = Levels(_words(text.as_py()), length)
                place = own.values.to_numpy()
                at, shape = place >> 32, place & 0xFFFFFFFF
                if half:
                    source, starts, place = levels.half, np.concatenate([at - part, at]), np.tile(place, 2)
                    inside = (starts >= 0) & (starts < len(source))
                    starts, place = starts[inside], place[inside]
                else:
                    count = (shape & 0xFFFF) + 1
                    source, place = levels.whole, np.repeat(place, count)
                    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    starts = np.repeat(at - (shape >> 16), count) + step
                rows.append(np.full(len(starts), i))
                for column, values in zip(columns, (place, starts, source[starts]), strict=True):
                    column.append(values)
            if rows:
                some = batch.select(KEY).take(pa.array(np.concatenate(rows)))
                place, starts, hashes = (np.concatenate(column) for column in columns)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(place, pa.int64()), pa.array(starts, pa.int32()), _signed(hashes)],
                    names=[*KEY, "place", "start", "hash"],
                )

    schema = _typed(docs, ("place", LongType()), ("start", IntegerType()), ("hash", LongType()))
    wanted = cut_lineage(places.groupBy(*KEY).agg(F.collect_set("place").alias("places")), "places")
    return sized_join(docs, wanted, KEY).select(*KEY, "text", "places").mapInArrow(run, schema)


@F.pandas_udf(ArrayType(LongType()))
def _merged(runs: pd.Series) -> pd.Series:
    return runs.map(merge_runs)


def _packed(start, end):
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(end.cast("long"))


def repeated_runs(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, version, runs``: the runs of words to remove, for the documents that have any.

    ``docs`` is ``doc_id, version, text``. A run is start * 2**32 + end; the end may pass the text's.
    """
    text_batches(docs)
    anchors = cut_lineage(_anchors(docs, length), "anchors")
    again = anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    level1 = cut_lineage(anchors.join(again, "h", "left_semi"), "level1")
    discard(anchors)
    place = F.struct(*KEY, "at", "shape")
    firsts = cut_lineage(level1.groupBy("h", "c").agg(F.min(place).alias("earliest"), F.count("*").alias("n")), "firsts")
    later = level1.join(firsts.where("n > 1").select("h", "c", "earliest"), ["h", "c"]).where(place != F.col("earliest"))
    first = F.col("at") - F.shiftright("shape", 16)
    copied = later.select(*KEY, _packed(first, first + F.col("shape").bitwiseAND(F.lit(0xFFFF)) + length).alias("run"))

    differ = firsts.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    places = firsts.join(differ, "h", "left_semi").select("earliest.*")
    places = places.select(*KEY, _packed(F.col("at"), F.col("shape")).alias("place"))
    level2 = cut_lineage(_hashes(docs, places, length, half=True), "level2")
    longer = level2.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    places = level2.join(longer, "hash", "left_semi").select(*KEY, "place")
    level3 = cut_lineage(_hashes(docs, places, length, half=False), "level3")
    start = F.struct(*KEY, "start")
    whole = level3.groupBy("hash").agg(F.min(start).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    windows = level3.join(whole.drop("n"), "hash").where(start != F.col("earliest"))
    found = windows.select(*KEY, _packed(F.col("start"), F.col("start") + length).alias("run"))
    return copied.unionByName(found).groupBy(*KEY).agg(_merged(F.collect_set("run")).alias("runs"))


def _cut(text: str, runs: list[int] | None) -> tuple[int, int, bytes]:
    """Words, words removed, and the kept words joined by single spaces."""
    words = _words(text)
    if not runs:
        return len(words), 0, b" ".join(words)
    kept, at = [], 0
    for run in runs:
        kept += words[at : run >> 32]
        at = run & 0xFFFFFFFF
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def _with_runs(docs: DataFrame, length: int) -> DataFrame:
    runs = cut_lineage(repeated_runs(docs, length), "runs")
    return sized_join(docs, runs, KEY, "left")


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return plain(docs, id_column, text_column).select("doc_id", text_version().alias("version"), "text")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (of the kept words joined by one space)."""
    marked = _with_runs(_keyed(docs, id_column, text_column), length)
    schema = StructType([marked.schema["doc_id"], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_cut(t.as_py(), r.as_py()) for t, r in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string())],
                names=schema.names,
            )

    return marked.select("doc_id", "text", "runs").mapInArrow(run, schema)


@F.pandas_udf(StringType())
def _kept_text(texts: pd.Series, runs: pd.Series) -> pd.Series:
    return pd.Series([_cut(t, r)[2].decode() for t, r in zip(texts, runs.map(lambda r: [int(x) for x in r]), strict=True)])


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; other columns and texts as they are.

    A text that loses words is its kept words joined by single spaces, empty if none is left; so no
    row is lost here.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    keyed = docs.select("*", F.col(f"`{id_column}`").alias("__id"), F.hash(text).alias("__version"))
    runs = cut_lineage(repeated_runs(_keyed(docs, id_column, text_column), length), "runs")
    marked = sized_join(keyed, runs.toDF("__id", "__version", "__runs"), ["__id", "__version"], "left")
    cut = F.when(F.col("__runs").isNull(), F.col(f"`{text_column}`")).otherwise(_kept_text(text, F.coalesce("__runs", F.array().cast("array<bigint>"))))
    return marked.select(*[cut.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns])
