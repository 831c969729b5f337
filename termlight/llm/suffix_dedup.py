"""Deduplication of repeated byte strings by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed, all
copies alike; strings are judged on the input and never cross documents.

1. The anchor of a string of the length is the 32-byte gram in it with the smallest hash, so equal
   strings have equal anchors at equal places; about one byte in 85 starts one. Anchors that occur
   once in the corpus are dropped, so most text is left here. Anchors whose whole surroundings (all
   strings that they are the anchor of) occur again are removed with them, and one occurrence of
   each goes on where an anchor has different surroundings.
2. These surroundings go to shards by anchor, so that equal strings meet in one shard. A shard sorts
   its suffixes by Larsson-Sadakane refinement and finds common prefixes by Kasai's method, both in
   numpy; neighbours that share the length stand at two places.
3. An anchor with very many different surroundings is split over several shards. The distinct strings
   of each of those shards, as a sorted run of hashes cut by range, meet those of the others and are
   merged run by run with binary search; a string found in an earlier run is removed in both.

A shard is bounded by its number of surroundings, whatever the data. Hashes have 64 bits. Texts meet
positions by document: the positions are broadcast where their measured size allows, otherwise both
sides are shuffled. Null and empty texts have no bytes; texts shorter than the length lose none.
Rows that agree in id and text are one document, listed once per row. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from termlight.llm.anchors import anchors_of, merge_runs, mix, shapes, slices
from termlight.llm.suffixes import Shard, repeated_starts
from termlight.llm.tables import discard, plain, sized_join, text_version
from termlight.session import cut_lineage

LENGTH = 200
GRAM = 32
#: Surroundings in a shard, in the mean, and of one anchor before it is split.
SHARD = 3000
KEY = ["doc_id", "version"]


def _typed(table: DataFrame, *fields: tuple) -> StructType:
    return StructType([StructField(n, t) for n, t in [*[(k, table.schema[k].dataType) for k in KEY], *fields]])


def _gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """An order of the grams that depends on their first and last eight bytes."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    count = len(data) - gram + 1
    return mix(words[:count], words[gram - 8 : gram - 8 + count])


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, version, at, shape, h, c``: anchors with hashes of themselves and their surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches):
            rows, at, shape, h, c = [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                data = text.as_py().encode()
                if len(data) < length:
                    continue
                found, first, last = anchors_of(_gram_hashes(data, gram), length - gram + 1)
                form = shapes(found, first, last).tolist()
                found, spans = found.tolist(), zip(first.tolist(), (last + length).tolist(), form, strict=True)
                rows.append(np.full(len(found), i))
                at += found
                shape += form
                h += [digest(data[p : p + gram]) for p in found]
                c += [digest(data[a:b], s) for a, b, s in spans]
            if rows:
                some = batch.select(KEY).take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(at, pa.int32()), pa.array(shape, pa.int32()),
                     *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in (h, c)]],
                    names=[*KEY, "at", "shape", "h", "c"],
                )

    fields = [("at", IntegerType()), ("shape", IntegerType()), ("h", LongType()), ("c", LongType())]
    return docs.select(*KEY, "text").mapInArrow(run, _typed(docs, *fields))


def _surroundings(docs: DataFrame, places: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, version, h, first, bytes``: the text of all strings of each anchor in ``place``."""
    wanted = cut_lineage(places.groupBy(*KEY).agg(F.collect_set("place").alias("places")), "places")
    joined = sized_join(docs, wanted, KEY).select(*KEY, "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, h, first, texts = [], [], [], []
            for i, (text, own) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                data = text.as_py().encode()
                for place in own.as_py():
                    at, shape = place >> 32, place & 0xFFFFFFFF
                    begin = at - (shape >> 16)
                    rows.append(i)
                    h.append(xxhash.xxh3_64_intdigest(data[at : at + gram]))
                    first.append(begin)
                    texts.append(data[begin : begin + (shape & 0xFFFF) + length])
            some = batch.select(KEY).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(first, pa.int32()), pa.array(texts, pa.binary())],
                names=[*KEY, "h", "first", "bytes"],
            )

    schema = _typed(docs, ("h", LongType()), ("first", IntegerType()), ("bytes", BinaryType()))
    return joined.mapInArrow(run, schema)


def _shard_function(length: int, ranges: int, names: list[str]):
    """Of one shard: the runs to remove, and, of anchors that are split, the sorted distinct strings.

    The strings, as hashes with their places, are cut by range: one row for each range.
    """

    def run(rows: pa.Table) -> pa.Table:
        shard, numbers = Shard(rows.column("bytes").to_pylist()), {}
        keys = list(zip(*[rows.column(n).to_pylist() for n in KEY], strict=True))
        document = np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)
        first = rows.column("first").to_numpy().astype(np.int64)
        start = first[shard.text_of] + np.arange(len(shard.rest)) - shard.starts[shard.text_of]
        at, several, group = repeated_starts(shard, length, document[shard.text_of] << 32 | start)
        out = []
        hits = np.sort(at[several])
        for own in np.split(hits, np.flatnonzero(np.diff(shard.text_of[hits])) + 1) if len(hits) else []:
            doc, version = keys[int(shard.text_of[own[0]])]
            out.append({"doc_id": doc, "version": version, "runs": merge_runs(start[own] << 32 | (start[own] + length)).tolist()})
        split = np.array(rows.column("split").to_pylist(), bool)
        if split.any() and len(at):
            distinct = np.concatenate([[True], group[1:] != group[:-1]])
            places = at[distinct & split[shard.text_of[at]]]
            digest = np.array([xxhash.xxh3_64_intdigest(shard.bytes[p : p + length].tobytes()) for p in places.tolist()], np.uint64)
            by = np.argsort(digest)
            places, digest = places[by], digest[by]
            part = np.minimum((digest.astype(np.float64) / 2**64 * ranges).astype(np.int64), ranges - 1)
            for r in np.unique(part).tolist():
                own = np.flatnonzero(part == r)
                held = [keys[t] for t in shard.text_of[places[own]].tolist()]
                out.append({
                    "part": r, "digests": digest[own].view(np.int64).tolist(), "starts": start[places[own]].tolist(),
                    "ids": [k[0] for k in held], "versions": [k[1] for k in held],
                })
        kinds = [rows.schema.field("doc_id").type, pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(rows.schema.field("doc_id").type), pa.list_(pa.int32())]
        return pa.Table.from_arrays([pa.array([o.get(n) for o in out], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return run


def _merged_shards(strings: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, version, runs`` of the strings that several shards hold.

    Of one range, each shard's strings are a sorted run. A run is searched in what has been merged
    so far, by binary search, and then merged into it.
    """
    schema = _typed(docs, ("runs", ArrayType(LongType())))

    def run(rows: pa.Table) -> pa.Table:
        merged, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
        places, hits = [], set()
        for row in rows.to_pylist():
            own = np.array(row["digests"], np.int64).view(np.uint64)
            begin = len(places)
            places += zip(row["ids"], row["versions"], row["starts"], strict=True)
            into = np.searchsorted(merged, own)
            if len(merged):
                at = np.minimum(into, len(merged) - 1)
                for i in np.flatnonzero(merged[at] == own).tolist():
                    pair = places[int(owner[at[i]])], places[begin + i]
                    if pair[0] != pair[1]:
                        hits.update(pair)
            merged, owner = np.insert(merged, into, own), np.insert(owner, into, np.arange(begin, len(places)))
        found: dict = {}
        for doc, version, start in hits:
            found.setdefault((doc, version), []).append(start << 32 | (start + length))
        columns = [[k[0] for k in found], [k[1] for k in found], [merge_runs(np.array(v)).tolist() for v in found.values()]]
        kinds = [rows.schema.field("ids").type.value_type, pa.int32(), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    return strings.groupBy("part").applyInArrow(run, schema)


@F.pandas_udf(ArrayType(LongType()))
def _merged(runs: pd.Series) -> pd.Series:
    return runs.map(lambda parts: merge_runs(np.concatenate([np.asarray(p, np.int64) for p in parts])))


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``doc_id, version, runs``: runs of bytes to remove, as start * 2**32 + end, where there are any.

    ``docs`` is ``doc_id, version, text``; the end of a run may pass the text's.
    """
    anchors = cut_lineage(_anchors(docs, length, gram), "anchors")
    again = anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    level1 = cut_lineage(anchors.join(again, "h", "left_semi"), "level1")
    discard(anchors)
    place = F.struct(*KEY, "at", "shape")
    kinds = level1.groupBy("h", "c").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    kinds = cut_lineage(kinds, "kinds")
    copied = level1.join(kinds.where("one <> other").select("h", "c"), ["h", "c"], "left_semi")
    first = F.col("at") - F.shiftright("shape", 16)
    copied = copied.select(*KEY, F.array(_packed(first, first + F.col("shape").bitwiseAND(F.lit(0xFFFF)) + length)).alias("runs"))

    counts = cut_lineage(kinds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    places = kinds.select("h", "one").join(counts, "h", "left_semi").select("one.*")
    places = places.select(*KEY, _packed(F.col("at"), F.col("shape")).alias("place"))
    hot = counts.where(F.col("n") > shard).select("h", F.ceil(F.col("n") / shard).alias("parts"))
    shards = max(1, (counts.agg(F.sum("n")).first()[0] or 0) // shard)
    part = F.coalesce(F.pmod(F.xxhash64(*KEY, "first"), "parts"), F.lit(0))
    texts = sized_join(_surroundings(docs, places, length, gram), hot, ["h"], "left")
    texts = texts.select(*KEY, "first", "bytes", F.pmod(F.xxhash64("h", part), F.lit(shards)).alias("shard"), F.col("parts").isNotNull().alias("split"))
    numbers = ArrayType(LongType())
    schema = _typed(
        docs, ("runs", numbers), ("part", LongType()), ("digests", numbers), ("starts", numbers),
        ("ids", ArrayType(docs.schema["doc_id"].dataType)), ("versions", ArrayType(IntegerType())),
    )
    sharded = texts.groupBy("shard").applyInArrow(_shard_function(length, shards, schema.names), schema)
    found = cut_lineage(sharded, "shards")
    strings = found.where("part IS NOT NULL").drop(*KEY, "runs")
    across = _merged_shards(strings, docs, length)
    every = copied.unionByName(found.where("part IS NULL").select(*KEY, "runs")).unionByName(across)
    return every.groupBy(*KEY).agg(_merged(F.collect_set("runs")).alias("runs"))


def _packed(start: Column, end: Column) -> Column:
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(end.cast("long"))


def _cut(text: str, runs: list[int] | None) -> tuple[int, int, int, bytes]:
    """Bytes, bytes removed, runs, and the bytes that are left."""
    data = text.encode()
    if not runs:
        return len(data), 0, 0, data
    kept, at = [], 0
    for run in runs:
        kept.append(data[at : run >> 32])
        at = run & 0xFFFFFFFF
    left = b"".join([*kept, data[at:]])
    return len(data), len(data) - len(left), len(runs), left


def digests(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM, shard: int = SHARD
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of the bytes that are left."""
    keyed = plain(docs, id_column, text_column).select("doc_id", text_version().alias("version"), "text")
    runs = cut_lineage(repeated_runs(keyed, length, gram, shard), "runs")
    marked = sized_join(keyed, runs, KEY, "left").select("doc_id", "text", "runs")
    numbers = ["n_bytes", "n_removed", "n_spans"]
    schema = StructType([marked.schema["doc_id"], *[StructField(n, LongType()) for n in numbers], StructField("kept_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_cut(t.as_py(), r.as_py()) for t, r in zip(batch.column(1), batch.column(2), strict=True)]
            arrays = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            sums = pa.array([hashlib.sha256(f[3]).hexdigest() for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, sums], names=schema.names)

    return marked.mapInArrow(run, schema)
