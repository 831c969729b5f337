"""Language identification by the nearest of several centroids per language.

A text is a vector of its byte n-grams, lengths one to three, over lower-cased letters with blanks
between words: logarithmic counts times inverse document frequency, scaled to length one. Each
language is several centroids, found by clustering the vectors of its labelled texts on the sphere.
The prediction is the language of the centroid with the largest cosine; a text farther from every
centroid than its language allows is rejected as ``und``.

``fit`` reads a bounded sample of labelled rows, ``SAMPLE`` in all and an equal share of each label,
chosen by a hash of the id; a label needs one row to be learned. N-grams are hashed to ``SIZE``
places, so a sampled text is at most that many counts on the driver, and a model has no more
centroids than the sample has rows. Centroids of very few of a language's texts are dropped, since
these are noise under its label, and the bound of the rejection is a share of a low quantile of the
cosines of the language's sample, which does not fall as the sample grows. ``predict`` is a scan without a shuffle. Rows with null text, null label or no letter are not
learned from; null, empty and letterless texts are ``und`` with score 0. Repeated rows are judged
alike. From an empty sample every text is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from termlight.llm.tables import plain, text_batches

SIZE = 8192
SAMPLE = 3000
CLUSTERS = 4
ROUNDS = 12
#: A centroid with a smaller share of its language's sample is dropped, unless all have one.
FEW = 0.02
#: A text is rejected when its cosine is below this share of that quantile of its language's sample.
QUANTILE, SLACK = 0.02, 0.4
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
#: Bytes 0-127 that are no letters become blanks; bytes of longer characters stay.
_FOLD = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    least: np.ndarray


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams, or None where the text has no letter."""
    if not _LETTER.search(text):
        return None
    a = np.frombuffer(b" " + text.lower().encode().translate(_FOLD) + b" ", np.uint8)
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 32) | (a[:-1] != 32)
    a = a[keep].astype(np.uint32)
    pairs = (a[:-1] << np.uint32(8)) | a[1:]
    triples = (pairs[:-1] << np.uint32(8)) | a[2:]
    mixed = np.concatenate([a + np.uint32(1 << 25), pairs + np.uint32(1 << 24), triples]) * np.uint32(2654435761)
    return np.bincount(mixed >> np.uint32(19), minlength=SIZE)


def _unit(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    vector = (np.log1p(counts) * weights).astype(np.float32)
    return vector / max(float(np.sqrt(vector @ vector)), 1e-12)


def _clusters(vectors: np.ndarray) -> np.ndarray:
    """Centroids on the sphere; the first is the mean, each further one starts at the farthest text.

    Those that stand for few texts go, and their texts with them.
    """
    def scaled(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    centers = scaled(vectors.mean(axis=0, keepdims=True))
    while len(centers) < min(CLUSTERS, len(vectors)):
        far = int(np.argmin((vectors @ centers.T).max(axis=1)))
        centers = np.vstack([centers, vectors[far]])
    for _ in range(ROUNDS):
        own = (vectors @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, vectors)
        filled = np.bincount(own, minlength=len(centers)) > 0
        centers = scaled(np.where(filled[:, None], sums, centers))
    own = np.bincount((vectors @ centers.T).argmax(axis=1), minlength=len(centers))
    usual = own >= FEW * len(vectors)
    return centers[usual] if usual.any() else centers


def fit(
    labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    sample: int = SAMPLE,
) -> Model:
    """Learn from a sample of the labelled rows: the smallest by a hash, as many for each label.

    The numbers of rows give a bound of the hash below which a label very likely has its share, about
    twice as many; only rows below it are ranked, however frequent a label is.
    """
    text_batches(labelled)
    rows = labelled.select(
        F.col(f"`{lang_column}`").alias("lang"), F.col(f"`{text_column}`").alias("text"),
        F.xxhash64(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text_column}`")).alias("order"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()
    each = max(1, sample // max(1, len(counts)))
    # As an Arrow table: rows given from Python would start workers of their own on the executors.
    shares = pa.table({
        "lang": pa.array([r.lang for r in counts], pa.string()),
        "share": pa.array([min(1.0, (2.0 * each + 20) / r.n) for r in counts], pa.float64()),
    })
    bounds = labelled.sparkSession.createDataFrame(shares)
    near = rows.join(F.broadcast(bounds), "lang").where(F.col("order") / 2.0**64 + 0.5 <= F.col("share"))
    # Rows that agree in id and text are one.
    near = near.groupBy("lang", "order").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    few = near.withColumn("place", place).where(F.col("place") <= each)
    schema = "lang string, order long, at array<int>, n array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, order, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                found = gram_counts(text)
                if found is not None:
                    at = np.flatnonzero(found)
                    out.append({"lang": lang, "order": order, "at": at.tolist(), "n": found[at].tolist()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("lang", pa.string()), ("order", pa.int64()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))

    return _fit(few.select("lang", "order", "text").mapInArrow(count, schema).toArrow())


def _fit(learned: pa.Table) -> Model:
    """One matrix of the sample, scaled in place; a language is a range of its rows."""
    learned = learned.sort_by([("lang", "ascending"), ("order", "ascending")])
    at, n = (learned.column(c).combine_chunks() for c in ("at", "n"))
    ends = np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    vectors = np.zeros((learned.num_rows, SIZE), np.float32)
    place, number = at.flatten().to_numpy(), n.flatten().to_numpy()
    for i, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True) if learned.num_rows else ()):
        vectors[i, place[a:b]] = number[a:b]
    weights = (np.log((1 + len(vectors)) / (1 + (vectors > 0).sum(axis=0))) + 1).astype(np.float32)
    np.log1p(vectors, out=vectors)
    vectors *= weights
    for row in vectors:
        row /= max(float(np.sqrt(row @ row)), 1e-12)
    names = learned.column("lang").to_pylist()
    languages, centroids, of, least = sorted(set(names)), [], [], []
    for i, lang in enumerate(languages):
        first = names.index(lang)
        own = vectors[first : first + names.count(lang)]
        centers = _clusters(own)
        centroids.append(centers)
        of += [i] * len(centers)
        least.append(SLACK * float(np.quantile((own @ centers.T).max(axis=1), QUANTILE)))
    matrix = np.vstack(centroids).astype(np.float32) if centroids else np.zeros((0, SIZE), np.float32)
    return Model(languages, weights, matrix, np.array(of, int), np.array(least))


def classify(model: Model, text: str | None) -> tuple[str, float]:
    counts = None if text is None or not model.languages else gram_counts(text)
    if counts is None:
        return UNKNOWN, 0.0
    cosines = model.centroids @ _unit(counts, model.weights)
    best = int(cosines.argmax())
    score, lang = min(max(float(cosines[best]), 0.0), 1.0), int(model.of[best])
    return (UNKNOWN if score < model.least[lang] else model.languages[lang]), score


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score``, the cosine, for every row."""
    text_batches(docs)
    table = plain(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([table.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(shared.value, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return table.mapInArrow(run, schema)


def recognised(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, with all their columns."""
    text_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(BooleanType())
    def known(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: classify(shared.value, t)[0] != UNKNOWN).astype(bool)

    return docs.where(known(F.col(f"`{text_column}`")))


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))
