"""Packing tokenised documents into sequences, with bounded space and in one pass.

Each task keeps a fixed number of open windows. A document's full windows are cut off and leave at
once; what remains goes whole into the window it fits best. When none fits, the fullest is topped up
with the head of the document and emitted, so a window that leaves early is never padded. At the end
of a partition the open windows are merged: their pieces are laid one after the other into full
windows, and the tail is cut at powers of two, which need no padding.

There is no shuffle, and a task holds the ids of its open windows and of one batch. A sequence is
numbered by its partition and its place there, so a task that is run again on the same split gives
the same sequences. A null or empty text has the end id alone. Repeated rows are packed once each,
ids may be null, and an empty table gives no pieces.

Ids come from the byte-level vocabulary in its rank form, which yields the ids of the JSON form (the
tests compare them). Words between single spaces are tokenised apart and remembered, up to a bound;
a text in which white space follows white space, or that holds the special token, goes whole.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from termlight.llm.tables import plain, text_batches

CAPACITY = 1024
OPEN_WINDOWS = 16
REMEMBERED = 120_000
#: The white space after which a cut before a space could change the ids.
_UNEVEN = regex.compile(r"\s\s|^\s|\s$|<\|endoftext\|>")


def _tiktoken(ranks: str):
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
        special_tokens={"<|endoftext|>": len(merges)},
    )


def encoder(ranks: str) -> Callable[[str], bytes]:
    """Text to ids as little-endian unsigned 32-bit numbers."""
    coder = _tiktoken(ranks)

    def whole(text: str) -> bytes:
        return array("I", coder.encode(text, allowed_special="all")).tobytes()

    known: dict[str, bytes] = {}

    def encode(text: str) -> bytes:
        if not text or _UNEVEN.search(text):
            return whole(text)
        words = text.split(" ")
        out = [whole(words[0])]
        for word in words[1:]:
            ids = known.get(word)
            if ids is None:
                ids = whole(" " + word)
                if len(known) >= REMEMBERED:
                    known.clear()
                known[word] = ids
            out.append(ids)
        return b"".join(out)

    return encode


class _Packer:
    """The open windows of one partition. A piece is (document, start, ids, tokens of the document)."""

    def __init__(self, first: int, capacity: int, open_windows: int):
        self.next, self.capacity, self.limit = first, capacity, open_windows
        self.open: list[tuple[int, list]] = []
        self.out: list[tuple] = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            length = len(ids) // 4
            self.out.append((doc, start, length, zlib.crc32(ids), tokens, self.next, offset))
            offset += length
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        tokens, start, size = len(ids) // 4, 0, self.capacity
        while tokens - start >= size:
            self.emit([(doc, start, ids[4 * start : 4 * (start + size)], tokens)])
            start += size
        need = tokens - start
        if not need:
            return
        fits = [i for i, (free, _) in enumerate(self.open) if free >= need]
        if fits:
            best = min(fits, key=lambda i: self.open[i][0])
            free, pieces = self.open[best]
            pieces.append((doc, start, ids[4 * start :], tokens))
            self.open[best] = (free - need, pieces)
            if free == need:
                self.emit(self.open.pop(best)[1])
            return
        if len(self.open) == self.limit:
            fullest = min(range(len(self.open)), key=lambda i: self.open[i][0])
            free, pieces = self.open.pop(fullest)
            pieces.append((doc, start, ids[4 * start : 4 * (start + free)], tokens))
            self.emit(pieces)
            start, need = start + free, need - free
        self.open.append((size - need, [(doc, start, ids[4 * start :], tokens)]))

    def finish(self) -> None:
        pieces = [p for _, held in sorted(self.open, key=lambda w: w[0]) for p in held]
        self.open = []
        left = sum(len(ids) // 4 for _, _, ids, _ in pieces)
        while left:
            size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            room, taken = size, []
            while room:
                doc, start, ids, tokens = pieces.pop(0)
                cut = min(room, len(ids) // 4)
                taken.append((doc, start, ids[: 4 * cut], tokens))
                if 4 * cut < len(ids):
                    pieces.insert(0, (doc, start + cut, ids[4 * cut :], tokens))
                room -= cut
            self.emit(taken)
            left -= size


def pack(
    docs: DataFrame,
    ranks: str,
    capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of the tokenised documents, each followed by ``end_id``, with their places.

    ``capacity`` is a power of two. Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32`` (of the
    ids as little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset``.
    """
    text_batches(docs)
    table = plain(docs, id_column, text_column)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = StructType([table.schema["doc_id"], *[StructField(n, LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ranks), end_id.to_bytes(4, "little")
        packer = _Packer(TaskContext.get().partitionId() << 40, capacity, open_windows)
        kind = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.out, strict=True)) or [()] * 7
            packer.out = []
            arrays = [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names])

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, encode(text.as_py()) + end)
                if len(packer.out) >= 20_000:
                    yield flush()
            yield flush()
        if kind is not None:
            packer.finish()
            yield flush()

    return table.mapInArrow(run, schema)
