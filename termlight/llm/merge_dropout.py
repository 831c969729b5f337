"""SentencePiece BPE with seeded merge-dropout, and lossless decoding.

Merges are taken best score first, leftmost among equals, as in plain BPE; but a candidate, two
neighbouring symbols that make a piece, is skipped if a keyed hash of its place falls below the
dropout rate. The key is made of the seed, the document (its id and text) and the word's place in it,
so the same call gives the same ids on every executor and every attempt, and every occurrence of a word
is segmented anew. Only the plain merges of a word are remembered: an occurrence that skips none of
them has the plain ids, the others are merged by themselves. With ``variants`` a word has that many
segmentations for a seed instead, keyed by the word. Rate 0 gives the ids of SentencePiece. Decoding concatenates the pieces and gives back the text exactly.

No piece of such a vocabulary goes on over a space or holds a line end (this is checked when it is
loaded), so words are segmented apart: those of a batch together, in numpy, one merge of each word a
round; very long words by an agenda of their own. Characters outside the vocabulary become byte
pieces. The character that stands for a space inside pieces is written as bytes where a text itself
holds it.

A null or empty text has no ids. Repeated rows get equal ids. An empty table gives an empty result.
There is no shuffle; a task holds one batch and a bounded memory of words.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from termlight.llm.tables import plain, text_batches

DROPOUT = 0.1
#: Segmentations of a word under a seed; None: as many as it has occurrences.
VARIANTS = None
#: Characters of text split into words at a time, words remembered by a task, and the longest that
#: are segmented together, so many at a time.
AT_ONCE = 1_000_000
REMEMBERED = 400_000
TOGETHER = 48
RUN = 20_000
SPACE = "▁"
#: Stands for a literal SPACE: a lone surrogate, which no text can hold.
_LITERAL = "\ud800"
#: Symbols of characters without a piece start here.
_OUTSIDE = 1 << 20
#: Orders of merges with their place in the last six bits stay below this.
_NONE = (1 << 31) - 1
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_FULL = (1 << 64) - 1
_START, _MIDDLE, _END = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_MIX = 0xBF58476D1CE4E5B9


def _skips(key: int, start: int, middle: int, end: int, below: int) -> bool:
    x = (key + start * _START + middle * _MIDDLE + end * _END) & _FULL
    x = ((x ^ (x >> 32)) * _MIX) & _FULL
    return ((x ^ (x >> 29)) * _START & _FULL) < below


def _skips_each(keys: np.ndarray, first: np.ndarray, middle: np.ndarray, end: np.ndarray, below: int) -> np.ndarray:
    """The same for one merge of each key."""
    x = keys + first * np.uint64(_START) + middle * np.uint64(_MIDDLE) + end * np.uint64(_END)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return (x ^ (x >> np.uint64(29))) * np.uint64(_START) < np.uint64(below)


class Vocabulary:
    """Pieces of a SentencePiece BPE model, and the merges that make them."""

    def __init__(self, model: str):
        import sentencepiece

        held = sentencepiece.SentencePieceProcessor(model_file=model)
        n = held.vocab_size()
        self.bytes_of = [b""] * n
        self.byte_ids = [0] * 256
        pieces = {}
        for i in range(n):
            piece = held.id_to_piece(i)
            if held.is_byte(i):
                self.bytes_of[i] = bytes([int(piece[1:-1], 16)])
                self.byte_ids[int(piece[1:-1], 16)] = i
            elif not (held.is_control(i) or held.is_unknown(i) or held.is_unused(i)):
                if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} goes on over a space or holds a line end")
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                pieces[piece] = i
        self.pieces = pieces
        made = {}
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                left, right = self._known(piece[:cut]), self._known(piece[cut:])
                if left is not None and right is not None:
                    made[left << 22 | right] = (-held.get_score(i), i)
        self.made = made
        keys = np.array(sorted(made), np.int64)
        self._merged = keys
        self._order = np.unique(np.array([made[k][0] for k in keys.tolist()]), return_inverse=True)[1].astype(np.int32)
        self._made = np.array([made[k][1] for k in keys.tolist()], np.int32)
        self._at = [np.full(1 << 21, -1, np.int32) for _ in range(3)]
        left = np.arange(len(keys))
        for level in range(3):
            slots = self._slot(keys[left], level)
            self._at[level][slots] = left
            left = left[self._at[level][slots] != left]
        if len(left) or len(keys) >> 24:
            raise ValueError("merges do not fit the table")
        self._symbols = _OUTSIDE + np.arange(0x110000, dtype=np.int32)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self._symbols[ord(piece)] = i

    def _known(self, part: str) -> int | None:
        return self.pieces.get(part, self.symbol(part) if len(part) == 1 else None)

    def symbol(self, char: str) -> int:
        return self.pieces.get(char, _OUTSIDE + ord(char))

    @staticmethod
    def _slot(keys: np.ndarray, level: int) -> np.ndarray:
        factor = np.uint64((_START, _MIDDLE, _END)[level])
        return (keys.astype(np.uint64) * factor >> np.uint64(43)).astype(np.int64)

    def merges(self, keys: np.ndarray) -> np.ndarray:
        """The number of each pair's merge, or -1. A pair is at a later level only where another has its slot."""
        found = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        for level in range(3):
            at = self._at[level][self._slot(keys[left], level)]
            left, at = left[at >= 0], at[at >= 0]
            here = self._merged[at] == keys[left]
            found[left[here]] = at[here]
            left = left[~here]
        return found

    def ids(self, symbols: list[int]) -> bytes:
        """Symbols to ids, those without a piece to byte pieces, as little-endian 32-bit numbers."""
        out = []
        for s in symbols:
            if s < _OUTSIDE:
                out.append(s)
            else:
                char = chr(s - _OUTSIDE)
                out += [self.byte_ids[b] for b in (SPACE if char == _LITERAL else char).encode()]
        return np.array(out, "<u4").tobytes()

    def agenda(self, word: str, key: int, below: int) -> list[int]:
        """Merge one word by an agenda of candidates."""
        symbols = [self.symbol(c) for c in word]
        n = len(symbols)
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple] = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (made := self.made.get(symbols[i] << 22 | symbols[j])):
                heapq.heappush(heap, (made[0], i, symbols[i], symbols[j], made[1], ends[i], ends[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, left, right, made, middle, end = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right or ends[i] != middle or ends[j] != end:
                continue
            if _skips(key, i, middle, end, below):
                continue
            symbols[i], symbols[j], ends[i], after[i] = made, -1, end, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s >= 0]

    def _ranked(self, left: np.ndarray, right: np.ndarray, keys: np.ndarray, places: tuple, below: int) -> tuple:
        """Order and place of each candidate in one number, ``_NONE`` where there is none, and its merge."""
        number = self.merges(left.astype(np.int64) << 22 | right)
        held = np.flatnonzero(number >= 0)
        if below:
            skipped = _skips_each(keys[held], *[p[held].astype(np.uint64) for p in places], below)
            held = held[~skipped]
        rank = np.full(len(number), _NONE, np.int32)
        rank[held] = self._order[number[held]] << 6 | places[0][held]
        return rank, number

    def together(self, words: list[str], keys: np.ndarray, below: int, path: list | None = None) -> list[bytes]:
        """Merge words of one length range, one merge of each a round; ``path`` gets the rows and places of the merges.

        Symbols lie at the place of their first character, a row of the matrices for each place. A merge
        changes two candidates, which alone are looked up again.
        """
        n, lengths = len(words), np.array([len(w) for w in words])
        wide = int(lengths.max())
        codes = np.frombuffer("".join([w.ljust(wide, "\0") for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
        place = np.repeat(np.arange(wide, dtype=np.int32), n)
        row = np.tile(np.arange(n), wide)
        inside = place < lengths[row]
        symbols = np.where(inside, self._symbols[codes.reshape(n, wide).T.ravel()], -1)
        after, before = place + np.int32(1), place - np.int32(1)
        rank, number = np.full(wide * n, _NONE, np.int32), np.zeros(wide * n, np.int32)
        at = np.flatnonzero(inside[n:])
        first = place[at]
        rank[at], number[at] = self._ranked(symbols[at], symbols[at + n], keys[row[at]], (first, first + 1, first + 2), below)
        while True:
            best = rank.reshape(wide, n).min(axis=0)
            own = np.flatnonzero(best != _NONE)
            if not len(own):
                break
            first = best[own] & 63
            at = first * n + own
            middle = after[at]
            gone = middle * n + own
            end = after[gone]
            if path is not None:
                path.append(np.stack([own, first, middle, end]))
            made = self._made[number[at]]
            symbols[at], symbols[gone], after[at] = made, -1, end
            rank[at] = rank[gone] = _NONE
            here = np.flatnonzero(end < lengths[own])
            follows = end[here] * n + own[here]
            before[follows] = first[here]
            there = np.flatnonzero(before[at] >= 0)
            previous = before[at[there]]
            ahead = previous * n + own[there]
            changed = np.concatenate([at[here], ahead])
            places = (
                np.concatenate([first[here], previous]), np.concatenate([end[here], first[there]]),
                np.concatenate([after[follows], end[there]]),
            )
            rank[changed], number[changed] = self._ranked(
                np.concatenate([made[here], symbols[ahead]]), np.concatenate([symbols[follows], made[there]]),
                np.concatenate([keys[own[here]], keys[own[there]]]), places, below)
        kept = symbols.reshape(wide, n).T
        counts = (kept >= 0).sum(axis=1)
        whole = kept[kept >= 0].astype("<u4")
        ends = np.cumsum(counts)
        outside = set(np.searchsorted(ends, np.flatnonzero(whole >= _OUTSIDE), "right").tolist())
        held, ends = whole.tobytes(), [0, *(4 * ends).tolist()]
        out = [held[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for i in outside:
            out[i] = self.ids(np.frombuffer(out[i], "<u4").tolist())
        return out


def _ranges(lengths: np.ndarray) -> Iterator[slice]:
    """Runs of ascending lengths that are near each other."""
    at = 0
    while at < len(lengths):
        size = int(lengths[at])
        end = min(int(np.searchsorted(lengths, max(size, min(size + size // 8, TOGETHER)), "right")), at + RUN)
        yield slice(at, end)
        at = end


class Encoder:
    """Texts to ids under one seed."""

    def __init__(self, vocabulary: Vocabulary, seed: int, dropout: float, variants: int | None = VARIANTS):
        self.vocabulary, self.seed, self.variants = vocabulary, seed, variants if dropout else 1
        self.below = min(int(dropout * 2**64), _FULL)
        self.known: list[dict[str, bytes]] = [{} for _ in range(self.variants or 0)]
        self._forget()

    def _forget(self) -> None:
        """Plain ids and merges of words; number 0 stands for every long word and has none."""
        self.number, self.plain = {}, [b""]
        self.first, self.merges = np.zeros(2, np.int64), np.zeros((3, 0), np.uint8)

    def key(self, word: str, variant: int) -> int:
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), (self.seed * 1_000_003 + variant) & _FULL)

    @staticmethod
    def words(text: str) -> list[str]:
        """Words with the spaces before them, line ends by themselves."""
        lines = (SPACE + text.replace(SPACE, _LITERAL).replace(" ", SPACE)).split("\n")
        out: list[str] = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            if SPACE + SPACE in line or line.endswith(SPACE):
                out += _WORDS.findall(line)
            else:
                out += line.replace(SPACE, " " + SPACE).lstrip(" ").split(" ")
        return [w for w in out if w]

    def places(self, text: str, document: str, n: int) -> np.ndarray:
        """A key for each of the ``n`` words of a document."""
        place = np.arange(n, dtype=np.uint64) + np.uint64(xxhash.xxh64_intdigest((document + text).encode(), self.seed & _FULL))
        return (place ^ (place >> np.uint64(31))) * np.uint64(_MIX)

    def encode(self, texts: list[str], documents: list[str] | None = None) -> list[bytes]:
        documents = documents or [""] * len(texts)
        split = [self.words(text) if text else [] for text in texts]
        if not self.variants:
            return self._each(split, [self.places(t, d, len(w)) for t, d, w in zip(texts, documents, split, strict=True)])
        chosen, missing = [], [set() for _ in self.known]
        for text, document, words in zip(texts, documents, split, strict=True):
            if self.variants > 1:
                which = ((self.places(text, document, len(words)) >> np.uint64(40)) % np.uint64(self.variants)).tolist()
            else:
                which = [0] * len(words)
            chosen.append(which)
            for word, variant in zip(words, which, strict=True):
                if word not in self.known[variant]:
                    missing[variant].add(word)
        for variant, words in enumerate(missing):
            self._learn(sorted(words, key=len), variant)
        known = self.known
        out = [b"".join([known[v][w] for w, v in zip(words, which, strict=True)]) for words, which in zip(split, chosen, strict=True)]
        if sum(map(len, self.known)) > REMEMBERED:
            self.known = [{} for _ in self.known]
        return out

    def _each(self, split: list[list[str]], places: list[np.ndarray]) -> list[bytes]:
        """The ids of the words of each text, every occurrence under its own key."""
        words = [w for own in split for w in own]
        keys = np.concatenate([np.zeros(0, np.uint64), *places])
        self._learn_plain(sorted({w for w in words if w not in self.number}, key=len))
        number = np.array([self.number[w] for w in words], np.int64)
        begin, count = self.first[number], self.first[number + 1] - self.first[number]
        at = np.repeat(np.arange(len(words)), count)
        merge = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        skipped = _skips_each(keys[at], *[m[merge].astype(np.uint64) for m in self.merges], self.below)
        again = np.unique(at[skipped])
        found = [self.plain[i] for i in number.tolist()]
        lengths = np.array([len(words[i]) for i in again.tolist()], np.int64)
        order = np.argsort(lengths, kind="stable")
        again, lengths = again[order], lengths[order]
        for run in _ranges(lengths):
            some = again[run].tolist()
            for i, ids in zip(some, self.vocabulary.together([words[i] for i in some], keys[some], self.below), strict=True):
                found[i] = ids
        for i in np.flatnonzero(number == 0).tolist():
            found[i] = self.vocabulary.ids(self.vocabulary.agenda(words[i], int(keys[i]), self.below))
        if len(self.number) > REMEMBERED:
            self._forget()
        ends = np.cumsum([0, *map(len, split)]).tolist()
        return [b"".join(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)]

    def _learn_plain(self, words: list[str]) -> None:
        """Remember plain ids and merges of words, given by length."""
        short = [w for w in words if len(w) <= TOGETHER]
        self.number.update((w, 0) for w in words[len(short) :])
        sizes, merges = [], [self.merges]
        for run in _ranges(np.array([len(w) for w in short], np.int64)):
            some = short[run]
            path: list[np.ndarray] = []
            ids = self.vocabulary.together(some, np.zeros(len(some), np.uint64), 0, path)
            self.number.update(zip(some, range(len(self.plain), len(self.plain) + len(some)), strict=True))
            self.plain += ids
            rows = np.concatenate([np.zeros((4, 0), np.int64), *path], axis=1)
            sizes.append(np.bincount(rows[0], minlength=len(some)))
            merges.append(rows[1:, np.argsort(rows[0], kind="stable")].astype(np.uint8))
        if short:
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(sizes))])
            self.merges = np.concatenate(merges, axis=1)

    def _learn(self, words: list[str], variant: int) -> None:
        known, vocabulary = self.known[variant], self.vocabulary
        short = [w for w in words if len(w) <= TOGETHER]
        for word in words[len(short) :]:
            known[word] = vocabulary.ids(vocabulary.agenda(word, self.key(word, variant), self.below))
        for run in _ranges(np.array([len(w) for w in short], np.int64)):
            some = short[run]
            keys = np.array([self.key(w, variant) for w in some], np.uint64)
            known.update(zip(some, vocabulary.together(some, keys, self.below), strict=True))


def encode(
    docs: DataFrame, model: str, seed: int = 1, dropout: float = DROPOUT, variants: int | None = VARIANTS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``text`` and ``ids``, the pieces of the text under this seed."""
    text_batches(docs)
    table = plain(docs, id_column, text_column)
    schema = StructType([*table.schema.fields, StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(model), seed, dropout, variants)
        for batch in batches:
            sizes = np.cumsum([0, *[len(t) for t in batch.column(1).to_pylist()]])
            begin = 0
            while begin < batch.num_rows:
                end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + AT_ONCE)))
                some = batch.slice(begin, end - begin)
                found = encoder.encode(some.column(1).to_pylist(), [f"{i}\n" for i in some.column(0).to_pylist()])
                ends = np.cumsum([0, *[len(f) // 4 for f in found]])
                values = pa.array(np.frombuffer(b"".join(found), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), ids], names=schema.names)
                begin = end

    return table.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids."""
    held: dict[str, Vocabulary] = {}

    @F.pandas_udf(StringType())
    def text_of(ids: pd.Series) -> pd.Series:
        if model not in held:
            held[model] = Vocabulary(model)
        piece = held[model].bytes_of.__getitem__
        return ids.map(lambda own: b"".join(map(piece, own.tolist())).decode()[1:])

    return encoded.withColumn("decoded", text_of(F.col(f"`{ids_column}`")))
