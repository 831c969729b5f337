"""Byte-level BPE by dynamic programming over prefixes, with exact appends and edits.

Of the encodings of all prefixes of a piece only the last tokens are stored: ``last[i]`` ends the
encoding of the first ``i + 1`` bytes. It is the one token for which the token before it, which is
``last`` of the shorter prefix, may stand in front of it: neighbours are valid when the merges of
their joined bytes give the same two tokens again, and a row of tokens is an encoding exactly when
all its neighbours are valid. So a table grows by appended bytes without touching what is there,
and behind an edit it can be taken over again as soon as it agrees for as long as a token can be.

Whether two tokens may be neighbours is read off their edges: what stands at the right edge of the
first and at the left edge of the second while their own merges go on, and until which merge. A
merge across the border that comes before both are used up means no.

Texts are cut by a pattern first and each match is encoded apart; pieces are remembered up to a
bound. No match spans a change from other characters to white space, so ``amend`` encodes only from
the last such change before an edit to the first one after it and keeps all ids outside.

Null and empty texts have no ids. Repeated rows are encoded once each, ids of documents may be null,
other columns stay as they are (``ids`` and ``decoded`` are replaced), and an empty table stays empty.
A piece of any length takes memory in proportion to it.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from termlight.llm.tables import sized_join, text_batches

REMEMBERED_PIECES = 300_000
REMEMBERED_PAIRS = 1_000_000
NEVER = 1 << 62


def byte_pairs(ranks: dict[bytes, int], piece: bytes) -> tuple[list[bytes], list[tuple]]:
    """Merge the lowest rank, leftmost first, to the end.

    Returns the parts, and for each merge its rank, its two sides, and whether they were the first
    and the last part.
    """
    parts, merges = [piece[i : i + 1] for i in range(len(piece))], []
    while True:
        found = [(ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, at = min(found, default=(NEVER, 0))
        if rank == NEVER:
            return parts, merges
        merges.append((rank, parts[at], parts[at + 1], at == 0, at == len(parts) - 2))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


class Vocabulary:
    """The ranks of a vocabulary, which tokens end at a byte, and which may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks, strict=True))
        self.longest = max(map(len, ranks))
        self.lengths = [0] * (max(self.bytes_of) + 1)
        for token, own in self.bytes_of.items():
            self.lengths[token] = len(own)
        #: States of reading bytes, by the longest ending that begins a token: what follows on each byte,
        #: with the ending itself under -1, and the tokens that end there. Made when first met.
        self._begins = {token[:end] for token in ranks for end in range(len(token) + 1)}
        self._states: dict[bytes, tuple[dict, tuple]] = {b"": ({-1: b""}, ())}
        self._edges: dict[int, tuple | None] = {}
        self._neighbours: dict[tuple[int, int], bool] = {}

    def edges(self, token: int) -> tuple | None:
        """The parts at the left and at the right edge, each with the rank of the merge that uses it up.

        The third value says whether the token's merges come in the order of their ranks. None where
        merging the token's bytes does not give the token.
        """
        if token not in self._edges:
            own = self.bytes_of[token]
            parts, merges = byte_pairs(self.ranks, own)
            left = [(a, rank) for rank, a, _, first, _ in merges if first] + [(own, NEVER)]
            right = [(b, rank) for rank, _, b, _, last in merges if last] + [(own, NEVER)]
            ordered = all(x[0] <= y[0] for x, y in zip(merges, merges[1:], strict=False))
            self._edges[token] = (left, right, ordered) if len(parts) == 1 else None
        return self._edges[token]

    def neighbours(self, first: int, second: int) -> bool:
        """Whether the merges of both tokens' bytes give these two tokens again."""
        known = self._neighbours
        if (first, second) not in known:
            if len(known) >= REMEMBERED_PAIRS:
                known.clear()
            known[first, second] = self._border_holds(first, second)
        return known[first, second]

    def _border_holds(self, first: int, second: int) -> bool:
        left, right = self.edges(first), self.edges(second)
        if not (left[2] and right[2]):
            joined = self.bytes_of[first] + self.bytes_of[second]
            return byte_pairs(self.ranks, joined)[0] == [self.bytes_of[first], self.bytes_of[second]]
        ranks, i, j = self.ranks, 0, 0
        while True:
            (a, until_a), (b, until_b) = left[1][i], right[0][j]
            across = ranks.get(a + b, NEVER)
            # Of equal ranks the leftmost goes first: the first token's merges, the border's, the second's.
            if across < until_a and across <= until_b:
                return False
            if until_a > until_b:
                j += 1
            elif until_a == NEVER:
                return True
            else:
                i += 1

    def _step(self, state: dict, byte: int) -> tuple:
        """The state after a byte and the tokens that end there, longest first, with their lengths."""
        ending = state[-1] + bytes((byte,))
        while ending not in self._begins:
            ending = ending[1:]
        if ending not in self._states:
            ends = (ending[i:] for i in range(len(ending)))
            found = [(self.ranks[e], len(e)) for e in ends if e in self.ranks]
            self._states[ending] = {-1: ending}, tuple(f for f in found if self.edges(f[0]))
        state[byte] = self._states[ending]
        return self._states[ending]

    def extend(self, piece: bytes, last: list[int], length: int | None = None, state: dict | None = None) -> dict:
        """Fill in the last tokens of the prefixes that ``last`` does not reach yet, up to ``length``.

        ``state`` is what the call for the prefixes before returned; it is found again if not given.
        """
        known, done = self._neighbours, len(last)
        if state is None:
            state = self._states[b""][0]
            for byte in piece[max(0, done - self.longest) : done]:
                state = self._step(state, byte)[0]
        at = done
        for byte in piece[done:length]:
            state, tokens = state.get(byte) or self._step(state, byte)
            for token, size in tokens:
                if size > at:
                    last.append(token)
                    break
                pair = last[at - size], token
                fits = known.get(pair)
                if self.neighbours(*pair) if fits is None else fits:
                    last.append(token)
                    break
            at += 1
        return state

    def walk(self, piece: bytes, last: list[int]) -> list[int]:
        """The encoding of a piece from the last tokens of its prefixes. A token on its own stays whole."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        ids, end, lengths = [], len(piece), self.lengths
        while end:
            token = last[end - 1]
            ids.append(token)
            end -= lengths[token]
        ids.reverse()
        return ids

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        last: list[int] = []
        self.extend(piece, last)
        return self.walk(piece, last)


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    """From a file with lines of a base64 token and its rank; kept for the tasks of a process."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


class Prefixes:
    """A piece of bytes that grows and changes, with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes, of all by default."""
        length = len(self.piece) if length is None else length
        return self.vocabulary.walk(self.piece[:length], self.last)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.vocabulary.extend(self.piece, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` for the bytes from ``start`` to ``stop``; returns how many entries were made anew.

        Entries before the edit stay. Behind it they are made again until as many in a row as a token
        can have bytes are what they were; the rest then follows from these and is taken over.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last, agreed, at, state = old[:start], 0, start, None
        while at < len(self.piece) and agreed < self.vocabulary.longest:
            state = self.vocabulary.extend(self.piece, self.last, at + 1, state)
            same = at >= start + len(new) and self.last[at] == old[at - shift]
            agreed, at = (agreed + 1 if same else 0), at + 1
        self.last += old[at - shift :]
        return at - start


class _Pieces(dict):
    """Pieces of text and their ids as 32-bit numbers, remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.vocabulary.encode(piece.encode())).tobytes()
        if len(self) >= REMEMBERED_PIECES:
            self.clear()
        self[piece] = ids
        return ids


def _border_before(text: str, at: int) -> int:
    """The last space behind a letter or digit before ``at``: no match of the pattern goes over it."""
    found = text.rfind(" ", 0, at)
    while found > 0 and not text[found - 1].isalnum():
        found = text.rfind(" ", 0, found)
    return max(found, 0)


def _border_behind(text: str, at: int) -> int:
    """The first space behind a letter or digit that stands at ``at`` or later."""
    found = text.find(" ", at + 1)
    while found > 0 and not text[found - 1].isalnum():
        found = text.find(" ", found + 1)
    return found if found > 0 else len(text)


class Coder:
    """Texts to ids and back."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self.pieces = _Pieces(self.vocabulary)
        self.lengths = np.array(vocabulary.lengths)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def amend(self, text: str, ids: np.ndarray, start: int, stop: int, new: str) -> tuple[str, np.ndarray]:
        """Text and ids after the characters from ``start`` to ``stop`` gave way to ``new``."""
        first, final = _border_before(text, start), _border_behind(text, stop)
        ends = np.cumsum(self.lengths[ids])
        before = np.searchsorted(ends, len(text[:first].encode()), "right")
        after = np.searchsorted(ends, len(text[:final].encode()), "right")
        anew = self.encode(text[first:start] + new + text[stop:final])
        return text[:start] + new + text[stop:], np.concatenate([ids[:before], anew, ids[after:]])


@lru_cache(maxsize=4)
def coder(ranks: str, pattern: str) -> Coder:
    """One for the tasks of a process, with what it remembers."""
    return Coder(read_vocabulary(ranks), pattern)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    values = np.concatenate([np.zeros(0, np.int32), *found]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def encode(docs: DataFrame, ranks: str, pattern: str, text_column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the tokens of each text by the ranks of a file."""
    text_batches(docs)

    @F.arrow_udf(ArrayType(IntegerType()))
    def ids_of(texts: pa.Array) -> pa.Array:
        own = coder(ranks, pattern)
        return _lists([own.encode(text or "") for text in texts.to_pylist()])

    # So called, the function is not copied into each expression that uses the ids and run again there.
    return docs.withColumn("ids", ids_of.asNondeterministic()(F.col(f"`{text_column}`")))


def decode(coded: DataFrame, ranks: str, ids_column: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``, the bytes of its ids."""

    @F.arrow_udf(BinaryType())
    def bytes_of(lists: pa.Array) -> pa.Array:
        token = read_vocabulary(ranks).bytes_of.__getitem__
        return pa.array([b"".join(map(token, ids or ())) for ids in lists.to_pylist()], pa.binary())

    return coded.withColumn("decoded", bytes_of(F.col(f"`{ids_column}`")))


def amend(coded: DataFrame, edits: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, text, ids`` of encoded documents after edits, with only what is near an edit encoded anew.

    ``edits(doc_id, start, stop, new)`` put ``new`` for the characters from ``start`` to ``stop`` of
    the text before all edits. They do not overlap or start at one place, and an append starts and stops at the text's
    length. Edits of unknown documents, or beyond a text's end, do nothing.
    """
    text_batches(coded)
    places = [F.col(c).cast("long").alias(c) for c in ("start", "stop")]
    edit = F.struct(*places, F.coalesce("new", F.lit("")).alias("new"))
    lists = edits.groupBy(F.col("doc_id")).agg(F.sort_array(F.collect_list(edit), asc=False).alias("edits"))
    table = coded.select(F.col(f"`{id_column}`").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "ids")

    @F.arrow_udf("text string, ids array<int>")
    def amended(texts: pa.Array, ids: pa.Array, changes: pa.Array) -> pa.Array:
        own, found = coder(ranks, pattern), ([], [])
        for text, old, edits_of in zip(texts.to_pylist(), ids, changes.to_pylist(), strict=True):
            now = old.values.to_numpy()
            for change in edits_of or ():
                if 0 <= change["start"] <= change["stop"] <= len(text):
                    text, now = own.amend(text, now, change["start"], change["stop"], change["new"])
            found[0].append(text)
            found[1].append(now)
        return pa.StructArray.from_arrays([pa.array(found[0], pa.string()), _lists(found[1])], ["text", "ids"])

    joined = sized_join(table, lists, ["doc_id"], "left")
    return joined.select("doc_id", amended("text", "ids", "edits").alias("now")).select("doc_id", "now.*")
