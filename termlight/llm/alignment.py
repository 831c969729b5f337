"""Aligning the tokens of two tokenizers, by fragments of byte ranges that compose in any order.

Tokenizer A is byte-level BPE, tokenizer B is a SentencePiece model, which puts a space in front; so
both are held against a space and the text. Where a token of A and one of B end at the same byte,
both rows of tokens are cut; what lies between two cuts is a group, and every A token of a group is
linked to every B token of it.

A byte range of a document gives a *fragment*: the tokens up to its first cut (its head, which ends
a group begun further left), the closed groups between its first and last cut, and the tokens behind
the last cut (its tail). Without a cut all of it is open. Two neighbouring fragments make one: the
tail of the left and the head of the right are one group, and an empty fragment changes nothing. As
this is associative, the fragments of a document are composed in a tree of ``FAN`` at a time.

A document of at most ``CHUNK`` bytes is one fragment, finished where it is read. A longer one is cut
into stretches at spaces between other characters, which both tokenizers begin anew; the stretches
are dealt to tasks, tokenised there and divided at the multiples of ``CHUNK`` bytes, wherever these
fall. A stretch without such a space is as long as it is. The task that finishes a document holds
its tokens once, as it must to give its groups as one text.

Null and empty texts, and texts that the tokens do not spell (U+2581 is a space to B), have no
tokens. Repeated rows are documents of their own, ids may be null, other columns are not read, and
an empty table gives no rows.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlight.llm.prefix_bpe import Coder, Vocabulary
from termlight.llm.tables import plain, text_batches
from termlight.session import cut_lineage

CHUNK = 65_536
FAN = 16
REMEMBERED_WORDS = 300_000
WORD_LENGTH = 60
#: Links of one group that are listed one by one; beyond, equal tokens are counted first.
LISTED = 4096
#: Most frequent pairs that are broadcast; the rest are shuffled to their counts.
MAX_PAIRS = 1_000_000
#: A space that both tokenizers begin anew at.
_BREAK = regex.compile(r"(?<=\S) (?=\S)")

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = "row long, {id}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
FRAGMENT = (
    "row long, {id}, part long, piece long, fits boolean, cut boolean, n_a long, n_b long, head_a array<int>, "
    "head_b array<int>, tail_a array<int>, tail_b array<int>, groups string, n_groups long, n_links long, "
    "pairs array<long>, times array<long>"
)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(path: str) -> Vocabulary:
    """The vocabulary of a byte-level BPE file in JSON, whose merges are in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters = byte_letters()
    spelled = lambda token: bytes(letters[c] for c in token)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(made):
        raise ValueError("merges and ids are not in the same order")
    single = {spelled(c): model["vocab"][c] for c in letters}
    return Vocabulary(single | {spelled(a + b): i for (a, b), i in zip(pairs, made, strict=True)})


class _Words(dict):
    """Words and their pieces behind a space as 32-bit numbers, None for a word that these do not spell."""

    def __init__(self, pieces, spelled: list[bytes]):
        self.pieces, self.spelled = pieces, spelled

    def encode(self, text: str) -> bytes | None:
        ids = self.pieces.encode(text)
        fits = b"".join(map(self.spelled.__getitem__, ids)) == b" " + text.encode()
        return array("i", ids).tobytes() if fits else None

    def __missing__(self, word: str) -> bytes | None:
        found = self.encode(word)
        if len(word) <= WORD_LENGTH:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = found
        return found


class Aligner:
    """Both tokenizers, the byte lengths of their tokens and the decimal forms of their ids."""

    def __init__(self, byte_model: str, piece_model: str, pattern: str):
        import sentencepiece

        coder = Coder(byte_level(byte_model), pattern)
        pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        spelled = [
            bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in ((i, pieces.id_to_piece(i)) for i in range(len(pieces)))
        ]
        if any(b" " in own.lstrip(b" ") for own in spelled):
            raise ValueError("a piece goes over the start of a word")
        self.coder, self.words = coder, _Words(pieces, spelled)
        self.a_bytes, self.b_bytes = coder.lengths, np.array([len(own) for own in spelled])
        n = len(self.a_bytes)
        #: By id and whether it is the last of its side of a group.
        self.written = [f"{i}{'|' if last else ','}" for i in range(n) for last in (0, 1)]
        self.written += [f"{i}{';' if last else ','}" for i in range(len(spelled)) for last in (0, 1)]
        self.b_bits, self.bits = len(spelled).bit_length(), n.bit_length() + len(spelled).bit_length()

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both for a space and the text; None where they do not spell it."""
        if not text:
            return None
        # No piece goes over a space behind another character, so words between single spaces stand alone.
        if "  " in text or text[0] == " " or text[-1] == " ":
            found = [self.words.encode(text)]
        else:
            found = list(map(self.words.__getitem__, text.split(" ")))
        if None in found:
            return None
        return self.coder.encode(" " + text), np.frombuffer(b"".join(found), np.int32)

    def closed(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
        """For each pair of token rows, which end at one byte: groups as text, their number, links, pairs, times.

        A pair is an A id times 2**32 and a B id; ``times`` counts its links in the row.
        """
        a = np.concatenate([np.zeros(0, np.int32), *[r[0] for r in rows]]).astype(np.int64)
        b = np.concatenate([np.zeros(0, np.int32), *[r[1] for r in rows]]).astype(np.int64)
        if not len(a):
            return [("", 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(rows)
        a_ends, b_ends = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n_a, n_b = np.bincount(a_group), np.bincount(b_group)
        a_stop, b_stop = np.cumsum(n_a), np.cumsum(n_b)
        owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])[a_stop - 1]

        written = np.empty(len(a) + len(b), np.int64)
        last = np.zeros(len(a), np.int64)
        last[a_stop - 1] = 1
        written[np.arange(len(a)) + (b_stop - n_b)[a_group]] = 2 * a + last
        last = np.zeros(len(b), np.int64)
        last[b_stop - 1] = 1
        written[np.arange(len(b)) + a_stop[b_group]] = 2 * (len(self.a_bytes) + b) + last

        keys, times = self._links(a, b, owner, a_group, n_a, n_b, b_stop)
        own = np.searchsorted(keys >> self.bits, np.arange(len(rows) + 1))
        pairs = ((keys >> self.b_bits) & ((1 << (self.bits - self.b_bits)) - 1)) << 32 | keys & ((1 << self.b_bits) - 1)
        groups = np.bincount(owner, minlength=len(rows))
        links = np.concatenate([[0], np.cumsum(n_a * n_b)])[np.concatenate([[0], np.cumsum(groups)])]
        ends = np.cumsum([0, *[len(r[0]) + len(r[1]) for r in rows]])
        out = []
        for i in range(len(rows)):
            text = "".join(map(self.written.__getitem__, written[ends[i] : ends[i + 1]].tolist()))[:-1]
            mine = slice(own[i], own[i + 1])
            out.append((text, int(groups[i]), int(links[i + 1] - links[i]), pairs[mine], times[mine]))
        return out

    def _links(self, a, b, owner, a_group, n_a, n_b, b_stop) -> tuple[np.ndarray, np.ndarray]:
        """The distinct links of each owner as sorted keys of owner, A id and B id, with their numbers."""
        few = n_a * n_b <= LISTED
        wide = np.flatnonzero(~few)
        mine = np.flatnonzero(few[a_group]) if len(wide) else np.arange(len(a))
        reps = n_b[a_group[mine]]
        which = np.repeat(mine, reps)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(reps) - reps, reps)
        group = a_group[which]
        keys = owner[group] << self.bits | a[which] << self.b_bits | b[(b_stop - n_b)[group] + offset]
        keys, times = np.unique(keys, return_counts=True)
        if len(wide):
            a_stop = np.cumsum(n_a)
            parts = [(keys, times)]
            for g in wide.tolist():
                a_ids, a_times = np.unique(a[a_stop[g] - n_a[g] : a_stop[g]], return_counts=True)
                b_ids, b_times = np.unique(b[b_stop[g] - n_b[g] : b_stop[g]], return_counts=True)
                found = owner[g] << self.bits | a_ids[:, None] << self.b_bits | b_ids[None, :]
                parts.append((found.ravel(), np.outer(a_times, b_times).ravel()))
            keys, times = _added(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return keys, times

    def fragment(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> dict:
        """The fragment of the tokens whose ends are given, in one byte range."""
        none = np.zeros(0, np.int32)
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(cuts):
            return {
                "fits": True, "cut": False, "n_a": len(a), "n_b": len(b), "head_a": a, "head_b": b, "tail_a": none,
                "tail_b": none, "groups": "", "n_groups": 0, "n_links": 0, "pairs": none, "times": none,
            }
        (a0, a1), (b0, b1) = (np.searchsorted(e, cuts[[0, -1]], "right") for e in (a_ends, b_ends))
        text, groups, links, pairs, times = self.closed([(a[a0:a1], b[b0:b1])])[0]
        return {
            "fits": True, "cut": True, "n_a": len(a), "n_b": len(b), "head_a": a[:a0], "head_b": b[:b0],
            "tail_a": a[a1:], "tail_b": b[b1:], "groups": text, "n_groups": groups, "n_links": links,
            "pairs": pairs, "times": times,
        }

    def compose(self, fragments: list[dict]) -> dict:
        """One fragment of neighbouring ones, from left to right."""
        inner = [i for i, f in enumerate(fragments) if f["cut"]]
        joined = lambda name, some: np.concatenate([np.zeros(0, np.int32), *[f[name] for f in some]])
        whole = {
            "fits": all(f["fits"] for f in fragments), "cut": bool(inner),
            "n_a": sum(f["n_a"] for f in fragments), "n_b": sum(f["n_b"] for f in fragments),
        }
        first, final = (inner[0], inner[-1]) if inner else (len(fragments), len(fragments))
        head, tail = fragments[: first + 1], fragments[final:]
        for side in "ab":
            whole[f"head_{side}"] = joined(f"head_{side}", head)
            opened = [tail[0][f"tail_{side}"], *[f[f"head_{side}"] for f in tail[1:]]] if inner else []
            whole[f"tail_{side}"] = np.concatenate([np.zeros(0, np.int32), *opened])
        closing = [
            tuple(
                np.concatenate([fragments[i][f"tail_{s}"], *[fragments[k][f"head_{s}"] for k in range(i + 1, j + 1)]])
                for s in "ab"
            )
            for i, j in zip(inner, inner[1:], strict=False)
        ]
        middle = self.closed(closing) if closing else []
        parts = [(f["groups"], f["n_groups"], f["n_links"], f["pairs"], f["times"]) for f in (fragments[i] for i in inner)]
        parts = [p for both in zip(parts, [*middle, None], strict=True) for p in both if p] if inner else []
        return whole | self._sum(parts)

    def finish(self, whole: dict) -> dict:
        """The closed form of a document: its start is a cut, so that the head is its first group."""
        if not whole["fits"]:
            return dict.fromkeys(NUMBERS, 0) | {"groups": "", "pairs": [], "times": []}
        first = self.closed([(whole["head_a"], whole["head_b"])])
        rest = (whole["groups"], whole["n_groups"], whole["n_links"], whole["pairs"], whole["times"])
        return {"n_a": whole["n_a"], "n_b": whole["n_b"]} | self._sum([*first, rest])

    @staticmethod
    def _sum(parts: list[tuple]) -> dict:
        empty = np.zeros(0, np.int64)
        pairs, times = (np.concatenate([empty, *[p[i] for p in parts]]) for i in (3, 4))
        pairs, times = _added(pairs, times)
        return {
            "groups": ";".join(p[0] for p in parts if p[0]), "n_groups": sum(p[1] for p in parts),
            "n_links": sum(p[2] for p in parts), "pairs": pairs, "times": times,
        }


def _added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their numbers."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(times, starts)


@lru_cache(maxsize=4)
def aligner(byte_model: str, piece_model: str, pattern: str) -> Aligner:
    """One for the tasks of a process, with the words it remembers."""
    return Aligner(byte_model, piece_model, pattern)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    flat = np.concatenate([np.zeros(0, np.int64), *values])
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(kind.value_type))


def _kinds(schema: str) -> list[tuple[str, pa.DataType]]:
    named = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    named |= {"array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    fields = [field.split(" ") for field in schema.split(", ")]
    return [(f[0], named.get(f[-1])) for f in fields]


def _batch(schema: str, id_kind: pa.DataType, rows: list[dict]) -> pa.RecordBatch:
    kinds = [("doc_id", id_kind) if name == "{id}" else (name, kind) for name, kind in _kinds(schema)]
    columns = [_column([r[name] for r in rows], kind) for name, kind in kinds]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in kinds])


def _stretches(text: str, chunk: int) -> Iterator[str]:
    """Cut a text at the first fitting space behind each ``chunk`` bytes; that space is left out."""
    begin = 0
    while begin < len(text):
        # A character has a byte at least, so no stretch is cut before ``chunk`` characters.
        far = begin + len(text[begin : begin + chunk].encode()[:chunk].decode(errors="ignore"))
        found = _BREAK.search(text, max(far, begin + 1))
        yield text[begin : found.start() if found else len(text)]
        begin = found.end() if found else len(text)


def align(
    docs: DataFrame, byte_model: str, piece_model: str, pattern: str, chunk: int = CHUNK,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row a document: its groups and links.

    ``row`` numbers the documents, ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count, ``groups`` is
    the text ``a1,a2|b1;a3|b2,b3`` of decimal ids in order, ``pairs`` are the distinct linked ids as
    A id times 2**32 plus B id, and ``times`` says how often each is linked.
    """
    text_batches(docs)
    table = plain(docs, id_column, text_column).withColumn("row", F.monotonically_increasing_id())
    id_field = f"doc_id {table.schema['doc_id'].dataType.simpleString()}"
    long = F.octet_length("text") > chunk
    tools = (byte_model, piece_model, pattern)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*tools)
        for batch in batches:
            ids, texts, rows = (batch.column(i).to_pylist() for i in range(3))
            tokens = [own.tokens(text) or (np.zeros(0, np.int32),) * 2 for text in texts]
            closed = own.closed(tokens)
            yield _batch(ALIGNED, batch.schema.field(0).type, [
                {"row": row, "doc_id": doc, "n_a": len(a), "n_b": len(b), "groups": c[0], "n_groups": c[1],
                 "n_links": c[2], "pairs": c[3], "times": c[4]}
                for row, doc, (a, b), c in zip(rows, ids, tokens, closed, strict=True)
            ])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, row in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                at = 0
                for part, stretch in enumerate(_stretches(text.as_py(), chunk)):
                    columns = [pa.array([doc.as_py()], batch.schema.field(0).type), pa.array([row.as_py()], pa.int64())]
                    columns += [pa.array([v], pa.int64()) for v in (part, at)] + [pa.array([stretch], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "part", "at", "text"])
                    at += 1 + len(stretch.encode())

    def in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*tools)
        for batch in batches:
            for i in range(batch.num_rows):
                doc, row, part, at, text = (batch.column(c)[i].as_py() for c in range(5))
                tokens = own.tokens(text)
                a, b = tokens or (np.zeros(0, np.int32),) * 2
                a_ends, b_ends = at + np.cumsum(own.a_bytes[a]), at + np.cumsum(own.b_bytes[b])
                found = []
                for border in range(at // chunk, (int(a_ends[-1]) - 1) // chunk + 1 if len(a) else at // chunk + 1):
                    low, high = border * chunk, (border + 1) * chunk
                    (a0, a1), (b0, b1) = (np.searchsorted(e, [low, high], "right") for e in (a_ends, b_ends))
                    own_range = own.fragment(a[a0:a1], b[b0:b1], a_ends[a0:a1], b_ends[b0:b1])
                    found.append(own_range | {"row": row, "doc_id": doc, "part": part, "piece": border, "fits": tokens is not None})
                yield _batch(FRAGMENT, batch.schema.field(0).type, found)

    def composed(rows: pa.Table) -> pa.Table:
        own, id_kind = aligner(*tools), rows.schema.field("doc_id").type
        rows = rows.sort_by([("part", "ascending"), ("piece", "ascending")]).combine_chunks()
        lists = [name for name, kind in _kinds(FRAGMENT) if kind is not None and pa.types.is_list(kind)]
        found = []
        for i in range(rows.num_rows):
            row = {name: rows.column(name)[i] for name in rows.column_names}
            found.append({n: v.values.to_numpy(zero_copy_only=False) if n in lists else v.as_py() for n, v in row.items()})
        same = {"row": found[0]["row"], "doc_id": found[0]["doc_id"], "part": found[0]["part"] // FAN, "piece": 0}
        return pa.Table.from_batches([_batch(FRAGMENT, id_kind, [own.compose(found) | same])])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*tools)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = dict(zip(batch.schema.names, one.columns, strict=True))
                row = {
                    n: v[0].values.to_numpy(zero_copy_only=False) if pa.types.is_list(v.type) else v[0].as_py()
                    for n, v in row.items()
                }
                done = own.finish(row) | {"row": row["row"], "doc_id": row["doc_id"]}
                yield _batch(ALIGNED, batch.schema.field("doc_id").type, [done])

    aligned, fragment = (s.format(id=id_field) for s in (ALIGNED, FRAGMENT))
    short = table.where(~long).mapInArrow(whole, aligned)
    parts = table.where(long).mapInArrow(cut_up, f"{id_field}, row long, part long, at long, text string")
    dealt = parts.repartition("row", "part").mapInArrow(in_ranges, fragment)
    fragments = cut_lineage(dealt, "fragments")
    most = fragments.agg(F.max("part")).first()[0]
    while most is not None:
        number = F.floor(F.col("part") / FAN).alias("over")
        fragments = fragments.groupBy("row", number).applyInArrow(composed, fragment)
        most = most // FAN or None
    return short.unionByName(fragments.mapInArrow(finished, aligned))


def weigh(aligned: DataFrame, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``aligned`` (without ``pairs`` and ``times``) with ``n_best`` and ``count_sum``.

    A pair's count is the number of documents that hold it. ``n_best`` is how many links of the
    document have the highest count of their A id, ``count_sum`` adds the counts of all its links.
    Counts are combined in each task before they are shuffled. As many of the most frequent pairs as
    ``max_pairs`` allows are broadcast; rarer pairs, of which none is hot, are shuffled to their counts.
    """
    held = cut_lineage(aligned, "aligned")
    counts = held.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    a_id = F.shiftright("pair", 32)
    counts = cut_lineage(counts, "pairs")
    # One row an A id: at most as many as its vocabulary has.
    best = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("most"))
    scored = counts.withColumn("a", a_id).join(F.broadcast(best), "a")
    scored = scored.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))

    links = held.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    least = _broadcast_from(counts, max_pairs)
    known = scored.where(F.col("docs") >= least) if least > 1 else scored
    weighed = links.join(F.broadcast(known), "pair", "left" if least > 1 else "inner")
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("docs") * F.col("times")).alias("count_sum"),
    ]
    if least > 1:
        rare = weighed.where(F.col("docs").isNull()).select("row", "pair", "times")
        rare = rare.join(scored.where(F.col("docs") < least), "pair")
        weighed = weighed.where(F.col("docs").isNotNull()).select(*rare.columns).unionByName(rare)
    sums = weighed.groupBy("row").agg(*sums)
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    rest = [c for c in held.columns if c not in ("pairs", "times")]
    return held.select(*rest).join(sums, "row", "left").select(*rest, *numbers)


def _broadcast_from(counts: DataFrame, max_pairs: int) -> int:
    """The least count from which on there are at most ``max_pairs`` pairs, a power of two or 1 for all."""
    power = F.length(F.bin("docs")) - 1
    sizes = {r.power: r["count"] for r in counts.groupBy(power.alias("power")).count().collect()}
    total, least = 0, 1
    for power in sorted(sizes, reverse=True):
        total += sizes[power]
        if total > max_pairs:
            return 1 << (power + 1)
        least = 1
    return least
