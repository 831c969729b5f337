"""Aligned tokens against both libraries and a plain count of groups and links."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termlight.llm import alignment
from termlight.llm.alignment import Aligner

from .test_operators import corpus, frame
from .test_tokens import some_texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def spell():
    """Both libraries: the ids and the bytes of each token for a space and a text."""
    bpe, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    bpe.encode_special_tokens = True
    letters = alignment.byte_letters()

    def of_piece(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()

    def both(text):
        a, b = bpe.encode(" " + text, add_special_tokens=False), pieces.encode(text)
        return a.ids, [bytes(letters[c] for c in t) for t in a.tokens], b, [of_piece(i) for i in b]

    return both


def plainly(rows, spell):
    """doc_id and the seven values of each row, by loops."""
    groups, docs = [], defaultdict(int)
    for _, text in rows:
        own = []
        if text:
            a, a_bytes, b, b_bytes = spell(text)
            if b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
                at_a, at_b = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
                cuts = sorted(set(at_a) & set(at_b))
                i = j = 0
                for cut in cuts:
                    k, m = at_a.index(cut, i) + 1, at_b.index(cut, j) + 1
                    own.append((a[i:k], b[j:m]))
                    i, j = k, m
        groups.append(own)
        for pair in {(x, y) for g in own for x in g[0] for y in g[1]}:
            docs[pair] += 1
    most = defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, _), own in zip(rows, groups, strict=True):
        links = Counter((x, y) for g in own for x in g[0] for y in g[1])
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((
            doc, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(links.values()),
            sum(n for p, n in links.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if own else "",
        ))
    return sorted(out, key=str)


def run(table, chunk=alignment.CHUNK, max_pairs=alignment.MAX_PAIRS):
    aligned = alignment.align(table, A, B, PATTERN, chunk)
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256))
    found = alignment.weigh(aligned.withColumn("groups_sha256", digest), max_pairs)
    return sorted((tuple(r) for r in found.select("doc_id", *NAMES).collect()), key=str)


def odd_rows():
    odd = [
        None, "", " ", "  two  spaces ", "a▁b", "▁", "x" * 300, "= " * 40 + "=" * 90, "\n\n \t\n x y", "<s> <|endoftext|> </s>",
        "ab" * 500 + " " + "日本語" * 100, "😀" * 50 + " word", "aaaa" * 2000, "0" * 3000 + " 12 " + "9" * 77, "é\x00\x1c z",
    ]
    rows = [*corpus(), *enumerate(odd, 200), *enumerate(some_texts(150, 21), 300)]
    return rows + [(None, "null id"), (None, None), (7, "repeated row"), (7, "repeated row")]


@pytest.mark.parametrize("chunk, max_pairs", [(1 << 16, 10**6), (40, 30), (7, 0)])
def test_aligned_documents(spark, spell, chunk, max_pairs):
    """Also with all texts in many byte ranges, and with few or no pairs broadcast."""
    rows = odd_rows() if chunk > 7 else odd_rows()[40:230:3]
    assert run(frame(spark, rows), chunk, max_pairs) == plainly(rows, spell)


def test_fragments_compose_in_any_tree():
    """Byte ranges of any width, composed in any order of neighbours, give the closed form of the whole."""
    own, r = Aligner(A, B, PATTERN), random.Random(3)
    same = lambda f: {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in f.items()}
    for text in [t for _, t in odd_rows() if t and own.tokens(t)]:
        a, b = own.tokens(text)
        whole = own.closed([(a, b)])[0]
        a_ends, b_ends = np.cumsum(own.a_bytes[a]), np.cumsum(own.b_bytes[b])
        size = int(a_ends[-1])
        borders = [0, *sorted(r.sample(range(1, size), min(size - 1, r.randint(0, 12)))), size]
        parts = []
        for low, high in zip(borders, borders[1:], strict=False):
            x, y = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
            parts.append(own.fragment(a[x], b[y], a_ends[x], b_ends[y]))
        flat = same(own.compose(parts))
        empty = own.fragment(a[:0], b[:0], a_ends[:0], b_ends[:0])
        assert same(own.compose([empty, *parts, empty])) == flat
        while len(parts) > 1:
            i = r.randrange(len(parts) - 1)
            parts[i : i + 2] = [own.compose(parts[i : i + 2])]
        assert same(own.compose(parts)) == flat
        done = own.finish(parts[0])
        assert (done["groups"], done["n_groups"], done["n_links"]) == whole[:3]
        assert done["pairs"].tolist() == whole[3].tolist() and done["times"].tolist() == whole[4].tolist()


def test_crowded_group(monkeypatch):
    """Groups with many links count equal tokens first."""
    own = Aligner(A, B, PATTERN)
    tokens = [own.tokens("a" * 900 + " b"), own.tokens("= " * 30)]
    listed = own.closed(tokens)
    monkeypatch.setattr(alignment, "LISTED", 1)
    for x, y in zip(listed, own.closed(tokens), strict=True):
        assert x[:3] == y[:3] and x[3].tolist() == y[3].tolist() and x[4].tolist() == y[4].tolist()


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def test_op12_over_a_whole_table(spark, spell):
    from termlight.llm.registered import op12_token_alignment

    folder = "/root/testdata/sf0.01"
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    found = op12_token_alignment(spark, folder).select("doc_id", *NAMES).collect()
    assert sorted((tuple(r) for r in found), key=str) == plainly(rows, spell)
