"""Byte-level BPE by prefixes against the tokenizer library, from scratch and after edits."""

import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import tiktoken

from termlight.llm import prefix_bpe
from termlight.llm.prefix_bpe import Coder, Prefixes, Vocabulary, read_vocabulary
from termlight.llm.registered import op11_byte_bpe

from .test_operators import CLASH, corpus, frame

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ALPHABETS = ["ab", "aeiou lst", "0123456789", "  \n\t", "aA.!-='", "éèü日本語", "\x00\x1c▁😀"]


@pytest.fixture(scope="module")
def library():
    ranks = read_vocabulary(RANKS).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_texts(n, seed=2):
    r = random.Random(seed)
    return ["".join(r.choice(r.choice(ALPHABETS)) for _ in range(r.randint(0, 50))) for _ in range(n)]


def test_texts_and_pieces(library):
    coder = Coder(read_vocabulary(RANKS), PATTERN)
    for text in some_texts(2000):
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text).tolist()) == text.encode()
        if text:
            assert coder.vocabulary.encode(text.encode()) == library._encode_single_piece(text.encode())


def test_every_prefix_appends_and_edits(library):
    r, vocabulary = random.Random(4), read_vocabulary(RANKS)
    for text in some_texts(300, 5):
        whole = (text * 8).encode()
        half = len(whole) // 2
        table = Prefixes(vocabulary, whole[:half])
        table.append(whole[half:])
        for length in r.sample(range(1, len(whole) + 1), min(5, len(whole))):
            assert table.ids(length) == library._encode_single_piece(whole[:length])
        start = r.randint(0, len(whole))
        stop, new = r.randint(start, min(len(whole), start + 9)), bytes(r.choices(whole, k=r.randint(0, 4))) if whole else b""
        table.replace(start, stop, new)
        assert table.piece == whole[:start] + new + whole[stop:]
        assert table.last == Prefixes(vocabulary, table.piece).last


def test_an_edit_is_taken_up_near_it():
    r = random.Random(6)
    table = Prefixes(read_vocabulary(RANKS), bytes(r.choices(b"abcdefgh", k=20_000)))
    assert table.replace(5_000, 5_003, b"xyz1") < 1_000
    assert table.last == Prefixes(table.vocabulary, table.piece).last


def test_ranks_out_of_order():
    """A token whose parts were ranked after it, one that its own merges never give, and equal ranks."""
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
    ranks |= {b"abc": 3, b"bc": 4, b"ab": 5, b"ca": 6, b"cab": 7, b"aa": 8, b"bb": 9, b"bbb": 10, b"abab": 11}
    vocabulary = Vocabulary(ranks)
    r = random.Random(7)
    for _ in range(3000):
        piece = bytes(r.choices(b"abc", k=r.randint(1, 14)))
        parts = [ranks[p] for p in prefix_bpe.byte_pairs(ranks, piece)[0]]
        assert vocabulary.encode(piece) == ([ranks[piece]] if piece in ranks else parts)


def test_encode_decode_frame(spark, library):
    rows = [*corpus(), (None, "a null id"), (7, "repeated"), (7, "repeated"), (900, "long " * 60_000 + "x" * 50_000)]
    coded = prefix_bpe.decode(prefix_bpe.encode(frame(spark, rows), RANKS, PATTERN), RANKS)
    found = sorted([(r.doc_id, r.ids, bytes(r.decoded)) for r in coded.collect()], key=str)
    assert found == sorted([(d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows], key=str)
    assert set(CLASH) < set(coded.columns)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert prefix_bpe.decode(prefix_bpe.encode(none, RANKS, PATTERN), RANKS).count() == 0


def test_amended_documents(spark, library):
    r = random.Random(8)
    rows = [(i, t) for i, t in enumerate(some_texts(200, 9))] + [(500, None), (501, "")]
    edits, want = [], {}
    for doc, text in rows:
        text = text or ""
        cuts = sorted(r.sample(range(len(text) + 1), 2 * r.randint(0, min(2, (len(text) + 1) // 2))))
        own = [(doc, a, b, r.choice(["", " ", "x", " and ", "'ll", "\n", "é"])) for a, b in zip(cuts[::2], cuts[1::2])]
        for _, a, b, new in reversed(own):
            text = text[:a] + new + text[b:]
        edits, want[doc] = edits + own, text
    edits += [(0, 10**6, 10**6, "beyond"), (10**6, 0, 0, "unknown")]
    coded = prefix_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, PATTERN)
    changes = spark.createDataFrame(edits, "doc_id long, start long, stop long, new string")
    for row in prefix_bpe.amend(coded, changes, RANKS, PATTERN).collect():
        assert (row.text, row.ids) == (want[row.doc_id], library.encode_ordinary(want[row.doc_id]))


def test_op11_over_a_whole_table(spark, library):
    folder = "/root/testdata/sf0.01"
    digest = lambda data: hashlib.sha256(data).hexdigest()
    want = {}
    for doc, text in duckdb.execute(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet'").fetchall():
        ids = library.encode_ordinary(text)
        want[doc] = (len(ids), digest(" ".join(map(str, ids)).encode()), digest(text.encode()))
    rows = op11_byte_bpe(spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_op11_encodes_each_text_once(spark):
    plan = op11_byte_bpe(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ids_of(") == 1 and "Exchange" not in plan
