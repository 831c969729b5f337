import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from termlight.llm import (
    components, doubling, exact_stream, language, licenses, merge_dropout, packing, quality, simhash, similar, suffix_dedup, urls,
)
from termlight.llm.suffixes import Shard
from termlight.session import cut_lineage

from . import brute

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Columns whose names the operators use themselves.
CLASH = ["version", "fp", "at", "runs", "digest", "row", "n", "h", "c", "host", "key", "__id", "__version"]


def corpus(n=60, seed=5):
    """Texts with exact copies, near copies, shared passages, ties and odd cases, with unique ids."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    shared = [word() for _ in range(40)]
    texts = [None, "", " \t\n", "Un.", "a", "a a a a a a a a a a a a a a", "x " * 300, "日本 語 " * 30]
    while len(texts) < n:
        own = [word() for _ in range(r.randint(1, 60))]
        kind = r.randint(0, 4)
        if kind == 1:
            texts.append(r.choice(texts))
            continue
        if kind == 2:
            own = own[:10] + shared[r.randint(0, 10) : r.randint(20, 40)] + own[10:]
        if kind == 3 and texts[-1]:
            own = texts[-1].split(" ")
            own[r.randrange(len(own))] = word()
        texts.append(r.choice([" ", "\n", "  "]).join(own))
    return list(enumerate(texts))


def frame(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return table.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus())


@pytest.mark.parametrize("bucket", [64, 1])
def test_simhash_groups(spark, docs, bucket):
    """Also with every bucket crowded, which goes by centres."""
    rows = found(simhash.near_duplicates(docs, max_bucket=bucket), "doc_id", "fingerprint", "component_id")
    assert rows == sorted(((d, *v) for d, v in brute.near(corpus()).items()), key=str)


def test_simhash_close_fingerprints(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(4)]
    prints = sorted({b ^ sum(1 << x for x in r.sample(range(64), k)) for b in base for k in (0, 1, 2, 4, 5, 6) for _ in range(6)})
    table = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    for bucket in (64, 2):
        links = simhash.links(table, bucket).collect()
        groups = {p: {p} for p in prints}
        for a, b in [(x.a % 2**64, x.b % 2**64) for x in links]:
            whole = groups[a] | groups[b]
            groups.update({p: whole for p in whole})
        want = {p: {p} for p in prints}
        for i, a in enumerate(prints):
            for b in prints[i + 1 :]:
                if (a ^ b).bit_count() <= 4:
                    whole = want[a] | want[b]
                    want.update({p: whole for p in whole})
        assert groups == want


def near_corpus():
    """Texts with copies of one to six changed words, a chain of them, and a passage in every third text."""
    r = random.Random(11)
    rows, passage = corpus(), " ".join(f"p{i}" for i in range(30))
    for _ in range(25):
        own = [f"w{r.randrange(5000)}" for _ in range(r.randint(20, 150))]
        for changed in range(r.randint(1, 6)):
            own = [*own]
            for _ in range(changed):
                own[r.randrange(len(own))] = f"v{r.randrange(5000)}"
            rows.append((len(rows), " ".join(own) + (" " + passage if changed % 3 == 0 else "")))
    rows += [(len(rows) + i, passage + f" end {i}") for i in range(9)]
    return rows


@pytest.mark.parametrize("bucket, frequent", [(64, 8), (2, 8), (2, 10**6)])
def test_similar_groups(spark, monkeypatch, bucket, frequent):
    """Also with every key crowded, and with no hash known as frequent."""
    monkeypatch.setattr(similar, "FREQUENT", frequent)
    rows = near_corpus()
    want = brute.similar(rows)
    got = {r.doc_id: r.component_id for r in similar.near_copies(frame(spark, rows), max_bucket=bucket).collect()}
    assert got == want
    four_bits = {d: root for d, (_, root) in brute.near(rows).items()}
    assert sum(d != root for d, root in want.items()) > sum(d != root for d, root in four_bits.items())


def test_stars_take_no_round(spark, monkeypatch):
    """The driver runs no round over what is done: none for stars, and none to see that the last was enough."""
    rounds, step = [], components._round
    monkeypatch.setattr(components, "_round", lambda edges: rounds.append(1) or step(edges))
    edges = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    assert found(components.components(edges([(2, 1), (3, 1), (5, 4), (6, 6)])), "node", "root") == [(2, 1), (3, 1), (5, 4)]
    assert components.components(edges([])).isEmpty() and not rounds
    assert found(components.components(edges([(2, 1), (3, 2)])), "node", "root") == [(2, 1), (3, 1)] and len(rounds) == 1
    line = [(i + 1, i) for i in range(1, 40)]
    assert found(components.components(edges(line)), "node", "root") == sorted([(i, 1) for i in range(2, 41)], key=str)


def test_merge_dropout_bounds_its_batches(spark):
    """Rows alone are no bound: a batch of long texts would be of any size."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    merge_dropout.encode(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), PIECES)
    assert spark.conf.get(name, None) == "1m"
    if before is not None:
        spark.conf.set(name, before)


def test_pipeline_drops_similar_copies(spark):
    """The stage keeps one document of each group at 5-word similarity 0.8, also beyond four bits."""
    rows = near_corpus()
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == {d for d, root in brute.similar(rows).items() if d == root}


def test_pipeline_drops_simhash_copies(spark):
    """Also where 5-word similarity says less: a line many times over, with another end in each text."""
    line = " ".join(f"l{i}" for i in range(8))
    rows = [(i, " ".join([line] * 60 + [f"end{i}x{j}" for j in range(9)])) for i in range(12)]
    rows += [(20 + i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(3)]
    want = {d: root for d, (_, root) in brute.near(rows).items()}
    assert len(set(want.values())) < 8 and len(set(brute.similar(rows).values())) == len(rows)
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_a_common_passage_makes_no_pairs(spark):
    """Texts of one passage and an eighth of their own are not similar: no pair of them is made by their places."""
    passage = [f"p{i}" for i in range(100)]
    rows = [(i, " ".join([*passage, *[f"own{i}x{j}" for j in range(15)]])) for i in range(80)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    levels = spark.sparkContext.broadcast(similar._levels(table, 5))
    keys = table.select("doc_id", similar._sketch(5, 0.8, levels)("text").alias("s")).select(
        F.col("s.set").alias("set"), F.col("s.n").alias("n"), F.posexplode("s.prefix").alias("at", "h"))
    assert keys.groupBy("h").count().where("count = 80").count() > 0
    pairs = similar._candidates(keys, keys, F.col("set_a") < F.col("set_b"), 0.8)
    assert pairs.count() == 0
    assert similar.near_copies(table).where("stays").count() == len(rows)


@pytest.mark.parametrize("shard", [3000, 2])
def test_repeated_bytes(spark, docs, shard):
    """Also with every anchor split over shards."""
    rows = suffix_dedup.digests(docs, length=24, gram=8, shard=shard)
    assert found(rows, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.repeated_bytes(corpus(), 24), key=str)


def test_suffix_array_and_prefixes():
    texts = [b"banana bandana", b"ananas", b"", b"banana bandana", bytes(300)]
    shard = Shard(texts)
    order = shard.suffix_array()
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    shared = shard.common_prefixes(order, 50)
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(want, 50)


@pytest.mark.parametrize("length", [8, 20])
def test_repeated_words(spark, docs, length):
    rows = doubling.digests(docs, length=length)
    assert found(rows, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.repeated_words(corpus(), length), key=str)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_groups(spark, docs, digest_bytes):
    """Also with a digest so short that different texts share one, and one file a batch."""
    rows = exact_stream.dedup(docs, digest_bytes=digest_bytes, files_per_batch=1)
    assert found(rows, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(brute.exact(corpus()), key=str)


def test_repeated_rows_and_null_ids(spark):
    """Rows that agree in id and text are one document; a null id is an id."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long), (None, long + " end"), (2, None), (2, "two"), (None, None)]
    table = frame(spark, rows)
    assert found(suffix_dedup.digests(table.where("doc_id = 1"), length=24, gram=8), "n_removed") == [(0,), (0,)]
    assert found(doubling.digests(table), "doc_id", "n_removed") == sorted([(1, 60), (1, 60), (None, 0), (2, 0), (2, 0), (None, 0)], key=str)
    kept = exact_stream.kept_rows(table)
    assert kept.columns == table.columns and kept.count() == 4
    assert simhash.near_duplicates(table).count() == 6
    assert packing.pack(table, RANKS).select("doc_id").distinct().count() == 3
    assert quality.ledger(table).count() == licenses.scan(table).count() == 6


def test_language(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(rows.where(~language.held_out()))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 $$ 4"), (None, "the and of")], "doc_id long, text string")
    assert found(language.predict(odd, model), "doc_id", "lang_pred")[:3] == [(1, "und"), (2, "und"), (3, "und")]
    judged = language.predict(rows, model).join(rows.select("doc_id", "lang"), "doc_id").where(language.held_out())
    right = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and 0 <= right[1] <= right[2] <= 1
    nothing = language.fit(rows.where("false"))
    assert language.predict(odd, nothing).where("lang_pred <> 'und'").count() == 0
    assert language.recognised(rows, model).columns == rows.columns


def test_packing(spark, docs):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*corpus(), (900, "long " * 4000), (901, "it's <|endoftext|> a\u00a0 b  \n c "), (902, " lead"), (903, "it's 12 o'clock\t\tnow")]
    ids = {d: coder.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    pieces = packing.pack(frame(spark, rows), RANKS, capacity=64, open_windows=3).collect()
    at, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        at[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for d, parts in at.items():
        assert [s for s, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) == len(ids[d])
    assert set(at) == set(ids)
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) in {1, 2, 4, 8, 16, 32, 64}


def test_merge_dropout(spark, docs):
    held = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = merge_dropout.Vocabulary(PIECES)
    texts = [t for _, t in corpus() if t] + ["  a  b\n\n c ", "▁ literal ▁", "\ufdd0 x", "q" * 90, "<s> <0x41>"]
    plain = merge_dropout.Encoder(vocabulary, 1, 0.0, 4).encode(texts[:-4])
    assert [np.frombuffer(p, "<u4").tolist() for p in plain] == held.encode(texts[:-4])
    for dropout in (0.0, 0.3, 1.0):
        coder = merge_dropout.Encoder(vocabulary, 7, dropout, 2)
        coded = coder.encode(texts)
        assert [b"".join(vocabulary.bytes_of[i] for i in np.frombuffer(c, "<u4")).decode()[1:] for c in coded] == texts
        assert coded == merge_dropout.Encoder(vocabulary, 7, dropout, 2).encode(texts)
        for variant, known in enumerate(coder.known):
            for word, ids in known.items():
                assert ids == vocabulary.ids(vocabulary.agenda(word, coder.key(word, variant), coder.below))
    varied = {merge_dropout.Encoder(vocabulary, s, 0.3, 2).encode(["international understanding"])[0] for s in range(8)}
    assert len(varied) > 1
    coded = merge_dropout.decode(merge_dropout.encode(docs, PIECES), PIECES)
    assert coded.where("decoded <> text").count() == 0 and coded.count() == 60


def test_merge_dropout_of_every_occurrence(spark):
    """A word has more segmentations than four, each the one of its own key; one odd character costs only itself."""
    vocabulary = merge_dropout.Vocabulary(PIECES)
    texts = ["international understanding " * 40, "y" * 90 + " \u2581 understanding", "", "international"]
    coder = merge_dropout.Encoder(vocabulary, 7, 0.3)
    coded = coder.encode(texts, ["1", "2", "3", "4"])
    seen = set()
    for text, document, ids in zip(texts, "1234", coded, strict=True):
        words = coder.words(text) if text else []
        keys = coder.places(text, document, len(words)).tolist()
        own = [vocabulary.ids(vocabulary.agenda(w, k, coder.below)) for w, k in zip(words, keys, strict=True)]
        assert ids == b"".join(own)
        seen.update(o for w, o in zip(words, own, strict=True) if w.endswith("understanding"))
    assert len(seen) > 4
    assert coded[::-1] == merge_dropout.Encoder(vocabulary, 7, 0.3).encode(texts[::-1], ["4", "3", "2", "1"])
    rows = spark.createDataFrame([(i, "understanding") for i in range(200)], "doc_id long, text string")
    out = merge_dropout.decode(merge_dropout.encode(rows, PIECES, dropout=0.3), PIECES)
    assert out.select("ids").distinct().count() > 4 and out.where("decoded <> text").count() == 0
    held = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    odd = np.frombuffer(merge_dropout.Encoder(vocabulary, 1, 0.0).encode(["international \ufdd0 \u2581"])[0], "<u4").tolist()
    assert odd[: len(held.encode("international"))] == held.encode("international") and len(odd) < 12
    assert b"".join(vocabulary.bytes_of[i] for i in odd).decode()[1:] == "international \ufdd0 \u2581"


def test_merge_dropout_looks_up_what_a_merge_changes(monkeypatch):
    """A merge changes two candidates; the others of its word are not looked up again."""
    vocabulary, asked = merge_dropout.Vocabulary(PIECES), []
    merges = merge_dropout.Vocabulary.merges
    monkeypatch.setattr(merge_dropout.Vocabulary, "merges", lambda self, keys: asked.append(keys.size) or merges(self, keys))
    words, path = [merge_dropout.SPACE + w for w in ("internationalisation", "misunderstanding", "a", "of")], []
    found = vocabulary.together(words, np.zeros(4, np.uint64), 0, path)
    assert found == [vocabulary.ids(vocabulary.agenda(w, 0, 0)) for w in words]
    assert sum(asked) <= sum(len(w) - 1 for w in words) + 2 * sum(p.shape[1] for p in path)


def test_licenses(spark):
    text = "Some words here.\nLicensed under the Apache License, Version 2.0.\n\nreleased  under the MIT license\n"
    rows = [(1, text), (2, "licensed under a licence that nobody has seen"), (3, None), (4, "License"), (5, "This work is licensed\nunder the GNU General\nPublic License, version 3.")]
    summary = licenses.summary(licenses.scan(frame(spark, rows)))
    assert found(summary, "doc_id", "n_matches", "licenses") == [
        (1, 3, "Apache-2.0|MIT"), (2, 0, ""), (3, 0, ""), (4, 0, ""), (5, 1, "GPL-3.0")]
    paragraph = rows[4][1] + "\n\n" + "other\n"
    assert found(licenses.summary(licenses.scan(frame(spark, [(5, paragraph)]))), "licenses") == [("GPL-3.0",)]
    for size in range(1, 30):
        low, high = licenses.bounds(size, 0.8)
        dice = lambda n: 2 * min(n, size) / (n + size)
        assert [n for n in range(1, 60) if dice(n) >= 0.8 - 1e-12] == list(range(max(low, 1), high + 1))


def test_url_rules_and_templates(spark):
    cases = {
        "https://A.NET/x?y": ("a.net", "/x", "net/", "block"), "http://x.example.net/en/1": ("x.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.com/de/1#f": ("example.com", "/de/1", "example.com/de/", "block"), "u://org?q": ("org", "", None, "allow"),
        "http://w.org/fr/": ("w.org", "/fr/", "org/fr/", "allow"), "nothing": ("", "", None, "allow"), "http://planet/": ("planet", "/", None, "allow"),
        "a://b://c": ("b:", "//c", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(90, None)]
    table = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("own") for c in CLASH})
    judged = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(table).collect()}
    assert judged == {**dict(enumerate(cases.values())), 90: ("", "", None, "allow")}
    # Labels in one branch of a host reach the pages that share its template, and no other branch.
    many = [(i, f"http://h.test/{'ad' if i % 2 else 'news'}/{i}/{'p' if i % 3 else 'q'}") for i in range(200)]
    rules = [("h.test", f"/ad/{i}/p", "block") for i in range(1, 120, 2)]
    out = urls.judge(spark.createDataFrame(many, "page_id long, url string"), rules).collect()
    assert {r.verdict for r in out if "/news/" in r.path} == {"allow"}
    assert {r.verdict for r in out if r.path.startswith("/ad/") and r.path.endswith("/p")} == {"block"}


def test_quality_ledger(spark, docs):
    rows = {r.doc_id: r for r in quality.judged(quality.ledger(docs), "v1").collect()}
    for d, text in corpus():
        words = (text or "").split() if not text or text.isascii() else [w.decode() for w in text.encode().split()]
        repeated = brute.repeated_window_words(words)
        assert (rows[d].n_words, rows[d].n_repeat_words, rows[d].word_chars) == (len(words), repeated, sum(map(len, words)))
        assert rows[d].base_failed == (len(words) < 10 or 100 * repeated > 20 * len(words))
        assert rows[d].kept == (rows[d].failed == 0)
    masks = [r.failed for r in rows.values()]
    for r in quality.ablation(quality.ledger(docs), "v1").collect():
        bit = 1 << quality.BITS[r.rule]
        assert r.n_failed == sum(m & bit != 0 for m in masks) and r.n_failed_alone == masks.count(bit)
        assert r.n_kept_without == masks.count(0) + masks.count(bit)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    results = [
        simhash.near_duplicates(none), suffix_dedup.digests(none), doubling.digests(none), exact_stream.dedup(none),
        exact_stream.kept_rows(none), packing.pack(none, RANKS), merge_dropout.decode(merge_dropout.encode(none, PIECES), PIECES),
        licenses.scan(none), quality.ledger(none), quality.ablation(quality.ledger(none), "v1"), doubling.without_repeats(none),
        urls.judge(spark.createDataFrame([], "page_id long, url string")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_pipeline(spark):
    """Every stage against the brute-force form of its operator, on what the stage before kept."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, t, ["x", "y"][d % 2], "s", len(t or "")) for d, t in corpus()]
    table = spark.createDataFrame(rows, schema).repartition(2)
    results = []
    for name, stage in corpus_pipeline.STAGES:
        table = cut_lineage(stage(spark, table, ""), name)
        results.append(table)
        if name != "packing":
            assert table.columns == [c.split(" ")[0] for c in schema.split(", ")]
    kept = [{r.doc_id: r.text for r in t.select("doc_id", "text").collect()} for t in results[:4]]
    assert all(any(c.isalpha() for c in t) for t in kept[0].values())
    assert set(kept[1]) == {d for d, keep, *_ in brute.exact(kept[0].items()) if d == keep}
    assert set(kept[2]) == {d for d, root in brute.similar(list(kept[1].items())).items() if d == root}
    want = {d: (removed, sha) for d, _, removed, sha in brute.repeated_words(kept[2].items(), 20)}
    for d, text in kept[3].items():
        removed, sha = want[d]
        assert text == kept[2][d] if not removed else hashlib.sha256(text.encode()).hexdigest() == sha
    assert {r.doc_id for r in results[4].collect()} == set(kept[3])
