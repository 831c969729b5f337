import itertools

from pyspark.sql import functions as F

from termlight.operators import annotate, index, refine
from termlight.operators.analyze import plain_tokens


def suggestions(spark, past, query):
    history = spark.createDataFrame([("u", i, q) for i, q in enumerate(past)], "user_id string, pos long, query string")
    asked = spark.createDataFrame([("q", "u", query)], "query_id string, user_id string, text string")
    return [r.suggestion for r in refine.suggest(asked, history).orderBy("suggestion_rank").collect()]


def by_hand(past, query, k=5):
    words = set(query.lower().split())
    return [p for p in reversed(past) if words & set(p.lower().split()) and p != query][:k]


def test_suggestions(spark):
    assert suggestions(spark, ["climate change", "dog food", "climate policy"], "climate change") == ["climate policy"]
    past = ["a b"] * 30 + ["a c", "b d"] + ["a"] * 40 + ["x y"] + ["b"] * 3
    for query in ("a", "b", "a b", "A c", "zzz", ""):
        assert suggestions(spark, past, query) == by_hand(past, query)


def test_history_append(spark):
    history = spark.createDataFrame([("u", 0, "a"), ("u", 1, "b")], "user_id string, pos long, query string")
    new = spark.createDataFrame([("u", 0, "b"), ("u", 1, "c"), ("v", 0, "a")], "user_id string, pos long, query string")
    found = sorted(tuple(r) for r in refine.append_history(history, new).collect())
    assert found == [("u", 0, "a"), ("u", 1, "b"), ("u", 3, "c"), ("v", 0, "a")]


def one_edit(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1} | {
        a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}


def test_spelling_matches_enumeration(spark):
    words = ["".join(p) for n in (1, 2, 3) for p in itertools.product("abc", repeat=n)][::2]
    words += ["internationalisation", "internationalization", "retrieval", "retriever", "abcabcabcabcabc"]
    counts = {w: 1 + (len(w) * 7 + i) % 5 for i, w in enumerate(words)}
    letters = sorted(set("".join(words)))
    asked = ["ab", "ba", "cab", "bca", "abcd", "retreival", "retirevel", "internationalizatoin",
             "abcabcbacabcab", "zzzzzz", "Ab", "12", ",", "internatoinalizaiton", "cbabcabcabcabcab"]

    def expected(word):
        if word.lower() in counts or word in ("12", ","):
            return word
        first = one_edit(word.lower(), letters)
        for near in (first, {e for f in first for e in one_edit(f, letters)}):
            known = [w for w in near if w in counts]
            if known:
                return min(known, key=lambda w: (-counts[w], w))
        return word

    dictionary = spark.createDataFrame(list(counts.items()), "term string, cf long")
    queries = spark.createDataFrame([(0, " ".join(asked))], "query_id int, text string")
    assert refine.correct_spelling(queries, dictionary).first().corrected.split() == [expected(w) for w in asked]


def test_few_words_need_no_written_keys(spark, monkeypatch):
    """Few words are corrected without a table of the dictionary's keys, and as many words are with it."""
    words = ["retrieval", "retriever", "ranking", "ranker", "query", "queries", "index", "é", "abcdefghij"]
    dictionary = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "term string, cf long")
    asked = spark.createDataFrame([(w,) for w in ["retreival", "rnaking", "quary", "qureies", "indxe", "abcdefghji", "zzzzzz"]], "word string")
    saved, save = [], refine.save_buckets
    monkeypatch.setattr(refine, "save_buckets", lambda df, path, name, *a: saved.append(name) or save(df, path, name, *a))
    speller = refine.build_speller(dictionary)
    few = sorted(tuple(r) for r in refine.corrections(asked, speller).collect())
    assert saved == ["terms"] and len(few) == 6
    monkeypatch.setattr(refine, "fits_broadcast", lambda *_: False)
    for _ in range(2):
        assert sorted(tuple(r) for r in refine.corrections(asked, speller).collect()) == few
    assert saved == ["terms", "keys"]


def test_synonyms(spark):
    table = spark.createDataFrame([("dog", 1, "dog"), ("dog", 2, "hot_dog"), ("dog", 3, "hound"), ("dog", 4, "cur"), ("cat", 1, "feline")], "term string, ord int, synonym string")
    asked = spark.createDataFrame([(1, ["cat", "dog", "cat"]), (2, ["bird"]), (3, [])], "query_id int, tokens array<string>")
    found = {r.query_id: r.expanded_tokens for r in refine.expand_synonyms(asked, table).collect()}
    assert found == {1: ["cat", "dog", "cat", "feline", "hot dog", "hound", "feline"], 2: ["bird"], 3: []}


def test_feedback_golden(spark):
    docs = spark.createDataFrame([(1, "Cats chase data cats"), (2, "dogs chase")], "doc_id int, text string")
    run = spark.createDataFrame([("q", "default", 1, 1), ("q", "default", 2, 2)], "query_id string, dataset string, doc_id int, rank int")
    assert refine.feedback_terms(run, docs, 2).first().words == ["cats", "chase"]


def test_feedback_leaves_hopeless_queries_alone(spark):
    docs = spark.createDataFrame([(1, "cats chase mice"), (2, "dogs bark"), (3, "birds sing")], "doc_id int, text string")
    built = index.build_index(docs)
    asked = plain_tokens(spark.createDataFrame([("a", "mice"), ("b", "nothing")], "query_id string, text string"))
    found = {r.query_id: r.prf_query for r in refine.relevance_feedback(built, asked, docs).collect()}
    assert found == {"a": "mice cats chase mice", "b": "nothing"}


def test_refine_flags(spark):
    docs = spark.createDataFrame([(1, "cats chase mice"), (2, "dogs bark"), (3, "birds sing")], "doc_id int, text string")
    words = spark.createDataFrame([("mice", 3), ("dogs", 2), ("cats", 1)], "term string, cf long")
    synonyms = spark.createDataFrame([("mice", 1, "rodents")], "term string, ord int, synonym string")
    history = spark.createDataFrame([("u", 0, "mise en place"), ("u", 1, "other")], "user_id string, pos long, query string")
    asked = spark.createDataFrame([("a", "u", "mise", True, True, False), ("b", "u", "mise", False, True, False), ("c", "v", "mice", True, True, True), ("d", "u", "mice", True, False, False)],
        "query_id string, user_id string, text string, use_spell_correction boolean, use_synonyms boolean, use_prf boolean")
    found = {r.query_id: r for r in refine.refine(asked, index.build_index(docs), docs, words, synonyms, history).collect()}
    assert [found[i].corrected for i in "abcd"] == ["mice", "mise", "mice", "mice"]
    assert found["a"].expanded_tokens == ["mice", "rodents"] and found["b"].expanded_tokens == ["mise"]
    assert found["c"].prf_query == "mice cats chase mice"
    assert found["c"].expanded_tokens == ["mice", "cats", "chase", "mice", "rodents", "rodents"]
    assert found["d"].expanded_tokens == ["mice"] and found["d"].prf_query is None
    assert found["a"].suggestions == ["mise en place"] and found["c"].suggestions == []


def test_entities_longest_first_without_overlap(spark):
    gazetteer = spark.createDataFrame([("new york", "GPE"), ("new york city", "GPE"), ("york", "PER"), ("city hall", "FAC"), ("hall", "FAC")], "phrase string, label string")
    docs = spark.createDataFrame([(1, "In New York City Hall, York."), (2, "nothing"), (3, None), (4, "Hall")], "doc_id int, text string")
    found = [(r.doc_id, r.pos, r.entity, r.label) for r in annotate.entities(docs, gazetteer, 3).orderBy("doc_id", "pos").collect()]
    assert found == [(1, 1, "New York City", "GPE"), (1, 4, "Hall", "FAC"), (1, 5, "York", "PER"), (4, 0, "Hall", "FAC")]


def test_sentiment(spark):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")
    docs = spark.createDataFrame([(1, "A good day"), (2, "not a good day"), (3, "  "), (4, None), (5, "bad, plain")], "doc_id int, text string")
    found = {r.doc_id: r for r in annotate.sentiment(docs, lexicon).collect()}
    assert found[1].compound == round(1.9 / (1.9**2 + 15) ** 0.5, 4) and found[1].sentiment == "POSITIVE"
    turned = 1.9 * -0.74
    assert found[2].compound == round(turned / (turned**2 + 15) ** 0.5, 4) and found[2].sentiment == "NEGATIVE"
    assert all((found[i].neg, found[i].neu, found[i].pos, found[i].compound) == (0.0, 1.0, 0.0, 0.0) for i in (3, 4))
    assert found[5].neg == round(3.5 / 4.5, 3) and found[5].neu == round(1 / 4.5, 3)
