"""The same results in plain SQL over the given tables, for checking.

Each query is put together from common table expressions; nothing here is used by the operators.
"""

from __future__ import annotations

from termlight.functions.wordlists import (
    FEEDBACK_STOP_WORDS,
    FUSED_WORDS,
    NEGATORS,
    NUMBER_WORDS,
    STOP_WORDS,
)
from termlight.plans.oracle_stems import stems


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _sql(body: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()


# --- text ------------------------------------------------------------------------------------


def norm(text: str) -> str:
    clean = f"lower({text})"
    for pattern in (r"https?://\S+|www\.\S+", "<[^>]+>", r"&\w+;"):
        clean = f"regexp_replace({clean}, '{pattern}', ' ', 'g')"
    clean = rf"regexp_replace(strip_accents({clean}), '[^\x00-\x7F]', '', 'g')"
    clean = rf"regexp_replace({clean}, '[!-/:-@\[-`{{-~]', ' ', 'g')"
    clean = rf"regexp_replace({clean}, '\b[0-9]+\b', ' ', 'g')"
    return rf"coalesce(trim(regexp_replace({clean}, '\s+', ' ', 'g')), '')"


def words(text: str) -> str:
    clean = norm(text)
    for fused, parts in FUSED_WORDS.items():
        clean = rf"regexp_replace({clean}, '\b{fused}\b', '{parts}', 'g')"
    return f"list_filter(string_split({clean}, ' '), lambda t: t <> '')"


def stopped(text: str) -> str:
    return (
        f"list_filter({words(text)}, lambda t: length(t) >= 2 AND t NOT IN ({_quoted(STOP_WORDS)}))"
    )


def tokens(name: str, source: str, keys: str, text: str) -> str:
    """Analyzer output of ``source`` as ``keys, tokens``."""
    return f"""{name}_w AS (
  SELECT {keys}, list_filter(string_split({norm(text)}, ' '),
    lambda t: regexp_full_match(t, '[a-z]{{2,}}') AND t NOT IN ({_quoted(NUMBER_WORDS)})) AS w
  FROM {source}),
{name}_s AS (
  SELECT *, list_filter(w, lambda t: t NOT IN ({_quoted(STOP_WORDS)})) AS s FROM {name}_w),
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (w, s), CASE WHEN len(s) > 0 THEN s ELSE w END AS tokens FROM {name}_s)"""


DOCS = tokens("d", "documents", "doc_id", "text")
QUERIES = tokens("q", "benchmark", "item_id AS query_id, text", "text")
INDEX = f"""{DOCS},
posts AS (SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(tokens) AS term FROM d) GROUP BY ALL),
lens AS (SELECT doc_id, len(tokens) AS dl FROM d WHERE len(tokens) > 0),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM posts GROUP BY 1),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM lens),
okapi AS (SELECT *, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM vocab, stats),
idf AS (SELECT term, df,
    CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM okapi) ELSE raw END AS idf FROM okapi)"""
QTERMS = """qterms AS (SELECT query_id, term, count(*) AS qtf
  FROM (SELECT query_id, unnest(tokens) AS term FROM q) GROUP BY ALL)"""
BASE = f"{INDEX},\n{QUERIES},\n{QTERMS}"


def ranked(name: str, scores: str, k: int, keys: str = "query_id", digits: int = 6) -> str:
    return f"""{name}_r AS (SELECT {keys}, doc_id, round(score, {digits}) AS score FROM ({scores})),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER
    (PARTITION BY {keys} ORDER BY score DESC, doc_id) AS rank FROM {name}_r) WHERE rank <= {k})"""


def okapi_run(name: str, k: int, query_terms: str = "qterms") -> str:
    return ranked(
        name,
        f"""SELECT query_id, doc_id, sum(qtf * idf * tf * 2.5
      / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
    FROM {query_terms} JOIN posts USING (term) JOIN idf USING (term) JOIN lens USING (doc_id), stats
    GROUP BY ALL HAVING score > 0""",
        k,
    )


TFIDF = """widf AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS w FROM vocab, stats),
norms AS (SELECT doc_id, sqrt(sum((tf * w) ** 2)) AS norm FROM posts JOIN widf USING (term) GROUP BY 1)"""


def tfidf_run(name: str, k: int, query_terms: str = "qterms") -> str:
    return f"""{name}_q AS (SELECT query_id, term, w, qtf * w /
    sqrt(sum((qtf * w) ** 2) OVER (PARTITION BY query_id)) AS wq
  FROM {query_terms} JOIN widf USING (term)),
{ranked(name, f'''SELECT query_id, doc_id, sum(wq * tf * w) / any_value(norm) AS score
    FROM {name}_q JOIN posts USING (term) JOIN norms USING (doc_id)
    GROUP BY ALL HAVING score > 0''', k)}"""


def _dot(a: str, b: str) -> str:
    return f"list_dot_product({a}::DOUBLE[], {b}::DOUBLE[])"


QVECTORS = """qv AS (SELECT item_id AS query_id, embedding
  FROM benchmark JOIN embeddings ON item_id = vec_id)"""


def dense_run(name: str, k: int) -> str:
    return ranked(
        name,
        f"""SELECT query_id, vec_id AS doc_id, {_dot('qv.embedding', 'e.embedding')} AS score
    FROM qv, embeddings e""",
        k,
    )


def rrf(name: str, runs: list[str], k: int = 10, depth: int = 20) -> str:
    union = " UNION ALL ".join(f"SELECT * FROM {r} WHERE rank <= {depth}" for r in runs)
    return ranked(
        name,
        f"SELECT query_id, doc_id, sum(1 / (60 + rank)) AS score FROM ({union}) GROUP BY ALL",
        k,
        digits=10,
    )


def linear(name: str, runs: list[str], k: int = 10, depth: int = 20) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT query_id, doc_id, score / CASE WHEN top = 0 THEN 1 ELSE top END / {len(runs)}
        AS part FROM (SELECT *, max(score) OVER (PARTITION BY query_id) AS top
        FROM {r} WHERE rank <= {depth})"""
        for r in runs
    )
    return ranked(
        name,
        f"SELECT query_id, doc_id, sum(part) AS score FROM ({parts}) GROUP BY ALL",
        k,
        digits=10,
    )


def serial(name: str, k: int = 10) -> str:
    return ranked(
        name,
        "SELECT dense.* FROM dense SEMI JOIN bm25 ON dense.query_id = bm25.query_id"
        " AND dense.doc_id = bm25.doc_id",
        k,
    )


def rescored(name: str, k: int = 10, depth: int = 100) -> str:
    """The lexical candidates of ``bm25`` by their vectors."""
    return ranked(
        name,
        f"""SELECT query_id, doc_id, {_dot('qv.embedding', 'e.embedding')} AS score
        FROM (SELECT query_id, doc_id FROM bm25 WHERE rank <= {depth}) JOIN qv USING (query_id)
        JOIN embeddings e ON vec_id = doc_id""",
        k,
    )


RUNS = [okapi_run("bm25", 100), TFIDF, tfidf_run("tfidf", 20), QVECTORS, dense_run("dense", 100)]
ALL_RUNS = ",\n".join(
    [
        BASE,
        *RUNS,
        rescored("hs"),
        rrf("hp", ["bm25", "tfidf", "dense"]),
        """runs AS (
  SELECT 'bm25' AS model, * FROM bm25 WHERE rank <= 10
  UNION ALL SELECT 'tfidf', * FROM tfidf WHERE rank <= 10
  UNION ALL SELECT 'embedding', * FROM dense WHERE rank <= 10
  UNION ALL SELECT 'hybrid_serial', * FROM hs
  UNION ALL SELECT 'hybrid_parallel', * FROM hp)""",
    ]
)
LEXICAL_RUNS = ",\n".join(
    [
        BASE,
        okapi_run("bm25", 10),
        TFIDF,
        tfidf_run("tfidf", 10),
        """runs AS (SELECT 'bm25' AS model, * FROM bm25 UNION ALL SELECT 'tfidf', * FROM tfidf)""",
    ]
)
POOLED = """qrels AS (SELECT DISTINCT query_id, doc_id, quality AS relevance
  FROM runs JOIN labels USING (doc_id)),
rel AS (SELECT query_id, doc_id FROM qrels WHERE relevance > 0),
nrel AS (SELECT query_id, count(*) AS relevant FROM rel GROUP BY 1)"""
METRICS = """hits AS (SELECT model, query_id, rank,
    row_number() OVER (PARTITION BY model, query_id ORDER BY rank) AS nth
  FROM runs SEMI JOIN rel USING (query_id, doc_id)),
sums AS (SELECT model, query_id, count(*) AS hits, sum(nth / rank) AS aps,
    sum(1 / log2(rank + 1)) AS dcg FROM hits GROUP BY ALL),
ideal AS (SELECT query_id, sum(1 / log2(i + 1)) AS idcg
  FROM nrel, (SELECT unnest(range(1, 11)) AS i) WHERE i <= relevant GROUP BY 1),
lists AS (SELECT DISTINCT model, query_id FROM runs),
per_query AS (SELECT model, query_id, coalesce(hits, 0) / 10 AS precision,
    coalesce(hits / relevant, 0) AS recall, coalesce(aps / relevant, 0) AS ap,
    coalesce(dcg / idcg, 0) AS ndcg
  FROM lists LEFT JOIN sums USING (model, query_id) LEFT JOIN nrel USING (query_id)
  LEFT JOIN ideal USING (query_id))"""

LEMMAS = """lemmas AS (SELECT a.term AS form, b.term AS lemma
  FROM vocab a JOIN vocab b ON a.term = b.term || 's')"""

SENTENCES = r"""sentences AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS sentence,
    unnest(parts) AS text FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?\n]+') AS parts
  FROM documents))"""

HISTORY = """history AS (SELECT conv_id AS user_id, turn AS pos, text AS query
  FROM conversations WHERE role = 'user')"""

SPELLING = r"""dict AS (SELECT term, count(*) AS cf FROM (
    SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents) GROUP BY 1),
raws AS (SELECT item_id AS query_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS raw FROM (
  SELECT item_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS ws
  FROM benchmark)),
unknown AS (SELECT DISTINCT lower(raw) AS word FROM raws
  WHERE NOT regexp_full_match(lower(raw), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?')
    AND NOT regexp_full_match(raw, '[!-/:-@\[-`{-~]') AND lower(raw) NOT IN (SELECT term FROM dict)),
fixes AS (SELECT word, arg_min(term, struct_pack(edits := edits, less := -cf, term := term)) AS fix FROM (
  -- The distance counts bytes, so each accented letter becomes one letter of its own.
  SELECT word, term, cf, damerau_levenshtein(plain, translate(term, 'äöüßéèêëçñáíóúàâîïôûù',
    'ABCDEFGHIJKLMNOPQRSTU')) AS edits FROM dict, (
    SELECT word, translate(word, 'äöüßéèêëçñáíóúàâîïôûù', 'ABCDEFGHIJKLMNOPQRSTU') AS plain FROM unknown)
  WHERE abs(length(word) - length(term)) <= 2) WHERE edits <= 2 GROUP BY 1),
corrected AS (SELECT query_id, string_agg(coalesce(fix, raw), ' ' ORDER BY pos) AS corrected
  FROM raws LEFT JOIN fixes ON lower(raw) = word GROUP BY 1)"""

FEEDBACK = f"""fb_w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-zA-Z]+'),
    lambda w: length(w) > 2 AND w NOT IN ({_quoted(FEEDBACK_STOP_WORDS)})) AS ws FROM documents),
fb AS (SELECT doc_id, word, count(*) AS n, min(i) AS first FROM (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM fb_w) GROUP BY ALL)"""


def prf(run: str, queries: str, text: str) -> str:
    return f"""fb_t AS (SELECT query_id, word, sum(n) AS n, min(struct_pack(r := rank, f := first)) AS first
  FROM {run} JOIN fb USING (doc_id) GROUP BY ALL),
fb_k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, first) AS place
  FROM fb_t),
prf AS (SELECT query_id, {text} || ' ' || string_agg(word, ' ' ORDER BY place) AS prf_query
  FROM {queries} JOIN fb_k USING (query_id) WHERE place <= 5 GROUP BY query_id, {text})"""


def synonyms(vocab: str = "vocab") -> str:
    """A thesaurus from the corpus: terms of four letters or more that differ by a final letter."""
    return f"""syns AS (SELECT b.term AS term, row_number() OVER
    (PARTITION BY b.term ORDER BY a.cf DESC, a.term) AS ord, a.term AS synonym
  FROM {vocab} a JOIN {vocab} b ON substr(a.term, 1, length(a.term) - 1) = b.term
  WHERE length(b.term) >= 4)"""


EXPANDED = """expanded AS (SELECT query_id, string_agg(term, ' ' ORDER BY part, pos, ord) AS expanded_tokens
  FROM (SELECT query_id, 0 AS part, pos, 0 AS ord, term FROM toks
    UNION ALL SELECT query_id, 1, pos, ord, synonym FROM toks JOIN syns USING (term) WHERE ord <= 2)
  GROUP BY 1)"""
TOKS = """toks AS (SELECT query_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM q)"""

GAZETTEER = r"""bw AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
gaz AS (
  SELECT w[1] AS phrase, 'WORD' AS label FROM (SELECT DISTINCT [x] AS w FROM (
    SELECT unnest(w) AS x FROM bw) WHERE length(x) >= 8)
  UNION SELECT DISTINCT w[i] || ' ' || w[i + 1], 'PAIR'
    FROM (SELECT w, unnest(range(1, len(w))) AS i FROM bw)
  UNION SELECT DISTINCT w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 'TRIPLE'
    FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM bw)),
dw AS (SELECT doc_id, regexp_extract_all(text, '\p{L}[\p{L}\p{M}\p{Nd}''-]*') AS w FROM documents),
grams AS (SELECT doc_id, i - 1 AS pos, n, array_to_string(w[i:i + n - 1], ' ') AS entity FROM (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM dw), (VALUES (1), (2), (3)) v(n)
  WHERE i + n - 1 <= len(w)),
found AS (SELECT doc_id, pos, n, entity, label FROM grams JOIN gaz ON phrase = lower(entity)),
folded AS (SELECT doc_id, list_reduce(list({'pos': pos, 'until': pos + n,
    'kept': [{'pos': pos, 'entity': entity, 'label': label}]} ORDER BY pos, n DESC),
  lambda a, b: CASE WHEN b.pos >= a.until THEN
    {'pos': b.pos, 'until': b.until, 'kept': list_concat(a.kept, b.kept)} ELSE a END) AS f
  FROM found GROUP BY 1)"""

LEXICON = r"""lw AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z][a-z''-]*')) AS w
  FROM documents JOIN labels USING (doc_id)),
lex AS (SELECT word, 8.0::DOUBLE * sum(quality) / count(*) - 4 AS valence
  FROM (SELECT doc_id, unnest(w) AS word FROM lw) JOIN labels USING (doc_id) GROUP BY 1
  HAVING count(*) >= 5)"""


def _plain(cte: str, columns: str, where: str = "") -> str:
    return f"SELECT {columns} FROM {cte} {where}"


def alias_column(names: list[str], value: str, key: str) -> str:
    return ", ".join(
        f"CASE WHEN {key} % {len(names) + 1} = {i} THEN {value} END AS {n}"
        for i, n in enumerate(names)
    )


def oracle_sql() -> dict[str, str]:
    eval_sql = lambda value: _sql(
        f"SELECT model, query_id, round({value}, 6) AS {value} FROM per_query",
        LEXICAL_RUNS,
        POOLED,
        METRICS,
    )
    lexical = "query_id, doc_id, score, rank"
    refined = [
        INDEX,
        SPELLING,
        """flags AS (SELECT item_id AS query_id, text, item_id % 4 <> 3 AS sp, item_id % 2 = 0 AS sy,
          item_id % 3 = 0 AS pf FROM benchmark)""",
        tokens("c", "(SELECT query_id, f.text AS text, sy, pf, CASE WHEN sp THEN x.corrected ELSE f.text END"
                    " AS corrected FROM flags f JOIN corrected x USING (query_id))",
               "query_id, text, corrected, sy, pf", "corrected"),
        """cterms AS (SELECT query_id, term, count(*) AS qtf
          FROM (SELECT query_id, unnest(tokens) AS term FROM c) GROUP BY ALL)""",
        okapi_run("fed", 5, "cterms"),
        FEEDBACK,
        prf("fed", "(SELECT * FROM c WHERE pf)", "corrected"),
        tokens("p", "prf", "query_id", "prf_query"),
        """q AS (SELECT query_id, sy, coalesce(p.tokens, c.tokens) AS tokens FROM c LEFT JOIN p USING (query_id))""",
        synonyms(),
        TOKS,
        """fterms AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, term FROM toks
          UNION ALL SELECT query_id, synonym FROM toks JOIN syns USING (term) JOIN q USING (query_id)
          WHERE ord <= 2 AND sy) GROUP BY ALL)""",
    ]
    return {
        # sources
        "scan_resolve_ids": """SELECT doc_id AS ordinal, CASE WHEN doc_id % 5 < 4
            THEN doc_id::VARCHAR ELSE 'DOC_' || doc_id END AS resolved FROM documents""",
        "scan_resolve_text": """SELECT doc_id::VARCHAR AS doc_id, trim(coalesce(CASE WHEN doc_id % 2 = 0
            THEN source || ' ' END, '') || trim(text, chr(32) || chr(9) || chr(10) || chr(13))) AS text
            FROM documents""",
        "sample_first_n": """SELECT doc_id::VARCHAR AS doc_id, trim(text, chr(32) || chr(9) || chr(10) ||
            chr(13)) AS text FROM documents WHERE trim(text) <> '' ORDER BY documents.doc_id LIMIT 100""",
        "scan_queries": "SELECT item_id::VARCHAR AS query_id, text FROM benchmark",
        "scan_jsonl": "SELECT doc_id::VARCHAR AS doc_id, text FROM documents",
        "scan_malformed_counts": r"""SELECT (SELECT count(*) FROM documents) AS good,
            count(*)::BIGINT AS malformed FROM (SELECT unnest(regexp_split_to_array(html, '\r\n|\r|\n'))
            AS line FROM pages) WHERE trim(line) <> ''""",
        "empty_docs": _sql(
            "SELECT doc_id, sentence FROM st WHERE len(tokens) = 0",
            SENTENCES,
            tokens("st", "sentences", "doc_id, sentence", "text"),
        ),
        "processed_docs": _sql("SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM d", DOCS),
        "processed_queries": _sql(
            "SELECT query_id, text, array_to_string(tokens, ' ') AS tokens FROM q", QUERIES
        ),
        "resume_antijoin": _sql(
            "SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM d ANTI JOIN labels USING (doc_id)",
            DOCS,
        ),
        "document_lookup": """SELECT conv_id AS doc_id, arg_max(text, turn) AS text FROM conversations
            WHERE trim(text) <> '' GROUP BY 1""",
        "output_summary": """SELECT 'documents' AS name, count(*) AS rows FROM documents
            UNION ALL SELECT 'queries', count(*) FROM benchmark
            UNION ALL SELECT 'judgments', count(*) FROM labels
            UNION ALL SELECT 'vectors', count(*) FROM embeddings""",
        "dataset_catalog": "SELECT source AS dataset, count(*) AS docs FROM documents GROUP BY 1",
        "embedding_stats": """SELECT count(*) AS vectors, max(len(embedding))::BIGINT AS dim
            FROM embeddings""",
        "index_tables": _sql("SELECT doc_id, term, tf, dl FROM posts JOIN lens USING (doc_id)", INDEX),
        "qrels_trec": """SELECT DISTINCT 'labels' AS query_id, doc_id::VARCHAR AS doc_id FROM labels
            WHERE quality > 0""",
        "metrics_report": _sql(
            """SELECT model AS "Model", round(avg(ap), 6) AS "MAP", round(avg(recall), 6) AS "Recall@10",
            round(avg(precision), 6) AS "P@10", round(avg(ndcg), 6) AS "nDCG@10"
            FROM per_query SEMI JOIN nrel USING (query_id) GROUP BY 1""",
            LEXICAL_RUNS,
            POOLED,
            METRICS,
        ),
        # text
        "text_normalize": f"""SELECT 'documents' AS source, doc_id AS id, {norm('text')} AS normalized
            FROM documents UNION ALL SELECT 'pages', page_id, {norm('html')} FROM pages""",
        "text_tokens": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS tokens FROM documents",
        "text_stopwords": f"""SELECT doc_id, array_to_string({stopped('text')}, ' ') AS tokens
            FROM documents""",
        "text_fallback": _sql(
            "SELECT doc_id, sentence, array_to_string(tokens, ' ') AS tokens FROM st",
            SENTENCES,
            tokens("st", "sentences", "doc_id, sentence", "text"),
        ),
        "feedback_words": _sql(
            "SELECT doc_id, array_to_string(ws, ' ') AS words FROM fb_w", FEEDBACK
        ),
        # dictionaries
        "stem_vocabulary": _sql(
            "SELECT form, term FROM stems",
            f"forms AS (SELECT unnest({stopped('text')}) AS term FROM documents)",
            *stems("forms"),
        ),
        "stem_tokens": _sql(
            """SELECT doc_id, coalesce(string_agg(stems.term, ' ' ORDER BY pos), '') AS tokens
            FROM documents LEFT JOIN forms USING (doc_id) LEFT JOIN stems ON form = forms.term GROUP BY 1""",
            f"""forms AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos
              FROM (SELECT doc_id, {stopped('text')} AS w FROM documents))""",
            *stems("forms"),
        ),
        "lemma_join": _sql(
            """SELECT doc_id, coalesce(string_agg(coalesce(lemma, term), ' ' ORDER BY pos), '') AS tokens
            FROM (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM d)
            LEFT JOIN lemmas ON form = term GROUP BY 1""",
            INDEX,
            LEMMAS,
        ),
        "lemma_postings": _sql(
            """SELECT doc_id, coalesce(lemma, term) AS term, sum(tf)::BIGINT AS tf
            FROM posts LEFT JOIN lemmas ON form = term GROUP BY ALL""",
            INDEX,
            LEMMAS,
        ),
        "entity_gazetteer": _sql(
            """SELECT doc_id, k.pos::BIGINT AS pos, k.entity AS entity, k.label AS label
            FROM (SELECT doc_id, unnest(f.kept) AS k FROM folded)""",
            GAZETTEER,
        ),
        "sentiment_lexicon": _sql(
            """SELECT doc_id, round(m / total, 3) AS neg, round(plain / total, 3) AS neu,
              round(p / total, 3) AS pos, round(s / sqrt(s * s + 15), 4) AS compound,
              CASE WHEN round(s / sqrt(s * s + 15), 4) >= 0.05 THEN 'POSITIVE'
                   WHEN round(s / sqrt(s * s + 15), 4) <= -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment
            FROM (SELECT *, p + m + plain AS total FROM sums WHERE n > 0)
            UNION ALL SELECT doc_id, 0, 1, 0, 0, 'NEUTRAL' FROM all_words WHERE len(w) = 0""",
            LEXICON,
            rf"""all_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z''-]*') AS w
              FROM documents),
            toks AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM all_words),
            valued AS (SELECT doc_id, p, valence,
              CASE WHEN valence IS NULL AND word IN ({_quoted(NEGATORS)}) THEN 1 ELSE 0 END AS negator
              FROM toks LEFT JOIN lex USING (word)),
            turned AS (SELECT doc_id, coalesce(valence, 0) * (-0.74::DOUBLE) ** coalesce(sum(negator) OVER (
              PARTITION BY doc_id ORDER BY p ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS v
              FROM valued),
            sums AS (SELECT doc_id, count(*) AS n, sum(v) AS s,
              sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS p,
              sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS m,
              sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS plain FROM turned GROUP BY 1)""",
        ),
        # index
        "postings": _sql("SELECT doc_id, term, tf FROM posts", INDEX),
        "index_skip_counts": _sql(
            """SELECT CASE WHEN toxic = 1 THEN 'listed_empty' WHEN len(tokens) = 0 THEN 'no_tokens'
            ELSE 'kept' END AS reason, count(*) AS docs
            FROM st LEFT JOIN labels USING (doc_id) GROUP BY 1""",
            SENTENCES,
            tokens("st", "sentences", "doc_id, sentence", "text"),
        ),
        "index_skip_list": _sql(
            """SELECT doc_id, term, tf FROM posts
            ANTI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)""",
            INDEX,
        ),
        "doc_lengths": _sql("SELECT doc_id, dl FROM lens", INDEX),
        "corpus_stats": _sql(
            """SELECT n AS doc_count, round(avgdl, 6) AS avg_dl, (SELECT count(*) FROM vocab) AS vocab_size,
            round((SELECT avg(raw) FROM okapi), 6) AS mean_idf FROM stats""",
            INDEX,
        ),
        "dataset_indexes": _sql(
            """SELECT dataset, doc_count, round(avg_dl, 6) AS avg_dl, vocab_size FROM (
              SELECT source AS dataset, count(*) AS doc_count, avg(dl) AS avg_dl
              FROM lens JOIN documents USING (doc_id) GROUP BY 1) JOIN (
              SELECT source AS dataset, count(DISTINCT term) AS vocab_size
              FROM posts JOIN documents USING (doc_id) GROUP BY 1) USING (dataset)""",
            INDEX,
        ),
        "doc_freq": _sql("SELECT term, df, cf::BIGINT AS cf FROM vocab", INDEX),
        "postings_lookup": _sql(
            "SELECT doc_id, term, tf FROM posts SEMI JOIN qterms USING (term)", BASE
        ),
        "postings_lookup_shelves": _sql(
            "SELECT doc_id, term, tf FROM posts SEMI JOIN qterms USING (term)", BASE
        ),
        "doc_length_lookup": _sql(
            """SELECT DISTINCT vec_id AS doc_id, coalesce(dl, 0)::BIGINT AS dl
            FROM embeddings LEFT JOIN lens ON vec_id = doc_id""",
            INDEX,
        ),
        "tfidf_weights": _sql(
            """SELECT doc_id, term, round(tf * w / norm * 1000000)::BIGINT AS weight
            FROM posts JOIN widf USING (term) JOIN norms USING (doc_id)""",
            INDEX,
            TFIDF,
        ),
        "bm25_idf": _sql("SELECT term, round(idf * 1000000)::BIGINT AS idf FROM idf", INDEX),
        # retrieval
        **{
            name: _sql(_plain("bm25", lexical), BASE, okapi_run("bm25", 10))
            for name in ("bm25_okapi", "bm25_shelves", "bm25_query_blocks", "bm25_pruned")
        },
        "bm25_plus_one": _sql(
            _plain("run", lexical),
            BASE,
            ranked(
                "run",
                """SELECT query_id, doc_id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5
                  / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
                FROM qterms JOIN posts USING (term) JOIN vocab USING (term)
                JOIN lens USING (doc_id), stats GROUP BY ALL""",
                10,
            ),
        ),
        "bm25_param_sweep": _sql(
            "SELECT query_id, k1, b, doc_id, score, rank FROM run",
            BASE,
            "params(k1, b) AS (VALUES (0.5::DOUBLE, 0.0::DOUBLE), (1.5, 0.75), (3.0, 1.0))",
            ranked(
                "run",
                """SELECT query_id, k1, b, doc_id, sum(qtf * idf * tf * (k1 + 1)
                  / (tf + k1 * (1 - b + b * dl / avgdl))) AS score
                FROM qterms JOIN posts USING (term) JOIN idf USING (term) JOIN lens USING (doc_id),
                  stats, params GROUP BY ALL HAVING score > 0""",
                10,
                "query_id, k1, b",
            ),
        ),
        "tfidf_cosine": _sql(_plain("tfidf", lexical), BASE, TFIDF, tfidf_run("tfidf", 10)),
        "tfidf_loglog": _sql(
            _plain("run", lexical),
            BASE,
            ranked(
                "run",
                """SELECT query_id, doc_id, sum((1 + ln(qtf)) * (1 + ln(tf)) * ln(n / (1 + df)) ** 2)
                  AS score FROM qterms JOIN posts USING (term) JOIN vocab USING (term), stats
                GROUP BY ALL""",
                10,
            ),
        ),
        **{
            name: _sql(_plain("dense", lexical), QVECTORS, dense_run("dense", 10))
            for name in ("dense_topk", "dense_pivots")
        },
        "vectors_saved": """SELECT vec_id AS doc_id, (SELECT max(len(embedding)) FROM embeddings)::INTEGER AS dimension,
            (SELECT count(*) FROM embeddings) AS vectors, array_to_string(list_transform(embedding::DOUBLE[],
            lambda x: round(x * 100000)::BIGINT), ' ') AS scaled FROM embeddings""",
        "vector_normalize": f"""SELECT vec_id, array_to_string(list_transform(embedding::DOUBLE[],
            lambda x: (round(x / sqrt({_dot('embedding', 'embedding')}) * 100000))::BIGINT), ' ') AS scaled
            FROM embeddings""",
        "query_tf": _sql("SELECT query_id, term, qtf FROM qterms", QUERIES, QTERMS),
        "hybrid_serial": _sql(
            _plain("hs", lexical), BASE, okapi_run("bm25", 100), QVECTORS, dense_run("dense", 100),
            serial("hs"),
        ),
        "hybrid_serial_rescored": _sql(
            _plain("hs", lexical),
            BASE,
            okapi_run("bm25", 100),
            QVECTORS,
            rescored("hs"),
        ),
        "hybrid_parallel_rrf": _sql(
            _plain("hp", lexical), BASE, *RUNS, rrf("hp", ["bm25", "tfidf", "dense"])
        ),
        "hybrid_parallel_linear": _sql(
            _plain("hp", lexical), BASE, *RUNS, linear("hp", ["bm25", "tfidf", "dense"])
        ),
        "model_router": _sql(
            """SELECT query_id || '/' || model AS query_id, model, doc_id, score, rank FROM runs
            UNION ALL SELECT query_id || '/linear', 'hybrid_parallel', doc_id, score, rank FROM hl""",
            ALL_RUNS,
            linear("hl", ["bm25", "tfidf", "dense"]),
        ),
        "router_deep_requests": _sql(
            " UNION ALL ".join(
                f"SELECT query_id || '/{k}' AS query_id, 'hybrid_serial' AS model, doc_id, score, rank FROM hs{k}"
                for k in (10, 150, 250)
            ),
            BASE, okapi_run("bm25", 300), QVECTORS,
            *[rescored(f"hs{k}", k, depth) for k, depth in ((10, 100), (150, 150), (250, 300))],
        ),
        "router_mixed_requests": _sql(
            " UNION ALL ".join(
                f"""SELECT query_id || '/{m}/{f} {k}' AS query_id, '{m}' AS model, doc_id, score, rank
                FROM {run} WHERE rank <= {k}"""
                for k in (3, 10, 25)
                for m, f, run in [
                    ("bm25", "rrf", "bm25"), ("tfidf", "rrf", "tfidf"), ("embedding", "rrf", "dense"),
                    ("hybrid_serial", "rrf", "hs"), ("hybrid_parallel", "rrf", f"hp{k}"),
                    ("hybrid_parallel", "linear", f"hl{k}"),
                ]
            ),
            BASE, okapi_run("bm25", 100), TFIDF, tfidf_run("tfidf", 50), QVECTORS, dense_run("dense", 100),
            rescored("hs", 25),
            *[rrf(f"hp{k}", ["bm25", "tfidf", "dense"], k, 2 * k) for k in (3, 10, 25)],
            *[linear(f"hl{k}", ["bm25", "tfidf", "dense"], k, 2 * k) for k in (3, 10, 25)],
        ),
        "search_datasets": _sql(
            "SELECT query_id, 'src' || (query_id % 20) AS dataset, doc_id, score, rank FROM run",
            BASE,
            """src AS (SELECT doc_id, source FROM documents),
            dp AS (SELECT source, doc_id, term, tf FROM posts JOIN src USING (doc_id)),
            dlen AS (SELECT source, doc_id, dl FROM lens JOIN src USING (doc_id)),
            ds AS (SELECT source, count(*) AS n, avg(dl) AS avgdl FROM dlen GROUP BY 1),
            dv AS (SELECT source, term, count(*) AS df FROM dp GROUP BY ALL),
            dk AS (SELECT source, term, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM dv JOIN ds USING (source)),
            di AS (SELECT source, term, CASE WHEN raw < 0 THEN 0.25 * avg(raw) OVER (PARTITION BY source)
              ELSE raw END AS idf FROM dk),
            dq AS (SELECT *, 'src' || (query_id % 20) AS source FROM qterms)""",
            ranked(
                "run",
                """SELECT query_id, doc_id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)))
                AS score FROM dq JOIN dp USING (source, term) JOIN di USING (source, term)
                JOIN dlen USING (source, doc_id) JOIN ds USING (source) GROUP BY query_id, doc_id HAVING score > 0""",
                10,
            ),
        ),
        "search_every_model": _sql(
            """SELECT c.query_id AS query_id, c.corrected AS corrected_query,
              CASE WHEN pf THEN coalesce(prf_query, c.corrected) END AS expanded_query,
              coalesce(offers, '') AS suggestions, name AS model_used,
              r.rank, r.doc_id, round(r.score, 4) AS score, documents.text AS snippet
            FROM c JOIN wish USING (query_id) LEFT JOIN prf USING (query_id) LEFT JOIN sug USING (query_id)
            LEFT JOIN chosen r ON r.query_id = c.query_id LEFT JOIN documents ON documents.doc_id = r.doc_id""",
            *refined,
            HISTORY,
            r"""sug AS (SELECT query_id, string_agg(suggestion, '|' ORDER BY place) AS offers FROM (
              SELECT f.query_id, b.query AS suggestion, row_number() OVER (PARTITION BY f.query_id ORDER BY b.pos DESC) AS place
              FROM flags f JOIN history b ON b.user_id = f.query_id AND b.query <> f.text AND list_has_any(
                regexp_split_to_array(lower(f.text), '\s+'), regexp_split_to_array(lower(b.query), '\s+'))) WHERE place <= 5 GROUP BY 1)""",
            """wish AS (SELECT item_id AS query_id, CASE WHEN item_id % 2 = 0 THEN 5 ELSE 10 END AS k,
              ['bm25', 'tfidf', 'embedding', 'hybrid_serial', 'hybrid_parallel'][item_id % 5 + 1] AS name FROM benchmark)""",
            okapi_run("bm25", 100, "fterms"), TFIDF, tfidf_run("tfidf", 20, "fterms"), QVECTORS, dense_run("dense", 20),
            rescored("hs"), rrf("hp", ["bm25", "tfidf", "dense"], 5, 10), linear("hl", ["bm25", "tfidf", "dense"], 10, 20),
            "chosen AS (" + " UNION ALL ".join(
                f"SELECT run.* FROM (SELECT query_id, doc_id, score, rank FROM {run}) run JOIN wish USING (query_id) WHERE name = '{name}' AND rank <= k AND {when}"
                for name, run, when in [
                    ("bm25", "bm25", "true"), ("tfidf", "tfidf", "true"), ("embedding", "dense", "true"), ("hybrid_serial", "hs", "true"),
                    ("hybrid_parallel", "hp", "k = 5"), ("hybrid_parallel", "hl", "k = 10"),
                ]
            ) + ")",
        ),
        "search_pipeline": _sql(
            """SELECT c.query_id AS query_id, c.text AS query, c.corrected AS corrected_query,
              CASE WHEN pf THEN coalesce(prf_query, c.corrected) END AS expanded_query,
              CASE WHEN c.query_id % 3 = 1 THEN 'tfidf' ELSE 'bm25' END AS model_used,
              r.rank, r.doc_id, round(r.score, 4) AS score, documents.text AS snippet,
              count(r.doc_id) OVER (PARTITION BY c.query_id) AS total_results
            FROM c LEFT JOIN prf USING (query_id) LEFT JOIN chosen r ON r.query_id = c.query_id
            LEFT JOIN documents ON documents.doc_id = r.doc_id""",
            *refined,
            okapi_run("bm25", 10, "fterms"),
            TFIDF,
            tfidf_run("tfidf", 10, "fterms"),
            """chosen AS (SELECT * FROM (SELECT *, query_id % 3 = 1 AS other FROM bm25 WHERE query_id % 3 <> 1
              UNION ALL SELECT *, true FROM tfidf WHERE query_id % 3 = 1)
              WHERE rank <= CASE WHEN query_id % 2 = 0 THEN 5 ELSE 10 END)""",
        ),
        # fusion and output
        "fusion_rrf": _sql(
            _plain("f", lexical), LEXICAL_RUNS, rrf("f", ["bm25", "tfidf"])
        ),
        "fusion_linear": _sql(
            _plain("f", lexical), LEXICAL_RUNS, linear("f", ["bm25", "tfidf"])
        ),
        "run_max_normalize": _sql(
            """SELECT model, query_id, doc_id, round(score / max(score) OVER
            (PARTITION BY model, query_id), 6) AS score FROM runs""",
            LEXICAL_RUNS,
        ),
        "run_ranked": """SELECT source AS query_id, doc_id::VARCHAR AS doc_id, n_chars::DOUBLE AS score,
            row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, documents.doc_id) AS rank
            FROM documents""",
        "runs_merged": _sql("SELECT model, query_id, doc_id, score, rank FROM runs", LEXICAL_RUNS),
        "results_with_text": _sql(
            """SELECT query_id, doc_id, rank, text AS snippet
            FROM dense LEFT JOIN documents USING (doc_id)""",
            QVECTORS,
            dense_run("dense", 10),
        ),
        "search_response": _sql(
            """SELECT item_id AS query_id, b.text AS query, 'bm25' AS model_used, r.rank, r.doc_id,
              round(r.score, 4) AS score, documents.text AS snippet,
              count(r.doc_id) OVER (PARTITION BY item_id) AS total_results
            FROM benchmark b LEFT JOIN bm25 r ON item_id = query_id
            LEFT JOIN documents ON documents.doc_id = r.doc_id""",
            BASE,
            okapi_run("bm25", 10),
        ),
        # refinement
        "query_analyze": _sql(
            "SELECT query_id, array_to_string(tokens, ' ') AS tokens FROM q", QUERIES
        ),
        "spell_correct": _sql("SELECT query_id, corrected FROM corrected", SPELLING),
        "synonym_expand": _sql(
            "SELECT query_id, expanded_tokens FROM expanded", BASE, synonyms(), TOKS, EXPANDED
        ),
        "prf_expand": _sql(
            """SELECT query_id, coalesce(prf_query, text) AS prf_query
            FROM q LEFT JOIN prf USING (query_id)""",
            BASE,
            okapi_run("bm25", 5),
            FEEDBACK,
            prf("bm25", "q", "text"),
        ),
        "query_suggest": _sql(
            r"""SELECT query_id, suggestion_rank, suggestion FROM (
              SELECT a.user_id || '-' || a.pos AS query_id, b.query AS suggestion,
                row_number() OVER (PARTITION BY a.user_id, a.pos ORDER BY b.pos DESC) AS suggestion_rank
              FROM history a JOIN history b ON a.user_id = b.user_id AND a.query <> b.query
              AND list_has_any(regexp_split_to_array(lower(a.query), '\s+'),
                regexp_split_to_array(lower(b.query), '\s+'))) WHERE suggestion_rank <= 5""",
            HISTORY,
        ),
        "query_refine": _sql(
            """SELECT query_id, c.text AS text, c.corrected, array_to_string(c.tokens, ' ') AS tokens,
              expanded_tokens, prf_query
            FROM c JOIN prf USING (query_id) JOIN expanded USING (query_id)""",
            INDEX,
            SPELLING,
            tokens("c", "(SELECT item_id AS query_id, text, corrected.corrected FROM benchmark"
                        " JOIN corrected ON item_id = query_id)",
                   "query_id, text, corrected", "corrected"),
            """cterms AS (SELECT query_id, term, count(*) AS qtf
              FROM (SELECT query_id, unnest(tokens) AS term FROM c) GROUP BY ALL)""",
            okapi_run("bm25", 5, "cterms"),
            FEEDBACK,
            prf("bm25", "c", "corrected"),
            tokens("q", "prf", "query_id", "prf_query"),
            synonyms(),
            TOKS,
            EXPANDED,
        ),
        "history_append": """SELECT user_id, min(pos) AS pos, query FROM (
              SELECT conv_id AS user_id, turn AS pos, text AS query FROM conversations WHERE role = 'user'
              UNION ALL SELECT conv_id, turn + coalesce(1 + (SELECT max(turn) FROM conversations u
                WHERE u.conv_id = c.conv_id AND role = 'user'), 0), text FROM conversations c)
            GROUP BY user_id, query""",
        # evaluation
        "eval_precision": eval_sql("precision"),
        "eval_recall": eval_sql("recall"),
        "eval_ap": eval_sql("ap"),
        "eval_ndcg": eval_sql("ndcg"),
        "eval_models": _sql(
            """SELECT model AS "Model", round(avg(coalesce(ap, 0)), 6) AS "MAP",
              round(avg(coalesce(recall, 0)), 6) AS "Recall@10",
              round(avg(coalesce(precision, 0)), 6) AS "P@10",
              round(avg(coalesce(ndcg, 0)), 6) AS "nDCG@10"
            FROM (SELECT model, query_id FROM (SELECT DISTINCT model FROM runs), nrel)
            LEFT JOIN per_query USING (model, query_id) GROUP BY 1""",
            ALL_RUNS,
            POOLED,
            METRICS,
        ),
        "eval_single_list": """WITH r AS (SELECT 'shortest' AS model, doc_id, row_number() OVER
                (ORDER BY n_chars, doc_id) AS rank FROM documents
              UNION ALL SELECT 'longest', doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id)
                FROM documents),
            rel AS (SELECT doc_id FROM labels WHERE quality > 0),
            h AS (SELECT model, rank, row_number() OVER (PARTITION BY model ORDER BY rank) AS nth
              FROM r SEMI JOIN rel USING (doc_id))
            SELECT model, round(sum(nth / rank) / (SELECT count(*) FROM rel), 6) AS "MAP",
              count(CASE WHEN rank <= 10 THEN 1 END) / 10 AS "P@10",
              round(count(CASE WHEN rank <= 10 THEN 1 END) / (SELECT count(*) FROM rel), 6) AS "Recall",
              round(sum(CASE WHEN rank <= 10 THEN 1 / log2(rank + 1) ELSE 0 END) / (SELECT
                sum(1 / log2(i + 1)) FROM (SELECT unnest(range(1, 11)) AS i)
                WHERE i <= (SELECT count(*) FROM rel)), 6) AS "nDCG@10"
            FROM h GROUP BY 1""",
        # streaming
        "stream_preprocess": _sql(
            "SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM d", DOCS
        ),
        "stream_resume": _sql(
            "SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM d", DOCS
        ),
        "stream_index": _sql("SELECT doc_id, term, tf FROM posts", INDEX),
        "stream_vocab_size": _sql(
            """SELECT source AS dataset, count(DISTINCT term) AS terms, true AS near
            FROM posts JOIN documents USING (doc_id) GROUP BY 1""",
            INDEX,
        ),
        "stream_index_every_id": _sql(
            """SELECT dataset, doc_id, term, count(*) AS tf FROM (SELECT dataset, doc_id, unnest(tokens) AS term
            FROM (SELECT dataset, doc_id, arg_max(tokens, place) AS tokens FROM e WHERE len(tokens) > 0
              GROUP BY dataset, doc_id)) GROUP BY ALL""",
            tokens("e", "(SELECT source AS dataset, doc_id, 1 AS place, text FROM documents"
                        " UNION ALL SELECT 'second', doc_id, 1, text FROM documents"
                        " UNION ALL SELECT source, doc_id, 0, 'superseded' FROM documents"
                        " UNION ALL SELECT source, doc_id, 2, '' FROM documents)",
                   "dataset, doc_id, place", "text"),
        ),
        "stream_search": _sql(_plain("bm25", lexical), BASE, okapi_run("bm25", 10)),
    }
