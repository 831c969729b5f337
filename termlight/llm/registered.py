"""The queries of this subpackage over the given tables, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlight.llm import (
    alignment,
    doubling,
    exact_stream,
    language,
    licenses,
    merge_dropout,
    merkle,
    packing,
    prefix_bpe,
    quality,
    simhash,
    suffix_dedup,
    urls,
)
from termlight.llm.tables import read


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(read(spark, folder, "pages"))


def op3_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    """Encodes every text under a seed and decodes the ids again."""
    model = tokenizer("piece_bpe_32k.model")
    coded = merge_dropout.decode(merge_dropout.encode(read(spark, folder, "documents"), model), model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("lossless"),
    )


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the documents outside the held-out fold and judges all of them."""
    docs = read(spark, folder, "documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(read(spark, folder, "documents")))


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digests(read(spark, folder, "documents"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return doubling.digests(read(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_stream.dedup(read(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality.judged(quality.ledger(read(spark, folder, "documents")), "v1")
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.col("failed"),
    )


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encodes every text and decodes the ids again."""
    import public_tokenizers

    ranks = tokenizer("byte_bpe_50k.tiktoken")
    coded = prefix_bpe.encode(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return prefix_bpe.decode(coded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Aligns the tokens of two vocabularies in every text and scores their links by the whole corpus."""
    import public_tokenizers

    byte_model, piece_model = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    aligned = alignment.align(read(spark, folder, "documents"), byte_model, piece_model, public_tokenizers.PATTERN)
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256))
    aligned = aligned.withColumn("groups_sha256", digest).drop("groups")
    return alignment.weigh(aligned).select("doc_id", *alignment.NUMBERS, "n_best", "count_sum", "groups_sha256")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of the documents, verified with one in seven counts of characters tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claims = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = merkle.manifest(read(spark, folder, "documents"), columns, "lang", "doc_id", claims)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_url_filters": op2_url_filters,
    "op3_merge_dropout": op3_merge_dropout,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _license_values() -> str:
    rows = [(name, licenses.template_bigrams(text)) for name, text in licenses.TEMPLATES]
    quoted = [f"('{name}', [{', '.join(repr(g) for g in grams)}])" for name, grams in rows]
    return ", ".join(quoted)


def _field_sql(column: str, value: str | None = None) -> str:
    return f"coalesce(strlen({value or column}::VARCHAR) || ':' || {value or column}, '-')"


def _leaf_sql(n_chars: str) -> str:
    parts = [_field_sql(c) for c in ("doc_id", "source", "lang")]
    return " || ".join([*parts, _field_sql("n_chars", n_chars), _field_sql("text")])


SQL = {
    "op5_license_scan": rf"""
WITH templates(license, grams) AS (VALUES {_license_values()}
), texts AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), units AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS unit FROM texts
  UNION ALL
  SELECT doc_id, p FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '\n[ \t\r]*\n')) AS p FROM texts)
  WHERE contains(trim(p, ' ' || chr(9) || chr(13) || chr(10)), chr(10))
), numbered AS (
  SELECT row_number() OVER () AS u, doc_id, string_split(trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units
), grams AS (
  SELECT u, doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM numbered WHERE len(w) > 1
), scores AS (
  SELECT u, doc_id, license, 2.0 * len(list_intersect(g, grams.grams_)) / (len(g) + len(grams.grams_)) AS score
  FROM (SELECT u, doc_id, g, license, templates.grams AS grams_ FROM grams JOIN templates
    ON len(g) <= len(templates.grams) * 1.5 AND len(g) * 1.5 >= len(templates.grams)) AS grams
), best AS (
  SELECT u, doc_id, max(score) AS score, max_by(license, (score, license)) AS license FROM scores GROUP BY u, doc_id HAVING max(score) >= 0.8
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, '|' ORDER BY license) AS licenses, max(score) AS score FROM best GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses, round(coalesce(score, 0.0), 6) AS best_score
FROM texts LEFT JOIN found USING (doc_id)
""",
    "op7_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS v
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY v ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later
), kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words) a
  ANTI JOIN gone USING (doc_id, p) GROUP BY a.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""",
    "op8_exact_dedup": r"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') AS n FROM documents
), best AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY n) AS group_size FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM best
""",
    "op10_quality_rules": r"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^ \t-\r]') GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS v
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM words WHERE len(w) >= 5)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(after - i, 5))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM again) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), failing AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 30 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
  failed = 0 AS kept, failed FROM failing
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda v, i: CASE WHEN (v & 1) = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS t
), hits AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda v, b: xor(t[(xor(v, b) & 255) + 1], v >> 8)), 4294967295) % 7 = 0 AS hit
  FROM documents, crc
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('n_chars')} AS leaf_text,
    {_leaf_sql('(n_chars + hit::BIGINT)')} AS claim_text FROM hits
), placed AS (
  SELECT doc_id, tree, sha256(leaf_text) AS leaf, sha256(claim_text) AS claim,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY tree) AS total FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, place, total, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, (total + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM nodes WHERE total > 1 GROUP BY tree, level, place // 2, total
), forest AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total, node, tree FROM nodes WHERE total = 1
), tops AS (
  SELECT level, place, total, node FROM forest
  UNION ALL
  SELECT level + 1, place // 2, (total + 1) // 2, sha256(string_agg(node, '' ORDER BY place)) FROM tops WHERE total > 1
  GROUP BY level, place // 2, total
), steps AS (
  SELECT a.tree, a.level, a.place, CASE WHEN a.place % 2 = 1 THEN b.node ELSE '' END AS l,
    CASE WHEN a.place % 2 = 0 THEN coalesce(b.node, '') ELSE '' END AS r
  FROM nodes a LEFT JOIN nodes b ON b.tree = a.tree AND b.level = a.level AND b.place = xor(a.place, 1) WHERE a.total > 1
), top_steps AS (
  SELECT a.level, a.place, CASE WHEN a.place % 2 = 1 THEN b.node ELSE '' END AS l,
    CASE WHEN a.place % 2 = 0 THEN coalesce(b.node, '') ELSE '' END AS r
  FROM tops a LEFT JOIN tops b ON b.level = a.level AND b.place = xor(a.place, 1) WHERE a.total > 1
), climbed AS (
  SELECT doc_id, tree, leaf, 0 AS level, place, claim AS h, '' AS proof, total FROM placed
  UNION ALL
  SELECT doc_id, c.tree, leaf, c.level + 1, c.place // 2, sha256(l || h || r), proof || l || r, (total + 1) // 2
  FROM climbed c JOIN steps s ON s.tree = c.tree AND s.level = c.level AND s.place = c.place
), beyond AS (
  SELECT doc_id, leaf, f.node AS subroot, 0 AS level, f.place, h, proof, f.total FROM climbed c JOIN forest f ON f.tree = c.tree WHERE c.total = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, c.level + 1, c.place // 2, sha256(l || h || r), proof || l || r, (total + 1) // 2
  FROM beyond c JOIN top_steps s ON s.level = c.level AND s.place = c.place
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM beyond, (SELECT node AS root FROM tops WHERE total = 1) WHERE total = 1
""",
}
