"""The registered queries of this subpackage; each reads whole tables through its operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.llm import best_fit, blocked_search, covering_simhash, decontaminate, html_diff, jaccard_join, line_dedup, pii, prefix_trie, quality_em, quote_link, token_binary, toxicity_chain
from duelist.llm.common import documents, tokenizer_path
from duelist.sources.session import shared_dir


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/llm/tokens-{uuid.uuid4().hex}"
    token_binary.write(documents(spark, sf_dir), path, tokenizer_path())
    return token_binary.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return decontaminate.leaks(docs, documents(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_ids", "n_overlaps", "max_matches")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.drop_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return deduped.select("doc_id", "text", F.array_join("removed", ",").alias("removed_lines"))


OP3_SQL = """
WITH lines AS (
  SELECT doc_id, i - 1 AS pos, trim(a[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS l
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL))
), numbered AS (
  SELECT doc_id, pos, l, count(*) OVER d AS n, row_number() OVER o AS r, lead(l, 1) OVER o AS l2, lead(l, 2) OVER o AS l3,
         lead(pos, 1) OVER o AS pos2, lead(pos, 2) OVER o AS pos3, n_words, lead(n_words, 1) OVER o AS n_words2
  FROM (SELECT *, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS n_words FROM lines) WHERE l <> '' WINDOW d AS (PARTITION BY doc_id), o AS (PARTITION BY doc_id ORDER BY pos)
), windows AS (
  SELECT doc_id, pos, pos3 AS until, [l, l2, l3] AS k FROM numbered WHERE n >= 3 AND r <= n - 2
  UNION ALL SELECT doc_id, pos, pos2, [l, l2] FROM numbered WHERE n = 2 AND r = 1
  UNION ALL SELECT doc_id, pos, pos, [l] FROM numbered WHERE n = 1 OR n_words > 50
  UNION ALL SELECT doc_id, pos, pos2, [l, l2] FROM numbered WHERE n >= 3 AND r < n AND n_words + n_words2 > 50
), later AS (
  SELECT doc_id, unnest(range(pos, until + 1)) AS line
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS r FROM windows) WHERE r > 1
), cut AS (SELECT doc_id, list_sort(list(DISTINCT line)) AS gone FROM later GROUP BY doc_id)
SELECT doc_id,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(
         [string_split(text, chr(10))[i + 1] FOR i IN range(0, len(string_split(text, chr(10)))) IF NOT list_contains(gone, i)], chr(10))
       END AS text,
       coalesce(array_to_string(gone, ','), '') AS removed_lines
FROM documents LEFT JOIN cut USING (doc_id)
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    n = {kind: F.expr(f"cast(size(filter(pii, s -> s.kind = '{kind}')) AS bigint)") for kind, *_ in pii.KINDS}
    return found.select(
        "doc_id", *(n[kind].alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.digest(kinds=pii.BASE_KINDS), 256).alias("base_sha256"), pii.digest().alias("spans"),
        *(c.alias(f"n_{kind}") for kind, c in n.items() if kind not in pii.BASE_KINDS),
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(documents(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_deleted")


def op6_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_link.link(documents(spark, sf_dir, "conversations"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_em.score(documents(spark, sf_dir).select("doc_id", "text"))
    return scored.selectExpr(
        "doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
        "quality.n_repeat_words", "quality.base_failed", "quality.kept", "quality.p_good", "quality.votes",
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(documents(spark, sf_dir)).select(
        "doc_id", "class_id", "n_links", "n_copies", F.hex("class_key").alias("class_key"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic, with the probabilities of all categories."""
    docs = documents(spark, sf_dir)
    chain = toxicity_chain.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity_chain.flag(docs.select("doc_id", "text"), chain).select(
        "doc_id", "p_quality", "p_toxic", F.lit(True).alias("toxic"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(documents(spark, sf_dir), tokenizer_path(), with_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocked_search.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH doc_terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, * FROM documents)
), tf AS (SELECT row, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL
), sizes AS (SELECT row, count(*) AS n FROM doc_terms GROUP BY row
), corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, docs
), item_terms AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), scores AS (
  SELECT item_id, row, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM item_terms JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (row), corpus GROUP BY item_id, row, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covering_simhash.near_copies(documents(spark, sf_dir))
    return found.select("doc_id", F.expr("lower(lpad(hex(fp), 16, '0')) AS fingerprint"), "component_id", "near_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(documents(spark, sf_dir, "conversations")).drop("node")


OP13_SQL = r"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
                                                FOR ch IN string_split(CAST(conv_id AS VARCHAR), '')])),
                         lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM ordered)
), seq AS (
  SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.pos < c.h
  UNION ALL
  SELECT c.conv_id, o.pos - c.h + least(c.h, coalesce(b.n, 0)), o.role, o.text
  FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.pos >= c.h
  LEFT JOIN (SELECT conv_id, count(*) AS n FROM ordered GROUP BY conv_id) b ON b.conv_id = c.base
), paths AS (
  SELECT conv_id, pos + 1 AS depth, length(text) AS cp, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM seq
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs
), sizes AS (SELECT conv_id, max(depth) AS size FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(depth) AS depth, any_value(cp) AS cp, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256
  FROM paths JOIN sizes USING (conv_id) GROUP BY path
), named AS (SELECT p.conv_id AS member, n.depth, n.conv_id AS first FROM paths p JOIN nodes n USING (path)
), kids AS (
  SELECT n.conv_id, n.depth, count(k.path) AS n_children
  FROM nodes n LEFT JOIN (SELECT k.path, k.depth, m.first AS parent FROM nodes k JOIN named m ON m.member = k.conv_id AND m.depth = k.depth - 1) k
    ON k.parent = n.conv_id AND k.depth = n.depth + 1 GROUP BY n.conv_id, n.depth
), sums AS (
  SELECT m.first AS conv_id, m.depth, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves, CAST(sum((d.n_convs - 1) * d.cp) AS BIGINT) AS saved_tokens
  FROM nodes d JOIN kids k ON k.conv_id = d.conv_id AND k.depth = d.depth JOIN named m ON m.member = d.conv_id AND m.depth <= d.depth
  GROUP BY m.first, m.depth
)
SELECT n.conv_id, n.depth, m.first AS parent_conv_id, n.n_convs, k.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN kids k ON k.conv_id = n.conv_id AND k.depth = n.depth JOIN sums s ON s.conv_id = n.conv_id AND s.depth = n.depth
LEFT JOIN named m ON m.member = n.conv_id AND m.depth = n.depth - 1
"""


QUERIES = {
    "op1_token_binary": op1_token_binary,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_line_dedup": op3_line_dedup,
    "op4_pii": op4_pii,
    "op5_html_extraction": op5_html_extraction,
    "op6_quote_linking": op6_quote_linking,
    "op7_quality_rules": op7_quality_rules,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_covering_simhash": op12_covering_simhash,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = {"op3_line_dedup": OP3_SQL, "op11_ranked_search": OP11_SQL, "op13_prefix_trie": OP13_SQL}
