"""Registered queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import (
    decontamination,
    exact_dedup,
    fill_middle,
    langid,
    line_dedup,
    mixing,
    packing,
    prefix_trie,
    secret_scan,
    simhash,
    token_files,
    topk,
    toxicity,
)
from cohortlens.llm.common import remainder, ship, written
from cohortlens.llm.tokens import public_vocabulary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, max_bits=3)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), public_vocabulary(), end=0)
    return token_files.read(spark, manifest)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secret_scan.KINDS[:3]
    return rows.select(
        "doc_id",
        *[secret_scan.counted("spans", kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.listed("spans", base), 256).alias("base_sha256"),
        secret_scan.listed("spans", secret_scan.KINDS).alias("spans"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), public_vocabulary(), end=2))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.train(docs))
    held_out = (remainder("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held_out, F.col("language.language").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.ambiguous").alias("ambiguous"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=5, every=50)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return placed.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = written(fill_middle.store(table(spark, sf_dir, "documents").select("doc_id", "text")), "fill-middle-frames")
    return fill_middle.digests(stored)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_token_files": op3_token_files,
    "op4_secrets": op4_secrets,
    "op5_packing": op5_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_language": op7_language,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_topk": op9_topk,
    "op10_mixing": op10_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_fill_middle": op12_fill_middle,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}) | {
    "op9_topk": """
        WITH v AS (
          SELECT row_number() OVER () AS n, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x FROM embeddings
          WHERE len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
        ), s AS (
          SELECT q.n, q.vec_id AS query_id, c.vec_id, list_sum([a[1] * a[2] FOR a IN list_zip(q.x, c.x)])::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.n <> c.n
        ), r AS (
          SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INT AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op6_line_dedup": """
        WITH d AS (
          SELECT row_number() OVER () AS r, * FROM documents
        ), l AS (
          SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nth
          FROM d
        ), k AS (
          SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM l
        ), m AS (
          SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT r) >= 3
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
               count(*) FILTER (m.key IS NOT NULL AND doc_id IS DISTINCT FROM last) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (m.key IS NULL OR doc_id IS NOT DISTINCT FROM last), '')) AS kept_sha256
        FROM k LEFT JOIN m ON k.key = m.key GROUP BY r
    """,
    "op8_exact_dedup": """
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
          FROM documents
        ), g AS (
          SELECT *, first_value(doc_id) OVER w AS keep_id,
                 count(*) OVER (PARTITION BY text_sha256) AS group_size
          FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
        )
        SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, text_sha256 FROM g
    """,
    "op11_decontamination": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
          FROM documents
        ), b AS (
          SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
          FROM benchmark
        ), t AS (
          SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
          FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)
        ), o AS (
          SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
          FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)
        ), h AS (
          SELECT o.r, o.p, o.n, t.item FROM o JOIN t ON o.n = t.n AND o.k = t.k
        ), words AS (
          SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r
        ), items AS (
          SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
    "op12_fill_middle": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                 sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
          FROM documents
        ), n AS (
          SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                 ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
          FROM d
        ), c AS (
          SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
          FROM n
        ), p AS (
          SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p
    """,
    "op13_prefix_trie": r"""
        WITH t AS (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p,
                 coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (  -- crc32 of the decimal id, bit by bit
          SELECT conv_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
                   flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(conv_id::VARCHAR, '')])),
                   lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 9 AS h
          FROM (SELECT DISTINCT conv_id FROM t)
        ), r AS (
          SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND p <= h
          UNION ALL
          SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h
        ), s AS (  -- prefixes of each conversation, by a chain of digests
          SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(sha256(strlen(role) || ':' || role || text), ',') OVER w) AS node,
                 strlen(text) AS size, count(*) OVER (PARTITION BY conv_id) AS turns
          FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING)
          UNION ALL
          SELECT conv_id, 0, '', 0, (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c
        ), n AS (
          SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
          FROM s GROUP BY node, depth
        ), e AS (  -- each node and the one above it
          SELECT DISTINCT a.node, b.node AS parent FROM s a JOIN s b ON a.conv_id = b.conv_id AND a.depth = b.depth + 1
        ), k AS (
          SELECT n.*, (SELECT count(*) FROM e WHERE e.parent = n.node) AS n_children FROM n
        ), u AS (  -- each node and all above it and itself
          SELECT DISTINCT a.node, b.node AS top FROM s a JOIN s b ON a.conv_id = b.conv_id AND a.depth >= b.depth
        ), g AS (
          SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
          FROM u JOIN k ON u.node = k.node GROUP BY top
        )
        SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, g.n_leaves, g.saved_tokens, k.ends_sha256
        FROM k JOIN g ON g.top = k.node LEFT JOIN e ON e.node = k.node LEFT JOIN n p ON p.node = e.parent
    """,
}
