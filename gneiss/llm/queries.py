"""Thin queries over the shared tables, one for each operator of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gneiss.llm import ann, decontamination, hard_negatives, langid, packing, prefix_trie, quality, rules, sentencepiece_sa, simhash, token_counts, tokenstore, warc
from gneiss.llm.common import shared_dir, table


def op1_sentencepiece(spark, sf_dir):
    found = sentencepiece_sa.encode_texts(table(spark, sf_dir, "documents"), with_ids=False)
    return found.drop("ids")


def op2_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"))


def op7_token_files(spark, sf_dir):
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = tokenstore.write_tokens(table(spark, sf_dir, "documents"), folder)
    found = tokenstore.read_tokens(manifest, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_warc(spark, sf_dir):
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.archive_pages(table(spark, sf_dir, "pages"), folder)
    return warc.archived_pages(spark, folder)


def op9_language_id(spark, sf_dir):
    return langid.detect(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_decontamination(spark, sf_dir):
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), heads=True)


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_quality_classifier, op3_token_counts, op4_nearest_neighbours, op5_simhash_dedup, op6_quality_rules, op7_token_files,
        op8_warc, op9_language_id, op10_packing, op11_decontamination, op12_conversation_trie, op13_hard_negatives,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        c AS (SELECT payload_digest, min(page_id) AS winner FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN winner IS NULL OR page_id IS NOT DISTINCT FROM winner THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM winner THEN winner END AS refers_to
        FROM p LEFT JOIN c USING (payload_digest)
    """,
    "op11_decontamination": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        cuts AS (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
        known AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS part FROM cuts),
        places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM known) WHERE len(w) >= size),
        parts AS (SELECT r, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS part FROM places),
        hits AS (SELECT r, i, size, item_id FROM parts JOIN known USING (size, part)),
        words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
        items AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
               sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
    # DuckDB has no crc32: its table-free form, a step for each byte and bit.
    "op12_conversation_trie": """
        WITH RECURSIVE t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
        own AS (
            SELECT c, list({'key': sha256(concat(strlen(role), ':', role, text)), 'bytes': strlen(text)} ORDER BY turn NULLS FIRST, role, text) AS s
            FROM t GROUP BY c),
        steps AS (
            SELECT c, CAST(c AS VARCHAR) AS digits, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM own
            UNION ALL
            SELECT c, digits, i + 1, CASE WHEN i % 9 = 0 THEN xor(v, ascii(substr(digits, i // 9 + 1, 1)))
                                          WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END
            FROM steps WHERE i < 9 * length(digits)),
        crc AS (SELECT c, CAST(xor(v, 4294967295) % 9 AS INTEGER) AS h FROM steps WHERE i = 9 * length(digits)),
        rebuilt AS (
            SELECT own.c, list_concat(list_slice(coalesce(b.s, []), 1, h), list_slice(own.s, h + 1, len(own.s))) AS s
            FROM own JOIN crc USING (c) LEFT JOIN own AS b ON b.c = own.c - own.c % 5),
        prefixes AS (SELECT c, len(s) AS n, d, s[d].bytes AS bytes, list_slice(s, 1, d) AS path FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
        placed AS (SELECT c, n, d, bytes, min(c) OVER (PARTITION BY d, path) AS node FROM prefixes),
        nodes AS (
            SELECT node, d, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * min(bytes) END AS saved,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
            FROM placed GROUP BY node, d),
        parents AS (SELECT nodes.node, nodes.d, placed.node AS parent FROM nodes JOIN placed ON placed.c = nodes.node AND placed.d = nodes.d - 1),
        kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM parents GROUP BY parent, d - 1),
        own_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node, d)),
        sums AS (
            SELECT p.node, p.d, sum(o.saved) AS saved_tokens, count(*) FILTER (o.n_children = 0) AS n_leaves
            FROM own_nodes AS o JOIN placed AS p ON p.c = o.node AND p.d <= o.d GROUP BY p.node, p.d)
        SELECT node AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
        FROM own_nodes JOIN sums USING (node, d) LEFT JOIN parents USING (node, d)
    """,
    "op13_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM e AS a JOIN e AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (
            SELECT p.anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
            FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
}
