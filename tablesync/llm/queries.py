"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.llm import license_scan
from tablesync.llm.bpe_codec import decode_ids, encode_texts
from tablesync.llm.conversation_trie import prefix_trie
from tablesync.llm.decontaminate import find_benchmark
from tablesync.llm.frames import table
from tablesync.llm.hard_negatives import hard_negatives
from tablesync.llm.jaccard_join import jaccard_components
from tablesync.llm.license_scan import scan_licenses
from tablesync.llm.line_dedup import dedup_lines
from tablesync.llm.mix import free_names, mix, source_rates
from tablesync.llm.substring_dedup import remove_repeats
from tablesync.llm.surrogates import replace_entities
from tablesync.llm.token_count import count_tokens
from tablesync.llm.toxicity import fit_network, held_out, score_toxicity
from tablesync.llm.vector_dedup import near_vectors


def op1_license_scan(spark, sf):
    return scan_licenses(table(spark, sf, "documents")).select(
        "row.doc_id", "n_sentences",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op2_jaccard_join(spark, sf):
    found = jaccard_components(table(spark, sf, "documents"), ngram=3, threshold=(90, 100))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n_grams").alias("n_shingles"), F.col("component").alias("component_id")
    )


def op3_token_count(spark, sf):
    return count_tokens(table(spark, sf, "documents")).select(
        "row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit")
    )


def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    network = fit_network(docs, table(spark, sf, "labels"))
    return score_toxicity(docs, network).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_substring_dedup(spark, sf):
    return remove_repeats(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept_text"), 256).alias("kept_sha256"),
    )


def op6_vector_dedup(spark, sf):
    return near_vectors(table(spark, sf, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept", "audited_recall"
    )


def op7_line_dedup(spark, sf):
    return dedup_lines(table(spark, sf, "documents")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )


def op8_surrogates(spark, sf):
    return replace_entities(table(spark, sf, "documents")).select(
        "row.doc_id", F.col("safe_text").alias("text"), "n_entities", "kinds"
    )


def op9_source_mix(spark, sf):
    docs = table(spark, sf, "documents")
    copy, key = free_names(docs.columns, "copy", "mix_key")
    return mix(docs, source_rates(docs)).select("row.*", F.col("copy").alias(copy), F.col("mix_key").alias(key))


def op10_decontaminate(spark, sf):
    found = find_benchmark(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_bpe_codec(spark, sf):
    encoded = encode_texts(table(spark, sf, "documents"))
    decoded = decode_ids(encoded.select(F.col("row.doc_id").alias("doc_id"), "ids"))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark, sf):
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(vectors.withColumn("label", moved), is_anchor=F.col("vec_id") % 100 == 0)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), "positive_score", "negative_score",
    )


def op13_prefix_trie(spark, sf):
    return prefix_trie(table(spark, sf, "conversations")).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def queries() -> dict:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_token_count": op3_token_count,
        "op4_toxicity": op4_toxicity,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_vector_dedup": op6_vector_dedup,
        "op7_line_dedup": op7_line_dedup,
        "op8_surrogates": op8_surrogates,
        "op9_source_mix": op9_source_mix,
        "op10_decontaminate": op10_decontaminate,
        "op11_bpe_codec": op11_bpe_codec,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_prefix_trie": op13_prefix_trie,
    }


_JACCARD = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p:p + 2], ' ')) END) AS gram FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    met AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b USING (gram)
        WHERE a.doc_id < b.doc_id GROUP BY ALL),
    link AS (
        SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * common >= 90 * (x.n + y.n - common)),
    edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (
        SELECT doc_id AS id, doc_id AS root FROM documents
        UNION SELECT edge.b, root FROM reach JOIN edge ON edge.a = reach.id WHERE root < edge.b)
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(root) AS component_id FROM reach GROUP BY id) ON id = w.doc_id"""

_REPEATS = r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d),
    later AS (
        SELECT doc_id, p FROM (
            SELECT doc_id, p, row_number() OVER (
                PARTITION BY array_to_string(w[p:p + 19], ' ') ORDER BY doc_id, p) AS nth FROM starts)
        WHERE nth > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM later),
    word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS text
        FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""

_LINES = r"""
    WITH line AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    keyed AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
    shared AS (
        SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
    marked AS (
        SELECT doc_id, pos, line, coalesce(doc_id > first, FALSE) AS dropped
        FROM keyed LEFT JOIN shared USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""

_BENCH = r"""
    WITH folded AS (
        SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        UNION ALL
        SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
    words AS (
        SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM folded),
    item AS (
        SELECT id AS item, least(len(w), 13) AS size, unnest(range(1, greatest(len(w) - 11, 2))) AS p, w
        FROM words WHERE kind = 'b' AND len(w) > 0),
    win AS (SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS run FROM item),
    place AS (
        SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM words, (SELECT DISTINCT size FROM win) WHERE kind = 'd'),
    found AS (
        SELECT id, p, win.size, item FROM place
        JOIN win ON win.size = place.size AND win.run = array_to_string(w[p:p + place.size - 1], ' ')),
    hit AS (SELECT id, count(DISTINCT q) AS n FROM (SELECT id, unnest(range(p, p + size)) AS q FROM found) GROUP BY id),
    items AS (
        SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM found) GROUP BY id)
    SELECT words.id AS doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256,
           coalesce(hit.n, 0) > 0 AND 20 * hit.n >= len(w) AS contaminated
    FROM words LEFT JOIN hit USING (id) LEFT JOIN items USING (id) WHERE kind = 'd'"""

_MIX = r"""
    WITH n AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY source),
    rates AS (
        SELECT source, pow(n_docs, 0.5) / (SELECT sum(pow(n_docs, 0.5)) FROM n)
               * (SELECT sum(n_docs) FROM n) / n_docs AS rate FROM n),
    sums AS (
        SELECT source, list_transform(range(1, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 2),
            lambda k: list_sum(list_transform(range(0, k), lambda j: exp(j * ln(rate) - rate - lgamma(j + 1))))) AS sums
        FROM rates),
    copies AS (
        SELECT d.*, len(list_filter(sums, lambda s: s <=
            CAST('0x' || md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':1')[1:13] AS BIGINT) / pow(16, 13))) AS n
        FROM documents d JOIN sums s ON d.source IS NOT DISTINCT FROM s.source)
    SELECT * EXCLUDE (n, copy), CAST(copy AS INTEGER) AS copy,
           md5('order17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS mix_key
    FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM copies)"""


_NEGATIVES = """
    WITH v AS (
        SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.id AS anchor, b.id, a.label = b.label AS same,
               CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
        FROM v a, v b WHERE a.id % 100 = 0 AND a.id <> b.id AND len(a.q) = len(b.q)),
    pos AS (
        SELECT * FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
    neg AS (
        SELECT p.anchor, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS rank
        FROM pos p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
         AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
    SELECT anchor AS anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM neg WHERE rank <= 5"""

_TRIE = """
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
            md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
        SELECT conv_id, conv_id - conv_id % 5 AS donor, xor(4294967295::UBIGINT, list_reduce(
            list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT),
            lambda crc, d: list_reduce(
                list_transform(range(8), lambda i: i::UBIGINT),
                lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, d)),
            4294967295::UBIGINT)) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM t)),
    turns AS (
        SELECT c.conv_id, 1 AS part, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos > h
        UNION ALL SELECT c.conv_id, 0, pos, role, text FROM c JOIN t ON t.conv_id = donor WHERE pos <= h),
    seqs AS (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, pos) FILTER (part IS NOT NULL) AS seq
        FROM c LEFT JOIN turns USING (conv_id) GROUP BY conv_id),
    member AS (SELECT conv_id, coalesce(len(seq), 0) AS n, seq, unnest(range(0, coalesce(len(seq), 0) + 1)) AS depth FROM seqs),
    node AS (
        SELECT depth, coalesce(seq[:depth], []) AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
        FROM member GROUP BY ALL),
    family AS (
        SELECT p.depth, p.path, count(*) AS n_children FROM node p
        JOIN node k ON k.depth = p.depth + 1 AND coalesce(k.path[:k.depth - 1], []) = p.path GROUP BY ALL),
    full_node AS (
        SELECT node.*, coalesce(n_children, 0) AS n_children,
               (n_convs - 1) * CASE WHEN depth > 0 THEN strlen(path[depth].text) ELSE 0 END AS saved
        FROM node LEFT JOIN family USING (depth, path)),
    above AS (SELECT saved, n_children, path, unnest(range(0, depth + 1)) AS depth FROM full_node),
    below AS (
        SELECT depth, coalesce(path[:depth], []) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
        FROM above GROUP BY ALL)
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
    FROM full_node f JOIN below USING (depth, path)
    LEFT JOIN node p ON p.depth = f.depth - 1 AND p.path = coalesce(f.path[:f.depth - 1], [])"""


def oracle_sql() -> dict:
    return {
        "op1_license_scan": license_scan.oracle_sql(),
        "op2_jaccard_join": _JACCARD,
        "op5_substring_dedup": _REPEATS,
        "op7_line_dedup": _LINES,
        "op9_source_mix": _MIX,
        "op10_decontaminate": _BENCH,
        "op12_hard_negatives": _NEGATIVES,
        "op13_prefix_trie": _TRIE,
    }
