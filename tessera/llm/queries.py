"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (conversation_trie, embed_dedup, langid, mixing, near_dup, packing, quality_rules, quality_trees,
                         secrets, sharding, token_counts, toxicity, vector_codes)
from tessera.llm.common import documents, id_crc_mod

Query = Callable[[SparkSession, str], DataFrame]


def op1_subword_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    held = id_crc_mod("doc_id", 3) == 1
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.learn(docs.filter(~held), labels.filter(~held))
    return toxicity.scored(docs.withColumn("held_out", held), model).select("doc_id", "held_out", "score", "predicted")


def op2_flow_resharding(spark: SparkSession, sf: str) -> DataFrame:
    placed, _ = sharding.reshard(documents(spark, sf), new_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op3_rule_ledger(spark: SparkSession, sf: str) -> DataFrame:
    entries = quality_rules.ledger(documents(spark, sf))
    policies = quality_rules.POLICIES
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          (~quality_rules.passes(policies["base"])).alias("base_failed"),
                          quality_rules.passes(policies["web"]).alias("kept"), "n_lines", "failed_bits")


def op4_pattern_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), "byte_bpe_50k.json", end_id=2, capacity=1024)


def op5_ppm_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    held = id_crc_mod("doc_id", 5) == 0
    model = langid.train(docs.filter(~held))
    return langid.identify(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


def op6_subspace_pigeonhole(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    return embed_dedup.near_duplicates(table, least=0.9)


def op7_curriculum_mix(spark: SparkSession, sf: str) -> DataFrame:
    order = mixing.scheduled(documents(spark, sf))
    return order.filter("copy IS NULL OR copy = 0").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", F.col("position").alias("first_position"), "last_position")


def op8_chosen_path_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf), words=4, percent=80)


def op9_randomness_battery(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf))


def op10_sentencepiece_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf), "piece_bpe_32k.model")


def op11_ternary_trie(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_trie.conversation_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


def op12_boosted_quality(spark: SparkSession, sf: str) -> DataFrame:
    held = id_crc_mod("doc_id", 3) == 1
    docs = documents(spark, sf).select("doc_id", "text", held.alias("held_out"), (~held).alias("learn"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return quality_trees.classify(docs, labels.filter(~held), learn_from="learn").drop("learn")


def op13_gnat_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_subword_toxicity": op1_subword_toxicity,
    "op2_flow_resharding": op2_flow_resharding,
    "op3_rule_ledger": op3_rule_ledger,
    "op4_pattern_packing": op4_pattern_packing,
    "op5_ppm_language": op5_ppm_language,
    "op6_subspace_pigeonhole": op6_subspace_pigeonhole,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op8_chosen_path_join": op8_chosen_path_join,
    "op9_randomness_battery": op9_randomness_battery,
    "op10_sentencepiece_counts": op10_sentencepiece_counts,
    "op11_ternary_trie": op11_ternary_trie,
    "op12_boosted_quality": op12_boosted_quality,
    "op13_gnat_codes": op13_gnat_codes,
}


def _codes_sql(parts: int = 8, size: int = 16, rounds: int = 6) -> str:
    """Every part against every entry, each round a pair of tables."""
    sql = f"""
        WITH v AS (SELECT vec_id, label, row_number() OVER () AS r, len(embedding) // {parts} AS w,
                          list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT r, part, q[part * w + 1:part * w + w] AS x FROM v, (SELECT unnest(range({parts})) AS part)),
        b AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {size}),
        c0 AS (SELECT part, entry, x AS c FROM p JOIN b USING (r))"""
    for k in range(rounds + 1):
        sql += f""",
        a{k} AS (SELECT r, part, min({size} * list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
                        + entry)::BIGINT AS best FROM p JOIN c{k} USING (part) GROUP BY r, part)"""
        if k < rounds:
            sql += f""",
        s{k} AS (SELECT part, entry, place, sum(y)::BIGINT AS s, count(*) AS n FROM (
                     SELECT part, best % {size} AS entry, unnest(x) AS y, unnest(range(len(x))) AS place
                     FROM a{k} JOIN p USING (r, part)) GROUP BY ALL),
        c{k + 1} AS (SELECT part, entry, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
                     SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY place) AS m FROM s{k} GROUP BY ALL)
                     USING (part, entry))"""
    return sql + f""",
        e AS (SELECT r, string_agg(printf('%02x', best % {size}), '' ORDER BY part) AS code, sum(best // {size})::BIGINT AS error
              FROM a{rounds} GROUP BY r),
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS sha FROM c{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
        FROM v JOIN e USING (r), h"""

_WORD = r"[^\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {
    # CRC-32 by its table; then every prefix of every conversation.
    "op11_ternary_trie": rf"""
        WITH k AS (SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))
                               ORDER BY i) AS t FROM (SELECT unnest(range(256))::BIGINT AS i)),
        o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
              FROM conversations WHERE conv_id IS NOT NULL),
        g AS (SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT) AS s
              FROM (SELECT DISTINCT conv_id FROM o)),
        c AS (SELECT conv_id, xor(list_reduce([4294967295] || s, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])),
                                  4294967295) % 4 AS h FROM g, k),
        m AS (SELECT c.conv_id, h, 0 AS own, pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND pos < h
              UNION ALL SELECT c.conv_id, h, 1, pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND pos >= h),
        q AS (SELECT conv_id, row_number() OVER w AS depth, text,
                     string_agg(md5(length(role) || ':' || role || text), '') OVER w AS path
              FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)),
        p AS (SELECT conv_id, depth, md5(path) AS node, len(regexp_extract_all(text, '{_WORD}')) AS words FROM q
              UNION ALL SELECT conv_id, 0, '', 0 FROM c),
        l AS (SELECT conv_id, max(depth) AS length FROM p GROUP BY conv_id),
        n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                     sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
              FROM p JOIN l USING (conv_id) GROUP BY node, depth),
        u AS (SELECT n.node, n.depth, a.node AS up FROM n JOIN p a ON a.conv_id = n.conv_id AND a.depth = n.depth - 1),
        k2 AS (SELECT up AS node, count(*) AS n_children FROM u GROUP BY up),
        f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k2 USING (node)),
        s AS (SELECT a.node, sum((f.n_children = 0)::BIGINT)::BIGINT AS n_leaves,
                     sum((f.n_convs - 1) * f.words)::BIGINT AS saved_tokens
              FROM f JOIN p a ON a.conv_id = f.conv_id AND a.depth <= f.depth GROUP BY a.node)
        SELECT f.conv_id, f.depth::BIGINT AS depth, n.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
               f.ends_sha256
        FROM f JOIN s USING (node) LEFT JOIN u USING (node) LEFT JOIN n ON n.node = u.up""",
    "op13_gnat_codes": _codes_sql(),
    "op3_rule_ledger": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
        w AS (SELECT r, unnest(regexp_extract_all(t, '{_WORD}')) AS word,
                     generate_subscripts(regexp_extract_all(t, '{_WORD}'), 1) AS p FROM d),
        tri AS (SELECT r, p, word AS a, lead(word) OVER q AS b, lead(word, 2) OVER q AS c
                FROM w WINDOW q AS (PARTITION BY r ORDER BY p)),
        rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n
                                  FROM tri WHERE c IS NOT NULL) WHERE n > 1),
        cov AS (SELECT r, count(DISTINCT p + k) AS n_repeat_words
                FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
        nw AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
        l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
        ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
               FROM l WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
        m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
                     (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                     coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                     coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
              FROM d LEFT JOIN nw USING (r) LEFT JOIN ln USING (r) LEFT JOIN cov USING (r))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words
                    OR word_chars < 2 * n_words) AS kept, n_lines,
               ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
                + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (word_chars < 2 * n_words)::BIGINT
                + 16 * (word_chars > 20 * n_words)::BIGINT + 32 * (10 * n_dup_lines > 3 * n_lines)::BIGINT) AS failed_bits
        FROM m""",
    "op7_curriculum_mix": rf"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size
                   FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
              FROM d GROUP BY source),
        w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][rk % 3 + 1] AS weight FROM s),
        c AS (SELECT *, (SELECT sum(source_size) FROM w) * 1.5::DOUBLE
                        - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rk
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pot,
                     sum(weight) OVER (ORDER BY source_size / weight, rk
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM w),
        f AS (SELECT pot / ws AS rate FROM c WHERE pot / ws * weight <= 2 * source_size
              ORDER BY source_size / weight, rk LIMIT 1),
        t AS (SELECT source, source_size, [-0.5::DOUBLE, 0.0, 0.5][rk % 3 + 1] AS slope,
                     coalesce(least((SELECT rate FROM f) * weight, 2.0::DOUBLE * source_size),
                              2.0::DOUBLE * source_size) AS target FROM w),
        p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
                     sum(d.size) OVER (PARTITION BY d.source ORDER BY
                         md5(coalesce(d.doc_id::VARCHAR, '') || ':' || d.size::VARCHAR), d.doc_id, d.size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM p),
        n AS (SELECT *, (CASE WHEN size > 0 THEN passes + CASE WHEN start + size / 2.0::DOUBLE < target - passes * source_size
                              AND passes < 2 THEN 1 ELSE 0 END ELSE 0 END)::INT AS copies FROM k),
        -- The share of its target that a copy starts after, and the inverse of (1 - r) t + r t^2.
        a AS (SELECT *, CASE WHEN copies > 0 THEN least(start / target, 1.0::DOUBLE) END AS first_done,
                     CASE WHEN copies > 0 THEN least((start + (copies - 1) * source_size) / target, 1.0::DOUBLE) END AS last_done
              FROM n)
        SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies,
               CASE WHEN slope = 0 OR first_done <= 0 THEN first_done ELSE (-(1 - slope) + sqrt(greatest((1 - slope) * (1 - slope)
                    + 4 * slope * first_done, 0.0::DOUBLE))) / (2 * slope) END AS first_position,
               CASE WHEN slope = 0 OR last_done <= 0 THEN last_done ELSE (-(1 - slope) + sqrt(greatest((1 - slope) * (1 - slope)
                    + 4 * slope * last_done, 0.0::DOUBLE))) / (2 * slope) END AS last_position
        FROM a""",
    # Brute force: every pair that shares a shingle, then reachability.
    "op8_chosen_path_join": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                     END AS shingles FROM d),
        e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS x FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n_a, b.n AS n_b, count(*) AS common
              FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (n_a + n_b - common)),
        u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id, doc_id AS root FROM s
              UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id WHERE r.root < u.b),
        c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
        SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
        FROM s JOIN c USING (doc_id)""",
    "op6_subspace_pigeonhole": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                                 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
                                THEN embedding::DOUBLE[] END AS x FROM embeddings),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
              WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
        u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT vec_id, vec_id AS root FROM v
              UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.vec_id WHERE r.root < u.b),
        c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
        n AS (SELECT a AS vec_id, count(*) AS n_links FROM u GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)""",
}
