"""Queries over the driver's tables, one for each text operator and one for the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fim, jaccard, langid, lines, packing, pages, quality, secrets, surrogates, tokens, topk, trie
from .common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.prefix_token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    freed = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short_lines=True)
    return freed.select("doc_id", "text", "n_lines", "n_dropped", "emptied")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.shared_starts(trie.ordered_turns(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(turns, convs)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = langid.identify(docs, langid.fit(docs.where(langid.learnable(F.col("doc_id")))))
    return judged.select("doc_id", (~langid.learnable(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_prefix_token_counts": op2_prefix_token_counts,
    "op3_pattern_packing": op3_pattern_packing,
    "op4_decontamination": op4_decontamination,
    "op5_surrogates": op5_surrogates,
    "op6_line_dedup": op6_line_dedup,
    "op7_main_text": op7_main_text,
    "op8_secret_scan": op8_secret_scan,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_top_k": op10_top_k,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_language": op13_language,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

#: CRC-32 of a decimal number ``s``, bit by bit.
_BYTE = "CASE WHEN i % 8 = 0 THEN CAST(unicode(substr(s, i // 8 + 1, 1)) AS BIGINT) ELSE 0 END"
_CRC32 = f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(0, 8 * length(s))), lambda a, i:
    CASE WHEN xor(a, {_BYTE}) % 2 = 1 THEN xor(3988292384, xor(a, {_BYTE}) // 2) ELSE xor(a, {_BYTE}) // 2 END))"""
_DRAW = "CAST('0x' || substr(sha256('1:' || doc_id), {}, 8) AS BIGINT)"

#: DuckDB SQL where SQL can express the operator: over doc_id, vec_id and (conv_id, turn) as keys.
ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": f"""
        WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
        windows AS (
            SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
            FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
                  FROM b WHERE len(w) > 0)),
        places AS (
            SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM d JOIN (SELECT DISTINCT k FROM windows) ON len(w) >= k)),
        found AS (SELECT DISTINCT doc_id, i, k, item_id FROM places JOIN windows USING (k, win)),
        hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op9_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                   FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
                  WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
        reach AS (SELECT doc_id, doc_id AS other FROM d
                  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
        SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id""",
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20""",
    "op11_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t),
        v AS (SELECT c, h, least(h, (SELECT count(*) FROM t m WHERE m.c = ids.c - ids.c % 20)) AS kept
              FROM ids JOIN (SELECT c AS c2, {_CRC32} % 4 AS h FROM ids) ON c2 = c),
        turns AS (SELECT v.c, p AS d, role, text FROM v JOIN t ON t.c = v.c - v.c % 20 AND p <= h
                  UNION ALL SELECT v.c, p - h + kept, role, text FROM v JOIN t ON t.c = v.c AND p > h),
        paths AS (
            SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
                   string_agg(sha256(length(role) || ':' || role || text), '' ORDER BY d) OVER (PARTITION BY c ORDER BY d) AS node FROM turns
            UNION ALL SELECT c, 0, 0, '' FROM v),
        tops AS (SELECT *, max(d) OVER (PARTITION BY c) AS last FROM paths),
        nodes AS (SELECT node, any_value(d) AS d, any_value(w) AS w, min(c) AS c, count(*) AS n,
                         string_agg(c, ',' ORDER BY c) FILTER (d = last) AS ends FROM tops GROUP BY node),
        linked AS (SELECT x.*, up.c AS parent_c,
                          (SELECT count(*) FROM nodes k WHERE k.d = x.d + 1 AND left(k.node, length(x.node)) = x.node) AS children
                   FROM nodes x LEFT JOIN nodes up ON x.d > 0 AND up.node = left(x.node, length(x.node) - 64)),
        below AS (SELECT p.node, count(*) FILTER (x.children = 0) AS leaves, sum((x.n - 1) * x.w) AS saved
                  FROM linked x JOIN paths p ON p.c = x.c AND p.d <= x.d GROUP BY p.node)
        SELECT c AS conv_id, CAST(d AS BIGINT) AS depth, parent_c AS parent_conv_id, n AS n_convs, children AS n_children, leaves AS n_leaves,
               CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
        FROM linked JOIN below USING (node)""",
    "op12_fill_in_middle": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
        h AS (SELECT *, {_DRAW.format(1)} % (n + 1) AS x, {_DRAW.format(9)} % (n + 1) AS y,
                     n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_DRAW.format(17)} % 100 >= 90 AS plain,
                     {_DRAW.format(25)} % 100 < 20 AS spm FROM d),
        cut AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b FROM h),
        part AS (SELECT *, left(t, CAST(a AS BIGINT)) AS prefix, substr(t, CAST(a + 1 AS BIGINT), CAST(b - a AS BIGINT)) AS middle,
                        substr(t, CAST(b + 1 AS BIGINT)) AS suffix FROM cut)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                           ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM part""",
}
