"""One query per operator over the synthetic tables, and SQL for those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, language, licenses, main_text, merkle, mixing, packing, parity_join, perplexity, planes, runs, secret_scan, severity
from larder.llm.shared import fresh, lean

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    lean(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(_table(spark, folder, "documents"))


def op2_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.judge(_table(spark, folder, "documents"))


def op3_plane_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return planes.report(_table(spark, folder, "documents"), fresh(spark, "token-planes"), TOKENIZER)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return severity.report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_parity_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.classes(_table(spark, folder, "documents"))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.report(_table(spark, folder, "documents"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.report(_table(spark, folder, "documents"))


def op9_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(_table(spark, folder, "documents"))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.report(_table(spark, folder, "pages"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.report(_table(spark, folder, "documents"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.report(_table(spark, folder, "documents"))


def op13_square_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.report(_table(spark, folder, "documents"), BYTE_TOKENIZER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_perplexity, op3_plane_shuffle, op4_toxicity, op5_parity_join,
        op6_license_scan, op7_decontaminate, op8_language_id, op9_pivotal_mix, op10_main_text,
        op11_merkle_manifest, op12_periodic_runs, op13_square_packing,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op5_parity_join": rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM worded WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * m >= 75 * (x.n + y.n - m)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
""",
    "op7_decontaminate": rf"""
WITH doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM item_words WHERE len(w) > 0)
), found AS (
    SELECT doc_id, p, i.n, item_id
    FROM (
        SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM doc_words, (SELECT DISTINCT n FROM item_windows)
        WHERE len(w) >= n
    ) d JOIN item_windows i ON i.n = d.n AND i.s = array_to_string(d.w[d.p : d.p + d.n - 1], ' ')
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS k FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE fields AS (
    SELECT row_number() OVER () AS r, *, coalesce('=' || lang, '') AS tree, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
    ) AS crc
    FROM documents
), leaves AS (
    SELECT r, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
            ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claim
    FROM (
        SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
        FROM fields
    )
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, nth AS i, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM placed
    UNION ALL
    SELECT tree, level + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 7) // 8) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 8
), subroots AS (
    SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS t FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, t AS i, subroot AS d, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 7) // 8) FROM tops WHERE n > 1 GROUP BY level, i // 8
), steps AS (
    SELECT p.r, x.level AS step, x.i, x.d, p.nth // (8 ** x.level)::BIGINT = x.i AS own
    FROM placed p JOIN nodes x ON x.tree = p.tree AND x.n > 1 AND x.i // 8 = p.nth // (8 ** (x.level + 1))::BIGINT
    UNION ALL
    SELECT p.r, 100 + x.level, x.i, x.d, s.t // (8 ** x.level)::BIGINT = x.i
    FROM placed p JOIN subroots s USING (tree) JOIN tops x ON x.n > 1 AND x.i // 8 = s.t // (8 ** (x.level + 1))::BIGINT
), ordered AS (
    SELECT *, dense_rank() OVER (PARTITION BY r ORDER BY step) AS k FROM steps
), folded AS (
    SELECT r, 0::BIGINT AS k, claim AS d FROM placed
    UNION ALL
    SELECT f.r, any_value(f.k + 1), sha256(string_agg(CASE WHEN o.own THEN f.d ELSE o.d END, '' ORDER BY o.i))
    FROM folded f JOIN ordered o ON o.r = f.r AND o.k = f.k + 1 GROUP BY f.r
), proofs AS (
    SELECT r, string_agg(d, '' ORDER BY step, i) FILTER (NOT own) AS others FROM steps GROUP BY r
)
SELECT p.doc_id, p.leaf, s.subroot, t.d AS root, sha256(coalesce(others, '')) AS proof_sha256, f.d AS folded_root, f.d = t.d AS verified
FROM placed p JOIN subroots s USING (tree) CROSS JOIN (SELECT d FROM tops WHERE n = 1) t
JOIN (SELECT r, arg_max(d, k) AS d FROM folded GROUP BY r) f USING (r) LEFT JOIN proofs USING (r)
""",
}
