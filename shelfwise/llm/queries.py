"""The operators over the whole given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import bpe, decontaminate, hilbert, jaccard, licenses, manifest, pii, quality, secrets, shards, substrings, toxicity, whiten
from shelfwise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


#: Words of a text: lower-cased A-Z, then runs of digits, letters and characters beyond ASCII.
_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op1_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
    tests AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n,
               array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS span
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ),
    lengths AS (SELECT DISTINCT n FROM tests),
    spans AS (
        SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS span
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
    ),
    hits AS (SELECT doc_id, i, s.n, item_id FROM spans s JOIN tests t ON s.span = t.span AND s.n = t.n),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
              FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.op1_decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op2_hilbert_neighbours",
    """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(e, lambda x: x <> 0)) > 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
          FROM ok q, ok c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert.op2_neighbours(table(spark, folder, "embeddings"))


@query("op3_license_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.op3_licenses(table(spark, folder, "documents"))


@query("op4_byte_bpe")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.op4_bpe(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


@query("op7_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return quality.op7_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.op8_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.op5_secrets(table(spark, folder, "documents"))


@query("op9_pii")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pii.op9_pii(table(spark, folder, "documents"))


@query(
    "op6_ngram_jaccard",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
    ),
    sets AS (SELECT doc_id, count(*) AS n, list_sort(list(g)) AS own FROM s GROUP BY doc_id),
    sized AS (SELECT doc_id, n, count(*) OVER (PARTITION BY own) AS copies FROM sets),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT x, y FROM common JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
    ),
    reached AS (SELECT x AS doc_id, y AS other FROM links UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x),
    least AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(other, w.doc_id)) AS component_id,
           coalesce(copies, 1) AS copies
    FROM w LEFT JOIN sized USING (doc_id) LEFT JOIN least USING (doc_id)
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.op6_jaccard(table(spark, folder, "documents"))


@query("op10_repeated_substrings")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.op10_repeats(table(spark, folder, "documents"))


#: The 256 steps of CRC-32, and the value for the bytes (numbers) of a list.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, b)) AS steps)"""


def _crc32(text: str) -> str:
    values = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce({values}, lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)"


#: Levels that the SQL writes out, in a tree and above: up to 8**7 rows of a language, and 64 languages.
_TREE_LEVELS, _TOP_LEVELS = 7, 2


def _levels_sql(name: str, first: str, levels: int) -> list[str]:
    """Nodes (tree, pos, n, node) of each level, and each node's siblings before and after it."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels + 1):
        if k:
            out.append(
                f"{name}{k} AS (SELECT tree, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(node, '' ORDER BY pos))"
                f" ELSE min(node) END AS node FROM {name}{k - 1} GROUP BY tree, pos // 8, n)"
            )
        out.append(
            f"{name}s{k} AS (SELECT a.tree, a.pos, a.n, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,"
            f" coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r"
            f" FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 GROUP BY ALL)"
        )
    return out


def _manifest_sql() -> str:
    def field(c):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text):
        return "sha256(" + " || ".join([field("doc_id"), field("source"), field("lang"), field("n_chars"), field(text)]) + ")"

    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        _CRC_TABLE,
        f"""d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS node,
            CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {leaf(small)} END AS claim FROM documents, crc)""",
        """r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
            count(*) OVER (PARTITION BY tree) AS n FROM d)""",
        *_levels_sql("a", "SELECT tree, pos, n, node FROM r", _TREE_LEVELS),
        f"top AS (SELECT tree AS name, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM a{_TREE_LEVELS})",
        *_levels_sql("b", "SELECT '' AS tree, pos, n, node FROM top", _TOP_LEVELS),
    ]
    steps = [(f"as{k}", "r", "r.tree", k) for k in range(_TREE_LEVELS)] + [(f"bs{k}", "top", "''", k) for k in range(_TOP_LEVELS)]
    joins = " JOIN top ON top.name = r.tree" + "".join(
        f" JOIN {s} ON {s}.tree = {tree} AND {s}.pos = {of}.pos // {8**k}" for s, of, tree, k in steps
    )
    proof = " || ".join(f"{s}.l || {s}.r" for s, *_ in steps)
    cells = ", ".join(f"{s}.n AS {s}_n, {s}.l AS {s}_l, {s}.r AS {s}_r" for s, *_ in steps)
    folded = f"""SELECT doc_id, r.node AS leaf, top.node AS subroot, (SELECT node FROM b{_TOP_LEVELS}) AS root,
        sha256({proof}) AS proof_sha256, coalesce(claim, r.node) AS f, {cells} FROM r{joins}"""
    for s, *_ in steps:
        folded = f"SELECT * REPLACE (CASE WHEN {s}_n > 1 THEN sha256({s}_l || f || {s}_r) ELSE f END AS f) FROM ({folded})"
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM ({folded})"""


@query("op11_manifest", _manifest_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.op11_manifest(table(spark, folder, "documents"))


@query(
    "op12_shards",
    f"""
    WITH {_CRC_TABLE},
    d AS (SELECT doc_id, coalesce('=' || source, '-') AS stratum, coalesce(strlen(text), 0) + 8 AS size,
                 {_crc32("coalesce(text, '')")} AS text_crc32,
                 md5(concat_ws(':', '{shards.SEED}', CAST(doc_id AS VARCHAR))) AS mixed FROM documents, crc),
    w AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY mixed, doc_id NULLS FIRST, size, text_crc32) - 1 AS rank,
                 count(*) OVER (PARTITION BY stratum) AS n FROM d),
    f AS (SELECT *, (rank + (CAST('0x' || substr(md5(concat_ws(':', '{shards.SEED}', stratum)), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE))
                            / CAST(4294967296 AS DOUBLE)) / n AS fraction FROM w),
    p AS (SELECT *, row_number() OVER (ORDER BY fraction, stratum) - 1 AS pos, count(*) OVER () AS whole FROM f)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
           CAST(pos * 24 // whole AS INTEGER) AS shard,
           pos - (pos * 24 // whole * whole + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM p
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return shards.op12_shards(table(spark, folder, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.op13_whitening(table(spark, folder, "embeddings"))
