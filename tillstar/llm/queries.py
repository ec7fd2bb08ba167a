"""Registered queries of the corpus operators and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    centroid_clusters,
    decontaminate,
    exact_dedup,
    html_text,
    jaccard_join,
    language_id,
    line_dedup,
    piece_codec,
    quality,
    suffix_dedup,
    toxicity,
    url_filter,
    vector_codes,
)

PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model(name: str = PIECE_MODEL) -> bytes:
    """Content of a public tokenizer's file."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.without_repeated_runs(docs, extended=True)
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.with_leaks(docs, table(spark, folder, "benchmark"))
    items = F.sort_array(F.transform("leaks", lambda x: x["item_id"]))
    return marked.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        items.alias("item_ids"),
        F.array_min(F.transform("leaks", lambda x: x["edits"])).alias("least_edits"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_bytes")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.with_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"), out_col="score"
    )
    return scored.select("doc_id", "score", (F.col("score") >= quality.KEEP_FROM).alias("kept"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_bytes_removed(table(spark, folder, "documents")).drop("kept")


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return piece_codec.with_digests(docs, piece_model()).drop("text")


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.with_text(table(spark, folder, "pages").select("page_id", "html"))
    return pages.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    codes, books = vector_codes.coded(vectors, "vec_id", "embedding", "label")
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return vector_codes.with_label_errors(codes, "label").select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.predicted(table(spark, folder, "documents"))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    clusters = centroid_clusters.clustered(table(spark, folder, "embeddings"))
    return clusters.rows.join(F.broadcast(clusters.sums()), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_line_dedup,
        op2_decontamination,
        op3_exact_dedup,
        op4_jaccard_join,
        op5_url_filters,
        op6_toxicity,
        op7_quality_classifier,
        op8_suffix_dedup,
        op9_sentencepiece,
        op10_html_extraction,
        op11_vector_codes,
        op12_language_id,
        op13_centroid_clustering,
    )
    return {q.__name__: q for q in named}


LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^ \n\r\t]+') AS w,
        regexp_extract_all(text, '(?:^[ \n\r\t]+)?[^ \n\r\t]+[ \n\r\t]*') AS p
    FROM docs),
words AS (
    SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM cut WHERE len(w) >= 32),
hashed AS (
    SELECT x, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(x))),
            lambda n: CAST('0x' || substr(hex(x), 2 * n + 1, 2) AS BIGINT)),
        lambda c, byte: list_reduce([xor(c, byte)] || range(8),
            lambda d, n: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END)),
        4294967295) AS crc
    FROM (SELECT DISTINCT x FROM words)),
keys AS (
    SELECT doc_id, list(x ORDER BY i) AS w, list(crc * 2147483648 + i ORDER BY i) AS k
    FROM words JOIN hashed USING (x) GROUP BY doc_id),
selected AS (
    SELECT doc_id, unnest(list_transform(
        list_distinct(list_transform(range(1, len(w) - 14), lambda s: list_min(k[s:s + 15]))
            || [k[1], k[len(w) - 31]]),
        lambda m: {'i': m % 2147483648, 'r': w[m % 2147483648 + 1:m % 2147483648 + 32]})) AS f
    FROM keys),
placed AS (
    SELECT doc_id, f.i AS i, row_number() OVER (PARTITION BY f.r ORDER BY doc_id, f.i) AS place
    FROM (SELECT DISTINCT doc_id, f FROM selected) WHERE len(f.r) = 32),
gone AS (
    SELECT doc_id, list(DISTINCT j) AS g
    FROM placed, unnest(range(i, i + 32)) AS t(j) WHERE place > 1 GROUP BY doc_id)
SELECT doc_id,
    coalesce(len(g), 0) AS n_removed,
    sha256(CASE WHEN g IS NULL THEN text ELSE array_to_string(
        list_filter(p, lambda x, i: NOT list_contains(g, i - 1)), '') END) AS kept_sha256
FROM cut LEFT JOIN gone USING (doc_id)
"""

EXACT_DEDUP = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s
    FROM documents),
g AS (SELECT s, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256,
    strlen(s) AS n_bytes
FROM t JOIN g USING (s)
"""

JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, w[i:i + 4] AS s
    FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
sized AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM pairs JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y
    WHERE 100 * o >= 75 * (p.n + q.n - o)),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM words
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
classes AS (
    SELECT doc_id, list_sort(list(s)) AS c FROM shingles GROUP BY doc_id),
class_sizes AS (SELECT c, count(*) AS class_size FROM classes GROUP BY c)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_size, 1) AS class_size
FROM words w LEFT JOIN sized s ON s.doc_id = w.doc_id
JOIN component ON x = w.doc_id
LEFT JOIN classes k ON k.doc_id = w.doc_id LEFT JOIN class_sizes z ON z.c = k.c
"""




def _nearest(name: str, rows: str, points: str, key: str) -> str:
    """Of each row (vec_id, x) the least (squared distance, number) over the points (n, c) of its
    key. Whole numbers this small are exact as doubles."""
    return f"""
{name} AS MATERIALIZED (
    SELECT vec_id, {key}, any_value(x) AS x, min(struct_pack(d := CAST(
        list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)
        AS BIGINT), n := n)) AS m
    FROM {rows} JOIN {points} USING ({key}) GROUP BY vec_id, {key})"""


def _moved(name: str, found: str, points: str, key: str) -> str:
    """The points after a round: floors of means, unused ones as they are."""
    return f"""
{name}_means AS (
    SELECT {key}, n, i, floor(sum(v) / count(*)) AS v
    FROM (SELECT {key}, m.n AS n, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM {found})
    GROUP BY {key}, n, i),
{name} AS MATERIALIZED (
    SELECT {key}, n, coalesce(a.c, b.c) AS c
    FROM {points} b LEFT JOIN (
        SELECT {key}, n, list(v ORDER BY i) AS c FROM {name}_means GROUP BY {key}, n) a
    USING ({key}, n))"""


def _rounds(rounds: int, key: str) -> str:
    steps = []
    for k in range(rounds):
        steps += [_nearest(f"near{k}", "rows", f"points{k}", key)]
        steps += [_moved(f"points{k + 1}", f"near{k}", f"points{k}", key)]
    return ",".join([*steps, _nearest("found", "rows", f"points{rounds}", key)])


FINITE = """embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

VECTOR_CODES = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE {FINITE}),
rows AS MATERIALIZED (
    SELECT vec_id, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x
    FROM kept, unnest(range(4)) AS t(p)),
points0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS n, x AS c
    FROM rows QUALIFY n < 256),
{_rounds(4, "p")},
codes AS (
    SELECT vec_id, string_agg(printf('%02x', m.n), '' ORDER BY p) AS code,
        CAST(sum(m.d) AS BIGINT) AS error
    FROM found GROUP BY vec_id),
books AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ','
        ORDER BY p, n)) AS codebooks_sha256
    FROM points4)
SELECT vec_id, code, error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""

CENTROID_CLUSTERING = f"""
WITH rows AS MATERIALIZED (
    SELECT vec_id, 0 AS p, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x
    FROM embeddings WHERE len(embedding) = 64 AND {FINITE}),
points0 AS MATERIALIZED (
    SELECT p, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS n, x AS c
    FROM rows QUALIFY n < 16),
{_rounds(3, "p")},
marks AS (
    SELECT n, sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','))
        AS centroid_sha256
    FROM points3)
SELECT vec_id, CAST(m.n AS INTEGER) AS cluster, m.d AS distance,
    CAST(sum(m.d) OVER (PARTITION BY m.n) AS BIGINT) AS cluster_inertia,
    CAST(sum(m.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM found JOIN marks ON n = m.n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_vector_codes": VECTOR_CODES,
        "op13_centroid_clustering": CENTROID_CLUSTERING,
        "op1_line_dedup": LINE_DEDUP,
        "op3_exact_dedup": EXACT_DEDUP,
        "op4_jaccard_join": JACCARD_JOIN,
    }
