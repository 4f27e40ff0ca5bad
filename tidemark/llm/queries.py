"""The ``opN_*`` queries: each operator over its whole table, as digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from . import bpe, collocations, decontaminate, hard_negatives, html_extract, langid, licenses, near_dup, nn_graph, pii, secret_scan, topk, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> list[Column]:
    """Counts of the base kinds, the digest of the base spans, all spans."""
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return [*(_count(F.col("spans"), k).alias(f"n_{k}") for k in kinds),
            F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    pages = _table(spark, sf_dir, "pages")
    found = warc.verified(warc.read(spark, warc.archive(pages)))
    kind = pages.schema["page_id"].dataType
    return found.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing words of every document."""
    found = pii.find_spans(_documents(spark, sf_dir))
    return found.select(F.col("doc.doc_id").alias("doc_id"), *_span_digest(found, pii.BASE))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_dup.near_duplicates(_documents(spark, sf_dir))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests are taken where the ids are."""
    docs = _documents(spark, sf_dir)
    where = bpe.default_path()
    schema = T.schema([T.field(docs, "doc_id", "doc_id")], "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = bpe.tokenizer(where)
        ids = t.encode_batch([x.decode() for x in T.raw(batch.column(1))])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([sha(np.ascontiguousarray(x).tobytes()) for x in ids], pa.string()),
             pa.array([sha(t.decode(x).encode()) for x in ids], pa.string())], names=schema.names)

    return T.map_groups(docs, fn, schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secret_scan.scan_secrets(_documents(spark, sf_dir))
    return found.select("doc_id", *_span_digest(found, secret_scan.BASE))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of every document."""
    found = decontaminate.find_items(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every twentieth vector."""
    v = topk.integers(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(v, v.where(F.col("id") % 20 == 0))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document: ids by place, and their places."""
    found = licenses.scan_licenses(_documents(spark, sf_dir))
    of = lambda f: F.array_join(F.transform("licenses", f), ",")
    return found.select(
        "doc_id", F.size("licenses").cast("bigint").alias("n_licenses"), of(lambda x: x["license"]).alias("licenses"),
        of(lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"))).alias("spans"),
        F.array_max(F.transform("licenses", lambda x: F.size(x["differences"]))).alias("most_differences"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations.mine(_table(spark, sf_dir, "documents").select("text", "lang"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, the labels of every seventh moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(_table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_nn_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return nn_graph.neighbours(nn_graph.vectors(_table(spark, sf_dir, "embeddings")), F.col("id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_html_extract, op3_pii, op4_near_dup, op5_bpe, op6_secrets, op7_decontaminate,
                            op8_langid, op9_topk, op10_licenses, op11_collocations, op12_hard_negatives, op13_nn_graph)}

# DuckDB SQL of what SQL can express.
ORACLE = {
    "op1_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS last FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
        FROM w""",
    "op9_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 20""",
    "op11_collocations": r"""
        WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM p),
        n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS v(m) WHERE len(w) >= m),
        f AS (SELECT lang, m, w[i:i + m - 1] AS w, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
        u AS (SELECT lang, w[i:i + k - 1] AS w, max(a) AS longer FROM
                (SELECT lang, w, a, k, unnest(range(1, m - k + 2)) AS i FROM f, (VALUES (2), (3)) AS v(k) WHERE k < m) GROUP BY ALL),
        c AS (SELECT f.lang, f.w, f.a, k, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * f.a) // (l.a::HUGEINT + r.a) AS BIGINT) AS score
              FROM f JOIN (VALUES (1), (2), (3)) AS v(k) ON k < f.m
                JOIN f AS l ON l.lang = f.lang AND l.w = f.w[1:k] JOIN f AS r ON r.lang = f.lang AND r.w = f.w[k + 1:f.m]
              QUALIFY row_number() OVER (PARTITION BY f.lang, f.w ORDER BY score, k) = 1),
        s AS (SELECT c.lang, array_to_string(c.w, ' ') AS phrase, a, l, r, score FROM c LEFT JOIN u ON u.lang = c.lang AND u.w = c.w
              WHERE u.longer IS NULL OR 100 * u.longer < 80 * a)
        SELECT s.lang, row_number() OVER o AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
        FROM s JOIN n ON n.lang = s.lang WINDOW o AS (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase)
        QUALIFY row_number() OVER o <= 2000""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
              FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other)
        QUALIFY row_number() OVER w <= 5""",
}
