"""Every operator and stage on odd rows and on empty tables."""

import corpus_pipeline
import pytest
from tidemark.llm import bpe, decontaminate, html_extract, langid, licenses, near_dup, pii, secret_scan, topk, warc


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, None), (3, ""), (None, "one two")],
                                 "item_id bigint, text string")


def _operators(items):
    return {
        "pii": lambda d: pii.find_spans(d),
        "near_dup": near_dup.near_duplicates,
        "bpe": bpe.encode,
        "secrets": secret_scan.scan_secrets,
        "decontaminate": lambda d: decontaminate.find_items(d, items),
        "langid": lambda d: langid.predict(d, langid.train(d)),
        "licenses": licenses.scan_licenses,
    }


@pytest.mark.parametrize("name", ["pii", "near_dup", "bpe", "secrets", "decontaminate", "langid", "licenses"])
def test_one_row_per_document(name, odd_docs, items):
    op = _operators(items)[name]
    assert op(odd_docs).count() == odd_docs.count()
    assert op(odd_docs.limit(0)).count() == 0


def test_odd_near_duplicates(odd_docs):
    r = {(x.doc_id, x.n_shingles, x.component_id, x.kept) for x in near_dup.near_duplicates(odd_docs).collect()}
    assert {(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 4, True)} <= r
    assert (None, 1, None, True) in r
    assert near_dup.keep_one(odd_docs).count() == odd_docs.count() - 1


def test_stages_keep_columns_and_pass_odd_rows(spark, odd_docs, items, tmp_path):
    items.write.parquet(f"file://{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, f"file://{tmp_path}")
        assert out.columns == odd_docs.columns, name
        out.collect()
        assert stage(spark, odd_docs.limit(0), f"file://{tmp_path}").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, odd_docs.drop("ids"), f"file://{tmp_path}")
    assert last.count() == odd_docs.count()


def test_sanitise_and_redact_keep_odd_rows(odd_docs):
    for out in (pii.sanitise(odd_docs), secret_scan.redact(odd_docs)):
        assert out.columns == odd_docs.columns
        assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, odd_docs.select("doc_id", "text").collect()))


PAGE_SCHEMA = "page_id bigint, url string, html string, digest string, payload string"


def test_pages_odd_rows(spark):
    big = "<p>" + "long text, " * 200_000
    pages = spark.createDataFrame([(1, None, None, "a", "b"), (None, "u v\n", "", None, None), (2, "u", big, "a", "b"), (3, "u", big, "a", "b"),
                                   (3, "u", big, "a", "b"), (4, "é", "<", None, None)], PAGE_SCHEMA)
    r = warc.verified(warc.read(spark, warc.archive(pages))).collect()
    assert sorted((x.id or "", x.record_type, x.refers_to or "", x.payload_bytes) for x in r) == [
        ("", "response", "", 0), ("1", "response", "", 0), ("2", "revisit", "3", len(big)), ("3", "response", "", len(big)),
        ("3", "response", "", len(big)), ("4", "response", "", 1)]
    text = {(x.page_id, x.text) for x in html_extract.extract(pages).collect()}
    assert {(1, ""), (None, ""), (4, "<")} <= text and len(max(t for _, t in text)) > 2_000_000
    empty = pages.limit(0)
    assert warc.with_revisits(empty, "page_id", empty.html.cast("binary")).count() == 0
    assert html_extract.extract(empty).count() == 0


def test_archives_of_no_pages(spark):
    pages = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.verified(warc.read(spark, warc.archive(pages))).count() == 0


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [nan, 0.0], 1), (2, [None, 1.0], 1), (3, None, 1), (4, [inf, 0.0], 1), (None, [1.0, 1.0], 1), (5, [1.0, 0.0], 1),
            (6, [1.0, 0.0], 1), (7, [1.0], 1), (20, [], 1), (40, [1e12, 1e12], 1)]
    v = topk.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int"))
    got = [tuple(r) for r in topk.top_k(v.where("id != 40"), v.where("id in (0, 20)"), 2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 5, 4096), (0, 2, 6, 4096)]
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_a_repeated_query_row_is_answered_for_each(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [0.25, 0.0])]
    v = topk.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = [tuple(r)[:3] for r in topk.top_k(v, v.where("id = 0"), 4).orderBy("rank", "query_id").collect()]
    assert got == [(0, 1, 1), (0, 1, 1), (0, 2, 2), (0, 2, 2), (0, 3, 3), (0, 3, 3)]
