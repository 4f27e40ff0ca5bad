"""The whole pipeline against plain versions of its stages."""

import random

import corpus_pipeline
from tidemark.llm import bpe, langid

PASSAGE = " ".join(f"bench{i}" for i in range(14))


def _corpus():
    rng = random.Random(11)
    sounds = {"aa": ["ka", "ra", "ma", "ta", "na"], "ee": ["sche", "che", "fe", "pfe", "zwe"]}
    rows = []
    for i in range(160):
        lang = "ae"[i % 2] * 2
        words = ["".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(2, 5))) for _ in range(rng.randrange(60, 120))]
        rows.append((i, " ".join(words), lang, "s", 0))
    text = {r[0]: r[1] for r in rows}
    rows += [(200, text[3], "ee", "s", 0), (201, text[3] + " fechezwe", "ee", "s", 0),   # an exact and a near copy
             (202, None, "aa", "s", 0), (203, "12 34 !", "aa", "s", 0),                  # no language
             (204, text[4] + " x " + PASSAGE + " taka " + text[6], "aa", "s", 0),        # a passage in a long text
             (205, PASSAGE + " kara", "aa", "s", 0),                                     # little but a passage
             (206, 'password = "abcdefgh12345" ' + text[8][::-1] + " " + text[10], "aa", "s", 0)]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s, _ in rows]


def test_rows_equal_plain_stages(spark, tmp_path):
    rows = _corpus()
    d = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, PASSAGE)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    # Stage 1 by its own predictions (their accuracy is tested elsewhere), the rest by hand.
    found = langid.predict(docs, langid.train(docs)).collect()
    sure = {r.doc_id for r in found if r.lang_pred != "und" and r.certainty >= langid.MIN_CERTAINTY}
    assert not sure & {202, 203} and len(sure) > 150
    by = {r[0]: r[1] for r in rows if r[0] in sure}
    copies = sorted(by.keys() & {3, 200, 201})
    expected = {i: t for i, t in by.items() if i not in copies[1:] and i != 205}
    if 204 in expected:
        expected[204] = expected[204].replace(PASSAGE, "")
    if 206 in expected:
        expected[206] = expected[206].replace('password = "abcdefgh12345', "[SECRET]")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    assert {i: r.text for i, r in out.items()} == expected
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.default_path())
    for i, t in expected.items():
        assert list(out[i].ids) == lib.encode(t, add_special_tokens=False).ids and out[i].n_chars == len(t)


def test_near_copies_from_0_80_on_go(spark, make_docs):
    rng = random.Random(3)
    words = [[f"w{rng.randrange(10**6)}" for _ in range(84)] for _ in range(12)]

    def changed(w, n):  # Jaccard of 80 shingles, 5 of them lost by each word
        return [f"new{i}" if i % 9 == 4 and i < 9 * n else x for i, x in enumerate(w)]

    texts = [" ".join(w) for w in words]
    near = [" ".join([*w, *(f"more{k}" for k in range(18))]) for w in words[:6]]  # 80 of 98: 0.816
    far = [" ".join(changed(w, 2)) for w in words[6:]]                             # 70 of 90: 0.778
    out = {r.doc_id for r in corpus_pipeline.near_dedup(spark, make_docs(texts + near + far), "").collect()}
    assert out == {*range(12), *range(18, 24)}
