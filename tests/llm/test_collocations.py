"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from tidemark.llm import collocations


def _plain(docs, least, top):
    f, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        taken = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in taken.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        rows = []
        for p, a in taken.items():
            if 100 * longer[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def _mined(docs, **kw):
    found = collocations.mine(docs, **kw)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def _texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ünder", "don't", "a-b", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = [["new", "york", "city", "hall"], ["of", "the"], ["once", "upon", "a", "time"]]
    out = []
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(0, 60)):
            w += rng.choice(fixed) if rng.random() < 0.15 else rng.choices(words, weights)
            w[-1] += rng.choice([""] * 8 + [".", ",", "!?", "\n", "\t"])
        out.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in w))
    return out


@pytest.mark.parametrize("part", [1 << 24, 2000])
def test_phrases_equal_plain_counting(spark, make_docs, part):
    texts = _texts(part, 260)
    langs = [["en", "de", None][i % 3] for i in range(len(texts))]
    got = _mined(make_docs(texts, langs).repartition(5), least=6, top=25, part_bytes=part)
    assert got == _plain(list(zip(texts, langs, strict=True)), 6, 25)
    assert {len(r[2].split()) for r in got} == {2, 3, 4}


def test_odd_texts(make_docs, odd_docs):
    texts = [None, "", " \t ", "...", "a", "a b" * 1, "x" * 50_000, "the end. " * 40, "the end " * 40, "The End\n" * 35, "é é " * 31]
    got = _mined(make_docs(texts, [None] * len(texts)), least=30)
    assert got == _plain([(t, None) for t in texts], 30, 2000)
    assert _mined(odd_docs)
    assert _mined(make_docs(texts).limit(0)) == []


def test_a_repeated_phrase_is_explained_by_the_longer_one(make_docs):
    texts = ["one two three four, "] * 50 + ["one two, "] * 13
    got = _mined(make_docs(texts, ["en"] * 63))
    assert got == _plain([(t, "en") for t in texts], 30, 2000)
    assert sorted(r[2] for r in got) == ["one two", "one two three four"]


@pytest.mark.parametrize("ids", [3, 700, 5000])
def test_tiles_count_pairs(ids):
    rng = np.random.default_rng(ids)
    a, b = (np.minimum(rng.zipf(1.3, 40_000), ids).astype(np.int64) - 1 for _ in range(2))
    keys, counts = collocations.count_pairs(a, b)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == Counter((a << 32 | b).tolist())
    assert len(collocations.count_pairs(a[:0], b[:0])[0]) == 0


def test_scores_beyond_64_bits(spark):
    a = 2**60
    row = spark.createDataFrame([(a, [a * 2, a], [a * 3, a])], "a bigint, pre array<bigint>, suf array<bigint>")
    cut = row.select(collocations._cut(2).alias("c")).first().c
    assert (cut.score, cut.k, cut.l, cut.r) == (2_000_000 * a // (a * 5), 1, a * 2, a * 3)
