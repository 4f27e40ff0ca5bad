"""Operators against plain versions of what they compute."""

import hashlib
import random
import re
import textwrap
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import automaton, bpe, decontaminate, html_extract, langid, licenses, near_dup, pii, queries, secret_scan, topk, warc


def _words(rng, n, vocabulary=60):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


# -- near duplicates -------------------------------------------------------------

def _plain_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("slots", [1, 4])
def test_near_duplicates_equal_brute_force(make_docs, monkeypatch, slots):
    monkeypatch.setattr(near_dup, "SLOTS", slots)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 30_000)  # several blocks of one value
    rng = random.Random(slots)
    shared = _words(rng, 40, 9999)
    texts = []
    for _ in range(12):
        base = _words(rng, rng.randrange(60, 200), 9999)
        texts += [" ".join(base)] * rng.randrange(1, 4)
        for _ in range(rng.randrange(0, 14)):  # drifting copies: chains, and some beyond the similarity
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy))
            if rng.random() < 0.4:
                base = copy
        texts.append(" ".join(shared + _words(rng, 30, 9999)))
    texts += ["", None, "a b", "a b", "A  b", "c"]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(make_docs(texts)).collect())
    assert got == [(i, n, c, i == c) for i, n, c in _plain_components(texts)]


def test_rows_without_id_or_with_one_id_twice(make_docs):
    rng = random.Random(5)
    a, b, c, d, e = ([" ".join(w), " ".join([*w, "more"])] for w in (_words(rng, 80, 9999) for _ in range(5)))
    rows = [(None, a[0]), (None, b[0]), (None, b[0]), (None, c[0]), (None, c[1]),  # alone, equal, near
            (7, d[0]), (7, e[0]), (7, e[0]), (None, d[1]),                          # one id, two texts; a near copy without id
            (None, ""), (8, None)]
    docs = make_docs([t for _, t in rows], ids=[i for i, _ in rows])
    out = [(r.doc_id, r.text) for r in near_dup.keep_one(docs).collect()]
    near = [x for x in out if x[1] in c]
    assert len(near) == 1
    assert sorted(map(str, set(out) - set(near))) == sorted(map(str, [(None, a[0]), (None, b[0]), (7, d[0]), (7, e[0]), (None, ""), (8, None)]))
    assert len(out) == 7
    named = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs.where(F.col("text").isin(d))).collect()}
    assert named == {(7, 7, True), (None, 7, False)}


def test_components_of_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = dict(near_dup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}


# -- secrets ---------------------------------------------------------------------

def test_automaton_finds_what_regexes_find():
    rules = [("ab+c", False), ("x(y|z){2,3}", True), (r"[0-9]{4}", False), ("a?b*c+", False)]
    a = automaton.compile_rules(rules)
    rng = random.Random(1)
    data = "".join(rng.choice("abcxyzXYZ0123 \n") for _ in range(5000))
    where, mask = automaton.scan(a, np.frombuffer(data.encode(), np.uint8), lane=32)
    got = {(int(w) + 1, k) for w, m in zip(where, mask, strict=True) for k in range(len(rules)) if m >> k & 1}
    exp = set()
    for k, (p, fold) in enumerate(rules):
        c = re.compile(p, re.I if fold else 0)
        exp |= {(e, k) for s in range(len(data)) for e in range(s + 1, min(s + 40, len(data)) + 1) if c.fullmatch(data, s, e)}
    assert got == exp


def test_secrets_equal_regexes(make_docs):
    rng = random.Random(2)
    bits = ["password", "Passwd", "secret", "TOKEN", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "==", "\n", "é", "abc123DEF456", "/+._-=",
            "AKIA", "AKIA" + "Z9" * 9, "0123456789abcdef", "deadbeef", "ſ", "ghp_" + "a1" * 15, "x,", "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan_secrets(make_docs(texts)).collect()}
    for i, t in enumerate(texts):
        exp = []
        for k, r in enumerate(secret_scan.RULES):
            for m in re.finditer(r.exact, t, re.A | (re.I if r.fold else 0)) if not r.fold else re.finditer(r.exact.encode(), t.encode(), re.I):
                if len(m.group(r.group)) >= r.least:
                    at = (m.start(), m.end()) if not r.fold else tuple(len(t.encode()[:x].decode()) for x in m.span())
                    exp.append((*at, k, r.kind))
        assert got[i] == [(kind, a, b) for a, b, _, kind in sorted(exp, key=lambda x: (x[0], x[2]))], t


@pytest.mark.parametrize("kinds", [("repo_token",), ("chat_token", "private_key"), ("web_token",), ("access", "repo_token"), ("hex",)])
def test_any_set_of_rules_finds_its_secrets(kinds):
    rules = tuple(r for r in secret_scan.RULES if r.kind in kinds)
    rng = random.Random(len(kinds))
    parts = ["ghp_" + "a1B2" * 8, "xoxb-" + "12-ab" * 5, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "abcDEF12" * 3 + ".eyJ" + "xyz_-123" * 2, "AKIA" + "Q7" * 9,
             "0123456789abcdef0", "gh", "x", " ", "\n", "eyJ.", "----", "é", "key: "]
    assert secret_scan.find([b"token ghp_" + b"a1B2" * 8], (next(r for r in secret_scan.RULES if r.kind == "repo_token"),))
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 9))).encode() for _ in range(4)]
        want = {}
        for i, t in enumerate(texts):
            hits = [(k, m.start(), m.end()) for k, r in enumerate(rules) for m in re.finditer(r.exact.encode(), t, re.I if r.fold else 0) if len(m.group(r.group)) >= r.least]
            if hits:
                want[i] = sorted(hits, key=lambda x: (x[1], x[0]))
        assert secret_scan.find(texts, rules) == want


def test_redaction(make_docs):
    r = secret_scan.redact(make_docs(["é token = abcdefghijkl0 x", "clean"])).orderBy("doc_id").collect()
    assert [(x.text, x.n_chars) for x in r] == [("é [SECRET] x", 12), ("clean", 5)]


@pytest.mark.parametrize("first", [None, ""])
def test_secret_after_a_leading_empty_text(make_docs, first):
    docs = make_docs([first, "token=ABCDEFGHIJKL1234"]).coalesce(1)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan_secrets(docs).collect()}
    assert spans == {0: [], 1: [("assign", 0, 22)]}
    assert [r.text for r in secret_scan.redact(docs).orderBy("doc_id").collect()] == [first, "[SECRET]"]


# -- benchmark -------------------------------------------------------------------

def _plain_hits(text, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = re.findall(pattern, _lower(text or ""))
    hit, named = [False] * len(w), set()
    for name, t in items:
        x = re.findall(pattern, _lower(t or ""))
        k = min(10, len(x))
        for i in range(len(x) - k + 1) if k else ():
            for j in range(len(w) - k + 1):
                if w[j:j + k] == x[i:i + k]:
                    hit[j:j + k] = [True] * k
                    named.add(str(name))
    return len(w), sum(hit), sorted(named)


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_items_equal_brute_force(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(3)
    items = [(i, " ".join(_words(rng, rng.choice([0, 1, 3, 9, 10, 25, 40]), 12))) for i in range(1, 25)]
    items = [(i, t if len(t.split()) != 1 else "Alone-É") for i, t in items]
    texts = [None, "", "alone-É. ALONE é"]
    for _ in range(120):
        w = _words(rng, rng.randrange(0, 60), 12)
        if rng.random() < 0.6:
            x = rng.choice(items)[1].split()
            w[len(w) // 2:len(w) // 2] = x[rng.randrange(0, 3):]
        texts.append(rng.choice([" ", ", ", "--"]).join(w).title())
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find_items(make_docs(texts), table).collect()
    got = {r.doc_id: (r.n_words, sum(h.end - h.start for h in r.hits), list(r["items"])) for r in rows}
    assert got == {i: _plain_hits(t, items) for i, t in enumerate(texts)}


def test_decontaminate_cuts_and_drops(spark, make_docs):
    passage = " ".join(f"p{i}" for i in range(12))
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    clean = " ".join(f"c{i}" for i in range(30))
    r = decontaminate.decontaminate(make_docs([clean, f"{clean} {passage}. end", passage]), items).orderBy("doc_id").collect()
    assert [(x.doc_id, x.text, x.n_chars) for x in r] == [(0, clean, len(clean)), (1, f"{clean} . end", len(clean) + 6)]


# -- BPE -------------------------------------------------------------------------

def test_bpe_equals_the_library_and_round_trips(make_docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.default_path())
    rng = random.Random(4)
    parts = ["don't", "I'LL", "'s's", "aaaaaaaaaaa", "İstanbul", "ΣΑΣ", "é", "é", "²½", "中文", "<|endoftext|>", "<|ENDOFTEXT|>", "\x1c", "　", "\x85",
             "a_b", "...", "!?", "12345", "the", "thethe", "😀👍", "‍", "\n", "ñandú", "ﬁ"]
    texts = ["".join(rng.choice([*parts, " ", " "]) for _ in range(rng.randrange(0, 80))) for _ in range(300)] + ["ab" * 5000]
    rows = bpe.decode(bpe.encode(make_docs(texts))).collect()
    for r in rows:
        e = lib.encode(texts[r.doc_id], add_special_tokens=False)
        assert list(r.ids) == e.ids and r.n_tokens == len(e.ids)
        assert r.decoded == lib.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "aab", "日本語中文字", "é"])
def test_bpe_of_a_long_unbroken_word(letters):
    from tokenizers import Tokenizer

    lib, t, rng = Tokenizer.from_file(bpe.default_path()), bpe.tokenizer(bpe.default_path()), random.Random(len(letters))
    words = ["".join(rng.choices(letters, k=n)) for n in (bpe.LONG // 3, bpe.LONG, bpe.LONG + 1, 200_000)]
    for text in [*words, " ".join(words)]:
        assert t.encode_batch([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


# -- personal data ---------------------------------------------------------------

def _plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub("[^0-9]", "", m.group())]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_equal_regexes():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "@@", "x.com", ".", "..", "-", "1", "255", "256", "007", "4111111111111111", "4111 1111-1111 1111", "+1 (555) 010-0000", "+", " ", "é", "%", "1.2.3.4", "\n"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(t) == _plain_pii(t), t
    assert pii.base_spans("a" * 300_000 + "@" + "1" * 300_000) == []


def test_disclosing_words(make_docs):
    rng = random.Random(6)
    texts = [f"{rng.choice(['we', 'they'])} told quixotia the {rng.choice('abc')}dd of jo@mail.org {' '.join(_words(rng, 3))}" for _ in range(8)]
    texts += ["we told they the add bdd cdd of them " + " ".join(_words(rng, 8)) for _ in range(300)]
    rows = {r.doc.doc_id: r.spans for r in pii.find_spans(make_docs(texts)).collect()}
    for i in range(8):
        assert [(s.kind, texts[i][s.start:s.end]) for s in rows[i]] == [("email", "jo@mail.org"), ("removed", "quixotia")]
    assert not any(rows[i] for i in range(8, 308))
    clean = {r.doc_id: r.text for r in pii.sanitise(make_docs(texts)).collect()}
    assert "quixotia" not in clean[0] and "[EMAIL]" in clean[0] and clean[20] == texts[20]


def _plain_disclosing(texts):
    """Words by plain sets of documents: (word, kind)."""
    word = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
    low = lambda w: re.sub("[A-Z]", lambda m: m.group().lower(), w)
    anywhere, free, held = [], [], []
    for t in texts:
        spans = _plain_pii(t)
        anywhere.append({low(m.group()) for m in word.finditer(t)})
        free.append({low(m.group()) for m in word.finditer(t) if not any(m.start() < b and a < m.end() for _, a, b in spans)})
        held.append({(pii.entity_key(k, t[a:b]), tuple(w.lower() for w in word.findall(t[max(0, a - 200):a])[-8:]), tuple(w.lower() for w in word.findall(t[b:b + 200])[:8]))
                     for k, a, b in spans})
    out = {}
    for e in {h[0] for d in held for h in d}:
        with_e = [i for i, d in enumerate(held) if any(h[0] == e for h in d)]
        for t in set().union(*(free[i] for i in with_e)):
            both = [i for i in with_e if t in free[i]]
            if len({h[1:] for i in both for h in held[i] if h[0] == e}) >= pii.SUPPORT and len(with_e) < len(texts):
                n = sum(t in d for d in anywhere)
                share = 1 + np.log(min(len(both), n) / n) / np.log(len(texts) / len(with_e))
                if share >= pii.GENERALISE:
                    out[t] = max(out.get(t, 0.0), share)
    return {t: "removed" if s >= pii.REMOVE else "generalised" for t, s in out.items()}


@pytest.mark.parametrize("block", [1 << 20, 16])
def test_disclosing_words_equal_plain_sets(make_docs, monkeypatch, block):
    """A name on another line or far away, in documents without the entity, in two letters; overlapping and repeated copies."""
    monkeypatch.setattr(pii, "PASS_TERMS", block)
    rng = random.Random(12)
    pool = ["".join(rng.choices("bcdfghaeiou", k=4)) for _ in range(60)]
    letters = lambda n: rng.choices(pool, k=n)
    texts = [f"Jane Quixotia {' '.join(letters(4))}\n\njane@x.org {' '.join(letters(5))}" for _ in range(8)]
    texts += [f"{' '.join(letters(300))} call +1 555 010-0000, {' '.join(letters(9))} 王五 {' '.join(letters(3))}" for _ in range(5)]
    texts += ["Quixotia was seen " + " ".join(letters(9)), "QUIXOTIA mail jane@x.org.", " 王五"]
    texts += ["verbatim copy of zorblatt with bob@y.net here"] * 6
    texts += [" ".join(letters(30)) for _ in range(90)] + ["", None]
    words = _plain_disclosing([t or "" for t in texts])
    assert words.get("quixotia") and words.get("王五") and "zorblatt" not in words
    docs = make_docs(texts)
    for r in pii.find_spans(docs).collect():
        t = texts[r.doc.doc_id] or ""
        base = _plain_pii(t)
        more = [(words[low], m.start(), m.end()) for m in re.finditer(r"[A-Za-z\x80-\U0010ffff]+", t)
                if (low := _lower(m.group())) in words and not any(m.start() < b and a < m.end() for _, a, b in base)]
        assert [(s.kind, s.start, s.end) for s in r.spans] == base + sorted(more, key=lambda x: (pii.KINDS.index(x[0]), x[1]))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any("quixotia" in (t or "").lower() or "王五" in (t or "") for t in clean.values())


# -- language --------------------------------------------------------------------

def test_language_held_out(make_docs):
    rng = random.Random(7)
    sounds = {"aa": ["ka", "ra", "ma", "ta"], "oo": ["kö", "rö", "mö", "tö"], "ee": ["sche", "che", "fe", "pfe"]}
    texts, langs = [], []
    for i in range(600):
        lang = ["aa", "oo", "ee"][i % 3]
        langs.append(lang)
        texts.append(" ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 200))))
    docs = make_docs([*texts, None, "123 !"], [*langs, "aa", "aa"])
    net = langid.train(docs, per_language=60)
    rows = langid.predict(docs, net).withColumn("held_out", langid.held_out("doc_id")).collect()
    held = [r for r in rows if r.held_out and r.doc_id < 600]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert len(held) > 100 and sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.95
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id >= 600} == {("und", 0.0)}
    left = {r.doc_id for r in langid.accepted(docs).collect()}
    assert left <= set(range(600)) and len(left) > 550


def test_language_of_a_text_depends_on_that_text_alone():
    rng = random.Random(9)
    texts = ["ro fe", "", "a", "é", "x" * 255, "y" * 256, "z" * 257, " \n", *(" ".join(_words(rng, rng.randrange(1, 400))) for _ in range(40))]
    net = langid.fit([t.encode()[:langid.WINDOW] or b" " for t in texts], [i % 3 for i in range(len(texts))], ["a", "b", "c"], epochs=1)
    tables, raw = net.tables(), [t.encode() for t in texts]
    alone = [tuple(x[0] for x in langid.predict_texts(net, tables, [t])) for t in raw]
    for _ in range(6):
        order = rng.sample(range(len(raw)), len(raw))
        cut = rng.randrange(1, 9)
        for a in range(0, len(order), cut):
            part = order[a:a + cut]
            got = list(zip(*langid.predict_texts(net, tables, [raw[i] for i in part]), strict=True))
            assert [(g[0], round(g[1], 5), round(g[2], 5)) for g in got] == [(alone[i][0], round(alone[i][1], 5), round(alone[i][2], 5)) for i in part]


# -- vectors ---------------------------------------------------------------------

def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "PAGE", 8)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 9)
    rng = np.random.default_rng(8)
    x = rng.integers(-3, 4, (400, 3)).astype(float)
    x[50:200] = x[0]  # a third of all rows is one vector
    v = topk.integers(spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "vec_id bigint, embedding array<double>"))
    got = sorted(tuple(r) for r in topk.top_k(v, v.where("id % 20 = 0")).collect())
    z = np.floor(64 * x).astype(int)
    exp = []
    for q in range(0, 400, 20):
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-int(z[q] @ z[i]), i))[:20]
        exp += [(q, k + 1, i, int(z[q] @ z[i])) for k, i in enumerate(order)]
    assert got == exp


# -- WARC ------------------------------------------------------------------------

def test_archives_round_trip_at_any_split(spark):
    rng = random.Random(9)
    noise = rng.randbytes(6000).hex()
    html = [None, "", "short", "x" * 999, "y" * 1000, "y" * 1000, noise, noise, "é" * 500, *(f"<p>{rng.random()}" * 80 for _ in range(40))]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in enumerate(html)], "page_id bigint, url string, html string")
    path = warc.archive(pages.repartition(3))
    for size in (257, 5000, 1 << 24):
        rows = warc.read(spark, path, size).collect()
        assert sorted(int(r.record_id) for r in rows) == list(range(len(html)))
        for r in rows:
            if r.record_type == "response":
                assert bytes(r.payload).decode() == (html[int(r.record_id)] or "")
    got = {int(r.id): (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.verified(warc.read(spark, path)).collect()}
    for i, h in enumerate(html):
        raw = (h or "").encode()
        last = max(j for j, o in enumerate(html) if (o or "").encode() == raw)
        revisit = len(raw) >= 1000 and last != i
        assert got[i] == ("revisit" if revisit else "response", str(last) if revisit else None, len(raw), hashlib.sha1(raw).hexdigest())


# -- HTML ------------------------------------------------------------------------

PARA = "This is a paragraph, with commas, and enough words in it to be taken for the text of an article."


@pytest.mark.parametrize(("html", "text"), [
    (f"<body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>{PARA}<p> a\n b<br>c</article><footer>x</footer>", f"T & U {PARA} a b c"),
    (f"<div class=content><p>{PARA}</p><aside>no</aside><div id='comments'><p>{PARA} too</p></div><p>{PARA}</div><div class='sidebar'><p>{PARA}</p></div>", f"{PARA} {PARA}"),
    (f"<main><p>{PARA}</p><form><p>{PARA}</p></form><script>var a='</p>';</script><p>&lt;b&gt; &#233;</p></main>", f"{PARA} <b> é"),
    ("<body><p>short</p></body>", "short"),
    ("", ""),
    ("<script>x</script><!-- c -->", ""),
    (f"<ul><li><a href=x>{PARA}</a><li><a href=y>{PARA}</a></ul><div><p>{PARA}</p></div>", PARA),
])
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


@pytest.mark.parametrize("html,text", [
    (f"<body><div class='page has-sidebar'><article><p>{PARA}</article></div></body>", PARA),
    (f"<div class='post hentry tag-linux'><p>{PARA}</div>", PARA),
    (f"<div class='post no-comments comments-open'><p>{PARA}</div>", PARA),
    (f"<body><form action=x><div><p>{PARA}</div></form></body>", PARA),
    (f"<div class=sidebar-layout><main><p>{PARA}</main><div class=sidebar>no</div></div>", PARA),
    (f"<div><section><p>{PARA * 3}</section><section><p>{PARA}</section><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>end.</div>",
     f"{PARA * 3} {PARA} one two a b end."),
    (f"<div><p>{PARA}</p><ul><li><a href=x>{PARA}</a></ul><p>b</p></div><a href=http://x/>{PARA}</a>", f"{PARA} {PARA} b"),
    (f"<div class=ad>{PARA * 2}</div><article><h1>T</h1><p>a</article>", "T a"),
    (f"<main><p>{PARA}</main><ol class=comment-list><li><article class=comment><p>{PARA * 3}</article></ol>", PARA),
])
def test_main_text_of_marked_pages(html, text):
    assert html_extract.main_text(html) == text


def test_an_unquoted_link_that_ends_in_a_slash_holds_its_text():
    links = "".join(f"<li><a href=http://x/{i}/>{PARA}</a>" for i in range(3))
    assert html_extract.main_text(f"<div id=c><p>{PARA}</div><ul>{links}</ul>") == PARA


# -- licenses --------------------------------------------------------------------

def test_licenses_by_wording():
    for name, texts in licenses.TEMPLATES.items():
        for t in texts:
            for around in (f"Intro line.\n{t}\nMore.", t, f"Some sixty characters of prose stand before the notice here. {t} And more after it.",
                           "/*\n * " + "\n * ".join(textwrap.wrap(t, 60, break_on_hyphens=False, break_long_words=False)) + "\n */", textwrap.fill(t, 40, break_on_hyphens=False, break_long_words=False)):
                found = licenses.find(around)
                assert [f["license"] for f in found] == [name], around
                assert licenses.words(around[found[0]["start"]:found[0]["end"]]) == licenses.words(t)
    assert licenses.find("The driver needs a licence to drive.") == []
    one = licenses.find("x\nSPDX-License-Identifier: Zlib\nLicensed under CC BY 4.0.\ny")
    assert [f["license"] for f in one] == ["Zlib", "CC-BY-4.0"]
    two = licenses.find("Licensed under CC BY 4.0. Released under the MIT License.")
    assert [f["license"] for f in two] == ["CC-BY-4.0", "MIT"]
    near = licenses.find("This work is licenced under the GNU General Public License, version 3.")
    assert near[0]["license"] == "GPL-3.0" and near[0]["differences"]


def _plain_licenses(text):
    """Every template against every stretch of words of its length; of overlapping ones the longer."""
    places = [(m.start(), m.end()) for m in re.finditer(licenses._WORD, text)]
    w = [text[a:b].lower() for a, b in places]
    hits = []
    for name, texts in licenses.TEMPLATES.items():
        for t in map(licenses.words, texts):
            hits += [(-len(t), places[i][0], places[i + len(t) - 1][1], name) for i in range(len(w) - len(t) + 1) if w[i:i + len(t)] == t]
    out = []
    for _, a, b, name in sorted(hits):
        if all(b <= x or y <= a for x, y, _ in out):
            out.append((a, b, name))
    return sorted(out)


def test_licenses_equal_plain_windows():
    rng = random.Random(3)
    notices = [(n, t) for n, texts in licenses.TEMPLATES.items() for t in texts]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts += [" ".join(_words(rng, rng.randrange(0, 30))), rng.choice(notices)[1], rng.choice(["the license of", "license, licensed", "", "\n\n"])]
        text = rng.choice([" ", "\n"]).join(parts)
        assert [(f["start"], f["end"], f["license"]) for f in licenses.find(text)] == _plain_licenses(text)
    long = "x" * 100_000 + " license " * 3000 + notices[0][1] + " y" * 50_000 + " " + notices[4][1]
    assert [(f["start"], f["end"], f["license"]) for f in licenses.find(long)] == _plain_licenses(long)


def test_queries_are_registered():
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE) <= set(queries.QUERIES)
