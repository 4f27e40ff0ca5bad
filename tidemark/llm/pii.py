"""Personal data: fixed patterns and information-theoretic sanitisation.

The protected entities are what the patterns find (email, ip, card, phone).
Words of the documents that hold them may give them away.  Over the whole corpus a
word t discloses the share

    1 + log(docs(t, e) / docs(t)) / log(N / docs(e))

of the information of entity e: its pointwise mutual information with e by the
information content of e.  ``docs(t, e)`` counts the documents that hold both,
wherever t stands in them.  A word that discloses at least ``GENERALISE`` of an
entity, seen with it in at least ``SUPPORT`` different contexts (a context is the
words right around the entity, so verbatim copies are one), is a span of its own at
every place in every document, also in those that do not show the entity, but not
inside a span of the patterns: generalised, from ``REMOVE`` on removed.

All counts are over all documents.  Only entities seen in ``SUPPORT`` contexts can
have such words, so pairs of entity and word are made for those alone, and counted
by a shuffle with map-side aggregation; document frequencies and places are looked
up for at most ``PASS_TERMS`` words at a time.

Edge cases: null or empty texts have no spans; repeated rows are documents of
their own; an entity of every document has no information to disclose; very long
texts are searched whole in linear time; an empty table gives no rows; other
columns are ignored or passed on.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from .secret_scan import lengths, replaced

# Kinds in their order, and their patterns.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "generalised", "removed")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
_TERM_BYTES = T.byte_class(lambda b: b >= 0x80 or chr(b).isalpha())
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalised": "[TERM]", "removed": ""}

#: Words on each side of an entity, and characters looked at for them, that make a context.
CONTEXT = 8
CONTEXT_CHARS = 200
SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95
PASS_TERMS = 1 << 20

_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_HELD = "array<struct<entity:bigint,context:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_HELD_TYPE = pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns: leftmost, not overlapping within a kind,
    failing ones dropped; by kind, then start."""
    out: list[tuple[str, int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:  # from each @ outwards: the local part is the run before it
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append(("email", lo, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_octet(x) for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) <= 3 and int(s or "0") <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)


def entity_key(kind: str, value: str) -> int:
    return _hash(f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else _NOT_DIGIT.sub('', value)}")


def held_entities(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """The entities of a text, each with the context that it stands in."""
    out = set()
    for kind, a, b in spans:
        left = [m.group().lower() for m in _TERM.finditer(text, max(0, a - CONTEXT_CHARS), a)][-CONTEXT:]
        right = [m.group().lower() for m in _TERM.finditer(text, b, min(len(text), b + CONTEXT_CHARS))][:CONTEXT]
        out.add((entity_key(kind, text[a:b]), _hash(" ".join([*left, "|", *right]))))
    return [{"entity": e, "context": c} for e, c in sorted(out)]


def outside(text: str, spans: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, byte starts and byte ends of the words that no span touches."""
    raw = text.encode()
    buf = np.frombuffer(raw, np.uint8)
    starts, ends = T.spans(buf, _TERM_BYTES)
    if spans:
        before = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before a byte
        lo, hi = np.array([x[1] for x in spans]), np.array([x[2] for x in spans])
        a, b = before[starts], before[ends]
        order = np.argsort(lo, kind="stable")
        reach = np.maximum.accumulate(hi[order])  # how far the spans that begin before a word's end go
        k = np.searchsorted(lo[order], b) - 1
        free = (k < 0) | (reach[np.maximum(k, 0)] <= a)
        starts, ends = starts[free], ends[free]
    return T.word_hashes(buf, starts, ends).view(np.int64), starts, ends


def document_frequencies(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """``term``, ``docs``: in how many documents each of the ``terms`` occurs."""
    total, out = terms.count(), None
    passes = max(1, -(-total // PASS_TERMS))
    for k in range(passes):
        part = terms if passes == 1 else terms.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == k)
        hashes = np.sort(np.array([r[0] for r in part.collect()], dtype=np.int64))
        if not len(hashes):
            continue
        wanted = docs.sparkSession.sparkContext.broadcast(hashes)

        def count(batches, wanted=wanted):
            known = wanted.value
            n = np.zeros(len(known), dtype=np.int64)
            for batch in batches:
                for piece in T.slices(batch, "text"):
                    buf, at = T.flat(T.raw(piece.column(0)))
                    starts, ends = T.spans(buf, _TERM_BYTES)
                    h = T.word_hashes(buf, starts, ends).view(np.int64)
                    row = np.repeat(np.arange(piece.num_rows), np.diff(T.word_rows(starts, at)))
                    i = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    hit = known[i] == h
                    n += np.bincount(np.unique(row[hit] * len(known) + i[hit]) % len(known), minlength=len(known))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(n[some])], names=["term", "docs"])

        found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "term bigint, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
        out = found if out is None else out.union(found)
    return out


def disclosing(docs: DataFrame, text_col: str = "text") -> DataFrame | None:
    """``term`` (hash) and ``share``: words that disclose at least ``GENERALISE`` of an
    entity, with the largest share; None if there can be none."""
    rows = docs.select(F.col(text_col).alias("text"))

    def hold(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [raw.decode() for raw in T.raw(batch.column(0))]
        held = [held_entities(t, found) if (found := base_spans(t)) else [] for t in texts]
        return pa.RecordBatch.from_arrays([pa.array([t if h else None for t, h in zip(texts, held, strict=True)], pa.string()), pa.array(held, _HELD_TYPE)],
                                          names=["text", "held"])

    base = T.kept(T.map_groups(rows, hold, f"text string, held {_HELD}").withColumn("key", F.monotonically_increasing_id()), "pii")
    holding = base.where(F.size("held") > 0)
    some = holding.select("key", F.explode("held").alias("x")).select("key", "x.*")
    contexts = some.groupBy("entity", "context").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("contexts"))
    of = some.select("entity", "key").distinct().groupBy("entity").agg(F.count("*").alias("of_entity"))
    entities = T.kept(contexts.where(F.col("contexts") >= SUPPORT).join(of, "entity").select("entity", "of_entity"), "pii-entities")
    if entities.isEmpty():
        return None
    wanted = some.join(entities, "entity").groupBy("key").agg(F.collect_set(F.struct("entity", "context")).alias("held"))

    def pair(batches):
        for batch in batches:
            for text, held in zip(batch.column("text").to_pylist(), batch.column("held").to_pylist(), strict=True):
                terms = np.unique(outside(text, base_spans(text))[0])
                by: dict[int, list[int]] = {}
                for h in held:
                    by.setdefault(h["entity"], []).append(h["context"])
                for entity, seen in by.items():
                    for k, context in enumerate(seen):  # a document counts once, whatever the number of contexts in it
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(terms), entity)), pa.array(terms), pa.array(np.full(len(terms), context)), pa.array(np.full(len(terms), int(k == 0)))],
                            names=["entity", "term", "context", "docs"])

    T.bounded_batches(docs.sparkSession)
    pairs = holding.select("key", "text").join(wanted, "key").select("text", "held").mapInArrow(pair, "entity bigint, term bigint, context bigint, docs bigint")
    both = (pairs.groupBy("entity", "term", "context").agg(F.sum("docs").alias("docs"))
            .groupBy("entity", "term").agg(F.count("*").alias("support"), F.sum("docs").alias("both")).where(F.col("support") >= SUPPORT))
    both = T.kept(both.select("entity", "term", "both"), "pii-pairs")
    if both.isEmpty():
        return None
    terms = document_frequencies(docs, both.select("term").distinct(), text_col).withColumnRenamed("docs", "of_term")
    information = F.log(F.lit(float(base.count())) / F.col("of_entity"))
    share = 1 + F.log(F.least(F.col("both"), F.col("of_term")) / F.col("of_term")) / information
    return T.kept(both.join(entities, "entity").join(terms, "term").where(information > 0).groupBy("term").agg(F.max(share).alias("share"))
                  .where(F.col("share") >= GENERALISE), "pii-disclosing")


def find_spans(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns (under ``doc``) and ``spans`` of every document: kind,
    start, end in code points, by kind as listed, then start."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.col(text_col).alias("text"))
    told = disclosing(docs, text_col)
    names, doc = ["doc", "text", "spans"], T.field(rows, "doc", "doc")

    def patterns(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in base_spans(raw.decode())] for raw in T.raw(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPAN_TYPE)], names=names)

    out = T.map_groups(rows, patterns, T.schema([doc, T.field(rows, "text", "text")], f"spans {_SPANS}"))
    for wanted in _in_passes(told):
        out = T.map_groups(out, _marker(wanted, names), out.schema)
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    by_kind = F.transform(F.array_sort(F.transform("spans", lambda s: F.struct(F.element_at(order, s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
                          lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select("doc", by_kind.alias("spans") if told is not None else "spans")


def _in_passes(told: DataFrame | None) -> list:
    """The disclosing words in broadcast blocks of at most about ``PASS_TERMS``: sorted hashes, and which are removed."""
    if told is None:
        return []
    passes, out = max(1, -(-told.count() // PASS_TERMS)), []
    for k in range(passes):
        part = (told if passes == 1 else told.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == k)).collect()
        part.sort(key=lambda r: r["term"])
        if part:
            out.append(told.sparkSession.sparkContext.broadcast((np.array([r["term"] for r in part], dtype=np.int64), np.array([r["share"] >= REMOVE for r in part]))))
    return out


def _marker(wanted, names: list[str]):
    """Adds the places of the wanted words to ``spans``."""
    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, removed = wanted.value
        raw = T.raw(batch.column(1))
        buf, at = T.flat(raw)
        starts, ends = T.spans(buf, _TERM_BYTES)
        h = T.word_hashes(buf, starts, ends).view(np.int64)
        hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        rows = np.unique(np.searchsorted(at, starts[hit], side="right") - 1)
        if not len(rows):
            return batch
        spans = batch.column(2).to_pylist()
        for r in rows.tolist():
            text = raw[r].decode()
            base = [(s["kind"], s["start"], s["end"]) for s in spans[r] if s["kind"] in BASE]
            words, a, b = outside(text, base)
            place = np.minimum(np.searchsorted(known, words), len(known) - 1)
            found = known[place] == words
            before = np.concatenate([[0], np.cumsum((np.frombuffer(raw[r], np.uint8) & 0xC0) != 0x80)])
            spans[r] += [{"kind": KINDS[-1] if gone else KINDS[-2], "start": x, "end": y}
                         for gone, x, y in zip(removed[place[found]].tolist(), before[a[found]].tolist(), before[b[found]].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPAN_TYPE)], names=names)

    return mark


def sanitise(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents, every span replaced by the mark of its kind (a removed word
    by nothing); overlapping spans are replaced as one.  All columns stay."""
    found = find_spans(docs, text_col, tuple(docs.columns))
    names = docs.columns
    count = length_col if length_col in names else None

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(batch.num_columns - 1).to_pylist()
        rest = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))
        changed = [i for i, s in enumerate(spans) if s]
        if not changed:
            return rest
        new = rest.column(names.index(text_col)).to_pylist()
        for r in changed:
            out, at = [], 0
            for s in sorted(spans[r], key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at:
                    out += [new[r][at:s["start"]], MARKS[s["kind"]]]
                at = max(at, s["end"])
            new[r] = "".join([*out, new[r][at:]])
        return replaced(rest, names, {text_col: new} | ({count: lengths(rest, names.index(count), changed, new)} if count else {}))

    return T.map_groups(found.select("doc.*", F.col("spans").alias("__spans")), fn, docs.schema, text_col)
