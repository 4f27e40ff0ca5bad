"""Benchmark decontamination by a generalised suffix automaton of test items.

Items are normalised (A-Z lower-cased; a word is a run of ASCII letters, digits
and non-ASCII characters) and built into one suffix automaton over word numbers.
Documents stream through it and keep, at every word, the state and length of
the longest match that ends there.  A match of at least ``window`` words makes
its words hit; an item of fewer words is one window as a whole.  Stretches of
words whose neighbouring pairs all occur in items are the only ones that can
match, so only they are walked, many stretches in step in numpy.  Windows found
are looked up by their exact words, which also names their items.

The items travel to the tasks in blocks of at most about ``BLOCK_BYTES`` of text; more
items mean more passes over the documents, never a larger broadcast or automaton.
The documents are written once for several passes; a pass writes only the places
that it finds, which meet the documents in one join.

Edge cases: a null or empty text has no words; an item without words matches
nothing; null item ids count as the empty name; repeated items are one item by
id; an empty table of items or documents is fine; very long texts are walked
whole; other columns are ignored or passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import _text as T
from .secret_scan import lengths, replaced

WINDOW = 10
BLOCK_BYTES = 1 << 20
WORD = T.byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
_FOUND = "array<struct<start:int,end:int>>"


class SuffixAutomaton:
    """Of several word sequences; numbers of words from the sorted hashes of
    ``vocab``.  A separator of its own after every item keeps matches inside."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.window = window
        self.windows: dict[bytes, set[str]] = {}
        sequences = []
        for name, text in items:
            buf, _ = T.flat([text])
            starts, ends = T.spans(buf, WORD)
            if not len(starts):
                continue
            sequences.append(T.word_hashes(buf, starts, ends))
            words = _words(buf, starts, ends)
            for i in range(max(1, len(words) - window + 1)):
                self.windows.setdefault(b" ".join(words[i:i + window]), set()).add(name)
        self.shorter = sorted({k.count(b" ") + 1 for k in self.windows} - {window})
        self.least = min([window, *self.shorter])
        self.vocab = np.unique(np.concatenate(sequences)) if sequences else np.zeros(0, np.uint64)
        numbered = [np.searchsorted(self.vocab, s) for s in sequences]
        pairs = [s[:-1] * len(self.vocab) + s[1:] for s in numbered]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self._build(numbered)

    def _build(self, sequences: list[np.ndarray]) -> None:
        n = len(self.vocab)
        step: list[dict[int, int]] = [{}]
        link, size, last = [-1], [0], 0
        symbols = (x for k, s in enumerate(sequences) for x in (*s.tolist(), n + k))
        for x in symbols:
            step.append({})
            size.append(size[last] + 1)
            link.append(0)
            new, p, last = len(step) - 1, last, len(step) - 1
            while p >= 0 and x not in step[p]:
                step[p][x] = new
                p = link[p]
            if p < 0:
                continue
            q = step[p][x]
            if size[q] == size[p] + 1:
                link[new] = q
                continue
            step.append(dict(step[q]))
            size.append(size[p] + 1)
            link.append(link[q])
            copy = len(step) - 1
            while p >= 0 and step[p].get(x) == q:
                step[p][x] = copy
                p = link[p]
            link[q] = link[new] = copy
        keys = [(s * n + x, t) for s, edges in enumerate(step) for x, t in edges.items() if x < n]
        keys.sort()
        self.keys = np.array([k for k, _ in keys], dtype=np.int64)
        self.to = np.array([t for _, t in keys], dtype=np.int64)
        self.link, self.size = np.array(link, dtype=np.int64), np.array(size, dtype=np.int64)

    def match_lengths(self, words: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Longest match that ends at every word of the stretches; 0 elsewhere."""
        out = np.zeros(len(words), dtype=np.int64)
        if not len(begin):
            return out
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        n = len(self.vocab)
        state = np.zeros(len(begin), dtype=np.int64)
        size = np.zeros(len(begin), dtype=np.int64)
        alive = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right")
        for t, k in enumerate(alive.tolist()):
            x = words[begin[:k] + t]
            open_ = np.arange(k)
            while len(open_):
                key = state[open_] * n + x[open_]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = self.keys[at] == key
                hit = open_[ok]
                state[hit] = self.to[at[ok]]
                size[hit] += 1
                back = open_[~ok]
                root = state[back] == 0
                size[back[root]] = 0
                back = back[~root]
                state[back] = self.link[state[back]]
                size[back] = self.size[state[back]]
                open_ = back
            out[begin[:k] + t] = size[:k]
        return out

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int, set[str], list]]]:
        """Words of every text; per text with windows: (row, hit words, items,
        byte spans of the hit stretches)."""
        buf, at = T.flat(texts)
        starts, ends = T.spans(buf, WORD)
        rows = T.word_rows(starts, at)
        counts = np.diff(rows)
        if not len(self.vocab) or not len(starts):
            return counts, []
        h = T.word_hashes(buf, starts, ends)
        number = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        known = self.vocab[number] == h
        row = np.repeat(np.arange(len(texts)), counts)
        joined = known[:-1] & known[1:] & (row[:-1] == row[1:])
        where = np.flatnonzero(joined)
        if len(self.pairs):
            pair = number[where] * len(self.vocab) + number[where + 1]
            i = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[where[self.pairs[i] != pair]] = False
        else:
            joined[:] = False
        edge = np.flatnonzero(~np.concatenate([[False], joined]))  # first words of the stretches
        length = np.diff(np.append(edge, len(h)))
        chosen = known[edge] & (length >= self.least)
        match = self.match_lengths(number, edge[chosen], length[chosen])
        out = []
        cut = np.searchsorted(cand := np.flatnonzero(match >= self.least), rows)
        for r in np.flatnonzero(np.diff(cut)).tolist():
            lo, hi = int(rows[r]), int(rows[r + 1])
            words = _words(buf, starts[lo:hi], ends[lo:hi])
            hit = np.zeros(hi - lo, dtype=bool)
            items: set[str] = set()
            for i in cand[cut[r]:cut[r + 1]].tolist():
                for k in [*self.shorter, self.window]:
                    if k <= match[i]:
                        named = self.windows.get(b" ".join(words[i - lo - k + 1:i - lo + 1]))
                        if named:
                            hit[i - lo - k + 1:i - lo + 1] = True
                            items |= named
            if items:
                d = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
                out.append((r, items, [(int(a), int(b)) for a, b in zip(
                    np.flatnonzero(d == 1), np.flatnonzero(d == -1), strict=True)]))
        return counts, out


def _words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    if not len(starts):
        return []
    lo = int(starts[0])
    data = T.LOWER[buf[lo:int(ends[-1])]].tobytes()
    return [data[a:b] for a, b in zip((starts - lo).tolist(), (ends - lo).tolist(), strict=True)]


def _blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[int, Iterable[list[tuple[str, bytes]]]]:
    """The number of blocks of bounded text, and the items block by block; one block at a time is on the driver."""
    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
                         F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    block = lambda b: named if n == 1 else named.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == b)
    return n, ([(r[0], r[1].encode()) for r in block(b).collect()] for b in range(n))


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
               text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
               carry: bool = False) -> DataFrame:
    """One row per document: its id (with ``carry`` all its columns, under
    ``doc``), ``n_words``, ``hits`` (word intervals, end exclusive, merged) and
    ``items`` (ids of items with occurring windows, as sorted strings)."""
    rows, text_at, last = _passes(docs, items, window, docs.columns if carry else [id_col, text_col], text_col, item_id_col, item_text_col)
    rows = _pass(rows, last, text_at, rows.schema)
    return rows if carry else rows.select(F.col("doc")[id_col].alias(id_col), "n_words", "hits", "items")


def _passes(docs: DataFrame, items: DataFrame, window: int, names: list[str], text_col: str, item_id_col: str, item_text_col: str):
    """What earlier passes have found, the text's place in ``doc``, and the last pass's automaton."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"))
    text_at = names.index(text_col)
    nothing = [F.expr(f"cast(array() as {_FOUND})"), F.expr("cast(array() as array<string>)")]
    n, blocks = _blocks(items, item_id_col, item_text_col)
    if n > 1:
        rows = T.kept(rows.withColumn("key", F.monotonically_increasing_id()), "items-docs")
        parts = []
        for k, block in enumerate(blocks):
            automaton = sc.broadcast(SuffixAutomaton(block, window))
            if k < n - 1:
                parts.append(T.kept(_places(rows, automaton, text_at), "items-places"))
                automaton.destroy()
        found = parts[0]
        for more in parts[1:]:
            found = found.union(more)
        found = found.groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        rows = rows.join(found, "key", "left").select("doc", F.lit(0).cast("bigint").alias("n_words"), F.coalesce("hits", nothing[0]).alias("hits"),
                                                      F.coalesce("items", nothing[1]).alias("items"))
    else:
        rows = rows.select("doc", F.lit(0).cast("bigint").alias("n_words"), nothing[0].alias("hits"), nothing[1].alias("items"))
        automaton = sc.broadcast(SuffixAutomaton(next(iter(blocks)), window))
    return rows, text_at, automaton


def _places(rows: DataFrame, automaton, text_at: int) -> DataFrame:
    """``key``, ``hits`` and ``items`` of the documents that hold items of one block."""
    def fn(batches):
        for batch in batches:
            flat = pa.RecordBatch.from_arrays([batch.column(0).field(text_at), batch.column(1)], names=["text", "key"])
            for part in T.slices(flat, "text"):
                _, found = automaton.value.find(T.raw(part.column(0)))
                if found:
                    keys = part.column(1).to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(keys[r]) for r, _, _ in found], pa.int64()),
                         pa.array([[{"start": a, "end": b} for a, b in spans] for _, _, spans in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         pa.array([sorted(named) for _, named, _ in found], pa.list_(pa.string()))], names=["key", "hits", "items"])

    T.bounded_batches(rows.sparkSession)
    return rows.mapInArrow(fn, f"key bigint, hits {_FOUND}, items array<string>")


def _pass(rows: DataFrame, automaton, text_at: int, schema: StructType, finish=None) -> DataFrame:
    """Find one block's items; ``finish`` makes the result of the documents, their
    numbers of words, hits and items."""
    hit_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = rows.columns

    def plain(doc, counts, hits, items):
        return pa.RecordBatch.from_arrays([doc, pa.array(counts, pa.int64()), pa.array(hits, hit_type), pa.array(items, pa.list_(pa.string()))], names=names)

    def fn(batches):
        for batch in batches:
            doc = batch.column(0)
            flatrow = pa.RecordBatch.from_arrays([doc.field(text_at), *batch.columns], names=["text", *names])
            for part in T.slices(flatrow, "text"):
                counts, found = automaton.value.find(T.raw(part.column(0)))
                hits, items = part.column(3).to_pylist(), part.column(4).to_pylist()
                fresh = {r: (named, spans) for r, named, spans in found}
                for r in sorted({*fresh, *(r for r, h in enumerate(hits) if h)}):
                    named, spans = fresh.get(r, ((), []))
                    old = [(x["start"], x["end"]) for x in hits[r]]
                    hits[r] = [{"start": a, "end": b} for a, b in _merged(old + spans)]
                    items[r] = sorted({*items[r], *named})
                out = (finish or plain)(part.column(1), counts, hits, items)
                if out.num_rows:
                    yield out

    T.bounded_batches(rows.sparkSession)
    return rows.mapInArrow(fn, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5,
                  text_col: str = "text", length_col: str | None = "n_chars", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """The documents without the hit stretches of their text; documents of whose
    words more than ``max_coverage`` are hit go.  All columns stay; ``length_col``
    follows the new text."""
    names = docs.columns
    rows, text_at, last = _passes(docs, items, window, names, text_col, item_id_col, item_text_col)
    count = length_col if length_col in names else None

    def cut(doc, counts, hits, _):
        batch = pa.RecordBatch.from_struct_array(doc)
        covered = np.array([sum(h["end"] - h["start"] for h in x) for x in hits])
        stay = covered <= counts * max_coverage
        changed = [i for i, h in enumerate(hits) if h and stay[i]]
        if changed:
            col = batch.column(text_at)
            new, texts = col.to_pylist(), T.raw(col)
            for r in changed:
                buf, _ = T.flat([texts[r]])
                starts, ends = T.spans(buf, WORD)
                out, at = [], 0
                for h in hits[r]:
                    out.append(texts[r][at:int(starts[h["start"]])])
                    at = int(ends[h["end"] - 1])
                new[r] = b"".join([*out, texts[r][at:]]).decode()
            more = {count: lengths(batch, names.index(count), changed, new)} if count else {}
            batch = replaced(batch, names, {text_col: new} | more)
        return batch.filter(pa.array(stay))

    return _pass(rows, last, text_at, docs.schema, cut)
