"""BPE encoding and decoding by batched numpy merge rounds.

For vocabularies in the JSON form of the public ``tokenizers`` library with a
word-end suffix: NFC, lower case per character, a split pattern, byte-level
symbols, merges by rank.  The words of a batch that are not yet known lie as
symbol numbers in one flat array; in every round each word's lowest-rank
neighbouring pair is found by binary search over the sorted pair keys, and all
its places in that word are merged at once, until no word has a pair left.
Encoded words stay in a bounded table of the worker.

Edge cases: a null or empty text has no tokens and decodes to the empty text;
repeated rows are encoded row by row; very long texts and words are encoded
whole; an empty table gives no rows; other columns are ignored or passed on.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from . import _text as T

CACHE_CHUNKS = 300_000
LONG = 512


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows, one after another, and each row's length."""
    begin, size = at[rows], at[rows + 1] - at[rows]
    where = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    return flat[where], size


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.size = 1 + max(max(vocab.values()), *(t["id"] for t in spec["added_tokens"]))
        self.strings = [""] * self.size
        for s, i in vocab.items():
            self.strings[i] = s
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.added.items():
            self.strings[i] = s
        self.symbol = np.array([vocab[s] for s in byte_symbols()], dtype=np.int64)
        self.final = np.array([vocab[s + suffix] for s in byte_symbols()], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.rank_of: dict[int, int] = {}  # for long words, filled when one comes
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(rf"{pattern}|\n")
        self.special = re.compile("(" + ("|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)) or "(?!)") + ")")
        self.clear()

    def clear(self) -> None:
        """Forget the known chunks."""
        self.hashes = np.zeros(0, dtype=np.uint64)  # sorted
        self.rows = np.zeros(0, dtype=np.int64)     # their rows in flat
        self.flat = np.zeros(0, dtype=np.int64)
        self.at = np.zeros(1, dtype=np.int64)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of every text.  Added tokens are recognised before anything else."""
        if not any(self.special.search(t) for t in texts):
            return self._encode([normalised(t).encode() for t in texts])
        parts = [self.special.split(t) for t in texts]  # plain, added, plain, ...
        ids = iter(self._encode([normalised(x).encode() for p in parts for x in p[::2]]))
        return [np.concatenate([np.array([self.added[x]], "<u4") if k % 2 else next(ids) for k, x in enumerate(p)]) for p in parts]

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Of normalised texts.  Chunks between ASCII white space, which no word
        contains, are told apart by 64-bit hashes; each distinct one is encoded once."""
        if len(self.hashes) > CACHE_CHUNKS:
            self.clear()
        buf, at = T.flat(texts)
        starts, ends = T.spans(buf, T.NOT_SPACE)
        cut = T.word_rows(starts, at)
        distinct, where, back = np.unique(T.word_hashes(buf, starts, ends, fold=False), return_index=True, return_inverse=True)
        if len(self.hashes):
            k = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
            fresh = self.hashes[k] != distinct
        else:
            fresh = np.ones(len(distinct), dtype=bool)
        if fresh.any():
            data = buf.tobytes()
            base = len(self.at) - 1
            self._learn([data[a:b].decode() for a, b in zip(starts[where[fresh]].tolist(), ends[where[fresh]].tolist(), strict=True)])
            hashes = np.concatenate([self.hashes, distinct[fresh]])
            rows = np.concatenate([self.rows, base + np.arange(int(fresh.sum()))])
            order = np.argsort(hashes)
            self.hashes, self.rows = hashes[order], rows[order]
        rows = self.rows[np.searchsorted(self.hashes, distinct)][back] if len(distinct) else np.zeros(0, np.int64)
        flat, size = _gather(self.flat, self.at, rows)
        total = np.concatenate([[0], np.cumsum(size)])[cut]
        flat = flat.astype("<u4")
        return [flat[a:b] for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True)]

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks that are not yet known and add them in this order."""
        words = self.words.findall("\n".join([*chunks, ""]))  # a newline after each chunk
        number = dict.fromkeys(words)
        distinct = [w for w in number if w != "\n"]
        number = dict(zip(distinct, range(len(distinct)), strict=True)) | {"\n": -1}
        seq = np.array(list(map(number.__getitem__, words)), dtype=np.int64)
        ids, at = self.merge([w.encode() for w in distinct])
        stop = np.flatnonzero(seq < 0)
        flat, size = _gather(ids, at, seq[seq >= 0])
        ends = np.concatenate([[0], np.cumsum(size)])[stop - np.arange(len(stop))]
        self.at = np.concatenate([self.at, len(self.flat) + ends])
        self.flat = np.concatenate([self.flat, flat])

    def merge_long(self, sym: list[int]) -> np.ndarray:
        """Symbols of one word, merged one pair at a time: the lowest rank first, from the left."""
        if not self.rank_of:
            self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        n, rank_of, size = len(sym), self.rank_of, self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of.get(sym[i] * size + sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if sym[i] < 0 or j >= n or rank_of.get(sym[i] * size + sym[j]) != r:
                continue  # one of the two has been merged since
            sym[i], sym[j] = int(self.merged[r]), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of.get(sym[i] * size + sym[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank_of.get(sym[h] * size + sym[i])) is not None:
                heapq.heappush(heap, (r, h))
        out = np.array(sym, dtype=np.int64)
        return out[out >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in one array, merged round by round; and where
        each word begins (one more entry for the end)."""
        count = np.array([len(w) for w in words], dtype=np.int64)
        buf = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym = self.symbol[buf]
        ends = np.cumsum(count) - 1
        sym[ends] = self.final[buf[ends]]
        word = np.repeat(np.arange(len(words)), count)
        done_sym, done_word = [], []
        if (count > LONG).any():
            for w in np.flatnonzero(count > LONG).tolist():
                done_sym.append(self.merge_long(sym[ends[w] + 1 - count[w]:ends[w] + 1].tolist()))
                done_word.append(np.full(len(done_sym[-1]), w))
            short = np.repeat(count <= LONG, count)
            sym, word = sym[short], word[short]
        none = np.int64(len(self.keys))
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(ok, self.ranks[at], none), none)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(word)))
            finished = best == none
            if finished.any():  # words without a pair leave the array
                leave = np.repeat(finished, size)
                done_sym.append(sym[leave])
                done_word.append(word[leave])
                sym, word, rank = sym[~leave], word[~leave], rank[~leave]
                best, size = best[~finished], size[~finished]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)  # aaa: every second place, from the left
            offset = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            hit = hit[(offset & 1) == 0]
            sym[hit] = self.merged[rank[hit]]
            stay = np.ones(len(sym), dtype=bool)
            stay[hit + 1] = False
            sym, word = sym[stay], word[stay]
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        at = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bincount(word, minlength=len(words)), out=at[1:])
        return sym[order], at

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary's own strings joined by a space (its file names no
        decoder), special ones too."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def normalised(text: str) -> str:
    """NFC and lower case per character (no final sigma, unlike ``str.lower``)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as f:
        return WordBpe(json.load(f))


def encode(docs: DataFrame, path: str | None = None, id_col: str | None = "doc_id", text_col: str = "text",
           carry: bool = False) -> DataFrame:
    """One row per document: its id (with ``carry`` all columns of ``docs``),
    ``ids`` (array of int) and ``n_tokens``.  The vocabulary file has to be at
    ``path`` on every machine, as the installed package that holds it is."""
    where = path or default_path()
    names = docs.columns if carry else [id_col, text_col]
    fields = [f for f in docs.schema.fields if f.name in names and (carry or f.name == id_col)]
    schema = T.schema(fields, "ids array<int>, n_tokens bigint")
    text_at = names.index(text_col)
    keep = list(range(len(names))) if carry else [0]

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = tokenizer(where).encode_batch([t.decode() for t in T.raw(batch.column(text_at))])
        n = np.array([len(x) for x in ids], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        values = pa.array(np.concatenate(ids).view(np.int32) if ids else np.zeros(0, np.int32), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.array(n, pa.int64())],
            names=schema.names)

    return T.map_groups(docs.select([f"`{c}`" for c in names]), fn, schema, text_col)


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the decoded text of its token ids; null ids
    decode to the empty text."""
    where = path or default_path()
    schema = T.schema(encoded.schema.fields, f"`{out_col}` string")
    at = encoded.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            t = tokenizer(where)
            ids = batch.column(at)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0 if x is None else x for x in pc.list_value_length(ids).to_pylist()]).tolist()
            texts, a = [], 0
            for b in ends:
                texts.append(t.decode(flat[a:b]))
                a = b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    T.bounded_batches(encoded.sparkSession)
    return encoded.mapInArrow(run, schema)
