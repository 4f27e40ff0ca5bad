"""Language identification by a byte convolutional network, trained here in numpy.

Texts are cut into windows of ``WINDOW`` bytes (all of the text, none skipped).
Every byte has a learned vector; filters of several widths run over a window,
each filter's largest value in it is kept, and a softmax layer gives the
probability of each language.  A document's probabilities are the mean over its
windows, weighted by their lengths.

Texts are laid out with spaces between them, as many as the widest filter spans,
and no filter begins where it would see another text: a text's result depends on
that text alone.

Training takes a bounded, documented sample: of every label value the
``PER_LANGUAGE`` labelled documents with the smallest hash of their id, three
windows each (fewer of each where there are so many values that this would pass
``SAMPLE_ROWS`` documents).  The number of filters grows with that of languages.
Rows with ``crc32(id) mod 4 = 2`` are held out.  Everything else covers all documents.

Edge cases: a null text or one without a letter is ``und`` with score 0; a null
language is never learned; without any learned language every document is
``und``; repeated rows are predicted row by row; very long texts are predicted
whole; an empty table gives no rows; other columns are ignored or passed on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as T

WINDOW = 256
WIDTHS = (2, 3, 4)
#: Filters of each width, at least and at most; between, one for each language.
FILTERS, MOST_FILTERS = 8, 64
BYTE_DIM = 6
PER_LANGUAGE = 400
SAMPLE_ROWS = 80_000
SAMPLE_CHARS = 200
EPOCHS = 8
UNDETERMINED = "und"
MIN_CERTAINTY = 0.5
_PAD = b" " * max(WIDTHS)
_LETTER = re.compile(r"[^\W\d_]")


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Network:
    """``byte``: 256 vectors; ``conv``: by width (matrix, bias); ``out``: (matrix, bias)."""

    languages: list[str]
    byte: np.ndarray
    conv: list[tuple[np.ndarray, np.ndarray]]
    out: tuple[np.ndarray, np.ndarray]

    def tables(self) -> list[np.ndarray]:
        """What the two bytes at places 0 and 1, and at 2 and 3, add to every filter
        of every width: one row for each pair of bytes."""
        n = self.conv[0][0].shape[1]
        place = [np.zeros((256, len(WIDTHS) * n), np.float32) for _ in range(max(WIDTHS) + max(WIDTHS) % 2)]
        for k, (w, (m, bias)) in enumerate(zip(WIDTHS, self.conv, strict=True)):
            for j in range(w):
                place[j][:, k * n:(k + 1) * n] = self.byte @ m[j * BYTE_DIM:(j + 1) * BYTE_DIM] + (bias if j == 0 else 0)
        return [(place[j][:, None] + place[j + 1][None]).reshape(65536, -1) for j in range(0, len(place), 2)]

    def probabilities(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Of each window, whose filters begin at the places ``begin`` to ``end`` of the
        buffer; windows follow each other, with gaps where no filter may begin, and
        none is empty.  A filter at the end of a window sees the bytes after it."""
        padded = np.concatenate([buf, np.zeros(2 * len(tables), np.uint8)]).astype(np.int32)
        pair = padded[:-1] * 256 + padded[1:]
        pooled = []
        for lo in range(0, len(begin), 64):  # some windows at a time stay in cache
            a, e = int(begin[lo]), int(end[min(lo + 64, len(end)) - 1])
            z = tables[0].take(pair[a:e], axis=0)
            for j in range(1, len(tables)):
                z += tables[j].take(pair[a + 2 * j:e + 2 * j], axis=0)
            edges = np.column_stack([begin[lo:lo + 64], end[lo:lo + 64]]).ravel() - a
            pooled.append(np.maximum.reduceat(z, edges[:-1], axis=0)[::2])  # windows and, in between, gaps
        return _softmax(np.maximum(np.concatenate(pooled), 0) @ self.out[0] + self.out[1])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: list[bytes], labels: list[int], languages: list[str], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Adam on cross entropy; windows are padded by spaces to ``WINDOW`` bytes."""
    rng = np.random.default_rng(seed)
    x = np.full((len(windows), WINDOW), 32, dtype=np.uint8)
    for i, b in enumerate(windows):
        x[i, :min(len(b), WINDOW)] = np.frombuffer(b[:WINDOW], np.uint8)
    y = np.array(labels)
    scale = lambda *shape: (rng.standard_normal(shape) * (1.5 / np.sqrt(shape[0]))).astype(np.float32)
    p = [rng.standard_normal((256, BYTE_DIM)).astype(np.float32)]
    filters = min(MOST_FILTERS, max(FILTERS, len(languages)))
    for w in WIDTHS:
        p += [scale(w * BYTE_DIM, filters), np.zeros(filters, np.float32)]
    p += [scale(len(WIDTHS) * filters, len(languages)), np.zeros(len(languages), np.float32)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 32):
            step += 1
            g = _gradients(p, x[order[at:at + 32]], y[order[at:at + 32]])
            for i in range(len(p)):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                p[i] -= 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    conv = [(p[1 + 2 * k], p[2 + 2 * k]) for k in range(len(WIDTHS))]
    return Network(languages, p[0], conv, (p[-2], p[-1]))


def _gradients(p: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    (n, length), filters = x.shape, p[1].shape[1]
    e = p[0][x]
    cols, best, pooled = [], [], []
    for k, w in enumerate(WIDTHS):
        c = np.concatenate([e[:, j:length - w + 1 + j] for j in range(w)], axis=2)
        z = c @ p[1 + 2 * k]
        b = z.argmax(axis=1)
        cols.append(c)
        best.append(b)
        pooled.append(np.maximum(np.take_along_axis(z, b[:, None], 1)[:, 0] + p[2 + 2 * k], 0))
    h = np.concatenate(pooled, axis=1)
    d = _softmax(h @ p[-2] + p[-1])
    d[np.arange(n), y] -= 1
    d /= n
    back = (d @ p[-2].T) * (h > 0)
    g = [np.zeros_like(p[0])]
    for k, w in enumerate(WIDTHS):
        dz = back[:, k * filters:(k + 1) * filters]
        seen = cols[k][np.arange(n)[:, None], best[k]]  # window, filter, what the filter saw
        g += [np.einsum("nfc,nf->cf", seen, dz), dz.sum(axis=0)]
        into = np.einsum("nf,cf->nfc", dz, p[1 + 2 * k]).reshape(n, filters, w, BYTE_DIM)
        bytes_ = x[np.arange(n)[:, None, None], best[k][:, :, None] + np.arange(w)]
        np.add.at(g[0], bytes_.ravel(), into.reshape(-1, BYTE_DIM))
    return [*g, h.T @ d, d.sum(axis=0)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Network | None:
    """A network from the bounded sample of labelled rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id") & F.col("text").rlike(r"\p{L}"))
    counts = docs.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(label_col).alias("lang")).count().collect()
    if not counts:
        return None
    per_language = max(1, min(per_language, SAMPLE_ROWS // len(counts)))
    # Of n rows about twice the wanted number by hash; the smallest hashes of those are taken.
    h = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 40))
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(int(min(1.0, (2 * per_language + 50) / r["count"]) * (1 << 40))))])
    at = F.length("text") - SAMPLE_CHARS
    cut = [F.substring("text", F.lit(1), F.lit(SAMPLE_CHARS)), F.substring("text", F.greatest(F.lit(1), (at / 2).cast("int")), F.lit(SAMPLE_CHARS)),
           F.substring("text", F.greatest(F.lit(1), at + 1), F.lit(SAMPLE_CHARS))]
    sample = (rows.where(h < F.element_at(share, F.col("lang"))).select("lang", h.alias("h"), F.array(*cut).alias("windows"))
              .limit(4 * len(counts) * (per_language + 50)).collect())
    sample.sort(key=lambda r: (r["lang"], r["h"], r["windows"]))
    languages = sorted({r["lang"] for r in sample})
    taken: dict[str, int] = {}
    windows, labels = [], []
    for r in sample:
        if taken.setdefault(r["lang"], 0) < per_language:
            taken[r["lang"]] += 1
            for w in sorted(set(r["windows"])):
                if _LETTER.search(w):
                    windows.append(w.encode()[:WINDOW])
                    labels.append(languages.index(r["lang"]))
    return fit(windows, labels, languages) if windows else None


def predict_texts(net: Network, tables: list[np.ndarray], texts: list[bytes]) -> tuple[list[str], list[float], list[float]]:
    """Language, score and certainty of every text: the mean probability of that language, and
    the mean over the windows of whichever language is likeliest in each."""
    buf = np.frombuffer(b"".join(t + _PAD for t in texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) + len(_PAD) for t in texts])])
    begin, end, row = [], [], []
    for i, (a, t) in enumerate(zip(at[:-1].tolist(), texts, strict=True)):
        cut = np.arange(a, a + len(t) + 1, WINDOW)  # the last filter begins right after the text
        begin.append(cut)
        end.append(np.append(cut[1:], a + len(t) + 1))
        row.append(np.full(len(cut), i))
    begin, end, row = np.concatenate(begin), np.concatenate(end), np.concatenate(row)
    weight, first = (end - begin)[:, None], np.searchsorted(row, np.arange(len(texts)))
    p = net.probabilities(buf, begin, end, tables) * weight
    share = np.add.reduceat(weight, first, axis=0)
    total = np.add.reduceat(p, first, axis=0) / share
    certain = np.add.reduceat(p.max(axis=1, keepdims=True), first, axis=0) / share
    best = total.argmax(axis=1)
    langs, scores, sure = [], [], []
    for i, t in enumerate(texts):
        if _LETTER.search(t.decode()):
            langs.append(net.languages[best[i]])
            scores.append(float(min(1.0, total[i, best[i]])))
            sure.append(float(min(1.0, certain[i, 0])))
        else:
            langs.append(UNDETERMINED)
            scores.append(0.0)
            sure.append(0.0)
    return langs, scores, sure


def predict(docs: DataFrame, net: Network | None, id_col: str | None = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Per document: its id (with ``carry`` all columns, under ``doc``),
    ``lang_pred``, ``score`` and ``certainty``."""
    names = docs.columns if carry else [id_col, text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col(text_col).alias("text"))
    schema = T.schema([T.field(rows, "doc", "doc")], "lang_pred string, score double, certainty double")
    tables = net.tables() if net else []

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = T.raw(batch.column(1))
        langs, scores, sure = predict_texts(net, tables, texts) if net else ([UNDETERMINED] * len(texts), *[[0.0] * len(texts)] * 2)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.float64())],
                                          names=schema.names)

    out = T.map_groups(rows, fn, schema)
    return out if carry else out.select(F.col("doc")[id_col].alias(id_col), "lang_pred", "score", "certainty")


def accepted(docs: DataFrame, min_certainty: float = MIN_CERTAINTY, **cols: str) -> DataFrame:
    """The documents whose windows' languages are recognised with a mean probability of at
    least ``min_certainty``; a document in several of the languages stays."""
    net = train(docs, **cols)
    found = predict(docs, net, text_col=cols.get("text_col", "text"), carry=True)
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("certainty") >= min_certainty)).select("doc.*")
