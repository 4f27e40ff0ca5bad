"""Phrase collocations by direct-address tiling.

Words get ids by falling frequency within their language, so that frequent pairs
of ids crowd into few tiles of ``TILE`` by ``TILE`` addresses.  In a part of the
corpus every tile with many pairs is counted directly, by one ``bincount`` over its
addresses; the pairs of all other tiles are sorted into coordinates and counts.
The parts' counts are added up by Spark.  Pairs that are frequent get ids in
turn, by their own falling frequency, and take the place of the words: a pair of
neighbouring pairs is a phrase of three words, a pair of those one of four.

A phrase is frequent only if both phrases that overlap in it are, so only pairs of
ids are ever looked at; all frequent phrases are found.  Each level goes like this:

* the parts' distinct keys with counts (``keys``, ``counts``) meet by key, in one
  shuffle; those of ``LEAST`` or more in their language go on and are ranked;
* the ranks travel back to the parts that hold the keys (a join by key, then one
  by part, each bounded by the frequent keys of a part);
* the part's symbols are rewritten and the pairs of the next level counted; the
  tables of the level below are deleted.

Nothing but languages is ever held whole: a hot word is one row a part.  Ids are
32-bit: more than 2^31 frequent words or phrases of one language are an error (of the
cast to int).

Scoring uses, for every phrase, the counts of its leading and trailing parts, which
are handed down from the two phrases that it was made of.  A phrase inside a longer
one also lies in one that is a single word longer and at least as frequent, so a look
at those decides which phrases a longer one explains.

Edge cases: a null language is ``und``; a null text is empty; a text or piece without
words has no phrase; phrases never cross a piece or a text; texts of any length are
read whole; repeated rows count again; ties are settled by the order stated; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import _text as T

LONGEST, LEAST, TOP = 4, 30, 2000
SCORE_SCALE, EXPLAINED_PERCENT = 2_000_000, 80
UNKNOWN = "und"
#: Text of a part; keys of a row; addresses of a tile's side; a tile with a pair for every
#: ``DENSE``-th address is counted directly, ``TILES`` of them at once.
PART_BYTES, ROW_KEYS = 16 << 20, 1 << 16
TILE, DENSE, TILES = 512, 16, 32

BLANK = T.byte_class(lambda b: b in (0x20, 0x09))
BREAK = T.byte_class(lambda b: b in b".,;:!?" or 0x0A <= b <= 0x0D)
WORD = ~(BLANK | BREAK)

WORDS = "part bigint, lang string, seq binary, first bigint, keys array<string>, counts array<bigint>"
PAIRS = "part bigint, lang string, seq binary, first bigint, keys array<bigint>, counts array<bigint>"


def _packed(symbols: np.ndarray) -> bytes:
    """Symbols as four planes of bytes, compressed: the high bytes of ids are mostly alike."""
    planes = np.ascontiguousarray(symbols.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _rows(part: int, lang: str, symbols: np.ndarray, keys, counts: np.ndarray, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A part's symbols, and its keys in rows of ``ROW_KEYS``; the first row holds the symbols."""
    for a in range(0, max(1, len(keys)), ROW_KEYS):
        b = a + ROW_KEYS
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([lang], pa.string()), pa.array([None if a else _packed(symbols)], pa.binary()), pa.array([a], pa.int64()),
             pa.array([keys[a:b]], pa.list_(key)), pa.array([counts[a:b]], pa.list_(pa.int64()))],
            names=["part", "lang", "seq", "first", "keys", "counts"])


# -- words ------------------------------------------------------------------------------

@dataclass
class _Words:
    """Words of one language in a part, group by group."""
    codes: list = field(default_factory=list)
    hashes: list = field(default_factory=list)
    words: list = field(default_factory=list)
    n: int = 0

    def add(self, texts: list[bytes]) -> None:
        buf, at = T.flat(texts)
        starts, ends = T.spans(buf, WORD)
        if not len(starts):
            return
        codes, distinct = pd.factorize(T.word_hashes(buf, starts, ends))
        place = np.empty(len(distinct), dtype=np.int64)
        place[codes[::-1]] = np.arange(len(codes))[::-1]
        folded = T.LOWER[buf].tobytes()
        self.words += [folded[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist(), strict=True)]
        breaks = np.concatenate([[0], np.cumsum(BREAK[buf])])
        apart = np.concatenate([[0], (breaks[starts[1:]] > breaks[ends[:-1]])]).astype(np.int64)
        symbols = np.full(len(codes) + int(apart.sum()) + 1, -1, dtype=np.int64)
        symbols[np.arange(len(codes)) + np.cumsum(apart)] = codes + self.n
        self.codes.append(symbols)
        self.hashes.append(distinct)
        self.n += len(distinct)

    def rows(self, part: int, lang: str) -> Iterator[pa.RecordBatch]:
        same, distinct = pd.factorize(np.concatenate(self.hashes))
        words: list = [None] * len(distinct)
        for c, w in zip(same.tolist(), self.words, strict=True):
            words[c] = w
        symbols = np.append(same, -1)[np.concatenate(self.codes)]
        counts = np.bincount(symbols[symbols >= 0], minlength=len(words))
        yield from _rows(part, lang, symbols, [w.decode() for w in words], counts, pa.string())


def _parts(batches: Iterator[pa.RecordBatch], part_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts (``lang``, ``text``) to parts with words as symbols."""
    task, made, size = TaskContext.get().partitionId(), 0, 0
    langs: dict[str, _Words] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal made
        for lang, words in langs.items():
            if words.n:
                yield from words.rows((task << 32) + made, lang)
        made += 1
        langs.clear()

    for batch in batches:
        for group in T.slices(batch, "text"):
            texts, by = T.raw(group.column("text")), {}
            for lang, text in zip(group.column("lang").to_pylist(), texts, strict=True):
                by.setdefault(lang, []).append(text)
            for lang, some in by.items():
                langs.setdefault(lang, _Words()).add(some)
            size += sum(map(len, texts))
            if size >= part_bytes:
                yield from flush()
                size = 0
    yield from flush()


# -- pairs ------------------------------------------------------------------------------

def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of ids as ``left << 32 | right``, and how often each occurs."""
    if not len(left):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    left, right = left.astype(np.int64), right.astype(np.int64)
    # Only the tiles of the most frequent ids can be dense: look at as many as there can be.
    side = int(np.sqrt(len(left) * DENSE)) // TILE + 1
    grid = side * side
    inside = (left < side * TILE) & (right < side * TILE)
    at = np.where(inside, (left // TILE) * side + right // TILE, grid)
    crowded = np.append(np.bincount(at[inside], minlength=grid) * DENSE >= TILE * TILE, False)
    dense = crowded[at]
    keys, counts = [], []
    tiles = np.flatnonzero(crowded)
    for a in range(0, len(tiles), TILES):
        some = tiles[a:a + TILES]
        number = np.full(grid + 1, -1, dtype=np.int64)
        number[some] = np.arange(len(some))
        here = number[at]
        pick = here >= 0
        cells = np.bincount((here[pick] * TILE + left[pick] % TILE) * TILE + right[pick] % TILE, minlength=len(some) * TILE * TILE)
        full = np.flatnonzero(cells)
        t, i, j = some[full // (TILE * TILE)], full // TILE % TILE, full % TILE
        keys.append((t // side * TILE + i) << 32 | (t % side * TILE + j))
        counts.append(cells[full])
    rest = np.sort(left[~dense] << 32 | right[~dense])
    if len(rest):
        begin = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        keys.append(rest[begin])
        counts.append(np.diff(np.append(begin, len(rest))))
    return np.concatenate(keys), np.concatenate(counts)


def _symbols(seq: np.ndarray, at: np.ndarray, rank: np.ndarray, words: bool) -> np.ndarray:
    """The part's symbols one level up; -1 where there is no frequent one."""
    if words:
        table = np.full(max(int(seq.max(initial=-1)), int(at.max(initial=-1))) + 2, -1, dtype=np.int64)
        table[at] = rank
        return table[seq]  # -1 is the last place
    order = np.argsort(at)
    at, rank = at[order], rank[order].astype(np.int64)
    left, right = seq[:-1].astype(np.int64), seq[1:].astype(np.int64)
    out = np.full(len(left), -1, dtype=np.int64)
    both = np.flatnonzero((left >= 0) & (right >= 0))
    key = left[both] << 32 | right[both]
    place = np.minimum(np.searchsorted(at, key), len(at) - 1)
    found = at[place] == key
    out[both[found]] = rank[place[found]]
    return out


def _next_level(words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                values = lambda c, one=one: one.column(c).flatten().to_numpy(zero_copy_only=False)
                s = _symbols(_unpacked(one.column("seq")[0].as_py()), values("at"), values("rank"), words)
                both = (s[:-1] >= 0) & (s[1:] >= 0)
                if both.any():
                    keys, counts = count_pairs(s[:-1][both], s[1:][both])
                    yield from _rows(one.column("part")[0].as_py(), one.column("lang")[0].as_py(), s, keys, counts, pa.int64())

    return run


# -- levels -----------------------------------------------------------------------------

def _occurring(level: DataFrame, least: int, words: bool) -> DataFrame:
    """The frequent keys of every part: ``lang``, ``key``, ``part``, ``at`` (place among the
    part's words, or the key) and ``a``, the count in the language.  The parts' counts
    meet in one shuffle by key; what is not frequent ends there."""
    each = level.select("lang", "part", *(["first"] if words else []), F.posexplode(F.arrays_zip("keys", "counts")).alias("pos", "e"))
    at = [(F.col("first") + F.col("pos")).cast("int").alias("at")] if words else []
    each = each.select("lang", F.col("e.keys").alias("key"), "part", *at, F.col("e.counts").alias("count"))
    total = each.withColumn("a", F.sum("count").over(Window.partitionBy("lang", "key"))).where(F.col("a") >= least).drop("count")
    return _written(total, "occurring")


def _frequent(occurring: DataFrame) -> DataFrame:
    """``lang``, ``key``, ``a`` and ``rank`` (from 0, by count descending) of the frequent keys."""
    total = T.kept(occurring.groupBy("lang", "key").agg(F.first("a").alias("a")), "frequent")
    order = ["lang", F.desc("a"), "key"]
    placed = T.kept(total.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    run = F.shiftright("at", 33).alias("run")
    before = Window.partitionBy("lang").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("lang", run).agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("n")).select(
        "lang", "run", "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return T.kept(placed.select("lang", "key", "a", "at", run).join(runs, ["lang", "run"])
                  .select("lang", "key", "a", (F.col("at") - F.col("begin") + F.col("before")).alias("rank")), "symbols")


def _raised(level: DataFrame, occurring: DataFrame, frequent: DataFrame, words: bool) -> DataFrame:
    """The next level: parts rewritten with the ranks of their frequent keys."""
    # two plain lists of one aggregation, in the same order: half the size of a list of pairs
    ranks = occurring.join(frequent.select("lang", "key", F.col("rank").cast("int").alias("rank")), ["lang", "key"]).groupBy("part", "lang").agg(
        F.collect_list("at" if words else "key").alias("at"), F.collect_list("rank").alias("rank"))
    parts = level.where(F.col("seq").isNotNull()).select("part", "lang", "seq")
    T.bounded_batches(level.sparkSession)
    return _written(parts.join(ranks, ["part", "lang"]).select("part", "lang", "seq", "at", "rank")
                    .mapInArrow(_next_level(words), PAIRS), "pairs")


def _written(df: DataFrame, name: str) -> DataFrame:
    """As ``kept``, tightly compressed; ``_removed`` deletes the table when nothing reads it any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def _removed(df: DataFrame) -> None:
    spark, path = df.sparkSession, df._tidemark_path
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _phrases(frequent: DataFrame, shorter: DataFrame | None) -> DataFrame:
    """``phrase``, its ``last`` word, the counts of its leading (``pre``) and trailing
    (``suf``) words by their number, and the ids of the two phrases inside (``left``, ``right``)."""
    one = F.array("a")
    if shorter is None:
        return frequent.select("lang", "rank", "a", F.col("key").alias("phrase"), F.col("key").alias("last"), one.alias("pre"), one.alias("suf"))
    pair = frequent.select("lang", "rank", "a", F.shiftright("key", 32).alias("left"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("right"))
    left = shorter.select("lang", F.col("rank").alias("left"), F.col("phrase").alias("begin"), F.col("pre").alias("led"))
    right = shorter.select("lang", F.col("rank").alias("right"), "last", F.col("suf").alias("trailed"))
    return T.kept(pair.join(left, ["lang", "left"]).join(right, ["lang", "right"]).select(
        "lang", "rank", "a", F.concat_ws(" ", "begin", "last").alias("phrase"), "last",
        F.concat("led", one).alias("pre"), F.concat("trailed", one).alias("suf"), "left", "right"), "phrases")


def _wide(c: str) -> Column:
    """A count as a decimal: products of it may pass 64 bits."""
    return F.col(c).cast("decimal(20,0)")


def _cut(m: int) -> Column:
    """The lowest-scoring cut of a phrase of ``m`` words: ``score``, ``k``, ``l``, ``r``."""
    cuts = []
    for k in range(1, m):
        score = f"CAST((CAST(a AS DECIMAL(20,0)) * {SCORE_SCALE}) DIV (CAST(pre[{k - 1}] AS DECIMAL(20,0)) + suf[{m - k - 1}]) AS BIGINT)"
        cuts.append(F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"), F.col("pre")[k - 1].alias("l"), F.col("suf")[m - k - 1].alias("r")))
    return F.array_min(F.array(*cuts))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang", part_bytes: int = PART_BYTES) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's first
    ``top`` phrases of two to ``LONGEST`` words that occur ``least`` times or more."""
    T.bounded_batches(docs.sparkSession)
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    level = _written(given.mapInArrow(lambda batches: _parts(batches, part_bytes), WORDS), "words")
    sizes = T.kept(level.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x)).alias("n")), "sizes")
    phrases: list[DataFrame] = []
    for m in range(1, LONGEST + 1):
        occurring = _occurring(level, least, m == 1)
        frequent = _frequent(occurring)
        phrases.append(_phrases(frequent, phrases[-1] if phrases else None))
        following = _raised(level, occurring, frequent, m == 1) if m < LONGEST else None
        _removed(level)
        _removed(occurring)
        level = following
    found = []
    for m in range(2, LONGEST + 1):
        some = phrases[m - 1].withColumn("cut", _cut(m))
        if m < LONGEST:
            inside = phrases[m].select("lang", F.explode(F.array("left", "right")).alias("rank"), "a").groupBy("lang", "rank").agg(F.max("a").alias("longer"))
            explained = _wide("longer") * 100 >= _wide("a") * EXPLAINED_PERCENT
            some = some.join(inside, ["lang", "rank"], "left").where(F.col("longer").isNull() | ~explained)
        found.append(some.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(docs.sparkSession.sparkContext.defaultParallelism * 4)).alias("salt")
    best = every.select("*", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    first = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return first.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
