"""Spelling variants: words one edit apart, by blocked Gram matrices of letter counts.

Each word is a row of letter counts (a to z and U+00C0 to U+00FF).  For a
block A of such rows, the product A A' and the rows' squares give all squared
distances at once.  An inserted or deleted letter changes one count by one, so
the distance is 1; a replaced one changes two counts, so it is 2.  Of two words
of the same length the pairs at distance 2, and of lengths that differ by one
those at distance 1, are kept and verified by comparing the letters.

Blocks keep the matrices small.  Words of length n meet words of length n and
n + 1.  If one edit lies behind the first half of the shorter word, both begin
with that half; if not, both end with its other half.  So a word goes into
four blocks: by its first and its last half, for its own length and for the
length before.  A block of more than ``tile`` words is dealt into parts by the
words' hash, and each two of its parts meet in a tile of their own, so no task
holds a whole block and no pair is left out.  Small blocks share one product,
in which pairs of different blocks are masked.

Rows: null and empty texts have no words; repeated rows count again; words of
any length are words, a run of megabytes too; ties in n go to the smallest
word in code-point order; an empty table gives an empty result; extra columns
are ignored.  A null id counts as the empty text where an id is asked for.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import bounded, discard, land, pick

RUN = re.compile("[a-zÀ-ÿ]+")
LETTERS = 26 + 64


@dataclass(frozen=True)
class SpellingParams:
    """Words of at least ``min_length`` code points and ``min_count`` occurrences; a form must occur
    ``form_factor`` times as often."""

    min_length: int = 5
    min_count: int = 3
    form_factor: int = 2
    tile: int = 1024  # words of a block that are multiplied at once
    shared: int = 192  # words of small blocks that share a product
    held_words: int = 200_000  # words that a task sums before it hands them on


# ---- words and their counts ----------------------------------------------------------------------

def words_of(text: str) -> list[str]:
    """The runs of letters, A-Z lowered."""
    return RUN.findall(text.encode().lower().decode())  # bytes.lower knows A-Z only


def _counts(p: SpellingParams, damage: int | None):
    def batch_of(n: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])

    def damaged(run: str, seed: int) -> str:
        h = zlib.crc32(run.encode(), seed)
        return run if h % damage else run[:(at := h % len(run))] + run[at + 1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, int] = {}
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                here: dict[str, int] = {}
                for w in words_of(text.as_py() or ""):
                    here[w] = here.get(w, 0) + 1
                if damage:
                    seed = zlib.crc32(f"{'' if own is None else own}:".encode())
                    for w, c in here.items():
                        w = damaged(w, seed)
                        if len(w) >= p.min_length:
                            n[w] = n.get(w, 0) + c
                else:
                    for w, c in here.items():
                        if len(w) >= p.min_length:
                            n[w] = n.get(w, 0) + c
                if len(n) >= p.held_words:
                    yield batch_of(n)
                    n = {}
        yield batch_of(n)
    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SpellingParams = SpellingParams(),
                damage: int | None = None) -> DataFrame:
    """word, n of the words that are long and frequent enough.  With ``damage`` d, a run whose crc32 h
    (of id, colon and run) is divisible by d first loses its code point h mod length: planted typos."""
    rows = pick(docs, id=id_col, text=text_col)
    counted = rows.mapInArrow(_counts(params, damage), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= params.min_count)


# ---- blocks --------------------------------------------------------------------------------------

def _entries(words: DataFrame) -> DataFrame:
    """block, word, n, len, size: the four blocks of each word; ``size`` is the length of the block's
    shorter words, ``side`` 0 for first halves."""
    n = F.col("len")

    def entry(size, side):
        k = F.floor(size / 2).cast("int")
        half = F.substring("word", 1, k) if side == 0 else F.substring(F.col("word"), (n - (size - k) + 1).cast("int"), (size - k).cast("int"))
        return F.struct(F.xxhash64(half, size, F.lit(side)).alias("block"), F.lit(side).alias("side"), size.cast("int").alias("size"))

    each = F.explode(F.array(*[entry(size, side) for size in (n, n - 1) for side in (0, 1)]))
    return (words.withColumn("len", F.length("word")).select("word", "n", "len", each.alias("e"))
            .select("e.block", "e.side", "e.size", "word", "n", "len"))


def _tiles(entries: DataFrame, p: SpellingParams) -> DataFrame:
    """Adds ``tile`` (what is multiplied together: two parts of a block, the whole block where it is
    small) and ``left``, ``right``: whether the word is a row or a column of the tile."""
    large = land(entries.groupBy("block").agg(F.count("*").alias("c")).where(F.col("c") > p.tile)
                 .select("block", F.ceil(F.col("c") / p.tile).cast("int").alias("parts")))
    rows = entries.join(bounded(large), "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("word", F.lit(7)), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("other", other)
    lo, hi = F.least("part", "other"), F.greatest("part", "other")
    return rows.select(F.when(F.col("parts") == 1, F.col("block")).otherwise(F.xxhash64("block", lo, hi)).alias("tile"),
                       "block", "side", "size", "word", "n", "len",
                       (F.col("part") == lo).alias("left"), (F.col("part") == hi).alias("right"))


# ---- Gram matrices -------------------------------------------------------------------------------

def letter_counts(words: list[str]) -> np.ndarray:
    """A row of counts for each word; exact in single precision as long as the squares are."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.where(codes < 0xC0, codes - 97, codes - 0xC0 + 26)
    lengths = np.array([len(w) for w in words], np.int64)
    row = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(row * LETTERS + codes, minlength=len(words) * LETTERS).reshape(-1, LETTERS)
    return counts.astype(np.float32 if len(lengths) == 0 or lengths.max() < 4096 else np.float64)


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion or replacement makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)
    while lo < hi and a[lo] == b[lo]:  # first difference
        lo += 1
    return a[lo:] == b[lo + 1:] if len(a) < len(b) else a[lo + 1:] == b[lo + 1:]


def near_in_tile(words: list[str], group: np.ndarray, length: np.ndarray, size: np.ndarray, side: np.ndarray,
                 left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the near words of a product: rows that are ``left`` by columns that are
    ``right``, pairs of one ``group`` only, each pair once in all its blocks."""
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    counts = letter_counts(words)
    square = (counts * counts).sum(1)
    gap = square[a][:, None] + square[b][None, :] - 2 * (counts[a] @ counts[b].T)
    step = np.abs(length[a][:, None] - length[b][None, :])
    fits = (gap == 2 - step) & (step <= 1) & (group[a][:, None] == group[b][None, :])
    fits &= (length[a][:, None] == size[a][:, None]) | (length[b][None, :] == size[a][:, None])  # two of size + 1 meet elsewhere
    x, y = np.nonzero(fits)
    i, j = a[x], b[y]
    once = (i < j) | ~(left[j] & right[i])  # pairs inside a part come twice
    i, j = i[once], j[once]
    keep = np.zeros(len(i), bool)
    for at, (u, v) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        s, t, k = words[u], words[v], int(size[u]) // 2
        keep[at] = one_edit(s, t) and not (side[u] == 1 and s[:k] == t[:k])  # that one is found by its first half
    return i[keep], j[keep]


def _near(p: SpellingParams):
    names = ["tile", "side", "size", "word", "n", "len", "left", "right"]

    def multiplied(cols: list) -> pa.RecordBatch:
        tile, side, size, words, n, length, left, right = cols
        i, j = near_in_tile(words, tile, length, size, side, left, right)
        both = np.concatenate([i, j]), np.concatenate([j, i])
        text = pa.array(words, pa.string())
        return pa.RecordBatch.from_arrays(
            [text.take(pa.array(both[0])), pa.array(n[both[0]]), text.take(pa.array(both[1])), pa.array(n[both[1]])],
            names=["word", "n", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by tile: whole tiles, small ones together.  A tile has some 2 * tile rows."""
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch.select(names))
            rows += batch.num_rows
            if rows < 4 * p.tile:
                continue
            done, last = _whole_tiles(held)
            yield from map(multiplied, _products(done, p))
            held, rows = [last], last.num_rows
        if rows:
            done, last = _whole_tiles(held)
            yield from map(multiplied, _products(done, p))
            yield from map(multiplied, _products(last, p))
    return run


def _whole_tiles(held: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The rows before the last tile, and the last tile, which may go on."""
    all_rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    tile = all_rows.column(0).to_numpy()
    cut = int(np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))[-1])
    return all_rows.slice(0, cut), all_rows.slice(cut)


def _products(rows: pa.RecordBatch, p: SpellingParams) -> Iterator[list]:
    """Columns of what is multiplied at once: one large tile, or as many small ones as have ``shared``
    words in all."""
    if rows.num_rows == 0:
        return
    tile = rows.column(0).to_numpy()
    edges = np.append(np.flatnonzero(np.append(True, tile[1:] != tile[:-1])), len(tile))
    lengths = np.diff(edges)
    at = 0
    while at < len(lengths):
        end = int(np.searchsorted(edges, edges[at] + p.shared, "right")) - 1
        end = min(max(end, at + 1), len(lengths))
        if lengths[at:end].max() > 1:
            part = rows.slice(int(edges[at]), int(edges[end] - edges[at]))
            yield [part.column(c).to_pylist() if c == 3 else part.column(c).to_numpy(zero_copy_only=False) for c in range(8)]
        at = end


def near_pairs(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """word, n, near, near_n: both ways round, once each, of the words one edit apart."""
    tiles = _tiles(_entries(words), params).drop("block")
    return (tiles.repartition("tile").sortWithinPartitions("tile")
            .mapInArrow(_near(params), "word string, n long, near string, near_n long"))


# ---- forms and roots -----------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """word, root of word, form (each word's form, for words that have one): pointers are doubled until
    none moves.  A form is ``form_factor`` times as frequent, so chains are short."""
    now = land(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = land(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(now)
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SpellingParams = SpellingParams(),
             damage: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n, root for each word: ``form`` is its most frequent near word, if
    that is ``form_factor`` times as frequent; ``root`` the end of the chain of forms."""
    words = land(count_words(docs, id_col, text_col, params, damage))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = near_pairs(words, params).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(found, "word", "left")
    formed = -F.col("best.less") >= params.form_factor * F.col("n")
    rows = land(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")))
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
