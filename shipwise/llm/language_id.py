"""Language identification by nearest centroid.

A text is the normalised TF-IDF vector of its hashed byte n-grams (1 to 3
bytes; A-Z lowered; digits and ASCII punctuation count as spaces).  Document
frequencies come from all labelled rows.  A bounded sample of labelled rows
per language (``sample``) is clustered by spherical k-means into several
centroids per language, and a text takes the language of the nearest one by
cosine.  It is rejected if it is much farther away than the sample's own
texts of about its length are: below ``reject`` times the lower ``quantile``
of their cosines.

Rows: a null text or one without a letter is ``und`` with score 0 and is
rejected; equal texts get equal results; a tie goes to the first centroid
(languages in order); with nothing to learn from, every text is ``und``;
rows of null language are not learned from; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipwise.llm.tables import kept, land, lean, pick
from shipwise.llm.words import LOWER, blocks, string_buffers

NEUTRAL = LOWER.copy()
NEUTRAL[[b for b in range(128) if not 97 <= LOWER[b] <= 122]] = 32


@dataclass(frozen=True)
class LanguageParams:
    """``sample``: expected rows per language for the clusters (at most twice as many are used)."""

    dims: int = 1 << 12
    sample: int = 400
    clusters: int = 3
    rounds: int = 12
    reject: float = 0.5
    quantile: float = 0.01


def grams(data: np.ndarray, offsets: np.ndarray, rows: range, dims: int) -> np.ndarray:
    """Counts of hashed n-grams, one row per text (float32)."""
    lo = offsets[rows.start]
    b = NEUTRAL[data[lo:offsets[rows.stop]]].astype(np.uint32)
    at = offsets[rows.start:rows.stop + 1] - lo
    doc = np.repeat(np.arange(len(rows), dtype=np.int64), np.diff(at))
    out = np.zeros(len(rows) * dims, dtype=np.int64)
    code = np.zeros(len(b), dtype=np.uint32)
    for n in range(1, 4):
        if len(b) < n:
            break
        code = code[:len(b) - n + 1] * np.uint32(257) + b[n - 1:]
        inside = doc[n - 1:] == doc[:len(doc) - n + 1]
        bucket = ((code * np.uint32(2654435761)) >> np.uint32(32 - dims.bit_length() + 1)).astype(np.int64)
        out += np.bincount((doc[:len(bucket)] * dims + bucket)[inside], minlength=len(out))
    return out.reshape(len(rows), dims).astype(np.float32)


def gram_blocks(column: pa.Array, dims: int) -> Iterator[tuple[range, np.ndarray]]:
    data, offsets = string_buffers(column)
    for rows in blocks(offsets):
        for i in range(rows.start, rows.stop, 64):  # short texts: bounded rows as well as bytes
            part = range(i, min(i + 64, rows.stop))
            yield part, grams(data, offsets, part, dims)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return (v / np.where(norm > 0, norm, 1)).astype(np.float32)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(counts.sum(axis=1) + 1).astype(np.int64)


# ---- learning ------------------------------------------------------------------------------------

def _learn(dims: int):
    """Per task one row of document frequencies (lang null), and the sampled rows' counts."""
    schema = ["lang", "n", "buckets", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dims, dtype=np.int64), 0
        for batch in batches:
            langs, taken = batch.column("lang"), batch.column("taken").to_numpy(zero_copy_only=False)
            found = []
            for rows, counts in gram_blocks(batch.column("text"), dims):
                df += (counts > 0).sum(axis=0)
                n += len(rows)
                for i in np.flatnonzero(taken[rows.start:rows.stop]):
                    b = np.flatnonzero(counts[i])
                    found.append((langs[rows.start + int(i)].as_py(), 1, b, counts[i][b].astype(np.int64)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=schema)
        b = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([n]), pa.array([b]), pa.array([df[b]])],
                                         names=schema)
    return run


def cluster(vectors: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; starts from the farthest points in turn, so it needs no seed."""
    centres = vectors.mean(axis=0, keepdims=True)
    centres /= max(np.linalg.norm(centres), 1e-9)
    start = [int(np.argmax(vectors @ centres[0]))]
    while len(start) < min(k, len(vectors)):
        start.append(int(np.argmin((vectors @ vectors[start].T).max(axis=1))))
    centres = vectors[start]
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        moved = np.stack([vectors[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        norm = np.linalg.norm(moved, axis=1, keepdims=True)
        centres = moved / np.where(norm > 0, norm, 1)
    return centres


@dataclass
class LanguageModel:
    params: LanguageParams
    langs: list[str]
    idf: np.ndarray
    centres: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def predict(self, counts: np.ndarray):
        """(place of the language, cosine, whether it is too far away) of each row."""
        if not self.langs:
            n = len(counts)
            return np.full(n, -1), np.zeros(n), np.ones(n, bool)
        sims = weighted(counts, self.idf) @ self.centres.T
        best = np.argmax(sims, axis=1)
        score = np.clip(sims[np.arange(len(sims)), best].astype(np.float64), 0, 1)
        return self.owner[best], score, score < self.floor[np.minimum(length_class(counts), len(self.floor) - 1)]


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id", params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Learn from the rows where ``learn`` holds; ids only pick the sample."""
    p = params
    rows = pick(docs.where(learn), id=id_col, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row per language
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, p.sample / n)).otherwise(share)
    taken = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(17)), F.lit(1_000_000)) < share * 1_000_000
    found = land(rows.select("text", "lang", taken.alias("taken")).mapInArrow(
        lean(_learn(p.dims)), "lang string, n long, buckets array<long>, counts array<long>"))
    total = found.where("lang is null")
    n = total.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    df = np.zeros(p.dims)
    for bucket, count in (total.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
                          .groupBy("x.buckets").agg(F.sum("x.counts")).collect()):  # at most dims rows
        df[bucket] = count
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    langs = sorted(sizes)
    centres, owner, sims = [], [], []
    for j, lang in enumerate(langs):
        sample = found.where(F.col("lang") == lang).select("buckets", "counts").limit(2 * p.sample).collect()
        counts = np.zeros((len(sample), p.dims), dtype=np.float32)
        for i, r in enumerate(sample):
            counts[i, r["buckets"]] = r["counts"]
        counts = counts[counts.sum(axis=1) > 0]
        if not len(counts):
            continue
        vectors = weighted(counts, idf)
        own = cluster(vectors, p.clusters, p.rounds)
        centres.append(own)
        owner += [j] * len(own)
        sims.append((length_class(counts), (vectors @ own.T).max(axis=1)))
    if not centres:
        return LanguageModel(p, [], idf, np.zeros((0, p.dims)), np.zeros(0, int), np.zeros(1))
    length, sim = (np.concatenate(c) for c in zip(*sims, strict=True))
    # the lower quantile by length class, never above that of a longer class's texts
    floor = np.full(40, np.inf)
    for c in range(40):
        if (length == c).sum() >= 20:
            floor[c] = np.quantile(sim[length == c], p.quantile)
    known = np.flatnonzero(np.isfinite(floor))
    base = np.quantile(sim, p.quantile)
    for c in range(40):
        if not np.isfinite(floor[c]):
            near = known[known > c][:1] if (known > c).any() else known[-1:]
            floor[c] = floor[near[0]] if len(near) else base
            if len(known) and c < known[0]:
                floor[c] *= 2.0 ** ((c - known[0]) / 2)  # cosines fall with the root of the length
    return LanguageModel(p, langs, idf, np.concatenate(centres), np.array(owner), p.reject * floor)


# ---- prediction ----------------------------------------------------------------------------------

def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        names = np.array([*m.langs, "und"], dtype=object)
        for batch in batches:
            lang, score, out = [], [], []
            for _, counts in gram_blocks(batch.column("text"), m.params.dims):
                a, b, c = m.predict(counts)
                lang.append(a)
                score.append(b)
                out.append(c)
            lang, score, out = (np.concatenate(x) if x else np.zeros(0) for x in (lang, score, out))
            known = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool) & (lang >= 0)
            lang = np.where(known, lang, len(m.langs)).astype(np.int64)
            columns = {"lang_pred": pa.array(names[lang], pa.string()), "score": pa.array(np.where(known, score, 0.0)),
                       "rejected": pa.array(out.astype(bool) | ~known)}
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in batch.schema.names if c != "letters"], *columns.values()],
                names=[*[c for c in batch.schema.names if c != "letters"], *columns])
    return run


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """id, text, kept columns, lang_pred, score (cosine, 0 to 1) and rejected for every row."""
    names, fields = kept(docs, keep)
    rows = pick(docs, id=id_col, text=text_col, **names).withColumn(
        "letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "letters"]).add(
        "lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(lean(_predict(docs.sparkSession.sparkContext.broadcast(model))), schema)


def crc_part(id_col: str, parts: int) -> Column:
    """The remainder that tells held-out rows; a null id has none (null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))
