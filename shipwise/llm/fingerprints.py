"""Document fingerprints: one-permutation MinHash with optimal densification.

Each word shingle is hashed once; its top bits name one of ``bins`` bins and
each bin keeps its least hash.  An empty bin copies the bin that is first in
its own random order among the filled ones (the limit of optimal
densification's probing).  Only the low ``bits`` bits of each bin are stored,
packed; likeness corrects for bins that agree by chance.

``with_edits`` also pairs each document with the next one in descending id.
Ids are cut into ranges at quantiles; a range's rows go to one task by a
single shuffle, sorted, and the first row of each range is also sent to the
range before it.  Only one id per range reaches the driver.

Rows: null and wordless texts have the empty fingerprint (likeness 1 with
each other, else 0); equal texts have equal fingerprints; a null id comes
last; equal ids are ordered by their texts' hashes; a single document is its
own next one; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import pick
from shipwise.llm.words import NONSPACE, U64, each_block, mix, shingle_sets


@dataclass(frozen=True)
class FingerprintParams:
    """``bins`` a power of two of at least 2; ``bits`` 1, 2, 4 or 8."""

    width: int = 5
    bins: int = 512
    bits: int = 4


@lru_cache(maxsize=4)
def _orders(bins: int) -> np.ndarray:
    """For each bin a random order of all bins, as ranks."""
    i = np.arange(bins * bins, dtype=U64) + U64(1 << 40)
    return (mix(i) >> U64(32)).astype(np.uint32).reshape(bins, bins)


def codes(s: np.ndarray, p: FingerprintParams) -> np.ndarray | None:
    """The low bits of each bin for a sorted set of hashes; None for the empty set."""
    if not len(s):
        return None
    b = (s >> U64(64 - p.bins.bit_length() + 1)).astype(np.int64)
    at = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    filled, least = b[at], (s[at] & U64((1 << p.bits) - 1)).astype(np.uint8)
    out = np.zeros(p.bins, dtype=np.uint8)
    out[filled] = least
    empty = np.ones(p.bins, dtype=bool)
    empty[filled] = False
    gaps = np.flatnonzero(empty)
    if len(gaps):
        out[gaps] = least[_orders(p.bins)[np.ix_(gaps, filled)].argmin(axis=1)]
    return out


def pack(c: np.ndarray | None, p: FingerprintParams) -> str:
    if c is None:
        return ""
    bits = np.unpackbits(c[:, None], axis=1)[:, 8 - p.bits:]
    return base64.b64encode(np.packbits(bits.ravel()).tobytes()).decode()


def unpack(f: str, p: FingerprintParams) -> np.ndarray | None:
    if not f:
        return None
    bits = np.unpackbits(np.frombuffer(base64.b64decode(f), np.uint8)).reshape(p.bins, p.bits)
    return (bits * (1 << np.arange(p.bits)[::-1])).sum(axis=1).astype(np.uint8)


def likeness(x: np.ndarray | None, y: np.ndarray | None, p: FingerprintParams) -> float:
    """Jaccard estimate from 0 to 1, without the share of bins that agree by chance."""
    if x is None or y is None:
        return float(x is None and y is None)
    chance = 0.5 ** p.bits
    return float(max(0.0, ((x == y).mean() - chance) / (1 - chance)))


def codes_of(texts: list[str], p: FingerprintParams) -> list[np.ndarray | None]:
    return [codes(s, p) for words in each_block(pa.array(texts, pa.string()), NONSPACE) for s in shingle_sets(words, p.width)]


def _single(p: FingerprintParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [pack(codes(s, p), p) for words in each_block(batch.column("text"), NONSPACE) for s in shingle_sets(words, p.width)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["id", "fingerprint"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 params: FingerprintParams = FingerprintParams()) -> DataFrame:
    """id, fingerprint."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(_single(params), f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string")


# ---- each document and the next one --------------------------------------------------------------

def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """part, ahead, id, text: each part's rows in descending id, and after them, with ``ahead`` 1,
    the first row of the next part (after the last one, of the first)."""
    spark = docs.sparkSession
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("id", F.lit(-(1 << 63)).cast("long")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({float(c) for c in rows.select("key").approxQuantile("key", [i / n for i in range(1, n)], 0.1 / n)})
    cuts = cuts or [0.0]
    inner = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="place", outputCol="part")
    rows = inner.transform(rows.withColumn("place", F.col("key").cast("double"))).withColumn("part", F.col("part").cast("int")).drop("place")
    heads = sorted(rows.groupBy("part").agg(F.max("key")).collect(), reverse=True)  # one row per part
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    own = F.struct(F.col("part"), F.lit(0).alias("ahead"))
    places = F.array(own)
    if before:
        first = F.create_map(*[F.lit(v) for pair in before.items() for v in pair])
        places = F.when(F.col("key").isin(list(before)),
                        F.array(own, F.struct(first[F.col("key")].alias("part"), F.lit(1).alias("ahead")))).otherwise(places)
    rows = rows.withColumn("at", F.explode(places)).select("at.part", "at.ahead", "key", "id", "text")
    return (rows.repartition(n, "part").sortWithinPartitions("part", "ahead", F.desc("key"), F.xxhash64("text"))
            .select("part", "ahead", "id", "text"))


def _edits(p: FingerprintParams):
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def pair(rows: list) -> pa.RecordBatch:
        """rows: (this, next), each (part, ahead, id, text, codes)."""
        edited = [a[3][:len(a[3]) - len(a[3]) // 3] + b[3][:len(a[3]) // 3] for a, b in rows]
        after = codes_of(edited, p)
        cols = [[a[2] for a, _ in rows], [len(a[3]) for a, _ in rows],
                [hashlib.sha256(e.encode()).hexdigest() for e in edited], [pack(a[4], p) for a, _ in rows],
                [pack(c, p) for c in after], [likeness(a[4], c, p) for (a, _), c in zip(rows, after, strict=True)],
                [likeness(a[4], b[4], p) for a, b in rows]]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols = [c.to_pylist() for c in part.columns]
                rows = list(zip(*cols, codes_of(cols[3], p), strict=True))
                seq = [last, *rows] if last is not None else rows
                both = [(a, b) for a, b in zip(seq, seq[1:]) if a[1] == 0 and a[0] == b[0]]
                last = seq[-1]
                if both:
                    yield pair(both)
    return run


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               params: FingerprintParams = FingerprintParams()) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return with_next(docs, id_col, text_col).mapInArrow(
        _edits(params), "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                        "near_edited double, near_next double")
