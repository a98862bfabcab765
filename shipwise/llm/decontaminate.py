"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Words are runs of digits, letters a-z (A-Z lowered) and non-ASCII characters.
An item gives all its windows of ``width`` words, or one window of all its
words if it has fewer.  The windows' hashes are a sorted array with a bit
table in front; each document block looks up its rolling window hashes, and
each hit is verified against the item's words.

The benchmark is a stated query set.  Its size is checked: it is cut into
slices of at most ``slice_bytes`` of text, each slice is broadcast, and the
documents pass one scan per slice (one slice for any usual benchmark).
Nothing is shuffled.

Rows: a null or wordless text has no words and no hits; a null or wordless
item has no window; a null item id counts for the hits but is not listed;
repeated items count once; an empty benchmark leaves all documents clean;
other columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import kept, lean, pick
from shipwise.llm.words import ALNUM, U64, Words, each_block, windows


@dataclass(frozen=True)
class DecontaminationParams:
    width: int = 10
    slice_bytes: int = 8 << 20


@dataclass
class WindowSet:
    """Windows of one length, sorted by hash: hash, item and first word; ``bits`` is a table over
    the hashes' top bits, so that most lookups end after one byte."""

    length: int
    hash: np.ndarray
    item: np.ndarray
    first: np.ndarray
    shift: int
    bits: np.ndarray

    def candidates(self, grams: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.bits[(grams >> U64(self.shift)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hash, grams[maybe]), len(self.hash) - 1)
        return maybe[self.hash[at] == grams[maybe]]


@dataclass
class Benchmark:
    ids: list[str | None]
    words: list[list[bytes]]
    sets: list[WindowSet]


def build_benchmark(ids: list, texts: list, width: int) -> Benchmark:
    found: dict[int, list] = {}
    words: list[list[bytes]] = []
    for block in each_block(pa.array(texts, pa.string()), ALNUM):
        for i in range(len(block.rows)):
            s = block.of(i)
            item, h = len(words), block.hash[s]
            words.append([block.word(k) for k in range(s.start, s.stop)])
            if len(h):
                grams = windows(h, min(width, len(h)))
                found.setdefault(min(width, len(h)), []).append(
                    (grams, np.full(len(grams), item), np.arange(len(grams))))
    sets = []
    for length, parts in sorted(found.items()):
        h, item, first = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h = h[order]
        top = min(26, max(16, len(h).bit_length() + 4))
        bits = np.zeros(1 << top, dtype=bool)
        bits[(h >> U64(64 - top)).astype(np.int64)] = True
        sets.append(WindowSet(length, h, item[order], first[order], 64 - top, bits))
    return Benchmark([None if i is None else str(i) for i in ids], words, sets)


def hits_in(block: Words, bench: Benchmark) -> tuple[np.ndarray, dict[int, set[int]]]:
    """(which words of the block are hit, for each document its items)."""
    edge = np.zeros(len(block.hash) + 1, dtype=np.int64)
    items: dict[int, set[int]] = {}
    texts: dict[int, bytes] = {}

    def word(k: int) -> bytes:
        if k not in texts:
            texts[k] = block.word(k)
        return texts[k]

    for ws in bench.sets:
        grams = windows(block.hash, ws.length)
        if not len(grams):
            continue
        for i in ws.candidates(grams):
            if block.doc[i] != block.doc[i + ws.length - 1]:
                continue
            here = [word(k) for k in range(i, i + ws.length)]
            a, b = np.searchsorted(ws.hash, grams[i], "left"), np.searchsorted(ws.hash, grams[i], "right")
            for k in range(a, b):
                if bench.words[ws.item[k]][ws.first[k]:ws.first[k] + ws.length] == here:
                    edge[i] += 1
                    edge[i + ws.length] -= 1
                    items.setdefault(int(block.doc[i]), set()).add(int(ws.item[k]))
    return np.cumsum(edge)[:-1] > 0, items


def _runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    yield from zip(edge[::2], edge[1::2], strict=True)


def _scan(bench):
    """Adds one slice's hits: spans are first and end byte of runs of hit words, flat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bench.value
        for batch in batches:
            text = batch.column("text")
            n_words, n_hit, spans, items = [], [], [], []
            before = batch.column("hit_spans").to_pylist()
            earlier = batch.column("item_ids").to_pylist()
            for block in each_block(text, ALNUM):
                hit, by_doc = hits_in(block, b)
                hit_docs = set(np.unique(block.doc[hit]).tolist())
                for i in range(len(block.rows)):
                    s, row = block.of(i), block.rows.start + i
                    n_words.append(s.stop - s.start)
                    base = int(block.start[s.start]) if s.stop > s.start else 0
                    if i not in hit_docs and not before[row]:
                        n_hit.append(0)
                        spans.append(before[row])
                        items.append(earlier[row])
                        continue
                    own, at = hit[s].copy(), block.start[s] - base
                    for x, y in zip(before[row][::2], before[row][1::2], strict=True):
                        own |= (at >= x) & (at < y)
                    ends = block.end[s] - base
                    n_hit.append(int(own.sum()))
                    spans.append([int(v) for x, y in _runs(own) for v in (at[x], ends[y - 1])])
                    new = {b.ids[k] for k in by_doc.get(i, ())} - {None}
                    items.append(sorted({*earlier[row], *new}))
            out = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
                   "hit_spans": pa.array(spans, pa.list_(pa.int64())), "item_ids": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([out.get(c, batch.column(k)) for k, c in enumerate(batch.schema.names)],
                                             names=batch.schema.names)
    return run


def scan_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = (),
                   params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """id, text, n_words, n_hit, hit_spans (bytes from the text's first word: first, end, ...) and
    item_ids (sorted as strings) for every document; columns in ``keep`` come along as kept_*."""
    spark = docs.sparkSession
    bench = pick(items, id=item_id_col, text=item_text_col).where("text is not null")
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, -(-size // params.slice_bytes))
    names, _ = kept(docs, keep)
    out = pick(docs, id=id_col, text=text_col, **names).select(
        "id", "text", *names, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<long>").alias("hit_spans"), F.array().cast("array<string>").alias("item_ids"))
    schema = out.schema
    for k in range(slices):
        part = bench.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == k).toArrow()
        windows_of = build_benchmark(part.column("id").to_pylist(), part.column("text").to_pylist(), params.width)
        out = out.mapInArrow(lean(_scan(spark.sparkContext.broadcast(windows_of))), schema)
    return out


def digest_columns(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text"), batch.column("hit_spans").to_pylist(), strict=True):
            raw = text.as_py()
            if spans:
                raw = raw.encode()
                lead = next(each_block(pa.array([raw.decode()]), ALNUM)).start[0]
                keep, at = [], 0
                for x, y in zip(spans[::2], spans[1::2], strict=True):
                    keep.append(raw[at:lead + x])
                    at = lead + y
                raw = b"".join([*keep, raw[at:]]).decode()
            out.append(raw)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string()), batch.column("n_hit")],
                                         names=["id", "text", "n_hit"])


def remove_spans(found: DataFrame) -> DataFrame:
    """id, text without its hit runs, n_hit."""
    return found.mapInArrow(_remove, "id long, text string, n_hit long")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
m AS (SELECT r, i, bw.l, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.l = bw.l),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS k FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
