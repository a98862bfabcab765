"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Within a pre-token the adjacent pairs wait in one bucket per merge rank that
holds positions of a linked list.  A two-level bitmap over the ranks tells
the lowest bucket in use by find-first-set.  A merge relinks the list and
adds its two new pairs; entries that no longer hold their pair are skipped
when they come up.  A pre-token of n bytes costs about n log n, however long
it is.

Spark partitions the texts; each task streams its rows.  A text is cut at
single spaces where that cannot change the pre-tokens (no two spaces in a
row), and the ids of such pieces are remembered in a bounded table, so common
words are looked up and only new ones are merged, all those of some megabytes
of text in one queue.  Decoding goes from the ids
back to bytes.

Rows: null is the empty text and has no ids; texts of any length, ties and
repeats encode alike; other columns stay as asked for by ``keep``.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shipwise.llm.tables import kept, lean, pick, release_memory  # noqa: F401
from shipwise.llm.words import blocks, string_buffers

#: Text encoded at a time, in bytes (at least one whole text).
BATCH_BYTES = 2 << 20
#: New pre-tokens merged in one queue, in bytes (at least one whole pre-token): its lists take some
#: 100 bytes for each, which should stay in a core's cache.
QUEUE_BYTES = 1 << 15
#: Pieces, and pre-tokens, that a worker remembers: some 250 bytes each.
REMEMBER = 450_000


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class RankQueue:
    """Positions by rank; the ranks in use are bits of leaves of 256, the leaves bits of a root."""

    def __init__(self) -> None:
        self.root = 0
        self.leaves: dict[int, int] = {}
        self.buckets: dict[int, list[int]] = {}

    def put(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            hi = rank >> 8
            self.leaves[hi] = self.leaves.get(hi, 0) | 1 << (rank & 255)
            self.root |= 1 << hi
        else:
            bucket.append(position)

    def fill(self, ranks: np.ndarray) -> None:
        """Puts all positions into the empty queue, at the rank given for each; -1 stays out."""
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0):]
        used, first = np.unique(ranks[order], return_index=True)
        for rank, positions in zip(used.tolist(), np.split(order, first[1:])):
            self.buckets[rank] = positions.tolist()
            hi = rank >> 8
            self.leaves[hi] = self.leaves.get(hi, 0) | 1 << (rank & 255)
            self.root |= 1 << hi

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank in use and its positions, which leave the queue; -1 if there are none."""
        if not self.root:
            return -1, []
        hi = (self.root & -self.root).bit_length() - 1
        leaf = self.leaves[hi]
        low = leaf & -leaf
        self.leaves[hi] = leaf ^ low
        if leaf == low:
            self.root ^= 1 << hi
        rank = hi << 8 | low.bit_length() - 1
        return rank, self.buckets.pop(rank)


class ByteBpe:
    """Encoder and decoder of one vocabulary; ``remember`` bounds each of its tables."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = REMEMBER) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.single_of = np.array(self.single, np.int32)
        self.of_bytes = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.remember = remember
        self.spelled = {str(i): b for i, b in self.bytes_of.items()}
        self.pairs: dict[int, int] = {}
        self.tokens: dict[str, str] = {}
        self.pieces: dict[str, str] = {}

    def merge(self, raws: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token.  All of them lie in one linked list, with no pair across a
        border, so they share the queue and each still merges its own lowest, leftmost pair."""
        pairs, ranks, bytes_of = self.pairs, self.ranks, self.bytes_of
        if len(pairs) > self.remember // 3:  # cheap to look up again
            pairs.clear()

        def rank_of(a: int, b: int) -> int:
            r = pairs[a << 20 | b] = ranks.get(bytes_of[a] + bytes_of[b], -1)
            return r

        raw = np.frombuffer(b"".join(raws), np.uint8)
        n = len(raw)
        ends = np.cumsum([len(r) for r in raws], dtype=np.int64)
        filled = ends[np.diff(ends, prepend=0) > 0]
        ids: list[int] = self.single_of[raw].tolist()
        links = np.arange(1, n + 1)
        links[filled - 1] = -1
        after = links.tolist()
        links = np.arange(-1, n - 1)
        links[filled[:-1]] = -1
        before = links.tolist()
        firsts = np.full(n, -1, np.int32)
        firsts[:-1] = self.of_bytes[raw[:-1].astype(np.int32) << 8 | raw[1:]]
        firsts[filled - 1] = -1
        pair = firsts.tolist()
        queue = RankQueue()
        if n:
            queue.fill(firsts)
        put, known, waiting = queue.put, pairs.get, queue.buckets.get
        while True:
            rank, bucket = queue.take()
            if rank < 0:
                break
            bucket.sort()
            for at, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale: one side was merged away
                j = after[i]
                k = after[j]
                ids[i], after[i], ids[j], pair[j] = rank, k, -1, -1
                lowest = rank
                if k >= 0:
                    before[k] = i
                    r = known(rank << 20 | ids[k])
                    if r is None:
                        r = rank_of(rank, ids[k])
                    pair[i] = r
                    if r >= 0:
                        others = waiting(r)
                        if others is None:
                            put(r, i)
                        else:
                            others.append(i)
                        if r < lowest:
                            lowest = r
                else:
                    pair[i] = -1
                h = before[i]
                if h >= 0:
                    r = known(ids[h] << 20 | rank)
                    if r is None:
                        r = rank_of(ids[h], rank)
                    pair[h] = r
                    if r >= 0:
                        others = waiting(r)
                        if others is None:
                            put(r, h)
                        else:
                            others.append(h)
                        if r < lowest:
                            lowest = r
                if lowest < rank:  # a new pair goes first; the rest of the bucket waits
                    for rest in bucket[at + 1:]:
                        put(rank, rest)
                    break
        merged = np.array(ids, np.int32)
        left = merged >= 0
        merged = merged[left].tolist()
        stops = np.append(0, np.cumsum(left))[ends].tolist() if n else [0] * len(raws)
        return [merged[lo:hi] for lo, hi in zip([0, *stops], stops)]

    def _merge_all(self, raws: list[bytes]) -> Iterator[list[int]]:
        """The ids of each pre-token, some ``QUEUE_BYTES`` of them in a queue."""
        lo = size = 0
        for hi, raw in enumerate(raws):
            if size and size + len(raw) > QUEUE_BYTES:
                yield from self.merge(raws[lo:hi])
                lo, size = hi, 0
            size += len(raw)
        yield from self.merge(raws[lo:])

    def _learn(self, pieces: set[str]) -> None:
        """Puts the ids of new pieces of text into the tables."""
        if len(self.pieces) + len(pieces) > self.remember:
            self.pieces.clear()
        cut = {p: self.pattern.findall(p) for p in pieces}
        if len(self.tokens) > self.remember:
            self.tokens.clear()
        new = set().union(*cut.values()).difference(self.tokens)
        todo = []
        for t in new:
            whole = self.ranks.get(raw := t.encode())
            if whole is not None:
                self.tokens[t] = str(whole)
            else:
                todo.append((t, raw))
        for (t, _), ids in zip(todo, self._merge_all([raw for _, raw in todo]), strict=True):
            self.tokens[t] = " ".join(map(str, ids))
        spelled = self.tokens
        for p, ts in cut.items():
            self.pieces[p] = " ".join(map(spelled.__getitem__, ts))
        for t in [t for t in new if len(t) > 256]:
            del spelled[t]

    @staticmethod
    def cut(text: str) -> list[str]:
        """Pieces whose pre-tokens are those of the text: each space that is not beside another one
        starts a piece, as it starts a pre-token."""
        if not text:
            return []
        if "  " in text:
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + p for p in rest]] if first else [" " + p for p in rest]

    def encode_texts(self, texts: list[str]) -> list[str]:
        """The decimal ids of each text, joined by spaces. Its many short lists hold no cycles, so
        the cycle collector would only walk them in vain."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[str]:
        pieces = [self.cut(t) for t in texts]
        known = self.pieces
        missing = set().union(*pieces).difference(known)
        if len(known) + len(missing) > self.remember:
            known.clear()
            missing = set().union(*pieces)
        if missing:
            self._learn(missing)
        out = [" ".join(map(known.__getitem__, ps)) for ps in pieces]
        for p in [p for p in missing if len(p) > 256]:
            del known[p]
        return out

    def decode_text(self, ids: str) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids.split(" "))) if ids else b""


_CODERS: dict[str, ByteBpe] = {}


def coder(raw: bytes, pattern: str, remember: int = REMEMBER) -> ByteBpe:
    """One coder for each vocabulary and Python worker, so its tables serve later tasks too."""
    name = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if name not in _CODERS:
        _CODERS[name] = ByteBpe(read_ranks(raw), pattern)
    _CODERS[name].remember = remember
    return _CODERS[name]


def _code(vocabulary, pattern: str, ids: bool, decoded: bool, remember: int, batch_bytes: int = BATCH_BYTES):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary.value, pattern, remember)
        for batch in batches:
            _, offsets = string_buffers(batch.column("text"))
            for rows in blocks(offsets, batch_bytes):
                part = batch.slice(rows.start, len(rows))
                out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
                for spelled in c.encode_texts([text or "" for text in part.column("text").to_pylist()]):
                    back = c.decode_text(spelled)
                    out["n_tokens"].append(spelled.count(" ") + 1 if spelled else 0)
                    out["ids_sha256"].append(hashlib.sha256(spelled.encode()).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                    if ids:
                        out["ids"].append(np.fromstring(spelled, dtype=np.int32, sep=" ") if spelled else np.zeros(0, np.int32))
                    if decoded:
                        out["decoded"].append(back)
                columns = {"n_tokens": pa.array(out["n_tokens"], pa.int64()), "ids_sha256": pa.array(out["ids_sha256"], pa.string()),
                           "decoded_sha256": pa.array(out["decoded_sha256"], pa.string())}
                if ids:
                    columns["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
                if decoded:
                    columns["decoded"] = pa.array(out["decoded"], pa.binary())
                old = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in old], *columns.values()], names=[*old, *columns])
    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = (), ids: bool = False, decoded: bool = False, remember: int = REMEMBER,
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """id, kept columns, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.
    ``remember`` bounds a worker's tables of known pieces; less takes less memory and more time,
    as do fewer ``batch_bytes`` of text encoded at a time. The vocabulary at ``path`` (about 1 MB) is read by the driver and broadcast."""
    with open(path, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    names, fields = kept(docs, keep)
    rows = pick(docs, id=id_col, text=text_col, **names)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"])
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    schema = schema.add("ids", T.ArrayType(T.IntegerType())) if ids else schema
    schema = schema.add("decoded", "binary") if decoded else schema
    return rows.mapInArrow(lean(_code(vocabulary, pattern, ids, decoded, remember, batch_bytes), tables=True), schema)
