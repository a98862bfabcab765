"""Token counts through a digest cache.

The cache is a table of (tokenizer version, content digest, tokens).  The
version is the digest of the tokenizer's file and of the counting rules; the
content digest is SHA-256 of the normalised text (tabs and line ends become
spaces, which this kind of tokenizer drops anyway).  Contents are joined to
the stored counts; only distinct contents without one are encoded, and their
counts are appended.  A lost task writes nothing: files appear when the
append is committed, and a repeated digest counts once.

Encoding uses the tokenizer's own library on the pieces between white space,
which this tokenizer never joins, and remembers the counts of pieces in a
bounded table per Python worker.

Rows: null is the empty text (0 tokens, 0 bytes); equal texts are encoded
once; rows and ties stay as they are; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwise.llm.tables import land, pick

RULES_VERSION = "pieces-1"
_TAIL = re.compile(r"[.,;:!?)]+$")


class PieceCounter:
    """Counts of white-space separated pieces by the library, remembered up to ``remember``."""

    def __init__(self, spec: str, remember: int = 400_000) -> None:
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.remember = remember
        self.known: dict[str, int] = {"": 0}

    @staticmethod
    def parts(piece: str) -> tuple[str, ...]:
        """ASCII pieces count alike in lower case, and closing punctuation after a letter or digit
        is a pre-token of its own; a special token's string stays whole."""
        if not piece.isascii() or "<|" in piece:
            return (piece,)
        piece = piece.lower()
        m = _TAIL.search(piece)
        return (piece[:m.start()], m[0]) if m and m.start() and piece[m.start() - 1].isalnum() else (piece,)

    def count_all(self, texts: list[str]) -> list[int]:
        known = self.known
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        new = {p for pieces in split for p in pieces if p not in known}
        if len(known) + len(new) > self.remember:
            known.clear()
            known[""] = 0
            new = {p for pieces in split for p in pieces if p}
        parts = {p: self.parts(p) for p in new}
        todo = list({q for qs in parts.values() for q in qs if q not in known})
        for at in range(0, len(todo), 20_000):
            some = todo[at:at + 20_000]
            for q, e in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[q] = len(e)
        for p, qs in parts.items():
            known[p] = sum([known[q] for q in qs])
        return [sum(map(known.__getitem__, pieces)) for pieces in split]


_COUNTERS: dict[str, PieceCounter] = {}


def counter(spec: str) -> PieceCounter:
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _COUNTERS:
        _COUNTERS[name] = PieceCounter(spec)
    return _COUNTERS[name]


def _count(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = c.count_all(part.column("content").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"])
    return run


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def content(text):
    """The normalised content."""
    text = F.coalesce(text, F.lit(""))
    for c in "\n\t\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """digest, n_tokens of one tokenizer version, or None if there are none."""
    path = f"{cache.rstrip('/')}/version={version}"
    if not exists(spark, path):
        return None
    return spark.read.schema("digest binary, n_tokens long").parquet(path).dropDuplicates(["digest"])


def count_tokens(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens for every row; ``path`` is the tokenizer's file (its size is broadcast
    as it is, a few MB), ``cache`` a folder that driver and executors share."""
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    version = hashlib.sha256((RULES_VERSION + "\0" + spec).encode()).hexdigest()
    rows = pick(docs, id=id_col, text=text_col).withColumn("content", content(F.col("text")))
    rows = rows.withColumn("digest", F.unhex(F.sha2("content", 256)))
    distinct = rows.groupBy("digest").agg(F.first("content").alias("content"))
    stored = stored_counts(spark, cache, version)
    misses = distinct if stored is None else distinct.join(stored, "digest", "left_anti")
    counted = misses.mapInArrow(_count(spark.sparkContext.broadcast(spec)), "digest binary, n_tokens long")
    counted.write.mode("append").parquet(f"{cache.rstrip('/')}/version={version}")
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
    # landed, so that a hot content is a skewed join of two plain shuffles, which can be split
    known = land(stored_counts(spark, cache, version))
    return (rows.select("id", size.alias("n_bytes"), "digest")
            .join(known, "digest").select("id", "n_bytes", "n_tokens"))
