"""Line dedup over levelled sorted runs of line hashes.

The documents come in batches.  For each batch every line's key (the line
without white space at its ends, A-Z lowered) is hashed to 128 bits, counted
once a document, and summed over the batch.  The batch is merge-anti-joined
with the stored runs: keys that a run already holds for enough documents are
settled and leave, and what is left is written as a run of its own.  A run is
a table bucketed and sorted by hash, so a join or a merge of runs moves
nothing of what is stored.  A batch that would be the
``fanout``-th run of a level is merged with the others into one run of the
next level; so a store of n batches has some ``fanout * log(n)`` runs, and a
hash is rewritten some ``log(n)`` times.

Counts of a key are spread over several runs until they are merged;
``repeated`` sums them all, and ``drop_lines`` then takes the lines out in one
pass over the documents.  Keys found often are counted before they are
broadcast; if they are too many, the lines meet them in a shuffle by hash and
go back to their documents by the digest of the text.

Rows: each row is a document, repeated rows and null ids too; a null or empty
text is one empty line, whose key is empty and never dropped; a text of one
very long line is held by one task as it is; extra columns are ignored or, if
named in ``keep``, carried under a prefix; an empty table has no runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipwise.llm.tables import kept, land, pick, prepare
from shipwise.session import ensure_checkpoint_dir

_HASH = ["hi", "lo"]


@dataclass(frozen=True)
class LineDedupParams:
    """A key counts from ``min_chars`` code points and leaves from ``min_docs`` documents on.
    ``buckets`` files a run, or if 0 as many as the session has shuffle partitions, as the counted keys
    are dealt; ``fanout`` runs of a level make one of the next."""

    min_docs: int = 10
    min_chars: int = 1
    buckets: int = 0
    fanout: int = 2
    held_keys: int = 200_000  # keys that a task sums before it hands them on
    broadcast_rows: int = 1_000_000  # 16 bytes each


def line_keys(text: str | None, p: LineDedupParams) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text as UTF-8, and the 16-byte hash of each line's key (b"" for a key that is too short)."""
    raw = (text or "").encode()
    lines, out = raw.split(b"\n"), []
    for line in raw.lower().split(b"\n"):  # bytes.lower and bytes.strip know ASCII only: A-Z, space and \t to \r
        key = line.strip()
        long_enough = len(key) >= p.min_chars if p.min_chars <= 1 else len(key.decode()) >= p.min_chars
        out.append(xxhash.xxh3_128_digest(key) if long_enough else b"")
    return lines, out


def _halves(digests: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
    return both[:, 0], both[:, 1]


def _counts(p: LineDedupParams):
    def batch_of(n: dict[bytes, int]) -> pa.RecordBatch:
        hi, lo = _halves(n)
        return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(list(n.values()), pa.int64())], names=["hi", "lo", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0):
                for k in set(line_keys(text.as_py(), p)[1]):
                    n[k] = n.get(k, 0) + 1
                if len(n) >= p.held_keys:
                    n.pop(b"", None)
                    yield batch_of(n)
                    n = {}
        n.pop(b"", None)
        yield batch_of(n)
    return run


def count_keys(docs: DataFrame, text_col: str = "text", params: LineDedupParams = LineDedupParams()) -> DataFrame:
    """hi, lo, n: the documents that hold each key."""
    counted = pick(docs, text=text_col).mapInArrow(_counts(params), "hi long, lo long, n long")
    return counted.groupBy(*_HASH).agg(F.sum("n").alias("n"))


@dataclass
class LineRuns:
    """The stored runs, by level; each is a bucketed, sorted table under ``folder``, which driver and
    executors share."""

    spark: SparkSession
    folder: str
    params: LineDedupParams = LineDedupParams()
    levels: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        # the exchange that sums a batch's keys deals them as the buckets do: a task writes one file, and
        # a batch meets the runs without another exchange
        self.buckets = self.params.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @staticmethod
    def scratch(spark: SparkSession, params: LineDedupParams = LineDedupParams()) -> LineRuns:
        return LineRuns(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/line_runs/{uuid.uuid4().hex}", params)

    def _write(self, rows: DataFrame, level: int) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.select(*_HASH, "n").write.format("parquet").bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
         .option("path", f"{self.folder}/level={level}/{name}").saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def _drop(self, name: str, level: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the table is external: its files go below
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/level={level}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def runs(self) -> list[str]:
        """The oldest and largest last level first."""
        return [name for level in reversed(self.levels) for name in level]

    def settled(self, name: str) -> DataFrame:
        """The keys that one run alone holds for enough documents."""
        return self.spark.table(name).where(F.col("n") >= self.params.min_docs).select(*_HASH)

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        """Counts a batch of documents, anti-joins it with each run's settled keys, and adds it as a run;
        a level that it fills is merged with it into one run of the next, in the same pass."""
        rows = count_keys(docs, text_col, self.params)
        for name in self.runs():
            rows = rows.join(self.settled(name).hint("merge"), _HASH, "left_anti")
        level, old = 0, []
        while level < len(self.levels) and len(self.levels[level]) >= self.params.fanout - 1:
            old += [(name, level) for name in reversed(self.levels[level])]
            self.levels[level] = []
            level += 1
        self._write(self._summed([rows, *[self.spark.table(name) for name, _ in old]]), level)
        for name, at in old:
            self._drop(name, at)

    def _merged(self, names: list[str]) -> DataFrame:
        """hi, lo, n over the runs, small ones first."""
        return self._summed([self.spark.table(name) for name in reversed(names)])

    @staticmethod
    def _summed(tables: list[DataFrame]) -> DataFrame:
        """hi, lo, n over tables of distinct keys: merge joins of sorted tables, two of which need no
        shuffle.  (Not a union and a sum: of bucketed tables in columns, Spark 4.1 sums each bucket by
        itself.)"""
        out, *others = tables
        for other in others:
            other = other.withColumnRenamed("n", "m").hint("merge")
            both = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            out = out.join(other, _HASH, "full").select(*_HASH, both.cast("long").alias("n"))
        return out

    def repeated(self) -> DataFrame:
        """hi, lo of the keys found in at least ``min_docs`` documents of all batches."""
        names = self.runs()
        if not names:
            return self.spark.createDataFrame([], "hi long, lo long")
        return self._merged(names).where(F.col("n") >= self.params.min_docs).select(*_HASH)

    def clear(self) -> None:
        for level, names in enumerate(self.levels):
            for name in names:
                self._drop(name, level)
        self.levels = []


# ---- taking lines out ----------------------------------------------------------------------------

_OUT = [T.StructField("id", T.LongType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
        T.StructField("text", T.StringType())]


def _dropped(batch: pa.RecordBatch, bad: Iterable[set | None], p: LineDedupParams, names: list[str], carried: list) -> pa.RecordBatch:
    n_lines, n_dropped, texts = [], [], []
    for text, held in zip(batch.column("text"), bad, strict=True):
        lines, keys = line_keys(text.as_py(), p)
        left = [x for x, k in zip(lines, keys, strict=True) if k not in held] if held else lines
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(left))
        texts.append(b"\n".join(left).decode())
    cols = [batch.column("id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string()), *carried]
    return pa.RecordBatch.from_arrays(cols, names=names)


def _bounded_slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def drop_lines(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               params: LineDedupParams = LineDedupParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """id, n_lines (before), n_dropped, text (of the lines left), and the columns in ``keep`` under a
    prefix.  ``repeated``: hi, lo of the keys whose lines go."""
    p = params
    names, fields = kept(docs, keep)
    rows = pick(docs, id=id_col, text=text_col, **names).withColumn("id", F.col("id").cast("long"))
    schema = T.StructType([*_OUT, *fields])
    repeated = land(repeated)
    if repeated.count() <= p.broadcast_rows:
        table = repeated.toArrow()
        cols = [table.column(c).to_numpy() for c in _HASH]
        sent = rows.sparkSession.sparkContext.broadcast(np.stack(cols, 1).astype(">i8").tobytes())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw = sent.value
            bad = {raw[i:i + 16] for i in range(0, len(raw), 16)}
            for batch in batches:
                for part in _bounded_slices(batch):
                    yield _dropped(part, [bad] * part.num_rows, p, schema.names, [part.column(c) for c in names])
        return rows.mapInArrow(run, schema)

    # too many for every worker: lines meet them by hash, and go back to the texts that hold them
    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                own = xxhash.xxh3_128_digest((text.as_py() or "").encode())
                keys = sorted({k for k in line_keys(text.as_py(), p)[1] if k})
                for at in range(0, len(keys), 100_000):
                    some = keys[at:at + 100_000]
                    hi, lo = _halves(some)
                    yield pa.RecordBatch.from_arrays([pa.array([own] * len(some), pa.binary()), pa.array(hi), pa.array(lo)],
                                                     names=["own", "hi", "lo"])

    def with_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [xxhash.xxh3_128_digest((t.as_py() or "").encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.binary())], names=[*batch.schema.names, "own"])

    found = rows.select("text").mapInArrow(lines_of, "own binary, hi long, lo long").join(repeated, _HASH)
    hits = land(found.groupBy("own").agg(F.collect_set(F.struct(*_HASH)).alias("bad")))  # a text's own lines
    both = (rows.mapInArrow(with_own, T.StructType([*rows.schema.fields, T.StructField("own", T.BinaryType())]))
            .join(hits, "own", "left").drop("own"))

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _bounded_slices(batch):
                bad = [None if x.as_py() is None else
                       {int(k["hi"]).to_bytes(8, "big", signed=True) + int(k["lo"]).to_bytes(8, "big", signed=True) for k in x.as_py()}
                       for x in part.column("bad")]
                yield _dropped(part, bad, p, schema.names, [part.column(c) for c in names])
    return both.mapInArrow(run_joined, schema)


def file_batches(spark: SparkSession, path: str, batches: int) -> list[DataFrame]:
    """The table at ``path`` as at most ``batches`` tables of whole files (in turn, by name)."""
    whole = spark.read.parquet(path)
    files = sorted(whole.inputFiles())
    if len(files) < 2:
        return [whole]
    return [spark.read.schema(whole.schema).parquet(*files[i::batches]) for i in range(min(batches, len(files)))]


def dedup(docs: DataFrame, batches: list[DataFrame] | None = None, id_col: str = "doc_id", text_col: str = "text",
          params: LineDedupParams = LineDedupParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """All of ``docs`` without the lines found in ``min_docs`` documents; ``batches`` are the parts of
    ``docs`` in which they are added to the runs (one, if not given)."""
    spark = docs.sparkSession
    prepare(spark)
    store = LineRuns.scratch(spark, params)
    for batch in batches or [docs]:
        store.add(batch, text_col)
    repeated = land(store.repeated())
    store.clear()
    return drop_lines(docs, repeated, id_col, text_col, params, keep)


_SPACE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
#: DuckDB; a row is a document.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT r, unnest(x) AS line, unnest(range(len(x))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
bad AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, bad.key IS NOT NULL AS gone FROM k LEFT JOIN bad ON k.key = bad.key)
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m JOIN d ON d.r = m.r GROUP BY m.r
"""
