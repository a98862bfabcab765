"""Line dedup against a plain version: contract, levels of runs, both ways to drop lines, edges."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shipwise.llm import line_dedup
from tests.llm import brute
from tests.oracle_harness import compare, duck_connect

SF = "/root/testdata/sf0.001"
P = line_dedup.LineDedupParams()


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, k, brute.sha(t)) for (d, _), (n, k, t) in zip(docs, brute.line_dedup([t for _, t in docs]), strict=True)}
    out = entry.queries()["op13_line_dedup"](spark, sf).collect()
    assert len(out) == len(docs)
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in out} == want
    assert sum(r["n_dropped"] for r in out) > 0


def _texts(rng, n):
    common = ["Share this page ", "  share THIS page\t", "Éa common line", "éa common line", "x", "", " \x0b ", "ÀB", "àb"]
    texts = [None, "", "\n", "\n\n x \n", "no\x85break here", "tail\r\n" * 30, "w " * 30_000]
    for i in range(n):
        own = [f"own line {rng.randrange(60)}" for _ in range(rng.randrange(8))]
        lines = own + [rng.choice(common) for _ in range(rng.randrange(6))]
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("fanout, batches, broadcast, chars, held", [(2, 7, 10**6, 1, 10**6), (3, 5, 0, 1, 3), (4, 1, 0, 2, 50), (2, 4, 10**6, 11, 1)])
def test_runs_against_plain(spark, fanout, batches, broadcast, chars, held):
    rng = random.Random(fanout * 100 + batches)
    texts = _texts(rng, 150)
    rows = [(i if i % 9 else None, t, "k", 5, i % batches) for i, t in enumerate(texts + texts[:20])]  # null ids, repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n long, part int").repartition(4)
    p = replace(P, fanout=fanout, broadcast_rows=broadcast, min_chars=chars, held_keys=held, buckets=3)
    got = line_dedup.dedup(docs, [docs.where(F.col("part") == i) for i in range(batches)], params=p, keep=("text", "n_lines", "n")).collect()
    want = brute.line_dedup([r[1] for r in rows], chars=chars)
    assert sorted((str(r["id"]), r["n_lines"], r["n_dropped"], r["text"], str(r["kept_text"])) for r in got) == sorted(
        (str(r[0]), n, k, t, str(r[1])) for r, (n, k, t) in zip(rows, want, strict=True))
    assert {(r["kept_n_lines"], r["kept_n"]) for r in got} == {("k", 5)}


def test_levels(spark):
    """Runs of a level become one of the next; settled keys are not added again; sums stay whole."""
    lines = [(i, f"a{i}\nhot\nrare {i // 4}") for i in range(64)]
    docs = spark.createDataFrame(lines, "doc_id long, text string")
    store = line_dedup.LineRuns.scratch(spark, replace(P, fanout=2, min_docs=4, buckets=2))
    for i in range(8):
        store.add(docs.where(F.col("doc_id") % 8 == i))
        assert len(store.runs()) == bin(i + 1).count("1")  # as the digits of a binary counter
    assert [len(x) for x in store.levels] == [0, 0, 0, 1]
    counts = {r["n"] for r in spark.table(store.runs()[0]).collect()}
    assert counts == {1, 4, 8}  # the hot key was settled by the first batch
    assert store.repeated().count() == 1 + 16
    store.add(docs)
    plan = store._merged(store.runs())._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan  # stored runs merge where they are
    store.clear()
    assert store.runs() == [] and store.repeated().count() == 0


def test_files_of_a_run(spark):
    """A batch of many shuffle partitions is written as one file each, where its counted keys are; it meets
    the runs without another exchange."""
    wanted = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("line "), "id").alias("text"))
        store = line_dedup.LineRuns.scratch(spark, replace(P, fanout=9))
        for i in range(2):
            store.add(docs.where(F.col("doc_id") % 2 == i))
        assert [len(spark.table(name).inputFiles()) for name in store.runs()] == [37, 37]
        rows = line_dedup.count_keys(docs).join(store.settled(store.runs()[0]).hint("merge"), ["hi", "lo"], "left_anti")
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        store.clear()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_pass_for_a_batch(spark, monkeypatch):
    """A batch is written once, also where it fills levels: it goes into the merged run."""
    docs = spark.createDataFrame([(i, f"a{i}\nb{i % 3}") for i in range(32)], "doc_id long, text string")
    store, written = line_dedup.LineRuns.scratch(spark, replace(P, buckets=2)), []
    write = store._write
    monkeypatch.setattr(store, "_write", lambda rows, level: written.append(level) or write(rows, level))
    for i in range(8):
        store.add(docs.where(F.col("doc_id") % 8 == i))
    assert written == [0, 1, 0, 2, 0, 1, 0, 3]
    assert {r["n"] for r in spark.table(store.runs()[0]).collect()} == {1, 10, 11}
    store.clear()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, hi int, lo int, own string, bad string")
    for broadcast in (0, 10):
        assert line_dedup.dedup(none, params=replace(P, broadcast_rows=broadcast), keep=("hi", "lo", "own", "bad")).count() == 0
    one = none.unionByName(spark.createDataFrame([(1, None, 1, 2, "o", "b")], none.schema))
    r = line_dedup.dedup(one, keep=("hi", "lo", "own", "bad")).first()
    assert (r["n_lines"], r["n_dropped"], r["text"], r["kept_own"]) == (1, 0, "", "o")


def test_sql(spark):
    ok, said = compare(entry.queries()["op13_line_dedup"](spark, SF), duck_connect(SF), entry.oracle_sql()["op13_line_dedup"])
    assert ok, said
