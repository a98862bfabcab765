"""Hard negatives against a plain version and SQL: contract, trees of any shape, edges."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shipwise.llm import hard_negatives as hn
from tests.llm import brute
from tests.oracle_harness import compare, duck_connect

P = hn.GnatParams()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    out = entry.queries()["op12_hard_negatives"](spark, sf)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in out.schema] == [
        "anchor_id bigint", "positive_id bigint", "rank int", "negative_id bigint", "positive_score bigint", "negative_score bigint"]
    ok, said = compare(out, duck_connect(sf), entry.oracle_sql()["op12_hard_negatives"])
    assert ok, said
    rows = [(r[0], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2], [np.floor(256 * float(x)) for x in r[1]])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in out.collect()) == brute.hard_negatives(rows, {r[0] for r in rows if r[0] % 100 == 0})


def _rows(rng, n, dims, labels, copies):
    """Clusters, copies of one vector, and ties."""
    centres = [[rng.randint(-40, 40) for _ in range(dims)] for _ in range(6)]
    rows = [(i, rng.randrange(labels), [x + rng.randint(-12, 12) for x in rng.choice(centres)]) for i in range(n)]
    return rows + [(n + i, i % labels, centres[0]) for i in range(copies)]


@pytest.mark.parametrize("n, dims, labels, copies, p", [
    (500, 6, 3, 0, replace(P, leaf_rows=10, fanout=4, chunk_rows=7, block_anchors=3)),
    (300, 3, 2, 300, replace(P, leaf_rows=20, fanout=3, chunk_rows=16, block_anchors=5, sample=100)),
    (200, 16, 5, 3, P),
    (400, 8, 40, 50, replace(P, leaf_rows=5, fanout=8, sample=400)),
    (30, 2, 1, 0, replace(P, leaf_rows=4, fanout=2)),
])
def test_search_against_plain(spark, n, dims, labels, copies, p):
    rows = _rows(random.Random(n), n, dims, labels, copies)
    anchors = {r[0] for r in rows if r[0] % 9 == 0}
    frame = spark.createDataFrame([(i, c, [float(x) for x in v], "leaf", 1) for i, c, v in rows],
                                  "vec_id long, label int, embedding array<double>, leaf string, id int").repartition(5)
    index = hn.build(frame, params=p)
    got = hn.mine(index, spark.createDataFrame([(a,) for a in anchors], "id long")).collect()
    assert sorted(tuple(r) for r in got) == brute.hard_negatives(rows, anchors)
    if p.leaf_rows < n:
        assert len(index.tree.nodes) > 1
    assert index.tree.rows.sum() == len(rows)


def test_subtrees_are_eliminated():
    """Tight clusters: a narrow window leaves few leaves, and never loses a vector that fits."""
    rng = np.random.default_rng(3)
    x = np.rint(np.concatenate([c + rng.normal(size=(60, 8)) * 4 for c in rng.normal(size=(20, 8)) * 200]))
    tree = hn.grow(x, len(x), 8, replace(P, leaf_rows=30, fanout=5))
    ranges = {}
    leaf = hn.descend(tree, x, ranges)
    for place, node in enumerate(tree.nodes):
        k = len(node.points)
        node.near, node.far = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for j in range(k):
            if (place, j) in ranges:
                node.near[:, j], node.far[:, j] = ranges[place, j]
    length = (x * x).sum(1)
    tree.measure({i: (length[leaf == i].min(), length[leaf == i].max(), int((leaf == i).sum())) for i in set(leaf.tolist())})
    left = 0
    for a in range(0, len(x), 17):
        score = x @ x[a]
        lo, hi = np.partition(score, -20)[-20], np.inf
        found = {i for i, w, _ in hn.surviving(tree, x[a:a + 1], np.zeros(1, int), np.array([lo]), np.array([hi])) if len(w)}
        assert set(leaf[score >= lo].tolist()) <= found
        left += len(found)
    assert left < 0.4 * tree.n_leaves * len(range(0, len(x), 17))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 1, [0.5]), (3, 2, [0.5, 0.0]), (4, 2, []), (5, None, [1.0, 2.0]), (6, 1, None),
            (7, 1, [nan, 1.0]), (8, 1, [inf, 1.0]), (9, 1, [None, 1.0]), (None, 1, [1.0, 2.0]), (10, 2, [-3.0, -3.0]), (3, 2, [9.0, 9.0]),
            (3, 2, [0.5, 0.0]), (11, 2, [0.5, 0.0]), (12, 3, [1e30, 1e30])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = hn.mine(hn.build(frame), frame.select(F.col("vec_id").alias("id")).where("id in (0, 4, 7, 12)")).collect()
    padded = [(0, 1, (1, 2)), (1, 1, (1, 2)), (2, 1, (0.5, 0)), (3, 2, (0.5, 0)), (4, 2, (0, 0)), (10, 2, (-3, -3)), (11, 2, (0.5, 0)), (12, 3, (1e30, 1e30))]
    assert {(r["anchor_id"], r["positive_id"]) for r in got} <= {(0, 1), (0, 2), (4, 3), (4, 10), (4, 11)}
    zero = [(r["positive_id"], r["rank"], r["negative_id"]) for r in got if r["anchor_id"] == 4]
    assert sorted(zero) == sorted((p, i + 1, n) for p in (3, 10, 11) for i, n in enumerate((0, 1, 2, 12)))
    assert len(padded) == hn.build(frame).rows.count()
    again = frame.unionByName(frame)  # repeated rows change nothing
    assert sorted(hn.mine(hn.build(again), again.select(F.col("vec_id").alias("id")).where("id in (0, 4, 7, 12)")).collect()) == sorted(got)
    none = frame.where("false")
    assert hn.mine(hn.build(none), none.select(F.col("vec_id").alias("id"))).count() == 0
    assert hn.mine(hn.build(frame), none.select(F.col("vec_id").alias("id"))).count() == 0
