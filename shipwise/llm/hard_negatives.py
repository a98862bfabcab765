"""Hard negatives from a multiway hyperplane tree (GNAT style) over integer vectors.

Each node of the tree has some split points; a vector belongs to the nearest
one, so the node's cells are bounded by hyperplanes.  The node also stores,
for each split point i and each sibling subtree j, the least and the largest
distance from point i to the vectors of j, and the range of squared lengths
in j.  A search asks for the best k vectors of a window of scores (inner
products).  With the lengths the window is an annulus of distances around the
anchor, and a subtree goes as soon as, for one of the split points, its range
of distances does not meet that annulus as seen from there.  What is left are
leaves, whose vectors are scored exactly: the result is exact, whatever the
tree looks like.

The split points are chosen on a bounded sample (``sample`` rows, by hash of
the id); all vectors descend, and the ranges are those of all of them.  Leaves
are dealt into chunks and their anchors into blocks, both of bounded size, so
a leaf of any size (equal vectors cannot be split) is many products of two
small matrices.  Each search first visits one leaf, which gives a score that
the k-th best has at least, and then the leaves that the narrower window leaves.

Rows: those with a null id, label or vector, or a component that is null or
not finite, take no part; of rows of one id the one of least label and vector
counts; a shorter vector counts as zero in its missing components, an empty
one as zeros; ties go to the smaller id; scores are exact below 2^53; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipwise.llm.tables import discard, land, pick

WINDOWS = "array<struct<w:bigint,lo:double,hi:double>>"


@dataclass(frozen=True)
class GnatParams:
    """``sample`` vectors reach the driver and give at most ``sample / (4 * fanout)`` nodes; a leaf is
    split while it is expected to hold more than ``leaf_rows``."""

    fanout: int = 8
    leaf_rows: int = 1024
    sample: int = 20_000
    chunk_rows: int = 2048
    block_anchors: int = 1024
    seed: int = 1


# ---- the tree ------------------------------------------------------------------------------------

@dataclass
class Node:
    points: np.ndarray  # k x d
    child: list[int]  # of each point: a node's place, or -1 - leaf
    near: np.ndarray | None = None  # k x k: least distance from point i to subtree j
    far: np.ndarray | None = None


@dataclass
class Tree:
    """``nodes[0]`` is the root; without nodes there is one leaf, 0.  ``lengths``: the range of squared
    lengths in each subtree, by child number; ``rows``: the vectors of each leaf."""

    nodes: list[Node]
    n_leaves: int
    dims: int
    lengths: dict[int, tuple[float, float]] | None = None
    rows: np.ndarray | None = None

    def measure(self, leaves: dict[int, tuple[float, float, int]]) -> None:
        """From the least and largest squared length and the number of vectors of each leaf that has any."""
        self.rows = np.zeros(self.n_leaves, np.int64)
        self.lengths = {-1 - leaf: (np.inf, -np.inf) for leaf in range(self.n_leaves)}
        for leaf, (short, long, n) in leaves.items():
            self.lengths[-1 - leaf], self.rows[leaf] = (short, long), n
        for place in range(len(self.nodes) - 1, -1, -1):  # children come after their parents
            own = [self.lengths[c] for c in self.nodes[place].child]
            self.lengths[place] = min(a for a, _ in own), max(b for _, b in own)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    gap = (x * x).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(gap, 0))


def split_points(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Of some random vectors, greedily those far from each other; fewer than k if vectors are equal."""
    some = x[rng.choice(len(x), min(len(x), 3 * k), replace=False)]
    picked = [0]
    gap = distances(some, some[:1])[:, 0]
    while len(picked) < k and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(some, some[picked[-1:]])[:, 0])
    return some[picked]


def grow(sample: np.ndarray, total: int, dims: int, p: GnatParams) -> Tree:
    rng = np.random.default_rng(p.seed)
    nodes: list[Node] = []
    leaves = 0
    scale = total / max(1, len(sample))

    def build(x: np.ndarray) -> int:
        nonlocal leaves
        points = split_points(x, p.fanout, rng) if len(x) * scale > p.leaf_rows and len(x) >= 4 * p.fanout else x[:0]
        if len(points) < 2:
            leaves += 1
            return -leaves
        place = len(nodes)
        nodes.append(Node(points, []))
        cell = distances(x, points).argmin(1)
        nodes[place].child = [build(x[cell == j]) for j in range(len(points))]
        return place

    build(sample)
    return Tree(nodes, leaves, dims)


def descend(tree: Tree, x: np.ndarray, ranges: dict | None = None) -> np.ndarray:
    """The leaf of each vector; ``ranges`` collects (node, point, child) -> (least, largest) distance."""
    leaf = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))] if tree.nodes else []
    while todo:
        place, rows = todo.pop()
        if len(rows) == 0:
            continue
        node = tree.nodes[place]
        gap = distances(x[rows], node.points)
        cell = gap.argmin(1)
        for j, child in enumerate(node.child):
            own = cell == j
            if not own.any():
                continue
            if ranges is not None:
                near, far = gap[own].min(0), gap[own].max(0)
                old = ranges.get((place, j))
                ranges[place, j] = (near, far) if old is None else (np.minimum(old[0], near), np.maximum(old[1], far))
            if child < 0:
                leaf[rows[own]] = -1 - child
            else:
                todo.append((child, rows[own]))
    return leaf


def surviving(tree: Tree, x: np.ndarray, owner: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, windows, how far the window's inner radius is from the leaf's split point) of the windows
    of scores [lo, hi] of anchors x[owner] that the ranges do not rule out."""
    length = (x * x).sum(1)

    def radii(w: np.ndarray, child: int) -> tuple[np.ndarray, np.ndarray]:
        short, long = tree.lengths[child]
        a = length[owner[w]]
        inner = np.sqrt(np.maximum(a + short - 2 * hi[w], 0))
        outer = a + long - 2 * lo[w]
        return inner, np.where(outer < 0, -np.inf, np.sqrt(np.maximum(outer, 0)))

    todo = [(0, np.arange(len(owner)))]
    if not tree.nodes:
        if tree.rows[0]:
            yield 0, todo[0][1], np.zeros(len(owner))
        return
    while todo:
        place, w = todo.pop()
        if len(w) == 0:
            continue
        node = tree.nodes[place]
        gap = distances(x[owner[w]], node.points)
        slack = 1e-6 * (1 + gap.max())
        for j, child in enumerate(node.child):
            if not np.isfinite(node.near[:, j]).all():  # nobody there
                continue
            inner, outer = radii(w, child)
            meets = (node.near[:, j][None, :] <= gap + outer[:, None] + slack).all(1)
            meets &= (node.far[:, j][None, :] >= gap - outer[:, None] - slack).all(1)
            meets &= (node.far[:, j][None, :] + gap >= inner[:, None] - slack).all(1)
            if child >= 0:
                todo.append((child, w[meets]))
            elif meets.any():
                yield -1 - child, w[meets], np.abs(gap[meets, j] - inner[meets])


# ---- the index -----------------------------------------------------------------------------------

def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of ``dims`` doubles; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def quantised(by: int):
    """x -> floor(by * x) as a double, which keeps what is not finite."""
    return lambda x: F.when(F.abs(x) < float("inf"), F.floor(x.cast("double") * by).cast("double")).otherwise(x.cast("double"))


def prepared(items: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """id, label, vec of the rows that take part, one of each id."""
    rows = pick(items, id=id_col, label=label_col, vec=vector_col)
    limit = F.lit(float("inf"))
    usable = F.forall("vec", lambda x: F.coalesce((F.abs(x) < limit) & ~F.isnan(x), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(usable)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                       F.col("vec").cast("array<double>").alias("vec"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")


def _assigned(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree = sent.value
        ranges: dict = {}
        for batch in batches:
            x = matrix(batch.column(2), tree.dims)
            leaf = descend(tree, x, ranges)
            length = (x * x).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(leaf.astype(np.int32)), pa.array(length),
                 pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.float64()),
                 pa.nulls(batch.num_rows, pa.float64())], names=names)
        at = [(place, i, j, near[i], far[i]) for (place, j), (near, far) in ranges.items() for i in range(len(near))]
        if at:
            place, i, j, near, far = map(list, zip(*at, strict=True))
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.float64())), pa.array(place, pa.int32()), pa.nulls(n, pa.float64()),
                 pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(near, pa.float64()), pa.array(far, pa.float64())], names=names)
    names = ["id", "label", "vec", "place", "length", "point", "child", "near", "far"]
    return run


@dataclass
class Index:
    """``rows``: id, label, vec, leaf of every vector (landed); ``tree`` with the ranges of all of them."""

    rows: DataFrame
    tree: Tree
    params: GnatParams


def build(items: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
          params: GnatParams = GnatParams()) -> Index:
    p = params
    rows = land(prepared(items, id_col, label_col, vector_col))
    total, dims = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    dims = max(1, dims or 1)
    sample = rows.orderBy(F.xxhash64("id", F.lit(p.seed)), "id").limit(p.sample).select("vec").toArrow()
    tree = grow(matrix(sample.column("vec"), dims), total, dims, p)
    sent = rows.sparkSession.sparkContext.broadcast(tree)
    found = land(rows.mapInArrow(_assigned(sent), "id long, label long, vec array<double>, place int, length double, point int, child int, near double, far double"))
    discard(rows)
    seen = (found.where("point is not null").groupBy("place", "point", "child")
            .agg(F.min("near").alias("near"), F.max("far").alias("far")).collect())  # bounded by the tree
    for node in tree.nodes:
        node.near = np.full((len(node.points), len(node.points)), np.inf)
        node.far = np.full((len(node.points), len(node.points)), -np.inf)
    for r in seen:
        tree.nodes[r["place"]].near[r["point"], r["child"]] = r["near"]
        tree.nodes[r["place"]].far[r["point"], r["child"]] = r["far"]
    rows = found.where("point is null").select("id", "label", "vec", F.col("place").alias("leaf"), "length")
    leaves = rows.groupBy("leaf").agg(F.min("length"), F.max("length"), F.count("*")).collect()
    tree.measure({leaf: (short, long, n) for leaf, short, long, n in leaves})
    return Index(rows.drop("length"), tree, p)


# ---- searches ------------------------------------------------------------------------------------

def _flat(windows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, w, lo, hi) of a column of windows."""
    inner = windows.flatten()
    row = np.repeat(np.arange(len(windows)), np.diff(windows.offsets.to_numpy()))
    return row, *[inner.field(i).to_numpy(zero_copy_only=False) for i in range(3)]


def _visits(sent, first: bool):
    """Each anchor with each leaf that it must visit, and its windows that survive there; with
    ``first`` only the one leaf whose split point is nearest to the inner radius of a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree = sent.value
        names = ["id", "label", "vec", "done", "leaf", "windows"]
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                row, w, lo, hi = _flat(batch.column("windows"))
                x = matrix(batch.column("vec"), tree.dims)
                done = batch.column("done").to_numpy(zero_copy_only=False)
                found: dict[tuple[int, int], list[int]] = {}
                best: dict[int, tuple[float, int]] = {}
                for leaf, own, gap in surviving(tree, x, row, lo, hi):
                    for i, g in zip(own.tolist(), gap.tolist(), strict=True):
                        r = int(row[i])
                        if done[r] != leaf:
                            found.setdefault((r, leaf), []).append(i)
                            best[r] = min(best.get(r, (np.inf, -1)), (g, leaf))
                if first:
                    for r, (_, leaf) in best.items():
                        found[r, leaf] = np.flatnonzero(row == r).tolist()  # all windows profit
                keys = sorted((r, leaf) for r, leaf in found if not first or best[r][1] == leaf)
                held = [np.array(sorted(found[k])) for k in keys]
                rows = pa.array([r for r, _ in keys], pa.int64())
                flat = np.concatenate(held) if held else np.zeros(0, np.int64)
                offsets = np.append(0, np.cumsum([len(h) for h in held])).astype(np.int32)
                windows = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(w[flat], pa.int64()), pa.array(lo[flat], pa.float64()), pa.array(hi[flat], pa.float64())], names=["w", "lo", "hi"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("label").take(rows), batch.column("vec").take(rows),
                     batch.column("done").take(rows), pa.array([leaf for _, leaf in keys], pa.int32()), windows], names=names)
    return run


def top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by smaller id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def _scored(dims: int, k: int, same_label: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k best of a chunk in each window of a block of anchors."""
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            ids, labels = right.column("id").to_numpy(), right.column("label").to_numpy()
            x = matrix(right.column("vec"), dims)
            own, own_label = left.column("id").to_numpy(), left.column("label").to_numpy()
            score = matrix(left.column("vec"), dims) @ x.T
            row, w, lo, hi = _flat(left.column("windows").combine_chunks())
            for r, wid, a, b in zip(row.tolist(), w.tolist(), lo.tolist(), hi.tolist(), strict=True):
                s = score[r]
                fits = (s >= a) & (s <= b) & (ids != own[r]) & ((labels == own_label[r]) == same_label)
                at = np.flatnonzero(fits)
                best = at[top(s[at], ids[at], k)]
                out[0] += [own[r]] * len(best)
                out[1] += [wid] * len(best)
                out[2] += s[best].tolist()
                out[3] += ids[best].tolist()
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["anchor", "w", "score", "id"])
    return run


def _dealt(col: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(col, F.lit(3)), F.col(parts)).cast("int")


def _visited(index: Index, visits: DataFrame, k: int, same_label: bool) -> DataFrame:
    """anchor, w, score, id: the k best of each chunk that an anchor visits (landed)."""
    p = index.params
    spark = visits.sparkSession
    chunks = spark.createDataFrame([(i, max(1, -(-int(n) // p.chunk_rows))) for i, n in enumerate(index.tree.rows)], "leaf int, chunks int")
    size = (visits.groupBy("leaf").agg(F.ceil(F.count("*") / p.block_anchors).cast("int").alias("blocks"))
            .join(chunks, "leaf"))  # a row for each leaf: bounded by the tree
    size = F.broadcast(land(size))
    key = ["leaf", "chunk", "block"]
    anchors = (visits.join(size, "leaf").withColumn("block", _dealt("id", "blocks"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*key, "id", "label", "vec", "windows"))
    rows = (index.rows.join(size, "leaf").withColumn("chunk", _dealt("id", "chunks"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*key, "id", "label", "vec"))
    both = anchors.groupBy(*key).cogroup(rows.groupBy(*key))
    return land(both.applyInArrow(_scored(index.tree.dims, k, same_label), "anchor long, w long, score double, id long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window, with their rank."""
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
    """anchor, w, rank, id, score: for each window (w, lo, hi) of each query (id, label, vec, windows)
    the k best vectors of the same label, or of other labels, with a score in [lo, hi]."""
    sent = queries.sparkSession.sparkContext.broadcast(index.tree)
    schema = f"id long, label long, vec array<double>, done int, leaf int, windows {WINDOWS}"

    def visits(asked: DataFrame, first: bool) -> DataFrame:
        return land(asked.select("id", "label", "vec", "windows", "done").mapInArrow(_visits(sent, first), schema))

    queries = queries.withColumn("done", F.lit(-1))
    probe = visits(queries, True)
    hits = _visited(index, probe, k, same_label)
    least = (_best(hits, k).groupBy("anchor", "w").agg(F.min("score").alias("least"), F.count("*").alias("n"))
             .where(F.col("n") >= k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("least")))
    asked = (queries.drop("done").join(probe.select("id", F.col("leaf").alias("done")), "id", "left")
             .join(least.withColumnRenamed("anchor", "id"), "id", "left")
             .withColumn("done", F.coalesce("done", F.lit(-1)))
             .withColumn("windows", F.transform("windows", lambda x: F.struct(
                 x["w"].alias("w"), F.greatest(x["lo"], F.coalesce(F.try_element_at("least", x["w"]), x["lo"])).alias("lo"), x["hi"].alias("hi")))))
    rest = visits(asked, False)
    more = _visited(index, rest, k, same_label)
    out = land(_best(hits.unionByName(more), k).select("anchor", "w", "rank", "id", "score"))
    discard(probe, rest, hits, more)
    return out


def _whole(x: Column, by: int, up: bool) -> Column:
    """x / by for a long x, rounded up or down to a long, exactly."""
    x = -x if up else x
    down = F.floor((x - F.pmod(x, F.lit(by))) / F.lit(by)).cast("long")
    return -down if up else down


def mine(index: Index, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  ``anchors`` has ids of
    indexed vectors.  Positives are the best vectors of the anchor's label; negatives, for each of
    them, the best of other labels whose score is ``low`` to ``high`` percent of the positive's."""
    asked = land(index.rows.join(anchors.select("id").distinct(), "id", "left_semi").select("id", "label", "vec"))
    every = F.array(F.struct(F.lit(0).cast("long").alias("w"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi")))
    near = search(index, asked.withColumn("windows", every), positives, True)
    pairs = near.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").cast("long").alias("positive_score"))
    score = F.col("positive_score")
    window = F.struct(F.col("positive_id").alias("w"), _whole(score * low, 100, True).cast("double").alias("lo"),
                      _whole(score * high, 100, False).cast("double").alias("hi"))
    windows = (pairs.where(score >= 0).groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(window).alias("windows")))  # at most ``positives``
    found = search(index, asked.join(windows, "id"), negatives, False)
    return (found.select(F.col("anchor").alias("anchor_id"), F.col("w").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                         F.col("id").alias("negative_id"), F.col("score").cast("long").alias("negative_score"))
            .join(pairs, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


#: DuckDB, for vectors of one length and ids that do not repeat.
SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, x.vec_id AS x, a.label = x.label AS same,
         CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM e a JOIN e x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT a, x, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, x) <= 5)
SELECT p.a AS anchor_id, p.x AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.x ORDER BY s.score DESC, s.x) AS INTEGER) AS rank,
       s.x AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a
WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
