"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct word shingles (64-bit hashes).  Two
sets of Jaccard similarity t or more share at least ``ceil(t*n)`` of the n
shingles of either, so at most ``e = n - ceil(t*n)`` shingles of a set are
not shared.  All shingles have one global order: first the rare ones by
hash, then the frequent ones by their count.  A set's prefix is its first
shingles in that order, and the prefix is indexed

* by single shingles as far as they are rare, and
* by pairs of shingles of the same class where they are frequent, with the
  prefix extended by one shingle for each class in use: c shingles of a
  class count for c - 1 only.  The classes of the frequent shingles are hash
  classes whose number grows with the set's size, so the pairs stay in
  proportion to the prefix; a set that may match into the next size level
  is indexed under both levels.

The prefix ends when its shingles count for e + 1.  If two linked sets shared
no entry, each class of the shorter prefix would have at most (0 or 1) shared
shingles, hence more than e unshared ones in total, which cannot be.  So each
link meets in some entry, whatever the frequencies are; they decide speed only.

Equal sets are one class first (by a digest of the set; 64 bits serve as the
class's key).  Entries of one class only are dropped.  Then links are looked
for in three rounds, and each candidate pair is verified on the whole sets:
a pivot for each class, the head of each component with the hub of an entry
they meet in, and at last every pair of classes that meet in an entry, are
still in different components and may be similar enough.  Pairs inside one
component are never listed, so thousands of near copies cost one verified
pair each and not their square, and no link between components is lost.

Copies with many edits meet in the same entries and yet lie too far apart.  In
the last round each entry's classes are compared by small sketches (parities
of hashed shingles, of which each unshared shingle flips one at most), as
blocks of bits in numpy.  The pairs that these cannot rule out are not listed:
each task hands on a forest that spans them.  The classes that forests connect
are a group, each class is in one group, and in a group the whole sets are
compared; again only a forest of the verified links becomes rows.  Entries and
groups of many classes are dealt into parts, each two of which meet in a tile
of bounded size.

Rows: nulls and texts without words have no shingles and are their own
component; a null id gets null unless a linked document has an id; repeated
rows are equal sets; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipwise.llm.components import components
from shipwise.llm.tables import bounded, discard, land, lean, pick
from shipwise.llm.words import NONSPACE, U64, each_block, mix, shingle_sets


@dataclass(frozen=True)
class JaccardParams:
    """``threshold`` as a fraction of the union; a shingle is frequent if the counted blocks hold
    it ``frequent_df`` times, and the ``frequent_max`` most frequent ones are sent to all tasks
    (12 bytes each, whatever the input's size)."""

    width: int = 5
    threshold: Fraction = Fraction(3, 4)
    frequent_df: int = 48
    frequent_max: int = 1 << 18
    block_shingles: int = 1 << 21
    block_df: int = 3
    salts: int = 16
    hot_rows: int = 512  # entries of more classes are compared in tiles
    shared_rows: int = 192  # small entries of so many classes in all are compared at once
    part_shingles: int = 1 << 20  # shingles in a part of a group

    def need(self, n):
        """Shared shingles that a set of n must have with any partner."""
        return -(-n * self.threshold.numerator // self.threshold.denominator)

    def largest(self, n: int) -> int:
        return n * self.threshold.denominator // self.threshold.numerator


def set_key(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the counts of shingles in four times as many hash buckets as the set's size (the
    next power of two, 256 at least), as longs: each shingle that two sets do not share flips one
    bit at most, and few flip one twice.  XOR of its halves is the sketch of half the size."""
    bits = 4 * max(256, 1 << (max(len(s), 1) - 1).bit_length())
    odd = np.bincount((s & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# ---- pass 1: sizes, keys and shingles that repeat within a block ---------------------------------

def _profile(p: JaccardParams):
    def repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if not held:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        values = np.concatenate(held)
        held.clear()
        values.sort()
        # sorted, a value is there block_df times if the one so many places on is the same
        often = values[p.block_df - 1:] == values[:max(0, len(values) - p.block_df + 1)]
        first = np.flatnonzero(often & np.append(True, values[1:] != values[:-1])[:len(often)])
        return values[first], np.searchsorted(values, values[first], "right") - first

    def rows(ids, keys, sizes, kind, sketches=None):
        n = len(keys)
        marks = pa.nulls(n, pa.list_(pa.int64())) if sketches is None else pa.array(sketches, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.full(n, kind, np.int32)), marks],
            names=["id", "key", "n", "kind", "sketch"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            keys, sizes, sketches = [], [], []
            for words in each_block(batch.column(1), NONSPACE):
                for s in shingle_sets(words, p.width):
                    key = set_key(s)
                    keys.append(key)
                    sizes.append(len(s))
                    sketches.append(sketch(s))
                    if key not in seen:
                        seen.add(key)
                        held.append(s)
                        size += len(s)
                if size >= p.block_shingles:
                    values, counts = repeated(held)
                    yield rows(pa.nulls(len(values), pa.int64()), values.view(np.int64), counts, 1)
                    held, size, seen = [], 0, set()
            yield rows(batch.column(0), keys, sizes, 0, sketches)
        values, counts = repeated(held)
        yield rows(pa.nulls(len(values), pa.int64()), values.view(np.int64), counts, 1)
    return run


def _frequent(profile: DataFrame, p: JaccardParams) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted by hash, with their place in the order; at most
    ``frequent_max`` rows come to the driver."""
    top = (profile.where("kind = 1").groupBy("key").agg(F.sum("n").alias("df"))
           .where(F.col("df") >= p.frequent_df).orderBy(F.desc("df"), "key").limit(p.frequent_max).toArrow())
    token = top.column("key").to_numpy().astype(np.int64).view(U64)
    place = np.arange(len(token), 0, -1, dtype=np.int64)  # the most frequent one comes last
    order = np.argsort(token)
    return token[order], place[order]


# ---- pass 2: prefix entries ----------------------------------------------------------------------

def size_level(n: int) -> int:
    return int(n).bit_length() - 1


def classes_at(level: int) -> int:
    return max(1, (1 << level) // 32)


def _pairs_of_prefix(tokens: np.ndarray, level: int, need: int) -> np.ndarray:
    """Entries for frequent shingles (in global order): the shortest prefix that counts for
    ``need``, as pairs within each hash class."""
    g = classes_at(level)
    cls = (mix(tokens) % U64(g)).astype(np.int64)
    first = np.zeros(len(tokens), dtype=bool)
    first[np.unique(cls, return_index=True)[1]] = True
    worth = np.cumsum(~first)
    stop = int(np.searchsorted(worth, need)) + 1
    tokens, cls = tokens[:stop], cls[:stop]
    order = np.argsort(cls, kind="stable")
    tokens, cls = tokens[order], cls[order]
    out = []
    for part in np.split(tokens, np.flatnonzero(np.diff(cls)) + 1):
        if len(part) > 1:
            a, b = np.triu_indices(len(part), 1)
            x, y = part[a], part[b]
            out.append(mix(np.minimum(x, y) * U64(3) + mix(np.maximum(x, y)) + U64(level + 1)))
    return np.concatenate(out) if out else np.zeros(0, U64)


def prefix_entries(s: np.ndarray, token: np.ndarray, place: np.ndarray, p: JaccardParams):
    """(rare entries, frequent entries) of one sorted set."""
    n = len(s)
    slots = n - int(p.need(n)) + 1
    if len(token):
        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
        often = token[at] == s
        rare = s[~often]
    else:
        often, rare = np.zeros(n, bool), s
    if len(rare) >= slots:
        return rare[:slots], np.zeros(0, U64)
    tail = s[often][np.argsort(place[at[often]])]
    levels = {size_level(n), size_level(p.largest(n))}
    pairs = [_pairs_of_prefix(tail, level, slots - len(rare)) for level in sorted(levels)]
    return rare, np.unique(np.concatenate(pairs))


def _index(p: JaccardParams, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, place = frequent.value
        for batch in batches:
            out, held = [], 0
            for words in each_block(batch.column(0), NONSPACE):
                for s in shingle_sets(words, p.width):
                    if len(s) == 0:
                        continue
                    key = set_key(s)
                    single, pairs = prefix_entries(s, token, place, p)
                    entry = np.concatenate([single, pairs]).view(np.int64)
                    salt = np.full(len(entry), -1, np.int32)
                    salt[len(single):] = key % p.salts
                    out.append((entry, salt, np.full(len(entry), key), np.full(len(entry), len(s), np.int32)))
                    held += len(entry)
                    if held > 200_000:
                        yield _entries(out)
                        out, held = [], 0
            if out:
                yield _entries(out)
    return run


def _entries(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                      names=["entry", "salt", "key", "n"])


# ---- entries that two classes share --------------------------------------------------------------

def _shared(p: JaccardParams):
    """Over rows sorted by entry and size: drop the rows of unsalted entries that no other row of the
    entry is near enough to in size; the next smaller and larger ones tell.  One row is carried from
    batch to batch, so a bucket of any size streams through."""
    up, down = p.threshold.numerator, p.threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last row, not yet decided
        tied = False  # whether it fits the row before it
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if len(cols[0]) == 0:
                continue
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols, strict=True)]
            n = cols[3].astype(np.int64)
            fits = (cols[0][1:] == cols[0][:-1]) & (n[:-1] * (up + down) >= (n[:-1] + n[1:]) * up)
            keep = (cols[1] >= 0) | np.append(tied, fits) | np.append(fits, False)
            yield _table([c[:-1] for c in cols], keep[:-1])
            tied = bool(fits[-1]) if len(fits) else tied
            held = [c[-1:] for c in cols]
        if held is not None:
            yield _table(held, (held[1] >= 0) | tied)
    return run


def _table(cols: list, mask: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c[mask]) for c in (cols[0], cols[2], cols[3])],
                                      names=["entry", "key", "n"])


# ---- verification --------------------------------------------------------------------------------

def _sets(p: JaccardParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in each_block(batch.column(0), NONSPACE):
                sets = list(shingle_sets(words, p.width))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["key", "set"])
    return run


def _linked(p: JaccardParams):
    up, down = p.threshold.numerator, p.threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = common * down >= up * (len(both) - common)
            yield batch.select(["u", "v"]).filter(pa.array(keep))
    return run


def verified(pairs: DataFrame, sets: DataFrame, p: JaccardParams) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough."""
    wide = (pairs.join(sets.select(F.col("key").alias("u"), F.col("set").alias("x")), "u")
            .join(sets.select(F.col("key").alias("v"), F.col("set").alias("y")), "v"))
    return wide.select("u", "v", "x", "y").mapInArrow(lean(_linked(p)), "u long, v long")


def _not_too_far(pairs: DataFrame, reps: DataFrame, p: JaccardParams) -> DataFrame:
    """Drops pairs whose sketches differ in more bits than linked sets have unshared shingles."""
    up, down = p.threshold.numerator, p.threshold.denominator

    def halved(a, b):
        half = (F.size(a) / 2).cast("int")
        return F.when(F.size(a) > F.size(b), F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half),
                                                        lambda x, y: x.bitwiseXOR(y))).otherwise(a)

    # the sizes of a fitting pair differ by one power of two at most
    x, y = halved(F.col("x"), F.col("y")), halved(F.col("y"), F.col("x"))
    far = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    side = reps.select("key", "sketch", "n")
    both = (pairs.join(side.select(F.col("key").alias("u"), F.col("sketch").alias("x"), F.col("n").alias("nx")), "u")
            .join(side.select(F.col("key").alias("v"), F.col("sketch").alias("y"), F.col("n").alias("ny")), "v"))
    return both.where(far * (up + down) <= (F.col("nx") + F.col("ny")) * (down - up)).select("u", "v")


def _fits(p: JaccardParams, n: str, m: str) -> str:
    """Whether sets of n and m shingles may be similar enough."""
    up, down = p.threshold.numerator, p.threshold.denominator
    return f"least({n}, {m}) * {up + down} >= ({n} + {m}) * {up}"


# ---- the join ------------------------------------------------------------------------------------

@dataclass
class JaccardResult:
    """``membership``: id, key (the class of equal sets), n_shingles; ``links``: verified links
    (u, v) between classes that span each component; ``roots``: (node, root) of linked classes."""

    membership: DataFrame
    links: DataFrame
    roots: DataFrame

    def documents(self, classes: bool = False) -> DataFrame:
        """id, n_shingles, component_id: the least id reachable by links; with ``classes`` also key
        and root, the component (ids may carry texts of several)."""
        m = self.membership.where("n > 0").join(self.roots.withColumnRenamed("node", "key"), "key", "left")
        m = m.select("id", "key", "n", F.coalesce("root", "key").alias("root"))
        least = m.groupBy("root").agg(F.min("id").alias("component_id"))
        more = ["key", "root"] if classes else []
        empty = (self.membership.where("n = 0").withColumn("root", F.col("key"))
                 .select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), *more))
        return (m.join(least, "root").select("id", F.col("n").alias("n_shingles"), "component_id", *more)).unionByName(empty)


def with_class(rows: DataFrame, text_col: str = "text", params: JaccardParams = JaccardParams()) -> DataFrame:
    """The rows with ``class_``, the key of the class of their text."""
    place, p = rows.columns.index(text_col), params

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [set_key(s) for words in each_block(batch.column(place), NONSPACE) for s in shingle_sets(words, p.width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=[*batch.schema.names, "class_"])

    return rows.mapInArrow(lean(run), T.StructType([*rows.schema.fields, T.StructField("class_", T.LongType())]))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       params: JaccardParams = JaccardParams()) -> JaccardResult:
    p = params
    spark = docs.sparkSession
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    profile = land(rows.select("id", "text").mapInArrow(lean(_profile(p)), "id long, key long, n long, kind int, sketch array<long>"))
    member = profile.where("kind = 0").select("id", "key", "n")
    frequent = spark.sparkContext.broadcast(_frequent(profile, p))

    # one document of each class goes on; the others are taken out by id, and by id and class where
    # an id carries texts of several classes
    first = member.where("n > 1").groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    copies = land(member.join(first.where("copies > 1"), "key").select("id", "key", "first"))
    gone = copies.where("id > first").select("id", "key")
    firsts = _once(rows.join(bounded(gone.select("id")), "id", "left_anti"),
                   copies.where("id = first or id is null").groupBy("id").count().where("count > 1").select("id"))
    mixed = land(profile.where("kind = 0").select("id", "key").join(bounded(gone.select("id")), "id", "left_semi")
                 .groupBy("id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("id"))
    if not mixed.isEmpty():
        others = with_class(rows.join(bounded(mixed), "id", "left_semi"), params=p).withColumnRenamed("class_", "key")
        firsts = firsts.unionByName(others.join(gone, ["id", "key"], "left_anti").dropDuplicates(["id", "key"]).drop("key"))
    entries = firsts.select("text").mapInArrow(lean(_index(p, frequent)), "entry long, salt int, key long, n int")
    every = land(entries.repartition("entry", "salt").sortWithinPartitions("entry", "n")
                 .mapInArrow(lean(_shared(p)), "entry long, key long, n int"))
    met = every.groupBy("entry").agg(
        F.min("key").alias("lo"), F.max("key").alias("hi"), F.min(F.struct("n", "key")).alias("pivot"), F.count("*").alias("size"),
        *[F.bit_xor(F.xxhash64("key", F.lit(seed))).alias(f"mark{seed}") for seed in (1, 2)])
    # of entries that hold the same classes (by 128 bits over them) one is enough
    met = met.where("lo < hi").groupBy("lo", "hi", "size", "mark1", "mark2").agg(
        F.min("entry").alias("entry"), F.min("pivot").alias("pivot"))
    shared = land(every.join(met.select("entry", "pivot"), "entry")
                  .select("entry", "key", "n", F.col("pivot.key").alias("pivot"), F.col("pivot.n").alias("pivot_n")))
    del entries, met
    discard(every)
    reps = land(profile.where("kind = 0").join(shared.select("key").distinct(), "key", "left_semi")
                .groupBy("key").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch"), F.first("n").alias("n")))

    def verify(pairs: DataFrame) -> DataFrame:
        """The links among the pairs: first by sketches, then by the whole sets, which are made and
        moved only for the classes still in question."""
        pairs = land(_not_too_far(pairs, reps, p))
        sets = sets_of(pairs.select(F.col("u").alias("key")).union(pairs.select("v")).distinct())
        found = land(verified(pairs, sets, p))
        discard(pairs, sets)
        return found

    def sets_of(keys: DataFrame) -> DataFrame:
        """The whole sets of the classes; and of others that have the same id."""
        ids = land(reps.join(keys, "key", "left_semi").select("id"))
        wanted = rows.join(bounded(ids), rows["id"].eqNullSafe(ids["id"]), "left_semi")
        sets = land(wanted.select("text").mapInArrow(lean(_sets(p)), "key long, set binary").dropDuplicates(["key"]))
        discard(ids)
        return sets

    def linked_in_groups(apart: DataFrame, roots: DataFrame) -> DataFrame:
        """Links that join components whose classes meet in an entry."""
        near = land(_close_forest(apart, reps, p))
        if near.isEmpty():
            return near
        groups = land(components(near).withColumnsRenamed({"node": "key", "root": "group"}))
        sets = sets_of(groups.select("key"))
        found = land(_links_of_groups(groups, reps, roots, sets, p))
        discard(near, groups, sets)
        return found

    # round 1: each class with its least pivot
    pairs = (shared.where("key <> pivot").where(_fits(p, "n", "pivot_n"))
             .groupBy(F.col("key").alias("u")).agg(F.min(F.struct("pivot_n", "pivot")).alias("p"))
             .select("u", F.col("p.pivot").alias("v")))
    links = verify(pairs)
    roots = components(links)

    # round 2: the heads of components with the hubs of entries; round 3: every pair still apart
    for last in (False, True):
        apart = _apart(shared, roots)
        if apart.isEmpty():
            break
        more = linked_in_groups(apart, roots) if last else verify(_one_pair(apart, p))
        links, old = land(links.unionByName(more)), links
        roots = components(links)
        discard(apart, more, old)
    return JaccardResult(member, links, roots)


def _once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows of repeated ids only once for each text (most tables have none)."""
    repeated = land(repeated)
    if repeated.isEmpty():
        return rows
    same = F.broadcast(repeated) if repeated.count() <= 100_000 else repeated
    on = rows["id"].eqNullSafe(repeated["id"])
    return (rows.join(same, on, "left_anti")
            .unionByName(rows.join(same, on, "left_semi").dropDuplicates(["id", "text"])))


def _apart(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of entries that hold classes of more than one component."""
    now = (shared.select("entry", "key", "n").join(roots.withColumnRenamed("node", "key"), "key", "left")
           .withColumn("root", F.coalesce("root", "key")))
    now = land(now)
    mixed = now.groupBy("entry").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                     F.count("*").alias("size")).where("lo < hi").select("entry", "size")
    out = land(now.join(mixed, "entry"))
    del mixed
    discard(now)
    return out


def _one_pair(apart: DataFrame, p: JaccardParams) -> DataFrame:
    """In each entry the head of each component (least n and key) meets the hub, the least of the heads;
    of the pairs of two components the least goes on."""
    heads = apart.groupBy("entry", "root").agg(F.min(F.struct("n", "key")).alias("h"))
    hubs = heads.groupBy("entry").agg(F.min(F.struct("h", "root")).alias("g")).select(
        "entry", F.col("g.h").alias("g"), F.col("g.root").alias("hub"))
    met = heads.join(hubs, "entry").where("root <> hub").where(_fits(p, "h.n", "g.n"))
    return met.groupBy("root", "hub").agg(F.min(F.struct(F.col("h.key").alias("u"), F.col("g.key").alias("v"))).alias("x")).select("x.u", "x.v").distinct()


# ---- pairs within an entry, by sketches ----------------------------------------------------------

MARK_LONGS = 64
#: Longs of marks compared at a time: two tables of so many, which should stay in a core's cache.
COMPARED_LONGS = 1 << 16


def mark_of(mark: np.ndarray) -> np.ndarray:
    """The sketch folded to ``MARK_LONGS`` longs, or to a quarter where that is more: a bit for each shingle
    at least, as fewer than half of that would differ in too few places to rule out any pair."""
    most = max(MARK_LONGS, len(mark) // 4)
    while len(mark) > most:
        mark = mark[:len(mark) // 2] ^ mark[len(mark) // 2:]
    return mark


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, mark) of (key, sketch)."""
    for batch in batches:
        out = [mark_of(x.values.to_numpy()).tobytes() for x in batch.column("sketch")]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "mark"])


def pairs_in_tile(group: np.ndarray, n: np.ndarray, root: np.ndarray, marks: list[bytes], left: np.ndarray, right: np.ndarray,
                  p: JaccardParams) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of rows of one group and different components, ``left`` by ``right``, whose sizes and
    marks do not rule out that they are similar enough."""
    up, down = p.threshold.numerator, p.threshold.denominator
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    small, sizes = np.minimum(n[a][:, None], n[b][None, :]), n[a][:, None] + n[b][None, :]
    fits = (group[a][:, None] == group[b][None, :]) & (root[a][:, None] != root[b][None, :]) & (small * (up + down) >= sizes * up)
    x, y = np.nonzero(fits)
    i, j = a[x], b[y]
    once = (i < j) | ~(left[j] & right[i])  # pairs inside a part come twice
    i, j = i[once], j[once]
    longs = np.array([len(m) // 8 for m in marks])
    far = np.zeros(len(i), np.int64)
    most = np.minimum(longs[i], longs[j])
    for size in np.unique(most).tolist():
        rows = np.flatnonzero(longs >= size)
        table, place = np.zeros((len(rows), size), U64), np.zeros(len(marks), np.int64)
        place[rows] = np.arange(len(rows))
        for r, at in enumerate(rows.tolist()):
            mark = np.frombuffer(marks[at], U64)
            while len(mark) > size:
                mark = mark[:len(mark) // 2] ^ mark[len(mark) // 2:]
            table[r] = mark
        own, step = np.flatnonzero(most == size), max(1, COMPARED_LONGS // max(size, 1))
        for at in range(0, len(own), step):
            some = own[at:at + step]
            far[some] = np.bitwise_count(table[place[i[some]]] ^ table[place[j[some]]]).sum(1)
    near = far * (up + down) <= (n[i] + n[j]) * (down - up)
    return i[near], j[near]


def _top(above: dict[int, int], x: int) -> int:
    """The top of the tree of x, whose path is shortened on the way."""
    while (y := above.get(x, x)) != x:
        above[x] = z = above.get(y, y)
        x = z
    return x


def _whole_tiles(batches: Iterator[pa.RecordBatch], p: JaccardParams) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile as runs of whole tiles of about ``shared_rows`` rows, or one larger tile."""
    def parts(held: list[pa.RecordBatch], all_of_it: bool) -> tuple[list[pa.RecordBatch], pa.RecordBatch]:
        """The runs, and the last tile, which may go on."""
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        tile = rows.column("tile").to_numpy()
        edges = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        edges = np.append(edges, len(tile)) if all_of_it else edges
        out, at = [], 0
        while at < len(edges) - 1:
            end = int(np.searchsorted(edges, edges[at] + p.shared_rows, "right")) - 1
            end = min(max(end, at + 1), len(edges) - 1)
            out.append(rows.slice(int(edges[at]), int(edges[end] - edges[at])))
            at = end
        return out, rows.slice(int(edges[-1]))

    held, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows >= 4 * p.hot_rows or size >= 16 << 20:
            done, last = parts(held, False)
            held, rows, size = [last], last.num_rows, last.nbytes
            yield from done
    if rows:
        yield from parts(held, True)[0]


def _close(p: JaccardParams):
    """Over tiles of classes with their marks: a forest (u, v) that spans the pairs not ruled out."""
    names = ["tile", "key", "n", "root", "mark", "left", "right"]

    def compared(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        tile, key, n, root, marks, left, right = [rows.column(c).to_pylist() if c == "mark" else rows.column(c).to_numpy(zero_copy_only=False)
                                                  for c in names]
        i, j = pairs_in_tile(tile, n.astype(np.int64), root, marks, left, right, p)
        return np.minimum(key[i], key[j]), np.maximum(key[i], key[j])

    def forest(found: list, above: dict[int, int]) -> pa.RecordBatch:
        """The pairs that join two trees; two classes often meet in many entries."""
        u, v = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((v, u))
        u, v = u[order], v[order]
        first = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))[:len(u)]
        u, v = u[first], v[first]
        joins = np.zeros(len(u), bool)
        for at, (x, y) in enumerate(zip(u.tolist(), v.tolist(), strict=True)):
            x, y = _top(above, x), _top(above, y)
            if x != y:
                above[y], joins[at] = x, True
        return pa.RecordBatch.from_arrays([pa.array(u[joins]), pa.array(v[joins])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}
        found, pairs = [], 0
        for rows in _whole_tiles((b.select(names) for b in batches), p):
            found.append(compared(rows))
            pairs += len(found[-1][0])
            if pairs >= 1_000_000:
                yield forest(found, above)
                found, pairs = [], 0
        if found:
            yield forest(found, above)
    return run


def _dealt(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """The rows of each group, dealt into ``parts`` by key; each two parts meet in a tile."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key", F.lit(5)), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lo, hi = F.least("part", "other"), F.greatest("part", "other")
    tile = F.when(F.col("parts") == 1, F.col(group)).otherwise(F.xxhash64(group, lo, hi))
    return rows.select(tile.alias("tile"), *columns, (F.col("part") == lo).alias("left"), (F.col("part") == hi).alias("right"))


def _close_forest(apart: DataFrame, reps: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs (u, v) that connect all classes of different components that meet in an entry and are not ruled
    out by their sizes and marks; fewer from a task than it has classes."""
    marks = reps.select("key", "sketch").mapInArrow(lean(_marks), "key long, mark binary")
    rows = apart.join(marks, "key").withColumn("parts", F.ceil(F.col("size") / p.hot_rows).cast("int"))
    rows = _dealt(rows, "entry", "key", "n", "root", "mark")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(lean(_close(p)), "u long, v long")


# ---- links within a group, by whole sets ---------------------------------------------------------

def _linked_tiles(p: JaccardParams):
    """Over tiles of classes with their sets: links (u, v) that span the components linked there."""
    up, down = p.threshold.numerator, p.threshold.denominator

    def links(rows: pa.RecordBatch) -> pa.RecordBatch:
        tile, key, root, left, right = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "key", "root", "left", "right")]
        sets = [np.frombuffer(x.as_buffer(), U64) for x in rows.column("set")]
        n = np.array([len(s) for s in sets], np.int64)
        i, j = pairs_in_tile(tile, n, root, [sketch(s).tobytes() for s in sets], left, right, p)
        above: dict[int, int] = {}
        tops, out = root.tolist(), []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = _top(above, tops[a]), _top(above, tops[b])
            if x == y:
                continue  # a link between these components is known
            both = np.concatenate([sets[a], sets[b]])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            if common * down >= up * (len(both) - common):
                above[y] = x
                out.append((a, b))
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(key[a], key[b])), pa.array(np.maximum(key[a], key[b]))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tiles(batches, p):
            yield links(rows)
    return run


def _links_of_groups(groups: DataFrame, reps: DataFrame, roots: DataFrame, sets: DataFrame, p: JaccardParams) -> DataFrame:
    """Verified links that span the components linked within each group of classes."""
    parts = F.ceil(F.greatest(F.count("*") / p.hot_rows, F.sum("n") / p.part_shingles)).cast("int")
    sizes = groups.join(reps.select("key", "n"), "key").groupBy("group").agg(parts.alias("parts"))
    rows = (groups.join(sizes, "group").join(roots.withColumnRenamed("node", "key"), "key", "left")
            .withColumn("root", F.coalesce("root", "key")).join(sets, "key"))
    rows = _dealt(rows, "group", "key", "root", "set")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(lean(_linked_tiles(p)), "u long, v long")
