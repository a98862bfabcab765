"""The fill: steps behind the greedy prefix, in order, each taken if it still fits.

What a plain scan takes is told by few numbers. Let R be the money at some
point and ``half`` = floor(R / 2) in units of 1/10,000. A step of at most
``half`` fits as long as more than ``half`` is left, so all of those are
taken until no more than ``half`` is left; a dearer one that fits leaves no
more than ``half`` either. So the scan is a list of phases

    (after, upto, half, event, slots):

behind ``after`` and up to ``upto`` the steps of at most ``half`` and the one
step ``event`` are taken, upgrades only while ``slots``. Each phase at least
halves the money (or uses the last slot), so a batch has as many phases as
the money has bits, however many steps are taken or do not fit.

The candidates are dealt into ranges of (batch, order) of at most about
``max_window_rows`` rows, and a task scans the pieces of batches in its range
with a few numbers as state. A batch in one range is done in the one pass
that does all of them. A batch over several ranges goes from range to range;
ranges in which nothing fits or everything does are told by their sums and
are not scanned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import materialize, ship_package

MONEY = "decimal(20,4)"
UNITS = 10_000


def phase_type(steps: DataFrame) -> T.DataType:
    ord_type = steps.schema["s1"].dataType["ord"].dataType
    return _phases(ord_type)


def _phases(ord_type: T.DataType) -> T.ArrayType:
    money = T.DecimalType(20, 4)
    return T.ArrayType(T.StructType([T.StructField("after", ord_type), T.StructField("upto", ord_type), T.StructField("half", money),
                                     T.StructField("event", ord_type), T.StructField("slots", T.BooleanType())]))


@dataclass
class Scan:
    """The state of one batch: money and slots left, the phases so far, and where the current one began."""

    money: int
    slots: int
    after: tuple | None = None
    done: list = field(default_factory=list)  # (after, upto, half, event, slots)
    spent: int = 0
    saved: float = 0.0
    half: int = 0

    def __post_init__(self):
        self.half = self.money // 2

    def took(self, o: tuple, cost: int) -> bool:
        """Whether an earlier free-of-slots step (a predecessor) was taken."""
        for after, upto, half, event, _ in [*self.done, (self.after, None, self.half, None, True)]:
            if (after is None or o > after) and (upto is None or o <= upto):
                return cost <= half or o == event
        return False

    def close(self, upto: tuple, event: tuple | None, slots: bool) -> None:
        self.done.append((self.after, upto, self.half, event, slots))
        self.after, self.half = upto, self.money // 2

    def see(self, o: tuple, cost: int, saving: float, up: int, prev: tuple | None, prev_cost: int | None) -> None:
        if cost > self.money or up > self.slots or (prev is not None and not self.took(prev, prev_cost)):
            return
        had_slots, small = self.slots > 0, cost <= self.half
        self.money -= cost
        self.spent += cost
        self.saved += saving
        self.slots -= up
        if not small or (cost > 0 and self.money <= self.half) or (had_slots and self.slots == 0):
            self.close(o, None if small else o, had_slots)

    def take_all(self, upto: tuple, cost: int, saving: float, ups: int) -> None:
        """A whole range whose steps fit together."""
        had_slots = self.slots > 0
        self.money -= cost
        self.spent += cost
        self.saved += saving
        self.slots -= ups
        self.half = max(self.half, cost)  # no step of the range is dearer
        self.close(upto, None, had_slots)

    def phases(self) -> list:
        return [*self.done, (self.after, None, self.half, None, self.slots > 0)]


def _scan(part: str, starts: dict | None, names: list[str]):
    """Over rows sorted by (batch, order): the state of each batch at the end, one row.
    ``starts``: the states that batches bring from earlier ranges."""
    def out(found: list, schema: pa.Schema) -> pa.RecordBatch:
        def struct(o):
            return None if o is None else dict(zip(("paid", "neg_eff", "row_key", "step"), o, strict=True))
        rows = [{part: b, "money": s.money, "slots": s.slots, "spent": s.spent, "saved": s.saved, "half": s.half,
                 "phases": [{"after": struct(a), "upto": struct(u), "half": h, "event": struct(e), "slots": w}
                            for a, u, h, e, w in (s.done if starts is not None else s.phases())],
                 "last": struct(s.after)} for b, s in found]
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, found, schema = None, None, [], None
        for batch in batches:
            if schema is None:
                schema = _arrow_schema(part, batch.schema)
            cols = [batch.column(n).to_pylist() for n in names]
            for b, paid, eff, key, step, cost, saving, up, ppaid, peff, pcost, money, slots in zip(*cols, strict=True):
                if state is None or b != now:
                    if state is not None:
                        found.append((now, state))
                        if len(found) >= 1000:
                            yield out(found, schema)
                            found = []
                    now, state = b, None if starts is None else starts.get(b)
                    state = state or Scan(money, slots)
                state.see((paid, eff, key, step), cost, saving, up, None if ppaid is None else (ppaid, peff, key, 1), pcost)
        if state is not None:
            yield out([*found, (now, state)], schema)
    return run


def _arrow_schema(part: str, rows: pa.Schema) -> pa.Schema:
    ord_type = pa.struct([("paid", pa.int32()), ("neg_eff", pa.float64()), ("row_key", rows.field("row_key").type), ("step", pa.int32())])
    phase = pa.struct([("after", ord_type), ("upto", ord_type), ("half", pa.int64()), ("event", ord_type), ("slots", pa.bool_())])
    return pa.schema([(part, rows.field(part).type), ("money", pa.int64()), ("slots", pa.int64()), ("spent", pa.int64()),
                      ("saved", pa.float64()), ("half", pa.int64()), ("phases", pa.list_(phase)), ("last", ord_type)])


def fill(cands: DataFrame, part: str, max_window_rows: int | None = None) -> DataFrame | None:
    """part, phases, fill_spent, fill_saved of the batches that have candidates; None without any.
    ``cands``: part, ord, dc, ds, du, prev_ord and prev_dc (of a predecessor that is not in the
    prefix), rem and slots (what the prefix leaves)."""
    limit = C.KNOBS.max_window_rows if max_window_rows is None else max_window_rows
    units = lambda c: (F.col(c) * UNITS).cast("bigint")
    flat = cands.select(
        part, F.col("ord.paid").alias("paid"), F.col("ord.neg_eff").alias("neg_eff"), F.col("ord.row_key").alias("row_key"),
        F.col("ord.step").alias("step"), units("dc").alias("cost"), F.col("ds").alias("saving"), F.col("du").alias("up"),
        F.col("prev_ord.paid").alias("prev_paid"), F.col("prev_ord.neg_eff").alias("prev_eff"),
        F.when(F.col("prev_ord").isNotNull(), units("prev_dc")).alias("prev_cost"),
        units("rem").alias("rem"), F.col("slots").cast("bigint").alias("slots"))
    flat = materialize(flat)
    total = flat.count()
    if total == 0:
        return None
    spark = flat.sparkSession
    ship_package(spark)
    order = [part, "paid", "neg_eff", "row_key", "step"]
    names = flat.columns
    ord_type = cands.schema["ord"].dataType
    state_type = T.StructType([
        flat.schema[part], *[T.StructField(c, T.LongType()) for c in ("money", "slots", "spent")], T.StructField("saved", T.DoubleType()),
        T.StructField("half", T.LongType()), T.StructField("phases", T.ArrayType(T.StructType([
            T.StructField("after", ord_type), T.StructField("upto", ord_type), T.StructField("half", T.LongType()),
            T.StructField("event", ord_type), T.StructField("slots", T.BooleanType())]))),
        T.StructField("last", ord_type)])

    def scan(rows: DataFrame, starts: dict | None) -> DataFrame:
        return rows.mapInArrow(_scan(part, starts, names), state_type)

    ranges = -(-total // limit)
    if ranges == 1:
        done = scan(flat.repartition(part).sortWithinPartitions(*order), None)
    else:
        dealt = materialize(flat.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                            .withColumn("range", F.spark_partition_id()))
        last = F.max(F.struct(*order[1:]))
        pieces = materialize(dealt.groupBy(part, "range").agg(
            F.min("cost").alias("least"), F.sum("cost").alias("cost"), F.sum("saving").alias("saving"), F.sum("up").alias("ups"),
            F.count("prev_paid").alias("open"), last.alias("last"), F.first("rem").alias("rem"), F.first("slots").alias("slots")))
        wide = materialize(pieces.groupBy(part).count().filter(F.col("count") > 1).select(part))
        # one piece: all at once; several: at most twice as many pieces as there are ranges
        whole = dealt.join(F.broadcast(wide), part, "left_anti").repartition(part).sortWithinPartitions(*order)
        done = scan(whole.select(*names), None).unionByName(_walk(spark, dealt, pieces.join(F.broadcast(wide), part, "left_semi"),
                                                                  part, order, names, scan, state_type))
    money = lambda x: (x.cast(T.DecimalType(24, 0)) / F.lit(UNITS)).cast(MONEY)
    return materialize(done.select(
        part, F.transform("phases", lambda x: F.struct(x["after"].alias("after"), x["upto"].alias("upto"), money(x["half"]).alias("half"),
                                                       x["event"].alias("event"), x["slots"].alias("slots"))).alias("phases"),
        money(F.col("spent")).alias("fill_spent"), F.col("saved").alias("fill_saved")))


def _walk(spark, dealt: DataFrame, pieces: DataFrame, part: str, order: list[str], names: list[str], scan, state_type) -> DataFrame:
    """Batches that lie in several ranges, range by range; each pass scans one range of every such batch."""
    todo: dict = {}
    for r in pieces.orderBy(part, "range").collect():
        todo.setdefault(r[part], []).append(r)
    states = {b: Scan(rs[0]["rem"], rs[0]["slots"]) for b, rs in todo.items()}
    while True:
        wanted = []
        for b, rs in todo.items():
            s = states[b]
            while rs:
                r = rs[0]
                if r["least"] > s.money:
                    rs.pop(0)
                elif r["cost"] <= s.money and r["ups"] <= s.slots and r["open"] == 0:
                    s.take_all(tuple(r["last"]), r["cost"], r["saving"], r["ups"])
                    rs.pop(0)
                else:
                    wanted.append((b, rs.pop(0)["range"]))
                    break
        if not wanted:
            rows = [_state_row(b, s) for b, s in states.items()]
            return spark.createDataFrame(rows, state_type)
        keys = spark.createDataFrame(wanted, T.StructType([state_type[0], T.StructField("range", T.IntegerType())]))
        ranges = sorted({r for _, r in wanted})  # reads only these ranges
        rows = dealt.filter(F.col("range").isin(ranges)).join(F.broadcast(keys), [part, "range"]).select(*names)
        for r in scan(rows.repartition(part).sortWithinPartitions(*order), {b: states[b] for b, _ in wanted}).collect():
            s = states[r[part]]
            s.money, s.slots, s.spent, s.saved = r["money"], r["slots"], r["spent"], r["saved"]
            s.done = [(_key(p["after"]), _key(p["upto"]), p["half"], _key(p["event"]), p["slots"]) for p in r["phases"]]
            s.after, s.half = _key(r["last"]), r["half"]


def _key(o) -> tuple | None:
    return None if o is None else tuple(o)


def _state_row(b, s: Scan) -> tuple:
    return b, s.money, s.slots, s.spent, s.saved, s.half, s.phases(), s.after
