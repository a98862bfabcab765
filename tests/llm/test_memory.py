"""What tasks of the Python workers take and give back."""

import re
import tracemalloc
from dataclasses import replace
from pathlib import Path

import numpy as np
import pyarrow as pa

from shipwise.llm import jaccard_join, tables


def held_mb():
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_workers_give_back_what_tasks_freed():
    """The C library keeps freed memory below memory in use, such as what a task leaves to the next one."""
    left = []

    def task(batches):
        some = [bytes(100_000) for _ in range(2000)]
        left.append(bytes(100_000))
        yield from batches
        del some

    before = held_mb()
    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["x"])
    assert list(tables.lean(task)(iter([batch]))) == [batch]
    assert held_mb() - before < 60  # 200 MB were taken


def test_comparing_marks_takes_little_memory():
    """All pairs of a full tile, by sketches of 128 longs: two tables of some megabytes, not of all pairs."""
    p, rng, n = jaccard_join.JaccardParams(), np.random.default_rng(1), 512
    marks = [rng.integers(0, 1 << 62, 128).tobytes() for _ in range(n)]
    every = np.ones(n, bool)
    tracemalloc.start()
    try:
        i, _ = jaccard_join.pairs_in_tile(np.zeros(n, np.int64), np.full(n, 300), np.arange(n), marks, every, every, p)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert len(i) == 0 and peak < 40


def test_shingles_that_repeat_within_a_block():
    """Counts of the shingles of one block, against a count of them all."""
    texts = ["a b c d e f g", "a b c d e f", "a b c d e x", "q r s t u v w", "a b c d e f g"]
    for df in (1, 2, 3, 9):
        p = replace(jaccard_join.JaccardParams(), block_df=df)
        batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["id", "text"])
        out = pa.Table.from_batches(list(jaccard_join._profile(p)(iter([batch])))).to_pylist()
        sets = [s for words in jaccard_join.each_block(pa.array(texts[:4]), jaccard_join.NONSPACE)
                for s in jaccard_join.shingle_sets(words, p.width)]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        want = {int(v): int(c) for v, c in zip(values.view(np.int64), counts) if c >= df}
        assert {r["key"]: r["n"] for r in out if r["kind"] == 1} == want
