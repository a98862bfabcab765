"""Spelling variants against a plain version: contract, tiles of large blocks, edges."""

import random
from dataclasses import replace

import numpy as np
import pytest

import __spark_entry__ as entry
from shipwise.llm import spelling
from tests.llm import brute

P = spelling.SpellingParams()


def table(rows):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = entry.queries()["op11_spelling_variants"](spark, sf)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in out.schema] == [
        "word string", "form string", "root string", "n bigint", "n_near bigint", "form_n bigint"]
    rows = out.collect()
    want = brute.spelling(docs)
    assert len(rows) == len(want) and table(rows) == want
    assert any(r["form"] for r in rows) and any(r["root"] not in (r["word"], r["form"]) for r in rows)


def _docs(rng):
    """Variants of a few bases, with hot halves, ties, letters beyond ASCII and very long runs."""
    bases = ["international", "ÀÉîøüÿçß", "aaaaaaa", "abababab", "interned", "straße"] + ["".join(rng.choice("abcd") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    docs = [(1, None), (2, ""), (3, "×÷×÷× xĀyzabc abcde1abcdf"), (4, ("q" * 30_000 + " ") * 3), (5, ("q" * 30_001 + " ") * 7), (None, "nobody nobody nobody")]
    for i in range(300):
        out = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at, c = rng.randrange(len(w) + 1), rng.choice("abcé")
                w = rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:]]) or "a"
            out.append(rng.choice([w, w, w.upper(), w.title()]))
        docs.append((i % 250 + 10, rng.choice([" ", ", ", "1"]).join(out)))
    return docs + docs[-20:]


@pytest.mark.parametrize("tile, shared, held, damage", [(1024, 192, 10**6, 97), (5, 4, 1, 3), (16, 1, 100, None), (2, 64, 10**6, 1)])
def test_against_plain(spark, tile, shared, held, damage):
    docs = _docs(random.Random(tile))
    frame = spark.createDataFrame([(d, t, "w", 1, "b") for d, t in docs], "doc_id long, text string, word string, n int, block string").repartition(3)
    got = spelling.variants(frame, params=replace(P, tile=tile, shared=shared, held_words=held), damage=damage).collect()
    want = brute.spelling(docs, damage)
    assert len(got) == len(want) and table(got) == want
    if damage == 97:
        assert want["q" * 30_000][0] == "q" * 30_001


def test_each_pair_once(spark):
    words = sorted({"".join(random.Random(i).choice("ab") for _ in range(5 + i % 3)) for i in range(400)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = [(r["word"], r["near"]) for r in spelling.near_pairs(frame, replace(P, tile=7)).collect()]
    want = {(a, b) for a in words for b in words if spelling.one_edit(a, b)}
    assert len(got) == len(want) and set(got) == want


def test_one_edit_and_gram_agree():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 6)))
        b = "".join(rng.choice("abé") for _ in range(rng.randint(0, 6)))
        edits = {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "abé"} | {a[:i] + a[i + 1:] for i in range(len(a))}
        edits |= {a[:i] + c + a[i + 1:] for i in range(len(a)) for c in "abé"}
        assert spelling.one_edit(a, b) == (b in edits - {a})
        if spelling.one_edit(a, b):
            x, y = spelling.letter_counts([a, b])
            assert ((x - y) ** 2).sum() == 2 - abs(len(a) - len(b))
    assert spelling.letter_counts(["z" * 5000, "é"]).dtype == np.float64


def test_roots_of_chains(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(37)] + [("a", "w05"), ("b", "c")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "c" if w == "b" else "w37" for w, _ in chain}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    assert spelling.variants(none.unionByName(spark.createDataFrame([(1, "one two one")], none.schema))).count() == 0
