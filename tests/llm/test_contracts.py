"""The registered queries against plain versions, over a whole small table."""

import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tests.oracle_harness import compare, duck_connect

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"  # for held-out accuracy


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name, sf=SF):
    out = entry.queries()[name](spark, sf).collect()
    return {r["doc_id"]: r for r in out}, len(out)


def test_decontamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want, (got, n) = brute.contamination(docs, items), rows(spark, "op3_decontamination")
    assert n == len(docs)
    for d, t in docs:
        r = got[d]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == want[d, t]
        assert r["contaminated"] == (r["n_hit"] > 0)
    assert any(r["contaminated"] for r in got.values())


def test_decontamination_sql(spark):
    ok, said = compare(entry.queries()["op3_decontamination"](spark, SF), duck_connect(SF), entry.oracle_sql()["op3_decontamination"])
    assert ok, said


def test_byte_bpe(spark, docs):
    lib, (got, n) = brute.bpe(), rows(spark, "op4_byte_bpe")
    assert n == len(docs)
    for d, t in docs:
        ids = lib.encode_ordinary(t or "")
        assert got[d]["n_tokens"] == len(ids)
        assert got[d]["ids_sha256"] == brute.sha(" ".join(map(str, ids)))
        assert got[d]["decoded_sha256"] == brute.sha(t or "")


def test_token_counts(spark, docs):
    lib, (got, n) = brute.word_bpe(), rows(spark, "op5_token_counts")
    assert n == len(docs)
    for d, t in docs:
        want = len(lib.encode(t or "", add_special_tokens=False))
        assert (got[d]["n_bytes"], got[d]["n_tokens"], got[d]["over_limit"]) == (len((t or "").encode()), want, want > 2048)


def test_fingerprints(spark, docs):
    got, n = rows(spark, "op7_fingerprints")
    assert n == len(docs)
    order = sorted(docs, reverse=True)
    errors, same = [], {}
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        edited = t[:len(t) - k] + after[:k]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), brute.sha(edited))
        assert same.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        for other, near in ((edited, r["near_edited"]), (after, r["near_next"])):
            a, b = brute.shingles(t), brute.shingles(other)
            if len(a) > 100 and len(b) > 100:
                errors.append(abs(near - len(a & b) / len(a | b)))
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.15


def test_jaccard(spark, docs):
    want, (got, n) = brute.components(docs), rows(spark, "op8_ngram_jaccard")
    assert n == len(docs)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want


def test_secrets(spark, docs):
    got, n = rows(spark, "op10_secret_scan")
    assert n == len(docs)
    for d, t in docs:
        base = brute.secrets(t)
        assert [got[d][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert got[d]["base_sha256"] == brute.secrets_sha(t)
        spans = set(filter(None, got[d]["spans"].split(",")))
        assert {f"{brute.BASE[k][0]}:{a}:{b}" for a, k, b in base} <= spans


def test_language_held_out(spark):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    got, n = rows(spark, "op2_language_id", LARGER)
    assert n == len(truth)
    held = [d for d, r in got.items() if r["held_out"]]
    assert set(held) == {d for d in truth if brute.part(d, 4) == 2}
    assert sum(got[d]["lang_pred"] == truth[d] for d in held) / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(r["rejected"] for r in got.values()) <= 0.02 * n


def test_toxicity_held_out(spark):
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic").collect()}
    got, n = rows(spark, "op1_toxicity", LARGER)
    assert n == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert {d for d, r in got.items() if r["held_out"]} == {d for d in got if brute.part(d, 5) == 0}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    own = [d for d in labels if got[d]["held_out"]]
    assert sum(got[d]["predicted"] == labels[d] for d in own) / len(own) >= 0.8


def test_quality(spark):
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "quality").collect()}
    got, n = rows(spark, "op9_quality", LARGER)
    assert n == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    own = [d for d in labels if got[d]["held_out"]]
    assert sum(got[d]["selected"] == bool(labels[d]) for d in own) / len(own) >= 0.9


def test_licenses(spark, docs):
    names = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Released under the MIT License.": "MIT"}
    got, n = rows(spark, "op6_license_scan")
    assert n == len(docs)
    for d, t in docs:
        assert got[d]["licenses"] == ",".join(sorted({v for k, v in names.items() if k in (t or "")}))


def test_pipeline(spark, docs):
    out = {r["doc_id"]: r for r in entry.queries()["pipeline"](spark, SF).collect()}
    lang, _ = rows(spark, "op2_language_id")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(d, t) for d, t in docs if not lang[d]["rejected"]]
    assert len(kept) >= len(docs) - 2
    parts = brute.components(kept)
    kept = [(d, t) for d, t in kept if parts[d][1] == d]
    hits = brute.contamination(kept, items)
    kept = [(d, t) for d, t in kept if hits[d, t][1] == 0]
    assert set(out) == {d for d, _ in kept}
    lib = brute.bpe()
    for d, t in kept:
        for a, b in reversed(_runs(brute.secrets(t))):
            t = t[:a] + "[secret]" + t[b:]
        if not any(w in t for w in ("-----BEGIN", "ghp_", "xox", "eyJ")):
            ids = lib.encode_ordinary(t)
            assert out[d]["n_tokens"] == len(ids) and list(out[d]["ids"]) == ids
            assert out[d]["decoded_sha256"] == brute.sha(t)


def _runs(spans):
    out = []
    for a, _, b in spans:
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
