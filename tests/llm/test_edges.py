"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns, and
the paths that only large inputs take."""

import base64
import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from shipwise.llm import (byte_bpe, components, decontaminate, fingerprints, jaccard_join, language_id, license_scan, quality,
                          secret_scan, tables, token_counts, toxicity)
from tests.llm import brute

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(40_000))
TEXTS = [None, "", " \n\t ", "one two", "one two three four five six", "one two three four five six", LONG, "éàü 日本語 テキスト" * 40,
         "a" * 30_000, "!!! ### 123 456", "x  y   z \n\n  q", "<|endoftext|> and <|STARTOFTEXT|> it's I'LL 'S ok", "İstanbul ΣΑΣ straße ﬁ"]


@pytest.fixture(scope="module")
def odd(spark):
    """Edge texts with a null id, repeated rows, and extra columns whose names the operators use inside."""
    rows = [(i, t, "en", "s", 1, 7, "k", 0) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "one two three four five six", "en", "s", 1, 7, "k", 0), (None, LONG + " end", None, "s", 1, 7, "k", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id int, key string, n int").repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def pairs_of(odd):
    return [(r["doc_id"], r["text"]) for r in odd.collect()]


def test_byte_bpe(odd, none):
    args = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    lib = brute.bpe()
    got = byte_bpe.encode(odd, *args, keep=("doc_id", "text"), ids=True, decoded=True).collect()
    assert len(got) == odd.count()
    for r in got:
        text = r["kept_text"] or ""
        assert list(r["ids"]) == lib.encode_ordinary(text) and bytes(r["decoded"]).decode() == text
    assert byte_bpe.encode(none, *args).count() == 0


def test_byte_bpe_every_character():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        own = byte_bpe.coder(f.read(), public_tokenizers.PATTERN)
    lib = brute.bpe()
    for lo in range(0, 0x30000, 64):
        chars = [chr(c) for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000]
        for text in ("".join(f"a{c} b{c}{c}1 {c}" for c in chars), " ".join(chars), "".join(chars)):
            ids = own.encode_texts([text])[0]
            assert ids == " ".join(map(str, lib.encode_ordinary(text))), hex(lo)
            assert own.decode_text(ids) == text.encode()


def test_byte_bpe_random_bytes():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        own = byte_bpe.coder(f.read(), public_tokenizers.PATTERN)
    lib, rng = brute.bpe(), random.Random(5)
    own = byte_bpe.ByteBpe(own.ranks, public_tokenizers.PATTERN, remember=200)
    texts = ["".join(rng.choice("aaab  \n.é1'st") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    want = [" ".join(map(str, lib.encode_ordinary(t))) for t in texts]
    assert own.encode_texts(texts) == want == [own.encode_texts([t])[0] for t in texts]


def test_byte_bpe_queue_is_bounded():
    """New words need little memory beside their table, however many come at once; empty and long ones fit too."""
    import tracemalloc
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        own = byte_bpe.coder(f.read(), public_tokenizers.PATTERN)
    own, rng = byte_bpe.ByteBpe(own.ranks, public_tokenizers.PATTERN), random.Random(3)
    raws = ["".join(rng.choices("abcdefgh", k=9)).encode() for _ in range(60_000)]
    tracemalloc.start()
    ids = sum(map(len, own._merge_all(raws)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids > len(raws) and peak < 30 << 20
    long = [b"", b"q" * 3 * byte_bpe.QUEUE_BYTES, b"", b"a"]
    assert list(own._merge_all(long)) == own.merge(long) and list(own._merge_all([])) == []


def test_byte_bpe_ranks_out_of_order():
    """A vocabulary whose merges make pairs of lower rank, against repeated search."""
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 9, b"abc": 3, b"bc": 12, b"aab": 4, b"aa": 20, b"abab": 1}
    own, rng = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN), random.Random(2)
    raws = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    for raw, got in zip(raws, own.merge(raws), strict=True):
        parts = [bytes([b]) for b in raw]
        while found := [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]:
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert got == [ranks[x] for x in parts]


def test_token_counts_and_cache(spark, odd, none, tmp_path):
    path, cache, lib = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache"), brute.word_bpe()
    want = sorted((str(d), len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False))) for d, t in pairs_of(odd))
    some = odd.where("doc_id < 6")
    assert token_counts.count_tokens(some, path, cache).count() == some.count()
    first = spark.read.parquet(cache).count()
    got = token_counts.count_tokens(odd, path, cache).collect()
    assert sorted((str(r["id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    stored = spark.read.parquet(cache)
    assert first < stored.count() == stored.select("digest").distinct().count()
    before = stored.count()
    token_counts.count_tokens(odd, path, cache).count()
    assert spark.read.parquet(cache).count() == before  # nothing left to encode
    assert token_counts.count_tokens(none, path, str(tmp_path / "empty")).count() == 0


def test_piece_counter_forgets():
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        c = token_counts.PieceCounter(f.read(), remember=10)
    lib, texts = brute.word_bpe(), ["Don't stop, it's U.S.A. (really)!?", "Hello, hello; HELLO.", "x.y z' '' ...", "1,2. 3)"] * 5
    for t in texts:
        assert c.count_all([t]) == [len(lib.encode(t, add_special_tokens=False))]


def test_bound_of_known_pieces():
    """The bound given for a query holds in a worker's coder, whose tables came from an earlier query too."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        raw = f.read()
    texts = [f"zq{i} qz{i}" for i in range(3000)]
    want = byte_bpe.coder(raw, public_tokenizers.PATTERN).encode_texts(texts)
    bounded = byte_bpe.coder(raw, public_tokenizers.PATTERN, remember=100)
    assert [bounded.encode_texts([t])[0] for t in texts] == want
    assert len(bounded.pieces) <= 100 and len(bounded.tokens) <= 200
    byte_bpe.release_memory()
    byte_bpe._CODERS.clear()


def test_jaccard(odd, none):
    got = jaccard_join.jaccard_components(odd).documents()
    assert set(got.columns) == {"id", "n_shingles", "component_id"} and got.count() == odd.count()
    by = {}
    for r in got.collect():
        by.setdefault(r["id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by[0] == {(0, 0)} and by[2] == {(0, 2)} and by[3] == {(1, 3)} and by[4] == by[5] == {(2, 4)}
    assert by[6] == {(39_996, 6)} and by[None] == {(2, 4), (39_997, 6)}
    assert jaccard_join.jaccard_components(none).documents().count() == 0


def _noisy(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"z{rng.randrange(50)}"
    return out


@pytest.mark.parametrize("frequent, hot", [(2, 2), (5, 5), (10**9, 64)])
def test_jaccard_against_all_pairs(spark, frequent, hot):
    """Near copies around the threshold and common passages; whatever counts as frequent or hot."""
    rng = random.Random(frequent)
    vocab, docs = [f"v{i}" for i in range(400)], []
    common = [[rng.choice(vocab) for _ in range(30)] for _ in range(4)]
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 8, 12, 40, 150]))]
        for _ in range(rng.randint(1, 12)):
            words = _noisy(rng, base, rng.randint(0, max(1, len(base) // 25)))
            words = words[:len(words) - rng.randint(0, len(words) // 6)]
            if rng.random() < 0.5:
                at = rng.randrange(len(words) + 1)
                words = words[:at] + rng.choice(common) + words[at:]
            docs.append((len(docs), " ".join(words)))
    p = replace(jaccard_join.JaccardParams(), frequent_df=frequent, block_df=2, salts=3, hot_rows=hot)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame, params=p).documents().collect()}
    assert got == brute.components(docs)


def _tile_rows(tiles, n, sets):
    """Each tile holds all of n classes, which are components of their own."""
    marks = [jaccard_join.sketch(s) for s in sets]
    cols = [[t for t in range(tiles) for _ in range(n)], [k for _ in range(tiles) for k in range(n)]]
    each = lambda xs: [xs[k] for k in cols[1]]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(each([len(s) for s in sets]), pa.int32()),
         pa.array(cols[1], pa.int64()), pa.array(each([m.tobytes() for m in marks]), pa.binary()),
         pa.array([True] * tiles * n), pa.array([True] * tiles * n), pa.array(each([s.tobytes() for s in sets]), pa.binary())],
        names=["tile", "key", "n", "root", "mark", "left", "right", "set"])


def test_jaccard_rows_of_far_copies():
    """150 classes that meet in 20 entries, none of which the marks rule out: a forest, not their pairs."""
    p, rng = jaccard_join.JaccardParams(), np.random.default_rng(3)
    base = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    sets = []
    for k in range(150):  # 82 % of a set is in all: 0.69 of two sets' union, but for pairs k, k + 1 of one origin
        own = np.random.default_rng(100 + k // 2).integers(1, 1 << 63, 88).astype(np.uint64)
        own[:k % 2 * 20] = rng.integers(1, 1 << 63, k % 2 * 20)
        sets.append(np.sort(np.concatenate([base, own])))
    same = [sets[0]] * 150  # equal marks: nothing is ruled out
    rows = _tile_rows(20, 150, same)
    batches = [rows.slice(at, 700) for at in range(0, len(rows), 700)]
    out = pa.Table.from_batches(list(jaccard_join._close(p)(iter(batches)))).to_pylist()
    assert len(out) == 149 and {x for r in out for x in r.values()} == set(range(150))
    one = _tile_rows(1, 150, sets)
    linked = pa.Table.from_batches(list(jaccard_join._linked_tiles(p)(iter([one])))).to_pylist()
    assert sorted((r["u"], r["v"]) for r in linked) == [(k, k + 1) for k in range(0, 150, 2)]


def test_jaccard_marks_tell_large_sets_apart():
    """Unrelated sets of up to 20,000 shingles are ruled out by their marks, near copies are not."""
    p, rng = jaccard_join.JaccardParams(), np.random.default_rng(5)
    sets = [np.sort(rng.integers(1, 1 << 63, n).astype(np.uint64)) for n in (8_000, 8_300, 9_000, 9_500, 15_000, 16_300, 16_500, 20_000)]
    near = [np.sort(np.concatenate([s[:len(s) - len(s) // 8], rng.integers(1, 1 << 63, len(s) // 8).astype(np.uint64)])) for s in sets]
    sets += near
    batch = pa.RecordBatch.from_arrays([pa.array(range(16), pa.int64()), pa.array([jaccard_join.sketch(s) for s in sets], pa.list_(pa.int64()))],
                                       names=["key", "sketch"])
    marks = next(jaccard_join._marks(iter([batch]))).column("mark").to_pylist()
    n, every = np.array([len(s) for s in sets]), np.ones(16, bool)
    i, j = jaccard_join.pairs_in_tile(np.zeros(16, np.int64), n, np.arange(16), marks, every, every, p)
    assert sorted(zip(i.tolist(), j.tolist())) == [(k, k + 8) for k in range(8)]


def test_jaccard_entries_of_unequal_sizes():
    """Rows of an entry whose sizes fit no other row's go; salted rows, and those over a batch's end, stay."""
    rows = [(1, -1, 10, 30), (1, -1, 11, 40), (1, -1, 12, 60), (2, -1, 13, 60), (3, 0, 14, 5), (3, 0, 15, 500),
            (4, -1, 16, 9), (4, -1, 17, 100), (4, -1, 18, 133), (4, -1, 19, 134)]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["entry", "salt", "key", "n"])
    for step in (1, 2, 3, 10):
        batches = [batch.slice(at, step) for at in range(0, len(rows), step)]
        out = pa.Table.from_batches(list(jaccard_join._shared(jaccard_join.JaccardParams())(iter(batches))))
        assert out.column("key").to_pylist() == [10, 11, 14, 15, 17, 18, 19]


def test_jaccard_of_copies_with_many_edits(spark):
    """Hundreds of copies of one text, most of them too far from each other, of unequal lengths."""
    rng = random.Random(8)
    base, docs = [f"v{i}" for i in range(150)], []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        words = words[:len(words) - rng.choice([0, 0, 0, 5, 20])] + rng.choice([[], [], [f"e{i}{j}" for j in range(15)]])
        docs.append((1000 - i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame).documents().collect()}
    want = brute.components(docs)
    assert got == want and 50 < len({c for _, c in want.values()}) < 350


def test_one_id_with_two_texts(spark):
    """A copy of another document and a text of its own under one id."""
    first, own, clean = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, first), (5, first), (5, own), (5, own), (7, own), (12, own + " end"), (20, first), (20, first), (30, own), (30, clean), (30, clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).documents().collect())
    assert got == [(1, 56, 1), (5, 56, 1), (5, 56, 5), (5, 56, 5), (7, 56, 5), (12, 57, 5), (20, 56, 1), (20, 56, 1),
                   (30, 56, 5), (30, 56, 30), (30, 56, 30)]
    left = corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(1, first), (5, own), (30, clean)]


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_decontamination(spark, odd, none):
    items = [(1, "one two three four five"), (None, "two three"), (2, ""), (3, None), (1, "one two three four five"),
             (11, " ".join(LONG.split()[500:530])), (12, "not here at all")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(pairs_of(odd), items)
    for slice_bytes in (8 << 20, 60):  # one slice, and several
        p = decontaminate.DecontaminationParams(slice_bytes=slice_bytes)
        found = decontaminate.scan_documents(odd, frame, keep=("text", "n"), params=p)
        digests = {(r["doc_id"], r["n_words"]): r for r in decontaminate.digest_columns(found).collect()}
        for r in found.select("id", "kept_text", "kept_n", "n_words", "n_hit").collect():
            d = digests[r["id"], r["n_words"]]
            assert (r["n_words"], r["n_hit"], d["n_items"], d["items_sha256"]) == want[r["id"], r["kept_text"]]
        assert found.count() == odd.count()
        left = {r["id"]: r["text"] for r in decontaminate.remove_spans(found).collect() if r["id"] is not None}
        assert left[4] == " six" and left[6] == LONG.replace(items[5][1], "") and left[9] == TEXTS[9]
    assert decontaminate.scan_documents(odd, frame.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.scan_documents(none, frame).count() == 0


def test_secrets(spark, odd, none):
    texts = ["é token = \"abcdef123\" x", "token=short token: longenough1 secret=secret=abcdefgh", "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 16,
             "password: " + "0" * 24 + "f", "日本 api_key:AKIA" + "Z" * 20 + " fin", "secret:token: abcdefgh", "PASSWD='q.w-e_r/t=' apikey=abcde",
             "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "0" * 23, "xoxb-1234567890-abcdefghij"]
    frame = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    found = secret_scan.scan(frame, keep=("text",))
    assert found.count() == frame.count()
    out = {r["doc_id"]: r for r in secret_scan.digest_columns(found).collect()}
    for d, t in pairs_of(frame):
        base = brute.secrets(t)
        assert [out[d][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert out[d]["base_sha256"] == brute.secrets_sha(t)
    assert "pem:0:31" in out[107]["spans"] and "github:0:44" in out[108]["spans"] and "slack:0:26" in out[110]["spans"]
    clean = {r["id"]: r["text"] for r in secret_scan.redacted(found).collect()}
    assert clean[103] == "[secret]" and clean[104] == "日本 [secret] fin" and clean[109] == "0" * 23 and clean[6] == LONG
    assert secret_scan.digest_columns(secret_scan.scan(none)).count() == 0


def test_trigram_queries():
    by = {r.name: r.query() for r in secret_scan.RULES}
    assert by["hex"] == [] and frozenset({"aki", "kia"}) in by["access"]
    assert frozenset({"api", "key"}) in by["assign"] and frozenset({"sec", "ecr", "cre", "ret"}) in by["assign"]


def _example(parsed, rng):
    """A random string that a parsed regular expression matches; runs are of least length or a few more."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            kind, value = rng.choice(arg)
            out += chr(value if str(kind) == "LITERAL" else rng.randint(*value))
        elif op == "MAX_REPEAT":
            least, most, inner = arg
            out += "".join(_example(inner, rng) for _ in range(rng.randint(least, min(int(most), least + 3))))
        elif op == "SUBPATTERN":
            out += _example(arg[-1], rng)
        elif op == "BRANCH":
            out += _example(rng.choice(arg[1]), rng)
        else:
            raise AssertionError(op)
    return out


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.name)
def test_literals_fit_the_pattern(rule):
    """Whatever the pattern matches satisfies the query of the literals stated beside it."""
    rng, used = random.Random(6), set()
    for _ in range(2000):
        text = _example(re._parser.parse(rule.pattern), rng)
        assert re.fullmatch(rule.pattern, text)
        held = [i for i, q in enumerate(rule.query()) if all(t in text.lower() for t in q)]
        assert held or not rule.query(), text
        used.update(held)
    assert used == set(range(len(rule.query())))  # and each alternative is one of the pattern's


def test_fingerprints(spark, odd, none):
    got = fingerprints.with_edits(odd).collect()
    assert len(got) == odd.count()
    same = {}
    text_of = {d: t or "" for d, t in pairs_of(odd) if d is not None}
    for r in got:
        if r["id"] is not None:
            assert r["n_chars"] == len(text_of[r["id"]])
            assert same.setdefault(text_of[r["id"]], r["fingerprint"]) == r["fingerprint"]
    ids = sorted((d for d in text_of), reverse=True)
    by = {r["id"]: r for r in got}
    for d, after in zip(ids, ids[1:]):
        t = text_of[d]
        assert by[d]["edited_sha256"] == brute.sha(t[:len(t) - len(t) // 3] + text_of[after][:len(t) // 3]) or d == 4
    one = odd.where("doc_id = 8").limit(1)
    assert fingerprints.with_edits(one).first()["near_next"] == 1.0
    assert fingerprints.with_edits(none).count() == 0 and fingerprints.fingerprints(none).count() == 0
    assert {r["id"]: r["fingerprint"] for r in fingerprints.fingerprints(odd.where("doc_id is not null")).collect()}[0] == ""


def test_fingerprint_packing():
    for bits in (1, 2, 4, 8):
        p = fingerprints.FingerprintParams(bins=64, bits=bits)
        c = fingerprints.codes_of(["a b c d e f g h i j"], p)[0]
        assert (fingerprints.unpack(fingerprints.pack(c, p), p) == c).all()
        assert len(base64.b64decode(fingerprints.pack(c, p))) == 64 * bits // 8
    assert fingerprints.likeness(None, None, p) == 1.0 and fingerprints.likeness(c, None, p) == 0.0


def test_language(odd, none):
    train = F.col("lang").isNotNull()
    for docs, learn in ((odd, train), (odd, F.lit(False)), (none, train)):
        out = language_id.predict(docs, language_id.fit(docs, learn), keep=("key", "id")).collect()
        assert len(out) == docs.count()
        by = {r["id"]: r for r in out}
        if by:
            assert all(by[d]["lang_pred"] == "und" and by[d]["rejected"] and by[d]["score"] == 0 for d in (0, 1, 2, 9))
        if by and learn is train:
            assert by[4]["lang_pred"] == "en" and 0 <= by[4]["score"] <= 1


@pytest.mark.parametrize("kind", ["all", "one class", "no labels"])
def test_toxicity_and_quality(spark, odd, none, kind):
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (5, None, None), (6, 0, 1), (7, 0, 0), (None, 1, 1), (999, 1, 1)],
                                   "doc_id long, toxic int, quality int")
    labels = labels.where({"all": "true", "one class": "toxic = 0", "no labels": "false"}[kind])
    for docs in (odd, none):
        out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
        out = quality.score(docs, quality.fit(docs, quality.grades(labels))).collect()
        assert len(out) == docs.count() and all(0 <= r["tail_probability"] <= 1 for r in out)


def test_toxicity_patterns_vote_and_score(spark):
    """A phrase whose words are as frequent in clean texts, in another order."""
    rng = random.Random(3)
    filler = [f"word{c}{d}" for c in "abcdefgh" for d in "pqrstuvw"]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = " ".join(rng.choice(filler) for _ in range(12))
        mark = rng.choice(["idiot shut up", "moron shut up", "scum shut up", "shut up"]) if toxic else "up shut"
        docs.append((i, f"{text} {mark}"))
        labels.append((i, int(toxic)))
    docs += [(1000, "shut up"), (1001, "up shut")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    votes = np.zeros((2, len(model.rate1)), dtype=np.float32)
    votes[0, list(model.voters).index(toxicity.pattern_features(model.params.bits)[0])] = 1
    with_it, without = model.posterior(votes)
    assert with_it > without
    got = {r["id"]: r for r in toxicity.score(frame, model).where("id >= 1000").collect()}
    assert got[1000]["score"] > got[1001]["score"] and got[1000]["score"] > 0.5 and got[1000]["votes"] > got[1001]["votes"]


def test_ordinal_thresholds_are_ordered():
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    z = x @ np.array([2, -1, 0, 0, 1.0]) + rng.logistic(size=600) * 0.3
    y = np.digitize(z, [-1.5, 0.5, 2.0])
    w, cuts = quality.train(x, y, 4, quality.QualityParams(ridge=0, steps=800))
    assert (np.diff(cuts) > 0).all()
    assert (np.digitize(x @ w, cuts) == y).mean() > 0.8


def test_licenses(spark, odd, none):
    texts = ["Intro.\nReleased under the MIT License.\r\nReleased under the BSD License", "permission is granted to nobody", "Copyright notes are copyright notes"]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(200 + i, t) for i, t in enumerate(texts)] + [(200, texts[0]), (None, texts[0])], "doc_id long, text string"))
    out = license_scan.scan(docs).collect()
    assert len(out) == docs.count()
    assert [(r["n_blocks"], r["licenses"]) for r in out if r["id"] in (200,)] == [(2, "BSD-3-Clause,MIT")] * 2
    assert {r["licenses"] for r in out if r["id"] in (201, 202, 4, 6)} == {""}
    assert license_scan.scan(none).count() == 0


def test_pipeline(spark, odd, none, tmp_path):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "id", "key")
    spark.createDataFrame([(1, "not in any text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, frame in (("odd", docs), ("none", docs.where("false"))):
        now = frame
        for step, f in corpus_pipeline.STAGES:
            now = tables.land(f(spark, now, str(tmp_path)))
            assert step == "byte_bpe" or now.columns == docs.columns
        if name == "odd":
            ids = [r["doc_id"] for r in now.collect()]
            assert 0 not in ids and 9 not in ids and 5 not in ids and ids.count(4) == 1 and 3 in ids and 6 in ids
        else:
            assert now.count() == 0


_BSD_CLAUSES = """

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_TERMS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "BSD-3-Clause": _BSD_TERMS + _BSD_CLAUSES + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission.\n\n" + _AS_IS,
    "BSD-2-Clause": _BSD_TERMS + _BSD_CLAUSES + _AS_IS,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
               "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
}


def test_license_notices_plain_wrapped_and_inline(spark):
    aside = "A long line went on about ships and weather and never came to a point, "  * 6
    rows = []
    for name, text in NOTICES.items():
        flat = " ".join(text.split())
        words, wrapped = flat.split(), []
        for i in range(0, len(words), 5):
            wrapped.append("# " + " ".join(words[i:i + 5]))
        rows += [(f"{name} {kind}", x) for kind, x in (("plain", text), ("flat", flat), ("wrapped", "\n".join(wrapped)),
                                                       ("inline", aside + flat + " " + aside))]
    rows.append(("BSD-3-Clause terms", _BSD_TERMS))
    rows.append(("CC-BY-4.0,MIT both", aside + NOTICES["MIT"] + " " + aside + NOTICES["CC-BY-4.0"]))
    rows += [(" " + t, t) for t in ("The MIT license is popular and nobody minds.", NOTICES["GPL-2.0"].replace("GNU", "GNU Lesser"),
                                    NOTICES["CC-BY-SA-4.0"].replace("Attribution", "Attribution-NonCommercial"))]
    got = {r["id"]: (r["licenses"], r["n_blocks"]) for r in
           license_scan.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for d, _ in rows:
        name = d.split(" ")[0]
        assert got[d] == (name, len(name.split(",")) if name else 0), d


def test_repeated_license_lines_are_notices_of_their_own(spark):
    texts = [(1, "Released under the MIT License.\n" * 400), (2, "Released under the MIT License. " * 400)]
    out = license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert [(r["n_blocks"], r["licenses"]) for r in out] == [(400, "MIT")] * 2
