"""Trigram queries read off the rules' expressions, and texts of very many secrets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shipwise.llm import secret_scan
from shipwise.llm.secret_scan import SecretRule, trigram_query
from tests.llm import brute


@pytest.mark.parametrize("pattern, want", [
    (r"AKIA[A-Z0-9]+", [{"aki", "kia"}]),
    (r"api_?key", [{"api", "key"}]),
    (r"x(?:abc|def)+y", [{"xab", "abc"}, {"xde", "def"}]),
    (r"a[bc]d", [{"abd"}, {"acd"}]),
    (r"(?i:SeC)ret", [{"sec", "ecr", "cre", "ret"}]),
    (r"abcdef|abc", [{"abc"}]),             # abcdef asks for more
    (r"abc|[0-9]+", []),                    # one branch has none
    (r"(?:abc)?d+", []), (r"[a-z]{8}", []), (r"é.ab", []), ("", []),
    (r"^abc$", [{"abc"}]), (r"abc(?=x)de", [{"abc", "bcd", "cde"}]),
    (r"foo[^x]bar", [{"foo", "bar"}]), (r"a{2}bcd", [{"bcd"}]),
    (r"[ab][ab][ab][ab][ab][ab][ab]xyz", [{"xyz"}]),  # too many alternatives: the run ends
])
def test_query_of_a_pattern(pattern, want):
    got = trigram_query(pattern)
    if pattern.startswith("[ab][ab]"):
        assert got and all({"xyz"} <= q for q in got) and len(got) <= secret_scan.ALTERNATIVES
    else:
        assert sorted(map(sorted, got)) == sorted(map(sorted, want))


def test_a_rule_given_by_pattern_alone_is_indexed(spark):
    rules = (*secret_scan.RULES, SecretRule("stripe", r"[rs]k_live_[0-9a-zA-Z]{10,}"))
    assert {"rk_", "k_l", "_li", "liv", "ive", "ve_"} in [set(q) for q in rules[-1].query()]
    texts = ["x sk_live_abcdefghij1 y", "rk_live_short", "nothing", "RK_LIVE_ABCDEFGHIJ1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = secret_scan.candidates(secret_scan.postings(
        frame.select(F.xxhash64("text").alias("b1"), F.xxhash64("text", F.lit(1)).alias("b2"), "text"), rules), rules)
    assert {r.wanted >> (len(rules) - 1) for r in wanted.collect()} == {1} and wanted.count() == 3
    found = {r["id"]: r["found"] for r in secret_scan.scan(frame, rules=rules).collect()}
    assert [(s.start, s.end) for s in found[0]] == [(2, 21)] and not found[1] and not found[2] and not found[3]


def test_very_many_secrets_in_one_text(spark):
    rng = random.Random(4)
    long = "".join(rng.choice(["token=abcdef12 ", "é passwd: short ", "日" * 3, "0" * 30 + " ", "secret=" + "a" * 24 + "\n"])
                   for _ in range(6000))
    texts = [long, "token=abcdef12", "", "a" + "0" * 24, "token=" + "f" * 24 + "token=" + "0" * 30]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.scan(frame).cache()
    digest = {r["doc_id"]: r for r in secret_scan.digest_columns(found).collect()}
    clean = {r["id"]: r["text"] for r in secret_scan.redacted(found).collect()}
    for d, t in enumerate(texts):
        assert digest[d]["base_sha256"] == brute.secrets_sha(t)
        want, at = [], 0
        spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in digest[d]["spans"].split(",") if s))
        for a, b in spans:
            if a >= at:
                want.append(t[at:a] + "[secret]")
            at = max(at, b)
        assert clean[d] == "".join(want) + t[at:]
    assert not re.search("abcdef12|a{24}", clean[0])


def test_rules_without_trigrams_scan_all(spark):
    hexes = tuple(r for r in secret_scan.RULES if r.name == "hex")
    frame = spark.createDataFrame([(1, "x " + "0f" * 12), (2, None)], "doc_id long, text string")
    found = {r["id"]: [(s.start, s.end) for s in r["found"]] for r in secret_scan.scan(frame, rules=hexes).collect()}
    assert found == {1: [(2, 26)], 2: []}
