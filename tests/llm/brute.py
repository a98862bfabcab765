"""Plain versions of the operators' contracts, to test against."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import zlib

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def part(doc_id, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def contamination(docs, items):
    """{(doc_id, text): (n_words, n_hit, n_items, sha)}"""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(LOWER))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            found[tuple(w[i:i + n])].add(item)
    sizes = {len(k) for k in found}
    out = {}
    for doc, text in docs:
        w = word.findall((text or "").translate(LOWER))
        hit, own = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in found:
                    hit |= set(range(i, i + n))
                    own |= found[k]
        ids = sorted(str(x) for x in own if x is not None)
        out[doc, text] = (len(w), len(hit), len(ids), sha(",".join(ids)))
    return out


def bpe():
    raw = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_bpe():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(docs, up=75, down=100):
    """{doc_id: (n_shingles, component)}, by all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    held = collections.defaultdict(list)
    for d, s in sets.items():
        common = collections.Counter(o for x in s for o in held[x])
        for o, n in common.items():
            if down * n >= up * (len(s) + len(sets[o]) - n):
                a, b = sorted((find(d), find(o)))
                root[b] = a
        for x in s:
            held[x].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = (("assign", ASSIGN, 2, 6), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile(r"[0-9a-f]+"), 0, 24))


def secrets(text):
    """[(start, kind number, end)] of the base kinds."""
    return sorted((m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(BASE)
                  for m in p.finditer(text or "") if len(m[g]) >= least)


def secrets_sha(text):
    return sha(",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in secrets(text)))


def line_dedup(texts, least=10, chars=1):
    """[(n_lines, n_dropped, kept text)] of texts, each a document."""
    split = [(t or "").split("\n") for t in texts]
    keys = [[x.strip(" \t\n\r\x0b\x0c").translate(LOWER) for x in lines] for lines in split]
    held = collections.Counter(k for ks in keys for k in set(ks) if len(k) >= chars)
    out = []
    for lines, ks in zip(split, keys, strict=True):
        left = [x for x, k in zip(lines, ks, strict=True) if held[k] < least]
        out.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def spelling(docs, damage=97, least_length=5, least_count=3):
    """{word: (form, root, n, n_near, form_n)} by deletions: near words share a word with one letter less,
    or with one letter left open."""
    n = collections.Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    near = collections.defaultdict(set)
    holes = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1:]].add(w)
            if (s := w[:i] + w[i + 1:]) in n:
                near[w].add(s)
                near[s].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def hard_negatives(rows, anchors, n_pos=5, n_neg=10):
    """[(anchor, positive, rank, negative, positive score, negative score)] of (id, label, vector) rows."""
    def dot(a, b):
        return sum(int(x) * int(y) for x, y in zip(a, b))
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        scores = sorted((-dot(v, x), i, own) for i, own, x in rows if i != a)
        for minus, pos, own in [s for s in scores if s[2] == label][:n_pos]:
            fits = [(-m, i) for m, i, o in scores if o != label and 30 * -minus <= 100 * -m <= 90 * -minus][:n_neg]
            out += [(a, pos, r, i, -minus, s) for r, (s, i) in enumerate(fits, 1)]
    return sorted(out)
