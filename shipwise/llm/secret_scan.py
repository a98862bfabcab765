"""Secret scans over a trigram inverted index, in DataFrame operations only.

Each rule's regular expression is turned into a Boolean trigram query: a list
of alternatives, each the set of all trigrams that a match by it must contain
(without regard to case, as a superset).  ``literal_runs`` reads them off the
parsed expression: literals join into runs, short character classes and
branches multiply the alternatives, optional parts and wide classes end a run.
The index has a posting (trigram, block) for each trigram of any query and each
block of text that holds it; it is written as a table, the postings of a block
are intersected as a bit set, and the rules' queries are evaluated on it.  Only
candidate blocks are verified with the regular expression.  A rule without a
mandatory trigram (a plain run of hex digits) scans every block.

Positions come from ``split`` with the same expression: the pieces between
matches and the matches alternate, so running sums of their lengths in code
points are the starts and ends.  Running sums and replacements go by chunks of
about the square root of a text's matches, so that a text of very many matches
does not cost the square of their number.

A block is a distinct text, named by two 64-bit hashes.  Rows: null is the
empty text, which holds nothing; equal texts share one block and get equal
spans; null ids and repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import kept, land, pick


#: A character class of at most so many characters gives an alternative for each; all in all at
#: most so many alternatives. Beyond either a run of literals ends, which only widens the query.
CLASS, ALTERNATIVES = 8, 64


def _members(parts: Iterable) -> list[str]:
    """The characters of a short class, else nothing."""
    found: set[str] = set()
    for op, value in parts:
        op = str(op)
        if op == "LITERAL":
            found.add(chr(value))
        elif op == "RANGE" and value[1] - value[0] < CLASS:
            found |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return []
    return sorted(found) if len(found) <= CLASS and all(c.isascii() for c in found) else []


def literal_runs(parsed, paths: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """``paths`` (alternatives: runs of literals, the last one open) led on through the expression."""
    def end(found: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
        return list(dict.fromkeys(p if p[-1] == "" else (*p, "") for p in found))

    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL" and chr(arg).isascii():
            paths = [(*p[:-1], p[-1] + chr(arg).lower()) for p in paths]
        elif op == "IN" and (chars := _members(arg)) and len(paths) * len(chars) <= ALTERNATIVES:
            paths = list(dict.fromkeys((*p[:-1], p[-1] + c.lower()) for p in paths for c in chars))
        elif op == "SUBPATTERN":
            paths = literal_runs(arg[-1], paths)
        elif op == "BRANCH" and len(paths) * len(arg[1]) <= ALTERNATIVES:
            paths = list(dict.fromkeys(q for branch in arg[1] for q in literal_runs(branch, paths)))
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
            paths = literal_runs(arg[2], paths)
            if arg[:2] != (1, 1):
                paths = end(paths)
        elif op not in ("AT", "ASSERT", "ASSERT_NOT"):  # what has a width and is not known ends the run
            paths = end(paths)
        if len(paths) > ALTERNATIVES:  # an inner branch led further than allowed: keep what they share, nothing
            paths = [("",)]
    return paths


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of mandatory trigrams; none if some match need not hold any. An alternative that
    asks for more than another one is left out, as the other holds wherever it does."""
    runs = literal_runs(re._parser.parse(pattern), [("",)])
    found = {frozenset(w[i:i + 3] for w in words for i in range(len(w) - 2)) for words in runs}
    least = [q for q in found if not any(other < q for other in found)]
    return [] if frozenset() in found else sorted(least, key=sorted)


@dataclass(frozen=True)
class SecretRule:
    """A match of ``pattern`` counts if its group ``group`` has ``least`` characters. Case is ignored
    only where the pattern says so. The pattern's syntax must mean the same to Java and Python."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False

    def query(self) -> list[frozenset[str]]:
        return trigram_query(self.pattern)


#: The three base rules, then the method's further ones.
RULES = (
    SecretRule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    SecretRule("hex", r"[0-9a-f]+", 0, 24, True),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", r"gh[opusr]_[A-Za-z0-9]+", 0, 40),
    SecretRule("slack", r"xox[abeprs]-[A-Za-z0-9-]+", 0, 20),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 24),
)


def trigrams(rules: tuple[SecretRule, ...]) -> list[str]:
    return sorted({t for r in rules for q in r.query() for t in q})


def _texts(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    names, _ = kept(docs, keep)
    rows = pick(docs, id=id_col, text=text_col, **names).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumns({"b1": F.xxhash64("text"), "b2": F.xxhash64("text", F.lit(1))})


def postings(blocks: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """The index: (trigram, b1, b2), trigram by its place in ``trigrams(rules)``."""
    names = F.array(*[F.lit(t) for t in trigrams(rules)])
    low = blocks.select("b1", "b2", F.lower("text").alias("low"))
    if not trigrams(rules):
        return low.select("b1", "b2", F.lit(0).alias("trigram")).where(F.lit(False))
    # a filter of the constant list: the same test written out once for each trigram is too much code to be compiled
    held = F.filter(F.sequence(F.lit(0), F.size(names) - 1), lambda i: F.contains("low", F.get(names, i)))
    return low.select("b1", "b2", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(b1, b2, wanted): a bit for each rule whose trigram query the block's postings satisfy."""
    place = {t: i for i, t in enumerate(trigrams(rules))}
    words = max(1, -(-len(place) // 62))
    sets = [F.bit_or(F.when((F.col("trigram") >= 62 * w) & (F.col("trigram") < 62 * (w + 1)),
                            F.expr(f"shiftleft(1L, cast(trigram - {62 * w} as int))")).otherwise(F.lit(0).cast("long"))
                     ).alias(f"w{w}") for w in range(words)]
    held = index.groupBy("b1", "b2").agg(*sets)

    def holds(query: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in range(words):
            mask = sum(1 << (place[t] - 62 * w) for t in query if 62 * w <= place[t] < 62 * (w + 1))
            out = out & (F.col(f"w{w}").bitwiseAND(F.lit(mask).cast("long")) == mask) if mask else out
        return out

    wanted = F.lit(0)
    for k, r in enumerate(rules):
        alternatives = F.lit(False)
        for q in r.query():
            alternatives = alternatives | holds(q)
        wanted = wanted + F.when(alternatives, 1 << k).otherwise(0)
    return held.select("b1", "b2", wanted.alias("wanted")).where("wanted > 0")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(values: Column) -> Column:
    """An array cut into pieces of about the square root of its size."""
    k = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    cut = _let(k, lambda k: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / k).cast("int")), lambda j: F.slice(values, j * k + 1, k)))
    return F.when(F.size(values) > 0, cut).otherwise(F.slice(F.array(values), 1, 0))


def _walk(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Results of ``step(result so far, value)`` after each value of a short array of ints."""
    return F.aggregate(
        values, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, v: _let(step(acc["at"], v), lambda now: F.struct(
            now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out"))))["out"]


def running(values: Column, step: Callable[[Column, Column], Column], whole: Callable[[Column], Column]) -> Column:
    """``step`` led through a long array of ints from 0: chunk by chunk, each from what ``whole`` says
    of the chunks before (an associative step: a sum, a maximum)."""
    def ends(chunks: Column) -> Column:
        before = _walk(F.transform(chunks, whole), F.lit(0), step)
        return F.flatten(F.transform(chunks, lambda c, i: _walk(
            c, F.when(i > 0, F.get(before, i - 1)).otherwise(F.lit(0)), step)))
    return _let(_chunks(values), ends)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, v: acc + v)


def _spans(rule: SecretRule, k: int, text: Column) -> Column:
    """array<struct<start, kind, end>> of a rule's matches, leftmost and not overlapping."""
    pattern = F.lit(rule.pattern)
    if rule.group == 0 and rule.name == "hex":
        pattern = F.lit("[0-9a-f]{%d,}" % rule.least)  # runs are maximal, so the bound can be in the pattern
    size = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m))
    value = size if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m))
    gap = F.transform(F.split(text, pattern, -1), lambda m: F.length(m))

    def placed(m: Column) -> Column:
        ends = running(F.transform(m, lambda x: x["gap"] + x["size"]), lambda at, v: at + v, _total)
        every = F.zip_with(m, ends, lambda x, end: F.struct(
            (end - x["size"]).alias("start"), F.lit(k).alias("kind"), end.alias("end"), x["value"].alias("value")))
        return F.transform(F.filter(every, lambda x: x["value"] >= rule.least),
                           lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    zipped = _let(size, lambda size: F.arrays_zip(
        size.alias("size"), (size if rule.group == 0 else value).alias("value"), F.slice(gap, 1, F.size(size)).alias("gap")))
    return _let(zipped, placed)


NO_SPANS = "array<struct<start:int,kind:int,end:int>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
         rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """id, text, kept columns and found: spans (start, kind, end) in code points, sorted."""
    rows = _texts(docs, id_col, text_col, keep)
    index = land(postings(rows.select("b1", "b2", "text"), rules))
    wanted = land(candidates(index, rules))
    marked = rows.join(wanted, ["b1", "b2"], "left").drop("b1", "b2")
    empty, text = F.array().cast(NO_SPANS), F.col("text")
    parts = []
    for k, r in enumerate(rules):
        quick = F.col("wanted").bitwiseAND(1 << k) > 0 if r.query() else F.lit(True)
        pattern = "[0-9a-f]{%d}" % r.least if r.name == "hex" else r.pattern
        parts.append(F.when(quick & text.rlike(pattern), _spans(r, k, text)).otherwise(empty))
    return marked.withColumn("found", F.array_sort(F.concat(*parts))).drop("wanted")


def _joined(spans: Column, rules: tuple[SecretRule, ...]) -> Column:
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest_columns(found: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    base = [k for k, r in enumerate(rules) if r.base]
    place = {r.name: k for k, r in enumerate(rules)}

    def count(name: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == place[name])).cast("long")

    return found.select(
        F.col("id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.filter("found", lambda s: s["kind"].isin(base)), rules), 256).alias("base_sha256"),
        _joined(F.col("found"), rules).alias("spans"))


def redacted(found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows with each run of overlapping spans replaced by ``mark`` in ``text``.

    Spans are cut into chunks and the text at the chunks' ends, so that a piece between spans is
    looked for in its chunk's part of the text only."""
    def cut(text: Column, spans: Column, reach: Column) -> Column:
        # the furthest end before each span: where the text that precedes it starts
        seen = F.transform(spans, lambda s, i: F.struct(
            s["start"].alias("start"), F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0)).alias("from")))
        holes = F.filter(seen, lambda s: s["start"] >= s["from"])

        def part(chunk: Column) -> Column:
            base = F.get(chunk, F.lit(0))["from"]
            last = F.element_at(chunk, -1)["start"]
            return _let(F.substring(text, base + 1, last - base), lambda near: F.array_join(F.transform(
                chunk, lambda s: F.concat(F.substring(near, s["from"] - base + 1, s["start"] - s["from"]), F.lit(mark))), ""))

        pieces = F.transform(_chunks(holes), part)
        return F.concat(F.array_join(pieces, ""), F.substring(text, F.element_at(reach, -1) + 1, F.length(text)))

    text, spans = F.col("text"), F.col("found")
    reach = running(F.transform(spans, lambda s: s["end"]), lambda at, v: F.greatest(at, v), lambda c: F.array_max(c))
    return found.withColumn("text", F.when(F.size(spans) > 0, _let(reach, lambda r: cut(text, spans, r))).otherwise(text))
