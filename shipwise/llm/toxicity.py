"""Toxicity by weak supervision.

Voters are lexicon terms, patterns, and word beginnings mined from labelled
rows; each fires or not on a text.  A generative model with one hidden class
is fitted from the voters' first and second moments over all documents: the
covariance of two voters that depend on the class only is
``p(1-p) * d_i * d_j`` with d the difference of their firing rates, so d comes
from triplets of voters, and what a covariance holds beyond that is the
correlation of the pair.  Correlated voters share their weight.  A rater's
label is one more voter of known accuracy.  The posterior labels train a
logistic classifier on hashed word features and the patterns; it alone scores
texts.

Fitted on a bounded sample of labelled rows (``sample``, at most twice as many
by chance); the moments cover all documents.  Feature counts are aggregated
in Spark and only the ``features`` best ones reach the driver.

Rows: null and empty texts have no features and get the score of the bias;
null labels are no labels; of repeated label rows the highest counts; equal
texts score alike; with no labels or one class only, the prior is the score;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import land, pick
from shipwise.llm.words import BYTE_VALUE, U64, Words, _mix_int, _powers, each_block, mix, windows

#: Words here are runs of letters (a-z and beyond ASCII).
LETTERS = np.zeros(256, dtype=bool)
LETTERS[97:123] = LETTERS[128:] = True

#: Insults, by language.
LEXICON = (
    "idiot", "moron", "loser", "scum", "pathetic", "worthless", "disgusting", "trash", "clown", "stupid",
    "dumb", "fool", "jerk", "imbecile", "filth", "vermin", "garbage", "bastard", "bitch", "asshole",
    "idiota", "estúpido", "imbécil", "basura", "payaso", "asqueroso", "inútil",
    "crétin", "imbécile", "connard", "ordure", "minable", "débile",
    "dummkopf", "abschaum", "trottel", "arschloch", "versager", "widerlich", "erbärmlich",
)
#: Insulting word pairs.
PATTERNS = (("shut", "up"), ("hate", "you"), ("you", "idiot"), ("you", "are", "worthless"), ("go", "away"))


@dataclass(frozen=True)
class ToxicityParams:
    sample: int = 12_000
    bits: int = 22
    features: int = 1024
    mined: int = 96
    mined_least: int = 4
    mined_precision: float = 0.8
    rater_accuracy: float = 0.995
    ridge: float = 1e-4
    steps: int = 300


def word_hash(word: str) -> int:
    block = next(each_block(pa.array([word]), LETTERS))
    return int(block.hash[0])


def pattern_hash(words: tuple[str, ...]) -> int:
    block = next(each_block(pa.array([" ".join(words)]), LETTERS))
    return int(windows(block.hash, len(words))[0])


def pattern_features(bits: int) -> np.ndarray:
    """The patterns' features: places of their own behind the hashed ones."""
    return (1 << bits) + np.arange(len(PATTERNS), dtype=np.int64)


def pattern_hits(words: Words) -> list[list[int]]:
    """For each text the patterns that it holds."""
    out: list[list[int]] = [[] for _ in words.rows]
    for j, words_of in enumerate(PATTERNS):
        grams = windows(words.hash, len(words_of))
        at = np.flatnonzero(grams == U64(pattern_hash(words_of)))
        at = at[words.doc[at] == words.doc[at + len(words_of) - 1]]
        for d in np.unique(words.doc[at]):
            out[d].append(j)
    return out


def doc_features(words: Words, bits: int) -> Iterator[np.ndarray]:
    """Distinct features of each text: hashed words, hashed beginnings of 4 and 5 bytes of longer
    words, and patterns."""
    low = words.data
    up, down = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[low] * up[:-1], out=sums[1:])
    parts = [words.hash]
    for n in (4, 5):
        end = np.minimum(words.start + n, words.end)
        h = mix(((sums[end] - sums[words.start]) * down[words.start]) ^ U64(_mix_int(n)))
        parts.append(np.where(words.end - words.start > n, h, words.hash))
    cut = [(h >> U64(64 - bits)).astype(np.int32) for h in parts]
    hits, places = pattern_hits(words), pattern_features(bits).astype(np.int32)
    for i in range(len(words.rows)):
        s = words.of(i)
        yield np.unique(np.concatenate([*[c[s] for c in cut], places[hits[i]]]))


@dataclass
class ToxicityModel:
    params: ToxicityParams
    voters: np.ndarray  # feature of each lexicon, pattern or mined voter
    prior: float = 0.5
    rate1: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate0: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))
    columns: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def posterior(self, votes: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        on = np.log(self.rate1 / self.rate0) * self.share
        off = np.log((1 - self.rate1) / (1 - self.rate0)) * self.share
        z = np.log(self.prior / (1 - self.prior)) + votes @ on + (1 - votes) @ off
        if label is not None:
            a = self.params.rater_accuracy
            z = z + np.where(label > 0, 1, -1) * np.log(a / (1 - a))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def votes_of(feats: list[np.ndarray], voters: np.ndarray) -> np.ndarray:
    """0/1 per text and voter, in the voters' order."""
    out = np.zeros((len(feats), len(voters)), dtype=np.float32)
    order = np.argsort(voters)
    for i, f in enumerate(feats):
        out[i, order] = np.isin(voters[order], f, assume_unique=False)
    return out


# ---- learning ------------------------------------------------------------------------------------

def _sample_features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in each_block(batch.column("text"), LETTERS):
                feats = list(doc_features(words, bits))
                label = batch.column("label").slice(words.rows.start, len(feats))
                yield pa.RecordBatch.from_arrays([label, pa.array(feats, pa.list_(pa.int32()))], names=["label", "feats"])
    return run


def _moments(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        size = len(m.voters)
        n, both = 0, np.zeros((size, size))
        for batch in batches:
            for words in each_block(batch.column("text"), LETTERS):
                v = votes_of(list(doc_features(words, m.params.bits)), m.voters)
                both += v.T @ v
                n += len(v)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([both.ravel()], pa.list_(pa.float64()))],
                                         names=["n", "both"])
    return run


def label_model(n: int, both: np.ndarray, prior: float):
    """(rate given 1, rate given 0, share) of each voter, from the counts of pairs that fire."""
    m = len(both)
    mean = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(mean, mean)
    live = mean > 0
    scale = np.zeros(m)
    for j in range(m):
        if not live[j]:
            continue
        k = [x for x in range(m) if x != j and live[x] and cov[j, x] > 0]
        est = [cov[j, a] * cov[j, b] / cov[a, b] for x, a in enumerate(k) for b in k[x + 1:] if cov[a, b] > 1e-12]
        scale[j] = np.sqrt(np.median(est)) if est else np.sqrt(max(mean[j] * (1 - mean[j]), 0)) / 2
    spread = np.sqrt(prior * (1 - prior))
    diff = np.minimum(scale / spread, mean / prior)  # a voter of the class rarely fires elsewhere
    rate0 = np.clip(mean - prior * diff, 1e-5, 0.5)
    rate1 = np.clip(rate0 + diff, 2e-5, 0.99)
    # correlation beyond the class, in units of the voters' own variance
    var = np.sqrt(np.maximum(np.outer(mean * (1 - mean), mean * (1 - mean)), 1e-18))
    rest = np.clip(np.abs(cov - np.outer(scale, scale)) / var, 0, 1)
    np.fill_diagonal(rest, 0)
    rest[rest < 0.2] = 0
    return rate1, rate0, 1 / (1 + rest.sum(axis=1)), live


def _logistic(rows: list[np.ndarray], y: np.ndarray, size: int, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on 0/1 features by accelerated gradient steps (Adam)."""
    length = np.array([len(r) for r in rows])
    col = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(rows)), length)
    w, b = np.zeros(size), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(doc, w[col], minlength=len(rows)) + b
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw = np.bincount(col, g[doc], minlength=size) / len(rows) + ridge * w
        gb = g.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = 0.1 / np.sqrt(t / 20 + 1)
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        b -= step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-9)
    return w, b


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, id_col: str, text_col: str) -> DataFrame:
    """text, label of labelled rows, picked by a hash of the id so that about ``bound`` are taken;
    the ids broadcast are bounded by the sample, not by the input."""
    labels = labels.where("label is not null and id is not null").groupBy("id").agg(F.max("label").alias("label"))
    n = labels.count()
    share = min(1.0, bound / max(n, 1))
    labels = land(labels.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(29)), F.lit(1_000_000)) < share * 1_000_000)
                  .limit(2 * bound))
    return pick(docs, id=id_col, text=text_col).join(F.broadcast(labels), "id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    p, spark = params, docs.sparkSession
    labels = pick(labels, id=id_col, label=label_col).withColumn("label", F.col("label").cast("int"))
    sample = land(labelled_sample(docs, labels, p.sample, id_col, text_col).mapInArrow(
        _sample_features(p.bits), "label int, feats array<int>"))
    n, pos = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = (pos + 0.5) / (n + 1)
    base = np.array([word_hash(w) >> (64 - p.bits) for w in LEXICON] + pattern_features(p.bits).tolist(), dtype=np.int64)
    if not pos or pos == n:
        return ToxicityModel(p, base, prior=prior, bias=float(np.log(prior / (1 - prior))))

    # features by how surely their rates differ; the best ones, and the precise ones as voters
    rate1, rate0 = (F.col("on1") + 0.5) / (pos + 1), (F.col("df") - F.col("on1") + 0.5) / (n - pos + 1)
    gap = F.log(rate1) - F.log(rate0)
    sure = F.abs(gap) / F.sqrt(1 / (F.col("on1") + 0.5) + 1 / (F.col("df") - F.col("on1") + 0.5))
    counted = land(sample.select("label", F.explode("feats").alias("f")).groupBy("f")
                   .agg(F.count("*").alias("df"), F.sum("label").cast("long").alias("on1"))
                   .where("df >= 3").select("f", "df", "on1", sure.alias("sure"), gap.alias("gap")))
    best = counted.orderBy(F.desc("sure"), "f").limit(p.features).select("f").collect()
    mined = (counted.where((F.col("on1") >= p.mined_least) & (F.col("gap") > 0)
                           & ((F.col("on1") + 0.5) / (F.col("df") + 1) >= p.mined_precision))
             .orderBy(F.desc("sure"), "f").limit(p.mined).select("f").collect())
    voters = np.array(list(dict.fromkeys([*base.tolist(), *[r[0] for r in mined]])), dtype=np.int64)
    model = ToxicityModel(p, voters, prior=prior)

    # the label model, from moments over all documents
    size = len(voters)
    parts = land(pick(docs, text=text_col).mapInArrow(_moments(spark.sparkContext.broadcast(model)), "n long, both array<double>"))
    total = parts.agg(F.sum("n")).first()[0]
    both = np.zeros(size * size)
    for k, x in parts.select(F.posexplode("both").alias("k", "x")).groupBy("k").agg(F.sum("x")).collect():  # size^2 rows
        both[k] = x
    r1, r0, share, live = label_model(total, both.reshape(size, size), prior)
    model.rate1, model.rate0, model.share = r1, r0, share * live

    # the classifier, on posterior labels of the sample
    columns = np.array(sorted({r[0] for r in best} | set(voters.tolist())), dtype=np.int64)
    wanted = F.array(*[F.lit(int(c)) for c in columns])
    rows = sample.select("label", F.array_intersect("feats", wanted).alias("feats")).toArrow()
    label = rows.column("label").to_numpy()
    feats = [np.searchsorted(columns, np.asarray(f, dtype=np.int64)) for f in rows.column("feats").to_pylist()]
    y = model.posterior(votes_of(feats, np.searchsorted(columns, voters)), label)
    model.weights, model.bias = _logistic(feats, y, len(columns), p.ridge, p.steps)
    model.columns = columns
    return model


# ---- scoring -------------------------------------------------------------------------------------

def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        weight = np.zeros((1 << m.params.bits) + len(PATTERNS), dtype=np.float32)
        weight[m.columns] = m.weights
        vote = np.zeros((1 << m.params.bits) + len(PATTERNS), dtype=bool)
        vote[m.voters] = True
        for batch in batches:
            score, votes = [], []
            for words in each_block(batch.column("text"), LETTERS):
                for f in doc_features(words, m.params.bits):
                    z = float(weight[f].sum(dtype=np.float64)) + m.bias
                    score.append(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))
                    votes.append(int(vote[f].sum()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score, pa.float64()), pa.array(votes, pa.int64())],
                                             names=["id", "score", "votes"])
    return run


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1), votes (lexicon, pattern and mined voters that fire) for every row."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)),
                           f"id {rows.schema['id'].dataType.simpleString()}, score double, votes long")
