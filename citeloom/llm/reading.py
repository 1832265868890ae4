"""Problem 9: reading level of each document.

Method: a Rasch-style model. Words are items: the log rate of a word at level v is ease + slope * v + curve * v ** 2, its
latent difficulty. Sentence lengths are a second set of items. A document has a latent level from 1 to 5, and beside it
one for its words and one for its sentences, which may lie off the first in opposite ways. Items, levels and the
raters' confusion are estimated in turn by distributed passes with soft posteriors; human ratings anchor the scale.
"""

from __future__ import annotations

import pickle
import re
import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import _util

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?…]+(?=[\s\"”’')\]]|$)|\n\s*\n")
#: Levels, and sentence lengths in eighths of a doubling (up to 4,096 words).
K, LENGTHS = 5, 97
AXIS = np.arange(K) - (K - 1) / 2
DESIGN = np.stack([np.ones(K), AXIS, AXIS**2 - 2], 1)
RIDGE = np.array([1e-3, 1.0, 2.0])
#: Words whose parameters are sent to the executors at a time (28 bytes each).
BLOCK_WORDS = 500_000
_KERNEL = np.array([1, 2, 3, 2, 1]) / 9
#: Where the raters' confusion starts from, and the weight of this start in documents.
CONFUSED, CONFUSED_WEIGHT = np.where(np.eye(K) > 0, 0.8, np.where(np.abs(np.subtract.outer(np.arange(K), np.arange(K))) == 1, 0.1, 0.005)), 10.0

COUNTED = "doc long, n_words int, at array<long>, n array<int>, lens array<int>"


def counted(rows: DataFrame) -> DataFrame:
    """(doc, n_words, at, n, lens) of (doc, text) rows: counts by 64-bit key of the word, and by length of sentence."""

    def scan(batches):
        key: dict[str, int] = {}
        for pdf in batches:
            at, n, lens, size = [], [], [], []
            for t in pdf["text"]:
                t = t.lower()
                ids, by = [], [0] * LENGTHS
                for s in SENTENCE.split(t):
                    ws = WORD.findall(s)
                    if len(ws) > 2:
                        by[min(LENGTHS - 1, int(8 * np.log2(len(ws))))] += 1
                    for w in ws:
                        k = key.get(w)
                        if k is None:
                            k = xxhash.xxh64_intdigest(w) - (1 << 63)
                            if len(key) < 200_000:
                                key[w] = k
                        ids.append(k)
                k, c = np.unique(np.array(ids, np.int64), return_counts=True)
                at.append(k)
                n.append(c.astype(np.int32))
                lens.append(by)
                size.append(len(t.split()))
            yield pd.DataFrame({"doc": pdf["doc"], "n_words": np.array(size, np.int32), "at": at, "n": n, "lens": lens})

    return rows.mapInPandas(scan, COUNTED)


def word_step(c: np.ndarray, total: np.ndarray, seen: float, steps: int = 12) -> np.ndarray:
    """Log rates (words, K), not yet normalised, by Newton steps on each word's ease, slope and curve.

    c: counts (words, K); total: all counts by level; seen: their sum. Words are independent given the totals.
    """
    beta = np.zeros((len(c), 3))
    beta[:, 0] = np.log((c.sum(1) + 0.05) / max(seen, 1.0))
    for _ in range(steps):
        rate = total * np.exp(np.clip(beta @ DESIGN.T, -25, 2))
        grad = (c - rate) @ DESIGN - np.array([0.0, *RIDGE[1:]]) * beta
        hess = np.einsum("kp,vk,kq->vpq", DESIGN, rate, DESIGN) + np.diag(RIDGE)
        beta += np.clip(np.linalg.solve(hess, grad[:, :, None])[:, :, 0], -1, 1)
    return beta @ DESIGN.T


class Model:
    """The small part of the model: lengths by level, the joint (level, words, sentences) prior and the raters."""

    def __init__(self):
        joint = np.full((K, K, K), 1e-4)
        for k in range(K):
            for off, w in ((0, 0.9), (1, 0.05), (-1, 0.05)):
                if 0 <= k + off < K and 0 <= k - off < K:
                    joint[k, k + off, k - off] += w
        self.joint, self.raters = joint / joint.sum(), CONFUSED / CONFUSED.sum(1, keepdims=True)
        self.lengths = None

    def posterior(self, words: np.ndarray | None, lens: np.ndarray, rated: np.ndarray) -> np.ndarray:
        """P(level, words' level, sentences' level) of each document from the words' log likelihood, lengths and ratings."""
        s = np.log(self.joint)[None] + (rated @ np.log(self.raters).T)[:, :, None, None]
        if words is not None:
            s = s + words[:, None, :, None] + (lens @ np.log(self.lengths).T)[:, None, None, :]
        p = np.exp(s - s.max((1, 2, 3), keepdims=True))
        return p / p.sum((1, 2, 3), keepdims=True)

    def update(self, stats: np.ndarray, first: bool) -> None:
        joint, lens, raters = np.split(stats, [K**3, K**3 + K * LENGTHS])
        lens = np.apply_along_axis(lambda x: np.convolve(x, _KERNEL, "same"), 1, lens.reshape(K, LENGTHS))
        base = (lens.sum(0) + 1e-3) / (lens.sum() + 1e-3 * LENGTHS)
        lens = lens + 5 * base
        self.lengths = lens / lens.sum(1, keepdims=True)
        if not first:
            joint = joint.reshape(K, K, K) + 1e-3
            self.joint = joint / joint.sum()
            raters = raters.reshape(K, K) + CONFUSED_WEIGHT * CONFUSED / CONFUSED.sum(1, keepdims=True)
            self.raters = raters / raters.sum(1, keepdims=True)


N_STATS = K**3 + K * LENGTHS + K * K


def _flat(pdf: pd.DataFrame):
    """(document, key, weight) triples of a batch; repeats of a word in one text depend on each other and weigh 1 + ln n."""
    size = pdf["at"].map(len).to_numpy()
    doc = np.repeat(np.arange(len(pdf)), size)
    return (doc, np.concatenate(pdf["at"].to_list()), 1 + np.log(np.concatenate(pdf["n"].to_list()))) if size.sum() else (doc, np.zeros(0, np.int64), np.zeros(0))


def _word_odds(pdf: pd.DataFrame, keys: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """(documents, K): the summed log rates of a batch's words; words without a rate say nothing."""
    doc, at, n = _flat(pdf)
    spot = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    hit = keys[spot] == at
    doc, spot, n = doc[hit], spot[hit], n[hit]
    return np.stack([np.bincount(doc, weights=n * rates[spot, k], minlength=len(pdf)) for k in range(K)], 1)


def _stats(p: np.ndarray, lens: np.ndarray, rated: np.ndarray) -> np.ndarray:
    return np.concatenate([p.sum(0).ravel(), (p.sum((1, 2)).T @ lens).ravel(), (p.sum((2, 3)).T @ rated).ravel()])


class _Words:
    """Sums of soft counts by word of one task, kept as sorted keys with K counts."""

    def __init__(self):
        self.keys, self.sums = np.zeros(0, np.int64), np.zeros((0, K))

    def add(self, pdf: pd.DataFrame, weight: np.ndarray) -> None:
        doc, at, n = _flat(pdf)
        keys, back = np.unique(at, return_inverse=True)
        sums = np.stack([np.bincount(back, weights=n * weight[doc, k], minlength=len(keys)) for k in range(K)], 1)
        both = np.union1d(self.keys, keys)
        out = np.zeros((len(both), K))
        out[np.searchsorted(both, self.keys)] += self.sums
        out[np.searchsorted(both, keys)] += sums
        self.keys, self.sums = both, out

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"key": self.keys, **{f"c{k}": self.sums[:, k] for k in range(K)}})


SUMS = "key long, " + ", ".join(f"c{k} double" for k in range(K)) + ", stat int"
LEVELS = [f"c{k}" for k in range(K)]


def _rows(words: _Words, stats: np.ndarray) -> pd.DataFrame:
    """A task's sums: words with stat -1, and the small part with its place in c0."""
    small = pd.DataFrame({"key": np.arange(len(stats)), "c0": stats, **{f"c{k}": 0.0 for k in range(1, K)}, "stat": 1})
    return pd.concat([words.frame().assign(stat=-1), small], ignore_index=True).astype({"key": "int64", "stat": "int32"})


def _summed(df: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(counts by word as a written table, the small part)."""
    got = _util.cut(df.groupBy("stat", "key").agg(*[F.sum(c).alias(c) for c in LEVELS]))
    stats = np.zeros(N_STATS)
    for r in got.where("stat = 1").select("key", "c0").collect():  # N_STATS rows
        stats[r.key] = r.c0
    return got.where("stat < 0").drop("stat"), stats


def _rates(counts: DataFrame, blocks: int, block: int, total: np.ndarray, norm: np.ndarray | None):
    """Keys and normalised log rates of one block of words, at most about BLOCK_WORDS."""
    part = counts if blocks == 1 else counts.where(F.pmod("key", F.lit(blocks)) == block)
    pdf = part.toPandas().sort_values("key")
    rates = word_step(pdf[LEVELS].to_numpy(float), total, float(total.sum()))
    norm = np.log(np.exp(rates).sum(0)) if norm is None else norm
    return pdf["key"].to_numpy(np.int64), (rates - norm).astype(np.float32)


def _norm(counts: DataFrame, total: np.ndarray) -> np.ndarray:
    """log of the summed rates by level, over all words, where they are too many for one block."""

    def scan(batches):
        for pdf in batches:
            s = np.exp(word_step(pdf[LEVELS].to_numpy(float), total, float(total.sum()))).sum(0)
            yield pd.DataFrame([s], columns=LEVELS)

    row = counts.mapInPandas(scan, ", ".join(f"{c} double" for c in LEVELS)).agg(*[F.sum(c) for c in LEVELS]).first()
    return np.log(np.array(row, float))


class Fit:
    """The alternating optimisation over a written table (doc, rated, n_words, at, n, lens)."""

    def __init__(self, table: DataFrame, block_words: int = BLOCK_WORDS):
        self.table, self.block_words, self.model, self.counts, self.blocks = table, block_words, Model(), None, 1

    def _begin(self) -> bool:
        model = _util.share(self.table.sparkSession, self.model)

        def scan(batches):
            m, words, stats = pickle.loads(model.value), _Words(), np.zeros(N_STATS)
            for pdf in batches:
                if len(pdf):
                    lens, rated = np.stack(pdf["lens"]).astype(float), np.stack(pdf["rated"]).astype(float)
                    p = m.posterior(None, lens, rated)
                    words.add(pdf, p.sum((1, 3)))
                    stats += _stats(p, lens, rated)
            yield _rows(words, stats)

        self.counts, stats = _summed(self.table.where("rated is not null").mapInPandas(scan, SUMS))
        if not stats.any():
            return False
        self.model.update(stats, True)
        return True

    def _shared(self):
        """One broadcast (model, keys, rates) for each block of words."""
        total = np.array(self.counts.agg(F.count("*"), *[F.sum(c) for c in LEVELS]).first()[1:], dtype=object)
        total = np.array([x or 0.0 for x in total], float)
        self.blocks = max(1, -(-self.counts.count() // self.block_words))
        norm = None if self.blocks == 1 else _norm(self.counts, total)
        for b in range(self.blocks):
            yield _util.share(self.table.sparkSession, (self.model, *_rates(self.counts, self.blocks, b, total, norm)))

    def _odds(self, shares: list) -> DataFrame:
        """(doc, ll): the words' log likelihood of every document where it takes several blocks; each block reads the table once."""
        out = None
        for share in shares:

            def scan(batches, share=share):
                _, keys, rates = pickle.loads(share.value)
                for pdf in batches:
                    yield pd.DataFrame({"doc": pdf["doc"], **dict(zip(LEVELS, _word_odds(pdf, keys, rates).T))})

            got = self.table.select("doc", "at", "n").mapInPandas(scan, "doc long, " + ", ".join(f"{c} double" for c in LEVELS))
            out = got if out is None else out.unionByName(got)
        return out.groupBy("doc").agg(F.array(*[F.sum(c) for c in LEVELS]).alias("ll"))

    def _pass(self, work, schema: str) -> DataFrame:
        """work(model, batch, posterior) over all documents; it gets every batch and then None, and gives frames or None."""
        shares = list(self._shared())
        several, spark = len(shares) > 1, self.table.sparkSession
        table = self.table.join(self._odds(shares), "doc") if several else self.table
        share = _util.share(spark, (self.model, None, None)) if several else shares[0]

        def scan(batches):
            m, keys, rates = pickle.loads(share.value)
            do = work()
            for pdf in batches:
                if len(pdf):
                    rated = np.stack([np.zeros(K) if r is None else r for r in pdf["rated"]]).astype(float)
                    lens = np.stack(pdf["lens"]).astype(float)
                    odds = np.stack(pdf["ll"]) if keys is None else _word_odds(pdf, keys, rates)
                    out = do(pdf, m.posterior(odds, lens, rated), lens, rated)
                    if out is not None:
                        yield out
            out = do(None, None, None, None)
            if out is not None:
                yield out

        return table.mapInPandas(scan, schema)

    def run(self, rounds: int, tolerance: float) -> bool:
        """Alternate until no cell of the joint prior moves by more than tolerance; False without any rating."""

        def work():
            words, stats = _Words(), np.zeros(N_STATS)

            def do(pdf, p, lens, rated):
                nonlocal stats
                if pdf is None:
                    return _rows(words, stats)
                words.add(pdf, p.sum((1, 3)))
                stats += _stats(p, lens, rated)

            return do

        if not self._begin():
            return False
        for _ in range(rounds):
            before = self.model.joint
            self.counts, stats = _summed(self._pass(work, SUMS))
            self.model.update(stats, False)
            if np.abs(self.model.joint - before).max() < tolerance:
                return True
        raise RuntimeError(f"the reading model did not settle in {rounds} rounds")

    def levels(self) -> DataFrame:
        def work():
            def do(pdf, p, lens, rated):
                if pdf is not None:
                    level = p.sum((2, 3)).argmax(1).astype(np.int32) + 1
                    return pd.DataFrame({"doc_id": pdf["doc"], "n_words": pdf["n_words"], "rated": rated.any(1), "level": level})

            return do

        return self._pass(work, "doc_id long, n_words int, rated boolean, level int")


def reading_levels(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", level: str = "level", rounds: int = 60, tolerance: float = 3e-3, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, rated, level): the level 1..5 of every document with a text.

    ratings: (doc_id, level) rows; each rating of a document is evidence, null ratings and levels beyond 1..5 are
    ignored. Without any rating of a document the scale has no anchor and the result is empty. A document without words
    gets the most frequent level. Every word and every sentence of every text counts, in blocks of block_words words of
    the vocabulary. Raises if the model does not settle within the rounds.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    n_rows, n_ids = rows.agg(F.count("*"), F.count_distinct("doc")).first()
    if n_rows > n_ids:
        rows = rows.dropDuplicates(["doc"])
    given = ratings.where(F.col(level).between(1, K)).groupBy(F.col(doc_id).cast("long").alias("doc")).agg(F.array(*[F.count_if(F.round(level) == k + 1).cast("int") for k in range(K)]).alias("rated"))
    table = _util.cut(counted(rows).join(_util.bounded(given, 64), "doc", "left"))
    fit = Fit(table, block_words)
    if not fit.run(rounds, tolerance):
        return spark.createDataFrame([], "doc_id long, n_words int, rated boolean, level int")
    return fit.levels()


_util.by_value(sys.modules[__name__])
