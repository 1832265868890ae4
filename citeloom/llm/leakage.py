"""Problem 8: evaluation texts leaking into training text.

Method: a BM25 inverted index of the test items with block-max WAND. Terms are runs of four words. Every passage of every
training text is a query. An item's impacts are measured in units of what the least run that counts as a leak must
still score, so all items that reach 1 are retrieved and nothing that can be verified is lost; each is then verified by
aligning the words of passage and item.
"""

from __future__ import annotations

import itertools
import math
import pickle
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import _util

TERM, PHRASE, PASSAGE, STRIDE, BLOCK = 4, 5, 64, 32, 16
K1, B = 1.2, 0.75
PART_CHARS = 4 << 20
WORD = re.compile(r"[^\W\d_]+")
BROKEN = re.compile(r"[-‐‑]\r?\n\s*(?=[^\W\d_])|[­​-‍⁠﻿]")
MARK = re.compile(r"<[^<>\n]{1,60}>|&[a-zA-Z]{2,8};|&#\d+;|\[[^\[\]\n]{1,16}\]|\(\s*(?:fig|p|pp|ref|note)\b[^()\n]{0,12}\)", re.I)


def words_of(text: str) -> list[str]:
    """Words in lower case; broken words are joined, tags, entities and bracketed notes go."""
    return WORD.findall(MARK.sub(" ", BROKEN.sub("", text)).lower())


def rolling(ids: np.ndarray, n: int = TERM) -> np.ndarray:
    """A 64-bit key of every run of n ids; runs with an unknown word (id 0) get key 0."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    m = len(ids) - n + 1
    key, known = np.zeros(m, np.uint64), np.ones(m, bool)
    with np.errstate(over="ignore"):
        for k in range(n):
            part = ids[k : k + m]
            key = key * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
            known &= part > 0
        key ^= key >> np.uint64(29)
    key[~known] = 0
    return key


def phrases(text: str) -> list[int]:
    """64-bit keys of the runs of PHRASE words."""
    w = words_of(text)
    return [xxhash.xxh64_intdigest(" ".join(w[i : i + PHRASE])) - (1 << 63) for i in range(len(w) - PHRASE + 1)]


def least_score(keys: list[int], impact: dict[int, float], least: int, changed: float) -> float:
    """What `least` running words of an item must score at the least: a changed word takes TERM terms away at most."""
    width, best = least - TERM + 1, math.inf
    left = max(1, width - TERM * round(changed * least))
    for i in range(len(keys) - width + 1):
        best = min(best, sum(sorted(impact[k] for k in set(keys[i : i + width]))[:left]))
    return best


class Index:
    """The inverted index of one block of items: term -> postings (item number, impact) in blocks with maxima.

    shared: keys of the phrases that many items share. Items of fewer than `least` words cannot leak and have no postings.
    """

    def __init__(self, items: list[tuple[int, str]], shared: set[int], least: int = 15, changed: float = 1 / 7):
        self.item_ids = [i for i, _ in items]
        self.words: dict[str, int] = {}
        self.ids = []
        for _, text in items:
            self.ids.append(np.array([self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)], np.int64))
        #: which words of an item lie in an opening or phrase that many items share
        self.shared = []
        for x, (_, text) in zip(self.ids, items):
            m = np.zeros(len(x), bool)
            for i, k in enumerate(phrases(text)):
                if k in shared:
                    m[i : i + PHRASE] = True
            self.shared.append(m)
        # a term that lies in a shared phrase whole is no evidence and has no postings
        n, df = len(items), defaultdict(int)
        keys = [[k for i, k in enumerate(rolling(x).tolist()) if not m[i : i + TERM].all()] for x, m in zip(self.ids, self.shared)]
        for ks in keys:
            for k in set(ks):
                df[k] += 1
        mean = max(1.0, float(np.mean([len(x) for x in self.ids]))) if n else 1.0
        post = defaultdict(list)
        for d, ks in enumerate(keys):
            f = Counter(ks)
            impact = {k: math.log(1 + (n - df[k] + 0.5) / (df[k] + 0.5)) * f[k] * (K1 + 1) / (f[k] + K1 * (1 - B + B * len(self.ids[d]) / mean)) for k in f}
            unit = least_score(ks, {k: w / f[k] for k, w in impact.items()}, least, changed)
            if unit < math.inf:
                for k, w in impact.items():
                    post[k].append((d, w / unit))
        self.postings = {k: ([d for d, _ in p], [w for _, w in p], [max(w for _, w in p[i : i + BLOCK]) for i in range(0, len(p), BLOCK)]) for k, p in post.items()}
        self.threshold = 1.0
        self.keys = np.array(sorted(self.postings), np.uint64)
        self.most = np.array([max(self.postings[k][2]) for k in self.keys.tolist()])

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose BM25 score for the query reaches the threshold, by block-max WAND."""
        lists = [(*self.postings[t], max(self.postings[t][2])) for t in terms]
        at, out, limit = [0] * len(lists), [], self.threshold - 1e-12
        while True:
            live = sorted((x[0][at[i]], i) for i, x in enumerate(lists) if at[i] < len(x[0]))
            bound, pivot = 0.0, None
            for d, i in live:
                bound += lists[i][3]
                if bound >= limit:
                    pivot = d
                    break
            if pivot is None:
                return out
            upto = [i for d, i in live if d <= pivot]
            for i in upto:  # shallow move: to the block that may hold the pivot
                docs = lists[i][0]
                while at[i] < len(docs) and docs[min(len(docs), (at[i] // BLOCK + 1) * BLOCK) - 1] < pivot:
                    at[i] = (at[i] // BLOCK + 1) * BLOCK
            if sum(lists[i][2][at[i] // BLOCK] for i in upto if at[i] < len(lists[i][0])) >= limit:
                score = 0.0
                for i in upto:
                    docs, weights = lists[i][:2]
                    while at[i] < len(docs) and docs[at[i]] < pivot:
                        at[i] += 1
                    if at[i] < len(docs) and docs[at[i]] == pivot:
                        score += weights[at[i]]
                        at[i] += 1
                if score >= limit:
                    out.append((pivot, score))
            else:
                for i in upto:
                    docs = lists[i][0]
                    while at[i] < len(docs) and docs[at[i]] <= pivot:
                        at[i] += 1


def aligned(passage: np.ndarray, item: np.ndarray, shared: np.ndarray, price: float = 1.3) -> tuple[int, int]:
    """(words of the item in the best local alignment that no shared phrase covers, how many of these are equal)."""
    n, m = len(passage), len(item)
    H = np.zeros((n + 1, m + 1))
    equal = passage[:, None] == item[None, :]
    steps = np.arange(m + 1) * price
    for i in range(1, n + 1):
        row = np.maximum(H[i - 1, 1:] - price, H[i - 1, :-1] + np.where(equal[i - 1], 1.0, -price))
        row = np.maximum(np.concatenate(([0.0], row)), 0.0)
        H[i] = np.maximum.accumulate(row + steps) - steps  # gaps in the passage
    i, j = np.unravel_index(int(np.argmax(H)), H.shape)
    span = same = 0
    while i > 0 and j > 0 and H[i, j] > 1e-9:
        if abs(H[i, j] - (H[i - 1, j - 1] + (1.0 if equal[i - 1, j - 1] else -price))) < 1e-9:
            if not shared[j - 1]:
                span += 1
                same += int(equal[i - 1, j - 1])
            i, j = i - 1, j - 1
        elif abs(H[i, j] - (H[i - 1, j] - price)) < 1e-9:
            i -= 1
        else:
            span += int(not shared[j - 1])
            j -= 1
    return span, same


def leaks_in(texts: list[str], index: Index, least: int, changed: float) -> list[tuple[int, int, int, int]]:
    """(text number, item number, words in the run, equal ones) of every verified leak."""
    get, flat, starts = index.words.get, [], [0]
    for t in texts:
        flat.extend([get(w, 0) for w in words_of(t)])
        flat.extend([0] * TERM)
        starts.append(len(flat))
    ids, begin = np.array(flat, np.int64), np.array(starts)
    keys = rolling(ids)
    if not len(keys) or not len(index.keys):
        return []
    where = np.minimum(np.searchsorted(index.keys, keys), len(index.keys) - 1)
    hit = np.flatnonzero((index.keys[where] == keys) & (keys != 0))
    doc = np.searchsorted(begin, hit, side="right") - 1
    off = hit - begin[doc]
    # passages are numbered through; a term lies in two that overlap
    first = np.concatenate([[0], np.cumsum(np.diff(begin) // STRIDE + 1)])
    now, before = first[doc] + off // STRIDE, first[doc] + off // STRIDE - 1
    inside = (off // STRIDE > 0) & (off % STRIDE + STRIDE + TERM <= PASSAGE)
    passage = np.concatenate([now, before[inside]])
    term = np.concatenate([where[hit], where[hit][inside]])
    # the first test of WAND for all passages at once: can the greatest impacts of the terms reach the threshold?
    bound = np.bincount(passage, weights=index.most[term], minlength=first[-1])
    order = np.flatnonzero(bound[passage] >= index.threshold - 1e-9)
    order = order[np.argsort(passage[order], kind="stable")]
    passage, term = passage[order], term[order]
    edge = np.flatnonzero(np.diff(passage, prepend=-1))
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for lo, hi in itertools.pairwise([*edge.tolist(), len(passage)]):
        p = int(passage[lo])
        found = index.retrieve([int(index.keys[t]) for t in np.unique(term[lo:hi])])
        if found:
            d = int(np.searchsorted(first, p, side="right")) - 1
            at = int(begin[d]) + (p - int(first[d])) * STRIDE
            part = ids[at : min(at + PASSAGE, int(begin[d + 1]))]
            for item, _ in found:
                span, same = aligned(part, index.ids[item], index.shared[item])
                if span >= least and span - same <= math.ceil(changed * span):
                    best[(d, item)] = max(best.get((d, item), (0, 0)), (span, same))
    return [(d, item, *v) for (d, item), v in best.items()]


def shared_phrases(items: DataFrame, text: str, share: float, fewest: int) -> set[int]:
    """Keys of the phrases in more than `share` of the items and in more than `fewest`.

    They are counted over all items; there are at most 1 / share times the mean number of words of an item.
    """

    def scan(batches):
        for pdf in batches:
            yield pd.DataFrame({"k": [k for t in pdf["t"] for k in set(phrases(t))]}, dtype="int64")

    common = max(fewest, share * items.count())
    each = items.select(F.col(text).alias("t")).mapInPandas(scan, "k long").groupBy("k").count()
    return {r.k for r in each.where(F.col("count") > common).select("k").toLocalIterator()}


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", least: int = 15, changed: float = 1 / 7, common_share: float = 0.05, common_least: int = 8, block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, item_id, run_words, equal_words): the documents that hold at least `least` running words of an item.

    Up to about `changed` of the run's words may differ. Phrases that more than common_share of all items (and more
    than common_least) share are no evidence. The index is broadcast in blocks of at most block_bytes of item text, so
    its size is bounded however many items there are; each block is asked all passages of all texts, whole texts, with
    no shuffle. Null or empty texts hold and leak nothing; repeated rows give repeated findings only once.
    """
    spark = docs.sparkSession
    it = items.where(f"{text} is not null and {item_id} is not null").select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).distinct()
    blocks = max(1, math.ceil((it.agg(F.sum(F.octet_length("t"))).first()[0] or 0) / block_bytes))
    shared, out = shared_phrases(it, "t", common_share, common_least), None
    for b in range(blocks):
        rows = it if blocks == 1 else it.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b)
        index = _util.share(spark, Index(sorted((r.i, r.t) for r in rows.toLocalIterator()), shared, least, changed))

        def scan(batches, index=index):
            ix = pickle.loads(index.value)
            for pdf in batches:
                ids, texts, found = pdf["doc"].tolist(), pdf["text"].tolist(), []
                part = np.cumsum([len(t) for t in texts]) // PART_CHARS
                for lo, hi in itertools.pairwise([*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(texts)]):
                    found += [(ids[lo + d], ix.item_ids[i], s, e) for d, i, s, e in leaks_in(texts[lo:hi], ix, least, changed)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "run_words", "equal_words"]).astype("int64")

        got = docs.where(f"{text} <> '' and {doc_id} is not null").select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).mapInPandas(scan, "doc_id long, item_id long, run_words long, equal_words long")
        out = got if out is None else out.unionByName(got)
    return out.groupBy("doc_id", "item_id").agg(F.max("run_words").alias("run_words"), F.max("equal_words").alias("equal_words"))


_util.by_value(sys.modules[__name__])
