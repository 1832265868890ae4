"""Problem 7: filling fixed-capacity containers with items.

Method: hierarchical residual packing. Items are packed best-fit inside partitions; nearly full containers are final,
the others become items themselves and are packed again, over fewer and fewer partitions, until little is left.
"""

from __future__ import annotations

import bisect
import math
import os
import sys

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import _util

#: Items one task packs at most on average; the tree of merges keeps every task near it.
ITEMS_PER_TASK = 40_000

MEMBER = "struct<doc_id:long,piece:int,n_tokens:int>"


def token_counts(docs: DataFrame, doc_id: str, text: str, vocabulary: str, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) in tokens of the byte-level vocabulary file; a null or empty text has 0.

    The file (under 2 MB, checked) is read by the driver and sent to the executors.
    """
    if os.path.getsize(vocabulary) > 2 << 20:
        raise ValueError("the vocabulary file is too large to send to every executor")
    with open(vocabulary, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def scan(batches):
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.value.splitlines())}
        # fixed value: the public pre-splitting pattern of this vocabulary
        split = pattern or r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        enc = tiktoken.Encoding("vocabulary", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["d"], "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in pdf["t"]]})

    return docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).mapInPandas(scan, "doc_id long, n_tokens int")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item, larger ones first, goes where the least room is left. Gives item numbers by container."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    open_rooms: list[int] = []  # the distinct rooms left, sorted
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        n = sizes[i]
        at = bisect.bisect_left(open_rooms, n)
        if at < len(open_rooms):
            left = open_rooms[at]
            b = room[left].pop()
            if not room[left]:
                del room[left]
                open_rooms.pop(at)
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        left -= n
        if left not in room:
            room[left] = []
            bisect.insort(open_rooms, left)
        room[left].append(b)
    return bins


def pack(counts: DataFrame, containers: DataFrame, name: str = "container_name", capacity: str = "capacity_tokens", full: float = 0.995, rounds: int = 8) -> DataFrame:
    """(container_name, container_id, doc_id, piece, first_token, n_tokens): every document, for every container size.

    counts: (doc_id, n_tokens). A document longer than the container is split into pieces of exactly its capacity and a
    rest; no other is split. Pieces that fill a container, and containers filled to the share `full`, are final at
    once; the rest is merged and packed again while that still saves a tenth. Documents without tokens take no room and
    are assigned too. Repeated ids count once; container rows without name or with a capacity below 1 are left out.
    Container ids are the smallest (document, piece) inside, so they are unique without any coordination.
    """
    sizes = containers.where(f"{name} is not null and {capacity} >= 1").groupBy(name).agg(F.min(capacity).cast("int").alias("cap")).select(F.col(name).alias("c"), "cap")
    base = counts.groupBy("doc_id").agg(F.max("n_tokens").alias("n")).crossJoin(_util.bounded(sizes, 64))
    last = F.greatest(F.ceil(F.col("n") / F.col("cap")).cast("int"), F.lit(1)) - 1
    pieces = base.select("c", "cap", "doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.withColumn("size", F.least("cap", F.col("n") - F.col("piece") * F.col("cap")).cast("int"))
    member = F.struct("doc_id", "piece", F.col("size").alias("n_tokens")).cast(MEMBER)
    items = _util.cut(pieces.select("c", "cap", "size", F.array(member).alias("members"), F.col("doc_id").alias("k")))
    done = items.where("size = cap").select("c", "cap", "members")
    left = items.where("size < cap").select("c", "cap", "size", "members", "k")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "k"], ascending=[False, True]).reset_index(drop=True)
        cap, name_ = int(pdf["cap"].iloc[0]), pdf["c"].iloc[0]
        sizes_, members, keys = pdf["size"].tolist(), pdf["members"].tolist(), pdf["k"].tolist()
        rows = []
        for b in best_fit(sizes_, cap):
            fill = sum(sizes_[i] for i in b)
            rows.append((name_, cap, fill, [m for i in b for m in members[i]], min(keys[i] for i in b), fill >= full * cap))
        return pd.DataFrame(rows, columns=["c", "cap", "size", "members", "k", "done"])

    schema = f"c string, cap int, size int, members array<{MEMBER}>, k long, done boolean"
    before, fan = left.count(), None
    for r in range(rounds):
        fan = max(1, math.ceil(before / ITEMS_PER_TASK))
        salted = left.withColumn("s", F.pmod(F.xxhash64("k", F.lit(r)), F.lit(fan)))
        packed = _util.cut(salted.groupBy("c", "s").applyInPandas(merge, schema))
        done = done.unionByName(packed.where("done").select("c", "cap", "members"))
        left = packed.where("not done").drop("done")
        now = left.count()
        # what one task saw whole is packed for good; so is what another round would hardly improve
        if fan == 1 or now == 0 or (r > 0 and now > 0.9 * before):
            break
        before = now
    done = done.unionByName(left.select("c", "cap", "members"))
    first = F.array_min("members")
    out = done.select(F.col("c").alias(name), "cap", F.concat_ws("-", first["doc_id"], first["piece"]).alias("container_id"), F.explode("members").alias("m"))
    return out.select(name, "container_id", "m.doc_id", "m.piece", (F.col("m.piece").cast("long") * F.col("cap")).alias("first_token"), "m.n_tokens")


_util.by_value(sys.modules[__name__])
