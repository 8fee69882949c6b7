"""Exact top-k inner-product search with MaxScore.

Vectors are cut to integers; a dimension is a query term, its posting list the
shard's column, its score bounds the column's extremes times the query's
weight. For a query, terms are ordered by how far they can move a score. With
the k-th best score so far as threshold, the terms whose joint reach cannot
lift a candidate over it are non-essential: essential terms are traversed for
all of a shard's block, then non-essential ones are probed, strongest first,
only for the candidates whose partial score plus remaining bound still ties or
beats the threshold. Shards' lists are merged. All arithmetic is exact integer.

Scale: rows are dealt by hash into shards of ``SHARD`` vectors and queries into
blocks of ``QUERIES``; a (shard, block) pair meets in one cogrouped task of
bounded size. Every query meets every shard; no pair of vectors is a row. A
shard sends at most k rows a query.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part; a null vec_id takes no part; vectors meet only those
of their own length; a row never answers a query with its own vec_id; ties go to the
smaller vec_id, then repeated rows count one by one; fewer candidates than k
give all; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, SCALE, EVERY = 10, 1024, 100
SHARD, QUERIES, BLOCK, STEP = 2048, 8192, 512, 8
_EXACT = float(1 << 53)


def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, int64 bytes of floor(1024 x)) of the vectors that take part."""
    for batch in batches:
        ids, vecs = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = v.values
            if i is None or x is None or not len(x) or x.null_count:
                continue
            y = np.floor(x.to_numpy().astype(np.float64) * SCALE)
            if np.isfinite(y).all():
                ids.append(i)
                vecs.append(y.astype(np.int64))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(v) for v in vecs], pa.int32()),
                               pa.array([v.tobytes() for v in vecs], pa.binary())], names=["vec_id", "dim", "v"])


def maxscore(query: np.ndarray, own: int, ids: np.ndarray, table: np.ndarray, low: np.ndarray, high: np.ndarray,
             k: int = K, block: int = BLOCK) -> tuple[list[int], list[int]]:
    """The k best (score, vec_id) of one shard for one query, as two lists; low and high: extremes of the columns."""
    reach = np.maximum(query * low, query * high)  # most that a term adds
    floor_ = np.minimum(query * low, query * high)  # least that it adds
    order = np.argsort(-(reach - floor_), kind="stable")
    spread = (reach - floor_)[order]
    rest = np.concatenate([np.cumsum(reach[order][::-1])[::-1], [0]])  # most that the terms from here on add
    tail = np.concatenate([np.cumsum(spread[::-1])[::-1], [0]])
    base = floor_.sum()
    best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
    for a in range(0, len(ids), block):
        rows = np.arange(a, min(a + block, len(ids)))
        rows = rows[ids[rows] != own]
        bar = best_s[-1] if len(best_s) == k else None
        # non-essential terms: together they cannot lift a candidate from the floor to the threshold
        cut = len(order) if bar is None else int(np.searchsorted(-tail, -(bar - base), side="left"))
        cut = max(1, min(cut, len(order)))
        score = table[np.ix_(rows, order[:cut])] @ query[order[:cut]] if cut < len(order) else table[rows] @ query
        while cut < len(order):
            live = score + rest[cut] >= bar
            rows, score = rows[live], score[live]
            if not len(rows):
                break
            more = order[cut: cut + STEP]
            score = score + table[np.ix_(rows, more)] @ query[more]
            cut += len(more)
        if bar is not None:
            live = score >= bar
            rows, score = rows[live], score[live]
        best_s, best_i = np.concatenate([best_s, score]), np.concatenate([best_i, ids[rows]])
        keep = np.lexsort((best_i, -best_s))[:k]
        best_s, best_i = best_s[keep], best_i[keep]
    return best_s.astype(np.int64).tolist(), best_i.tolist()


def _search(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            dim = int(rows["dim"].iloc[0])
            rows = rows.sort_values("vec_id", kind="stable")
            table = np.frombuffer(b"".join(rows["v"]), np.int64).reshape(-1, dim)
            ids = rows["vec_id"].to_numpy(np.int64)
            asked = np.frombuffer(b"".join(queries["v"]), np.int64).reshape(-1, dim)
            # products of doubles are exact below 2^53; beyond that plain integers take over
            exact = float(np.abs(table).max()) * float(np.abs(asked).max()) * dim * 2 < _EXACT
            table, asked = (x.astype(np.float64 if exact else object) for x in (table, asked))
            low, high = table.min(axis=0), table.max(axis=0)
            for own, query in zip(queries["vec_id"].tolist(), asked):
                if exact:
                    score, found = maxscore(query, own, ids, table, low, high, k)
                else:
                    every = [(-int(s), int(i)) for s, i in zip(table @ query, ids) if i != own]
                    score, found = zip(*[(-s, i) for s, i in sorted(every)[:k]]) if every else ((), ())
                out["query_id"] += [own] * len(found)
                out["vec_id"] += found
                out["score"] += score
        return pd.DataFrame(out).astype("int64")
    return run


def search(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query (vec_id divisible by ``every``)."""
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = own.mapInArrow(integers, "vec_id long, dim int, v binary")
    asked = rows.filter(F.col("vec_id") % every == 0)
    total, n_asked = own.agg(F.count("*"), F.sum((F.col("vec_id") % every == 0).cast("int"))).first()
    shards, blocks = max(1, math.ceil(total / SHARD)), max(1, math.ceil((n_asked or 0) / QUERIES))
    h = F.xxhash64("vec_id")
    left = (asked.withColumn("block", F.pmod(h, F.lit(blocks)).cast("int"))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    right = (rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
