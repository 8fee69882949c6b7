"""Mixing sources to target weights: entropy balancing of token constraints.

Every document starts with rate 1. Among all rates that give each source its
target number of words, the balanced ones are closest to 1 in entropy: an
exponential tilt r = exp(lambda_s * size / mean size of s), here cut at ``MOST``
copies. lambda_s maximises the convex dual; Newton steps (kept inside a
bracket) solve it for all sources at once, each step one Spark aggregate over
the exact table of (source, size, count), which is all the dual depends on.

Rates become whole copies: within a source, sizes from large to small, the
words still owed decide how many copies a size class takes, so what is owed at
the end is at most half the smallest size. The copies of a class go to its
documents by hash order: a class is split into hash buckets (one for every
``BUCKET`` documents of the table, so none grows with the corpus) that take
their shares by cumulative rounding, and each bucket numbers its own rows.

Scale: documents travel as (id, source, size); only per-source sums reach the
driver (one row a source, a dimension table). The rounding reads one source's
size classes, at most one for each distinct size, never its documents.

Defined cases: null text has size 0 and is never taken; a null source is a
source of its own and sorts last; sources without any word get target 0; a
source whose target is ``MOST`` times its size takes every document ``MOST``
times; equal rows are dealt with one by one (ties by hash, then id); an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.shared import cut, n_words

MOST, WEIGHTS, BUCKET = 3.0, (5.0, 2.0, 1.0), 100_000


def targets(sizes: dict, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> dict:
    """Target words of each source: weights repeat over the sources by code point (None last) and share all words;
    none above ``most`` times its own words, the excess is shared again by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8", "surrogatepass")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in names if s in open_)
        full = [s for s in names if s in open_ and left * weight[s] / total > most * sizes[s]]
        if not full:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            out[s] = most * sizes[s]
            open_.discard(s)
        left = float(sum(sizes.values())) - sum(most * sizes[s] for s in names if s not in open_)
    return out


def balance(classes: DataFrame, goal: dict, stats: dict, most: float = MOST, rounds: int = 60) -> dict:
    """lambda of each source so that the tilted, cut rates give its target; classes: source_key, size, n."""
    spark = classes.sparkSession
    lam = {s: 0.0 for s in goal}
    low, high = {s: -math.inf for s in goal}, {s: math.inf for s in goal}
    done = set()
    for s in goal:
        if goal[s] >= most * stats[s][0] * (1 - 1e-12):
            lam[s] = math.inf
            done.add(s)
    for _ in range(rounds):
        todo = sorted(set(goal) - done)
        if not todo:
            break
        now = spark.createDataFrame([(s, lam[s], stats[s][0] / stats[s][1]) for s in todo], "k string, lam double, mean double")
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(most), F.exp(F.least(F.col("lam") * x, F.lit(700.0))))
        words = F.col("n") * F.col("size") * rate
        got = (classes.join(now, F.col("source_key") == F.col("k")).groupBy("k").agg(
            F.sum(words).alias("have"), F.sum(F.when(rate < most, words * x).otherwise(0.0)).alias("slope")).collect())
        for row in got:
            s, gap = row["k"], row["have"] - goal[row["k"]]
            if abs(gap) <= 1e-9 * max(1.0, goal[s]):
                done.add(s)
                continue
            (high if gap > 0 else low)[s] = lam[s]
            step = lam[s] - gap / row["slope"] if row["slope"] > 0 else math.nan
            if not low[s] < step < high[s] or math.isnan(step):
                if math.isinf(low[s]):
                    step = high[s] * 2 if high[s] < 0 else -1.0
                elif math.isinf(high[s]):
                    step = low[s] * 2 if low[s] > 0 else 1.0
                else:
                    step = (low[s] + high[s]) / 2
            if step == lam[s]:
                done.add(s)
            lam[s] = step
    return lam


def _copies(most: float):
    """Copies of each size class of one source; sizes from large to small, what is still owed decides."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", ascending=False, ignore_index=True)
        size, n = part["size"].to_numpy(np.float64), part["n"].to_numpy(np.int64)
        lam, mean, goal = (float(part[c].iloc[0]) for c in ("lam", "mean", "goal"))
        rate = np.full(len(part), most) if math.isinf(lam) else np.minimum(most, np.exp(np.minimum(lam * size / mean, 700.0)))
        copies, dealt = [], 0.0
        owed = np.cumsum(n * rate * size)
        owed[-1] = goal
        for i in range(len(part)):
            c = int(min(max(round((owed[i] - dealt) / size[i]), 0), most * n[i]))
            dealt += c * size[i]
            copies.append(c)
        return part.assign(copies=copies)[["source_key", "size", "n", "copies"]]
    return run


def mix(docs: DataFrame, keep: list[str] | None = None, weights: tuple[float, ...] = WEIGHTS, most: int = int(MOST)) -> DataFrame:
    """Columns ``keep`` (default doc_id) plus size, source_size, target, taken, copies: how often each row enters the mix."""
    spark = docs.sparkSession
    # a prefix keeps a null source apart from every text, also from the empty one
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    own = [key.alias("source_key"), n_words(F.col("text")).alias("size"), F.xxhash64("doc_id").alias("h")]
    rows = cut(docs.select("doc_id", *own))
    sums = rows.groupBy("source_key").agg(F.sum("size").alias("words"), F.count("*").alias("n"),
                                          F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("full")).collect()
    stats = {r["source_key"]: (float(r["words"]), max(1, r["full"])) for r in sums}
    goal = {("null" if s is None else "=" + s): t for s, t in targets(
        {(None if k == "null" else k[1:]): w for k, (w, _) in stats.items()}, weights, most).items()}
    n_buckets = max(1, math.ceil(sum(r["n"] for r in sums) / BUCKET) * 8)
    bucket = F.pmod(F.col("h"), F.lit(n_buckets)).cast("int")
    cells = cut(rows.filter("size > 0").groupBy("source_key", "size", bucket.alias("bucket")).agg(F.count("*").alias("n")))
    classes = cut(cells.groupBy("source_key", "size").agg(F.sum("n").alias("n")))
    lam = balance(classes, {s: t for s, t in goal.items() if stats[s][0] > 0}, stats, float(most))
    plan = spark.createDataFrame([(s, lam.get(s, 0.0), stats[s][0] / stats[s][1], goal[s], int(stats[s][0])) for s in sorted(goal)],
                                 "source_key string, lam double, mean double, goal double, source_size long")
    given = (classes.join(plan.drop("source_size"), "source_key").groupBy("source_key").applyInPandas(
        _copies(float(most)), "source_key string, size long, n long, copies long")
        .withColumnsRenamed({"n": "class_n", "copies": "class_copies"}))
    order = Window.partitionBy("source_key", "size").orderBy("bucket")
    upto = F.round(F.sum("n").over(order) * F.col("class_copies") / F.col("class_n")).cast("long")
    shares = (cells.join(given, ["source_key", "size"]).withColumn("upto", upto)
              .withColumn("share", F.col("upto") - F.lag("upto", 1, 0).over(order))
              .select("source_key", "size", "bucket", F.col("n").alias("cell_n"), "share"))
    names = list(keep or ["doc_id"])
    base = docs.select(F.struct(*names).alias("row"), *own, F.col("doc_id").alias("tie")) if keep else rows.select(
        F.struct("doc_id").alias("row"), "source_key", "size", "h", F.col("doc_id").alias("tie"))
    number = F.row_number().over(Window.partitionBy("source_key", "size", "bucket").orderBy("h", "tie"))
    copies = F.when(F.col("share").isNull(), F.lit(0)).otherwise(
        F.floor(F.col("share") / F.col("cell_n")) + F.when(F.col("number") <= F.col("share") % F.col("cell_n"), 1).otherwise(0))
    return (base.withColumn("bucket", bucket).join(shares, ["source_key", "size", "bucket"], "left")
            .withColumn("number", number).withColumn("copies", copies.cast("int"))
            .join(plan.select("source_key", "source_size", "goal"), "source_key")
            .select("row.*", "size", "source_size", F.col("goal").alias("target"),
                    (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies"))
