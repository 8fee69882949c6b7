"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, grouping.

A document is the set of its distinct k-word shingles (words: runs of bytes
other than white space, A-Z folded). Every shingle owns a permutation of the
signature's slots; at level j it offers the value (j, r_j) to the j-th slot of
its permutation, and a slot keeps the smallest offer. Levels are taken in
ascending order, so a slot that is filled never changes again: a document stops
as soon as all slots are filled (after about ``m ln m / n`` levels for n
shingles). The slots of one element are tied together by its permutation, which
is what lowers the variance against independent minima.

Scale: one scan computes signatures; documents with equal shingle sets are
collapsed (partially aggregated) before banding, so a huge group of copies is
one row. Buckets never emit all pairs: first every member is compared with its
bucket's smallest member; then, in buckets whose members are not together yet,
signatures are compared in blocks of bounded size, and only pairs of different
components whose estimate is within ``MARGIN`` of the threshold become rows,
each in the first bucket that the two share. Links are confirmed on full
shingle sets. Texts meet in ordinary joins that adaptive execution can split.

With 42 bands of 6 slots a pair at similarity 0.8 shares no bucket with
probability (1 - 0.8^6)^42 < 3e-6; the estimate of 256 slots has a standard
deviation of at most 0.025 there, so the margin is 3.6 of them.

Defined cases: null or blank text has an empty set, links with nothing and is
kept; a null doc_id takes no part (component null, kept); rows with one doc_id
are one document, whose sets all lead to its links; texts of any length are read
whole; an empty table gives an empty result; columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.components import components
from veracity.llm.shared import batches_by_bytes, cut, mix64, released, shingle_sets, small

SLOTS, BANDS, ROWS = 256, 42, 6
MARGIN, MEMBERS = 0.09, 1024
_U = np.uint64
_SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, slots binary"


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures of hash sets, one row each; ``slots`` is a power of two. Empty sets give zeros."""
    n_docs = len(sets)
    filled = np.zeros(n_docs * slots, bool)
    out = np.zeros(n_docs * slots, _U)
    sizes = np.array([len(s) for s in sets], np.int64)
    doc = np.repeat(np.arange(n_docs), sizes)
    h = np.concatenate(sets) if n_docs else np.empty(0, _U)
    turn = mix64(h, 101)
    step, first = turn | _U(1), mix64(h, 102)
    mask, bits = _U(slots - 1), _U(slots.bit_length() - 1)
    for level in range(slots):
        if not len(h):
            break
        # the level-th slot of the element's permutation: odd steps walk through all slots of a power of two
        slot = ((first >> _U(8)) + step * _U(level)) & mask
        cell = doc * slots + slot.astype(np.int64)
        open_ = ~filled[cell]
        if open_.any():
            cells, offers = cell[open_], mix64(h[open_], 1000 + level) >> bits
            won = np.full(n_docs * slots, np.iinfo(np.uint64).max, _U)
            np.minimum.at(won, cells, offers)
            new = np.unique(cells)
            out[new] = won[new] * _U(slots) + _U(level)
            filled[new] = True
        done = filled.reshape(n_docs, slots).all(axis=1)
        keep = ~done[doc]
        if not keep.all():
            doc, h, step, first = doc[keep], h[keep], step[keep], first[keep]
    return out.reshape(n_docs, slots)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    part = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    key = np.zeros(part.shape[:2], _U)
    for r in range(rows):
        key = mix64(key ^ part[:, :, r], 7 + r)
    return mix64(key + np.arange(bands, dtype=_U)[None, :] * _U(0xA0761D6478BD642F), 3).view(np.int64)


def _sketcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in batches_by_bytes(texts, 1_500_000):
                sets = shingle_sets(texts[a:b], k)
                n = np.array([len(s) for s in sets], np.int64)
                prints = [[int(mix64(s, salt).sum(dtype=_U)) if len(s) else 0 for s in sets] for salt in (11, 12)]
                sig = signatures(sets)
                keys, short = band_keys(sig), mix64(sig, 4).astype(np.uint8)
                flat = pa.array(keys.reshape(-1), pa.int64())
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
                yield pa.record_batch(
                    [ids.slice(a, b - a), pa.array(n), *(pa.array(np.array(p, _U).view(np.int64)) for p in prints),
                     pa.ListArray.from_arrays(offsets, flat), pa.array([x.tobytes() for x in short], pa.binary())],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands", "slots"])
    return run


def _verifier(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in small(batches, 200):
            us, vs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            u_out, v_out = [], []
            for a, b in batches_by_bytes(right, 1_000_000):
                for i, other in enumerate(shingle_sets(right[a:b], k), a):
                    if us[i] not in kept:  # rows of one left document mostly follow one another
                        kept = {us[i]: shingle_sets([left[i]], k)[0]}
                    mine = kept[us[i]]
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    if both and 100 * both >= percent * (len(mine) + len(other) - both):
                        u_out.append(us[i])
                        v_out.append(vs[i])
            yield pa.record_batch([pa.array(u_out, pa.int64()), pa.array(v_out, pa.int64())], names=["u", "v"])
    return run


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach the threshold."""
    texts = docs.select(F.col("doc_id").alias("id"), "text").filter("id IS NOT NULL AND text IS NOT NULL")
    right = pairs.join(texts.alias("t"), F.col("v") == F.col("t.id")).select("u", "v", F.col("t.text").alias("right"))
    both = right.join(texts.alias("s"), F.col("u") == F.col("s.id")).select("u", "v", F.col("s.text").alias("left"), "right")
    return both.mapInArrow(released(_verifier(k, percent)), "u long, v long")


def _near_in_block(percent: int):
    """Pairs of one bucket (or pair of its blocks) that may be linked: of different components, sizes and estimate
    within the threshold, and in no earlier common bucket."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(part["lo"].iloc[0]), int(part["hi"].iloc[0])
        part = part.sort_values("rep", ignore_index=True)
        rep, n, c, block = (part[x].to_numpy(np.int64) for x in ("rep", "n", "c", "block"))
        slots = np.frombuffer(b"".join(part["slots"]), np.uint8).reshape(len(part), -1)
        bands = np.stack(part["bands"].to_numpy())
        key = int(part["key"].iloc[0])
        # eight bits of a slot agree by chance once in 256
        least = percent / 100 - MARGIN
        least = (least + (1 - least) / 256) * slots.shape[1]
        us, vs = [], []
        for i in range(len(part) - 1):
            other = np.arange(i + 1, len(part))
            fits = (c[other] != c[i]) & (np.minimum(n[other], n[i]) * 100 >= np.maximum(n[other], n[i]) * percent)
            if lo != hi:
                fits &= block[other] != block[i]
            other = other[fits]
            other = other[(slots[other] == slots[i]).sum(axis=1) >= least]
            if len(other):
                first = (bands[other] == bands[i]).argmax(axis=1)
                other = other[bands[i][first] == key]
                us += [int(rep[i])] * len(other)
                vs += rep[other].tolist()
        return pd.DataFrame({"u": np.array(us, np.int64), "v": np.array(vs, np.int64)})
    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their distinct k-word shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = cut(docs.mapInArrow(released(_sketcher(k)), _SKETCH))
    sets = cut(sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("slots").alias("slots")))
    rows = sets.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    heads = rows.groupBy("key").agg(F.min("rep").alias("head"), F.min_by("n", "rep").alias("head_n"),
                                    F.count("*").alias("size")).filter("size > 1")
    members = cut(rows.join(heads, "key"))

    def near(a: str, b: str):
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    pairs = cut(members.filter(F.col("rep") != F.col("head")).filter(near("n", "head_n")).select(
        F.col("head").alias("u"), F.col("rep").alias("v")).distinct())
    links = cut(_verified(pairs, docs, k, percent))
    # second pass: buckets of three or more whose members are not yet together
    found = cut(components(links))
    more = (members.filter("size > 2").join(found, F.col("rep") == F.col("node"), "left")
            .select("key", "size", "rep", "n", F.coalesce("component", "rep").alias("c")))
    mixed = more.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    more = cut(more.join(mixed, "key"))
    more = more.withColumn("blocks", F.ceil(F.col("size") / MEMBERS).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    more = more.join(sets.select("rep", "bands", "slots"), "rep").select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "n", "c", "bands", "slots")
    rest = more.groupBy("key", "lo", "hi").applyInPandas(_near_in_block(percent), "u long, v long")
    rest = cut(rest.join(pairs, ["u", "v"], "left_anti"))
    late = _verified(rest, docs, k, percent)
    # rows of one id are one document: an id with several sets ties them together
    several = (sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min(F.struct("f1", "f2", "n_shingles")).alias("lo"), F.max(F.struct("f1", "f2", "n_shingles")).alias("hi"))
               .filter("lo <> hi").select("doc_id"))
    ties = (sketch.select("doc_id", "f1", "f2", "n_shingles").join(several, "doc_id").distinct()
            .join(sets.select("f1", "f2", "n_shingles", "rep"), ["f1", "f2", "n_shingles"]).select("doc_id", "rep"))
    grouped = components(links.union(late).union(found.select("node", "component")).union(ties))
    of_set = sets.select("f1", "f2", "n_shingles", "rep").join(grouped, F.col("rep") == F.col("node"), "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("found"))
    return (sketch.drop("bands", "slots").join(of_set, ["f1", "f2", "n_shingles"], "left")
            .withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id"))
                        .when(F.col("doc_id").isNotNull(), F.col("found")))
            .select("doc_id", "n_shingles", "component_id",
                    (F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept")))
