"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Shards own virtual nodes on a 64-bit ring; a document hashes to the arc before
its clockwise neighbour. Capacities are exact (counts at most one apart), so
law ``rows`` holds: an arc's documents that find the shard full continue
clockwise to the next shard with room. What an arc sends where depends only on
the arcs' counts, one row for each virtual node; documents are ranked inside
their arc by hash position, and a rank falls into one of the arc's intervals.

Scale: the first pass reads ids only and aggregates counts by arc (``shards *
nodes`` rows, a parameter); the second ranks (id, size, crc) rows inside arcs,
which the hash keeps even: with the number of virtual nodes for 100 TB an arc
is a small part of a shard. The interval table has at most arcs + shards * arcs
rows by construction and is broadcast. Texts are never shuffled.

Defined cases: null text has size 1 and the crc of no bytes; a null doc_id
hashes as empty text; rows with one doc_id are ordered by crc, size; equal rows
take neighbouring slots; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.shared import mix64

SHARDS, NODES = 8, 256
_SIGN = 1 << 63


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Positions (signed 64-bit, ascending) and shards of the virtual nodes."""
    at = (mix64(np.arange(shards, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(nodes, dtype=np.uint64)[None, :], 77)
          ^ np.uint64(_SIGN)).view(np.int64).reshape(-1)
    owner = np.repeat(np.arange(shards), nodes)
    order = np.lexsort((owner, at))
    return at[order], owner[order]


def flow(counts: np.ndarray, owner: np.ndarray, capacity: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(arc, from rank, shard, slot of the first) intervals: rounds in which what an arc has left tries its next node
    clockwise; a shard takes arcs in ring order while it has room."""
    left, done = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    room, filled = capacity.astype(np.int64).copy(), np.zeros(len(capacity), np.int64)
    out = []
    for step in range(len(counts)):
        open_ = np.flatnonzero(left)
        if not len(open_):
            break
        for arc in open_.tolist():
            shard = int(owner[(arc + step) % len(owner)])
            take = int(min(left[arc], room[shard]))
            if take:
                out.append((arc, int(done[arc]), shard, int(filled[shard])))
                left[arc] -= take
                done[arc] += take
                room[shard] -= take
                filled[shard] += take
    return out


def capacities(n: int, shards: int) -> np.ndarray:
    return np.array([n // shards + (i < n % shards) for i in range(shards)], np.int64)


def with_arcs(df: DataFrame, at: np.ndarray) -> DataFrame:
    """Adds ``arc``: the first virtual node at or after ``position`` (a binary search on Arrow batches); past the last
    one the ring begins again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arc = np.searchsorted(at, batch.column("position").to_numpy()) % len(at)
            yield pa.record_batch([*batch.columns, pa.array(arc, pa.int32())], names=[*batch.schema.names, "arc"])
    return df.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", arc int")


def assign(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """doc_id, size, text_crc32, law (``rows``), shard, slot (gapless from 0 in each shard), grown_shard (null)."""
    spark = docs.sparkSession
    at, owner = ring(shards, nodes)
    position = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    counts = np.zeros(len(at), np.int64)
    for row in with_arcs(docs.select(position.alias("position")), at).groupBy("arc").count().collect():
        counts[row["arc"]] = row["count"]
    parts = flow(counts, owner, capacities(int(counts.sum()), shards))
    plan = spark.createDataFrame(parts, "arc int, first long, to_shard int, slot0 long")
    ends = F.lead("first").over(Window.partitionBy("arc").orderBy("first"))
    plan = plan.withColumn("end", F.coalesce(ends, F.lit(1 << 62)))
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = with_arcs(docs.select("doc_id", (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"),
                                 position.alias("position")), at)
    rank = F.row_number().over(Window.partitionBy("arc").orderBy("position", "doc_id", "text_crc32", "size")) - 1
    # at most one interval for each arc and shard
    return (rows.withColumn("rank", rank).join(F.broadcast(plan.withColumnRenamed("arc", "of")),
                                               (F.col("arc") == F.col("of")) & F.col("rank").between(F.col("first"), F.col("end") - 1))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("to_shard").alias("shard"),
                    (F.col("slot0") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
