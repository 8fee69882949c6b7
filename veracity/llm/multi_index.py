"""Embedding near-duplicates with an inverted multi-index.

A unit vector is split into halves; independent codebooks quantise each half,
and pairs of code words form a grid of cells (for each label and dimension).
A vector visits cells in the multi-sequence order, by ascending sum of the
halves' squared distances to the cells: what lies in centroid c's part is
beyond the plane between c and the query's own centroid a, so it is at least
(|x-c|^2 - |x-a|^2) / (2 |c-a|) away. Two vectors at the threshold differ by a
vector of length sqrt(2 (1 - cosine)); traversal stops at that length, so no
link is missed however the vectors are spread (recall 1; tests measure it on
vectors of low rank). Visited residents are compared in single precision; what
lies within its rounding of the threshold is verified in double precision.

Scale: equal vectors of a label are collapsed first (partial aggregation), so a
huge group of copies is one resident with a multiplicity. Codebooks are fitted
on at most ``SAMPLE`` distinct vectors (chosen by hash) and hold about one
centroid a half for each square root of ``CELL`` vectors' share; every row is
indexed. The vectors of a label are dealt out in tiles; a task holds one tile,
sorted by cell, and those of another one visit its cells, ``VISITORS`` at a time
(the bounds of the nearest one hold for all), so that a vector is sent once for
each tile of its label and never once for each cell, and no list of visits is
written. Each pair of vectors meets once. The work is quadratic in a label's
vectors where the bounds exclude little; memory is bounded. Links leave a task
as counts and as edges of a forest of its local groups, never as all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with null label, link with nothing and are their own
component; vectors of different length never link; equal rows are vectors of
their own that link with each other; a null vec_id is returned with a null
component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.llm.components import components
from veracity.llm.shared import cut, released

COSINE, SAMPLE, CELL, MOST_CODES = 0.93, 8192, 1024, 256
#: Vectors and bytes (as single floats) of a tile at most, the share of all vectors and the number that a tile has room for
#: at least; vectors that visit together, and residents compared with them at a time.
TILE, TILE_BYTES, SHARE, LEAST = 1 << 16, 1 << 25, 8, 1024
VISITORS, RESIDENTS = 256, 4096


def _valid(kind: type):
    """(vec_id, label, dim, bytes of the floats of that kind); bytes are null for vectors that cannot link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, label = batch.column(1), batch.column(2)
            with np.errstate(invalid="ignore"):
                flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False)).astype(kind) + kind(0)  # null components become NaN
            size = lists.value_lengths().fill_null(0).to_numpy()
            ends = np.append(0, np.cumsum(size))
            top, some = np.zeros(len(size)), np.flatnonzero(size)
            if len(some):
                top[some] = np.maximum.reduceat(np.abs(flat), ends[some])
            good = np.isfinite(top) & (top > 0) & ~label.is_null().to_numpy(zero_copy_only=False)
            v = pa.Array.from_buffers(pa.binary(), len(size), [pa.py_buffer(np.packbits(good, bitorder="little")),
                                                               pa.py_buffer((ends * flat.itemsize).astype(np.int32)), pa.py_buffer(flat)])
            yield pa.record_batch([batch.column(0), label, pa.array(np.where(good, size, 0), pa.int32()), v],
                                  names=["vec_id", "label", "dim", "v"])
    return run


def _units(column, dim: int, kind: type = np.float64) -> np.ndarray:
    x = np.frombuffer(b"".join(column), kind).reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, steps: int = 8, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = (-2 * x @ c.T + (c * c).sum(axis=1)).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _bounds(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own code, squared lower bound of the distance to anything in each code's part) of the rows of one half."""
    d = (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)
    own = d.argmin(axis=1)
    apart = np.sqrt(np.maximum(((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2), 0))[own]
    gap = d - d[np.arange(len(x)), own][:, None]
    low = np.where(apart > 0, gap / np.maximum(2 * apart, 1e-300), 0.0)
    return own, np.maximum(low - 1e-9, 0.0) ** 2


def traverse(low1: np.ndarray, low2: np.ndarray, radius2: float) -> np.ndarray:
    """Cells of one row's grid in multi-sequence order: both halves sorted, sums of bounds ascending, up to the radius."""
    o1, o2 = np.argsort(low1, kind="stable"), np.argsort(low2, kind="stable")
    ends = np.searchsorted(low2[o2], radius2 - low1[o1], side="right")
    a = np.repeat(np.arange(len(o1)), ends)
    b = np.arange(len(a)) - np.repeat(np.cumsum(ends) - ends, ends)
    order = np.argsort(low1[o1[a]] + low2[o2[b]], kind="stable")
    return (o1[a] * len(o2) + o2[b])[order]


def reach2(cosine: float) -> float:
    """Squared distance at which the traversal stops: that of two unit vectors at the threshold."""
    return 2 * (1 - cosine) + 1e-6


def _assign(books: dict, cosine: float, kind: type = np.float64, visits: bool = True):
    """Adds the own cell of each vector, and the cells that it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs = batch.column("dim").to_numpy(), batch.column("v").to_pylist()
            cells, visited = np.zeros(len(vecs), np.int64), [np.zeros(1, np.int32)] * len(vecs)
            for dim in set(dims.tolist()) & set(books):
                rows = np.flatnonzero(dims == dim)
                x, half = _units([vecs[i] for i in rows], dim, kind), dim // 2
                (own1, low1), (own2, low2) = _bounds(x[:, :half], books[dim][0]), _bounds(x[:, half:], books[dim][1])
                cells[rows] = own1 * len(books[dim][1]) + own2
                for r, i in enumerate(rows if visits else []):
                    visited[i] = traverse(low1[r], low2[r], reach2(cosine)).astype(np.int32)
            more = {"cell": pa.array(cells, pa.int32())} | ({"visits": pa.array(visited, pa.list_(pa.int32()))} if visits else {})
            yield pa.record_batch([*batch.columns, *more.values()], names=[*batch.schema.names, *more])
    return run


class _Tile:
    """Residents sorted by cell: their ids, multiplicities, unit vectors, numbers of links, and the smallest id that each is
    known to be grouped with."""

    def __init__(self, pieces: list[pa.RecordBatch], dim: int, books: dict, cosine: float, kind: type):
        self.books, self.cosine, self.kind, self.dim = books.get(dim), cosine, kind, dim
        self.ids, self.n, self.cell = (np.concatenate([p.column(c).to_numpy() for p in pieces]) for c in ("rep", "n", "cell"))
        self.units = np.concatenate([_units(p.column("v").to_pylist(), dim, kind) for p in pieces])
        self.single, self.root, self.links = self.units.astype(np.float32), self.ids.copy(), np.zeros(len(self.ids), np.int64)
        self.slack = (dim + 8) * 2.0 ** -23  # more than what a product of two single unit vectors is off by

    def reached(self, units: np.ndarray, first: int) -> np.ndarray | slice:
        """Residents from ``first`` on in the cells that vectors visit: all that are not beyond reach of any."""
        if not self.books:
            return slice(first, len(self.ids))
        half, (one, two) = self.dim // 2, self.books
        low1, low2 = _bounds(units[:, :half], one)[1], _bounds(units[:, half:], two)[1]
        cells = np.sort(traverse(low1.min(axis=0), low2.min(axis=0), reach2(self.cosine)))
        starts, ends = np.searchsorted(self.cell, cells), np.searchsorted(self.cell, cells, side="right")
        starts = np.maximum(starts, first)
        size = np.maximum(ends - starts, 0)
        if 4 * size.sum() >= 3 * (len(self.ids) - first):  # hardly any is excluded: not worth picking them out
            return slice(first, len(self.ids))
        return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def visit(self, ids, n, units, single, root, links, at: int | None = None) -> list[np.ndarray]:
        """Adds the links of the visitors (residents from place ``at`` on, if given) and their residents to both, and returns
        the edges by which groups grow."""
        edges, which = [], self.reached(units, 0 if at is None else at)
        total = which.stop - which.start if isinstance(which, slice) else len(which)
        for a in range(0, total, RESIDENTS):
            part = slice(which.start + a, min(which.stop, which.start + a + RESIDENTS)) if isinstance(which, slice) else which[a: a + RESIDENTS]
            near = single @ self.single[part].T
            if near.max(initial=-1.0) < self.cosine - self.slack:
                continue
            hit, place = near >= self.cosine + self.slack, np.arange(len(self.ids))[part]
            u, w = np.nonzero((near >= self.cosine - self.slack) & ~hit)
            hit[u, w] = np.einsum("ij,ij->i", units[u], self.units[place[w]]) >= self.cosine
            if at is not None:  # each pair once
                hit &= place[None, :] > at + np.arange(len(ids))[:, None]
            rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
            if not len(rows):
                continue
            hit, place = hit[np.ix_(rows, cols)], place[cols]
            links[rows] += hit @ self.n[place]
            self.links[place] += n[rows] @ hit
            was_u, was_v = root[rows], self.root[place]
            now_u, now_v, none = was_u, was_v, np.iinfo(np.int64).max
            while True:  # the smallest id of each local group, passed on until nothing changes
                u = np.minimum(now_u, np.where(hit, now_v[None, :], none).min(axis=1))
                v = np.minimum(now_v, np.where(hit, u[:, None], none).min(axis=0))
                if (u == now_u).all() and (v == now_v).all():
                    break
                now_u, now_v = u, v
            root[rows] = np.minimum(root[rows], now_u)
            self.root[place] = np.minimum(self.root[place], now_v)
            was, now = np.append(was_u, was_v), np.append(now_u, now_v)
            edges.append(np.unique(np.stack([was, now], axis=1)[was != now], axis=0))
        return edges


def _found(edges: list[np.ndarray], ids: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    """Edges of groups, and the links of those vectors that have some as loops."""
    some = links > 0
    edges = np.unique(np.concatenate([*edges, np.empty((0, 2), np.int64)]), axis=0)
    return pa.record_batch([pa.array(np.append(edges[:, 0], ids[some])), pa.array(np.append(edges[:, 1], ids[some])),
                            pa.array(np.append(np.zeros(len(edges), np.int64), links[some]))], names=["u", "v", "links"])


def _verify(books: dict, cosine: float, kind: type):
    """Links of pairs of tiles, whose residents (side 0) come sorted by cell before their visitors; a tile that comes alone is
    its own visitor."""
    def visited(tile: _Tile, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, n = piece.column("rep").to_numpy(), piece.column("n").to_numpy()
        units, edges, root, links = _units(piece.column("v").to_pylist(), tile.dim, kind), [], ids.copy(), np.zeros(len(ids), np.int64)
        single = units.astype(np.float32)
        for a in range(0, len(ids), VISITORS):
            own = slice(a, a + VISITORS)
            edges += tile.visit(*(c[own] for c in (ids, n, units, single, root, links)))
        yield _found(edges, ids, links)

    def ended(tile: _Tile, alone: bool) -> Iterator[pa.RecordBatch]:
        edges = []
        for a in range(0, len(tile.ids) if alone else 0, VISITORS):
            own = slice(a, a + VISITORS)
            edges += tile.visit(*(c[own] for c in (tile.ids, tile.n, tile.units, tile.single, tile.root, tile.links)), at=a)
        yield _found(edges, tile.ids, tile.links)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, tile = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("label", "dim", "i", "j", "side")], axis=1).astype(np.int64)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for a, b in zip(starts, np.append(starts[1:], len(keys))):
                if tuple(keys[a, :4]) != key:
                    if pieces:
                        tile = tile or _Tile(pieces, key[1], books, cosine, kind)
                        yield from ended(tile, key[2] == key[3])
                    key, pieces, tile = tuple(keys[a, :4].tolist()), [], None
                piece = batch.slice(a, b - a)
                if keys[a, 4] == 0:
                    pieces.append(piece)
                elif pieces:
                    tile = tile or _Tile(pieces, key[1], books, cosine, kind)
                    yield from visited(tile, piece)
        if pieces:
            yield from ended(tile or _Tile(pieces, key[1], books, cosine, kind), key[2] == key[3])
    return released(run)


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; links join vectors of one label whose cosine reaches the threshold."""
    spark = embeddings.sparkSession
    single = embeddings.schema["embedding"].dataType == T.ArrayType(T.FloatType(), embeddings.schema["embedding"].dataType.containsNull)
    kind = np.float32 if single else np.float64
    # read twice rather than written; outside of the tiles, a vector is known by 16 bytes of its hash
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
            .mapInArrow(_valid(kind), "vec_id long, label long, dim int, v binary"))
    key = F.substring(F.unhex(F.sha2("v", 256)), 1, 16).alias("key")
    distinct = cut(rows.filter("v IS NOT NULL AND vec_id IS NOT NULL").groupBy("label", "dim", "v").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    size, labels = distinct.agg(F.count("*"), F.approx_count_distinct("label")).first()
    codes = max(1, min(MOST_CODES, round(math.sqrt(size / max(1, labels) / CELL * 16))))
    chosen = distinct.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("dim", "v").collect()
    books = {}
    for dim in {r["dim"] for r in chosen if r["dim"] > 1}:
        x = _units([r["v"] for r in chosen if r["dim"] == dim], dim, kind)
        books[dim] = (kmeans(x[:, : dim // 2], codes), kmeans(x[:, dim // 2:], codes, seed=8))
    room = F.greatest(F.lit(1), F.least(F.lit(min(TILE, max(LEAST, size // SHARE))), F.floor(F.lit(TILE_BYTES) / 4 / F.col("dim"))))
    each = distinct.groupBy("label", "dim").agg(F.count("*").alias("held")).withColumn("tiles", F.ceil(F.col("held") / room).cast("int"))
    # labels of more than one tile are few: each has more vectors than one tile has room for
    large = [tuple(r) for r in each.filter("tiles > 1").select("label", "dim", "tiles").collect()]
    pairs = sum(t * (t + 1) // 2 for _, _, t in large) + labels
    tiles = F.broadcast(spark.createDataFrame(large, "label long, dim int, tiles int"))
    placed = (distinct.mapInArrow(_assign(books, cosine, kind, visits=False), "label long, dim int, v binary, rep long, n long, cell int")
              .join(tiles, ["label", "dim"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
              .withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    pair = ["label", "dim", "i", "j"]
    met = (placed.select("label", "dim", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
                         (F.col("tile") > F.col("other")).cast("int").alias("side"), "cell", "rep", "n", "v")
           .repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4 * pairs, 2000)), *pair)
           .sortWithinPartitions(*pair, "side", "cell", "rep"))
    found = cut(met.mapInArrow(_verify(books, cosine, kind), "u long, v long, links long"))
    counts = found.filter("links > 0").groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    groups = components(found.select("u", "v"))
    known = (distinct.select("label", "dim", key, "rep", "n").join(counts, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
             .select("label", "dim", "key", F.coalesce("component", "rep").alias("found"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    return (rows.select("vec_id", "label", "dim", key).join(known.toDF(*known.columns), ["label", "dim", "key"], "left")
            .select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
                    F.coalesce("found", "vec_id").alias("component_id"))
            .withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.col("component_id")))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
