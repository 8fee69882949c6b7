"""Language-model scoring with a gated recurrent network in numpy.

Tokens are words (A-Z folded) and one end per document. Counts of all training
tokens are gathered by Spark and give the base score. The network reads the
``CLASSES * MEMBERS`` most frequent tokens; its output softmax is factored into
the class and the member within the class (classes by frequency), and every
other token is one further class whose members share the chance by the base
counts, so probabilities of all tokens add up to one.

Training is truncated backpropagation: documents lie one after another in
lanes, windows of ``WINDOW`` steps are unrolled, the state is carried from
window to window and reset where a document begins. Every training document is
read in one of ``ROUNDS`` rounds (by the hash of its id); in a round each task
trains on its split from the shared parameters, and parameters are averaged by
tokens in Spark. So both what is counted and what is learned grow with the
input. Scoring carries the state across windows over each whole document.

Scale: counts are pre-aggregated in tasks and summed by a 64-bit word hash. The
at most ``HEAD`` most frequent tokens' counts are broadcast (2.4 MB, a fixed bound);
rarer tokens meet their counts in a join of (row, word) pairs.

Defined cases: null or blank text is the end token alone; a null doc_id counts
as remainder 0 (not held out); without training documents the base score of
every token is log10(1) and the network gives a uniform choice of classes it
never learned; repeated rows are scored one by one; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.shared import batches_by_bytes, cut, id_remainder, released, word_hashes

CLASSES, MEMBERS, HIDDEN = 32, 96, 16
HEAD, ROUNDS, WINDOW, LANES, RATE = 200_000, 2, 32, 256, 0.3
SCORE_LANES, BATCH = 512, 8_000_000
#: Bytes of text scored together (the more documents, the fuller the lanes beside the longest), and tokens whose output is computed at once.
SCORE_BATCH, BLOCK = 16_000_000, 8192
END = np.uint64(0)  # stands for the end token; no word hashes to it in practice
_F = np.float32


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, offsets): the tokens of text i are hashes[offsets[i]:offsets[i + 1]], the end included."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    starts, words = word_hashes(np.frombuffer(b" ".join(parts) + b" ", np.uint8))
    cuts = np.searchsorted(starts, bounds)
    out = np.insert(words, cuts[1:], END)
    return out, cuts + np.arange(len(cuts))


# ---------------------------------------------------------------- the network
def start_parameters(class_counts: np.ndarray, member_counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; biases that give the counts' own distribution. The last class holds all other tokens."""
    rng = np.random.default_rng(seed)
    h, words = HIDDEN, CLASSES * MEMBERS
    p = {"embed": rng.normal(0, 0.1, (words + 1, h)), "wx": rng.normal(0, h ** -0.5, (h, 3 * h)),
         "wh": rng.normal(0, h ** -0.5, (h, 3 * h)), "b": np.zeros(3 * h),
         "wc": np.zeros((h, CLASSES + 1)), "bc": np.log((class_counts + 0.5) / (class_counts + 0.5).sum()),
         "wm": np.zeros((CLASSES, h, MEMBERS)), "bm": np.log(member_counts + 0.5)}
    return {k: v.astype(_F) for k, v in p.items()}


def forward(p: dict, given: np.ndarray, fresh: np.ndarray, h: np.ndarray, save: bool = True):
    """States of a window. given: (steps, lanes) previous tokens; fresh: True where a document begins; h: carried state.

    Inside, lanes lie last: a gate of all lanes is one block of memory. ``save`` keeps what :func:`backward` needs."""
    k, (n, lanes) = HIDDEN, given.shape
    half = np.repeat(np.array([0.5, 1], _F), [2 * k, k])[:, None]  # the logistic function is a tanh of half its argument
    wx, wh = p["wx"].T * half, p["wh"].T * half
    gates = wx @ p["embed"][given].transpose(0, 2, 1)
    gates += p["b"][:, None] * half
    keep, begins = (~fresh).astype(_F)[:, None, :], fresh.any(axis=1)
    hs, before = np.empty((n, k, lanes), _F), np.empty((n, k, lanes), _F) if save else None
    us = np.empty((n if save else 1, 3 * k, lanes), _F)
    h = np.ascontiguousarray(h.T)
    for t in range(n):
        if begins[t]:
            h = h * keep[t]
        if save:
            before[t] = h
        u = np.matmul(wh, h, out=us[t if save else 0])
        rz, c = gates[t, : 2 * k], gates[t, 2 * k:]
        rz += u[: 2 * k]
        np.tanh(rz, out=rz)
        rz += _F(1)
        rz *= _F(0.5)
        c += rz[:k] * u[2 * k:]
        np.tanh(c, out=c)
        h = np.subtract(h, c, out=hs[t])
        h *= rz[k:]
        h += c
    hs = np.ascontiguousarray(hs.transpose(0, 2, 1))
    return hs, (before, gates, us, keep, begins), hs[-1]


def _exp(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, at: np.ndarray):
    """(exp of the clipped scores, the scores at (rows, at)); one buffer, as new large ones cost more than the arithmetic."""
    z = h @ weights
    z += bias
    np.clip(z, _F(-60), _F(60), out=z)  # keeps exp finite without a row maximum
    own = z[rows, at]
    return np.exp(z, out=z), own


def output(p: dict, hs: np.ndarray, token: np.ndarray, grads: dict | None = None):
    """Natural log-probabilities of the tokens after the states; with ``grads``, also d(-sum)/d(states)."""
    cls = np.minimum(token // MEMBERS, CLASSES)
    rows = np.arange(len(token))
    e, own = _exp(hs, p["wc"], p["bc"], rows, cls)
    total = e @ np.ones((e.shape[1], 1), e.dtype)
    logp = own - np.log(total[:, 0])
    dh = None
    if grads is not None:
        e /= total
        e[rows, cls] -= 1
        grads["wc"] += hs.T @ e
        grads["bc"] += e.sum(axis=0)
        dh = e @ p["wc"].T
    order = np.argsort(cls.astype(np.uint8), kind="stable")  # small numbers are sorted in linear time
    ends = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    for c in np.flatnonzero(np.diff(ends)):
        own = order[ends[c]: ends[c + 1]]
        h, member = hs[own], token[own] % MEMBERS
        at = rows[: len(own)]
        e, mine = _exp(h, p["wm"][c], p["bm"][c], at, member)
        total = e @ np.ones((MEMBERS, 1), e.dtype)
        logp[own] += mine - np.log(total[:, 0])
        if grads is not None:
            e /= total
            e[at, member] -= 1
            grads["wm"][c] += h.T @ e
            grads["bm"][c] += e.sum(axis=0)
            dh[own] += e @ p["wm"][c].T
    return logp, dh


def backward(p: dict, grads: dict, given: np.ndarray, saved, dhs: np.ndarray) -> None:
    """Adds the gradients of the recurrent part; dhs: gradient of each state from the output."""
    before, gates, us, keep, begins = saved
    k, n = HIDDEN, len(given)
    r, z, c, un = gates[:, :k], gates[:, k: 2 * k], gates[:, 2 * k:], us[:, 2 * k:]
    dx, du = np.empty_like(gates), np.empty_like(gates)
    down = np.ascontiguousarray(dhs.transpose(0, 2, 1))
    dh = np.zeros_like(before[0])
    # slopes that do not depend on the gradient, for the whole window at once
    rest = 1 - z
    to_c, to_z, to_r = rest * (1 - c * c), (before - c) * z * rest, un * r * (1 - r)
    for t in range(n - 1, -1, -1):
        dh += down[t]
        dc = np.multiply(dh, to_c[t], out=dx[t, 2 * k:])
        np.multiply(dh, to_z[t], out=dx[t, k: 2 * k])
        np.multiply(dc, to_r[t], out=dx[t, :k])
        du[t, : 2 * k] = dx[t, : 2 * k]
        np.multiply(dc, r[t], out=du[t, 2 * k:])
        dh *= z[t]
        dh += p["wh"] @ du[t]
        if begins[t]:
            dh *= keep[t]
    flat, x = dx.transpose(0, 2, 1).reshape(-1, 3 * k), given.reshape(-1)
    grads["wx"] += p["embed"][x].T @ flat
    grads["b"] += flat.sum(axis=0)
    grads["wh"] += before.transpose(0, 2, 1).reshape(-1, k).T @ du.transpose(0, 2, 1).reshape(-1, 3 * k)
    into = flat @ p["wx"].T
    order = np.argsort(x.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.append(True, x[order][1:] != x[order][:-1]))
    grads["embed"][x[order][first]] += np.add.reduceat(into[order], first, axis=0)


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Whole documents in lanes of about equal length, the longest lane first."""
    heap = [(0, i) for i in range(min(lanes, max(1, len(lengths))))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        held, i = heapq.heappop(heap)
        out[i].append(d)
        heapq.heappush(heap, (held + int(lengths[d]), i))
    return sorted(out, key=lambda ds: -int(lengths[ds].sum()))


def windows(ids: np.ndarray, offsets: np.ndarray, lanes: int, steps: int = WINDOW):
    """(previous tokens, tokens, document begins, positions in ids) of each window, (steps, active lanes); lanes that end drop out at the back."""
    lengths = np.diff(offsets)
    cols = [np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in lane]) for lane in lanes_of(lengths, lanes) if lane]
    sizes = np.array([len(c) for c in cols])
    begins = np.zeros(len(ids), bool)
    begins[offsets[:-1]] = True
    for a in range(0, int(sizes[0]) if len(sizes) else 0, steps):
        live = int(np.searchsorted(-sizes, -a, side="left"))
        n = min(steps, int(sizes[0]) - a)
        at = np.full((n, live), -1, np.int64)
        for i in range(live):
            part = cols[i][a: a + n]
            at[: len(part), i] = part
        token = ids[at]
        fresh = begins[at] & (at >= 0)
        previous = np.where(fresh, CLASSES * MEMBERS, ids[at - 1])  # a document begins after "no token"
        yield previous, token, fresh, at


class Trainer:
    def __init__(self, p: dict, rate: float = RATE):
        self.p = {k: v.copy() for k, v in p.items()}
        self.seen = {k: np.full_like(v, 1e-2) for k, v in p.items()}
        self.rate = rate

    def learn(self, ids: np.ndarray, offsets: np.ndarray) -> None:
        h = None
        for previous, token, fresh, at in windows(ids, offsets, LANES):
            h = np.zeros((token.shape[1], HIDDEN), _F) if h is None else h[: token.shape[1]]
            hs, saved, h = forward(self.p, previous, fresh, h)
            grads = {k: np.zeros_like(v) for k, v in self.p.items()}
            real = at.reshape(-1) >= 0
            flat = hs.reshape(-1, HIDDEN)
            dhs = np.zeros_like(flat)
            _, dhs[real] = output(self.p, flat[real], token.reshape(-1)[real], grads)
            backward(self.p, grads, previous, saved, dhs.reshape(hs.shape))
            scale = _F(1 / max(1, int(real.sum())))
            for k, g in grads.items():
                g *= scale * _F(30)
                np.clip(g, -1, 1, out=g)
                step = g * g
                self.seen[k] += step
                np.sqrt(self.seen[k], out=step)
                np.divide(g, step, out=step)
                step *= _F(self.rate * 0.3)
                self.p[k] -= step


def log_likelihood(p: dict, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of natural log-probabilities of each document; the state is carried across windows."""
    out = np.zeros(len(ids))
    h, held, waiting = None, [], 0

    def put():  # windows of few lanes share one output
        states, tokens, places = (np.concatenate(v) for v in zip(*held))
        out[places] = output(p, states, tokens)[0]
        held.clear()

    for previous, token, fresh, at in windows(ids, offsets, SCORE_LANES):
        h = np.zeros((token.shape[1], HIDDEN), _F) if h is None else h[: token.shape[1]]
        hs, _, h = forward(p, previous, fresh, h, save=False)
        at = at.reshape(-1)
        real = at >= 0
        held.append((hs.reshape(-1, HIDDEN)[real], token.reshape(-1)[real], at[real]))
        waiting += len(held[-1][2])
        if waiting >= BLOCK:
            put()
            waiting = 0
    if held:
        put()
    return np.add.reduceat(out, offsets[:-1]) if len(offsets) > 1 else np.empty(0)


# ---------------------------------------------------------------- Spark
class Vocabulary:
    """The most frequent tokens: counts of the head, slots of those that the network knows, the base law."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        order = np.lexsort((hashes, -counts))
        slot = np.full(len(hashes), CLASSES * MEMBERS, np.int64)
        known = order[: CLASSES * MEMBERS]
        slot[known] = np.arange(len(known))
        by_hash = np.argsort(hashes)
        self.hashes, self.counts, self.slots = hashes[by_hash], counts[by_hash], slot[by_hash]
        inside = self.slots < CLASSES * MEMBERS
        self.known, self.known_slots = self.hashes[inside], self.slots[inside]
        self.total, self.distinct = total, distinct
        self.mass = total + 0.5 * (distinct + 1)
        members = np.zeros(CLASSES * MEMBERS)
        members[: len(known)] = counts[known]
        self.members = members.reshape(CLASSES, MEMBERS)
        held = counts[known].sum()
        self.classes = np.append(self.members.sum(axis=1), total - held)
        #: log10 of the base chance of all tokens that the network does not know
        self.rest = np.log10(max(1e-300, 1 - (held + 0.5 * len(known)) / self.mass))

    def slot(self, tokens: np.ndarray) -> np.ndarray:
        """The network's slot of each token, from its own small table."""
        if not len(self.known):
            return np.full(len(tokens), CLASSES * MEMBERS, np.int64)
        at = np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)
        return np.where(self.known[at] == tokens, self.known_slots[at], CLASSES * MEMBERS)

    def look(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, count) of each token; count -1 outside the head."""
        if not len(self.hashes):
            return np.full(len(tokens), CLASSES * MEMBERS, np.int64), np.full(len(tokens), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        hit = self.hashes[at] == tokens
        return np.where(hit, self.slots[at], CLASSES * MEMBERS), np.where(hit, self.counts[at], -1)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merge():
        h, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        return h, np.bincount(back, weights=np.concatenate([x[1] for x in held]), minlength=len(h)).astype(np.int64)

    def rows(h, n):
        for a in range(0, len(h), 100_000):
            yield pa.record_batch([pa.array(h[a: a + 100_000].view(np.int64)), pa.array(n[a: a + 100_000])], names=["h", "n"])

    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in batches_by_bytes(texts, 2_000_000):
            held.append(np.unique(tokens_of(texts[a:b])[0], return_counts=True))
        if sum(len(x[0]) for x in held) > 2_000_000:
            held = [merge()]
            if len(held[0][0]) > 1_000_000:  # bounded memory: hand on what is there
                yield from rows(*held.pop())
    if held:
        yield from rows(*merge())


def count_tokens(docs: DataFrame) -> DataFrame:
    """(h, n): the number of each token in the texts."""
    return docs.select("text").mapInArrow(released(_counter), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The head holds all tokens from a count on that at most ``HEAD`` reach (found by a histogram of the counts, of a few
    thousand rows), and at least as many tokens as the network knows."""
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    rank = F.when(F.col("n") < 4096, F.col("n")).otherwise(4096 + F.floor(F.log2("n") * 64)).cast("long")
    least, held = 1 << 62, 0
    for r, n in sorted(counts.groupBy(rank.alias("r")).count().collect(), reverse=True):
        if held + n > HEAD:
            break
        least, held = r, held + n
    head = counts.filter(rank >= least) if held >= CLASSES * MEMBERS else counts.orderBy(F.desc("n"), "h").limit(CLASSES * MEMBERS)
    head = head.toArrow()
    return Vocabulary(head.column("h").to_numpy().view(np.uint64), head.column("n").to_numpy(), int(total or 0), int(distinct))


def _flat(p: dict) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)])


def _shaped(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at: at + like[k].size].reshape(like[k].shape).astype(_F)
        at += like[k].size
    return out


def _trainer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, p = shared.value
        trainer, seen = Trainer(p), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in batches_by_bytes(texts, BATCH):
                tokens, offsets = tokens_of(texts[a:b])
                trainer.learn(vocab.slot(tokens), offsets)
                seen += len(tokens)
        if seen:
            part = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([part], pa.int64()), pa.array([float(seen)]),
                                   pa.array([_flat(trainer.p).tobytes()], pa.binary())], names=["part", "weight", "p"])
    return run


def _average(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("part")
    w = part["weight"].to_numpy()
    total = sum(np.frombuffer(p, _F).astype(np.float64) * x for p, x in zip(part["p"], w))
    return pd.DataFrame({"part": [int(part["part"].iloc[0]) >> 5], "weight": [float(w.sum())], "p": [(total / w.sum()).astype(_F).tobytes()]})


def fit(train: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> dict:
    """Parameters after ``rounds`` of local training and averaging; every training document is read in one round."""
    spark = train.sparkSession
    p = start_parameters(vocab.classes, vocab.members)
    schema = "part long, weight double, p binary"
    for r in range(rounds):
        shared = spark.sparkContext.broadcast((vocab, p))
        own = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == r).select("text")
        level = cut(own.mapInArrow(released(_trainer(shared)), schema))
        # a task's parameters are 0.4 MB: averaged 32 by 32 until one is left
        while True:
            level = cut(level.groupBy((F.col("part") / 32).cast("long").alias("k")).applyInPandas(_average, schema))
            if level.count() <= 1:
                break
        got = level.first()
        if got is not None:
            p = _shaped(np.frombuffer(got["p"], _F), p)
        shared.unpersist()
    return p


_SCORED = "doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, model double, row long, tail array<long>"


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, p = shared.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in batches_by_bytes(texts, SCORE_BATCH):
                tokens, offsets = tokens_of(texts[a:b])
                slots, counts = vocab.look(tokens)
                base = np.log10((np.maximum(counts, 0) + 0.5) / vocab.mass)
                head, other = counts >= 0, slots == CLASSES * MEMBERS
                first = offsets[:-1]
                # the network's own chance of "another token", shared out by the base law; the tail's part is added by the join
                model = log_likelihood(p, slots, offsets) / np.log(10) + np.add.reduceat(
                    np.where(other, np.where(head, base, 0.0) - vocab.rest, 0.0), first)
                n = b - a
                tail = np.flatnonzero(~head)
                inside = np.searchsorted(tail, offsets).astype(np.int32)
                yield pa.record_batch(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(np.diff(offsets)),
                     pa.array(np.add.reduceat(head.astype(np.int64), first)), pa.array(np.add.reduceat(np.where(head, base, 0.0), first)),
                     pa.array(model), pa.array(np.arange(row, row + n)),
                     pa.ListArray.from_arrays(pa.array(inside), pa.array(tokens[tail].view(np.int64)))],
                    names=[f.split()[0] for f in _SCORED.split(", ")])
                row += n
    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Learns from documents whose crc32(id) mod 5 is not 1; log10 probabilities.
    """
    held = id_remainder(F.col("doc_id"), 5) == 1
    train = docs.filter(~held).select("doc_id", "text")
    counts = cut(count_tokens(train))
    vocab = vocabulary(counts)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, fit(train, vocab)))
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
               .mapInArrow(released(_scorer(shared)), _SCORED))
    chance = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(vocab.mass))
    tail = (rows.select("row", F.explode("tail").alias("h")).join(counts, "h", "left").groupBy("row")
            .agg(F.sum(chance).alias("tail_base"), F.count("n").alias("tail_known")))
    base = F.coalesce("tail_base", F.lit(0.0))
    return (rows.drop("tail").join(tail, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                    F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("head_base") + base).alias("base_score"),
                    (F.col("model") + base).alias("score")))
