"""Ranked lexical search over a length-stratified index.

Documents of a shard are grouped by their length normaliser m. Inside such a
stratum a term's postings lie by tf, so an impact is computed once per
(stratum, tf) and added to a run of documents. A stratum's bound for a query is
the sum of weight times the impact of each term's largest tf there; strata are
visited from the highest bound on, and the visit ends at the first bound below
the k-th best score. Shards' lists are merged by a ranked window.

Scale: two passes over the documents, none of which shuffles a posting. The
first counts N, L and df (one row a term and task, summed in Spark). The second
deals each split into shards of bounded size, builds a shard's index where its
rows lie and answers all queries of a block there; a shard sends at most k rows
a query. Queries are taken in blocks of about ``BLOCK`` bytes of terms, which is
what is collected and broadcast at once; more queries give more blocks, each
with its own two passes. All scores are 64-bit integers.

Defined cases: rows of items with one id (null included) are one item with the
terms of all of them; a null or term-free text or item has no terms and meets
nothing; repeated documents count and rank one by one; a null doc_id ranks after
the others of its score; ties go to the smaller doc_id; long texts are read in
pieces; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.shared import small

K = 50
#: A shard ends at so many documents, or at so many occurrences of asked terms.
SHARD, OCCURRENCES = 16_384, 4_000_000
#: Bytes of query terms that one broadcast holds, and strata visited at a time.
BLOCK, STEP = 16 << 20, 8
_PIECE = 1 << 20
# ASCII letters and digits stay (A-Z folded), other ASCII separates, bytes from 0x80 on stay
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about a megabyte."""
    at, end = 0, len(text or b"")
    while at < end:
        stop = min(at + _PIECE, end)
        part = text[at: stop].translate(_FOLD)
        while stop < end and part[-1] != 32:  # up to the next separator
            ahead = text[stop: stop + _PIECE].translate(_FOLD)
            gap = ahead.find(b" ")
            take = len(ahead) if gap < 0 else gap + 1
            part, stop = part + ahead[:take], stop + take
        yield part.split()
        at = stop


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i] .. start[i] + size[i] - 1 of all i, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


class Strata:
    """The index of one shard over the terms asked for."""

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int):
        """m of each document, which ascends; postings (doc, term, tf) in any order."""
        self.m, first, of_doc = np.unique(m, return_index=True, return_inverse=True)
        self.first = np.append(first, len(m))
        self.n_terms, self.scores = n_terms, np.zeros(len(m), np.int64)
        stratum = of_doc[doc]
        order = np.lexsort((doc, tf, term, stratum))
        self.doc, term, tf, stratum = doc[order], term[order], tf[order], stratum[order]
        place = stratum.astype(np.int64) * n_terms + term
        runs = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (tf[1:] != tf[:-1]))) if len(place) else np.empty(0, np.int64)
        self.place, self.start = place[runs], runs
        self.size = np.diff(np.append(runs, len(place)))
        often = tf[runs].astype(np.int64)
        self.impact = 1_000_000_000 * often // (1000 * often + 20 * self.m[stratum[runs]])

    def _spans(self, strata: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First run and end of the runs of each (stratum, term)."""
        keys = strata[:, None] * self.n_terms + terms[None, :]
        return np.searchsorted(self.place, keys), np.searchsorted(self.place, keys, "right")

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The highest score that a document of each stratum can have."""
        out = np.zeros(len(self.m), np.int64)
        step = max(1, 1_000_000 // max(1, len(self.m)))
        for a in range(0, len(terms) if len(self.impact) else 0, step):
            low, high = self._spans(np.arange(len(self.m)), terms[a: a + step])
            out += np.where(high > low, self.impact[high - 1], 0) @ weights[a: a + step]
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best, ties to the smaller document number in order of ``rank``."""
        bound = self.bounds(terms, weights)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        docs, found = np.empty(0, np.int64), np.empty(0, np.int64)
        for a in range(0, len(order), STEP):
            strata = order[a: a + STEP]
            if len(found) == k:
                strata = strata[bound[strata] >= found[-1]]
                if not len(strata):
                    break
            low, high = self._spans(strata, terms)
            runs = _ranges(low.ravel(), (high - low).ravel())
            gain = self.impact[runs] * np.repeat(np.tile(weights, len(strata)), (high - low).ravel())
            np.add.at(self.scores, self.doc[_ranges(self.start[runs], self.size[runs])], np.repeat(gain, self.size[runs]))
            own = _ranges(self.first[strata], self.first[strata + 1] - self.first[strata])
            score = self.scores[own]
            self.scores[own] = 0
            good = score > 0
            if len(found) == k:
                good &= score >= found[-1]
            docs, found = np.append(docs, own[good]), np.append(found, score[good])
            best = np.lexsort((self.rank[docs], -found))[:k]
            docs, found = docs[best], found[best]
        return docs, found


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        ids, out = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for words in term_lists(text.encode("utf-8", "surrogatepass") if text else None):
                fresh = set(words)
                ids += [item] * len(fresh)
                out += fresh
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["item_id", "term"])


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _counter(vocabulary):
    """df of the asked terms, and under -1 and -2 the number of documents with a term and of their terms."""
    def run(batches):
        known = vocabulary.value
        held, total, df = 0, 0, np.zeros(len(known), np.int64)
        for batch in small(batches):
            for text in _texts(batch):
                n, seen = 0, set()
                for words in term_lists(text):
                    n += len(words)
                    seen |= known.keys() & set(words)
                if n:
                    held, total = held + 1, total + n
                    df[[known[w] for w in seen]] += 1
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(at, [-1, -2]), pa.int64()), pa.array(np.append(df[at], [held, total]), pa.int64())],
                              names=["term", "n"])
    return run


def _searcher(vocabulary, asked, n_docs: int, n_terms: int, k: int, shard: int):
    """``asked``: broadcast list of (item_id, term numbers, weights)."""
    def answers(ids: list, lengths: list[int], hits: list[np.ndarray], width: int) -> pa.RecordBatch:
        m = 50 + 50 * np.array(lengths, np.int64) * n_docs // n_terms
        none = np.array([i is None for i in ids])
        number = np.array([0 if i is None else i for i in ids], np.int64)
        order = np.lexsort((number, none, m))
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        key = np.concatenate([new[d] * width + h for d, h in enumerate(hits)])
        key, tf = np.unique(key, return_counts=True)
        index = Strata(m[order], key // width, key % width, tf, width)
        index.rank = np.argsort(np.lexsort((number[order], none[order])), kind="stable")
        items, docs, scores = [], [], []
        for item, terms, weights in asked.value:
            found, score = index.search(terms, weights, k)
            items += [item] * len(found)
            docs += [ids[order[d]] for d in found.tolist()]
            scores += score.tolist()
        return pa.record_batch([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
                               names=["item_id", "doc_id", "score"])

    def run(batches):
        known = vocabulary.value
        number, width = known.get, len(known)
        ids, lengths, hits, held = [], [], [], 0
        for batch in small(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch)):
                n, own = 0, []
                for words in term_lists(text):
                    n += len(words)
                    own.append(np.array([i for i in map(number, words) if i is not None], np.int64))
                own = np.concatenate(own) if own else np.empty(0, np.int64)
                if not len(own):
                    continue
                ids.append(doc_id)
                lengths.append(n)
                hits.append(own)
                held += len(own)
                if len(ids) >= shard or held >= OCCURRENCES:
                    yield answers(ids, lengths, hits, width)
                    ids, lengths, hits, held = [], [], [], 0
        if ids:
            yield answers(ids, lengths, hits, width)
    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents above score 0 of each item."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .mapInArrow(_item_terms, "item_id long, term binary").distinct())
    size = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = math.ceil(size / block)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for i in range(blocks):
        mine = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        by_item: dict[int | None, list[int]] = {}
        known: dict[bytes, int] = {}
        for item, term in zip(*(c.to_pylist() for c in mine.toArrow().columns)):
            by_item.setdefault(item, []).append(known.setdefault(term, len(known)))
        if not known:
            continue
        vocabulary = spark.sparkContext.broadcast(known)
        counts = own.mapInArrow(_counter(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        df = dict(zip(*(c.to_pylist() for c in counts.columns)))
        n_docs, n_terms = df.get(-1, 0), df.get(-2, 0)
        if not n_docs:
            continue
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(known))], np.int64)
        asked = spark.sparkContext.broadcast([(item, np.sort(np.array(t)), weights[np.sort(np.array(t))])
                                              for item, t in by_item.items()])
        found = found.union(own.mapInArrow(_searcher(vocabulary, asked, n_docs, n_terms, k, shard),
                                           "item_id long, doc_id long, score long"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
