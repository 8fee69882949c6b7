"""Quality classifier: cumulative-link (ordinal) regression on graded ratings.

Grades come from the labels: 0 toxic, 1 low quality, 2 good. All grades share
one weight vector over hashed text features; ordered thresholds cut the line:
P(grade <= k) = sigmoid(threshold_k - w.x). The expected grade and the tail
probability P(grade = 2) select documents (kept: tail probability >= 0.5).

Features of a text are its distinct lower-cased words (hashed); the beginnings
of its longer words, and whether one, two or three distinct words begin so; the
shapes of its words (runs of letters, capitals and digits folded, other
characters kept) with the share of words that have the shape, in steps; and the
shares of distinct words and of words that repeat the one before, and the number
of words where it is small, a feature for each step reached. Features rarer than
``MIN_DOCS`` sampled documents are unused, and so are those whose documents' grades tell too little: at one cut between grades
at least the log-likelihood ratio against the mean must reach ``SCREEN``, as the
noise of the others would add up with the length of a text.

The fit uses a sample of at most ``SAMPLE`` labelled documents, chosen by the
hash of the id; that bound is the parameter ``sample``. Of rows that repeat an
id the one with the smallest text crc enters the fit. Every document is
scored over its whole text.

Defined cases: null or empty text has only the features of short texts; very
long texts are read whole, a part at a time; labels with a null
grade column take the other column, rows with both null are left out, repeated
labels count with their lowest grade; without labels (or with one grade only)
every document gets that grade, or 2, with probability 1; null doc_ids are
scored like others; further columns pass through ``score`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.shared import batches_by_bytes, mix64, released, small, split_words, string_hashes, text_parts

SAMPLE, MIN_DOCS, SCREEN, BITS = 12_000, 2, 4.0, 18
#: Characters of a word's beginning.
STEM = 5
GRADES = 3
_SIZE = 1 << BITS
_STEPS = np.array([0.0, 0.02, 0.1, 0.3, 0.6])
_DISTINCT = np.array([0.05, 0.15, 0.3, 0.5, 0.8])
_AGAIN = np.array([0.02, 0.1, 0.3, 0.6])
_FEW = np.array([1, 4, 8, 16, 32])
_EDGE = ".,;:!?\"'()[]|*%$&#"
#: Characters read at a time.
SLICE = 1_000_000


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _extra(codes: np.ndarray) -> np.ndarray:
    """Feature ids of small codes that are no words."""
    return _buckets(mix64(codes.astype(np.uint64), 9))


def _short_ids() -> np.ndarray:
    """Features of short texts; they stay in the model, as such texts show little else."""
    return _extra(np.arange(len(_FEW)) + (5 << 40))


def _read(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(text, key, word, shape, stem) of the distinct words of each text, and each text's number of words and of repeats."""
    words, codes, ends = split_words(texts)
    plain = pc.utf8_trim(pc.utf8_lower(words), characters=_EDGE)
    shape = words
    for pattern, sign in ((r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]+", "a"), (r"\p{Lu}+", "\x01"), (r"\p{Nd}+", "0")):
        shape = pc.replace_substring_regex(shape, pattern, sign)
    word, form = string_hashes(plain), string_hashes(shape)
    long = pc.utf8_length(plain).to_numpy(zero_copy_only=False) > STEM
    stem = np.where(long, _buckets(string_hashes(pc.utf8_slice_codeunits(plain, 0, STEM))), -1)
    text = np.repeat(np.arange(len(texts)), np.diff(ends))
    n = np.bincount(text, minlength=len(texts))
    same = (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])
    again = np.bincount(text[1:][same], minlength=len(texts))
    own = np.unique(text * len(words) + codes)
    text, code = own // max(1, len(words)), own % max(1, len(words))
    return text, (word + mix64(form, 3))[code], _buckets(word)[code], _buckets(form)[code], stem[code], n, again


def _pairs(text: np.ndarray, value: np.ndarray, **kw):
    """Distinct (text, bucket) pairs as two columns; with return_counts also how often each occurs."""
    got = np.unique(text << BITS | value, **kw)
    key, rest = (got[0], got[1:]) if isinstance(got, tuple) else (got, ())
    return key >> BITS, key & (_SIZE - 1), *rest


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature id) pairs, distinct and sorted."""
    texts = [t or "" for t in texts]
    found = []
    for a, b in batches_by_bytes(texts, SLICE):
        if b > a + 1:
            text, _, *rest, n, again = _read(texts[a:b])
        else:  # a long text is read in parts, its distinct words are merged
            parts = [_read([p]) for p in text_parts(texts[a], SLICE)]
            key, first = np.unique(np.concatenate([p[1] for p in parts]), return_index=True)
            text, rest = np.zeros(len(key), np.int64), [np.concatenate([p[i] for p in parts])[first] for i in (2, 3, 4)]
            n, again = (sum(p[i] for p in parts) for i in (5, 6))
        found.append(_features(text, *rest, n, again) + np.array([[a], [0]]))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    return pairs[0], pairs[1]


def _features(text: np.ndarray, word: np.ndarray, shape: np.ndarray, stem: np.ndarray, n: np.ndarray, again: np.ndarray) -> np.ndarray:
    distinct, some = np.bincount(text, minlength=len(n)), np.maximum(n, 1)
    rows, cols = [text], [word]

    def add(t, code):
        rows.append(t)
        cols.append(_extra(code))

    t, s, count = _pairs(text, shape, return_counts=True)
    add(t, s * 8 + np.searchsorted(_STEPS, count / distinct[t]) + (1 << 40))
    for kind, steps, reached in ((2, _DISTINCT, lambda x: (distinct / some < x) & (n > 0)), (3, _AGAIN, lambda x: again / some >= x),
                                 (5, _FEW, lambda x: n < x)):
        for i, x in enumerate(steps):
            t = np.flatnonzero(reached(x))
            add(t, np.full(len(t), i + (kind << 40)))
    # surface forms of one word begin alike only once
    long = np.unique(np.stack([text, stem, word], axis=1)[stem >= 0], axis=0) if (stem >= 0).any() else np.empty((0, 3), np.int64)
    t, s, alike = _pairs(long[:, 0], long[:, 1], return_counts=True)
    for k in (1, 2, 3):
        add(t[alike >= k], s[alike >= k] * 4 + k + (4 << 40))
    return np.stack(_pairs(np.concatenate(rows), np.concatenate(cols)))


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _evidence(hits: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """Log-likelihood ratio of hits in n against the common rate."""
    rate, own = min(max(rate, 1e-9), 1 - 1e-9), np.clip(hits / n, 1e-12, 1 - 1e-12)
    return n * (own * np.log(own / rate) + (1 - own) * np.log((1 - own) / (1 - rate)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, steps: int = 200,
                l2: float = 2e-4, rate: float = 0.05, screen: float = 0.0):
    """(weights over the buckets, ordered thresholds). Full-batch Adam on the cumulative-link likelihood."""
    used, seen = np.unique(np.concatenate(rows) if rows else np.empty(0, np.int64), return_counts=True)
    sizes = np.array([len(r) for r in rows])
    doc = np.repeat(np.arange(len(rows)), sizes)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    col, told = np.searchsorted(used, flat), np.zeros(len(used))
    for cut in range(n_grades - 1):
        under = grades <= cut
        told = np.maximum(told, _evidence(np.bincount(col, weights=under[doc], minlength=len(used)), seen, under.mean()))
    used = used[(seen >= MIN_DOCS) & (told >= screen) | np.isin(used, _short_ids())]
    keep = np.isin(flat, used)
    doc, col = doc[keep], np.searchsorted(used, flat[keep])
    share = np.cumsum(np.bincount(grades, minlength=n_grades)[:-1] + 1.0) / (len(grades) + n_grades)
    first = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(len(used)), [first[0]], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(len(grades))
    for t in range(1, steps + 1):
        w, raw = p[: len(used)], p[len(used):]
        cuts = raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])
        z = np.bincount(doc, weights=w[col], minlength=len(grades))
        below = np.hstack([np.zeros((len(z), 1)), _sigmoid(cuts[None, :] - z[:, None]), np.ones((len(z), 1))])
        slope = below * (1 - below)
        chance = np.maximum(below[at, grades + 1] - below[at, grades], 1e-12)
        dz = (slope[at, grades + 1] - slope[at, grades]) / chance  # d(-log chance)/dz
        dcut = np.zeros((len(z), n_grades + 1))
        dcut[at, grades + 1] -= slope[at, grades + 1] / chance
        dcut[at, grades] += slope[at, grades] / chance
        dcut = dcut[:, 1:-1].sum(axis=0)
        draw = np.concatenate([[dcut.sum()], np.cumsum(dcut[::-1])[::-1][1:] * np.exp(raw[1:])])
        g = np.concatenate([np.bincount(col, weights=dz[doc], minlength=len(used)), draw]) / len(grades)
        g[: len(used)] += l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(_SIZE)
    weights[used] = p[: len(used)]
    raw = p[len(used):]
    return weights, raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])


def grades_of(labels: DataFrame) -> DataFrame:
    """doc_id, grade: 0 toxic, 1 low quality, 2 good; the lowest of repeated labels."""
    grade = (F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
             .when((F.col("quality") == 1) | (F.col("toxic") == 0), 2))
    return (labels.select(F.col("doc_id").alias("label_id"), grade.alias("grade")).dropna()
            .groupBy("label_id").agg(F.min("grade").alias("grade")))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """A model fitted on at most ``sample`` labelled documents (a narrow table of ids, so it may be broadcast)."""
    chosen = grades_of(labels).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    # one row a label, partially aggregated: a document that repeats its id enters the fit once
    own = (own.groupBy("label_id", "grade").agg(F.min(F.struct(F.crc32(F.coalesce("text", F.lit(""))), "text"))["text"].alias("text"))
           .select("grade", "text"))

    def featurise(batches):
        for batch in small(batches):
            text, found = features(batch.column(1).to_pylist())
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))],
                                  names=["grade", "x"])

    got = own.mapInArrow(released(featurise), "grade int, x array<int>").toArrow()
    grades = got.column("grade").to_numpy().astype(np.int64)
    rows = [np.asarray(x.values if hasattr(x, "values") else x, np.int64) for x in got.column("x")]
    if len(set(grades.tolist())) < 2:
        return None, int(grades[0]) if len(grades) else GRADES - 1
    # the sum does not depend on the order in which tasks end
    order = np.lexsort((grades, [int(r.sum()) for r in rows]))
    return fit_ordinal([rows[i] for i in order], grades[order], screen=SCREEN)


def score(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs plus expected_grade, tail_prob (chance of the best grade) and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, cuts = shared.value
        for batch in small(batches):
            if weights is None:
                n = batch.num_rows
                expected, tail = np.full(n, float(cuts)), np.full(n, float(cuts == GRADES - 1))
            else:
                text, found = features(batch.column(0).to_pylist())
                z = np.bincount(text, weights=weights[found], minlength=batch.num_rows)
                above = 1 - _sigmoid(cuts[None, :] - z[:, None])
                expected, tail = above.sum(axis=1), above[:, -1]
            yield pa.record_batch([*batch.columns[1:], pa.array(expected), pa.array(tail), pa.array(tail >= 0.5)],
                                  names=[*batch.schema.names[1:], "expected_grade", "tail_prob", "kept"])

    own = docs.select(F.col("text").alias("_text"), *keep)
    schema = ", ".join(f"`{c}` {t}" for c, t in own.drop("_text").dtypes) + ", expected_grade double, tail_prob double, kept boolean"
    return own.mapInArrow(released(run), schema)


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, expected_grade, tail_prob, kept of every document."""
    return score(docs, fit(docs, labels, sample), ["doc_id"])
