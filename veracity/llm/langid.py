"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in every task and sums them in Spark; the
log-probability matrix (buckets x languages, float32; 2^15 buckets, so 128 KB a
language) is broadcast. Scoring treats a batch of texts as one sparse block:
n-gram indices gather rows of the matrix and are summed per document in numpy.

Texts are lower-cased; ASCII bytes that are not letters become one space class.
Long texts are scored in pieces whose sums are added, so memory stays bounded.

Defined cases: null text or text without a letter gives ``und`` and score 0;
rows with null lang are not learned from but are scored; a null doc_id counts as
remainder 0; without any learned language everything is ``und``; ties go to the
language that sorts first; repeated rows count as often as they occur; further
columns pass through ``predict`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.shared import batches_by_bytes, id_remainder, released, small

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
# spread of a language's own documents: classes of bytes, histogram step, quantile, distances, documents a class needs
LENGTHS = np.array([32, 128, 512, 2048, 8192])
BIN, LOW, FAR, ENOUGH = 0.02, 0.1, 4.0, 200
#: Natural units an n-gram that a text may always lie below its language's median; letters among its visible bytes.
SLACK, LETTERS = 2.0, 0.25
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_PAD = b" " * max(GRAMS)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of the texts with padding between them, and where each text starts (last: the end)."""
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.cumsum([0] + [len(p) + len(_PAD) for p in parts])
    return _FOLD[np.frombuffer(_PAD.join(parts) + _PAD, np.uint8)], bounds


def _grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the bucket of the n-gram that starts at each position (positions at the very end are left out)."""
    wide = codes.astype(np.uint32)
    h = np.zeros(len(wide), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        h = h[: len(wide) - n + 1] * np.uint32(0x01000193) ^ wide[n - 1:]
        if n in GRAMS:
            g = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            yield (g >> np.uint32(17)).astype(np.int64)


def _pieces(text: str, most: int = 1_000_000) -> list[str]:
    return [text[i: i + most] for i in range(0, len(text), most)] or [""]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in small(batches):
        langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
        for lang in set(langs.tolist()):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            docs[lang] = docs.get(lang, 0) + len(own)
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for a, b in batches_by_bytes(own, 500_000):
                for part in ([p] for p in _pieces(own[a])) if b == a + 1 else [own[a:b]]:
                    for g in _grams(_codes(part)[0]):
                        total += np.bincount(g, minlength=BUCKETS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()),
                               pa.array(np.append(total[at], docs[lang]), pa.int64())], names=["lang", "bucket", "n"])


def fit(train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities buckets x languages, log priors) from the columns lang and text.

    Bucket -1 holds the number of documents. The table collected has at most
    (2^15 + 1) rows a language whatever the corpus size.
    """
    sums = (train.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
            .mapInArrow(released(_counter), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .toArrow())
    lang, bucket, n = (sums.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    names = sorted(set(lang.tolist()))
    counts, priors = np.zeros((BUCKETS, len(names))), np.zeros(len(names))
    for j, name in enumerate(names):
        own = lang == name
        b, c = bucket[own], n[own].astype(float)
        counts[b[b >= 0], j] = c[b >= 0]
        priors[j] = c[b < 0].sum()
    logp = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS)) if names else counts
    return names, logp.astype(np.float32), np.log(priors / priors.sum()) if names else priors


def _sums(texts: list[str], logp: np.ndarray) -> np.ndarray:
    codes, bounds = _codes(texts)
    out = np.zeros((len(texts), logp.shape[1]))
    for g in _grams(codes):
        # a position before the padding of its text: the n-gram cannot reach the next text
        starts = np.minimum(bounds[:-1], len(g) - 1)
        out += np.add.reduceat(logp[g], starts, axis=0, dtype=np.float64)
    return out


def classify(texts: list[str | None], model) -> tuple[list[str], np.ndarray]:
    """(language or ``und``, posterior of that language) of each text."""
    return rate(texts, model)[:2]


def letter_share(text: str | None) -> float:
    """Share of letters (bytes from 0x80 on count as such) among the bytes that are no white space."""
    codes = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    return float((_FOLD[codes] != 32).sum() / max(1, (codes > 32).sum()))


def rate(texts: list[str | None], model) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(language or ``und``, posterior, mean log-probability an n-gram under that language, bytes) of each text."""
    names, logp, priors = model
    known = [i for i, t in enumerate(texts) if t and names and _LETTER.search(t)]
    best, score, mean, size = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), -np.inf), np.zeros(len(texts))
    own = [texts[i] for i in known]
    for a, b in batches_by_bytes(own, 300_000):
        if b == a + 1:
            total = sum(_sums([p], logp) for p in _pieces(own[a]))
        else:
            total = _sums(own[a:b], logp)
        length = np.array([len(t.encode("utf-8", "surrogatepass")) for t in own[a:b]])
        chance = total + priors
        chance -= chance.max(axis=1, keepdims=True)
        chance = np.exp(chance)
        chance /= chance.sum(axis=1, keepdims=True)
        for row, i in enumerate(known[a:b]):
            j = int(chance[row].argmax())
            best[i], score[i], size[i] = names[j], chance[row, j], length[row]
            mean[i] = total[row, j] / (len(GRAMS) * length[row])
    return best, score, mean, size


def _length_class(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, size, side="right")


def spread(train: DataFrame, model) -> dict[tuple[str, int], float]:
    """The least mean log-probability of each (language, class of length) that still counts as that language.

    Over the training documents of the language: the median less ``FAR`` times its distance to the ``LOW`` quantile, or less
    ``SLACK`` where that is more, from a histogram in steps of ``BIN`` (its size does not depend on the corpus). Classes with fewer than ``ENOUGH``
    documents take the language's own histogram over all lengths.
    """
    shared = train.sparkSession.sparkContext.broadcast(model)
    n_bins = int(20 / BIN)

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in small(batches):
            langs = batch.column(0).to_pylist()
            best, _, mean, size = rate(batch.column(1).to_pylist(), shared.value)
            own = np.array([a == b for a, b in zip(langs, best)], bool)
            bins = np.clip(-np.where(own, mean, 0) / BIN, 0, n_bins - 1).astype(np.int64)
            cell = _length_class(size) * n_bins + bins
            for lang in {x for x, o in zip(langs, own) if o}:
                mine = own & np.array([x == lang for x in langs])
                held[lang] = held.get(lang, 0) + np.bincount(cell[mine], minlength=(len(LENGTHS) + 1) * n_bins)
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                  names=["lang", "cell", "n"])

    sums = (train.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
            .mapInArrow(released(run), "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow())
    lang, cell, n = (sums.column(c).to_numpy() for c in ("lang", "cell", "n"))
    out = {}
    for name in model[0]:
        counts = np.zeros((len(LENGTHS) + 1) * n_bins)
        counts[cell[lang == name]] = n[lang == name]
        counts = counts.reshape(-1, n_bins)
        for k, own in enumerate(counts):
            own = own if own.sum() >= ENOUGH else counts.sum(axis=0)
            upto = np.cumsum(own)
            if not upto[-1]:
                continue
            middle, low = (np.searchsorted(upto, q * upto[-1]) for q in (0.5, 1 - LOW))
            out[name, k] = -BIN * (middle + 1) - max(SLACK, FAR * BIN * (low - middle))
    return out


def predict(docs: DataFrame, model, keep: list[str], least: dict[tuple[str, int], float] | None = None) -> DataFrame:
    """Columns ``keep`` of docs plus lang_pred and score; text is read, lang, source and doc_id are not. With ``least``
    (of ``spread``) also known: whether the text lies within the spread of the language predicted."""
    shared = docs.sparkSession.sparkContext.broadcast((model, least))

    def run(batches):
        model, least = shared.value
        for batch in small(batches):
            texts = batch.column(0).to_pylist()
            best, score, mean, size = rate(texts, model)
            more = [] if least is None else [pa.array(
                [bool(m >= least.get((b, int(k)), np.inf)) and letter_share(t) >= LETTERS
                 for t, b, m, k in zip(texts, best, mean, _length_class(size))], pa.bool_())]
            yield pa.record_batch([*batch.columns[1:], pa.array(best, pa.string()), pa.array(score), *more],
                                  names=[*batch.schema.names[1:], "lang_pred", "score", *["known"] * len(more)])

    own = docs.select(F.col("text").alias("_text"), *keep)
    schema = ", ".join(f"`{c}` {t}" for c, t in own.drop("_text").dtypes) + ", lang_pred string, score double"
    return own.mapInArrow(released(run), schema + (", known boolean" if least is not None else ""))


def held_out(doc_id):
    return id_remainder(doc_id, 3) == 1


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; learned from the documents that are not held out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    own = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(own, model, ["doc_id", "held_out"])
