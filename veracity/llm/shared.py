"""Small helpers that several operators use: tables, lineage cuts, word hashes."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise a narrow table once in the shared checkpoint folder, so that lost executors only reread it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo; a null id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def n_words(text: Column) -> Column:
    """Number of maximal runs of bytes other than space and \\x09-\\x0D; null: 0. JVM only."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]+", "")).cast("long")


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over an unsigned array."""
    x = x + _U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


# Word hashes: a polynomial over a random byte alphabet, modulo 2^64, with A-Z folded to a-z.
_BASE = 0x5851F42D4C957F2D | 1
_CHUNK = 1 << 20
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_ALPHA = mix64(np.arange(256, dtype=_U), 17) | _U(1)
_ALPHA[65:91] = _ALPHA[97:123]
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(n, base, _U)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, 64-bit hash) of each word in a byte buffer; cut into chunks at separators."""
    starts_all, hashes_all, at = [], [], 0
    while at < len(buf):
        end = min(at + _CHUNK, len(buf))
        if end < len(buf):
            back = np.flatnonzero(_SEP[buf[at:end]])
            if len(back):
                end = at + int(back[-1]) + 1
            else:  # one word longer than a chunk
                ahead = end
                while ahead < len(buf) and not _SEP[buf[ahead]]:
                    ahead += 1
                end = ahead
        part = buf[at:end]
        word = ~_SEP[part]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(starts):
            up, down = _power_table(max(_CHUNK, len(part)) + 1)
            sums = np.zeros(len(part) + 1, _U)
            np.cumsum(_ALPHA[part] * up[: len(part)], out=sums[1:])
            h = (sums[ends] - sums[starts]) * down[starts]
            hashes_all.append(mix64(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93)))
            starts_all.append(starts + at)
        at = end
    if not starts_all:
        return np.empty(0, np.int64), np.empty(0, _U)
    return np.concatenate(starts_all), np.concatenate(hashes_all)


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string of an array without nulls, with A-Z folded."""
    strings = strings.cast(pa.large_string())
    at = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset: strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[at[0]: at[-1]] if len(strings) else np.empty(0, np.uint8)
    at = at - at[:1]
    up, down = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_ALPHA[data] * up[: len(data)], out=sums[1:])
    h = (sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]]
    return mix64(h + np.diff(at).astype(_U) * _U(0xD6E8FEB86659FD93), 1)


def split_words(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words at white space, code of each word in turn, the words' ends by text: text i has words ends[i] to ends[i + 1])."""
    words = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    coded = words.flatten().dictionary_encode()
    codes, ends = coded.indices.to_numpy(), words.offsets.to_numpy()
    blank = pc.index(coded.dictionary, "").as_py()  # white space at an edge of a text leaves an empty word
    if blank >= 0:
        real = codes != blank
        codes, ends = codes[real], np.append(0, np.cumsum(real))[ends]
    return coded.dictionary, codes, ends


def text_parts(text: str, most: int) -> list[str]:
    """A long text in parts of about ``most`` characters that end before a space."""
    out, at = [], 0
    while len(text) - at > most and (stop := text.find(" ", at + most)) >= 0:
        out.append(text[at:stop])
        at = stop
    return [*out, text[at:]]


def released(run):
    """A task's function over Arrow batches that hands its freed memory back to the system at the end: workers serve
    later stages too."""
    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return task


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; fewer words: the whole sequence as one; none: empty."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    starts, words = word_hashes(np.frombuffer(b" ".join(parts) + b" ", np.uint8))
    cuts = np.searchsorted(starts, bounds)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        w = words[a:b]
        if not len(w):
            out.append(np.empty(0, _U))
            continue
        size = min(k, len(w))
        n = len(w) - size + 1
        s = np.full(n, size, _U)
        for j in range(size):
            s = s * _U(0x9FB21C651E98DF25) + w[j: j + n]
        out.append(np.unique(mix64(s, 5)))
    return out


def small(batches, rows: int = 500):
    """Arrow batches in slices of so many rows: texts become Python strings a slice at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def batches_by_bytes(texts: list[str | None], most: int):
    """Consecutive index ranges of texts that hold about ``most`` characters each (a longer text stands alone)."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > most:
            yield first, i
            first, held = i, 0
        held += n + 1
    if first < len(texts):
        yield first, len(texts)
