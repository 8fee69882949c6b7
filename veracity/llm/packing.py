"""Packing token sequences: order-preserving dynamic programming over window cuts.

Documents keep their order inside an input split; their ids form one stream
that is cut into windows of at most 2048 ids. A cut may fall after a document
(free), after a sentence (``SENTENCE``), or inside one (``INSIDE``); a window
pays its padding, one unit an id. With f(j) the least cost of a stream cut at j,

    f(j) = cut(j) + (2048 - j) + min over i in [j - 2048, j) of (f(i) + i),

and a monotone queue holds the minimum of the sliding range. Cuts inside a
sentence are candidates only where a full window after another candidate would
end, so the number of steps follows the number of sentences. Windows whose
length is a power of two need no padding: the stream's last window is split
into such lengths.

Scale: no shuffle. Each task packs its split in blocks; a block commits all
windows but the last, whose ids open the next block, so memory stays bounded
for any split and any document. Only the last windows of a task see its end.

Tokenising: the distinct words of a slice of texts are looked up in a bounded
cache that a task keeps; new words go through the tokenizer's own model, and texts with
characters outside the range where words are independent (or with the
vocabulary's special strings) go through the tokenizer whole.

Defined cases: null text counts as empty; an empty document is one piece of one
id (the end id); repeated rows are packed one by one; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from veracity.llm.shared import batches_by_bytes, released, small, split_words, text_parts

LENGTH, END, SENTENCE, INSIDE = 2048, 1, 8.0, 48.0
BLOCK = 400_000
#: Characters that are tokenised at a time.
SLICE = 1_000_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long")

# Fixed: how the vocabulary file splits text (after NFC, lower case and white space).
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Characters for which words between white space are independent and lower case is one by one.
_PLAIN = re.compile(r"[\x09-\x0D\x20-\x7E\xA0-įı-ɏ]*\Z")


class WordTokenizer(dict):
    """Ids of texts for a vocabulary of the kind that ends words. The dictionary itself is the cache of words, each with
    its ids as unsigned 32-bit bytes; when it holds ``most`` words they become the older half, and the half before them goes."""

    def __init__(self, path: str, most: int = 200_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.older: dict[str, bytes] = {}
        self.most = most
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(keep)]
        # the byte alphabet of byte-level vocabularies: printable bytes stand for themselves
        self.bytes = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.sentence_ids = np.array([i for i in (self.full.token_to_id(c + "</w>") for c in ".!?…。") if i is not None] or [-1])

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def __missing__(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            pieces = (word,) if word.isalpha() else (word[:-1], word[-1]) if word[:-1].isalpha() else _PIECE.findall(word)
            if len(pieces) == 1 and pieces[0] == word:
                mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes)
                got = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            else:
                got = b"".join([self[p] for p in pieces])
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts of independent words: every distinct word is looked up once."""
        words, at, ends_of = split_words([t.lower() for t in texts])
        known = list(map(self.__getitem__, words.to_numpy(zero_copy_only=False).tolist()))
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), np.uint32)
        count, ends = size[at], np.cumsum(size)
        stop = np.append(0, np.cumsum(count))
        ids = flat[np.arange(stop[-1]) + np.repeat((ends - size)[at] - stop[:-1], count)]
        return np.split(ids, stop[ends_of[1:-1]])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        plain = [i for i, t in enumerate(texts) if "<|" not in t and _PLAIN.match(t)]
        out: list = [None] * len(texts)
        for a, b in batches_by_bytes([texts[i] for i in plain], SLICE):
            own = [texts[i] for i in plain[a:b]]
            if b == a + 1:
                out[plain[a]] = np.concatenate([self._plain([p])[0] for p in text_parts(own[0], SLICE)])
            else:
                for i, ids in zip(plain[a:b], self._plain(own)):
                    out[i] = ids
        return [np.array(self.full.encode(t, add_special_tokens=False).ids, np.uint32) if o is None else o
                for t, o in zip(texts, out)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


_held: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """One tokenizer, and so one cache of words, for each worker process."""
    if path not in _held:
        _held[path] = WordTokenizer(path)
    return _held[path]


def plan_cuts(points: np.ndarray, costs: np.ndarray, total: int, length: int = LENGTH, inside: float = INSIDE) -> list[int]:
    """Ascending ends of windows over the ids 0..total: the cheapest cuts at ``points`` (ascending, below total, with
    their costs) and, at ``inside``, one full window after any candidate. The last end is total; its window's padding is free."""
    place, cost = points.tolist(), costs.tolist()
    place.append(total)
    cost.append(0.0)
    # a full window after j ends inside a sentence, and no cheaper cut lies shortly before its end
    near = int(inside - SENTENCE)
    best: list[float] = [0.0]  # f(i) + i of each candidate
    at: list[int] = [0]
    back: list[int] = [-1]
    queue: deque[int] = deque([0])  # candidates in the sliding range whose f(i) + i ascends
    forced: deque[int] = deque([length])
    k, n, ahead = 0, len(place), 0
    while k < n:
        j, extra = place[k], cost[k]
        if forced and forced[0] < j:
            j, extra = forced.popleft(), inside
        else:
            k += 1
            if forced and forced[0] == j:
                forced.popleft()
        while at[queue[0]] < j - length:
            queue.popleft()
        m = len(at)
        if j < total:
            i = queue[0]
            value = best[i] + extra + length
        else:  # the last window pays no padding: the least f itself
            i = min(range(bisect_left(at, j - length), m), key=lambda x: best[x] - at[x])
            value = best[i] - at[i] + j
        best.append(value)
        at.append(j)
        back.append(i)
        while queue and best[queue[-1]] >= value:
            queue.pop()
        queue.append(m)
        end = j + length
        while ahead < n and place[ahead] <= end:
            ahead += 1
        if not ahead or place[ahead - 1] < end - near:
            forced.append(end)
    out, i = [], len(at) - 1
    while i > 0:
        out.append(at[i])
        i = back[i]
    return out[::-1]


def _packer(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = tokenizer_of(path)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        docs: list[list] = []  # [doc_id, ids, start of what is left, tokens of the document]
        held = 0

        def commit(last: bool):
            nonlocal docs, held, sequence
            flat = np.concatenate([d[1] for d in docs])
            ends = np.cumsum([len(d[1]) for d in docs])
            stops = np.flatnonzero(np.isin(flat, make.sentence_ids)) + 1
            # a sentence that ends its document has the end id behind it: the document's own end is free
            cost = np.full(len(flat) + 1, np.inf)
            cost[stops] = SENTENCE
            cost[ends] = 0.0
            points = np.flatnonzero(np.isfinite(cost[:-1]))
            points = points[points > 0]
            cuts = plan_cuts(points, cost[points], len(flat), length)
            if not last:
                cuts = cuts[:-1]
            else:  # the open window: lengths that need no padding
                left = len(flat) - (cuts[-2] if len(cuts) > 1 else 0)
                cuts = cuts[:-1]
                for bit in range(length.bit_length() - 1, -1, -1):
                    if left >> bit & 1:
                        cuts.append((cuts[-1] if cuts else 0) + (1 << bit))
            rows, at, d, inside = [], 0, 0, 0
            for stop in cuts:
                first = at
                while at < stop:
                    doc = docs[d]
                    take = min(stop - at, len(doc[1]) - inside)
                    ids = np.ascontiguousarray(doc[1][inside: inside + take], dtype="<u4")
                    rows.append((doc[0], doc[2] + inside, take, zlib.crc32(ids), doc[3], sequence, at - first, stop - first))
                    at += take
                    inside += take
                    if inside == len(doc[1]):
                        d, inside = d + 1, 0
                sequence += 1
            docs = docs[d:]
            if inside:
                docs[0] = [docs[0][0], docs[0][1][inside:], docs[0][2] + inside, docs[0][3]]
            held = sum(len(x[1]) for x in docs)
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            columns = zip(*rows) if rows else [[] for _ in names]
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in small(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), make.encode_all(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype(np.uint32)
                done = 0
                while len(ids) - done > 2 * BLOCK:  # a very long document enters in parts
                    docs.append([doc_id, ids[done: done + BLOCK], done, len(ids)])
                    done += BLOCK
                    held += BLOCK
                    yield commit(False)
                docs.append([doc_id, ids[done:], done, len(ids)])
                held += len(ids) - done
                if held >= BLOCK:
                    yield commit(False)
        if held:
            yield commit(True)
        make.forget()  # workers live on: the words go when the task ends
    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    ``tokenizer`` is the path of a vocabulary file that every executor can open. Cuts are chosen by dynamic
    programming at document and sentence boundaries; every id of every document lies in exactly one piece.
    """
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(released(_packer(tokenizer, length, end_id)), SCHEMA)
