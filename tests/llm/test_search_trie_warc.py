"""Length-stratified search, the prefix trie and the archives against brute force, and their defined edge cases."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from veracity.llm import prefix_trie, strata_search, warc

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- 11 search
def ranked(docs, items, k=50):
    lists = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    lists = [(d, c) for d, c in lists if c]
    n_docs, n_terms = len(lists), sum(sum(c.values()) for _, c in lists)
    df = Counter(t for _, c in lists for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = {}
    for i, terms in asked.items():
        scored = []
        for d, c in lists:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if c[t])
            if s > 0:
                scored.append((-s, d is None, d))
        out[i] = [(d, -s) for s, _, d in sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return {i: v for i, v in out.items() if v}


def found(df):
    out = defaultdict(list)
    for r in sorted(rows(df), key=lambda r: r["rank"]):
        assert r["rank"] == len(out[r["item_id"]]) + 1
        out[r["item_id"]].append((r["doc_id"], r["score"]))
    return dict(out)


@pytest.mark.parametrize("shard, block", [(16_384, 16 << 20), (7, 300)])
def test_search_equals_brute_force(spark, shard, block):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["Ünïcode", "ÀB", "x9", "THE"]
    docs = [(i, " ".join(rng.choices(words, weights=range(1, 45), k=rng.choice([1, 3, 9, 30, 200])))) for i in range(150)]
    docs += [(200 + i, "the the w1, w2; w3") for i in range(60)]  # ties, and a third of the rows in one stratum
    docs += [(7, docs[7][1]), (None, "the W1"), (None, "w3"), (300, None), (301, ""), (302, " .,;\n"), (303, "w5 " * 4000)]
    items = [(1, "The w1 w1 w40"), (2, "ünïcode Ünïcode àb"), (3, "zzz"), (4, None), (5, ""), (None, "w3 x9"), (1, "w2"), (6, "w1" * 3),
             *[(10 + i, " ".join(rng.choices(words, k=6))) for i in range(8)]]
    docs_df = spark.createDataFrame([(d, t, 1, "s", 2) for d, t in docs], "doc_id long, text string, rank int, term string, n int")
    items_df = spark.createDataFrame([(i, t, 3, 4) for i, t in items], "item_id long, text string, doc_id int, score int")
    got = found(strata_search.search(docs_df.repartition(3), items_df, k=12, block=block, shard=shard))
    assert got == ranked(docs, items, 12)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(strata_search.search(docs.limit(0), items)) == []
    assert rows(strata_search.search(docs, items.limit(0))) == []
    assert rows(strata_search.search(docs.withColumn("text", docs.text.substr(1, 0)), items)) == []


def test_term_lists_in_pieces(monkeypatch):
    text = ("Ab, cd" * 30 + "x" * 100 + " É9-" * 20).encode()
    whole = [w for part in strata_search.term_lists(text) for w in part]
    monkeypatch.setattr(strata_search, "_PIECE", 16)
    assert [w for part in strata_search.term_lists(text) for w in part] == whole
    assert [w.decode() for w in whole] == TERM.findall(text.decode().translate(LOWER))


def test_visits_end_early():
    """Strata of long documents are not visited once k short ones beat their bound."""
    m = np.repeat([50, 500, 5000], 40)
    index = strata_search.Strata(m, np.arange(120), np.zeros(120, np.int64), np.ones(120, np.int64), 1)
    index.rank = np.arange(120)
    seen = []
    index._spans, plain = lambda s, t: (seen.append(len(s)), plain(s, t))[1], index._spans
    docs, _ = index.search(np.array([0]), np.array([1000]), 5)
    assert docs.tolist() == [0, 1, 2, 3, 4]
    bound = index.bounds(np.array([0]), np.array([1000]))
    assert (np.diff(bound) < 0).all() and bound[0] == 1000 * (10**9 // (1000 + 20 * 50))


# ---------------------------------------------------------------- 12 trie
def nodes_of(data):
    convs = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            tid = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tid, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        gain = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += gain
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(spark, data, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "conv_id long, turn long, role string, text string, low string, n int")
    out = prefix_trie.trie(df.repartition(5), **kw)
    assert out.columns == COLUMNS
    return Counter(tuple(r) for r in out.collect())


def talks():
    rng = random.Random(8)
    data = []
    for c in range(160):
        start = rng.choice([["s"], ["s", "t"], ["u"], ["s", "t", "q", "r", "s", "t"]])
        said = start + [rng.choice("abc") for _ in range(rng.choice([0, 0, 1, 2, 5]))]
        for i, x in enumerate(said):
            data.append((c, i, "user" if i % 2 else "assistant", f"text {x} more"))
    for c in range(400, 480):  # exact copies
        data += [(c, 0, "user", "hot start"), (c, 1, "assistant", "hot answer of four")]
    data += [(600, i, "user", f"line {i % 3}") for i in range(70)]  # a long conversation, and ones that share most of it
    data += [(601, i, "user", f"line {i % 3}") for i in range(70)] + [(620, i, "user", f"line {i % 3}") for i in range(65)]
    data += [(700, None, None, None), (700, 0, "user", "a"), (700, 0, "user", "a"), (701, 0, "user", ""), (701, None, "", " \t"),
             (None, 0, "user", "lost"), (-5, 0, "user", "below zero"), (-5, 1, None, "x" * 5000), (900, 3, "ab", "c"), (920, 3, "a", "bc")]
    return data


@pytest.mark.parametrize("chunk, most", [(64, 4096), (4, 3), (2, 1), (8, 40)])
def test_trie_equals_brute_force(spark, chunk, most):
    data = talks()
    got, want = trie_of(spark, data, chunk=chunk, most=most), nodes_of(data)
    assert got == want


def test_trie_of_few_rows(spark):
    assert trie_of(spark, []) == Counter()
    for data in ([(1, 0, "user", "one")], [(0, 0, "user", "one"), (19, 0, "user", "two words")], [(23, None, None, None)]):
        assert trie_of(spark, data) == nodes_of(data)


def test_digest_streams_over_spans(spark):
    ids = [*range(-700, 3000), *range(10**9, 10**9 + 50)]
    df = spark.createDataFrame([("a", i) for i in ids] + [("b", 4)], "node string, conv_id long").repartition(7)
    got = {r["node"]: r["sha"] for r in prefix_trie.end_digests(df).collect()}
    assert got == {"a": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "b": hashlib.sha256(b"4").hexdigest()}


# ---------------------------------------------------------------- 13 archives
def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(pages, least=0):
    out, seen = [], {}
    for page, url, html in sorted(pages, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        payload = (html or "").encode()
        key = sha(payload)
        if len(payload) < least or key not in seen:
            seen.setdefault(key, page)
            out.append((page, len(payload), key, "response", None))
        else:
            out.append((page, len(payload), key, "revisit", seen[key]))
    return Counter(out)


PAGES = ([(i, f"http://h/{i}", f"<p>page {i % 5}</p>\r\n\r\nWARC/1.1\r\n\r\n") for i in range(10, 40)]
         + [(100 + i, "http://hot/", "<p>hot</p>") for i in range(60)]
         + [(3, None, None), (4, "u\r\nX-Page-Id: 9", ""), (4, "u\r\nX-Page-Id: 9", ""), (None, "n", "<p>hot</p>"), (None, None, "only null"),
            (5, "é", "ü" * 70_000), (5, "é", "ü" * 70_000), (6, "a", "small"), (2, "b", "small")])


@pytest.mark.parametrize("least", [0, 6])
def test_archives_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame([(*p, "x", 7, "response") for p in PAGES],
                               "page_id long, url string, html string, payload string, payload_bytes int, record_type string")
    folder = f"{tmp_path}/out"
    warc.write(warc.deduplicate(df.repartition(4), least), folder)
    records = warc.read(spark, folder, payloads=True)
    got = Counter(tuple(r) for r in warc.resolve(records).collect())
    assert got == expected(PAGES, least)
    all_rows = rows(records)
    assert len({r["record_id"] for r in all_rows}) == len(all_rows) or least
    texts = {(h or "").encode() for _, _, h in PAGES}
    assert {bytes(r["payload"]) for r in all_rows if r["record_type"] == "response"} == texts
    assert all(r["payload"] is None and r["refers_to_id"] for r in all_rows if r["record_type"] == "revisit")


def test_archives_follow_the_format(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/", "hi"), (2, "http://b/", "hi")], "page_id long, url string, html string")
    warc.write(warc.deduplicate(df.coalesce(1)), f"{tmp_path}/out")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "out").glob("*.gz")))
    for record in data.split(b"WARC/1.1\r\n")[1:]:
        head, block = record.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
        assert block.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(block) - 4
        assert fields["WARC-Payload-Digest"] == "sha1:" + sha(b"hi")
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To-Target-URI"] == "http://a/" and fields["WARC-Target-URI"] == "http://b/"
            assert fields["WARC-Profile"] == warc.PROFILE
        else:
            assert block.endswith(b"\r\n\r\nhi\r\n\r\n") and b"Content-Length: 2\r\n" in block


def test_empty_and_damaged_archives(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(warc.deduplicate(none), f"{tmp_path}/none")
    assert rows(warc.resolve(warc.read(spark, f"{tmp_path}/none"))) == []
    one = spark.createDataFrame([(1, "u", "text " * 400), (2, "u", "other")], "page_id long, url string, html string").coalesce(1)
    warc.write(warc.deduplicate(one), f"{tmp_path}/one")
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "one").glob("*.gz"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "cut.gz").write_bytes(gzip.compress(raw[:-50]))
    (tmp_path / "bad" / "two.gz").write_bytes(gzip.compress(raw[:700]) + gzip.compress(raw[700:]))
    (tmp_path / "bad" / "torn.gz").write_bytes(gzip.compress(raw)[:40])
    (tmp_path / "bad" / "plain.gz").write_bytes(raw.replace(b"other", b"otter"))
    got = defaultdict(Counter)
    for r in rows(warc.read(spark, f"{tmp_path}/bad")):
        got[r["file"].rsplit("/", 1)[-1]][r["record_type"]] += 1
    assert got["two.gz"] == {"response": 2}
    assert got["cut.gz"] == {"response": 1, "damaged": 1}
    assert got["torn.gz"]["damaged"] == 1
    assert got["plain.gz"] == {"response": 1, "damaged": 1}


# ---------------------------------------------------------------- 6 gradients of the language model
def test_gradients_equal_finite_differences(monkeypatch):
    from veracity.llm import gru_lm as G
    monkeypatch.setattr(G, "_F", np.float64)
    rng = np.random.default_rng(2)
    n = G.CLASSES * G.MEMBERS
    p = {k: v.astype(np.float64) for k, v in G.start_parameters(rng.random(G.CLASSES + 1) + 1, rng.random((G.CLASSES, G.MEMBERS)) + 1).items()}
    for k in ("wc", "wm"):
        p[k] = rng.normal(0, 0.3, p[k].shape)
    ids = np.append(rng.integers(0, n + 1, 60), rng.integers(0, 40, 60))
    offsets = np.array([0, 25, 31, 90, 120])

    def loss(p, grads=None):
        total = 0.0
        for previous, token, fresh, at in G.windows(ids, offsets, 4, 200):
            hs, saved, _ = G.forward(p, previous, fresh, np.zeros((token.shape[1], G.HIDDEN)))
            real = at.reshape(-1) >= 0
            flat = hs.reshape(-1, G.HIDDEN)
            dhs = np.zeros_like(flat)
            logp, d = G.output(p, flat[real], token.reshape(-1)[real], grads)
            total -= logp.sum()
            if grads is not None:
                dhs[real] = d
                G.backward(p, grads, previous, saved, dhs.reshape(hs.shape))
        return total

    grads = {k: np.zeros_like(v) for k, v in p.items()}
    loss(p, grads)
    for k in p:
        flat, g = p[k].reshape(-1), grads[k].reshape(-1)
        for i in [*rng.integers(0, len(flat), 4), int(np.abs(g).argmax())]:
            keep, step = flat[i], 1e-5
            flat[i] = keep + step
            up = loss(p)
            flat[i] = keep - step
            down = loss(p)
            flat[i] = keep
            assert (up - down) / (2 * step) == pytest.approx(g[i], rel=1e-4, abs=1e-6), k


def test_scoring_shares_outputs_between_windows(monkeypatch):
    """Blocks of output, and states without what training keeps, give the same likelihoods."""
    from veracity.llm import gru_lm as G
    rng = np.random.default_rng(6)
    n = G.CLASSES * G.MEMBERS
    p = G.start_parameters(rng.random(G.CLASSES + 1) + 1, rng.random((G.CLASSES, G.MEMBERS)) + 1)
    p = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in p.items()}
    ids, offsets = rng.integers(0, n + 1, 700), np.array([0, 500, 501, 600, 700])
    previous, token, fresh, _ = next(G.windows(ids, offsets, 3, 40))
    h = np.zeros((token.shape[1], G.HIDDEN), np.float32)
    assert (G.forward(p, previous, fresh, h)[0] == G.forward(p, previous, fresh, h, save=False)[0]).all()
    calls, whole = [], G.output
    monkeypatch.setattr(G, "output", lambda *a: calls.append(len(a[2])) or whole(*a))
    one = G.log_likelihood(p, ids, offsets)
    assert calls == [700]  # one output, though the longest document has many windows
    monkeypatch.setattr(G, "BLOCK", 1)
    assert np.allclose(one, G.log_likelihood(p, ids, offsets), rtol=1e-5) and len(calls) > 10
