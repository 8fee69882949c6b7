"""The training-data operators against brute force, invariants and held-out accuracy, and their defined edge cases."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from veracity.llm import (components, gru_lm, html_extract, langid, mixing, multi_index, packing, quality, sharding, shared,
                          superminhash, topk)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, bucket string, n int, score string"


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in each column, empty and blank texts, repeated rows and ids, a long text, clashing extra columns."""
    long = " ".join(f"word{i % 977} the of" for i in range(30_000))
    data = [(1, "The cat sat on the mat.", "en", "a"), (1, "The cat sat on the mat.", "en", "a"), (2, None, "en", None),
            (3, "", None, "b"), (4, " \t\n", "en", "b"), (None, "no id at all here", "en", "a"), (5, long, "en", None),
            (6, "123 456 !!!", "en", ""), (7, "Les chats sont sur la table rouge", "fr", "c"), (1, "another text entirely", None, "c")]
    return spark.createDataFrame([(*r, 0, 9, "x", 3, "y") for r in data], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


# ---------------------------------------------------------------- helpers
def test_word_hashes_across_chunks(monkeypatch):
    text = "Alpha beta\tGAMMA\n" * 50 + "x" * 300 + " end"
    whole = shared.word_hashes(np.frombuffer(text.encode(), np.uint8))
    monkeypatch.setattr(shared, "_CHUNK", 64)
    parts = shared.word_hashes(np.frombuffer(text.encode(), np.uint8))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert len(set(whole[1].tolist())) == 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, x) for x in range(101, 130)] + [(5, 5), (200, 300)]
    got = {r["node"]: r["component"] for r in rows(components.components(spark.createDataFrame(edges, "u long, v long")))}
    want = groups({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items()}
    assert rows(components.components(spark.createDataFrame([], "u long, v long"))) == []


# ---------------------------------------------------------------- 1 top-k
def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 12))
    x[50:80] = x[3]
    data = [(i, [float(v) for v in x[i]]) for i in range(700)]
    data += [(700, None), (800, [1.0, None] + [0.0] * 10), (900, [float("nan")] * 12), (701, []), (1000, [1.0, 2.0]), (None, [1.0] * 12),
             (200, [float(v) for v in x[200]])]
    got = rows(topk.search(spark.createDataFrame(data, "vec_id long, embedding array<double>")))
    ok = [(i, [math.floor(1024 * v) for v in e]) for i, e in data
          if i is not None and e and all(v is not None and math.isfinite(v) for v in e)]
    for q in {i for i, _ in ok if i % 100 == 0}:
        mine = next(e for i, e in ok if i == q)
        want = sorted((-sum(a * b for a, b in zip(mine, e)), i) for i, e in ok if i != q and len(e) == len(mine))[:10]
        found = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q and r["rank"] <= 10)
        if q != 200:
            assert [(s, i) for _, s, i in found] == want
    assert rows(topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"))) == []


# ---------------------------------------------------------------- 2 packing
def test_packing_round_trip(spark, docs, odd, empty):
    full = Tokenizer.from_file(VOCABULARY)
    for table in (docs.select("doc_id", "text").limit(80), odd):
        texts = [(r["doc_id"], r["text"]) for r in rows(table)]
        out = rows(packing.pack(table, VOCABULARY))
        want = Counter()
        for d, t in texts:
            want[d] += len(full.encode(t or "", add_special_tokens=False).ids) + 1
        have = Counter()
        for r in out:
            have[r["doc_id"]] += r["length"]
        assert have == want
        ids = {d: np.array(full.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in texts}
        for r in out:
            if r["doc_id"] not in (1, None):
                part = ids[r["doc_id"]][r["start"]: r["start"] + r["length"]]
                assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        by = {}
        for r in out:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for pieces in by.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 2048
        sizes = [sum(n for _, n in p) for p in by.values()]
        pad = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
        assert pad <= 0.03 * sum(sizes)
    assert rows(packing.pack(empty, VOCABULARY)) == []


def test_cuts_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(40):
        total, length = int(rng.integers(20, 60)), 16
        points = np.unique(rng.integers(1, total, int(rng.integers(8, 20))))
        costs = rng.choice([0.0, 3.0], len(points))
        got = packing.plan_cuts(points, costs, total, length, inside=packing.SENTENCE)  # forced cuts only where nothing is near
        at = dict(zip(points.tolist(), costs.tolist()))

        def price(cuts):
            out, a = 0.0, 0
            for c in cuts:
                out += (0 if c == total else at.get(c, packing.SENTENCE) + length - (c - a))
                a = c
            return out
        best = {0: 0.0}
        allowed = sorted(set(points.tolist()) | {c for c in got})
        for j in [*[p for p in allowed if p < total], total]:
            options = [best[i] + (0 if j == total else at.get(j, packing.SENTENCE) + length - (j - i)) for i in best if 0 < j - i <= length]
            if options:
                best[j] = min(options)
        assert all(b - a <= length for a, b in zip([0, *got], got)) and got[-1] == total
        assert price(got) <= best[total] + 1e-9


def test_word_cache_equals_tokenizer():
    w = packing.WordTokenizer(VOCABULARY, most=40)
    alphabet = "abcAB éÉñß .,!'’st  \n\t12½²ªº|$%&*+Σσ́ İ中"
    rng = np.random.default_rng(2)
    for _ in range(400):
        s = "".join(rng.choice(list(alphabet), int(rng.integers(0, 25)))) + ("<|endoftext|>" if rng.random() < 0.1 else "")
        assert w.full.encode(s, add_special_tokens=False).ids == w.encode(s).tolist()


# ---------------------------------------------------------------- 3 extraction
def test_extraction(spark):
    page = ("<html><body><nav><a>m</a></nav><div class='cookie-bar notice'><p>We use cookies on this site for you</p></div>"
            "<div class='post-{i}'><h1>Title &amp; {i}</h1><p>First&nbsp;para<br>goes\n on &eacute;<p><b>second <i>para</i>"
            "<script>var a='</p>'</script><div class='comments'><p>I disagree with all of it, and at length too</p></div></div>"
            "<aside>side</aside><footer>foot &copy;</footer><!-- gone <p>no</p> --></body></html>")
    data = [(i, f"https://User@H{i % 2}.example:80/a{i}", page.replace("{i}", str(i))) for i in range(6)]
    data += [(90, "http://h0.example/x", None), (91, None, "just text"), (92, "http://h1.example/", ""), (93, "http://h1.example/", "<p>cut &am"),
             (93, "http://h1.example/", "<p>cut &am"), (94, None, "<p>" * 500 + "deep <a href='x>y'>t</a>" + "<div" * 50)]
    got = {r["page_id"]: r for r in rows(html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")))}
    for i in range(6):
        assert got[i]["text"] == f"Title & {i}\n\nFirst para goes on é\n\nsecond para" and got[i]["n_chars"] == len(got[i]["text"])
    assert got[90]["text"] == got[92]["text"] == "" and got[91]["text"] == "just text" and got[93]["text"] == "cut &am"
    assert rows(html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"))) == []


def test_extraction_of_the_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    import html
    source = {r["page_id"]: r["html"] for r in rows(pages)}
    for r in rows(html_extract.extract(pages)):
        article = re.search(r"<article>(.*?)(</article>|$)", source[r["page_id"]], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip()
                 for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(x for x in parts if x)


def texts_of(spark, *pages):
    """Extracted texts of (url, html) pairs."""
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(rows(html_extract.extract(df)), key=lambda r: r["page_id"])]


def test_class_words_drop_only_parts_beside_the_article(spark):
    layouts = ["content no-sidebar", "post has-sidebar", "page-content right-sidebar", "long-form", "entry-header", "discussion"]
    pages = [(f"http://a{i}.x/", f"<body><div class='{c}'><p>the text of {i}</p></div><div class='site-footer'><p>contact and imprint</p></div></body>")
             for i, c in enumerate(layouts)]
    pages += [("http://b.x/", "<body><article><header class='entry-header'><h1 class='widget'>Title</h1></header><p>first and second</p>"
                              "<div class='post-comments'><p>I disagree with it</p></div></article></body>"),
              ("http://c.x/", "<body><div class='sidebar'><p>all there is</p><nav>menu</nav></div></body>")]
    assert texts_of(spark, *pages) == [f"the text of {i}" for i in range(len(layouts))] + ["Title\n\nfirst and second", "all there is"]
    for word in ("ad", "ad1", "ad-300x250", "site-header", "cookie-bar", "main-nav", "sidebar_2", "comment-list", "related-posts"):
        assert html_extract._beside(word)


def test_the_winning_path_needs_a_fair_share_of_the_page(spark):
    usual = "<body><div><p>" + "the usual text of this host " * 20 + "</p></div></body>"
    other = "<body><div><p>3 May, a teaser</p></div><section><p>" + "another template " * 20 + "</p></section></body>"
    for url in ("http://mixed.x/", None):
        got = texts_of(spark, *[(url, usual)] * 4, (url, other))
        assert got[:4] == [("the usual text of this host " * 20).strip()] * 4 and got[4] == ("another template " * 20).strip()


def test_lists_and_quotes_never_win(spark):
    long = "an item of the list " * 30
    for inner in (f"<ul><li>{long}</li></ul>", f"<blockquote><p>{long}</p></blockquote>", f"<table><tr><td>{long}</td></tr></table>"):
        page = f"<body><div><h1>Title</h1><p>intro</p>{inner}<p>outro</p></div></body>"
        assert texts_of(spark, *[("http://list.x/", page)] * 2) == [f"Title\n\nintro\n\n{long.strip()}\n\noutro"] * 2
    body = f"<body><article><header class='entry-header'><h1>Title</h1></header><div class='entry-content'><p>{long}</p></div></article></body>"
    assert texts_of(spark, ("http://body.x/", body)) == [f"Title\n\n{long.strip()}"]


def test_a_self_closed_svg_ends_at_once(spark):
    page = "<body><div><p>a</p><svg class='i' d=\"1>2\"/><p>body text</p><svg><path d='m'/>drawn</svg><p>end</p></div></body>"
    assert texts_of(spark, ("http://svg.x/", page)) == ["a\n\nbody text\n\nend"]


# ---------------------------------------------------------------- 4 quality
def test_quality_held_out(spark, odd, empty):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.filter("doc_id % 4 = 1")
    out = {r["doc_id"]: r for r in rows(quality.quality(docs, labels.filter("doc_id % 4 <> 1")))}
    right = [out[r["doc_id"]]["kept"] == (r["quality"] == 1 and r["toxic"] == 0) for r in rows(held)]
    assert np.mean(right) > 0.97 and len(out) == docs.count()
    none = labels.limit(0)
    assert all(r["kept"] and r["tail_prob"] == 1.0 for r in rows(quality.quality(odd, none)))
    assert len(rows(quality.quality(odd, labels.union(labels)))) == odd.count() and rows(quality.quality(empty, labels)) == []


def test_a_repeated_document_enters_the_fit_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 8 if i < 40 else 1, f"text {i} of {i % 3}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    met = []
    monkeypatch.setattr(quality, "fit_ordinal", lambda x, grades, **more: met.append((len(x), grades.tolist())))
    quality.fit(docs, labels)
    quality.fit(docs, labels, sample=5)
    assert [n for n, _ in met] == [8, 5] and sorted(met[0][1]) == [1] * 4 + [2] * 4


def test_ordinal_thresholds_are_ordered():
    rng = np.random.default_rng(1)
    x = [np.unique(rng.integers(0, 30, 6)) for _ in range(400)]
    grade = np.clip([int(np.digitize(sum(r < 8), [1, 3])) for r in x], 0, 2)
    weights, cuts = quality.fit_ordinal(x, np.array(grade))
    assert cuts[0] < cuts[1]
    z = np.array([weights[r].sum() for r in x])
    assert np.corrcoef(z, grade)[0, 1] > 0.8


# ---------------------------------------------------------------- 5 sharding
def test_sharding(spark, docs, odd, empty):
    for table in (docs, odd):
        out = rows(sharding.assign(table))
        texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows(table))
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == texts
        slots = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(8)}
        assert all(v == list(range(len(v))) for v in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        assert {r["law"] for r in out} == {"rows"} and {r["grown_shard"] for r in out} == {None}
    assert rows(sharding.assign(empty)) == []


def test_a_new_shard_moves_little(docs):
    before = {r["doc_id"]: r["shard"] for r in rows(sharding.assign(docs, 8))}
    after = {r["doc_id"]: r["shard"] for r in rows(sharding.assign(docs, 9))}
    assert np.mean([before[d] != after[d] for d in before]) < 0.45  # a modulus would move 8 of 9


# ---------------------------------------------------------------- 6 language model
def test_base_scores_and_model(spark, docs, odd, empty):
    for table in (docs, odd):
        out = rows(gru_lm.score(table))
        data = [(r["doc_id"], WORD.findall((r["text"] or "").translate(LOWER)) + [None]) for r in rows(table)]
        held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in data}
        count = Counter(itertools.chain.from_iterable(t for d, t in data if not held[d]))
        n, v = sum(count.values()), len(count)
        want = Counter((d, held[d], len(t), sum(x in count for x in t), n,
                        round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 4)) for d, t in data)
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out) == want
        if table is docs:
            own = [r for r in out if r["held_out"]]
            assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
    assert rows(gru_lm.score(empty)) == []


def test_chances_add_up_and_state_is_carried():
    rng = np.random.default_rng(3)
    words = gru_lm.CLASSES * gru_lm.MEMBERS
    p = gru_lm.start_parameters(rng.integers(0, 9, gru_lm.CLASSES + 1), rng.integers(0, 9, (gru_lm.CLASSES, gru_lm.MEMBERS)))
    p["wc"] += rng.normal(0, 0.3, p["wc"].shape).astype(np.float32)
    h = np.repeat(rng.normal(size=(1, gru_lm.HIDDEN)).astype(np.float32), words + 1, axis=0)
    assert abs(np.exp(gru_lm.output(p, h, np.arange(words + 1))[0]).sum() - 1) < 1e-3
    ids = rng.integers(0, words + 1, 150)
    whole = gru_lm.log_likelihood(p, ids, np.array([0, 150]))
    many = gru_lm.log_likelihood(p, np.concatenate([ids, ids[:7], ids]), np.array([0, 150, 157, 307]))
    assert np.allclose(many[[0, 2]], whole, rtol=1e-4)


# ---------------------------------------------------------------- 7 language ID
def test_language_id(spark, docs, odd, empty):
    out = {r["doc_id"]: r for r in rows(langid.language_id(docs))}
    truth = {r["doc_id"]: r["lang"] for r in rows(docs)}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d, r in out.items() if r["held_out"]} == set(held)
    assert np.mean([out[d]["lang_pred"] == truth[d] for d in held]) > 0.97
    got = rows(langid.language_id(odd))
    assert len(got) == odd.count() and all((r["lang_pred"] == "und") == (r["score"] == 0) for r in got)
    assert [r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4, 6)] == ["und"] * 4
    assert rows(langid.language_id(empty)) == []
    model = (["de", "en"], np.log(np.random.default_rng(0).dirichlet(np.ones(langid.BUCKETS), 2).T).astype(np.float32), np.log([0.5, 0.5]))
    text = "Grüße an the World 12 " * 40
    alone = langid.classify([text], model)
    assert langid.classify(["x", text, "", None, text], model)[1][[1, 4]] == pytest.approx(alone[1][0])


# ---------------------------------------------------------------- 8 multi-index
def test_multi_index_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 16))
    x[100:200] = x[:100] + rng.normal(0, 0.08, (100, 16))
    x[200:300] = x[100:200] + rng.normal(0, 0.12, (100, 16))
    x[300:340] = x[0]
    label = rng.integers(0, 3, 900)
    label[:340] = 1
    data = [(i, [float(v) for v in x[i]], int(label[i])) for i in range(900)]
    data += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("inf")] * 16, 1), (903, data[0][1], None), (904, [1.0, None], 1), (905, [1.0, 2.0], 1)]
    got = {r["vec_id"]: r for r in rows(multi_index.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")))}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hit = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    want = groups(range(900), [(i, j) for i, j in zip(*np.nonzero(np.triu(hit, 1)))])
    found = sum(got[i]["n_links"] for i in range(900))
    assert found >= 0.99 * (hit.sum() - 900) and all(got[i]["n_links"] <= hit[i].sum() - 1 for i in range(900))
    assert np.mean([got[i]["component_id"] == want[i] for i in range(900)]) > 0.99
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))
    assert rows(multi_index.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))) == []


def test_traversal_order():
    low1, low2 = np.array([0.0, 0.5, 0.2]), np.array([0.1, 0.0])
    cells = multi_index.traverse(low1, low2, 0.45).tolist()
    assert cells == sorted(cells, key=lambda c: low1[c // 2] + low2[c % 2]) and set(cells) == {0, 1, 4, 5}


@pytest.mark.parametrize("dim", [64, 256, 768])
@pytest.mark.parametrize("spread", ["rank 8", "power law"])
def test_no_link_is_missed_on_concentrated_vectors(dim, spread):
    rng = np.random.default_rng(dim)
    n, codes = 2600, 9  # 9 codes a half: the number for 5,200 vectors of a label
    scale = np.where(np.arange(dim) < 8, 1.0, 0.02) if spread == "rank 8" else 1.0 / np.sqrt(1.0 + np.arange(dim))
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    x = (rng.normal(size=(n, dim)) * scale)
    y = x + rng.normal(size=(n, dim)) * scale * rng.uniform(0.2, 0.4, (n, 1))
    u = np.concatenate([x, y]) @ turn
    u /= np.linalg.norm(u, axis=1)[:, None]
    half = dim // 2
    books = {dim: (multi_index.kmeans(u[:, :half], codes), multi_index.kmeans(u[:, half:], codes, seed=8))}
    batch = pa.record_batch([pa.array([dim] * len(u), pa.int32()), pa.array([v.tobytes() for v in u], pa.binary())], names=["dim", "v"])
    out = next(multi_index._assign(books, multi_index.COSINE)([batch]))
    cell = out.column("cell").to_numpy()
    visited = np.zeros((len(u), codes * codes), bool)
    for i, cells in enumerate(out.column("visits").to_pylist()):
        visited[i, cells] = True
    a, b = np.nonzero(np.triu(u @ u.T >= multi_index.COSINE, 1))
    assert len(a) > 1000
    assert visited[a, cell[b]].all() and visited[b, cell[a]].all()


def test_vectors_are_sent_by_tile_and_not_by_cell(spark, monkeypatch):
    """A vector is dealt out once for each tile of its label, however many cells it visits, and tiles change no result."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 8))
    x[2000:] = x[:2000] + rng.normal(0, 0.1, (2000, 8)) * (np.arange(2000) % 2)[:, None]
    x[3990:] = x[0]
    label = np.where(np.arange(4000) % 2000 < 1700, 0, 1)
    table = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x.astype(np.float32), label))],
                                  "vec_id long, embedding array<float>, label int").repartition(3)
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    hit = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    want = groups(range(4000), list(zip(*np.nonzero(np.triu(hit, 1)))))
    sent = spark.sparkContext.accumulator(0)
    verify = multi_index._verify

    def counted(*args):
        run = verify(*args)

        def task(batches):
            def seen():
                for b in batches:
                    sent.add(b.num_rows)
                    yield b
            return run(seen())
        return task
    monkeypatch.setattr(multi_index, "_verify", counted)
    monkeypatch.setattr(multi_index, "VISITORS", 50)
    monkeypatch.setattr(multi_index, "RESIDENTS", 70)
    for least in (4000, 400):
        monkeypatch.setattr(multi_index, "LEAST", least)
        before = sent.value
        got = {r["vec_id"]: r for r in rows(multi_index.near_duplicates(table))}
        n = len(np.unique(np.concatenate([u, label[:, None]], axis=1), axis=0))
        room = min(multi_index.TILE, max(least, n // multi_index.SHARE))
        tiles = [-(-len(np.unique(u[label == k], axis=0)) // room) for k in (0, 1)]
        assert sent.value - before == sum(t * len(np.unique(u[label == k], axis=0)) for t, k in zip(tiles, (0, 1)))
        assert (tiles[0] > 3) == (least == 400)
        assert all(got[i]["n_links"] == hit[i].sum() - 1 and got[i]["component_id"] == want[i] for i in range(4000))


def test_links_are_found_in_any_number_of_partitions(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(600, 16))
    x[300:] = x[:300] + rng.normal(0, 0.05, (300, 16))
    table = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r["vec_id"]: r for r in rows(multi_index.near_duplicates(table))}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    assert all(got[i]["n_links"] == 1 and got[i]["component_id"] == i % 300 for i in range(600))


def test_single_precision_decides_nothing_near_the_threshold():
    """Pairs within the rounding of single precision are settled in double precision, beyond and below the threshold."""
    a = np.zeros((1, 64))
    a[0, 0] = 1.0
    c = 0.93 + np.array([-1e-9, 1e-9, -1e-12, 1e-12, 0.01, -0.01])
    b = np.zeros((6, 64))
    b[:, 0], b[:, 1] = c, np.sqrt(1 - c * c)
    rep = pa.array(np.arange(1, 8))
    batch = pa.record_batch([pa.array([0] * 7), pa.array([64] * 7, pa.int32()), *[pa.array([0] * 7, pa.int32())] * 4, rep, pa.array([1] * 7),
                             pa.array([v.tobytes() for v in np.concatenate([a, b])], pa.binary())],
                            names=["label", "dim", "i", "j", "side", "cell", "rep", "n", "v"])
    out = pa.Table.from_batches(multi_index._verify({}, 0.93, np.float64)(iter([batch.slice(0, 3), batch.slice(3)]))).to_pylist()
    links = {r["u"]: r["links"] for r in out if r["links"]}
    u = np.concatenate([a, b])
    u /= np.linalg.norm(u, axis=1)[:, None]
    linked = u @ u.T >= 0.93
    assert links == {i + 1: n - 1 for i, n in enumerate(linked.sum(axis=1)) if n > 1}
    assert [bool(x) for x in linked[0, 1:]] == [False, True, False, True, True, False]
    assert all(r["u"] > r["v"] or r["links"] for r in out)


def test_odd_vectors_become_bytes():
    lists = pa.array([[1.0, -0.0], None, [], [0.0, 0.0], [float("nan"), 1.0], [1.0, None], [2.0, 3.0], [4.0]], pa.list_(pa.float32()))
    batch = pa.record_batch([pa.array(range(8)), lists, pa.array([1, 1, 1, 1, 1, 1, None, 2], pa.int64())], names=["vec_id", "embedding", "label"])
    for part, first in ((batch, 0), (batch.slice(3), 3)):
        for kind in (np.float32, np.float64):
            got = next(multi_index._valid(kind)(iter([part]))).to_pylist()
            good = {0: [1.0, 0.0], 7: [4.0]}
            assert [r["v"] for r in got] == [np.array(good[i], kind).tobytes() if i in good else None for i in range(first, 8)]
            assert [r["dim"] for r in got] == [len(good.get(i, [])) for i in range(first, 8)]


# ---------------------------------------------------------------- 9 SuperMinHash
def test_signature_estimates():
    rng = np.random.default_rng(4)
    gaps = []
    for _ in range(60):
        u = np.unique(rng.integers(0, 2 ** 63, 100).astype(np.uint64))
        s = superminhash.signatures([u[:90], u[10:]])
        gaps.append((s[0] == s[1]).mean() - 0.8)
    assert abs(np.mean(gaps)) < 0.01 and np.std(gaps) < 0.025  # independent minima: 0.025


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_brute_force(spark, docs, odd, empty, k):
    rng = np.random.default_rng(k)
    base = [f"w{i}" for i in range(60)]
    extra = []
    for i in range(60):  # a group of near copies around one text
        words = list(base)
        for at in rng.choice(60, int(rng.integers(0, 4)), replace=False):
            words[at] = f"x{i}_{at}"
        extra.append((10_000 + i, " ".join(words)))
    table = docs.select("doc_id", "text").union(odd.filter("doc_id <> 1").withColumn("doc_id", odd.doc_id + 5000).select("doc_id", "text")).union(
        spark.createDataFrame(extra, "doc_id long, text string"))
    sets = {r["doc_id"]: shingles(r["text"], k) for r in rows(table)}
    ids = sorted(sets)
    links = [(a, b) for a, b in itertools.combinations(ids, 2) if sets[a] and min(len(sets[a]), len(sets[b])) * 10 >= 8 * max(len(sets[a]), len(sets[b]))
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = groups(ids, links)
    got = {r["doc_id"]: r for r in rows(superminhash.near_duplicates(table, k=k, percent=80))}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[d]) and r["kept"] == (d == want[d]) for d, r in got.items())
    out = rows(superminhash.near_duplicates(odd, k=k))
    assert len(out) == odd.count() and all(r["kept"] and r["component_id"] is None for r in out if r["doc_id"] is None)
    assert rows(superminhash.near_duplicates(empty, k=k)) == []


# ---------------------------------------------------------------- 10 mixing
def test_mixing(spark, docs, odd, empty):
    for table in (docs, odd):
        out = rows(mixing.mix(table))
        assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in rows(table))
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
        assert Counter(map(str, out)) == Counter(map(str, rows(mixing.mix(table))))
    source = {r["doc_id"]: r["source"] for r in rows(docs)}
    out = rows(mixing.mix(docs))
    for s in set(source.values()):
        own = [r for r in out if source[r["doc_id"]] == s]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.02 * own[0]["target"] + 5
    assert rows(mixing.mix(empty)) == []


def test_targets():
    got = mixing.targets({"a": 10, "b": 1000, None: 500, "c": 0})
    assert got["a"] == 30 and got["c"] == 0 and sum(got.values()) == pytest.approx(1510)
    assert got["b"] / got[None] == pytest.approx(2 / 5)
