"""The corpus pipeline: each stage's decisions against its operator's rules on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from veracity.llm import mixing


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    kept = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "packing":
            tokens = Counter()
            for r in out.collect():
                tokens[r["doc_id"]] += r["length"]
            assert set(tokens) == set(kept["mixing"])
            break
        assert out.columns == pipeline.COLUMNS
        out = out.cache()
        kept[name] = [r["doc_id"] for r in out.select("doc_id").collect()]
        if name == "mixing":
            want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
            assert Counter(kept[name]) == want
        docs = out
    assert len(kept["language_id"]) > 0.98 * len(ids)
    good = [d for d in kept["quality"] if d in labels]
    assert all(labels[d]["toxic"] == 0 for d in good) and sum(labels[d]["quality"] for d in good) > 0.95 * len(good)
    clean = [d for d in kept["language_id"] if d in labels and labels[d]["quality"] == 1 and labels[d]["toxic"] == 0]
    assert len(set(clean) & set(kept["quality"])) > 0.95 * len(clean)
    assert len(set(kept["near_duplicates"])) == len(kept["near_duplicates"]) < len(kept["quality"])


def test_repeated_ids_and_nulls(spark):
    data = [(1, "one two three four five six", "en", "a", 3), (1, "one two three four five six", "en", "a", 3), (None, None, None, None, None),
            (2, "something else entirely here now ok", "en", "b", 3), (1, "one two three four five seven", None, None, 3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    out = [r["doc_id"] for r in pipeline.dedup_stage(spark, docs, "").collect()]
    assert sorted(out, key=str) == [1, 1, 2, None]
    empty = docs.limit(0)
    for name, stage in pipeline.STAGES:
        if name != "quality":
            assert stage(spark, empty, "").collect() == []


def test_distinct_texts_under_one_id_stay(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    data = [(1, a), (1, b), (1, b), (2, a + " more"), (3, b + " more"), (None, a), (None, ""), (None, ""), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r["doc_id"], r["text"][:2]) for r in pipeline.dedup_stage(spark, docs, "").collect()]
    assert sorted(x for _, x in out) == ["", "", "", "a0", "b0"]


def test_foreign_and_garbage_texts_go(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*pipeline.COLUMNS)
    odd = ["Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek ésszel és lelkiismerettel bírnak.",
           "xq zvk wpfj qqx jkzv xxw vbnq zzkq pfw kjx qvz wxk zqj vkp fjx qzw", "=== 12 %% a ;; 99 == 77 ## 3 $$ ;; 11 ==", "123 456 !!!", None]
    plant = spark.createDataFrame([(10**9 + i, t, [None, "en"][i % 2], "plant", 1) for i, t in enumerate(odd)], docs.schema)
    out = pipeline.language_stage(spark, docs.union(plant), sf)
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert not [i for i in ids if i >= 10**9]
    assert len(ids) > 0.985 * docs.count()
