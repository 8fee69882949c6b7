"""Operator-level tests: skew-safe paths equal the plain ones, metrics equal
brute-force definitions, ML invariants, bundle checks, upload adapter."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veracity.operators import metrics as M
from veracity.operators import ml as ML
from veracity.operators import ordered as O


def _df(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.choice(["hot", "b", "c"], n, p=[.8, .15, .05]), "o": np.arange(n),
                        "x": rng.normal(size=n).round(3), "y": rng.integers(0, 2, n)})
    return spark.createDataFrame(pdf), pdf


def test_group_median(spark):
    df, pdf = _df(spark)
    got = {r.g: r.m for r in O.group_median(df, ["g"], "x", "m").collect()}
    for k, m in pdf.groupby("g").x.median().to_dict().items():
        assert abs(got[k] - m) < 1e-12


def test_median_of_hot_tie_and_odd_values(spark):
    rows = [("hot", 2.5)] * 500 + [("hot", float(i)) for i in range(-20, 20)] + [("nan", float("nan"))]
    rows += [(None, 1.0), (None, 4.0), ("tiny", 1e-310), ("tiny", -1e-310), ("tiny", 0.0), ("void", None)]
    rows += [("wide", x) for x in (float("-inf"), -1e305, 3.0, 1e305)]
    got = {r.g: r.m for r in O.group_median(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", "m").collect()}
    assert got["hot"] == 2.5 and got[None] == 2.5 and got["tiny"] == 0.0 and "void" not in got and math.isnan(got["nan"])
    assert got["wide"] == (-1e305 + 3.0) / 2


def test_running_sums_and_ranks(spark, monkeypatch):
    df, pdf = _df(spark)
    d = df.withColumn("w", F.col("y").cast("double"))
    s = O.running_sums(d, ["g"], [F.col("o")], ["w"], F.floor(F.col("o") / 100)).orderBy("o").toPandas()
    assert np.allclose(s.cum_w, pdf.groupby("g").y.cumsum()) and np.allclose(s.tot_w, pdf.groupby("g").y.transform("sum"))
    r = O.global_rank(df.select("g", "o"), [F.col("g"), F.col("o")]).orderBy("g", "o").toPandas()
    assert list(r["rank"]) == list(range(len(r)))
    # a hot first order column that is tied throughout
    t = O.group_rank(df.select("g", "o", F.lit(0.5).alias("p")), ["g"], [F.col("p").desc(), F.col("o")]).orderBy("o").toPandas()
    assert list(t["rank"]) == list(pdf.groupby("g").cumcount())
    assert O.global_rank(df.select("o").where("o < 0"), [F.col("o")]).count() == 0


def test_carry_arrays_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "SPAN", 3)
    rows = [("hot" if i % 5 else "b", i // 40, i, [str(i), None] if i % 7 == 0 else None, float(i) if i % 11 == 0 else None)
            for i in range(200)]
    df = spark.createDataFrame(rows, "g string, t int, o int, a array<string>, v double")
    got = {r.o: r for r in O.carry_forward(df, ["g"], ["t", "o"], ["a", "v"]).collect()}
    last = {}
    for g, _, o, a, v in rows:
        old = last.get(g, (None, None))
        last[g] = (a if a is not None else old[0], v if v is not None else old[1])
        assert (got[o].ffill_a, got[o].ffill_v) == last[g]


def test_neighbours_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "SPAN", 4)
    marks = {"x": [3, 17, 18, 40], "y": []}
    df = spark.createDataFrame([(g, p, p if p in m else None) for g, m in marks.items() for p in range(50)], "g string, p int, m int")
    for r in O.neighbours(df, ["g"], "p", "m", "m").collect():
        m = marks[r.g]
        assert r.left == max((x for x in m if x < r.p), default=None) and r.right == min((x for x in m if x >= r.p), default=None)


def _ap(y, s):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, tp, n = 0.0, 0, 0
    for t in order:
        idx = [i for i in range(len(s)) if s[i] == t]
        dtp = sum(y[i] for i in idx)
        tp += dtp
        n += len(idx)
        ap += dtp / P * tp / n
    return ap


def _auc(y, s):
    pos = [s[i] for i in range(len(y)) if y[i] == 1]
    neg = [s[i] for i in range(len(y)) if y[i] == 0]
    return sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))


def _best(y, s):
    grid = M.threshold_grid()
    best_t, best_f = 0.5, -1.0
    for t in grid:
        tp = sum(1 for a, b in zip(y, s) if a == 1 and b >= t)
        fp = sum(1 for a, b in zip(y, s) if a == 0 and b >= t)
        fn = sum(1 for a, b in zip(y, s) if a == 1 and b < t)
        f = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
        if f > best_f:
            best_t, best_f = t, f
    return best_t, best_f


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rank_metrics_brute_force(spark, seed):
    rnd = random.Random(seed)
    y = [rnd.randint(0, 1) for _ in range(300)]
    s = [round(rnd.random(), 2) if rnd.random() < .7 else rnd.choice([0.1, 0.3, 0.5, 0.9, 0.105]) for _ in range(300)]
    df = spark.createDataFrame(pd.DataFrame({"y_true": y, "y_prob": s}))
    assert abs(M.average_precision(df).first().pr_auc - _ap(y, s)) < 1e-12
    assert abs(M.roc_auc(df).first().roc_auc - _auc(y, s)) < 1e-12
    bt = M.best_threshold(df).first()
    t, f = _best(y, s)
    assert bt.threshold == t and abs(bt.f1 - f) < 1e-12


def test_ece_edges(spark):
    y = [1, 0, 1, 0, 1, 1]
    p = [0.3, 3 * 0.1, 1.0, 0.0, 0.9, 0.95]
    df = spark.createDataFrame(pd.DataFrame({"y_true": y, "y_prob": p}))
    r = M.brier_ece(df).first()
    edges = [i * 0.1 for i in range(11)]
    ece = 0.0
    for i in range(10):
        m = [(a, b) for a, b in zip(y, p) if (edges[i] <= b < edges[i + 1]) or (i == 9 and edges[i] <= b <= 1.0)]
        if m:
            ece += abs(sum(b for _, b in m) / len(m) - sum(a for a, _ in m) / len(m)) * len(m) / len(y)
    assert abs(r.ece - ece) < 1e-12
    assert abs(r.brier - sum((b - a) ** 2 for a, b in zip(y, p)) / len(y)) < 1e-12


def test_fold_ci_single_and_nan(spark):
    df = spark.createDataFrame([("m", 1, 0.5, float("nan")), ("m", 2, 0.7, 0.2)], "model string, fold int, f1 double, pr_auc double")
    r = {x.metric: x for x in M.fold_ci(df, ["f1", "pr_auc"], by=["model"]).collect()}
    assert r["pr_auc"].n == 1 and r["pr_auc"].std == 0.0 and r["pr_auc"].ci_low == 0.2
    sd = math.sqrt(((0.5 - .6) ** 2 + (0.7 - .6) ** 2) / 1)
    assert abs(r["f1"].std - sd) < 1e-12 and abs(r["f1"].ci_high - (0.6 + 1.96 * sd / math.sqrt(2))) < 1e-12


# --- bundle shape checks (same accept/reject cases as the serving side)
def test_bundle_accepts_single_and_ensemble():
    assert ML.validate_bundle({"model": object(), "feature_cols": ["a"], "threshold": 0.5})
    assert ML.validate_bundle({"model_kind": "ensemble", "models": [{"name": "x", "model": object(), "weight": 1.0}],
                               "feature_cols": ["a"], "label_col": "y", "threshold": 0.5})


@pytest.mark.parametrize("bad,msg", [
    ({"model": object()}, "feature_cols"),
    ({"feature_cols": ["a"]}, "`model` or non-empty `models`"),
    ({"models": [], "feature_cols": ["a"]}, "`model` or non-empty `models`"),
])
def test_bundle_rejects(bad, msg):
    with pytest.raises(ValueError, match=msg):
        ML.validate_bundle(bad)


def test_folds_and_holdout_invariants(spark):
    rng = np.random.default_rng(0)
    n = 600
    pdf = pd.DataFrame({"test_id": [f"t{i % 40}" for i in range(n)], "_label": rng.integers(0, 2, n),
                        "a": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    f1, k, kind = ML.assign_folds(df, "test_id", "_label")
    p1 = f1.toPandas()
    assert k == 5 and kind == "stratified_group"
    assert (p1.groupby("test_id").fold.nunique() == 1).all() and set(p1.fold) == set(range(5))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    p2 = ML.assign_folds(df, "test_id", "_label")[0].toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert p1.groupby("test_id").fold.first().equals(p2.groupby("test_id").fold.first())
    h = ML.group_holdout(df, "test_id", "_label").toPandas()
    assert (h.groupby("test_id").split.nunique() == 1).all()
    assert h[h.split == "holdout"].test_id.nunique() == round(40 * 0.2)
    assert h[h.split == "holdout"]._label.nunique() == 2 and h[h.split == "dev"]._label.nunique() == 2


@pytest.mark.parametrize("labels, size", [([0] * 7 + [1] * 7, 3), ([0, 1, 1, 1], 2)])
def test_holdout_takes_exactly_its_size(spark, labels, size):
    rows = [(f"g{i}", y, x) for i, y in enumerate(labels) for x in range(2)]
    if len(labels) == 4:
        rows += [(f"g{i}", 1 - y, 9) for i, y in enumerate(labels)]  # both classes on both sides
    df = spark.createDataFrame(rows, "test_id string, _label int, a int")
    h = ML.group_holdout(df, "test_id", "_label").toPandas()
    assert len(h) == len(rows) and h[h.split == "holdout"].test_id.nunique() == size


def test_row_folds_keep_every_row(spark):
    df = spark.createDataFrame([("t", i % 2, i // 4) for i in range(40)], "test_id string, _label int, a int")
    out, k, kind = ML.assign_folds(df, "test_id", "_label")
    got = out.toPandas()
    assert kind == "stratified" and k == 5 and len(got) == 40
    assert got.groupby(["_label", "fold"]).size().eq(4).all()


def test_feedback_ties_do_not_depend_on_order(spark):
    from veracity.operators import feedback as FB
    rows = [("t", "q", "2024-01-01 00:00:00", 1, "a"), ("t", "q", "2024-01-01 00:00:00", 0, "b")]
    cols = "test_id string, question_code string, created_at string, expert_label int, note string"
    got = [FB.latest_feedback(spark.createDataFrame(r, cols)).collect()[0].note for r in (rows, rows[::-1])]
    assert got[0] == got[1]


def test_headers_reach_rows(spark):
    from veracity.operators import cells as CE
    rows = [("d", 0, 0, ["Вопрос", "I", "Параметр"]), ("d", 0, 1, ["Пв1", "1,5", "КГР"]),
            ("d", 0, 2, ["Параметр", "Вопрос", "II"]), ("d", 0, 3, ["АД", "Пв2", "7"]), ("d", 1, 0, ["Нв1", "ПГ", "3"])]
    df = spark.createDataFrame(rows, "doc string, tbl_no int, row_no int, cells array<string>")
    want = {(0, 1): ("Пв1", "КГР"), (0, 3): ("Пв2", "АД"), (1, 0): ("Нв1", "ПГ")}
    got = {(r.tbl_no, r.row_no): (r.cell_question, r.cell_parameter) for r in CE.cells_to_fields(df).collect()}
    assert got == want


def test_logreg_beats_majority(spark):
    rng = np.random.default_rng(1)
    n = 400
    x = rng.normal(size=n)
    y = (x + rng.normal(scale=.5, size=n) > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"test_id": [f"t{i % 20}" for i in range(n)], "a": x, "b": rng.normal(size=n),
                                             "_label": y}))
    f = ML.fit(ML.build_models()[0], df, ["a", "b"])
    p = ML.predict_proba(f, df, "p").withColumn("pred", (F.col("p") >= .5).cast("int"))
    acc = p.where("pred = _label").count() / n
    assert acc > max(y.mean(), 1 - y.mean()) + 0.1


def test_upload_adapter(spark):
    from veracity.sources.tables import adapt_upload
    wide = spark.createDataFrame([("T", 1.0)], "test_id string, i_gsr double")
    assert adapt_upload(wide)[1] == "wide"
    long = spark.createDataFrame([("Пв1 x", "КГР", "1,5", "2", "0.7")], "Question_Raw string, PARAMETER string, I string, ii string, result string")
    out, kind = adapt_upload(long, "u/exam.csv")
    r = out.first()
    assert kind == "long" and r.test_id == "exam" and r.source_type == "upload" and r.question_type == "other"
    assert (r.metric_ii, r.score_result, r.question_code) == (2.0, 0.7, "Пв1 x")
    bad = spark.createDataFrame([("q", "p", "x")], "question_raw string, parameter string, I string")
    with pytest.raises(ValueError, match="No numeric I/II"):
        adapt_upload(bad)
    with pytest.raises(ValueError, match="Unsupported"):
        adapt_upload(spark.createDataFrame([(1,)], "a int"))


def test_calibrated_forest_probabilities(spark):
    rng = np.random.default_rng(2)
    n = 300
    x = rng.normal(size=n)
    y = (x > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": rng.normal(size=n), "_label": y}))
    spec = [s for s in ML.build_models(trees_scale=0.01) if s.calibrated][0]
    f = ML.fit(spec, df, ["a", "b"])
    p = ML.predict_proba(f, df, "p")
    assert p.columns == ["a", "b", "_label", "p"]
    pdf = p.toPandas()
    assert pdf.p.between(0, 1).all() and pdf[pdf._label == 1].p.mean() > pdf[pdf._label == 0].p.mean() + 0.3
    assert ML.feature_importance(f) == [("a", 0.0), ("b", 0.0)]


def test_forest_splits_follow_many_distinct_values(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": np.arange(200.0), "_label": ((np.arange(200) >= 53) & (np.arange(200) < 118)).astype(int)}))
    params = {"numTrees": 1, "minInstancesPerNode": 1, "featureSubsetStrategy": "all", "bootstrap": False}
    got = ML.predict_proba(ML.fit(ML.Spec("one_tree", "rf", params=params), df, ["a"]), df, "p").toPandas()
    assert ((got.p > 0.5) == (got._label == 1)).all()


def test_robust_stats(spark, sf):
    from veracity.operators import direct as D
    from veracity.plans import catalog as C
    m = C._masked(spark, sf)
    got = {r.test_id: r for r in D.robust_stats(m, "test_id").collect()}
    base = m.where("in_baseline").select("test_id", *D.SIG.values()).toPandas()
    assert len(got) == 15
    for t, x in base.groupby("test_id"):
        for ch, col in D.SIG.items():
            mid = x[col].median()
            mad, sd = (x[col] - mid).abs().median() * 1.4826, x[col].std(ddof=0)
            assert abs(got[t][f"centre_{ch}"] - mid) < 1e-12
            assert abs(got[t][f"scale_{ch}"] - (mad if mad > 1e-8 else sd if sd > 1e-8 else 1.0)) < 1e-9


def test_feedback_log_versions(spark, tmp_path):
    from veracity.sources.tables import upsert_feedback_log
    schema = "created_at timestamp, test_id string, question_code string, expert_review string"
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(t, "T1", "c1", "Ложь"), (t + dt.timedelta(seconds=1), "T1", "c2", "maybe")], schema)
    v0 = upsert_feedback_log(spark, str(tmp_path / "log"), a)
    assert {(r.question_code, r.expert_label) for r in v0.collect()} == {("c1", 1)}
    b = spark.createDataFrame([(t + dt.timedelta(days=1), "T1", "c1", " нет "), (t - dt.timedelta(days=1), "T1", "c1", "да")], schema)
    v1 = upsert_feedback_log(spark, str(tmp_path / "log"), b)
    assert {(r.question_code, r.expert_label) for r in v1.collect()} == {("c1", 0)}
    assert spark.read.parquet(str(tmp_path / "log" / "v=0")).count() == 1  # previous version untouched


def test_attach_expected_keys_by_test(spark):
    from veracity.operators.verdicts import attach_expected
    pred = spark.createDataFrame([("A", "Пв1", 0.7), ("B", "Пв1", 0.2)], "test_id string, question_code string, deception_probability double")
    qs = spark.createDataFrame([("A", "Пв1", 2, "Lie"), ("B", "Пв1", 2, "Truth"), ("B", "Пв1", 5, "Lie")],
                               "test_id string, question_code string, order int, waiting_answer_label string")
    got = {r.test_id: r.waiting_answer_label for r in attach_expected(pred, qs).collect()}
    assert got == {"A": "Lie", "B": "Truth"}


def test_nearest_reference(spark, sf, monkeypatch):
    from veracity.operators import direct as D
    from veracity.plans import catalog as C
    z = O.materialize(D.robust_z(C._masked(spark, sf), "test_id"))
    cols = ["test_id", "group_idx", "stimulus_idx", "ref_c_question_code", "ref_group_idx", "ref_stimulus_idx",
            "delta_eda_vs_c", "delta_resp_vs_c"]
    a = sorted(tuple(r) for r in D.nearest_reference(z, "test_id").select(*cols).collect())
    monkeypatch.setattr(O, "SPAN", 2)  # many buckets a test
    b = sorted(tuple(r) for r in D.nearest_reference(z, "test_id").select(*cols).collect())
    assert len(a) == 1000 and a == b
    c = D.nearest_reference(z, "test_id", within_group=True).select(*cols).collect()
    assert all(r.ref_group_idx is None or r.ref_group_idx == r.group_idx for r in c)


def test_impute_scale(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.integers(0, 3, 200).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).select(F.nanvl("a", F.lit(None)).alias("a"), "b", F.lit(None).cast("double").alias("void"))
    got = {r.feature: r for r in ML.fit_impute_scale(df, ["a", "b", "void"]).collect()}
    for c in ("a", "b"):
        imp = pdf[c].fillna(pdf[c].median())
        assert abs(got[c].median - pdf[c].median()) < 1e-12
        assert abs(got[c].mean - imp.mean()) < 1e-12 and abs(got[c].std - imp.std(ddof=0)) < 1e-12
    assert (got["void"].median, got["void"].mean, got["void"].std) == (None, 0.0, 1.0)


def test_score_uploads(spark):
    from veracity.plans import jobs as J
    rng = np.random.default_rng(9)
    n = 120
    pdf = pd.DataFrame({"test_id": [f"t{i % 4}" for i in range(n)], "question_code": [f"q{i}" for i in range(n)],
                        "i_gsr": rng.normal(size=n) * 3, "ii_gsr": rng.normal(size=n), "i_bp": rng.normal(size=n) * 0.1,
                        "ii_bp": rng.normal(size=n) * 5})
    pdf["_label"] = (pdf.i_gsr > 0).astype(int)
    df = spark.createDataFrame(pdf)
    cols = ["i_gsr", "ii_gsr", "i_bp", "ii_bp"]
    f = ML.fit(ML.build_models()[0], df, cols)
    summary, per_q = J.score_uploads(df.drop("_label"), [(f, 1.0)], 0.5, cols)
    s = {r.test_id: r for r in summary.collect()}
    assert set(s) == {"t0", "t1", "t2", "t3"}
    for r in s.values():
        assert 0 <= r.overall_score <= 1 and r.n_items == 30 and len(r.key_channels) == 3
        assert r.key_channels[0] in ("ii_bp", "i_gsr") and "i_bp" not in r.key_channels
    assert per_q.count() == n and set(per_q.columns) >= {"test_id", "question_code", "deception_probability"}


def test_feedback_log_read_error_propagates(spark, tmp_path):
    """An unreadable newest version stops the upsert; earlier versions stay as they are."""
    from veracity import schemas as S
    from veracity.sources.tables import upsert_feedback_log
    log = tmp_path / "log"
    empty = spark.createDataFrame([], S.FEEDBACK)
    upsert_feedback_log(spark, str(log), empty)
    bad = log / "v=1"
    bad.mkdir()
    (bad / "part-00000.parquet").write_bytes(b"not parquet")
    (bad / "_SUCCESS").touch()
    before = sorted(p.name for p in (log / "v=0").iterdir())
    with pytest.raises(Exception):
        upsert_feedback_log(spark, str(log), empty)
    assert sorted(p.name for p in (log / "v=0").iterdir()) == before and not (log / "v=2").exists()


# ---------------------------------------------------------------- crowded values, row ids, log replays
def test_median_and_running_sums_of_values_packed_just_below_one(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = 1 - rng.integers(1, 1 << 20, 60_000) * 2.0 ** -40  # one coarse cell, many fine ones
    y = rng.integers(0, 2, 60_000)
    df = spark.createDataFrame([(int(i % 3 == 0), float(v), int(t)) for i, (v, t) in enumerate(zip(x, y))], "g int, v double, y int")
    from veracity.operators import metrics, ordered
    cells = df.select(ordered.value_bucket(F.col("v")).alias("b"), ordered.fine_bucket(F.col("v")).alias("f"))
    coarse, fine = cells.agg(F.count_distinct("b"), F.count_distinct("f")).first()
    assert coarse <= 2 and fine > 500
    got = {r["g"]: r["median"] for r in ordered.group_median(df, ["g"], "v").collect()}
    for g in (0, 1):
        assert got[g] == np.median(x[np.arange(len(x)) % 3 == 0] if g else x[np.arange(len(x)) % 3 != 0])
    order = np.argsort(x, kind="stable")
    values, first = np.unique(x[order], return_index=True)
    pos = np.add.reduceat(y[order], first)
    neg = np.diff(np.append(first, len(x))) - pos
    auc = (pos * (np.cumsum(neg) - neg / 2)).sum() / (pos.sum() * neg.sum())
    assert metrics.roc_auc(df, "y", "v").first()["roc_auc"] == pytest.approx(auc, abs=1e-9)


def test_row_ids_and_splits_do_not_depend_on_partitions(spark):
    from veracity.operators import ml
    rows = [(i % 7, float(i % 5), i % 2) for i in range(200)]
    made = []
    for n in (1, 7):
        df = spark.createDataFrame(rows, f"a int, b double, {ml.LABEL} int").repartition(n)
        ids = ml.row_ids(df)
        folds, k, kind = ml.assign_folds(df.withColumn("test_id", F.lit("one")), "test_id", ml.LABEL)
        made.append((sorted(map(tuple, ids.collect())), sorted(map(tuple, folds.collect()))))
        assert len({r["_rid"] for r in ids.collect()}) == 200 and kind == "stratified"
        sizes = folds.groupBy(ml.LABEL, "fold").count().collect()
        assert max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 1 and len(sizes) == 2 * k
    assert made[0] == made[1]


def test_blend_of_members(spark):
    from veracity.operators import ml
    p = spark.createDataFrame([("x", "a", 0.2), ("x", "b", 0.8), ("y", "a", 0.4), ("y", "c", 0.9), ("z", "b", None)], "k string, model string, y_prob double")
    w = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "model string, weight double")
    got = {r["k"]: round(r["deception_probability"], 9) for r in ml.blend(p, w, ["k"]).collect()}
    assert got == {"x": 0.65, "y": 0.4}
    none = w.withColumn("weight", F.lit(0.0))
    assert round({r["k"]: r["deception_probability"] for r in ml.blend(p, none, ["k"]).collect()}["x"], 9) == 0.5


def test_replayed_batches_write_nothing_and_old_versions_go(spark, tmp_path):
    import os
    from veracity.sources import tables as TB
    log = str(tmp_path / "log")
    one = spark.createDataFrame([("2026-01-01 00:00:00", "t", "q", "lie")], "created_at string, test_id string, question_code string, expert_review string")
    two = one.withColumn("created_at", F.lit("2026-01-02 00:00:00")).withColumn("expert_review", F.lit("truth"))
    TB.upsert_feedback_log(spark, log, one, batch_id=0)
    TB.upsert_feedback_log(spark, log, two, batch_id=1)
    assert TB.upsert_feedback_log(spark, log, one, batch_id=0).first()["expert_label"] == 0
    assert TB.upsert_feedback_log(spark, log, two, batch_id=1).count() == 1 and sorted(os.listdir(log)) == ["v=0", "v=1"]
    for i in range(2, 5):
        TB.upsert_feedback_log(spark, log, two, batch_id=i)
    TB.upsert_feedback_log(spark, log, one)  # by hand: the stream's last id is kept
    assert sorted(os.listdir(log)) == ["v=3", "v=4", "v=5"]
    assert TB.upsert_feedback_log(spark, log, two, batch_id=4).first()["expert_label"] == 0 and len(os.listdir(log)) == 3


def test_questions_are_numbered_in_linear_work(spark):
    import json
    from veracity import schemas as S
    from veracity.sources import archives as A
    types = ["I", "R", "r", "zz", None]
    doc = json.dumps({"questionList": {"questions": [{"type": types[i % 5]} for i in range(10_000)]}})
    t = spark.createDataFrame([("a", doc)], "test_id string, j string").select("test_id", F.from_json("j", S.TEST_JSON).alias("t"))
    rows = A.question_map(t).orderBy("question_index").collect()
    seen, want = {}, []
    for i in range(10_000):
        k = (types[i % 5] or "UNK").upper()
        seen[k] = seen.get(k, 0) + 1
        want.append({"I": "Нв", "R": "Пв"}.get(k, k) + str(seen[k]))
    assert [r["question_code"] for r in rows] == want


def test_order_key(spark):
    """Keys order as the doubles do, tell neighbouring doubles apart and give them back."""
    import math
    import struct
    rng = np.random.default_rng(5)
    vals = [struct.unpack("d", rng.bytes(8))[0] for _ in range(4000)]
    vals += [2.0 ** e for e in range(-1074, 1024)] + [math.nextafter(2.0 ** e, 0.0) for e in range(-1073, 1024)]
    vals += [0.0, -0.0, float("inf"), float("-inf"), 1.0, math.nextafter(1.0, 2.0), -1.5, 1e-310, 1.7976931348623157e308]
    vals = [v for v in vals if not math.isnan(v)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    k = O.order_key(F.col("v"))
    rows = df.select("v", k.alias("k"), O.key_value(k).alias("b")).collect()
    assert all(r["v"] == r["b"] for r in rows)
    rows.sort(key=lambda r: r["k"])
    assert [r["v"] for r in rows] == sorted(vals)
    assert len({r["k"] for r in rows}) == len(set(vals))


def test_median_million_values(spark):
    """A million distinct values inside 1e-6 in a hot group, beside a null group, small groups, weights and NaN."""
    n = 1_000_000
    hot = spark.range(n).select(F.lit("hot").alias("g"), (1.0 + F.col("id") * 1e-12).alias("x"), F.lit(1).alias("c"))
    rest = spark.createDataFrame([(None, -3.0, 1), (None, 5.0, 2), ("w", 1.0, 3), ("w", 9.0, 2), ("e", None, 1), ("z", -0.0, 1), ("z", 0.0, 1),
                                  ("n", float("nan"), 1), ("n", 1.0, 1), ("n", 2.0, 1), ("i", float("inf"), 1)], "g string, x double, c int")
    df = hot.union(rest)
    got = {r["g"]: r["m"] for r in O.group_median(df, ["g"], "x", "m", times="c").collect()}
    want = float(np.median(1.0 + np.arange(n) * 1e-12))
    assert got == {"hot": want, None: 5.0, "w": 1.0, "z": 0.0, "n": 2.0, "i": float("inf")}
