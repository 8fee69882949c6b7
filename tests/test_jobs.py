"""End-to-end jobs on a generated corpus: preprocess -> train -> bundle ->
predict, and per-test routing between the model and the direct path."""

import random

from archives import docx, score, xdex_json
from veracity.plans import jobs as J


def _corpus(root):
    rnd = random.Random(5)
    dx, xd = root / "docx", root / "xdex"
    dx.mkdir()
    xd.mkdir()
    for t in range(10):
        rows = [["Вопрос", "Параметр", "I", "II", "Результат"]]
        for q in range(6):
            lie = (q + t) % 2
            code = ["Нв", "Пв", "Вл"][q % 3] + str(q + 1)
            res = f"{0.8 if lie else 0.2:.1f}".replace(".", ",")
            for ch in ["КГР", "АД", "ДЫХАНИЕ", "ПГ"]:
                base = 3.0 if lie else 1.0
                rows.append([f"{code} вопрос {q}" if ch == "КГР" else "", ch,
                             f"{base + rnd.random():.2f}".replace(".", ","), f"{base * 2 + rnd.random():.2f}".replace(".", ","),
                             res if ch == "КГР" else ""])
        docx(dx / f"exam_{t}.docx", [rows])
    qs = [{"type": ty, "contents": [{"text": f"q{i}", "waitingAnswer": "no" if ty == "R" else "yes"}]}
          for i, ty in enumerate(["I", "R", "C", "R", "C", "I"])]
    for t in range(3):
        stims = [{"questionIndex": i % 6, "analysisInterval": {"isEmpty": False},
                  "scores": {"A_BV": score(auto=str((i * 3 + t) % 5 - 2)), "A_EDA": score(auto=(i + t) % 4),
                             "A_PLE": score(auto=i % 3)}} for i in range(12)]
        xdex_json(xd / f"j{t}.xdex", {"questionList": {"questions": qs}, "stimulusGroups": [{"stimuli": stims}]})
    return str(dx), str(xd)


def test_pipeline_bundle_predict_analyze(spark, tmp_path):
    dx, xd = _corpus(tmp_path)
    out = str(tmp_path / "run")
    res = J.run_pipeline(spark, dx, xd, out, trees_scale=0.02, model_names=["logreg", "random_forest"])
    comp = res["comparison"].orderBy("rank").collect()
    assert [r.rank for r in comp] == [1, 2] and all(0 <= r.threshold <= 1 for r in comp)
    assert 1 <= len(res["members"]) <= 2
    preds = res["predictions"]
    assert preds.count() == spark.read.parquet(f"{out}/processed/features").where("label_bootstrap IS NOT NULL").count()
    assert set(r.split for r in preds.select("split").distinct().collect()) == {"dev", "holdout"}
    pred, summ = J.predict_job(spark, spark.read.parquet(f"{out}/processed/features"), f"{out}/model")
    p = [r.deception_probability for r in pred.collect()]
    assert all(0.0 <= x <= 1.0 for x in p) and len(p) > 0
    assert summ.count() == 13  # 10 docx + 3 json tests
    from veracity.operators import ml as ML
    bundle = ML.load_bundle(f"{out}/model")
    q, s = J.analyze(spark, xd, bundle)
    methods = {r.test_id: r.method for r in s.collect()}
    assert set(methods) == {"j0", "j1", "j2"}
    assert set(methods.values()) == {"model_metrics"}   # json tests melt into usable I metrics
    q2, s2 = J.analyze(spark, xd)
    assert {r.method for r in s2.collect()} == {"xdex_direct_scoring_v2_pairwise"}
