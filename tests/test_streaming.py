"""Drop-folder streams (STR1, STR2) with availableNow triggers."""

import os

from archives import score, xdex_json
from veracity.plans import jobs as J
from veracity.streaming import streams as ST


def _test(n_r):
    qs = [{"type": "I", "contents": [{"text": "n"}]}, {"type": "R", "contents": [{"text": "r"}]},
          {"type": "C", "contents": [{"text": "c"}]}]
    stims = [{"questionIndex": i % 3, "analysisInterval": {"isEmpty": False},
              "scores": {"A_BV": score(auto=str((i * 7 + n_r) % 5 - 2)), "A_EDA": score(auto=(i * 3 + n_r) % 4),
                         "A_PLE": score(auto=i % 3), "A_ARLENGTH": score(auto=(i + n_r) % 6)}} for i in range(9)]
    return {"questionList": {"questions": qs}, "stimulusGroups": [{"stimuli": stims}]}


def test_stream_scores_matches_batch(spark, tmp_path):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    for i in range(3):
        xdex_json(drop / f"t{i}.xdex", _test(i))
    q = ST.stream_scores(spark, str(drop), str(out), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(300)
    got = {r.test_id: (r.overall_score, r.recommendation) for r in ST.read_stream_output(spark, str(out)).collect()}
    _, summ = J.analyze(spark, str(drop))
    exp = {r.test_id: (r.overall_score, r.recommendation) for r in summ.collect()}
    assert set(got) == {"t0", "t1", "t2"} == set(exp)
    for k in exp:
        assert abs(got[k][0] - exp[k][0]) < 1e-12 and got[k][1] == exp[k][1]
    # a second run with no new files processes nothing and keeps the output
    q2 = ST.stream_scores(spark, str(drop), str(out), checkpoint=str(tmp_path / "ck"))
    q2.awaitTermination(120)
    assert ST.read_stream_output(spark, str(out)).count() == 3


def test_stream_feedback_latest_wins(spark, tmp_path):
    drop, log = tmp_path / "fb", tmp_path / "log"
    drop.mkdir()
    hdr = "created_at,test_id,question_code,question_raw,question_type,deception_probability,pred_label,expert_review,expert_label\n"
    (drop / "a.csv").write_text(hdr + "2024-01-01T00:00:00,T1,c1,,,,,Ложь,\n2024-01-01T00:00:05,T1,c2,,,,,unsure,\n")
    q = ST.stream_feedback(spark, str(drop), str(log), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    (drop / "b.csv").write_text(hdr + "2024-01-02T00:00:00,T1,c1,,,,,truth,\n2023-12-31T00:00:00,T1,c1,,,,,yes,\n")
    q = ST.stream_feedback(spark, str(drop), str(log), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    df = spark.read.parquet(str(log))
    last = df.agg({"v": "max"}).first()[0]
    rows = {(r.test_id, r.question_code): r.expert_label for r in df.where(df.v == last).collect()}
    assert rows == {("T1", "c1"): 0}
    assert sorted(os.listdir(log))[:2] == ["v=0", "v=1"]
