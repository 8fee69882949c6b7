"""Upload folder: tables with different headers side by side, up to verdicts."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from veracity.operators import ml as ML
from veracity.plans import jobs as J
from veracity.sources import tables as TB


def _folder(root):
    (root / "deep").mkdir()
    (root / "wide.csv").write_text("test_id,i_eda,ii_eda,question_code\nw1,0.5,-1,Пв1\nw1,2,,Пв2\n")
    (root / "short wide+1.csv").write_text("i_eda\n-3\n")
    (root / "deep" / "exam.one.csv").write_text('\ufeffquestion_raw,parameter,I,II,Результат\n"Пв1 a, ""b""\nc",EDA,1.5,2,0.7\nНв2 n,EDA,x,3\n')
    (root / "deep" / "cased.csv").write_text("Parameter,QUESTION_RAW,metric_i,i,test_id,source_type,is_allowed,test_id\nPLE,Пв1 q,4,9,t7,own,true,t8\n"
                                             "PLE,,5,9,,own,maybe,t8,extra\n")
    (root / "other.csv").write_text("a,b\n1,2\n")
    (root / "void.csv").write_text("question_raw,parameter,I\nq,EDA,none\n")
    (root / "head.csv").write_text("question_raw,parameter,I\n")
    (root / "empty.csv").write_text("")
    (root / "note.txt").write_text("question_raw,parameter,I\nq,EDA,1\n")
    return str(root)


def test_scan_of_mixed_layouts(spark, tmp_path):
    files, rows = TB.scan_uploads(spark, _folder(tmp_path))
    got = {r["source_file"]: (r["layout"], r["n_rows"], r["error"]) for r in files.collect()}
    assert got == {"wide.csv": ("wide", 2, None), "short wide+1.csv": ("wide", 1, None), "exam.one.csv": ("long", 2, None),
                   "cased.csv": ("long", 2, None), "other.csv": ("unsupported", 1, TB.UNSUPPORTED),
                   "void.csv": ("long", 1, TB.NO_METRICS), "head.csv": ("long", 0, TB.NO_METRICS)}
    long = sorted((tuple(r) for r in TB.upload_long(files, rows).collect()), key=lambda r: (r[0], r[13]or 0, r[14] or 0))
    a = 'Пв1 a, "b"\nc'
    assert long == [
        ("cased.csv", "own", "t7", "Пв1 q", "Пв1 q", "Пв1 q", None, "other", True, None, None, None, "PLE", 4.0, None, None),
        ("cased.csv", "own", None, None, None, None, None, "other", None, None, None, None, "PLE", 5.0, None, None),
        ("exam.one.csv", "upload", "exam.one", "Нв2 n", "Нв2 n", "Нв2 n", None, "other", None, None, None, None, "EDA", None, 3.0, None),
        ("exam.one.csv", "upload", "exam.one", a, a, a, None, "other", None, None, None, None, "EDA", 1.5, 2.0, 0.7)]
    wide = sorted((tuple(r) for r in TB.upload_wide(rows, ["test_id", "question_code"], ["i_eda", "ii_eda"]).collect()), key=str)
    assert wide == [("short wide+1", None, -3.0, None), ("w1", "Пв1", 0.5, -1.0), ("w1", "Пв2", 2.0, None)]


def test_scan_agrees_with_the_adapter(spark, tmp_path):
    """A file read on its own and through the folder gives the same records."""
    folder = _folder(tmp_path)
    one = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{folder}/deep/exam.one.csv")
    want, kind = TB.adapt_upload(one, "exam.one.csv")
    files, rows = TB.scan_uploads(spark, folder)
    got = TB.upload_long(files, rows).where("source_file = 'exam.one.csv'")
    assert kind == "long" and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_driver_headers(spark, tmp_path):
    """Many layouts are one plan: two scans of the files, however many headers there are."""
    for i in range(60):
        (tmp_path / f"f{i}.csv").write_text(f"x{i},question_raw,parameter,I\n1,q{i},EDA,{i}\n")
    files, rows = TB.scan_uploads(spark, str(tmp_path))
    long = TB.upload_long(files, rows)
    assert sorted(r["metric_i"] for r in long.collect()) == [float(i) for i in range(60)]
    assert len(str(long._jdf.queryExecution().optimizedPlan()).split("Relation [")) <= 8


def test_folder_to_verdicts(spark, tmp_path):
    rng = np.random.default_rng(2)
    n = 80
    pdf = pd.DataFrame({"i_eda": rng.normal(size=n), "ii_eda": rng.normal(size=n)})
    pdf["_label"] = (pdf.i_eda > 0).astype(int)
    cols = ["i_eda", "ii_eda"]
    f = ML.fit(ML.build_models()[0], spark.createDataFrame(pdf), cols)
    summary, per_q, files = J.score_upload_folder(spark, _folder(tmp_path), [(f, 1.0)], 0.5, cols)
    s = {r["test_id"]: r for r in summary.collect()}
    assert s["w1"]["n_items"] == 2 and s["short wide+1"]["n_items"] == 1 and s["exam.one"]["n_items"] == 2
    assert s["short wide+1"]["overall_score"] < 0.5 and all(0 <= r["overall_score"] <= 1 for r in s.values())
    rows = {(r["test_id"], r["question_code"]): r["deception_probability"] for r in per_q.collect()}
    assert rows["w1", "Пв2"] > 0.5 and ("exam.one", "Нв2 n") in rows
    assert files.where(F.col("error").isNotNull()).count() == 3


def test_empty_folder(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    files, rows = TB.scan_uploads(spark, str(tmp_path))
    assert files.count() == 0 and TB.upload_long(files, rows).count() == 0 and TB.upload_wide(rows, ["test_id"], ["i_eda"]).count() == 0
