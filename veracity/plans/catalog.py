"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB
oracles. Every query reads the driver tables (through the fixture views) in
full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..operators import direct as D
from .fixtures import fixture

DIGITS = 6


TIE_BIAS = 3e-11  # far above float noise, far below the rounding step


def rnd(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column for cross-engine comparison. Values that are
    exact decimal halves at digit ``digits+1`` would otherwise round either way
    depending on summation order; a tiny bias puts both engines on one side."""
    return df.select(*[(F.round(F.col(f.name) + TIE_BIAS, digits) + 0.0).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


ROW = ["test_id", "group_idx", "stimulus_idx"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- direct (F_STIM)
def stim(spark, sf):
    return fixture(spark, sf, "f_stim")


@register("direct_signals")
def q_direct_signals(spark, sf):
    return rnd(D.signals(stim(spark, sf)).select(*ROW, *D.SIG.values()))


def _masked(spark, sf):
    sig = D.signals(stim(spark, sf))
    return D.with_masks(sig, D.test_tiers(sig, "test_id"), "test_id")


@register("direct_robust_z")
def q_direct_robust_z(spark, sf):
    z = D.robust_z(_masked(spark, sf), "test_id")
    return rnd(z.select(*ROW, F.col("in_baseline").cast("int").alias("in_baseline"),
                        *[f"z_{c}" for c in K.CHANNELS]))


@register("direct_nearest_reference")
def q_direct_nearest_reference(spark, sf):
    n = D.nearest_reference(D.robust_z(_masked(spark, sf), "test_id"), "test_id")
    return rnd(n.select(*ROW, "ref_c_question_code", "ref_group_idx", "ref_stimulus_idx",
                        *[f"delta_{c}_vs_c" for c in K.CHANNELS]))


@register("direct_scored")
def q_direct_scored(spark, sf):
    s = D.score_direct(stim(spark, sf))
    return rnd(s.select(*ROW, "question_code", "pair_evidence", "baseline_evidence", "empirical_scaled",
                        "evidence_score", "deception_probability", "pred_label"))


@register("direct_summary")
def q_direct_summary(spark, sf):
    return rnd(D.direct_summary(D.score_direct(stim(spark, sf))))


def oracles() -> dict[str, str]:
    from .oracle_direct import direct_oracles
    from .oracle_long import long_oracles, ml_oracles, review_oracles, split_oracles
    from .oracle_verdicts import verdict_oracles
    from .oracle_metrics import metric_oracles
    from .oracle_exam import exam_oracles
    from .oracle_misc import misc_oracles
    out = exam_oracles()
    out.update(misc_oracles())
    out.update(ml_oracles())
    out.update(split_oracles())
    out.update(review_oracles())
    out.update(metric_oracles())
    out.update(verdict_oracles())
    out.update(direct_oracles())
    out.update(long_oracles())
    return out


# ---------------------------------------------------------------- features (F_LONG)
from ..operators import features as FE  # noqa: E402
from ..operators.ordered import materialize  # noqa: E402


def raw_long(spark, sf):
    return fixture(spark, sf, "f_long").drop("event_id")


def long_table(spark, sf):
    return FE.build_long(raw_long(spark, sf))


def wide_table(spark, sf):
    return FE.build_features(materialize(long_table(spark, sf)))


@register("source_union")
def q_source_union(spark, sf):
    r = raw_long(spark, sf)
    return rnd(FE.source_union(r.where("source_type = 'docx'"), r.where("source_type = 'xdex'")))


@register("question_code_fill")
def q_question_code_fill(spark, sf):
    r = raw_long(spark, sf)
    df = (r.withColumn("parameter_norm", FE.E.normalize_parameter("parameter"))
          .where(~F.col("parameter_norm").isin(*K.JUNK_PARAMETERS)))
    return FE.question_numbering(df)


@register("long_dedupe")
def q_long_dedupe(spark, sf):
    return rnd(long_table(spark, sf))


def _wide_select(spark, sf, pred):
    w = wide_table(spark, sf)
    return rnd(w.select(*FE.ID_COLS, *[c for c in w.columns if pred(c)]))


@register("feature_scores")
def q_feature_scores(spark, sf):
    return _wide_select(spark, sf, lambda c: c == "score_result")


@register("feature_meta_first")
def q_feature_meta_first(spark, sf):
    return _wide_select(spark, sf, lambda c: c in FE.META_COLS)


@register("feature_pivot")
def q_feature_pivot(spark, sf):
    return _wide_select(spark, sf, lambda c: (c.startswith("i_") or c.startswith("ii_")) and "_neutral_" not in c)


@register("feature_ratios")
def q_feature_ratios(spark, sf):
    return _wide_select(spark, sf, lambda c: c.startswith("ratio_ii_i_"))


@register("neutral_zscores")
def q_neutral_zscores(spark, sf):
    return _wide_select(spark, sf, lambda c: c.endswith(("_neutral_mean", "_neutral_std", "_vs_neutral")))


@register("surrogate_labels")
def q_surrogate_labels(spark, sf):
    return _wide_select(spark, sf, lambda c: c.startswith("label_"))


@register("type_flags")
def q_type_flags(spark, sf):
    return _wide_select(spark, sf, lambda c: c.startswith("is_") and c.endswith("_q"))


@register("feature_column_stats")
def q_feature_column_stats(spark, sf):
    return FE.feature_column_stats(wide_table(spark, sf), "label_bootstrap")


@register("top_channels")
def q_top_channels(spark, sf):
    return rnd(FE.top_channels(wide_table(spark, sf)).withColumn("rank", F.col("rank").cast("int")))


# ---------------------------------------------------------------- verdicts (F_STIM)
from ..operators import verdicts as V  # noqa: E402
from ..functions import exprs as E  # noqa: E402


def collapsed(spark, sf):
    return V.collapse_questions(D.score_direct(stim(spark, sf)), threshold=K.DIRECT_LABEL_THRESHOLD)


@register("question_collapse")
def q_question_collapse(spark, sf):
    return rnd(collapsed(spark, sf))


@register("question_votes")
def q_question_votes(spark, sf):
    return rnd(V.question_votes(collapsed(spark, sf), K.DIRECT_LABEL_THRESHOLD))


@register("verdict_blend")
def q_verdict_blend(spark, sf):
    scored = materialize(D.score_direct(stim(spark, sf)))  # read by the summary and the vote branch
    q = V.collapse_questions(scored, threshold=K.DIRECT_LABEL_THRESHOLD)
    return rnd(V.blend_verdicts(D.direct_summary(scored), V.question_votes(q, K.DIRECT_LABEL_THRESHOLD)))


@register("melt_channels")
def q_melt_channels(spark, sf):
    return rnd(V.melt_channels(stim(spark, sf)))


@register("degenerate_flag")
def q_degenerate_flag(spark, sf):
    return rnd(V.degenerate_flag(collapsed(spark, sf)))


@register("prob_diagnostics")
def q_prob_diagnostics(spark, sf):
    return rnd(V.prob_diagnostics(collapsed(spark, sf)))


@register("chart_points")
def q_chart_points(spark, sf):
    return rnd(V.chart_points(collapsed(spark, sf)))


# ---------------------------------------------------------------- string/scalar expressions
SCORE_JSON = """SELECT event_id,
 '{"isManuallyChanged": ' || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END
 || ', "manualValue": ' || CASE WHEN k % 6 = 0 THEN '"n/a"' ELSE '"' || CAST(k AS VARCHAR(20)) || '.5"' END
 || CASE WHEN k % 4 = 0 THEN '' ELSE ', "autoValue": ' || CAST(k % 50 AS VARCHAR(20)) END
 || CASE WHEN k % 5 = 0 THEN ', "value": "' || CAST(k AS VARCHAR(20)) || '"' ELSE '' END
 || ', "automaticScorePoints": [{"value": ' || CAST(k % 10 AS VARCHAR(20)) || '}, {"value": "x"}, {"value": "'
 || CAST(k % 7 AS VARCHAR(20)) || '.25"}]}' AS score_json
FROM ev"""

EXPECTED_SQL = """SELECT event_id, CASE k % 5 WHEN 0 THEN ' YES ' WHEN 1 THEN 'no' WHEN 2 THEN 'No ' WHEN 3 THEN 'maybe' END
 AS waiting_answer_raw FROM ev"""


def _ev_sql(spark, sf, body):
    from .fixtures import EV_SPARK, table
    body = body.replace("{", "{{").replace("}", "}}")  # literal braces survive spark.sql formatting
    return spark.sql(f"WITH ev AS ({EV_SPARK}) {body}", events=table(spark, sf, "events"))


@register("score_precedence")
def q_score_precedence(spark, sf):
    from ..schemas import SCORE_OBJECT
    df = _ev_sql(spark, sf, SCORE_JSON)
    return rnd(df.select("event_id", E.score_value(F.from_json("score_json", SCORE_OBJECT)).alias("score_value")))


@register("expected_answer")
def q_expected_answer(spark, sf):
    df = _ev_sql(spark, sf, EXPECTED_SQL)
    ea = E.expected_answer("waiting_answer_raw")
    return df.select("event_id", "waiting_answer_raw", ea["label"].alias("waiting_answer_label"),
                     ea["ru"].alias("waiting_answer_ru"))


@register("proxy_score")
def q_proxy_score(spark, sf):
    return rnd(stim(spark, sf).select(*ROW, E.proxy_score().alias("proxy_score")))


@register("recommendation_bands")
def q_recommendation_bands(spark, sf):
    s = D.score_direct(stim(spark, sf))
    g = s.groupBy("test_id").agg(
        F.avg(F.when(F.col("allowed") & (F.col("q_type") == "R"), F.col("deception_probability"))).alias("score"))
    return rnd(g.select("test_id", "score",
                        E.recommend("score", *K.ML_BANDS).alias("recommendation_ml"),
                        E.recommend("score", *K.DIRECT_BANDS).alias("recommendation_direct"),
                        E.recommend("score", *K.DIRECT_BANDS, missing=K.REC_INSUFFICIENT).alias("recommendation_vote")))


# ---------------------------------------------------------------- metrics (F_PRED)
from ..operators import metrics as M  # noqa: E402

FOLD_METRICS = ["f1", "pr_auc", "brier", "ece", "accuracy", "precision", "recall"]


def pred(spark, sf):
    return fixture(spark, sf, "f_pred").withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int"))


@register("binary_metrics")
def q_binary_metrics(spark, sf):
    return rnd(M.binary_metrics(pred(spark, sf), by=["model", "fold"]))


@register("brier_ece")
def q_brier_ece(spark, sf):
    return rnd(M.brier_ece(pred(spark, sf), by=["model", "fold"]))


@register("average_precision")
def q_average_precision(spark, sf):
    return rnd(M.average_precision(pred(spark, sf), by=["model", "fold"]))


@register("roc_auc")
def q_roc_auc(spark, sf):
    return rnd(M.roc_auc(pred(spark, sf), by=["model", "fold"]))


@register("fold_ci")
def q_fold_ci(spark, sf):
    folds = M.eval_metrics(pred(spark, sf), by=["model", "fold"])
    return rnd(M.fold_ci(folds, FOLD_METRICS, by=["model"]))


@register("source_breakdown")
def q_source_breakdown(spark, sf):
    return rnd(M.eval_metrics(pred(spark, sf), by=["model", "source_type"]))


@register("best_threshold")
def q_best_threshold(spark, sf):
    return rnd(M.best_threshold(pred(spark, sf), by=["model"]))


def model_table(spark, sf):
    """Per-model comparison row: folds 1-4 are development, fold 0 is holdout."""
    p = pred(spark, sf)
    dev, hold = p.where("fold <> 0"), p.where("fold = 0")
    bt = M.best_threshold(dev, by=["model"]).withColumnRenamed("f1", "cv_f1_opt")
    ap = M.average_precision(dev, by=["model", "fold"]).groupBy("model").agg(F.avg("pr_auc").alias("cv_pr_auc"))
    h = hold.join(bt.select("model", "threshold"), "model").withColumn(
        "y_pred_t", (F.col("y_prob") >= F.col("threshold")).cast("int"))
    hf = M.binary_metrics(h, pred="y_pred_t", by=["model"]).select("model", F.col("f1").alias("holdout_f1"))
    return bt.join(ap, "model", "left").join(hf, "model", "left")


@register("model_ranking")
def q_model_ranking(spark, sf):
    return rnd(M.rank_models(model_table(spark, sf)))


@register("ensemble_members")
def q_ensemble_members(spark, sf):
    return rnd(M.ensemble_members(M.rank_models(model_table(spark, sf))))


@register("class_counts")
def q_class_counts(spark, sf):
    return M.class_counts(pred(spark, sf), by=["model"])


# ---------------------------------------------------------------- feedback (F_FB)
from ..operators import feedback as FB  # noqa: E402


def fb(spark, sf):
    return fixture(spark, sf, "f_fb")


@register("review_labels")
def q_review_labels(spark, sf):
    return FB.with_review_labels(fb(spark, sf)).drop("created_at")


@register("feedback_latest")
def q_feedback_latest(spark, sf):
    return FB.latest_feedback(FB.with_review_labels(fb(spark, sf))).drop("created_at")


@register("feedback_overlay")
def q_feedback_overlay(spark, sf):
    latest = FB.latest_feedback(FB.with_review_labels(fb(spark, sf)))
    o = FB.overlay(wide_table(spark, sf), latest)
    return o.select(*FE.ID_COLS, "label_bootstrap", "label_expert", "label_train", "label_source_train")


# ---------------------------------------------------------------- document cells (F_CELLS)
from ..operators import cells as CE  # noqa: E402


def cells(spark, sf):
    return fixture(spark, sf, "f_cells")


@register("cell_numbers")
def q_cell_numbers(spark, sf):
    c = cells(spark, sf)
    return rnd(c.select("doc", "row_no", E.to_float("cell_i").alias("metric_i"),
                        E.to_float("cell_result").alias("score_result")))


@register("question_split")
def q_question_split(spark, sf):
    c = cells(spark, sf)
    p = E.question_parts(F.col("cell_question"))
    return c.select("doc", "row_no", "cell_question", p["code"].alias("question_code"),
                    p["text"].alias("question_text"), p["type"].alias("question_type"))


@register("carry_forward")
def q_carry_forward(spark, sf):
    return rnd(CE.interpret_rows(cells(spark, sf)))


# ---------------------------------------------------------------- models (F_ML = wide F_LONG, label_bootstrap)
from ..operators import ml as ML  # noqa: E402
from . import jobs as J  # noqa: E402

ML_LABEL = "label_bootstrap"


def ml_rows(spark, sf):
    w = wide_table(spark, sf)
    cols = FE.select_feature_columns(w, ML_LABEL)
    lab = w.where(F.col(ML_LABEL).isNotNull()).withColumn(ML.LABEL, F.col(ML_LABEL).cast("int"))
    return materialize(ML.feature_matrix(lab, cols)), cols


@register("group_folds")
def q_group_folds(spark, sf):
    rows, _ = ml_rows(spark, sf)
    out, _, _ = ML.assign_folds(rows, "test_id", ML.LABEL)
    return out.select(*FE.ID_COLS, "fold")


@register("group_holdout")
def q_group_holdout(spark, sf):
    rows, _ = ml_rows(spark, sf)
    return ML.group_holdout(rows, "test_id", ML.LABEL).select(*FE.ID_COLS, "split")


@register("impute_scale")
def q_impute_scale(spark, sf):
    rows, cols = ml_rows(spark, sf)
    return rnd(ML.fit_impute_scale(rows, cols))


def _fit_predict(spark, sf, spec):
    rows, cols = ml_rows(spark, sf)
    f = ML.fit(spec, rows, cols)
    return rnd(ML.predict_proba(f, rows, "deception_probability").select(*FE.ID_COLS, "deception_probability"))


@register("train_logreg")
def q_train_logreg(spark, sf):
    return _fit_predict(spark, sf, ML.build_models()[0])


@register("train_forests")
def q_train_forests(spark, sf):
    return _fit_predict(spark, sf, ML.build_models()[1])


@register("train_extra_trees")
def q_train_extra_trees(spark, sf):
    return _fit_predict(spark, sf, ML.build_models()[2])


def member_weights(spark, sf):
    return M.ensemble_members(M.rank_models(model_table(spark, sf))).select("model", "weight")


@register("ensemble_blend")
def q_ensemble_blend(spark, sf):
    one = pred(spark, sf).groupBy("test_id", "fold", "model").agg(F.avg("y_prob").alias("y_prob"))
    return rnd(ML.blend(one, member_weights(spark, sf), ["test_id", "fold"]))


@register("ml_summary")
def q_ml_summary(spark, sf):
    return rnd(J.ml_summary(pred(spark, sf).withColumnRenamed("y_prob", "deception_probability")))


@register("explain_table")
def q_explain_table(spark, sf):
    return rnd(V.explain_table(D.score_direct(stim(spark, sf)), ROW))


@register("feedback_upsert")
def q_feedback_upsert(spark, sf):
    import uuid
    from ..session import ensure_checkpoint_dir
    from ..sources import tables as TB
    log, rows = f"{ensure_checkpoint_dir(spark)}/feedback-{uuid.uuid4().hex}", fb(spark, sf)
    late = F.dayofmonth("created_at") % 2 == 0  # two batches that reach back into each other's time
    for i, part in enumerate((rows.where(late), rows.where(~late), rows.where(~late))):
        out = TB.upsert_feedback_log(spark, log, part, batch_id=min(i, 1))  # the last one is played again
    return out.select("test_id", "question_code", "expert_review", F.col("expert_label").cast("int").alias("expert_label"))


@register("upload_adapter")
def q_upload_adapter(spark, sf):
    """The long records written as uploads with two headers, read back by the folder scan."""
    import uuid
    from ..session import ensure_checkpoint_dir
    from ..sources import tables as TB
    folder, raw = f"{ensure_checkpoint_dir(spark)}/uploads-{uuid.uuid4().hex}", raw_long(spark, sf)
    docx = F.col("source_type").eqNullSafe("docx")
    plain = raw.where(docx).selectExpr("metric_ii AS II", "parameter", "question_raw", "test_id", "metric_i AS I", "score_result AS `Результат`",
                                       "source_file")
    full = raw.where(~docx).selectExpr("question_raw AS Question_Raw", "parameter AS PARAMETER", "metric_i", "metric_ii", "score_result AS score",
                                       *[c for c in raw.columns if c not in ("question_raw", "parameter", "metric_i", "metric_ii", "score_result")])
    for name, part in (("plain", plain), ("full", full)):
        (part.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}"))
    return rnd(TB.upload_long(*TB.scan_uploads(spark, folder)))


@register("analyze_route")
def q_analyze_route(spark, sf):
    raw = raw_long(spark, sf)
    return raw.groupBy("test_id").agg(F.count(F.lit(1)).alias("n_records")).join(
        J.model_route(raw.where("metric_ii > 60")).withColumn("method", F.lit("model_metrics")), "test_id", "left").fillna(
            D.K.DIRECT_METHOD, ["method"])


@register("review_defaults")
def q_review_defaults(spark, sf):
    w = wide_table(spark, sf).withColumn("pred_label", F.col("label_weak"))
    return V.review_sheet(w).select("test_id", "question_code", "question_raw", "question_type", "pred_label",
                                    "expert_review")


# ---------------------------------------------------------------- archives (F_EXAM as nested JSON)
from ..sources import archives as A  # noqa: E402
from .fixtures import exam_scan  # noqa: E402


def exams(spark, sf):
    return A.parsed_json(exam_scan(spark, sf))


@register("question_codes")
def q_question_codes(spark, sf):
    return A.question_map(exams(spark, sf))


@register("exam_manifest")
def q_exam_manifest(spark, sf):
    return A.question_map(exams(spark, sf), manifest=True)


@register("stimuli")
def q_stimuli(spark, sf):
    return rnd(A.stimuli(exams(spark, sf)))


@register("structure_stats")
def q_structure_stats(spark, sf):
    return A.structure_stats(exams(spark, sf))


@register("exam_overview")
def q_exam_overview(spark, sf):
    _, s = A.exam_overview(exams(spark, sf))
    pairs = F.array_sort(F.transform(F.map_entries("question_types"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return s.withColumns({"question_types": F.array_join(pairs, ";"), "channels_raw": F.array_join("channels_raw", ";"),
                          "channels_pretty": F.array_join("channels_pretty", ";")})


@register("attach_expected")
def q_attach_expected(spark, sf):
    pred = fixture(spark, sf, "f_exam").select(
        "test_id", F.concat(F.lit("Пв"), (F.col("rn") % 6).cast("string")).alias("question_code"), "rn")
    return V.attach_expected(pred, A.question_map(exams(spark, sf), manifest=True))
