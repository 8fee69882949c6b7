"""Composite jobs (JOB1-JOB9) built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from ..operators import direct as D
from ..operators import features as FE
from ..operators import feedback as FB
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import verdicts as V
from ..operators.ordered import materialize
from ..sources import archives as A
from ..sources import tables as TB


# ---------------------------------------------------------------- JOB1 / JOB5
def run_preprocess(spark: SparkSession, docx_dir: str | None, xdex_dir: str | None, out_dir: str | None = None,
                   weak_threshold: float = K.WEAK_LABEL_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Corpus -> long and wide tables (optionally written as parquet, with the unreadable files in ``quarantine``)."""
    raw = A.load_raw(spark, docx_dir, xdex_dir, quarantine=f"{out_dir}/quarantine" if out_dir else None)
    long = materialize(FE.build_long(raw))
    wide = FE.build_features(long, weak_threshold)
    if out_dir:
        TB.write_table(long, f"{out_dir}/long", partition_by=["source_type"])
        TB.write_table(wide, f"{out_dir}/features", partition_by=["source_type"])
    return long, wide


# ---------------------------------------------------------------- JOB2 / JOB8
def prepare_training(features: DataFrame, label: str | None = None, feedback: DataFrame | None = None) -> tuple[DataFrame, str]:
    df = features
    if "label_train" not in df.columns:
        base = next((c for c in ("label_bootstrap", "label_weak", "label") if c in df.columns), None)
        if base:
            df = df.withColumn("label_train", F.col(base).cast("int"))
    if "label_source_train" not in df.columns:
        df = df.withColumn("label_source_train", F.col("label_source") if "label_source" in df.columns else F.lit("missing"))
    if feedback is not None:
        df = FB.overlay(df, FB.latest_feedback(feedback))
    label_col = FE.detect_label_column(df.columns, label or ("label_train" if "label_train" in df.columns else None))
    return df, label_col


def train(features: DataFrame, label: str | None = None, feedback: DataFrame | None = None, seed: int = 42,
          trees_scale: float = 1.0, model_names: list[str] | None = None, out_dir: str | None = None) -> dict:
    """JOB2: holdout split, group CV per model, OOF threshold, refit, ranking,
    weighted ensemble of the close best, predictions for every labelled row."""
    df, label_col = prepare_training(features, label, feedback)
    cols = FE.select_feature_columns(df, label_col)
    if not cols:
        raise ValueError("No numeric feature columns were found for training.")
    work = df.where(F.col(label_col).isNotNull()).withColumn(ML.LABEL, F.col(label_col).cast("int"))
    if "source_type" not in work.columns:
        work = work.withColumn("source_type", F.lit("unknown"))
    if work.select(ML.LABEL).distinct().count() < 2:
        raise ValueError("Training requires at least two classes in labels.")
    work = materialize(ML.group_holdout(ML.feature_matrix(work, cols), "test_id", ML.LABEL, seed=seed))
    dev, hold = work.where("split = 'dev'"), work.where("split = 'holdout'")
    dev, k, kind = ML.assign_folds(dev, "test_id", ML.LABEL, seed=seed)
    dev = materialize(ML.row_ids(dev))
    n_dev, n_hold = dev.count(), hold.count()
    specs = [s for s in ML.build_models(trees_scale, seed) if model_names is None or s.name in model_names]
    rows, folds_all, breakdown, fitted, oofs = [], [], [], {}, {}
    for spec in specs:
        oof, folds = ML.cross_validate(spec, dev, cols, seed)
        oof = materialize(oof)
        bt = M.best_threshold(oof, y=ML.LABEL, prob="oof").first()
        thr, f1opt = float(bt["threshold"]), float(bt["f1"])
        oof = oof.withColumn("oof_pred_t", (F.col("oof") >= thr).cast("int"))
        f = ML.fit(spec, dev, cols, seed)
        tp = ML.predict_proba(f, dev, "p").withColumn("pred", (F.col("p") >= thr).cast("int"))
        train_m = M.binary_metrics(tp, y=ML.LABEL, pred="pred").first().asDict()
        train_m["roc_auc"] = M.roc_auc(tp.withColumn("_all", F.lit(0)), y=ML.LABEL, prob="p", by=["_all"]).first()["roc_auc"]
        hp = ML.predict_proba(f, hold, "p").withColumn("pred", (F.col("p") >= thr).cast("int"))
        hm = M.eval_metrics(hp, y=ML.LABEL, pred="pred", prob="p").first().asDict()
        ci = {r["metric"]: r for r in M.fold_ci(folds, FOLD_METRICS).collect()}
        row = {"model": spec.name, "n_samples_dev": n_dev, "n_samples_holdout": n_hold, "n_features": len(cols),
               "threshold": thr, "cv_f1_opt": f1opt,
               "oof_prob_std": oof.agg(F.stddev_pop("oof")).first()[0], "cv_folds": k, "cv_kind": kind}
        for m in FOLD_METRICS:
            r = ci.get(m)
            row.update({f"cv_{m}": r and r["mean"], f"cv_{m}_std": r and r["std"],
                        f"cv_{m}_ci_low": r and r["ci_low"], f"cv_{m}_ci_high": r and r["ci_high"]})
        row.update({f"train_{m}": train_m.get(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")})
        row.update({f"holdout_{m}": hm.get(m) for m in ("accuracy", "precision", "recall", "f1", "brier", "ece", "pr_auc")})
        rows.append(row)
        folds_all.append(folds)
        breakdown += [_breakdown(oof, "oof", "oof_pred_t", spec.name, "cv_oof"), _breakdown(hp, "p", "pred", spec.name, "holdout")]
        fitted[spec.name] = f
        oofs[spec.name] = oof
    spark = features.sparkSession
    comparison = M.rank_models(_table(spark, rows))
    members = M.ensemble_members(comparison).collect()
    chosen = [(fitted[r["model"]], float(r["weight"]), float(r["threshold"])) for r in members]
    ens_thr = float(members[0]["ensemble_threshold"])
    # ensemble diagnostics on the out-of-fold probabilities (rows aligned by _rid) and on the holdout
    total_w = sum(w for _, w, _ in chosen)
    ens_oof = None
    for (f, w, _), r in zip(chosen, members):
        o = oofs[r["model"]].select("_rid", "source_type", ML.LABEL, (F.col("oof") * w).alias("_wp"))
        ens_oof = o if ens_oof is None else ens_oof.join(o.select("_rid", F.col("_wp").alias("_wp2")), "_rid").select(
            "_rid", "source_type", ML.LABEL, (F.col("_wp") + F.col("_wp2")).alias("_wp"))
    ens_oof = ens_oof.withColumn("p", F.col("_wp") / total_w).withColumn("pred", (F.col("p") >= ens_thr).cast("int"))
    ens_hold = ML.ensemble_probability([(f, w) for f, w, _ in chosen], hold, "test_id", "p").withColumn(
        "pred", (F.col("p") >= ens_thr).cast("int"))
    breakdown += [_breakdown(ens_oof, "p", "pred", "ensemble", "cv_oof"), _breakdown(ens_hold, "p", "pred", "ensemble", "holdout")]
    diagnostics = {"ensemble_cv_oof": M.eval_metrics(ens_oof, y=ML.LABEL, pred="pred", prob="p").first().asDict(),
                   "ensemble_holdout": M.eval_metrics(ens_hold, y=ML.LABEL, pred="pred", prob="p").first().asDict()}
    preds = ML.ensemble_probability([(f, w) for f, w, _ in chosen], work, "test_id")
    preds = preds.withColumn("pred_label", (F.col("deception_probability") >= ens_thr).cast("int"))
    folds_df = folds_all[0]
    for x in folds_all[1:]:
        folds_df = folds_df.unionByName(x)
    bd = breakdown[0]
    for x in breakdown[1:]:
        bd = bd.unionByName(x)
    best = comparison.where("rank = 1").first()["model"]
    importance = spark.createDataFrame(ML.feature_importance(fitted[best]), "feature string, importance double")
    out = {"comparison": comparison, "folds": folds_df, "breakdown": bd, "predictions": preds, "importance": importance,
           "members": members, "threshold": ens_thr, "feature_cols": cols, "label_col": label_col, "fitted": chosen,
           "diagnostics": diagnostics}
    if out_dir:
        ML.save_bundle(f"{out_dir}/model", chosen, cols, label_col, ens_thr)
        for name in ("comparison", "folds", "breakdown", "importance"):
            TB.write_table(out[name], f"{out_dir}/reports/{name}")
        TB.write_table(preds.select("test_id", "question_code", "source_type", ML.LABEL, "split", "deception_probability",
                                    "pred_label"), f"{out_dir}/reports/predictions_train")
    return out


FOLD_METRICS = ["f1", "pr_auc", "brier", "ece", "accuracy", "precision", "recall"]


def _table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Small per-model table with an explicit schema (no inference on NULLs)."""
    from pyspark.sql import types as T
    strings, longs = {"model", "cv_kind"}, {"n_samples_dev", "n_samples_holdout", "n_features", "cv_folds"}
    keys = list(rows[0])
    schema = T.StructType([T.StructField(k, T.StringType() if k in strings else T.LongType() if k in longs
                                         else T.DoubleType()) for k in keys])
    conv = [tuple(r[k] if k in strings else (None if r[k] is None else int(r[k]) if k in longs else float(r[k]))
                  for k in keys) for r in rows]
    return spark.createDataFrame(conv, schema)


def _breakdown(df: DataFrame, prob: str, pred: str, model: str, split: str) -> DataFrame:
    """AGG19: metrics per source type (NULL source kept as its own group)."""
    return (M.eval_metrics(df, y=ML.LABEL, pred=pred, prob=prob, by=["source_type"])
            .withColumn("model", F.lit(model)).withColumn("eval_split", F.lit(split)))


def predict(features: DataFrame, members: list, threshold: float, cols: list[str]) -> DataFrame:
    """JOB3 / ML17: ensemble probability + label for every feature row."""
    p = ML.ensemble_probability(members, features, "test_id")
    return p.withColumn("pred_label", (F.col("deception_probability") >= threshold).cast("int"))


def ml_summary(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG8 (model flavour): mean probability, bands .60/.40, item count."""
    by = ["test_id"] if by is None else by
    g = pred.groupBy(*by).agg(F.avg("deception_probability").alias("overall_score"), F.count(F.lit(1)).alias("n_items"))
    return g.withColumn("recommendation", E.recommend("overall_score", *K.ML_BANDS))


# ---------------------------------------------------------------- JOB4 / JOB6 / JOB7 / JOB9
def score_direct_corpus(spark: SparkSession, xdex_dir: str) -> tuple[DataFrame, DataFrame]:
    """JOB4 over a folder of archives: scored stimuli + per-test summary."""
    st = A.stimuli(A.parsed_json(A.parsed_once(A.scan_xdex(spark, xdex_dir))))
    scored = D.score_direct(st)
    return scored, D.direct_summary(scored)


def analyze(spark: SparkSession, xdex_dir: str, bundle: tuple | None = None) -> tuple[DataFrame, DataFrame]:
    """JOB7: a route is decided for every test before anything is scored: the model path when a bundle is given and the
    test has usable I/II metrics, else the direct path. Each test is computed on its one path; question votes and blended
    verdict follow. Returns (question rows, one summary row per test with ``method`` and the AGG22 flag ``degenerate``:
    probabilities weakly separated)."""
    sc = A.parsed_once(A.scan_xdex(spark, xdex_dir))
    pj = A.parsed_json(sc)
    if bundle is None:
        return _routed([_direct_path(A.stimuli(pj))])
    manifest, members = bundle
    raw = FE.source_union(A.xml_raw(sc), A.json_raw(pj))
    by_model = materialize(model_route(raw))
    direct = _direct_path(A.stimuli(pj).join(by_model, "test_id", "left_anti"))
    wide = FE.build_features(FE.build_long(raw.join(by_model, "test_id", "left_semi")))
    threshold = float(manifest["threshold"])
    mq = V.collapse_questions(predict(wide, members, threshold, manifest["feature_cols"]), threshold=threshold)
    model = (mq, V.blend_verdicts(ml_summary(mq), V.question_votes(mq, threshold)), "model_metrics")
    return _routed([model, direct])


def model_route(raw: DataFrame) -> DataFrame:
    """Tests that the model path takes: those with any I/II metric."""
    return raw.where(F.col("metric_i").isNotNull() | F.col("metric_ii").isNotNull()).select("test_id").distinct()


def _direct_path(stimuli: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    scored = D.score_direct(stimuli)
    q = V.collapse_questions(scored, threshold=K.DIRECT_LABEL_THRESHOLD)
    return q, V.blend_verdicts(D.direct_summary(scored), V.question_votes(q, K.DIRECT_LABEL_THRESHOLD)), K.DIRECT_METHOD


def _routed(paths: list[tuple[DataFrame, DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """Question rows and summaries of all paths, each with its method; summaries with the degeneracy flag."""
    rows, sums = None, None
    for q, s, method in paths:
        q = q.withColumn("method", F.lit(method))
        s = s.withColumn("method", F.lit(method)).join(V.degenerate_flag(q).select("test_id", "degenerate"), "test_id", "left")
        rows = q if rows is None else rows.unionByName(q, allowMissingColumns=True)
        sums = s if sums is None else sums.unionByName(s, allowMissingColumns=True)
    return rows, sums


def score_uploads(features: DataFrame, members: list, threshold: float, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """JOB9 re-aimed to batch: per test overall score, recommendation,
    per-question scores and the three key channels."""
    pred = predict(features, members, threshold, cols)
    summary = ml_summary(pred).join(
        FE.top_channels(pred).groupBy("test_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "channel"))), lambda s: s["channel"]).alias("key_channels")),
        "test_id", "left")
    per_q = pred.select(*[c for c in ("test_id", "question_code", "question_raw", "question_type", "deception_probability")
                          if c in pred.columns])
    return summary, per_q


UPLOAD_IDS = ["test_id", "question_code", "question_raw", "question_type"]


def score_upload_folder(spark: SparkSession, folder: str, members: list, threshold: float,
                        cols: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JOB9 from the uploaded files on: every table of the folder, wide ones as they are, long ones through the feature
    table, to verdicts. Returns (summary per test, question rows, files with the error of those left out)."""
    files, rows = TB.scan_uploads(spark, folder)
    files = materialize(files)
    built = FE.build_features(materialize(FE.build_long(TB.upload_long(files, rows))))
    both = ML.feature_matrix(built, cols).select(*UPLOAD_IDS, *cols).unionByName(TB.upload_wide(rows, UPLOAD_IDS, cols))
    return (*score_uploads(both, members, threshold, cols), files)


def run_pipeline(spark: SparkSession, docx_dir: str | None, xdex_dir: str | None, out_dir: str,
                 trees_scale: float = 1.0, feedback: DataFrame | None = None, model_names: list[str] | None = None) -> dict:
    """JOB5: preprocess then train; tables, reports and bundle under out_dir."""
    run_preprocess(spark, docx_dir, xdex_dir, f"{out_dir}/processed")
    return train(spark.read.parquet(f"{out_dir}/processed/features"), feedback=feedback, trees_scale=trees_scale,
                 out_dir=out_dir, model_names=model_names)


def feedback_retrain(spark: SparkSession, features: DataFrame, log_dir: str, reviews: DataFrame, out_dir: str,
                     trees_scale: float = 1.0) -> dict:
    """JOB8: fold new reviews into the feedback log, then retrain with it."""
    log = TB.upsert_feedback_log(spark, log_dir, reviews)
    return train(features, feedback=log, trees_scale=trees_scale, out_dir=out_dir)


def predict_job(spark: SparkSession, features: DataFrame, bundle_dir: str, out_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """JOB3/ML17: features + stored bundle -> predictions and per-test summary."""
    manifest, members = ML.load_bundle(f"{bundle_dir}")
    pred = predict(features, members, float(manifest["threshold"]), manifest["feature_cols"])
    summ = ml_summary(pred)
    if out_dir:
        TB.write_table(pred, f"{out_dir}/predictions")
        TB.write_summary(summ, f"{out_dir}/summary")
    return pred, summ
