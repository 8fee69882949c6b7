"""Question-level collapse, votes and verdict blending (AGG7, AGG9, FLT5,
EXP14, EXP19, AGG22, AGG23, ORD5, PRJ5).

All per-test logic is aggregate-first: cascades are decided from conditional
counts computed in the same ``groupBy`` as the votes (no join back), and the
first-non-null picks use ``min_by`` (partially aggregated) instead of windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from .ordered import group_rank

FIRST_COLS = ["source_file", "source_type", "question_raw", "question_text", "question_type", "question_type_code",
              "question_type_ru", "is_allowed", "ref_c_question_code", "waiting_answer_raw", "waiting_answer_label",
              "waiting_answer_ru"]
MEAN_COLS = ["deception_probability", "raw_score", "evidence_score", "pair_evidence", "baseline_evidence",
             "empirical_scaled", "delta_resp_vs_c", "delta_eda_vs_c", "delta_cardio_vs_c", "delta_ppg_vs_c",
             "z_resp", "z_eda", "z_cardio", "z_ppg", "sig_resp", "sig_eda", "sig_cardio", "sig_ppg"]


def collapse_questions(df: DataFrame, threshold: float = 0.5, keys: list[str] | None = None,
                       order: list[str] | None = None) -> DataFrame:
    """AGG7: one row per (test, question): first non-null meta (in stimulus
    order), mean scores, label = coalesce(p, 0) >= threshold."""
    keys = keys or [k for k in ("test_id", "question_code") if k in df.columns]
    order = [c for c in (order or ["stimulus_idx", "group_idx"]) if c in df.columns]
    firsts = [c for c in FIRST_COLS if c in df.columns and c not in keys]
    # without a stimulus order the tie-break is the row content (deterministic, documented)
    ordkey = F.struct(*[F.col(c) for c in (order or firsts or [c for c in df.columns if c not in keys])])
    means = [c for c in MEAN_COLS if c in df.columns]
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey)).alias(c) for c in firsts]
    aggs += [F.avg(c).alias(c) for c in means]
    if not aggs:
        aggs = [F.max_by(F.struct(*[c for c in df.columns if c not in keys]), ordkey).alias("_last")]
        out = df.groupBy(*keys).agg(*aggs).select(*keys, "_last.*")
    else:
        out = df.groupBy(*keys).agg(*aggs)
    if "deception_probability" in out.columns:
        out = out.withColumn("pred_label", (F.coalesce(F.col("deception_probability"), F.lit(0.0)) >= threshold).cast("int"))
    elif "pred_label" in out.columns:
        out = out.withColumn("pred_label", F.coalesce(E.to_double("pred_label"), F.lit(0.0)).cast("int"))
    return out


def _vote_candidates(df: DataFrame):
    """Candidate masks of the FLT5 cascade (first existing column decides)."""
    if "question_type_code" in df.columns:
        tc = F.upper(F.coalesce(F.col("question_type_code").cast("string"), F.lit("None")))
        first, second = tc == "R", tc != "I"
        return [("r", first), ("ni", second)], True
    if "question_type" in df.columns:
        qt = F.lower(F.coalesce(F.col("question_type").cast("string"), F.lit("None")))
        return [("nn", qt != "neutral")], False
    return [("all", F.lit(True))], False


def question_votes(df: DataFrame, threshold: float = 0.55, by: list[str] | None = None) -> DataFrame:
    """AGG9/FLT5: per test, share of considered questions voted 'lie'.

    Considered = R questions if any, else non-neutral; restricted to allowed
    ones when that leaves any; all questions when nothing is left."""
    by = ["test_id"] if by is None else by
    p = F.col("deception_probability")
    lie = F.coalesce(p >= threshold, F.lit(False))
    allowed = F.coalesce(F.col("is_allowed"), F.lit(True)) if "is_allowed" in df.columns else F.lit(True)
    cands, cascade = _vote_candidates(df)
    aggs = [F.count(F.lit(1)).alias("n_all"), F.count_if(lie).alias("lie_all")]
    for name, m in cands:
        aggs += [F.count_if(m).alias(f"n_{name}"), F.count_if(m & allowed).alias(f"n_{name}_a"),
                 F.count_if(m & lie).alias(f"lie_{name}"), F.count_if(m & allowed & lie).alias(f"lie_{name}_a")]
    g = df.groupBy(*by).agg(*aggs)

    def pick(prefix_n: str, name: str):
        # restrict to allowed when that leaves anything, then fall back to all
        n_a, n_m = F.col(f"n_{name}_a"), F.col(f"n_{name}")
        return (F.when(n_a > 0, F.col(f"{prefix_n}_{name}_a")).when(n_m > 0, F.col(f"{prefix_n}_{name}"))
                .otherwise(F.col(f"{prefix_n}_all")))

    if cascade:
        use_r = F.col("n_r") > 0
        n = F.when(use_r, pick("n", "r")).otherwise(pick("n", "ni"))
        lies = F.when(use_r, pick("lie", "r")).otherwise(pick("lie", "ni"))
    else:
        name = cands[0][0]
        n, lies = pick("n", name), pick("lie", name)
    share = lies / F.nullif(n, F.lit(0))
    return g.select(*by, n.cast("long").alias("n_questions"), lies.cast("long").alias("lie_count"),
                    (n - lies).cast("long").alias("truth_count"), share.alias("lie_share"),
                    E.recommend(share, *K.DIRECT_BANDS, missing=K.REC_INSUFFICIENT).alias("recommendation"))


def verdict_labels(df: DataFrame, threshold: float = 0.55) -> DataFrame:
    """Per-question verdict code/text (AGG9 row part)."""
    code = F.coalesce(F.col("deception_probability") >= threshold, F.lit(False)).cast("int")
    return (df.withColumn("question_verdict_code", code)
            .withColumn("question_verdict", F.when(code == 1, K.REC_LIE).otherwise(K.REC_TRUTH)))


def blend_verdicts(summary: DataFrame, votes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """EXP19: final score = mean of probability score and vote share when both
    exist, else the one present; bands .65/.35."""
    by = ["test_id"] if by is None else by
    v = votes.select(*by, F.col("lie_share").alias("overall_score_vote"),
                     F.col("recommendation").alias("recommendation_vote"))
    s = summary.select(*by, F.col("overall_score").alias("overall_score_probability"),
                       F.col("recommendation").alias("recommendation_probability"))
    j = s.join(v, by, "full")
    final = E.blend_scores("overall_score_probability", "overall_score_vote")
    rec = F.when(final.isNotNull(), E.recommend(final, *K.DIRECT_BANDS)).otherwise(F.col("recommendation_vote"))
    return j.withColumn("overall_score", final).withColumn("recommendation", rec)


def melt_channels(stim: DataFrame, test_col: str = "test_id") -> DataFrame:
    """PRJ5 (+EXP3, EXP9): stimulus scores -> long records, one per non-null
    score channel; metric_ii NULL; score = counter_answer else reaction proxy."""
    df = stim
    for c in K.SCORE_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    for c in ("question_text", "question_type_ru", "waiting_answer_raw", "waiting_answer_label", "waiting_answer_ru",
              "source_file"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    tc = F.upper(F.coalesce(F.col("question_type_code").cast("string"), F.lit("None")))
    ids = [c for c in (test_col, "group_idx", "stimulus_idx") if c in df.columns]
    base = df.select(
        *ids, F.col("source_file"), F.lit("xdex").alias("source_type"),
        F.col("question_text").alias("question_raw"), "question_code", "question_text",
        tc.alias("question_type_code"),
        E.type_from_code(tc, F.col("question_type_ru")).alias("question_type"),
        F.coalesce(F.col("is_allowed"), F.lit(True)).alias("is_allowed"),
        "waiting_answer_raw", "waiting_answer_label", "waiting_answer_ru",
        E.proxy_score().alias("score_result"), *K.SCORE_COLUMNS)
    keep = [c for c in base.columns if c not in K.SCORE_COLUMNS]
    long = base.unpivot(keep, K.SCORE_COLUMNS, "parameter", "metric_i").where(F.col("metric_i").isNotNull())
    return long.withColumn("metric_ii", F.lit(None).cast("double"))


def degenerate_flag(q: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG22: probabilities look unseparated (p NULL counts as 0)."""
    by = ["test_id"] if by is None else by
    p = F.coalesce(F.col("deception_probability"), F.lit(0.0))
    g = q.groupBy(*by).agg(F.count_distinct(p).alias("n_distinct"), F.stddev_samp(p).alias("sd"),
                           F.min(p).alias("p_min"), F.max(p).alias("p_max"))
    flag = ((F.col("n_distinct") <= 1) | F.coalesce(F.col("sd") < 1e-9, F.lit(False))
            | (F.col("p_max") < 0.20) | (F.col("p_min") > 0.85))
    return g.withColumn("degenerate", flag.cast("int"))


def prob_diagnostics(q: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG23."""
    by = ["test_id"] if by is None else by
    p = F.col("deception_probability")
    return q.groupBy(*by).agg(F.min(p).alias("prob_min"), F.max(p).alias("prob_max"), F.avg(p).alias("prob_mean"))


def chart_points(q: DataFrame, by: list[str] | None = None) -> DataFrame:
    """ORD5: (question, probability) pairs without NULLs, ranked by
    probability descending within the test (bounded by its questions)."""
    by = ["test_id"] if by is None else by
    d = q.select(*by, "question_code", "deception_probability").dropna(subset=["question_code", "deception_probability"])
    r = group_rank(d, by, [F.col("deception_probability").desc(), F.col("question_code")])
    return r.withColumn("rank", (F.col("rank") + 1).cast("int"))


def attach_expected(pred: DataFrame, questions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """JOIN7: expected-answer columns the prediction rows lack, from the
    question table (one row per key: the first by ordinal). The key includes
    the test, so questions of different tests never mix."""
    keys = keys or ["test_id", "question_code"]
    wanted = [c for c in ("waiting_answer_label", "waiting_answer_ru", "waiting_answer_raw")
              if c not in pred.columns and c in questions.columns]
    if not wanted:
        return pred
    order = next((c for c in ("order", "question_index") if c in questions.columns), None)
    ordkey = F.col(order) if order else F.lit(0)
    q = questions.groupBy(*keys).agg(F.min_by(F.struct(*wanted), ordkey).alias("_w")).select(*keys, "_w.*")
    return pred.join(q, keys, "left")


def review_sheet(df: DataFrame) -> DataFrame:
    """PRJ8 + EXP20: review table with a suggested expert review per
    question (expected answer, else the predicted label, else Truth)."""
    lab = F.col("waiting_answer_label") if "waiting_answer_label" in df.columns else F.lit(None).cast("string")
    raw = F.col("waiting_answer_raw") if "waiting_answer_raw" in df.columns else F.lit(None).cast("string")
    pred = F.col("pred_label") if "pred_label" in df.columns else F.lit(None).cast("int")
    keep = [c for c in ("test_id", "question_code", "question_raw", "question_type", "deception_probability", "pred_label")
            if c in df.columns]
    return df.select(*keep, E.default_review(lab, raw, pred).alias("expert_review"))


#: Columns of the explanation, in the order shown.
EXPLAIN = ["question_code", "question_type_ru", "ref_c_question_code", "sig_resp", "sig_eda", "sig_cardio", "sig_ppg",
           "z_resp", "z_eda", "z_cardio", "z_ppg", "delta_resp_vs_c", "delta_eda_vs_c", "delta_cardio_vs_c", "delta_ppg_vs_c",
           "pair_evidence", "baseline_evidence", "empirical_scaled", "evidence_score", "raw_score", "deception_probability"]


def explain_table(scored: DataFrame, ids: list[str]) -> DataFrame:
    """PRJ8: how each probability came about: signals, z values, contrasts and evidence, as far as the table has them."""
    return scored.select(*ids, *[c for c in EXPLAIN if c in scored.columns and c not in ids])
