"""Evaluation metrics as aggregates (AGG13-AGG21, AGG24, WIN6, ORD2, ORD3).

Every metric is a ``groupBy`` over the evaluation rows (partial aggregation,
so a hot model/fold key is combined map-side). Rank-based metrics (average
precision, ROC-AUC) first collapse rows to one per distinct score and then
take the two-level running sums of :func:`ordered.running_sums`.
The best-threshold search is a histogram over the 161 fixed thresholds, never
a rows x thresholds cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from .ordered import fine_bucket, running_sums, value_bucket


def _f1(tp, fp, fn):
    den = 2 * tp + fp + fn
    return F.when(den > 0, (2.0 * tp) / den).otherwise(F.lit(0.0))


def confusion(y: str, pred: str):
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    return [F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
            F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 0) & (pp == 0)).alias("tn")]


def classification_cols():
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return [F.when(n > 0, (tp + tn) / n).alias("accuracy"),
            F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
            F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
            _f1(tp, fp, fn).alias("f1")]


def binary_metrics(df: DataFrame, y: str = "y_true", pred: str = "y_pred", by: list[str] | None = None) -> DataFrame:
    """AGG13: accuracy, precision, recall, F1 (0 on zero division)."""
    by = by or []
    g = df.groupBy(*by).agg(*confusion(y, pred))
    return g.select(*by, *classification_cols())


# --- fixed values: calibration bin edges are i * (1/n) as in an evenly spaced grid from 0 to 1
def _bin_index(p, n_bins: int):
    step = 1.0 / n_bins
    edges = [i * step for i in range(1, n_bins)]
    idx = sum((F.when(p >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return F.when((p >= 0.0) & (p <= 1.0), idx)


def brier_ece(df: DataFrame, y: str = "y_true", prob: str = "y_prob", by: list[str] | None = None,
              n_bins: int = 10) -> DataFrame:
    """AGG14 + AGG15: Brier score and expected calibration error (equal-width
    bins, last bin closed)."""
    by = by or []
    yy, p = F.col(y).cast("double"), F.col(prob).cast("double")
    b = df.select(*by, yy.alias("_y"), p.alias("_p"), _bin_index(p, n_bins).alias("_bin"))
    per_bin = b.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.avg("_p").alias("_mp"), F.avg("_y").alias("_my"),
                                         F.sum((F.col("_p") - F.col("_y")) ** 2).alias("_se"))
    g = per_bin.groupBy(*by).agg(
        F.sum("_n").alias("_n"),
        F.sum("_se").alias("_se"),
        F.sum(F.when(F.col("_bin").isNotNull(), F.abs(F.col("_mp") - F.col("_my")) * F.col("_n"))).alias("_ece"))
    return g.select(*by, (F.col("_se") / F.col("_n")).alias("brier"),
                    F.coalesce(F.col("_ece") / F.col("_n"), F.lit(0.0)).alias("ece"))


def _score_table(df: DataFrame, y: str, prob: str, by: list[str]) -> DataFrame:
    s = df.select(*by, F.col(y).cast("double").alias("_y"), F.col(prob).cast("double").alias("_s"))
    g = s.groupBy(*by, "_s").agg(F.sum("_y").alias("pos"), F.count(F.lit(1)).cast("double").alias("cnt"))
    return g.withColumn("neg", F.col("cnt") - F.col("pos"))


def average_precision(df: DataFrame, y: str = "y_true", prob: str = "y_prob", by: list[str] | None = None) -> DataFrame:
    """AGG16: step-wise average precision over distinct scores (descending);
    NULL when only one class is present."""
    by = by or []
    return _ap_from_scores(_score_table(df, y, prob, by), by)


def roc_auc(df: DataFrame, y: str = "y_true", prob: str = "y_prob", by: list[str] | None = None) -> DataFrame:
    """AGG17: area under the ROC curve with ties counted half (Mann-Whitney
    form of the trapezoid rule); NULL when only one class is present."""
    by = by or []
    g = _score_table(df, y, prob, by)
    r = running_sums(g, by, [F.col("_s").desc()], ["pos", "neg"], _descending("_s"), _descending("_s", fine_bucket))
    contrib = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)
    a = r.groupBy(*by).agg(F.sum(contrib).alias("_u"), F.max("tot_pos").alias("_p"), F.max("tot_neg").alias("_q"))
    ok = (F.col("_p") > 0) & (F.col("_q") > 0)
    return a.select(*by, F.when(ok, F.col("_u") / (F.col("_p") * F.col("_q"))).alias("roc_auc"))


def eval_metrics(df: DataFrame, y: str = "y_true", pred: str = "y_pred", prob: str = "y_prob",
                 by: list[str] | None = None, n_bins: int = 10) -> DataFrame:
    """Classification metrics + Brier + ECE + PR-AUC (+ n, positive rate);
    labels are 0/1. One aggregate by (group, calibration bin) gives all but
    PR-AUC, which alone needs the table of distinct scores."""
    if not by:  # global metrics: a constant key keeps every step an equi-join of one-row tables
        return eval_metrics(df.withColumn("_all", F.lit(0)), y, pred, prob, ["_all"], n_bins).drop("_all")
    yy, s, hit = F.col(y).cast("double"), F.col(prob).cast("double"), F.col(pred).cast("int") == 1
    parts = {"tp": F.when(hit, yy).otherwise(0.0), "fp": F.when(hit, 1.0 - yy).otherwise(0.0),
             "fn": F.when(~hit, yy).otherwise(0.0), "tn": F.when(~hit, 1.0 - yy).otherwise(0.0)}
    b = df.groupBy(*by, _bin_index(s, n_bins).alias("_bin")).agg(
        *[F.sum(e).alias(c) for c, e in parts.items()], F.count(F.lit(1)).cast("double").alias("_n"),
        F.sum(yy).alias("_p"), F.sum(s).alias("_s"), F.sum((s - yy) ** 2).alias("_se"))
    gap = F.when(F.col("_bin").isNotNull(), F.abs(F.col("_s") / F.col("_n") - F.col("_p") / F.col("_n")) * F.col("_n"))
    c = b.groupBy(*by).agg(*[F.sum(x).alias(x) for x in (*parts, "_n", "_p", "_se")], F.sum(gap).alias("_gap"))
    m = c.select(*[F.col(x).alias("_m_" + x) for x in by], F.col("_n").cast("long").alias("n_samples"),
                 (F.col("_p") / F.col("_n")).alias("positive_rate"), *classification_cols(),
                 (F.col("_se") / F.col("_n")).alias("brier"), F.coalesce(F.col("_gap") / F.col("_n"), F.lit(0.0)).alias("ece"))
    ap = _ap_from_scores(_score_table(df, y, prob, by), by)
    on = [F.col("_m_" + x).eqNullSafe(F.col(x)) for x in by]
    return m.join(ap, on, "left").select(*[F.col("_m_" + x).alias(x) for x in by],
                                         *[x for x in m.columns if x not in {"_m_" + k for k in by}], "pr_auc")


def _descending(score: str, bucket=value_bucket) -> Column:
    """Buckets of scores in descending order, null scores last."""
    return F.coalesce(-bucket(F.col(score)), F.lit(1 << 62))


def _ap_from_scores(g: DataFrame, by: list[str]) -> DataFrame:
    r = running_sums(g, by, [F.col("_s").desc()], ["pos", "cnt"], _descending("_s"), _descending("_s", fine_bucket))
    contrib = F.when(F.col("tot_pos") > 0, (F.col("pos") / F.col("tot_pos")) * (F.col("cum_pos") / F.col("cum_cnt")))
    a = r.groupBy(*by).agg(F.sum(contrib).alias("_ap"), F.max("tot_pos").alias("_p"), F.max("tot_cnt").alias("_n"))
    one_class = (F.col("_p") == 0) | (F.col("_p") == F.col("_n"))
    return a.select(*by, F.when(one_class, F.lit(None).cast("double")).otherwise(F.col("_ap")).alias("pr_auc"))


def fold_ci(folds: DataFrame, metrics: list[str], by: list[str] | None = None, z: float = 1.96) -> DataFrame:
    """AGG18: per metric mean, sample sd (0 for one fold), mean +- z*sd/sqrt(n);
    NULL (NaN) folds ignored. One row per (by..., metric)."""
    by = by or []
    long = folds.unpivot(by, metrics, "metric", "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    g = long.groupBy(*by, "metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("_sd"),
                                        F.count(F.lit(1)).alias("n"))
    sd = F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("_sd"))
    half = z * sd / F.sqrt(F.col("n").cast("double"))
    return g.select(*by, "metric", "mean", sd.alias("std"), (F.col("mean") - half).alias("ci_low"),
                    (F.col("mean") + half).alias("ci_high"), F.col("n").cast("long").alias("n"))


def threshold_grid(lo: float = K.THRESHOLD_LO, hi: float = K.THRESHOLD_HI, n: int = K.THRESHOLD_N) -> list[float]:
    """Evenly spaced candidates, computed as start + i*step with the last one
    exactly ``hi`` (the same floats as an evenly spaced grid routine)."""
    step = (hi - lo) / (n - 1)
    grid = [i * step + lo for i in range(n)]
    grid[-1] = hi
    return grid


def best_threshold(df: DataFrame, y: str = "y_true", prob: str = "y_prob", by: list[str] | None = None,
                   lo: float = K.THRESHOLD_LO, hi: float = K.THRESHOLD_HI, n: int = K.THRESHOLD_N) -> DataFrame:
    """AGG20: threshold with the highest F1 over the fixed grid (first maximum
    wins). Each row lands in the bucket 'number of thresholds <= score'; the
    TP/FP at threshold j are the counts of rows in buckets > j."""
    if not by:
        return best_threshold(df.withColumn("_all", F.lit(0)), y, prob, ["_all"], lo, hi, n).drop("_all")
    grid = threshold_grid(lo, hi, n)
    step = (hi - lo) / (n - 1)
    s = F.col(prob).cast("double")
    j0 = F.floor((s - lo) / step).cast("int")
    thr = F.create_map(*[x for i, t in enumerate(grid) for x in (F.lit(i), F.lit(t))])
    # exact bucket: count of grid values <= s, corrected against the literal neighbours
    k = (F.when(s < grid[0], F.lit(0)).when(s >= grid[-1], F.lit(n))
         .otherwise(F.when(s >= thr[j0 + 1], j0 + 2).when(s >= thr[j0], j0 + 1).otherwise(j0)))
    h = (df.select(*by, F.col(y).cast("int").alias("_y"), k.alias("_k"))
         .groupBy(*by, "_k").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg")))
    # complete the (n+1)-bucket histogram of every group; windows span n+1 rows per group
    keys = h.select(*by).distinct()
    grid_rows = keys.select(*by, F.explode(F.sequence(F.lit(0), F.lit(n))).alias("_k"))
    full = grid_rows.join(h, by + ["_k"], "left").fillna(0, ["pos", "neg"])
    above = Window.partitionBy(*by).orderBy(F.col("_k").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    f = full.select(*by, F.col("_k").alias("_j"),
                    F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"),
                    F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp"),
                    F.sum("pos").over(whole).alias("P")).where(F.col("_j") < n)
    f = f.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("P") - F.col("tp")))
    key = F.struct(F.col("f1"), (-F.col("_j")).alias("nj"))
    best = f.groupBy(*by).agg(F.max(key).alias("b"))
    return best.select(*by, thr[-F.col("b.nj")].alias("threshold"), F.col("b.f1").alias("f1"))


def class_counts(df: DataFrame, y: str = "y_true", group: str = "test_id", by: list[str] | None = None,
                 max_folds: int = 5) -> DataFrame:
    """AGG24 + ML10 plan: class counts, fold count min(5, minority), CV kind."""
    by = by or []
    g = df.groupBy(*by).agg(F.count_if(F.col(y) == 1).alias("n_pos"), F.count_if(F.col(y) == 0).alias("n_neg"),
                            F.count_distinct(F.col(group).cast("string")).alias("n_groups"))
    mc = F.least("n_pos", "n_neg")
    k = F.least(F.lit(max_folds).cast("long"), mc)
    kind = (F.when(k < 2, "invalid").when(F.col("n_groups") >= k, "stratified_group").otherwise("stratified"))
    return g.select(*by, "n_pos", "n_neg", mc.alias("min_class"), k.alias("n_splits"), "n_groups", kind.alias("cv_kind"))


def rank_models(table: DataFrame) -> DataFrame:
    """ORD2: cv_f1_opt, cv_pr_auc, holdout_f1 descending (NULLs last), then
    model name. The window spans one row per model."""
    w = Window.orderBy(F.col("cv_f1_opt").desc_nulls_last(), F.col("cv_pr_auc").desc_nulls_last(),
                       F.col("holdout_f1").desc_nulls_last(), F.col("model"))
    return table.withColumn("rank", F.row_number().over(w).cast("int"))


def ensemble_members(ranked: DataFrame, margin: float = K.ENSEMBLE_F1_MARGIN, k: int = K.ENSEMBLE_MAX_MEMBERS,
                     min_weight: float = K.ENSEMBLE_MIN_WEIGHT) -> DataFrame:
    """ORD3: models within ``margin`` of the best cv_f1_opt, first ``k`` by
    rank; weight max(min_weight, F1); ensemble threshold = weighted mean."""
    # the ranking table has one row per model: a global window over it is bounded by the model count
    top = F.first("cv_f1_opt").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    c = ranked.withColumn("_top", top).where((F.col("cv_f1_opt") >= F.col("_top") - margin) | (F.col("rank") == 1))
    c = c.orderBy("rank").limit(k)
    c = c.withColumn("weight", F.greatest(F.lit(min_weight), F.coalesce(F.col("cv_f1_opt"), F.lit(0.0))))
    w = Window.partitionBy(F.lit(1))
    return c.select("model", "rank", "weight", "threshold",
                    (F.sum(F.col("weight") * F.col("threshold")).over(w) / F.sum("weight").over(w)).alias("ensemble_threshold"))
