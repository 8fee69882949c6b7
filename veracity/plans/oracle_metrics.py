"""DuckDB oracle SQL for the metric queries on F_PRED (brute force where it
is cheap: thresholds by a cross join with the grid, AP/AUC by windows)."""

from .fixtures import duck_ctes
from .oracle_direct import rd

P = duck_ctes("f_pred").rstrip() + """,
p AS (SELECT *, CAST(y_prob >= 0.5 AS INTEGER) AS y_pred FROM f_pred)
"""


def _cls(by: str) -> str:
    return f"""cf AS (SELECT {by}, count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp,
        count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
        count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn, count(*) AS n_samples, avg(CAST(y_true AS DOUBLE)) AS positive_rate
        FROM p GROUP BY {by}),
      cls AS (SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy,
        CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
        CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
        CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM cf)"""


def _calib(by: str) -> str:
    return f"""bins AS (SELECT {by}, y_true, y_prob,
        CASE WHEN y_prob < 0 OR y_prob > 1 THEN NULL ELSE least(9, CAST(floor(y_prob * 10) AS INTEGER)) END AS b0 FROM p),
      bins2 AS (SELECT *, CASE WHEN b0 IS NULL THEN NULL
          WHEN b0 < 9 AND y_prob >= (b0 + 1) * CAST(0.1 AS DOUBLE) THEN b0 + 1
          WHEN b0 > 0 AND y_prob < b0 * CAST(0.1 AS DOUBLE) THEN b0 - 1 ELSE b0 END AS b FROM bins),
      bagg AS (SELECT {by}, b, count(*) AS nb, avg(y_prob) AS mp, avg(CAST(y_true AS DOUBLE)) AS my FROM bins2 GROUP BY {by}, b),
      cal AS (SELECT {by}, sum(abs(mp - my) * nb) FILTER (WHERE b IS NOT NULL) / sum(nb) AS ece FROM bagg GROUP BY {by}),
      bri AS (SELECT {by}, avg((y_prob - y_true) * (y_prob - y_true)) AS brier FROM p GROUP BY {by})"""


def _ap(by: str, src: str = "p") -> str:
    return f"""st AS (SELECT {by}, y_prob AS s, sum(y_true) AS pos, count(*) AS cnt FROM {src} GROUP BY {by}, y_prob),
      st2 AS (SELECT *, sum(pos) OVER (PARTITION BY {by} ORDER BY s DESC) AS cpos,
                        sum(cnt) OVER (PARTITION BY {by} ORDER BY s DESC) AS ccnt,
                        sum(pos) OVER (PARTITION BY {by}) AS tpos, sum(cnt) OVER (PARTITION BY {by}) AS tcnt FROM st),
      apx AS (SELECT {by}, CASE WHEN max(tpos) = 0 OR max(tpos) = max(tcnt) THEN NULL
                 ELSE sum(CAST(pos AS DOUBLE) / tpos * cpos / ccnt) END AS pr_auc FROM st2 GROUP BY {by})"""


GRID = """grid AS (SELECT CAST(i AS INTEGER) AS j,
      CASE WHEN i = 160 THEN CAST(0.9 AS DOUBLE)
           ELSE CAST(i AS DOUBLE) * ((CAST(0.9 AS DOUBLE) - CAST(0.1 AS DOUBLE)) / 160) + CAST(0.1 AS DOUBLE) END AS thr FROM range(161) t(i))"""


def _best(src: str, by: str = "model") -> str:
    return f"""{GRID},
      tj AS (SELECT x.{by}, g.j, g.thr, count(*) FILTER (WHERE x.y_true = 1 AND x.y_prob >= g.thr) AS tp,
               count(*) FILTER (WHERE x.y_true = 0 AND x.y_prob >= g.thr) AS fp,
               count(*) FILTER (WHERE x.y_true = 1 AND x.y_prob < g.thr) AS fn
             FROM {src} x CROSS JOIN grid g GROUP BY x.{by}, g.j, g.thr),
      tf AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM tj),
      best AS (SELECT {by}, arg_min(thr, j) FILTER (WHERE rk = 1) AS threshold, max(f1) AS f1
               FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY f1 DESC) AS rk FROM tf) r GROUP BY {by})"""


def metric_oracles() -> dict[str, str]:
    q = {}
    mf = "model, fold"
    q["binary_metrics"] = P + ", " + _cls(mf) + f"""
      SELECT model, fold, {rd('accuracy')} AS accuracy, {rd('precision')} AS precision, {rd('recall')} AS recall,
        {rd('f1')} AS f1 FROM cls"""
    q["brier_ece"] = P + ", " + _calib(mf) + f"""
      SELECT b.model, b.fold, {rd('b.brier')} AS brier, {rd('coalesce(c.ece, 0.0)')} AS ece
      FROM bri b JOIN cal c ON b.model = c.model AND b.fold = c.fold"""
    q["average_precision"] = P + ", " + _ap(mf) + f" SELECT model, fold, {rd('pr_auc')} AS pr_auc FROM apx"
    q["roc_auc"] = P + f""", ra AS (SELECT model, fold, y_true,
          rank() OVER (PARTITION BY model, fold ORDER BY y_prob) AS r0,
          count(*) OVER (PARTITION BY model, fold, y_prob) AS tie FROM p),
      rk AS (SELECT *, r0 + (tie - 1) / 2.0 AS r FROM ra),
      au AS (SELECT model, fold, sum(r) FILTER (WHERE y_true = 1) AS rs, count(*) FILTER (WHERE y_true = 1) AS np,
               count(*) FILTER (WHERE y_true = 0) AS nn FROM rk GROUP BY model, fold)
      SELECT model, fold, {rd('CASE WHEN np > 0 AND nn > 0 THEN (rs - np * (np + 1) / 2.0) / (np * nn) END')} AS roc_auc FROM au"""
    ev = P + ", " + _cls(mf) + ", " + _calib(mf) + ", " + _ap(mf) + """,
      ev AS (SELECT c.model, c.fold, c.f1, a.pr_auc, b.brier, coalesce(k.ece, 0.0) AS ece, c.accuracy, c.precision, c.recall
             FROM cls c JOIN bri b USING (model, fold) JOIN cal k USING (model, fold) JOIN apx a USING (model, fold)),
      lg AS (""" + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM ev WHERE {m} IS NOT NULL AND NOT isnan({m})"
                                     for m in ["f1", "pr_auc", "brier", "ece", "accuracy", "precision", "recall"]) + """),
      ci AS (SELECT model, metric, avg(value) AS mean, CASE WHEN count(*) < 2 THEN 0.0 ELSE stddev_samp(value) END AS sd,
               count(*) AS n FROM lg GROUP BY model, metric)"""
    q["fold_ci"] = ev + f"""
      SELECT model, metric, {rd('mean')} AS mean, {rd('sd')} AS std, {rd('mean - 1.96 * sd / sqrt(n)')} AS ci_low,
        {rd('mean + 1.96 * sd / sqrt(n)')} AS ci_high, CAST(n AS BIGINT) AS n FROM ci"""
    ms = "model, source_type"
    q["source_breakdown"] = P + ", " + _cls(ms) + ", " + _calib(ms) + ", " + _ap(ms) + f"""
      SELECT c.model, c.source_type, CAST(c.n_samples AS BIGINT) AS n_samples, {rd('c.positive_rate')} AS positive_rate,
        {rd('c.accuracy')} AS accuracy, {rd('c.precision')} AS precision, {rd('c.recall')} AS recall, {rd('c.f1')} AS f1,
        {rd('b.brier')} AS brier, {rd('coalesce(k.ece, 0.0)')} AS ece, {rd('a.pr_auc')} AS pr_auc
      FROM cls c JOIN bri b USING (model, source_type) JOIN cal k USING (model, source_type) JOIN apx a USING (model, source_type)"""
    q["best_threshold"] = P + ", " + _best("p") + f" SELECT model, {rd('threshold')} AS threshold, {rd('f1')} AS f1 FROM best"
    table = P + """, dev AS (SELECT * FROM p WHERE fold <> 0), hold AS (SELECT * FROM p WHERE fold = 0), """ + _best("dev") + """,
      """ + _ap("model, fold", "dev") + """,
      cvap AS (SELECT model, avg(pr_auc) AS cv_pr_auc FROM apx GROUP BY model),
      hf0 AS (SELECT h.model, count(*) FILTER (WHERE y_true = 1 AND y_prob >= b.threshold) AS tp,
               count(*) FILTER (WHERE y_true = 0 AND y_prob >= b.threshold) AS fp,
               count(*) FILTER (WHERE y_true = 1 AND y_prob < b.threshold) AS fn
             FROM hold h JOIN best b ON h.model = b.model GROUP BY h.model),
      hf AS (SELECT model, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS holdout_f1 FROM hf0),
      mt AS (SELECT b.model, b.threshold, b.f1 AS cv_f1_opt, c.cv_pr_auc, h.holdout_f1
             FROM best b LEFT JOIN cvap c ON b.model = c.model LEFT JOIN hf h ON b.model = h.model),
      rk AS (SELECT *, CAST(row_number() OVER (ORDER BY cv_f1_opt DESC NULLS LAST, cv_pr_auc DESC NULLS LAST,
                                            holdout_f1 DESC NULLS LAST, model) AS INTEGER) AS rank FROM mt)"""
    q["model_ranking"] = table + f"""
      SELECT model, {rd('threshold')} AS threshold, {rd('cv_f1_opt')} AS cv_f1_opt, {rd('cv_pr_auc')} AS cv_pr_auc,
        {rd('holdout_f1')} AS holdout_f1, rank FROM rk"""
    q["ensemble_members"] = table + f""",
      top AS (SELECT cv_f1_opt AS t FROM rk WHERE rank = 1),
      mem AS (SELECT rk.* FROM rk, top WHERE (rk.cv_f1_opt >= top.t - 0.02 OR rk.rank = 1) ORDER BY rank LIMIT 3),
      mw AS (SELECT *, greatest(0.001, coalesce(cv_f1_opt, 0.0)) AS weight FROM mem)
      SELECT model, rank, {rd('weight')} AS weight, {rd('threshold')} AS threshold,
        {rd('sum(weight * threshold) OVER () / sum(weight) OVER ()')} AS ensemble_threshold FROM mw"""
    q["ensemble_blend"] = q["ensemble_members"].split("SELECT model, rank,")[0].rstrip() + f""",
      one AS (SELECT test_id, fold, model, avg(y_prob) AS y_prob FROM p GROUP BY ALL)
      SELECT test_id, fold, {rd('sum(weight * y_prob) / sum(weight)')} AS deception_probability, CAST(count(*) AS BIGINT) AS n_members
      FROM one JOIN mw ON one.model = mw.model GROUP BY test_id, fold"""
    q["ml_summary"] = P + f""", s AS (SELECT test_id, avg(y_prob) AS v, count(*) AS n FROM p GROUP BY test_id)
      SELECT test_id, {rd('v')} AS overall_score, CAST(n AS BIGINT) AS n_items, CASE WHEN v >= 0.60 THEN 'Вероятно ложь'
        WHEN v <= 0.40 THEN 'Вероятно правда' ELSE 'Требует внимания эксперта' END AS recommendation FROM s"""
    q["class_counts"] = P + """, cc AS (SELECT model, count(*) FILTER (WHERE y_true = 1) AS n_pos, count(*) FILTER (WHERE y_true = 0) AS n_neg,
          count(DISTINCT test_id) AS n_groups FROM p GROUP BY model)
      SELECT model, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, CAST(least(n_pos, n_neg) AS BIGINT) AS min_class,
        CAST(least(5, least(n_pos, n_neg)) AS BIGINT) AS n_splits, CAST(n_groups AS BIGINT) AS n_groups,
        CASE WHEN least(5, least(n_pos, n_neg)) < 2 THEN 'invalid' WHEN n_groups >= least(5, least(n_pos, n_neg))
             THEN 'stratified_group' ELSE 'stratified' END AS cv_kind FROM cc"""
    return q
