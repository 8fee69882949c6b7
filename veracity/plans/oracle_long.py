"""DuckDB oracle SQL for the feature queries on F_LONG."""

from .fixtures import duck_ctes
from .oracle_direct import rd

CH = ["bp", "breath", "gsr", "my_chan"]  # channels present in F_LONG after normalisation
IDS = "test_id, source_file, source_type, question_code, question_raw, question_text, question_type"
KEYS14 = ("source_file, source_type, test_id, question_raw, question_code, question_text, question_type_code, "
          "question_type, is_allowed, waiting_answer_raw, waiting_answer_label, waiting_answer_ru, parameter, parameter_norm")
REST_ORDER = ", ".join(f"{c} NULLS LAST" for c in ["question_type_code", "is_allowed", "waiting_answer_raw",
                                                    "waiting_answer_label", "waiting_answer_ru", "parameter", "parameter_norm"])
META = ["question_type_code", "is_allowed", "waiting_answer_raw", "waiting_answer_label", "waiting_answer_ru"]
PMAP = {"ДЫХАНИЕ": "breath", "BREATH": "breath", "КГР": "gsr", "EDA": "gsr", "GSR": "gsr", "АД": "bp", "AR": "bp",
        "BP": "bp", "ПГ": "ppg", "PLE": "ppg", "PPG": "ppg"}
FULL = " AND ".join(f"{c} IS NOT NULL" for c in IDS.split(", "))


def _norm(p: str) -> str:
    up = f"upper(regexp_replace({p}, '^\\s+|\\s+$', '', 'g'))"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PMAP.items())
    return f"coalesce(CASE {up} {cases} END, replace(lower({up}), ' ', '_'))"


RAW = """raw AS (
  SELECT source_file, source_type, test_id, question_raw, question_code, question_text, question_type_code, question_type,
         is_allowed, waiting_answer_raw, waiting_answer_label, waiting_answer_ru,
         regexp_replace(coalesce(parameter, 'None'), '^\\s+|\\s+$', '', 'g') AS parameter, metric_i, metric_ii, score_result
  FROM f_long)"""

LONG_CTES = duck_ctes("f_long") + ",\n" + RAW + f""",
n1 AS (SELECT *, {_norm('parameter')} AS parameter_norm FROM raw),
flt AS (SELECT * FROM n1 WHERE parameter_norm NOT IN ('', 'none', 'nan', 'параметр', 'parameter')),
ng AS (SELECT test_id, question_raw,
          CAST(dense_rank() OVER (ORDER BY test_id NULLS LAST, question_raw NULLS LAST) - 1 AS BIGINT) AS qgroup
       FROM (SELECT DISTINCT test_id, question_raw FROM flt) d),
filled AS (
  SELECT f.* REPLACE (coalesce(f.question_code, 'q' || CAST(ng.qgroup AS VARCHAR)) AS question_code,
                      coalesce(f.question_type, 'other') AS question_type)
  FROM flt f JOIN ng ON f.test_id IS NOT DISTINCT FROM ng.test_id AND f.question_raw IS NOT DISTINCT FROM ng.question_raw),
long AS (SELECT {KEYS14}, avg(metric_i) AS metric_i, avg(metric_ii) AS metric_ii, max(score_result) AS score_result
         FROM filled GROUP BY {KEYS14}),
wide0 AS (
  SELECT {IDS}, max(score_result) AS score_result,
    {", ".join(f"first({m} ORDER BY {REST_ORDER}) FILTER (WHERE {m} IS NOT NULL) AS {m}" for m in META)},
    {", ".join(f"avg(metric_i) FILTER (WHERE {FULL} AND parameter_norm = '{c}') AS i_{c}" for c in CH)},
    {", ".join(f"avg(metric_ii) FILTER (WHERE {FULL} AND parameter_norm = '{c}') AS ii_{c}" for c in CH)}
  FROM long GROUP BY {IDS}),
nst AS (
  SELECT test_id,
    {", ".join(f"avg(i_{c}) FILTER (WHERE question_type = 'neutral') AS i_{c}_neutral_mean, nullif(stddev_samp(i_{c}) FILTER (WHERE question_type = 'neutral'), 0.0) AS i_{c}_neutral_std" for c in CH)}
  FROM wide0 WHERE test_id IS NOT NULL GROUP BY test_id),
wide AS (
  SELECT w.*,
    {", ".join(f"ii_{c} / nullif(i_{c}, 0.0) AS ratio_ii_i_{c}" for c in CH)},
    {", ".join(f"n.i_{c}_neutral_mean, n.i_{c}_neutral_std, (i_{c} - n.i_{c}_neutral_mean) / n.i_{c}_neutral_std AS z_i_{c}_vs_neutral" for c in CH)},
    CAST(lower(question_type) = 'control' AS INTEGER) AS is_control_q,
    CAST(lower(question_type) = 'probable_lie' AS INTEGER) AS is_probable_lie_q,
    CAST(lower(question_type) = 'neutral' AS INTEGER) AS is_neutral_q,
    CAST(lower(question_type) = 'sacrifice' AS INTEGER) AS is_sacrifice_q,
    CASE WHEN score_result IS NULL THEN NULL ELSE CAST(score_result >= 0.55 AS INTEGER) END AS label_weak,
    coalesce(CASE lower(trim(waiting_answer_label)) WHEN 'lie' THEN 1 WHEN 'truth' THEN 0 END,
             CASE lower(trim(waiting_answer_raw)) WHEN 'no' THEN 1 WHEN 'yes' THEN 0 END) AS label_question_template
  FROM wide0 w LEFT JOIN nst n USING (test_id)),
wide2 AS (
  SELECT *, coalesce(label_question_template, label_weak) AS label_bootstrap,
    CASE WHEN label_question_template IS NOT NULL THEN 'question-template' WHEN label_weak IS NOT NULL THEN 'weak'
         ELSE 'missing' END AS label_source
  FROM wide)
"""


def long_oracles() -> dict[str, str]:
    q = {}
    q["source_union"] = duck_ctes("f_long") + ",\n" + RAW + """
      SELECT source_file, source_type, test_id, question_raw, question_code, question_text, question_type_code, question_type,
        is_allowed, waiting_answer_raw, waiting_answer_label, waiting_answer_ru, parameter,
        """ + f"{rd('metric_i')} AS metric_i, {rd('metric_ii')} AS metric_ii, {rd('score_result')} AS score_result FROM raw"
    q["question_code_fill"] = LONG_CTES + "SELECT test_id, question_raw, qgroup FROM ng"
    q["long_dedupe"] = LONG_CTES + f"""SELECT {KEYS14}, {rd('metric_i')} AS metric_i, {rd('metric_ii')} AS metric_ii,
        {rd('score_result')} AS score_result FROM long"""
    q["feature_scores"] = LONG_CTES + f"SELECT {IDS}, {rd('score_result')} AS score_result FROM wide2"
    q["feature_meta_first"] = LONG_CTES + f"SELECT {IDS}, {', '.join(META)} FROM wide2"
    q["feature_pivot"] = LONG_CTES + f"SELECT {IDS}, " + ", ".join(
        f"{rd(p + c)} AS {p}{c}" for p in ("i_", "ii_") for c in CH) + " FROM wide2"
    q["feature_ratios"] = LONG_CTES + f"SELECT {IDS}, " + ", ".join(
        f"{rd('ratio_ii_i_' + c)} AS ratio_ii_i_{c}" for c in CH) + " FROM wide2"
    q["neutral_zscores"] = LONG_CTES + f"SELECT {IDS}, " + ", ".join(
        f"{rd(x)} AS {x}" for c in CH for x in (f"i_{c}_neutral_mean", f"i_{c}_neutral_std", f"z_i_{c}_vs_neutral")) + " FROM wide2"
    q["surrogate_labels"] = LONG_CTES + f"""SELECT {IDS}, label_weak, label_question_template, label_bootstrap, label_source
        FROM wide2"""
    q["type_flags"] = LONG_CTES + f"SELECT {IDS}, is_control_q, is_probable_lie_q, is_neutral_q, is_sacrifice_q FROM wide2"
    feats = (["is_allowed"] + [f"i_{c}" for c in CH] + [f"ii_{c}" for c in CH] + [f"ratio_ii_i_{c}" for c in CH]
             + [x for c in CH for x in (f"i_{c}_neutral_mean", f"i_{c}_neutral_std")]
             + [f"z_i_{c}_vs_neutral" for c in CH]
             + ["is_control_q", "is_probable_lie_q", "is_neutral_q", "is_sacrifice_q"])
    counts = ", ".join(f"count({f}) AS c_{f}" for f in feats)
    unions = " UNION ALL ".join(f"SELECT '{f}' AS feature, c_{f} AS n_non_null, n FROM cnt" for f in feats)
    q["feature_column_stats"] = LONG_CTES + f""", cnt AS (SELECT count(*) AS n, {counts} FROM wide2)
      SELECT feature, CAST(n_non_null AS BIGINT) AS n_non_null, CAST(n AS BIGINT) AS n_rows,
        CAST(n_non_null >= greatest(5, CAST(floor(n * 0.15) AS BIGINT)) AS INTEGER) AS selected
      FROM ({unions}) u"""
    tcols = [f"i_{c}" for c in CH] + [f"ii_{c}" for c in CH] + [x for c in CH for x in (f"i_{c}_neutral_mean", f"i_{c}_neutral_std")]
    tunion = " UNION ALL ".join(f"SELECT test_id, '{c}' AS channel, avg(abs({c})) AS mean_abs FROM wide2 GROUP BY test_id" for c in tcols)
    q["top_channels"] = LONG_CTES + f""", ma AS ({tunion}),
      rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY test_id ORDER BY mean_abs DESC NULLS LAST, channel) AS INTEGER) AS rank FROM ma)
      SELECT test_id, channel, {rd('mean_abs')} AS mean_abs, rank FROM rk WHERE rank <= 3"""
    return q


def ml_oracles() -> dict[str, str]:
    """impute_scale: selected features (PRJ2 rule), exact median over the
    labelled rows, mean / population sd of the imputed column (sd 0 -> 1)."""
    feats = (["is_allowed"] + [f"i_{c}" for c in CH] + [f"ii_{c}" for c in CH] + [f"ratio_ii_i_{c}" for c in CH]
             + [x for c in CH for x in (f"i_{c}_neutral_mean", f"i_{c}_neutral_std")]
             + [f"z_i_{c}_vs_neutral" for c in CH]
             + ["is_control_q", "is_probable_lie_q", "is_neutral_q", "is_sacrifice_q"])
    counts = ", ".join(f"count({f}) AS c_{f}" for f in feats)
    sel = " UNION ALL ".join(f"SELECT '{f}' AS feature, c_{f} >= greatest(5, CAST(floor(n * 0.15) AS BIGINT)) AS ok FROM cnt"
                            for f in feats)
    per = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, median(CAST({f} AS DOUBLE)) AS med FROM lab" for f in feats)
    vals = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM lab" for f in feats)
    return {"impute_scale": LONG_CTES + f""", cnt AS (SELECT count(*) AS n, {counts} FROM wide2),
      selected AS ({sel}),
      lab AS (SELECT * FROM wide2 WHERE label_bootstrap IS NOT NULL),
      meds AS ({per}),
      vals AS ({vals}),
      imp AS (SELECT v.feature, coalesce(v.x, m.med, 0.0) AS xi FROM vals v JOIN meds m USING (feature)),
      st AS (SELECT feature, avg(xi) AS mean, stddev_pop(xi) AS sd FROM imp GROUP BY feature)
      SELECT s.feature, {rd('m.med')} AS median, {rd('s.mean')} AS mean,
        {rd('CASE WHEN s.sd IS NULL OR s.sd = 0 THEN 1.0 ELSE s.sd END')} AS std
      FROM st s JOIN meds m USING (feature) JOIN selected k USING (feature) WHERE k.ok"""}


SPLIT_CTES = """, lab AS (SELECT * FROM wide2 WHERE label_bootstrap IS NOT NULL),
  grp AS (SELECT test_id, CAST(avg(CAST(label_bootstrap AS DOUBLE)) >= 0.5 AS INTEGER) AS stratum FROM lab GROUP BY test_id),
  pos AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || CAST(test_id AS VARCHAR)), test_id) - 1 AS pos
    FROM grp)"""
SPLIT_KEYS = ("l.test_id, l.source_file, l.source_type, l.question_code, l.question_raw, l.question_text, l.question_type")


def split_oracles() -> dict[str, str]:
    """group_folds: position in the stratum modulo k; group_holdout: the first positions, shares by largest remainder."""
    folds = LONG_CTES + SPLIT_CTES + f""", k AS (SELECT least(5, min(c)) AS k FROM (SELECT count(*) AS c FROM lab GROUP BY label_bootstrap))
      SELECT {SPLIT_KEYS}, CAST(p.pos % k.k AS INTEGER) AS fold FROM lab l JOIN pos p USING (test_id) CROSS JOIN k"""
    hold = LONG_CTES + SPLIT_CTES + f""", n AS (SELECT count(*) AS n, least(greatest(2, CAST(round_even(count(*) * 0.2, 0) AS BIGINT)), count(*) - 2) AS size
        FROM grp),
      st AS (SELECT stratum, count(*) AS c FROM grp GROUP BY stratum),
      part AS (SELECT stratum, c * size // n AS base, c * size % n AS rest, size FROM st CROSS JOIN n),
      sh AS (SELECT stratum, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, stratum) <= size - sum(base) OVER ()
        THEN 1 ELSE 0 END AS share FROM part)
      SELECT {SPLIT_KEYS}, CASE WHEN p.pos < s.share THEN 'holdout' ELSE 'dev' END AS split
      FROM lab l JOIN pos p USING (test_id) JOIN sh s USING (stratum)"""
    return {"group_folds": folds, "group_holdout": hold}


def review_oracles() -> dict[str, str]:
    return {"review_defaults": LONG_CTES + """SELECT test_id, question_code, question_raw, question_type, label_weak AS pred_label,
      coalesce(CASE trim(waiting_answer_label) WHEN 'Lie' THEN 'Lie' WHEN 'Truth' THEN 'Truth' END,
               CASE lower(trim(waiting_answer_raw)) WHEN 'no' THEN 'Lie' WHEN 'yes' THEN 'Truth' END,
               CASE WHEN label_weak = 1 THEN 'Lie' WHEN label_weak IS NOT NULL THEN 'Truth' END, 'Truth') AS expert_review
      FROM wide2"""}
