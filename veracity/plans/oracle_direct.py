"""DuckDB oracle SQL for the direct-scoring queries (independent formulation:
plain aggregates and a brute-force nearest-reference search)."""

from .fixtures import duck_ctes

R = 6  # decimals every double is rounded to, on both sides


def rd(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE) + 3e-11, {R}) + 0.0)"


DIRECT_CTES = duck_ctes("f_stim") + """,
sig AS (
  SELECT *, upper(coalesce(question_type_code, 'None')) AS q_type, coalesce(is_allowed, true) AS allowed,
    -coalesce(a_bv, 0.0) + coalesce(abs(a_trlength), 0.0) AS sig_resp,
    coalesce(a_eda, 0.0) + 0.5 * coalesce(a_eda2, 0.0) AS sig_eda,
    coalesce(a_arlength, 0.0) AS sig_cardio,
    coalesce(abs(a_ple), 0.0) AS sig_ppg
  FROM f_stim),
tiers AS (
  SELECT test_id, count(*) AS n_items,
    count(*) FILTER (WHERE allowed AND q_type IN ('I','C')) AS n_base_ic,
    count(*) FILTER (WHERE allowed) AS n_allowed,
    count(*) FILTER (WHERE allowed AND q_type = 'R') AS n_rel
  FROM sig GROUP BY test_id),
m AS (
  SELECT s.*,
    CASE WHEN t.n_base_ic > 0 THEN s.allowed AND s.q_type IN ('I','C') WHEN t.n_allowed > 0 THEN s.allowed ELSE true END AS in_baseline,
    CASE WHEN t.n_rel > 0 THEN s.allowed AND s.q_type = 'R' WHEN t.n_allowed > 0 THEN s.allowed ELSE true END AS in_target
  FROM sig s JOIN tiers t USING (test_id)),
bl AS (
  SELECT test_id, 'resp' AS ch, sig_resp AS x FROM m WHERE in_baseline
  UNION ALL SELECT test_id, 'eda', sig_eda FROM m WHERE in_baseline
  UNION ALL SELECT test_id, 'cardio', sig_cardio FROM m WHERE in_baseline
  UNION ALL SELECT test_id, 'ppg', sig_ppg FROM m WHERE in_baseline),
cen AS (SELECT test_id, ch, median(x) AS c FROM bl GROUP BY test_id, ch),
spread AS (
  SELECT b.test_id, b.ch, median(abs(b.x - c.c)) AS mad, stddev_pop(b.x) AS sd
  FROM bl b JOIN cen c ON b.test_id = c.test_id AND b.ch = c.ch GROUP BY b.test_id, b.ch),
st AS (
  SELECT c.test_id, c.ch, c.c,
    CASE WHEN 1.4826 * s.mad > 1e-8 THEN 1.4826 * s.mad WHEN s.sd > 1e-8 THEN s.sd ELSE 1.0 END AS sc
  FROM cen c JOIN spread s ON c.test_id = s.test_id AND c.ch = s.ch),
stw AS (
  SELECT test_id,
    max(c) FILTER (WHERE ch = 'resp') AS c_resp, max(sc) FILTER (WHERE ch = 'resp') AS s_resp,
    max(c) FILTER (WHERE ch = 'eda') AS c_eda, max(sc) FILTER (WHERE ch = 'eda') AS s_eda,
    max(c) FILTER (WHERE ch = 'cardio') AS c_cardio, max(sc) FILTER (WHERE ch = 'cardio') AS s_cardio,
    max(c) FILTER (WHERE ch = 'ppg') AS c_ppg, max(sc) FILTER (WHERE ch = 'ppg') AS s_ppg
  FROM st GROUP BY test_id),
z AS (
  SELECT m.*,
    least(5.0, greatest(-5.0, (sig_resp - c_resp) / s_resp)) AS z_resp,
    least(5.0, greatest(-5.0, (sig_eda - c_eda) / s_eda)) AS z_eda,
    least(5.0, greatest(-5.0, (sig_cardio - c_cardio) / s_cardio)) AS z_cardio,
    least(5.0, greatest(-5.0, (sig_ppg - c_ppg) / s_ppg)) AS z_ppg
  FROM m JOIN stw USING (test_id)),
refs AS (
  SELECT test_id, question_index AS idx, group_idx AS g, stimulus_idx AS s, question_code AS code,
         z_resp AS r_resp, z_eda AS r_eda, z_cardio AS r_cardio, z_ppg AS r_ppg,
         question_index * 1000000 + group_idx * 1000 + stimulus_idx AS ord
  FROM z WHERE allowed AND q_type = 'C'),
pairs AS (
  SELECT z.test_id, z.group_idx, z.stimulus_idx, z.question_index AS q, r.*
  FROM z JOIN refs r ON r.test_id = z.test_id),
lft AS (
  SELECT test_id, group_idx, stimulus_idx,
    arg_max(struct_pack(idx := idx, g := g, s := s, code := code, r_resp := r_resp, r_eda := r_eda, r_cardio := r_cardio, r_ppg := r_ppg), ord) AS l
  FROM pairs WHERE idx < q GROUP BY test_id, group_idx, stimulus_idx),
rgt AS (
  SELECT test_id, group_idx, stimulus_idx,
    arg_min(struct_pack(idx := idx, g := g, s := s, code := code, r_resp := r_resp, r_eda := r_eda, r_cardio := r_cardio, r_ppg := r_ppg), ord) AS r
  FROM pairs WHERE idx >= q GROUP BY test_id, group_idx, stimulus_idx),
nr AS (
  SELECT z.*,
    CASE WHEN lft.l IS NULL OR (rgt.r IS NOT NULL AND abs(rgt.r.idx - z.question_index) < abs(lft.l.idx - z.question_index))
         THEN rgt.r ELSE lft.l END AS ref
  FROM z LEFT JOIN lft USING (test_id, group_idx, stimulus_idx) LEFT JOIN rgt USING (test_id, group_idx, stimulus_idx)),
d AS (
  SELECT *, ref.code AS ref_c_question_code, ref.g AS ref_group_idx, ref.s AS ref_stimulus_idx,
    coalesce(z_resp - ref.r_resp, 0.0) AS delta_resp_vs_c, coalesce(z_eda - ref.r_eda, 0.0) AS delta_eda_vs_c,
    coalesce(z_cardio - ref.r_cardio, 0.0) AS delta_cardio_vs_c, coalesce(z_ppg - ref.r_ppg, 0.0) AS delta_ppg_vs_c
  FROM nr),
e AS (
  SELECT *,
    0.45 * delta_eda_vs_c + 0.25 * delta_cardio_vs_c + 0.20 * delta_resp_vs_c + 0.10 * delta_ppg_vs_c AS pair_evidence,
    0.45 * z_eda + 0.25 * z_cardio + 0.20 * z_resp + 0.10 * z_ppg AS baseline_evidence,
    least(2.0, greatest(-2.0, (0.10 * coalesce(empirical_resp, 0.0) + 0.55 * coalesce(empirical_eda, 0.0)
        + 0.25 * coalesce(empirical_bv, 0.0) + 0.10 * coalesce(empirical_ple, 0.0)) / 2.0)) AS empirical_scaled
  FROM d),
evd AS (
  SELECT *, CASE WHEN q_type = 'R' THEN pair_evidence + 0.20 * empirical_scaled WHEN q_type = 'C' THEN -pair_evidence
                 ELSE 0.35 * baseline_evidence END AS evidence_score
  FROM e),
pr AS (
  SELECT *, 1.0 / (1.0 + exp(-least(20.0, greatest(-20.0, 1.45 * evidence_score - 0.10)))) AS p0 FROM evd),
scored AS (
  SELECT *, least(0.98, greatest(0.02, CASE WHEN q_type IN ('R','C') THEN p0 ELSE 0.5 + (p0 - 0.5) * 0.35 END)) AS deception_probability
  FROM pr),
scored2 AS (SELECT *, CAST(deception_probability >= 0.55 AS INTEGER) AS pred_label FROM scored)
"""

ROW_KEYS = "test_id, group_idx, stimulus_idx"


def direct_oracles() -> dict[str, str]:
    q = {}
    q["direct_signals"] = DIRECT_CTES + f"SELECT {ROW_KEYS}, " + ", ".join(
        f"{rd('sig_' + c)} AS sig_{c}" for c in ("resp", "eda", "cardio", "ppg")) + " FROM sig"
    q["direct_robust_z"] = DIRECT_CTES + f"SELECT {ROW_KEYS}, CAST(in_baseline AS INTEGER) AS in_baseline, " + ", ".join(
        f"{rd('z_' + c)} AS z_{c}" for c in ("resp", "eda", "cardio", "ppg")) + " FROM z"
    q["direct_nearest_reference"] = DIRECT_CTES + f"SELECT {ROW_KEYS}, ref_c_question_code, ref_group_idx, ref_stimulus_idx, " + ", ".join(
        f"{rd('delta_' + c + '_vs_c')} AS delta_{c}_vs_c" for c in ("resp", "eda", "cardio", "ppg")) + " FROM d"
    q["direct_scored"] = DIRECT_CTES + f"""SELECT {ROW_KEYS}, question_code, {rd('pair_evidence')} AS pair_evidence,
      {rd('baseline_evidence')} AS baseline_evidence, {rd('empirical_scaled')} AS empirical_scaled,
      {rd('evidence_score')} AS evidence_score, {rd('deception_probability')} AS deception_probability, pred_label
      FROM scored2"""
    q["direct_summary"] = DIRECT_CTES + f"""SELECT test_id,
      {rd('avg(deception_probability) FILTER (WHERE in_target)')} AS overall_score,
      CAST(count(*) AS BIGINT) AS n_items,
      CAST(count(*) FILTER (WHERE allowed AND q_type = 'R') AS BIGINT) AS n_relevant_questions,
      CAST(count(*) FILTER (WHERE allowed AND q_type = 'C') AS BIGINT) AS n_comparison_questions,
      {rd('avg(abs(delta_eda_vs_c)) FILTER (WHERE in_target)')} AS mean_abs_delta_eda,
      {rd('avg(abs(delta_cardio_vs_c)) FILTER (WHERE in_target)')} AS mean_abs_delta_cardio,
      {rd('avg(abs(delta_resp_vs_c)) FILTER (WHERE in_target)')} AS mean_abs_delta_resp,
      {rd('avg(abs(delta_ppg_vs_c)) FILTER (WHERE in_target)')} AS mean_abs_delta_ppg,
      CASE WHEN avg(deception_probability) FILTER (WHERE in_target) IS NULL THEN 'Требует внимания эксперта'
           WHEN avg(deception_probability) FILTER (WHERE in_target) >= 0.65 THEN 'Вероятно ложь'
           WHEN avg(deception_probability) FILTER (WHERE in_target) <= 0.35 THEN 'Вероятно правда'
           ELSE 'Требует внимания эксперта' END AS recommendation,
      'xdex_direct_scoring_v2_pairwise' AS method
      FROM scored2 GROUP BY test_id"""
    names = ["pair_evidence", "baseline_evidence", "empirical_scaled", "evidence_score", "deception_probability"]
    names += [f"{k}_{c}{e}" for k, e in (("sig", ""), ("z", ""), ("delta", "_vs_c")) for c in ("resp", "eda", "cardio", "ppg")]
    q["explain_table"] = DIRECT_CTES + f"SELECT {ROW_KEYS}, question_code, ref_c_question_code, " + ", ".join(
        f"{rd(c)} AS {c}" for c in names) + f", {rd('evidence_score')} AS raw_score FROM scored2"
    return q
