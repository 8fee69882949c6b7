"""DuckDB oracle SQL for verdict and scalar-expression queries."""

from .fixtures import duck_ctes
from .oracle_direct import DIRECT_CTES, rd

MEANS = ["deception_probability", "raw_score", "evidence_score", "pair_evidence", "baseline_evidence",
         "empirical_scaled", "delta_resp_vs_c", "delta_eda_vs_c", "delta_cardio_vs_c", "delta_ppg_vs_c",
         "z_resp", "z_eda", "z_cardio", "z_ppg", "sig_resp", "sig_eda", "sig_cardio", "sig_ppg"]
FIRSTS = ["question_type_code", "is_allowed", "ref_c_question_code"]
SCORES = ["a_bv", "a_eda", "a_eda2", "a_ple", "a_arlength", "a_trlength", "counter_answer", "empirical_resp",
          "empirical_bv", "empirical_eda", "empirical_ple"]  # counter_resp/counter_trm are absent (NULL) in F_STIM
LIE, TRUTH, EXPERT = "'Вероятно ложь'", "'Вероятно правда'", "'Требует внимания эксперта'"

COLLAPSE = DIRECT_CTES.rstrip() + """,
scored3 AS (SELECT *, evidence_score AS raw_score FROM scored2),
col0 AS (
  SELECT test_id, question_code,
    """ + ",\n    ".join(f"first({c} ORDER BY stimulus_idx, group_idx) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in FIRSTS) + """,
    """ + ",\n    ".join(f"avg({c}) AS {c}" for c in MEANS) + """
  FROM scored3 GROUP BY test_id, question_code),
collapsed AS (SELECT *, CAST(coalesce(deception_probability, 0.0) >= 0.55 AS INTEGER) AS pred_label FROM col0),
c1 AS (SELECT *, upper(coalesce(question_type_code, 'None')) AS tc, coalesce(is_allowed, true) AS al,
         coalesce(deception_probability >= 0.55, false) AS lie FROM collapsed),
c2 AS (SELECT *, CASE WHEN max(CASE WHEN tc = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY test_id) = 1
                      THEN tc = 'R' ELSE tc <> 'I' END AS m0 FROM c1),
c3 AS (SELECT *, CASE WHEN sum(CASE WHEN m0 AND al THEN 1 ELSE 0 END) OVER (PARTITION BY test_id) > 0
                      THEN m0 AND al ELSE m0 END AS m1 FROM c2),
c4 AS (SELECT *, CASE WHEN sum(CASE WHEN m1 THEN 1 ELSE 0 END) OVER (PARTITION BY test_id) > 0
                      THEN m1 ELSE true END AS m2 FROM c3),
votes0 AS (SELECT test_id, count(*) FILTER (WHERE m2) AS n, count(*) FILTER (WHERE m2 AND lie) AS l FROM c4 GROUP BY test_id),
votes AS (
  SELECT test_id, CAST(n AS BIGINT) AS n_questions, CAST(l AS BIGINT) AS lie_count, CAST(n - l AS BIGINT) AS truth_count,
    CAST(l AS DOUBLE) / nullif(n, 0) AS lie_share FROM votes0),
votes2 AS (
  SELECT *, CASE WHEN lie_share IS NULL THEN 'Insufficient data' WHEN lie_share >= 0.65 THEN """ + LIE + """
                 WHEN lie_share <= 0.35 THEN """ + TRUTH + " ELSE " + EXPERT + """ END AS recommendation FROM votes),
summ AS (
  SELECT test_id, avg(deception_probability) FILTER (WHERE in_target) AS overall_score FROM scored2 GROUP BY test_id),
summ2 AS (
  SELECT *, CASE WHEN overall_score IS NULL THEN """ + EXPERT + " WHEN overall_score >= 0.65 THEN " + LIE + """
                 WHEN overall_score <= 0.35 THEN """ + TRUTH + " ELSE " + EXPERT + """ END AS recommendation FROM summ)
"""


def _rec(x: str, hi: float, lo: float, missing: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN {missing} WHEN {x} >= {hi} THEN {LIE} WHEN {x} <= {lo} THEN {TRUTH} "
            f"ELSE {EXPERT} END")


SCORE_JSON_DUCK = """SELECT event_id,
 '{"isManuallyChanged": ' || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END
 || ', "manualValue": ' || CASE WHEN k % 6 = 0 THEN '"n/a"' ELSE '"' || CAST(k AS VARCHAR(20)) || '.5"' END
 || CASE WHEN k % 4 = 0 THEN '' ELSE ', "autoValue": ' || CAST(k % 50 AS VARCHAR(20)) END
 || CASE WHEN k % 5 = 0 THEN ', "value": "' || CAST(k AS VARCHAR(20)) || '"' ELSE '' END
 || ', "automaticScorePoints": [{"value": ' || CAST(k % 10 AS VARCHAR(20)) || '}, {"value": "x"}, {"value": "'
 || CAST(k % 7 AS VARCHAR(20)) || '.25"}]}' AS j
FROM ev"""


def verdict_oracles() -> dict[str, str]:
    q = {}
    q["question_collapse"] = COLLAPSE + "SELECT test_id, question_code, " + ", ".join(FIRSTS) + ", " + ", ".join(
        f"{rd(c)} AS {c}" for c in MEANS) + ", pred_label FROM collapsed"
    q["question_votes"] = COLLAPSE + f"""SELECT test_id, n_questions, lie_count, truth_count, {rd('lie_share')} AS lie_share,
        recommendation FROM votes2"""
    q["verdict_blend"] = COLLAPSE + f""", vb AS (
        SELECT s.test_id, s.overall_score AS p, s.recommendation AS rp, v.lie_share AS v, v.recommendation AS rv
        FROM summ2 s FULL JOIN votes2 v ON s.test_id = v.test_id),
      vb2 AS (SELECT *, coalesce(p * 0.5 + v * 0.5, v, p) AS f FROM vb)
      SELECT test_id, {rd('p')} AS overall_score_probability, rp AS recommendation_probability,
        {rd('v')} AS overall_score_vote, rv AS recommendation_vote, {rd('f')} AS overall_score,
        CASE WHEN f IS NULL THEN rv ELSE {_rec('f', 0.65, 0.35, EXPERT)} END AS recommendation
      FROM vb2"""
    proxy = ("coalesce(counter_answer, (coalesce(abs(a_bv), 0.0) + coalesce(abs(a_eda), 0.0) + coalesce(abs(a_ple), 0.0))"
             " / nullif(CAST(a_bv IS NOT NULL AS INTEGER) + CAST(a_eda IS NOT NULL AS INTEGER) + CAST(a_ple IS NOT NULL AS INTEGER), 0))")
    typ = ("CASE upper(coalesce(question_type_code, 'None')) WHEN 'I' THEN 'neutral' WHEN 'R' THEN 'control' "
           "WHEN 'C' THEN 'probable_lie' WHEN 'SR' THEN 'sacrifice' WHEN 'S' THEN 'symptomatic' WHEN 'B' THEN 'other' "
           "WHEN 'DL' THEN 'probable_lie' ELSE 'other' END")
    melt_rows = " UNION ALL ".join(
        f"SELECT test_id, group_idx, stimulus_idx, '{c}' AS parameter, {c} AS metric_i, question_code, question_type_code, "
        f"is_allowed, {proxy} AS score_result FROM f_stim WHERE {c} IS NOT NULL" for c in SCORES)
    q["melt_channels"] = duck_ctes("f_stim") + f""", m AS ({melt_rows})
      SELECT test_id, group_idx, stimulus_idx, CAST(NULL AS VARCHAR) AS source_file, 'xdex' AS source_type,
        CAST(NULL AS VARCHAR) AS question_raw, question_code, CAST(NULL AS VARCHAR) AS question_text,
        upper(coalesce(question_type_code, 'None')) AS question_type_code, {typ} AS question_type,
        coalesce(is_allowed, true) AS is_allowed, CAST(NULL AS VARCHAR) AS waiting_answer_raw,
        CAST(NULL AS VARCHAR) AS waiting_answer_label, CAST(NULL AS VARCHAR) AS waiting_answer_ru,
        {rd('score_result')} AS score_result, parameter, {rd('metric_i')} AS metric_i, CAST(NULL AS DOUBLE) AS metric_ii
      FROM m"""
    q["degenerate_flag"] = COLLAPSE + f""", dg AS (
        SELECT test_id, count(DISTINCT coalesce(deception_probability, 0.0)) AS nd,
          stddev_samp(coalesce(deception_probability, 0.0)) AS sd, min(coalesce(deception_probability, 0.0)) AS mn,
          max(coalesce(deception_probability, 0.0)) AS mx FROM collapsed GROUP BY test_id)
      SELECT test_id, CAST(nd AS BIGINT) AS n_distinct, {rd('sd')} AS sd, {rd('mn')} AS p_min, {rd('mx')} AS p_max,
        CAST(nd <= 1 OR coalesce(sd < 1e-9, false) OR mx < 0.20 OR mn > 0.85 AS INTEGER) AS degenerate FROM dg"""
    q["prob_diagnostics"] = COLLAPSE + f"""SELECT test_id, {rd('min(deception_probability)')} AS prob_min,
        {rd('max(deception_probability)')} AS prob_max, {rd('avg(deception_probability)')} AS prob_mean
      FROM collapsed GROUP BY test_id"""
    q["chart_points"] = COLLAPSE + f"""SELECT test_id, question_code, {rd('deception_probability')} AS deception_probability,
        CAST(row_number() OVER (PARTITION BY test_id ORDER BY deception_probability DESC, question_code) AS INTEGER) AS rank
      FROM collapsed WHERE question_code IS NOT NULL AND deception_probability IS NOT NULL"""
    q["score_precedence"] = duck_ctes("f_stim") + f""", sj AS ({SCORE_JSON_DUCK}),
      sv AS (SELECT event_id, coalesce(
          CASE WHEN coalesce(TRY_CAST(json_extract_string(j, '$.isManuallyChanged') AS BOOLEAN), false)
               THEN TRY_CAST(json_extract_string(j, '$.manualValue') AS DOUBLE) END,
          TRY_CAST(json_extract_string(j, '$.autoValue') AS DOUBLE),
          TRY_CAST(json_extract_string(j, '$.value') AS DOUBLE),
          list_avg(list_filter(list_transform(json_extract_string(j, '$.automaticScorePoints[*].value'),
                                              lambda x: TRY_CAST(x AS DOUBLE)), lambda x: x IS NOT NULL))) AS v FROM sj)
      SELECT event_id, {rd('v')} AS score_value FROM sv"""
    q["expected_answer"] = duck_ctes("f_stim") + """, ea AS (SELECT event_id, CASE k % 5 WHEN 0 THEN ' YES ' WHEN 1 THEN 'no'
        WHEN 2 THEN 'No ' WHEN 3 THEN 'maybe' END AS waiting_answer_raw FROM ev)
      SELECT event_id, waiting_answer_raw,
        CASE lower(trim(waiting_answer_raw)) WHEN 'yes' THEN 'Truth' WHEN 'no' THEN 'Lie' END AS waiting_answer_label,
        CASE lower(trim(waiting_answer_raw)) WHEN 'yes' THEN 'правда' WHEN 'no' THEN 'ложь' END AS waiting_answer_ru
      FROM ea"""
    q["proxy_score"] = duck_ctes("f_stim") + f"SELECT test_id, group_idx, stimulus_idx, {rd(proxy)} AS proxy_score FROM f_stim"
    q["recommendation_bands"] = DIRECT_CTES + f""", rb AS (
        SELECT test_id, avg(deception_probability) FILTER (WHERE allowed AND q_type = 'R') AS score FROM scored2 GROUP BY test_id)
      SELECT test_id, {rd('score')} AS score, {_rec('score', 0.60, 0.40, EXPERT)} AS recommendation_ml,
        {_rec('score', 0.65, 0.35, EXPERT)} AS recommendation_direct,
        {_rec('score', 0.65, 0.35, "'Insufficient data'")} AS recommendation_vote FROM rb"""
    return q
