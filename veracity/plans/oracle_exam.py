"""DuckDB oracle SQL for archive queries: the same rows, read relationally instead of through nested JSON."""

from ..functions import constants as K
from .fixtures import duck_ctes
from .oracle_direct import rd


def case_of(x: str, values: dict[str, str], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE {default} END"


def _questions(canonical: bool) -> str:
    raw = "upper(coalesce(q_type, 'UNK'))" if canonical else "coalesce(q_type, 'UNK')"
    code = case_of("t", K.TYPE_CODE_CANONICAL, "t") if canonical else "t"
    other = case_of(case_of("t", K.TYPE_CODE_CANONICAL, "t"), K.TYPE_CODE_RU, f"'{K.TYPE_RU_DEFAULT}'") if canonical else f"'{K.TYPE_RU_DEFAULT}'"
    start = 0 if canonical else 1
    return f"""SELECT test_id, CAST(rn + {start} AS INTEGER) AS question_index,
        {case_of('t', K.TYPE_CODE_SHORT, 't')} || row_number() OVER (PARTITION BY test_id, t ORDER BY rn) AS question_code,
        {code} AS question_type_code, t AS question_type_code_raw, {case_of('t', K.TYPE_CODE_RU, other)} AS question_type_ru,
        trim(coalesce(q_text, '')) AS question_text, coalesce(q_allowed, TRUE) AS is_allowed, q_waiting AS waiting_answer_raw,
        CASE lower(trim(q_waiting)) WHEN 'yes' THEN 'правда' WHEN 'no' THEN 'ложь' END AS waiting_answer_ru,
        CASE lower(trim(q_waiting)) WHEN 'yes' THEN 'Truth' WHEN 'no' THEN 'Lie' END AS waiting_answer_label
      FROM (SELECT *, {raw} AS t FROM f_exam WHERE is_question) z"""


def exam_oracles() -> dict[str, str]:
    base = duck_ctes("f_exam").rstrip()
    q = {"question_codes": base + " " + _questions(True)}
    manifest = _questions(False)
    q["exam_manifest"] = base + f""", m AS ({manifest}) SELECT * EXCLUDE (question_index, question_type_code_raw),
        question_index AS "order" FROM m"""
    empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in K.SCORE_COLUMNS if c not in ("a_eda", "a_ple"))
    q["stimuli"] = base + f""", q AS ({_questions(True)}),
      s AS (SELECT test_id, group_idx, stimulus_idx, CAST(s_question AS INTEGER) AS question_index,
              CASE WHEN s_interval THEN s_min END AS analysis_min, CASE WHEN s_interval THEN s_max END AS analysis_max,
              CASE WHEN s_eda_changed THEN 7.25 ELSE TRY_CAST(s_eda_auto AS DOUBLE) END AS a_eda, TRY_CAST(s_ple AS DOUBLE) AS a_ple
            FROM f_exam WHERE NOT s_null AND s_question IS NOT NULL AND NOT (s_interval AND coalesce(s_empty, FALSE)))
      SELECT s.test_id, s.test_id || '.xdex' AS source_file, group_idx, stimulus_idx, q.* EXCLUDE (test_id), {rd('analysis_min')} AS analysis_min,
        {rd('analysis_max')} AS analysis_max, {rd('a_eda')} AS a_eda, {rd('a_ple')} AS a_ple, {empty}
      FROM s JOIN q ON s.test_id = q.test_id AND s.question_index = q.question_index"""
    used = "NOT s_null AND NOT (s_interval AND coalesce(s_empty, FALSE))"
    q["structure_stats"] = base + f""" SELECT test_id, CAST(count(DISTINCT group_idx) AS INTEGER) AS groups_total,
        CAST(count(*) FILTER (WHERE NOT s_null) AS INTEGER) AS stimuli_total, CAST(count(*) FILTER (WHERE {used}) AS INTEGER) AS stimuli_nonempty,
        CAST(count(*) FILTER (WHERE NOT s_null AND NOT ({used})) AS INTEGER) AS stimuli_empty_or_skipped FROM f_exam GROUP BY test_id"""
    pretty = {c: K.SENSOR_NAMES.get(c, c) for c in ("ar", "eda", "bv", "tremor", "zz")}
    lists = [["ar", "eda"], ["bv", "tremor", "zz"]]
    raw, shown = ([";".join(x if not names else pretty[x] for x in c) for c in lists] for names in (False, True))
    q["exam_overview"] = base + f""", m AS ({manifest}),
      h AS (SELECT test_id, string_agg(question_type_ru || '=' || n, ';' ORDER BY question_type_ru) AS question_types,
              CAST(sum(n) AS BIGINT) AS questions_total, CAST(sum(a) AS BIGINT) AS questions_allowed
            FROM (SELECT test_id, question_type_ru, count(*) AS n, count(*) FILTER (WHERE is_allowed) AS a FROM m GROUP BY ALL) y GROUP BY test_id),
      t AS (SELECT DISTINCT test_id, user_id, test_type FROM f_exam)
      SELECT t.test_id, test_type, CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN '{raw[0]}' ELSE '{raw[1]}' END AS channels_raw,
        CAST(CASE user_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 3 END AS INTEGER) AS channels_total,
        CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN '{shown[0]}' ELSE '{shown[1]}' END AS channels_pretty,
        questions_total, questions_allowed, question_types FROM t JOIN h USING (test_id)"""
    lookup = "any_value(waiting_answer_label) AS waiting_answer_label, any_value(waiting_answer_ru) AS waiting_answer_ru, any_value(waiting_answer_raw) AS waiting_answer_raw"
    q["attach_expected"] = base + f""", m AS ({manifest}), l AS (SELECT test_id, question_code, {lookup} FROM m GROUP BY ALL),
      p AS (SELECT test_id, 'Пв' || (rn % 6) AS question_code, rn FROM f_exam)
      SELECT p.*, waiting_answer_label, waiting_answer_ru, waiting_answer_raw FROM p LEFT JOIN l USING (test_id, question_code)"""
    q["analyze_route"] = duck_ctes("f_long") + """SELECT test_id, CAST(count(*) AS BIGINT) AS n_records,
        CASE WHEN bool_or(coalesce(metric_ii > 60, FALSE)) THEN 'model_metrics' ELSE 'xdex_direct_scoring_v2_pairwise' END AS method
      FROM f_long GROUP BY test_id"""
    return q
