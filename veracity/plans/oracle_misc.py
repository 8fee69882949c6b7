"""DuckDB oracle SQL for feedback and document-cell queries."""

from .fixtures import duck_ctes
from .oracle_direct import rd
from .oracle_long import LONG_CTES

NBSP = " "
# Unicode-aware trim (RE2): whitespace plus separator characters
UTRIM = "regexp_replace({x}, '^[\\s\\p{{Z}}\\x0B\\x{{85}}]+|[\\s\\p{{Z}}\\x0B\\x{{85}}]+$', '', 'g')"


def utrim(x: str) -> str:
    return UTRIM.format(x=x)


def to_float(x: str) -> str:
    s = f"replace(regexp_replace({utrim(x)}, '[{NBSP} ]', '', 'g'), ',', '.')"
    return f"TRY_CAST(nullif(regexp_extract({s}, '-?[0-9]+(?:\\.[0-9]+)?', 0), '') AS DOUBLE)"


META = ["question_type_code", "is_allowed", "waiting_answer_raw", "waiting_answer_label", "waiting_answer_ru"]
REVIEW = ("CASE WHEN lower({t}) IN ('ложь', 'lie', '1', 'true', 'yes', 'да') THEN 1 "
          "WHEN lower({t}) IN ('правда', 'truth', '0', 'false', 'no', 'нет') THEN 0 END")
PREFIX = {"Нв": "neutral", "Пв": "control", "Вл": "probable_lie", "Жв": "sacrifice", "Св": "symptomatic"}


def split_sql(x: str) -> str:
    t = utrim(x)
    code = f"nullif(regexp_extract({t}, '^([Ѐ-ӿA-Za-z]{{1,3}}[0-9]+)', 1), '')"
    rest = f"nullif({utrim(f'substr({t}, length({code}) + 1)')}, '')"
    typ = "coalesce(CASE substr(" + code + ", 1, 2) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PREFIX.items()) + " END, 'other')"
    empty = f"({x} IS NULL OR {x} = '')"
    return (f"CASE WHEN {empty} THEN NULL ELSE {code} END AS question_code, "
            f"CASE WHEN {empty} THEN NULL WHEN {code} IS NULL THEN {t} ELSE {rest} END AS question_text, "
            f"CASE WHEN {empty} OR {code} IS NULL THEN NULL ELSE {typ} END AS question_type")


def misc_oracles() -> dict[str, str]:
    q = {}
    given = "source_type IS DISTINCT FROM 'docx'"
    q["upload_adapter"] = duck_ctes("f_long") + f"""SELECT source_file, test_id, question_raw, parameter,
        CASE WHEN {given} THEN source_type ELSE 'upload' END AS source_type,
        CASE WHEN {given} THEN question_code ELSE question_raw END AS question_code,
        CASE WHEN {given} THEN question_text ELSE question_raw END AS question_text,
        CASE WHEN {given} THEN question_type ELSE 'other' END AS question_type,
        {", ".join(f"CASE WHEN {given} THEN {c} END AS {c}" for c in META)},
        {rd('metric_i')} AS metric_i, {rd('metric_ii')} AS metric_ii, {rd('score_result')} AS score_result
        FROM f_long"""
    lab = REVIEW.format(t=utrim("expert_review"))
    q["review_labels"] = duck_ctes("f_fb") + f"SELECT test_id, question_code, expert_review, {lab} AS expert_label FROM f_fb"
    latest = duck_ctes("f_fb") + f""", lb AS (SELECT *, {lab} AS expert_label FROM f_fb),
      lt AS (SELECT test_id, question_code, expert_review, CAST(expert_label AS INTEGER) AS expert_label,
               row_number() OVER (PARTITION BY test_id, question_code ORDER BY created_at DESC) AS rn
             FROM lb WHERE expert_label IS NOT NULL)"""
    q["feedback_latest"] = latest + " SELECT test_id, question_code, expert_review, expert_label FROM lt WHERE rn = 1"
    q["feedback_upsert"] = q["feedback_latest"]
    fbl = f"""fbl AS (SELECT test_id AS t, question_code AS qc, expert_label FROM (
        SELECT *, row_number() OVER (PARTITION BY test_id, question_code ORDER BY created_at DESC) AS rn
        FROM (SELECT *, {lab} AS expert_label FROM f_fb) z WHERE expert_label IS NOT NULL) y WHERE rn = 1)"""
    fb_body = duck_ctes("f_fb").split("f_fb AS (", 1)[1]
    q["feedback_overlay"] = LONG_CTES.rstrip() + ",\n      f_fb AS (" + fb_body.rstrip() + f""",
      {fbl}
      SELECT test_id, source_file, source_type, question_code, question_raw, question_text, question_type, label_bootstrap,
        f.expert_label AS label_expert, CAST(coalesce(f.expert_label, label_bootstrap) AS INTEGER) AS label_train,
        CASE WHEN f.expert_label IS NOT NULL THEN 'expert' ELSE label_source END AS label_source_train
      FROM wide2 w LEFT JOIN fbl f ON w.test_id = f.t AND w.question_code = f.qc"""
    q["cell_numbers"] = duck_ctes("f_cells") + f"""SELECT doc, row_no, {rd(to_float('cell_i'))} AS metric_i,
        {rd(to_float('cell_result'))} AS score_result FROM f_cells"""
    q["question_split"] = duck_ctes("f_cells") + f"SELECT doc, row_no, cell_question, {split_sql('cell_question')} FROM f_cells"
    cq = f"nullif({utrim('coalesce(cell_question, ' + chr(39) + chr(39) + ')')}, '')"
    q["carry_forward"] = duck_ctes("f_cells") + f""", c1 AS (SELECT *, {cq} AS q0, {to_float('cell_result')} AS r0 FROM f_cells),
      c2 AS (SELECT *, last_value(q0 IGNORE NULLS) OVER w AS question_raw, last_value(r0 IGNORE NULLS) OVER w AS score_result
             FROM c1 WINDOW w AS (PARTITION BY doc ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      SELECT doc, row_no, question_raw, {split_sql('question_raw')}, {utrim("coalesce(cell_parameter, '')")} AS parameter,
        {rd(to_float('cell_i'))} AS metric_i, CAST(NULL AS DOUBLE) AS metric_ii, {rd('score_result')} AS score_result
      FROM c2 WHERE {utrim("coalesce(cell_parameter, '')")} <> ''"""
    return q
