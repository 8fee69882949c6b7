"""Fixture views over the driver tables (see FIXTURES.md part B).

Each fixture is one SQL body valid in Spark SQL and DuckDB; only the base CTE
``ev`` differs (JSON accessor). In Spark the bodies run through ``spark.sql``
with the parquet scans bound as DataFrame parameters, so filters/projections
still reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EV_SPARK = "SELECT *, CAST(get_json_object(props,'$.k') AS INT) AS k FROM {events}"
EV_DUCK = "SELECT *, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events"

F_LONG = """
SELECT event_id,
 'T' || CAST(user_id AS VARCHAR(20)) AS test_id,
 CASE WHEN user_id % 2 = 0 THEN 'a.docx' ELSE 'b.xdex' END AS source_file,
 CASE WHEN user_id % 2 = 0 THEN 'docx' ELSE 'xdex' END AS source_type,
 CASE WHEN k % 7 = 6 THEN NULL ELSE 'Q' || CAST(k % 7 AS VARCHAR(20)) END AS question_raw,
 CASE WHEN k % 7 >= 5 THEN NULL ELSE 'c' || CAST(k % 7 AS VARCHAR(20)) END AS question_code,
 CASE WHEN k % 7 = 4 THEN NULL ELSE 'text ' || CAST(k % 7 AS VARCHAR(20)) END AS question_text,
 CASE WHEN k % 7 IN (0,1) THEN 'neutral' WHEN k % 7 IN (2,3) THEN 'control' WHEN k % 7 = 4 THEN 'probable_lie' WHEN k % 7 = 5 THEN 'sacrifice' END AS question_type,
 CAST(NULL AS VARCHAR(20)) AS question_type_code,
 k % 7 <> 1 AS is_allowed,
 CASE WHEN k % 7 = 4 THEN 'no' WHEN k % 7 = 0 THEN 'yes' END AS waiting_answer_raw,
 CASE WHEN k % 7 = 2 THEN 'Lie' WHEN k % 7 = 3 THEN 'Truth' END AS waiting_answer_label,
 CAST(NULL AS VARCHAR(20)) AS waiting_answer_ru,
 CASE event_type WHEN 'click' THEN ' КГР ' WHEN 'error' THEN 'eda' WHEN 'purchase' THEN 'АД' WHEN 'signup' THEN 'ДЫХАНИЕ' WHEN 'view' THEN CASE WHEN k % 10 = 0 THEN 'None' ELSE 'My Chan' END END AS parameter,
 value AS metric_i,
 CASE WHEN k % 11 = 0 THEN NULL ELSE value * (k + 1) / 100 END AS metric_ii,
 CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k AS DOUBLE) / 100 END AS score_result
FROM ev
"""

F_STIM = """
SELECT test_id, group_idx, stimulus_idx, question_index, event_id,
 CASE WHEN question_index IN (0,6) THEN 'I' WHEN question_index IN (1,4,8) THEN CASE WHEN user_id % 15 = 0 THEN 'S' ELSE 'C' END
      WHEN question_index = 3 THEN 'SR' ELSE CASE WHEN user_id % 10 = 0 THEN 'S' ELSE 'R' END END AS question_type_code,
 'q' || CAST(question_index AS VARCHAR(20)) AS question_code,
 user_id % 25 <> 0 AND k % 17 <> 0 AS is_allowed,
 CAST(k - 50 AS DOUBLE)/25 AS a_bv, value/50 AS a_eda,
 CASE WHEN k % 9 = 0 THEN NULL ELSE value/100 END AS a_eda2,
 CAST(50 - k AS DOUBLE)/40 AS a_ple,
 CASE WHEN k % 8 = 0 THEN NULL ELSE CAST(k AS DOUBLE)/30 END AS a_arlength,
 value/200 AS a_trlength,
 CASE WHEN k % 5 = 0 THEN CAST(k AS DOUBLE)/100 END AS counter_answer,
 CAST(k % 3 AS DOUBLE) AS empirical_resp, CAST(k % 5 AS DOUBLE) - 2 AS empirical_eda,
 CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k % 7 AS DOUBLE)/2 END AS empirical_bv, CAST(k % 2 AS DOUBLE) AS empirical_ple
FROM (SELECT *, CAST(FLOOR(rn/10) AS INT) AS group_idx, rn % 10 AS stimulus_idx, (rn * 3) % 10 AS question_index,
        'T' || CAST(user_id AS VARCHAR(20)) AS test_id
      FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS rn FROM ev) a) b
"""

F_PRED = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
 LEAST(1.0, GREATEST(0.0, l_discount * 6 + l_tax * 5)) AS y_prob,
 'm' || CAST(l_linenumber AS VARCHAR(20)) AS model, l_linestatus AS source_type,
 CAST(l_orderkey % 5 AS INT) AS fold, 's' || CAST(l_suppkey AS VARCHAR(20)) AS test_id FROM {lineitem}
"""

F_CELLS = """
SELECT conv_id AS doc, turn AS row_no, CASE WHEN role = 'user' THEN text ELSE '' END AS cell_question,
 CASE WHEN role = 'system' THEN '' ELSE 'КГР' END AS cell_parameter,
 CAST(LENGTH(text) % 97 AS VARCHAR(20)) || ',5 усл.' AS cell_i,
 CASE WHEN turn % 3 = 0 THEN ' 0,' || CAST(LENGTH(text) % 10 AS VARCHAR(20)) ELSE '' END AS cell_result FROM {conversations}
"""

F_FB = """
SELECT 'T' || CAST(user_id AS VARCHAR(20)) AS test_id, 'c' || CAST(k % 7 AS VARCHAR(20)) AS question_code, ts AS created_at,
 CASE event_type WHEN 'click' THEN 'Ложь' WHEN 'error' THEN 'truth' WHEN 'purchase' THEN ' YES ' WHEN 'signup' THEN 'нет' ELSE 'unsure' END AS expert_review FROM ev
"""

# rows of examination archives: a user's first 15 events are the questions, all events are stimuli in groups of ten
F_EXAM = """
SELECT 'T' || CAST(user_id AS VARCHAR(20)) AS test_id, user_id, rn, k, CAST(FLOOR(rn / 10) AS INT) AS group_idx,
 CAST(rn % 10 AS INT) AS stimulus_idx, rn < 15 AS is_question,
 CASE k % 9 WHEN 0 THEN 'I' WHEN 1 THEN 'r' WHEN 2 THEN 'C' WHEN 3 THEN 'SR' WHEN 4 THEN 'S' WHEN 5 THEN 'B' WHEN 6 THEN 'DL'
   WHEN 7 THEN 'zz' END AS q_type,
 CASE k % 5 WHEN 0 THEN FALSE WHEN 1 THEN CAST(NULL AS BOOLEAN) ELSE TRUE END AS q_allowed,
 CASE WHEN k % 11 <> 0 THEN ' text ' || CAST(k AS VARCHAR(20)) || ' ' END AS q_text,
 CASE k % 4 WHEN 0 THEN ' YES ' WHEN 1 THEN 'no' WHEN 2 THEN 'maybe' END AS q_waiting,
 k % 17 = 0 AS s_null, CASE WHEN k % 13 <> 0 THEN CAST((rn * 3) % 18 - 1 AS BIGINT) END AS s_question,
 k % 6 <> 0 AS s_interval, CASE k % 7 WHEN 0 THEN TRUE WHEN 1 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS s_empty,
 CAST(k AS DOUBLE) / 8 AS s_min, CAST(k AS DOUBLE) / 8 + 1 AS s_max,
 CASE WHEN k % 4 <> 0 THEN CAST(k AS VARCHAR(20)) END AS s_eda_auto, k % 8 = 0 AS s_eda_changed,
 CASE WHEN k % 3 = 0 THEN CAST(k AS VARCHAR(20)) || '.5' WHEN k % 3 = 1 THEN 'n/a' END AS s_ple,
 CASE WHEN user_id % 3 <> 0 THEN 'ZONE' END AS test_type
FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS rn FROM ev) a
"""

BODIES = {"f_exam": F_EXAM, "f_long": F_LONG, "f_stim": F_STIM, "f_pred": F_PRED, "f_cells": F_CELLS, "f_fb": F_FB}
USES_EV = {"f_exam", "f_long", "f_stim", "f_fb"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build fixture ``name`` from the parquet tables under ``sf_dir``."""
    body = BODIES[name]
    if name in USES_EV:
        q = f"WITH ev AS ({EV_SPARK}) {body}"
        return spark.sql(q, events=table(spark, sf_dir, "events"))
    if name == "f_pred":
        return spark.sql(body, lineitem=table(spark, sf_dir, "lineitem"))
    return spark.sql(body, conversations=table(spark, sf_dir, "conversations"))


def exam_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``f_exam`` as scanned archives: path, has_xml, test_json, document_json; one row per test."""
    e = fixture(spark, sf_dir, "f_exam")
    question = F.struct(F.col("q_type").alias("type"), F.col("q_allowed").alias("isAllowed"), F.array(F.struct(
        F.col("q_text").alias("text"), F.col("q_waiting").alias("waitingAnswer"))).alias("contents"))
    eda = F.struct(F.col("s_eda_changed").alias("isManuallyChanged"), F.lit("7.25").alias("manualValue"), F.col("s_eda_auto").alias("autoValue"))
    ple = F.when(F.col("s_ple").isNotNull(), F.struct(F.col("s_ple").alias("value")))
    stimulus = F.when(~F.col("s_null"), F.struct(
        F.col("s_question").alias("questionIndex"),
        F.when(F.col("s_interval"), F.struct(F.col("s_empty").alias("isEmpty"), F.col("s_min").alias("min"), F.col("s_max").alias("max")))
        .alias("analysisInterval"), F.struct(eda.alias("A_EDA"), ple.alias("A_PLE")).alias("scores")))

    def listed(order, value, only=None):
        pair = F.struct(F.col(order).alias("at"), value.alias("it"))
        return F.transform(F.sort_array(F.collect_list(pair if only is None else F.when(only, pair))), lambda x: x["it"])

    groups = e.groupBy("test_id", "group_idx").agg(listed("stimulus_idx", stimulus).alias("stimuli"))
    groups = groups.groupBy("test_id").agg(listed("group_idx", F.struct("stimuli")).alias("stimulusGroups"))
    tests = e.groupBy("test_id", "user_id", F.col("test_type").alias("testType")).agg(
        listed("rn", question, F.col("is_question")).alias("questions"))
    channels = (F.when(F.col("user_id") % 4 == 0, F.lit("{}"))
                .when(F.col("user_id") % 4 == 1, F.lit('{"channelInfos": {"eda": {}, "ar": {}}}'))
                .otherwise(F.lit('{"channelInfos": {"zz": {}, "tremor": 1, "bv": null}}')))
    doc = F.struct("testType", F.struct("questions").alias("questionList"), "stimulusGroups")
    return tests.join(groups, "test_id").select(
        F.concat(F.lit("/exams/"), F.col("test_id"), F.lit(".xdex")).alias("path"), F.lit(False).alias("has_xml"),
        F.to_json(doc).alias("test_json"), channels.alias("document_json"))


def duck_ctes(*names: str) -> str:
    """DuckDB ``WITH`` prefix defining the given fixtures over the registered views."""
    parts = []
    if any(n in USES_EV for n in names):
        parts.append(f"ev AS ({EV_DUCK})")
    for n in names:
        body = BODIES[n].replace("{lineitem}", "lineitem").replace("{conversations}", "conversations")
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
