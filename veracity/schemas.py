"""Explicit schemas (never inferred)."""

from pyspark.sql import types as T

S, D, B, I = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType()

RAW = T.StructType([T.StructField(c, t) for c, t in [
    ("source_file", S), ("source_type", S), ("test_id", S), ("question_raw", S), ("question_code", S),
    ("question_text", S), ("question_type_code", S), ("question_type", S), ("is_allowed", B),
    ("waiting_answer_raw", S), ("waiting_answer_label", S), ("waiting_answer_ru", S), ("parameter", S),
    ("metric_i", D), ("metric_ii", D), ("score_result", D)]])

# score object of one stimulus channel; members are strings and converted with try_cast
SCORE_OBJECT = T.StructType([
    T.StructField("isManuallyChanged", B), T.StructField("manualValue", S), T.StructField("autoValue", S),
    T.StructField("value", S),
    T.StructField("automaticScorePoints", T.ArrayType(T.StructType([T.StructField("value", S)])))])

# subset of an archive's test.json that is read
TEST_JSON = T.StructType([
    T.StructField("testType", S),
    T.StructField("questionList", T.StructType([T.StructField("questions", T.ArrayType(T.StructType([
        T.StructField("type", S), T.StructField("isAllowed", B),
        T.StructField("contents", T.ArrayType(T.StructType([
            T.StructField("text", S), T.StructField("waitingAnswer", S)])))])))])),
    T.StructField("stimulusGroups", T.ArrayType(T.StructType([T.StructField("stimuli", T.ArrayType(T.StructType([
        T.StructField("questionIndex", T.LongType()),
        T.StructField("analysisInterval", T.StructType([
            T.StructField("isEmpty", B), T.StructField("min", D), T.StructField("max", D)])),
        T.StructField("scores", T.MapType(S, SCORE_OBJECT))])))])))])

FEEDBACK = T.StructType([T.StructField(c, t) for c, t in [
    ("created_at", T.TimestampType()), ("test_id", S), ("question_code", S), ("question_raw", S), ("question_type", S),
    ("deception_probability", D), ("pred_label", I), ("expert_review", S), ("expert_label", I)]])
