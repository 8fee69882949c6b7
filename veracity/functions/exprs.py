"""Column -> Column expressions (EXP1-EXP21). Everything here is a native
Catalyst expression: no Python UDFs, so it stays inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

NUM_PATTERN = r"-?[0-9]+(?:\.[0-9]+)?"
CODE_PATTERN = "^([Ѐ-ӿA-Za-z]{1,3}[0-9]+)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_map(d: dict) -> Column:
    """Literal map for small fixed vocabularies (folded into the plan)."""
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def utrim(x) -> Column:
    """Unicode-aware strip (Spark ``trim`` keeps NBSP and other spaces)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def clip(x, lo: float, hi: float) -> Column:
    """Bounded value; NULL stays NULL (bare least/greatest skip NULLs)."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def safe_div(a, b) -> Column:
    """EXP5: a / b with a zero denominator giving NULL."""
    return _c(a) / F.nullif(_c(b), F.lit(0.0))


def to_double(x) -> Column:
    """EXP6: numeric coercion; bad input, NaN and +-inf become NULL."""
    d = _c(x).cast("string").try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def nan_to_null(x) -> Column:
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def to_float(x) -> Column:
    """EXP1: lenient number parse of a cell: spaces/NBSP removed, comma as
    decimal point, first ``-?d+(.d+)?`` match, else NULL."""
    s = F.replace(F.regexp_replace(utrim(x), r"[\u00a0 ]", ""), F.lit(","), F.lit("."))
    m = F.regexp_extract(s, NUM_PATTERN, 0)
    return F.nullif(m, F.lit("")).try_cast("double")


def question_parts(x) -> Column:
    """EXP2+EXP3: split a raw question into struct(code, text, type)."""
    raw = _c(x)
    t = utrim(raw)
    code = F.nullif(F.regexp_extract(t, CODE_PATTERN, 1), F.lit(""))
    rest = utrim(F.substring(t, F.length(code) + 1, 1 << 30))
    qtype = F.coalesce(lit_map(K.QUESTION_PREFIX_TYPE)[F.substring(code, 1, 2)], F.lit("other"))
    empty = raw.isNull() | (raw == "")
    return (F.when(empty, F.struct(F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("text"),
                                   F.lit(None).cast("string").alias("type")))
            .when(code.isNull(), F.struct(F.lit(None).cast("string").alias("code"), t.alias("text"),
                                          F.lit(None).cast("string").alias("type")))
            .otherwise(F.struct(code.alias("code"), F.nullif(rest, F.lit("")).alias("text"), qtype.alias("type"))))


def type_from_code(code, type_ru=None) -> Column:
    """EXP3: archive type code -> question type; unknown code falls back to the
    Russian type name fragments, then 'other'."""
    up = F.upper(F.coalesce(_c(code).cast("string"), F.lit("None")))
    fallback = F.lit("other")
    if type_ru is not None:
        low = F.lower(_c(type_ru))
        fb = None
        for frag, val in K.TYPE_RU_FRAGMENTS:
            cond = low.contains(frag)
            fb = F.when(cond, val) if fb is None else fb.when(cond, val)
        fallback = fb.otherwise("other")
    return F.coalesce(lit_map(K.TYPE_CODE_TO_TYPE)[up], fallback)


def normalize_parameter(x) -> Column:
    """EXP4: channel name -> canonical channel ('none' for NULL)."""
    up = F.upper(utrim(F.coalesce(_c(x).cast("string"), F.lit("None"))))
    return F.coalesce(lit_map(K.PARAMETER_MAP)[up], F.replace(F.lower(up), F.lit(" "), F.lit("_")))


def expected_answer(x) -> Column:
    """EXP7: waitingAnswer -> struct(label, ru): yes=Truth/правда, no=Lie/ложь."""
    w = F.lower(utrim(_c(x)))
    lab = F.when(w == "yes", K.EXPECTED_YES[0]).when(w == "no", K.EXPECTED_NO[0])
    ru = F.when(w == "yes", K.EXPECTED_YES[1]).when(w == "no", K.EXPECTED_NO[1])
    return F.named_struct(F.lit("label"), lab, F.lit("ru"), ru)  # names survive inside lambdas


def score_value(s) -> Column:
    """EXP8: numeric value of a score object (struct with string members):
    manual value when flagged and numeric, else auto value, else value, else
    mean of the numeric automatic score points."""
    s = _c(s)
    manual = F.when(F.coalesce(s["isManuallyChanged"], F.lit(False)), to_double(s["manualValue"]))
    pts = F.filter(F.transform(s["automaticScorePoints"], lambda p: to_double(p["value"])), lambda v: v.isNotNull())
    mean_pts = F.when(F.size(pts) > 0, F.aggregate(pts, F.lit(0.0), lambda a, v: a + v) / F.size(pts))
    return F.coalesce(manual, to_double(s["autoValue"]), to_double(s["value"]), mean_pts)


def proxy_score(counter_answer="counter_answer", cols=("a_bv", "a_eda", "a_ple")) -> Column:
    """EXP9: counter_answer, else mean |x| of the non-null reaction scores."""
    arr = F.filter(F.array(*[F.abs(_c(c)) for c in cols]), lambda v: v.isNotNull())
    mean_abs = F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda a, v: a + v) / F.size(arr))
    return F.coalesce(_c(counter_answer), mean_abs)


def z0(x) -> Column:
    return F.coalesce(_c(x), F.lit(0.0))


def channel_signals() -> dict[str, Column]:
    """EXP10: the four reaction signals (NULL inputs count as 0)."""
    return {
        "sig_resp": -z0("a_bv") + z0(F.abs(F.col("a_trlength"))),
        "sig_eda": z0("a_eda") + 0.5 * z0("a_eda2"),
        "sig_cardio": z0("a_arlength"),
        "sig_ppg": z0(F.abs(F.col("a_ple"))),
    }


def weighted(cols: dict[str, float], fmt: str) -> Column:
    """Weighted sum in the fixed channel order."""
    return reduce(lambda a, b: a + b, [F.lit(w) * F.col(fmt.format(k)) for k, w in cols.items()])


def empirical_scaled() -> Column:
    raw = reduce(lambda a, b: a + b, [F.lit(w) * z0(c) for c, w in K.EMPIRICAL_WEIGHTS.items()])
    return clip(raw / 2.0, -2.0, 2.0)


def direct_probability(evidence, qtype) -> Column:
    """EXP13: logistic squash; non R/C questions shrink towards 0.5."""
    logit = clip(K.LOGIT_SLOPE * _c(evidence) + K.LOGIT_BIAS, -K.LOGIT_CLIP, K.LOGIT_CLIP)
    p = 1.0 / (1.0 + F.exp(-logit))
    p = F.when(_c(qtype).isin("R", "C"), p).otherwise(0.5 + (p - 0.5) * K.OTHER_SHRINK)
    return clip(p, K.PROB_MIN, K.PROB_MAX)


def recommend(p, hi: float, lo: float, missing: str = K.REC_EXPERT) -> Column:
    """EXP14: three-way recommendation; NULL handled first (NaN never enters)."""
    p = _c(p)
    return (F.when(p.isNull(), F.lit(missing)).when(p >= hi, K.REC_LIE).when(p <= lo, K.REC_TRUTH)
            .otherwise(K.REC_EXPERT))


def review_label(x) -> Column:
    """EXP15: free-text expert review -> 1 (lie) / 0 (truth) / NULL."""
    w = F.lower(utrim(_c(x).cast("string")))
    return (F.when(w.isin(*K.REVIEW_LIE_WORDS), F.lit(1)).when(w.isin(*K.REVIEW_TRUTH_WORDS), F.lit(0))
            .otherwise(F.lit(None).cast("int")))


def template_label(label="waiting_answer_label", raw="waiting_answer_raw") -> Column:
    """EXP16 part: expected answer label (lie=1/truth=0), else raw no=1/yes=0."""
    lab = F.lower(utrim(_c(label)))
    rw = F.lower(utrim(_c(raw)))
    a = F.when(lab == "lie", F.lit(1)).when(lab == "truth", F.lit(0))
    b = F.when(rw == "no", F.lit(1)).when(rw == "yes", F.lit(0))
    return F.coalesce(a, b).cast("int")


def weak_label(score="score_result", threshold: float = K.WEAK_LABEL_THRESHOLD) -> Column:
    s = _c(score)
    return F.when(s.isNotNull(), (s >= threshold).cast("int"))


def blend_scores(prob, vote) -> Column:
    """EXP19: mean of the two scores, else whichever is present."""
    return F.coalesce((_c(prob) * 0.5 + _c(vote) * 0.5), _c(vote), _c(prob))


def default_review(label="waiting_answer_label", raw="waiting_answer_raw", pred="pred_label") -> Column:
    """EXP20: suggested review: expected answer, else prediction, else Truth."""
    lab = utrim(_c(label))
    a = F.when(lab == "Lie", "Lie").when(lab == "Truth", "Truth")
    rw = F.lower(utrim(_c(raw)))
    b = F.when(rw == "no", "Lie").when(rw == "yes", "Truth")
    c = F.when(_c(pred) == 1, "Lie").when(_c(pred).isNotNull(), "Truth")
    return F.coalesce(a, b, c, F.lit("Truth"))


def stem_from_path(path) -> Column:
    """EXP21: file stem of a path/URI."""
    return F.regexp_extract(_c(path), r"([^/]+?)(?:\.[^./]*)?$", 1)


def file_name(path) -> Column:
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)


def sensor_display(ids) -> Column:
    """EXP18: sorted sensor ids -> display names (default: the id)."""
    m = lit_map(K.SENSOR_NAMES)
    return F.transform(F.array_sort(_c(ids)), lambda s: F.coalesce(m[s], s))


def short_code(type_raw) -> Column:
    return F.coalesce(lit_map(K.TYPE_CODE_SHORT)[_c(type_raw)], _c(type_raw))


def type_ru(type_raw, canonical=None) -> Column:
    m = lit_map(K.TYPE_CODE_RU)
    alt = m[_c(canonical)] if canonical is not None else F.lit(None)
    return F.coalesce(m[_c(type_raw)], alt, F.lit(K.TYPE_RU_DEFAULT))


def canonical_code(type_raw) -> Column:
    return F.coalesce(lit_map(K.TYPE_CODE_CANONICAL)[_c(type_raw)], _c(type_raw))
