"""Training-free direct scoring of stimulus tables (JOB4).

Per test: four reaction signals, robust z against the test's own baseline
questions, contrast of every stimulus against its nearest comparison ('C')
question, a logistic squash to a probability, and a per-test verdict.

Scale design: every per-test statistic is a ``groupBy`` (partial aggregation
before the shuffle) or a two-level exact median from :mod:`ordered` (a hot
test is split across tasks). The nearest-reference search runs on a table
pre-aggregated to one row per (test, question_index), never on the test's
stimuli. Per-test results are joined back on the test key; AQE turns those
joins into broadcasts when the measured side is small and splits skewed
partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from .ordered import group_median, materialize, neighbours

SIG = {ch: f"sig_{ch}" for ch in K.CHANNELS}


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def signals(stim: DataFrame) -> DataFrame:
    """EXP10 + type/allowed normalisation (upper type code, NULL allowed = true)."""
    sig = E.channel_signals()
    return stim.select(
        "*",
        F.upper(F.coalesce(F.col("question_type_code").cast("string"), F.lit("None"))).alias("q_type"),
        F.coalesce(F.col("is_allowed"), F.lit(True)).alias("allowed"),
        *[c.alias(n) for n, c in sig.items()])


def test_tiers(sig: DataFrame, by) -> DataFrame:
    """Per-test counts that drive the FLT3/FLT4 cascades (one aggregate)."""
    by = _by(by)
    a, t = F.col("allowed"), F.col("q_type")
    return sig.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(a & t.isin("I", "C")).alias("n_base_ic"),
        F.count_if(a).alias("n_allowed"),
        F.count_if(a & (t == "R")).alias("n_rel"),
        F.count_if(a & (t == "C")).alias("n_cmp"))


def with_masks(sig: DataFrame, tiers: DataFrame, by) -> DataFrame:
    """FLT3 baseline and FLT4 target flags from the per-test counts."""
    by = _by(by)
    a, t = F.col("allowed"), F.col("q_type")
    j = sig.join(tiers, by, "left")
    base = (F.when(F.col("n_base_ic") > 0, a & t.isin("I", "C")).when(F.col("n_allowed") > 0, a)
            .otherwise(F.lit(True)))
    target = (F.when(F.col("n_rel") > 0, a & (t == "R")).when(F.col("n_allowed") > 0, a).otherwise(F.lit(True)))
    n_base = (F.when(F.col("n_base_ic") > 0, F.col("n_base_ic")).when(F.col("n_allowed") > 0, F.col("n_allowed"))
              .otherwise(F.col("n_items")))
    return (j.withColumn("in_baseline", base).withColumn("in_target", target)
            .withColumn("n_baseline", n_base))


def _scale(mad, sd):
    robust = mad * K.MAD_FACTOR
    return F.when(robust > K.SCALE_EPS, robust).when(sd > K.SCALE_EPS, sd).otherwise(F.lit(1.0))


def robust_stats(masked: DataFrame, by) -> DataFrame:
    """AGG6: per test and channel: centre = median, scale = 1.4826*MAD, else
    population sd, else 1 (over baseline rows). One row per test, wide."""
    by = _by(by)
    # test and channel are one struct key, which compares null-safe: every step shares its placement.
    # The values are read again by every pass; only the centres, a row per test and channel, are written
    v = (masked.where("in_baseline").select(F.struct(*by).alias("_t"), *SIG.values())
         .unpivot("_t", list(SIG.values()), "channel", "x").where(F.col("x").isNotNull())
         .select(F.struct("_t", "channel").alias("_g"), "x"))
    centre = materialize(group_median(v, ["_g"], "x", "centre"))
    dev = v.join(centre, "_g").select("_g", "centre", (F.col("x") - F.col("centre")).alias("d"),
                                      F.abs(F.col("x") - F.col("centre")).alias("dev"))
    mad = group_median(dev, ["_g"], "dev", "mad")
    # the variance about the median, less the square of the mean's distance from it
    var = F.avg(F.col("d") * F.col("d")) - F.pow(F.avg("d"), F.lit(2.0))
    sd = dev.groupBy("_g").agg(F.first("centre").alias("centre"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("sd"))
    st = sd.join(mad, "_g", "left").select(F.col("_g._t").alias("_t"), F.col("_g.channel").alias("channel"), "centre",
                                           _scale(F.col("mad"), F.col("sd")).alias("scale"))
    aggs = []
    for ch, col in SIG.items():
        sel = F.col("channel") == col
        aggs += [F.max(F.when(sel, F.col("centre"))).alias(f"centre_{ch}"),
                 F.max(F.when(sel, F.col("scale"))).alias(f"scale_{ch}")]
    return st.groupBy("_t").agg(*aggs).select("_t.*", *[f"{x}_{ch}" for ch in SIG for x in ("centre", "scale")])


def _with_z(j: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the clipped robust z of every channel, from rows that carry their test's centres and scales."""
    zs = []
    for ch, col in SIG.items():
        scale = F.coalesce(F.col(f"scale_{ch}"), F.lit(1.0))
        zs.append(E.clip((F.col(col) - F.col(f"centre_{ch}")) / scale, -K.Z_CLIP, K.Z_CLIP).alias(f"z_{ch}"))
    return j.select(*columns, *zs)


def robust_z(masked: DataFrame, by) -> DataFrame:
    by = _by(by)
    return _with_z(masked.join(robust_stats(masked, by), by, "left"), masked.columns)


def nearest_reference(df: DataFrame, by, within_group: bool = False) -> DataFrame:
    """JOIN3 + JOIN5: for every stimulus the nearest allowed 'C' stimulus by
    question_index (left = last with a smaller index, right = first with index
    >= q; right only when strictly nearer), its code and z values -> deltas.

    Runs on the table of distinct (test[, group], question_index) positions,
    never on stimuli: per position the last and the first comparison stimulus
    (struct max/min, partially aggregated), then the two-level search of
    :func:`ordered.neighbours`. Stimuli without an index have no reference.
    """
    key = _by(by) + (["group_idx"] if within_group else [])
    is_ref = F.col("allowed") & (F.col("q_type") == "C")
    payload = F.struct(F.col("question_index").alias("idx"), F.col("group_idx").alias("g"),
                       F.col("stimulus_idx").alias("s"), F.col("question_code").alias("code"),
                       *[F.col(f"z_{ch}").alias(ch) for ch in K.CHANNELS])
    # order among stimuli of one index: (group_idx, stimulus_idx)
    ref = F.when(is_ref, F.struct(F.col("group_idx"), F.col("stimulus_idx"), payload.alias("p")))
    per_idx = (df.where(F.col("question_index").isNotNull()).groupBy(*key, "question_index")
               .agg(F.max(ref).alias("_last"), F.min(ref).alias("_first"))
               .select(*key, "question_index", F.col("_last.p").alias("_last"), F.col("_first.p").alias("_first")))
    qi, lj, rj = F.col("question_index"), F.col("left"), F.col("right")
    use_right = lj.isNull() | (rj.isNotNull() & (F.abs(rj["idx"] - qi) < F.abs(lj["idx"] - qi)))
    picked = (neighbours(per_idx, key, "question_index", "_last", "_first")
              .select(*key, "question_index", F.when(use_right, rj).otherwise(lj).alias("ref")))
    j = df.join(picked, key + ["question_index"], "left")
    deltas = [F.coalesce(F.col(f"z_{ch}") - F.col(f"ref.{ch}"), F.lit(0.0)).alias(f"delta_{ch}_vs_c")
              for ch in K.CHANNELS]
    return j.select(*df.columns, F.col("ref.code").alias("ref_c_question_code"),
                    F.col("ref.g").alias("ref_group_idx"), F.col("ref.s").alias("ref_stimulus_idx"), *deltas)


def evidence(df: DataFrame) -> DataFrame:
    """EXP12 + EXP13: evidence by question type, probability, label."""
    pair = E.weighted(K.CHANNEL_WEIGHTS, "delta_{}_vs_c")
    base = E.weighted(K.CHANNEL_WEIGHTS, "z_{}")
    t = F.col("q_type")
    ev = (F.when(t == "R", F.col("pair_evidence") + K.R_EMPIRICAL_FACTOR * F.col("empirical_scaled"))
          .when(t == "C", -F.col("pair_evidence"))
          .otherwise(K.OTHER_BASELINE_FACTOR * F.col("baseline_evidence")))
    out = (df.withColumn("pair_evidence", pair).withColumn("baseline_evidence", base)
           .withColumn("empirical_scaled", E.empirical_scaled())
           .withColumn("evidence_score", ev).withColumn("raw_score", F.col("evidence_score")))
    p = E.direct_probability(F.col("evidence_score"), t)
    return (out.withColumn("deception_probability", p)
            .withColumn("pred_label", (F.col("deception_probability") >= K.DIRECT_LABEL_THRESHOLD).cast("int")))


def score_direct(stim: DataFrame, by="test_id", within_group: bool = False) -> DataFrame:
    """JOB4 row level: every stimulus with signals, z, deltas, probability."""
    by = _by(by)
    sig = signals(stim)
    tiers = materialize(test_tiers(sig, by))
    # one row per test is all that is written; the stimuli are read again, with the columns that the step needs
    per_test = materialize(tiers.join(robust_stats(with_masks(sig, tiers, by), by), by, "left"))
    masked = with_masks(sig, per_test, by)
    z = _with_z(masked, [c for c in masked.columns if not c.startswith(("centre_", "scale_"))])
    return evidence(nearest_reference(z, by, within_group))


def direct_summary(scored: DataFrame, by="test_id") -> DataFrame:
    """AGG8 + EXP14: one row per test."""
    by = _by(by)
    tgt = F.col("in_target")
    aggs = [F.avg(F.when(tgt, F.col("deception_probability"))).alias("overall_score"),
            F.count(F.lit(1)).alias("n_items"),
            F.count_if(F.col("allowed") & (F.col("q_type") == "R")).alias("n_relevant_questions"),
            F.count_if(F.col("allowed") & (F.col("q_type") == "C")).alias("n_comparison_questions")]
    aggs += [F.avg(F.when(tgt, F.abs(F.col(f"delta_{ch}_vs_c")))).alias(f"mean_abs_delta_{ch}") for ch in K.CHANNEL_WEIGHTS]
    s = scored.groupBy(*by).agg(*aggs)
    return s.withColumn("recommendation", E.recommend("overall_score", *K.DIRECT_BANDS)).withColumn(
        "method", F.lit(K.DIRECT_METHOD))
