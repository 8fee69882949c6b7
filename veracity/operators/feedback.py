"""Expert feedback: review text -> label (EXP15), latest label per question
(WIN5/SET2), upsert of the feedback log (SNK4) and overlay onto the training
table (JOIN6).

Latest-wins is a ``max_by`` aggregate keyed by (test, question): partial
aggregation keeps a hot key cheap and no window holds a whole key group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E

KEYS = ["test_id", "question_code"]


def with_review_labels(fb: DataFrame, review: str = "expert_review") -> DataFrame:
    return fb.withColumn("expert_label", E.review_label(review))


def latest_feedback(fb: DataFrame, keys: list[str] | None = None, ts: str = "created_at") -> DataFrame:
    """Latest labelled row per key by ``ts`` (labels outside 0/1 clipped,
    unlabeled rows dropped). Rows of one instant are ordered by their other
    columns, so the choice never depends on the order of arrival."""
    keys = keys or KEYS
    raw = E.to_double("expert_label").cast("int")
    lab = F.when(raw.isNotNull(), F.least(F.lit(1), F.greatest(F.lit(0), raw)))  # bare least/greatest skip NULLs
    d = (fb.withColumn("expert_label", lab).where(F.col("expert_label").isNotNull())
         .withColumn("test_id", F.col("test_id").cast("string"))
         .withColumn("question_code", F.col("question_code").cast("string")))
    rest = [c for c in d.columns if c not in keys]
    g = d.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts])).alias("_r"))
    return g.select(*keys, *[F.col("_r." + c).alias(c) for c in rest])


def upsert_feedback(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """SNK4: old log + new reviews -> one latest row per key."""
    if "expert_label" in new.columns and "expert_review" in new.columns:
        new = new.withColumn("expert_label", F.coalesce(E.to_double("expert_label").cast("int"), E.review_label("expert_review")))
    elif "expert_label" not in new.columns:
        new = with_review_labels(new)
    allr = new if old is None else old.unionByName(new, allowMissingColumns=True)
    return latest_feedback(allr)


def overlay(features: DataFrame, latest: DataFrame, base_label: str = "label_bootstrap",
            base_source: str = "label_source") -> DataFrame:
    """JOIN6: expert label overrides the surrogate one where present."""
    fb = latest.select(F.col("test_id").alias("_t"), F.col("question_code").alias("_q"),
                       F.col("expert_label").alias("label_expert"))
    j = features.join(fb, (F.col("test_id").cast("string") == F.col("_t"))
                      & (F.col("question_code").cast("string") == F.col("_q")), "left").drop("_t", "_q")
    base = F.col("label_train") if "label_train" in features.columns else F.col(base_label)
    src = F.col("label_source_train") if "label_source_train" in features.columns else F.col(base_source)
    return (j.withColumn("label_train", F.coalesce(F.col("label_expert"), base).cast("int"))
            .withColumn("label_hybrid", F.col("label_train"))
            .withColumn("label_source_train", F.when(F.col("label_expert").isNotNull(), F.lit("expert")).otherwise(src)))
