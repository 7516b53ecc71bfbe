"""Area under the ROC curve by rank sums, exact and without a global sort in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

BUCKETS = 256


def auc_exact(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row (positives, negatives, auc), ties counting half.

    Rows shrink to one per distinct score, which is stored as it is read three times. Score ranges of similar size are then summed apart: each
    range needs only the number of negatives below it, which comes from at most ``BUCKETS`` totals. A
    score that is NULL or NaN has no rank and fails the job.
    """
    value = F.col(score).cast("double")
    ranked = F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit("a score is NULL or NaN")).cast("double")).otherwise(value)
    per_score = scored.groupBy(ranked.alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    per_score = settle(per_score, "scores")
    cuts = per_score.approxQuantile("s", [i / BUCKETS for i in range(1, BUCKETS)], 0.001)
    splits = [-float("inf"), *sorted({0.5, *cuts}), float("inf")]
    parted = Bucketizer(splits=splits, inputCol="s", outputCol="part", handleInvalid="error").transform(per_score)
    totals = parted.groupBy("part").agg(F.sum("neg").alias("part_neg"))
    # at most BUCKETS rows meet in this window
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("part_neg").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = parted.withColumn("neg_before", F.coalesce(F.sum("neg").over(within), F.lit(0))).join(
        F.broadcast(offsets), "part"
    )
    wide = lambda name: F.col(name).cast("decimal(18,0)")
    half_wins = wide("pos") * (2 * (wide("offset") + wide("neg_before")) + wide("neg"))
    return below.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(half_wins.cast("decimal(38,0)")).alias("_wins"),
    ).select(
        "positives",
        "negatives",
        (
            F.col("_wins").cast("double")
            / F.nullif(F.col("positives").cast("double") * F.col("negatives") * 2.0, F.lit(0.0))
        ).alias("auc"),
    )
