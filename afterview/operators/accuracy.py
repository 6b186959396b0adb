"""Credited conversions against the true links, at household grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio_or_zero
from .versions import current, current_exposures


def accuracy(attributed: DataFrame, truth: DataFrame, exposures: DataFrame) -> DataFrame:
    """One row of counts and ratios; ratios of nothing are zero."""
    homes = current_exposures(exposures).select(F.col("exposure_id").alias("truth_exposure_id"), F.col("household_id").alias("truth_household"))
    links = truth.join(homes, "truth_exposure_id", "left").withColumn("linked", F.lit(True))
    rows = current(attributed).where("attributed").select("conversion_id", "household_id", "exposure_id").join(links, "conversion_id", "full")
    credited, linked = F.col("exposure_id").isNotNull(), F.col("linked").isNotNull()
    right = credited & linked & F.coalesce(F.col("truth_household") == F.col("household_id"), F.lit(False))
    counts = rows.agg(
        F.count_if(credited).alias("credited"), F.count_if(linked).alias("truth_links"), F.count_if(right).alias("household_correct"),
        F.count_if(credited & linked & (F.col("exposure_id") == F.col("truth_exposure_id"))).alias("exact_exposure_correct"),
        F.count_if(credited & ~linked).alias("organic_credited"), F.count_if(linked & ~credited).alias("caused_missed"), F.count_if(credited & linked & ~right).alias("caused_wrong_household"),
    )
    p, r = ratio_or_zero(F.col("household_correct"), F.col("credited")), ratio_or_zero(F.col("household_correct"), F.col("truth_links"))
    counts = counts.withColumns({"precision": p, "recall": r, "exact_exposure_match_rate": ratio_or_zero(F.col("exact_exposure_correct"), F.col("credited"))})
    return counts.withColumn("f1", ratio_or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def eval_spread(results: DataFrame) -> DataFrame:
    """Of results (scenario, kind, outcome, verdict), one row a repetition: repetitions,
    right ones, the spread of outcomes and verdicts, by scenario."""
    right = F.col("outcome").isin("correct", "correct_silence")
    return results.groupBy("scenario", "kind").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(right).alias("correct"), F.count_if(F.col("outcome") == "false_positive").alias("false_positives"),
        F.count_distinct("outcome").alias("outcomes"), F.count_distinct("verdict").alias("verdicts"),
    )


def false_positive_rate(results: DataFrame) -> DataFrame:
    """One row over the control scenarios alone; null where there are none."""
    rows = results.where("kind = 'control'").agg(F.count_if(F.col("outcome") == "false_positive").alias("false_positives"), F.count(F.lit(1)).alias("control_runs"))
    return rows.withColumn("rate", F.col("false_positives") / F.nullif("control_runs", F.lit(0)))
