"""The count cube: reads of a variant in a sample-replicate, its totals, averages and audits.

A count frame has run_id, marker_id, sample_id, replicate, variant_id and read_count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varicube.functions.sequences import is_nucleotides

RUN_MARKER = ["run_id", "marker_id"]
SAMPLE_REPLICATE = [*RUN_MARKER, "sample_id", "replicate"]
KEYS = [*SAMPLE_REPLICATE, "variant_id"]
OCCURRENCE = [*RUN_MARKER, "variant_id", "sample_id"]
N_I = [*RUN_MARKER, "variant_id"]
N_IJ = OCCURRENCE
N_IK = [*N_I, "replicate"]
N_JK = SAMPLE_REPLICATE


def dereplicate(reads: DataFrame) -> DataFrame:
    """Identical sequences of a sample-replicate become one row with their count."""
    return reads.groupBy(*SAMPLE_REPLICATE, "sequence").agg(F.count(F.lit(1)).alias("read_count"))


def totals(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("read_count").alias(name))


def total_over(keys: list[str]) -> Column:
    """A total as a window, for filters that keep the rows."""
    return F.sum("read_count").over(Window.partitionBy(*keys))


def above_global_cutoff(counts: DataFrame, cutoff: int = 2) -> DataFrame:
    """Rows of variants with at least `cutoff` reads in their run and marker."""
    return counts.withColumn("n_i", total_over(N_I)).where(F.col("n_i") >= cutoff).drop("n_i")


def replicate_average(counts: DataFrame) -> DataFrame:
    """Reads, replicates and their quotient of each occurrence."""
    sums = counts.groupBy(*OCCURRENCE).agg(F.sum("read_count").alias("read_count"), F.count(F.lit(1)).alias("replicate_count"))
    return sums.withColumn("read_count_average", F.col("read_count").cast("double") / F.col("replicate_count"))


def variant_validity(variants: DataFrame) -> DataFrame:
    return variants.select("variant_id", is_nucleotides(F.col("sequence")).alias("is_valid"))


def audit_distinct(state: DataFrame, what: list[str], name: str) -> DataFrame:
    """Distinct values of `what` among the rows that a stage has not deleted, by run and marker."""
    alive = state.where(~F.col("filter_delete"))
    return alive.select(*dict.fromkeys(RUN_MARKER + what)).distinct().groupBy(*RUN_MARKER).agg(F.count(F.lit(1)).alias(name))


def audit_reads(state: DataFrame) -> DataFrame:
    return state.where(~F.col("filter_delete")).groupBy(*RUN_MARKER).agg(F.sum("read_count").alias("n_reads"))


def audit_variants(state: DataFrame, variants: DataFrame) -> DataFrame:
    """The variants left by a stage, with their sequences."""
    return state.where(~F.col("filter_delete")).select(*RUN_MARKER, "variant_id").distinct().join(variants, "variant_id")


def stage_summary(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and deleted rows of each stage, and whether all were deleted."""
    parts = [df.select(F.lit(name).alias("stage"), F.col("filter_delete").cast("long").alias("gone")) for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("gone").alias("n_deleted")).withColumn("all_deleted", F.col("n_rows") == F.col("n_deleted"))


def survivors(state: DataFrame, sheet: DataFrame | None = None, filter_id: int | None = None) -> DataFrame:
    """Distinct count rows that a stage has kept, restricted to the sheet's sample-replicates and, for the LFN stage, to one filter."""
    kept = state.where(~F.col("filter_delete"))
    if filter_id is not None:
        kept = kept.where(F.col("filter_id") == filter_id)
    if sheet is not None:
        kept = kept.join(sheet.select(*SAMPLE_REPLICATE).distinct(), SAMPLE_REPLICATE, "left_semi")
    return kept.select(*KEYS, "read_count").distinct()
