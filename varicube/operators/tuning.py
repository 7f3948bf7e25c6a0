"""Tuning of thresholds from control samples, and known occurrences made from a variant table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varicube.functions.storage import stored
from varicube.operators.counts import N_I, N_IK, N_JK, OCCURRENCE, RUN_MARKER, total_over
from varicube.operators.pairs import pcr_error_ratios

SAMPLE = [*RUN_MARKER, "sample_id"]


def known_split(known: DataFrame, action: str) -> DataFrame:
    return known.where(F.col("action") == action).select(*OCCURRENCE).distinct()


def sample_replicate_report(counts: DataFrame, known: DataFrame) -> DataFrame:
    """For expected occurrences of mock samples: reads, reads of the sample-replicate, and their ratio cut to four decimals."""
    mock = known.where("mock = 1 and action = 'keep'").select(*OCCURRENCE).distinct()
    told = counts.withColumn("n_jk", total_over(N_JK)).join(mock, OCCURRENCE, "left_semi")
    ratio = F.col("read_count").cast("double") / F.col("n_jk")
    return told.select(*N_JK, "variant_id", F.col("read_count").alias("n_ijk"), "n_jk", ratio.alias("ratio"), (F.floor(ratio * 10000) / 10000).alias("round_down"))


def pcr_error_report(counts: DataFrame, variants: DataFrame, known: DataFrame) -> DataFrame:
    """In mock samples, ratios of unexpected to expected variants one edit away."""
    mocks = known.where("mock = 1").select(*SAMPLE).distinct()
    keep = known_split(known.where("mock = 1"), "keep")
    ratios = pcr_error_ratios(counts.join(mocks, SAMPLE, "left_semi"), variants)
    expected = ratios.join(keep.withColumnRenamed("variant_id", "variant_expected"), [*SAMPLE, "variant_expected"], "left_semi")
    return expected.join(keep.withColumnRenamed("variant_id", "variant_unexpected"), [*SAMPLE, "variant_unexpected"], "left_anti")


def with_ratios(counts: DataFrame) -> DataFrame:
    share = lambda keys: F.col("read_count").cast("double") / total_over(keys)
    return counts.withColumns({"ratio_i": share(N_I), "ratio_ik": share(N_IK), "ratio_jk": share(N_JK)})


def survivors_of(counts: DataFrame, variant: float, read_count: int, sample_replicate: float, replicates: int, by_replicate: bool = False) -> DataFrame:
    """Distinct occurrences left by the ratio filters, the read count and the least number of replicates."""
    ratio = "ratio_ik" if by_replicate else "ratio_i"
    left = with_ratios(counts).where((F.col(ratio) > variant) & (F.col("read_count") >= read_count) & (F.col("ratio_jk") > sample_replicate))
    return left.groupBy(*OCCURRENCE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= replicates).drop("n")


def survivor_counts(left: DataFrame, known: DataFrame) -> DataFrame:
    """Surviving occurrences that are to be kept and to be deleted, by run and marker."""
    acts = known.select(*OCCURRENCE, "action").distinct()
    n = lambda a, name: F.sum((F.col("action") == a).cast("long")).alias(name)
    return left.join(acts, OCCURRENCE).groupBy(*RUN_MARKER).agg(n("keep", "n_keep"), n("delete", "n_delete"))


def cutoff_grid(spark, read_count_start: int = 10, ratio_start: float = 0.001) -> DataFrame:
    """Read counts up to 100 in tens, and ten ratios up to 0.051, rounded to three decimals: at most 100 settings."""
    ratios = [round(ratio_start + i * (0.051 - ratio_start) / 10, 3) for i in range(10)]
    counts = spark.range(read_count_start, 101, 10).select(F.col("id").cast("int").alias("read_count_cutoff"))
    grid = F.explode(F.array(*[F.lit(x) for x in ratios]))
    return counts.select("read_count_cutoff", grid.alias("ratio_cutoff"))


def grid_rows(counts: DataFrame, by_replicate: bool = False) -> DataFrame:
    """Each setting of the grid with n_rows, the count rows that reach both of its cutoffs: what a setting leaves of all data, known or not.

    A row goes to the last setting that it reaches in either direction, and only these at most 121 sums meet the grid.
    """
    grid = cutoff_grid(counts.sparkSession)
    reads, ratios = [sorted({r[i] for r in grid.collect()}) for i in (0, 1)]
    reached = lambda cuts, fits: sum((fits(F.lit(c)).cast("int") for c in cuts), F.lit(0))
    ratio = F.col("ratio_ik" if by_replicate else "ratio_i")
    placed = with_ratios(counts).select(reached(reads, lambda c: F.col("read_count") >= c).alias("i"), reached(ratios, lambda c: ratio > c).alias("j"))
    sums = placed.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
    place = lambda c, cuts: F.array_position(F.array(*[F.lit(x) for x in cuts]), F.col(c))
    marked = grid.withColumns({"gi": place("read_count_cutoff", reads), "gj": place("ratio_cutoff", ratios)})
    met = marked.join(F.broadcast(sums), (F.col("i") >= F.col("gi")) & (F.col("j") >= F.col("gj")), "left")
    return met.groupBy("read_count_cutoff", "ratio_cutoff").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def optimize_grid(counts: DataFrame, known: DataFrame, sample_replicate: float, replicates: int, by_replicate: bool = False) -> DataFrame:
    """Settings that keep at least as many occurrences as the run and marker has distinct expected variants, with the deletes that are left.

    A run and marker of which no setting keeps so many has no row. Ratios are computed once over all counts, then only the known occurrences meet the grid (at most 100 rows, broadcast).
    """
    ratio = "ratio_ik" if by_replicate else "ratio_i"
    own = with_ratios(counts).where(F.col("ratio_jk") > sample_replicate).join(known.select(*OCCURRENCE, "action").distinct(), OCCURRENCE)
    grid = F.broadcast(cutoff_grid(counts.sparkSession))
    met = own.join(grid, (F.col(ratio) > F.col("ratio_cutoff")) & (F.col("read_count") >= F.col("read_count_cutoff")))
    left = met.groupBy(*OCCURRENCE, "action", "read_count_cutoff", "ratio_cutoff").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= replicates)
    n = lambda a, name: F.sum((F.col("action") == a).cast("long")).alias(name)
    told = left.groupBy(*RUN_MARKER, "read_count_cutoff", "ratio_cutoff").agg(n("keep", "n_keep"), n("delete", "n_delete"))
    wanted = known_split(known, "keep").groupBy(*RUN_MARKER).agg(F.countDistinct("variant_id").alias("n_expected"))
    return told.join(wanted, RUN_MARKER).where("n_keep >= n_expected").drop("n_expected")


def grid_report(grid: DataFrame) -> DataFrame:
    """optimize_grid()'s settings in the order of a report: most keeps, fewest deletes, highest cutoffs first within a run and marker."""
    return grid.orderBy(*RUN_MARKER, F.desc("n_keep"), "n_delete", F.desc("read_count_cutoff"), F.desc("ratio_cutoff"))


def specific_cutoffs(counts: DataFrame, known: DataFrame, by_replicate: bool = False) -> DataFrame:
    """For each variant (and replicate) with occurrences to delete: the row of the largest ratio, whose ratio would be the cutoff."""
    keys = N_IK if by_replicate else N_I
    total = "n_ik" if by_replicate else "n_i"
    gone = known_split(known, "delete")
    told = counts.withColumn(total, total_over(keys)).join(gone, OCCURRENCE, "left_semi").withColumn("cutoff", F.col("read_count").cast("double") / F.col(total))
    best = F.max_by(F.struct("read_count", total), F.struct("cutoff", "read_count"))
    return told.groupBy(*keys).agg(F.max("cutoff").alias("cutoff"), best.alias("b")).select(*keys, F.col("b.read_count").alias("read_count_max"), F.col(f"b.{total}").alias(total), "cutoff")


# --- known occurrences from a long variant table: run_id, marker_id, variant_id, sample_id, read_count, sequence


def known_keep(mock: DataFrame, table: DataFrame) -> DataFrame:
    """Mock rows except those to tolerate, with the number of the table's variant of that sequence, or zero. A missing action is keep."""
    ids = table.select(*RUN_MARKER, "sequence", "variant_id").distinct()
    return mock.where(F.coalesce("action", F.lit("keep")) != "tolerate").join(ids, [*RUN_MARKER, "sequence"], "left").select(*SAMPLE, "sequence", F.coalesce("variant_id", F.lit(0)).alias("variant_id"), F.lit("keep").alias("action"))


def missing_occurrences(keep: DataFrame, table: DataFrame) -> DataFrame:
    """Expected variants that are not in the table, or have no reads in the sample."""
    seen = table.where("read_count > 0").select(*SAMPLE, "sequence").distinct()
    return keep.join(seen, [*SAMPLE, "sequence"], "left_anti").select(*SAMPLE, "sequence")


def delete_negative(table: DataFrame, types: DataFrame) -> DataFrame:
    negative = types.where("sample_type = 'negative'").select("sample_id")
    return table.where("read_count > 0").join(negative, "sample_id", "left_semi").select(*SAMPLE, "variant_id", F.lit("delete").alias("action"))


def delete_mock(table: DataFrame, types: DataFrame, mock: DataFrame) -> DataFrame:
    """Variants in a mock sample whose sequence its list does not hold, be it to keep or to tolerate; the marker plays no part."""
    mocks = types.where("sample_type = 'mock'").select("sample_id")
    listed = mock.select("run_id", "sample_id", "sequence").distinct()
    return table.where("read_count > 0").join(mocks, "sample_id", "left_semi").join(listed, ["run_id", "sample_id", "sequence"], "left_anti").select(*SAMPLE, "variant_id", F.lit("delete").alias("action"))


def delete_habitat(table: DataFrame, types: DataFrame, proportion: float = 0.5) -> DataFrame:
    """A variant's real samples of a habitat that has less than `proportion` of the variant's reads."""
    placed = table.join(types.where("habitat is not null"), "sample_id")
    by_habitat = placed.groupBy(*N_I, "habitat").agg(F.sum("read_count").alias("n"))
    share = by_habitat.withColumn("share", F.try_divide(F.col("n").cast("double"), F.sum("n").over(Window.partitionBy(*N_I)).cast("double")))
    minor = share.where(F.col("share") < proportion).select(*N_I, "habitat")
    return placed.where("sample_type = 'real' and read_count > 0").join(minor, [*N_I, "habitat"]).select(*SAMPLE, "variant_id", F.lit("delete").alias("action"))


def known_occurrences(table: DataFrame, types: DataFrame, mock: DataFrame, proportion: float = 0.5) -> DataFrame:
    table = stored(table, "variant-table")  # read by all of the rules
    keep = known_keep(mock, table).select(*SAMPLE, "variant_id", "action")
    gone = delete_negative(table, types).unionByName(delete_mock(table, types, mock)).unionByName(delete_habitat(table, types, proportion))
    return keep.unionByName(gone).distinct()
