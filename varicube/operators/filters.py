"""Denoising filters: count rows in, the same rows with filter_delete out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varicube.functions.sequences import has_stop, stop_count
from varicube.operators.counts import KEYS, N_I, N_IK, N_JK, OCCURRENCE, RUN_MARKER, total_over

# The numbers and names of the low-frequency-noise filters.
FILTER_NAMES = {
    2: "lfn_variant", 3: "lfn_variant_replicate", 4: "lfn_variant_specific", 5: "lfn_variant_replicate_specific",
    6: "lfn_sample_replicate", 7: "lfn_read_count", 8: "lfn_all",
}


@dataclass(frozen=True)
class LfnCutoffs:
    """variant excludes variant_replicate; which of the two is set decides the mode."""

    variant: float | None = 0.001
    variant_replicate: float | None = None
    sample_replicate: float = 0.001
    read_count: int = 10

    def __post_init__(self):
        if (self.variant is None) == (self.variant_replicate is None):
            raise ValueError("set either the variant or the variant-replicate cutoff")


def low_ratio(keys: list[str], cutoff: float | Column) -> Column:
    """The row's share of its total is the cutoff or less, or it has no reads."""
    return (F.col("read_count") == 0) | (F.try_divide(F.col("read_count").cast("double"), total_over(keys).cast("double")) <= cutoff)


def lfn_variant(counts: DataFrame, cutoff: float = 0.001) -> DataFrame:
    return counts.withColumn("filter_delete", F.coalesce(low_ratio(N_I, cutoff), F.lit(False)))


def lfn_variant_replicate(counts: DataFrame, cutoff: float = 0.001) -> DataFrame:
    return counts.withColumn("filter_delete", F.coalesce(low_ratio(N_IK, cutoff), F.lit(False)))


def lfn_sample_replicate(counts: DataFrame, cutoff: float = 0.001) -> DataFrame:
    return counts.withColumn("filter_delete", F.coalesce(low_ratio(N_JK, cutoff), F.lit(False)))


def lfn_read_count(counts: DataFrame, cutoff: int = 10) -> DataFrame:
    return counts.withColumn("filter_delete", F.col("read_count") < cutoff)


def lfn_specific(counts: DataFrame, cutoffs: DataFrame, by_replicate: bool = False) -> DataFrame:
    """A verdict for the rows of the variants (or variants and replicates) that have a cutoff of their own."""
    keys = N_IK if by_replicate else N_I
    told = counts.withColumn("total", total_over(keys)).join(cutoffs.select(*keys, "cutoff"), keys)
    low = (F.col("read_count") == 0) | (F.try_divide(F.col("read_count").cast("double"), F.col("total").cast("double")) <= F.col("cutoff"))
    return told.withColumn("filter_delete", low).select(*KEYS, "read_count", "filter_delete")


def lfn_verdicts(counts: DataFrame, cutoffs: LfnCutoffs, specific: DataFrame | None = None) -> DataFrame:
    """One row per count row with a column per verdict (f2 or f3, f4 or f5 null without an own cutoff, f6, f7) and their OR, f8.

    All totals are windows over one scan; a specific cutoff can only add a deletion.
    """
    by_replicate = cutoffs.variant is None
    keys, general = (N_IK, 3) if by_replicate else (N_I, 2)
    out = counts.withColumn(f"f{general}", low_ratio(keys, cutoffs.variant_replicate if by_replicate else cutoffs.variant))
    if specific is not None:
        ratio = F.try_divide(F.col("read_count").cast("double"), F.col("own_total").cast("double"))
        out = out.withColumn("own_total", total_over(keys)).join(specific.select(*keys, "cutoff"), keys, "left")
        out = out.withColumn(f"f{general + 2}", F.when(F.col("cutoff").isNotNull(), (F.col("read_count") == 0) | (ratio <= F.col("cutoff")))).drop("own_total", "cutoff")
    else:
        out = out.withColumn(f"f{general + 2}", F.lit(None).cast("boolean"))
    out = out.withColumn("f6", low_ratio(N_JK, cutoffs.sample_replicate)).withColumn("f7", F.col("read_count") < cutoffs.read_count)
    any_of = [F.coalesce(F.col(f"f{k}"), F.lit(False)) for k in (general, general + 2, 6, 7)]
    return out.withColumn("f8", any_of[0] | any_of[1] | any_of[2] | any_of[3]).select(*KEYS, "read_count", f"f{general}", f"f{general + 2}", "f6", "f7", "f8")


def lfn_long(counts: DataFrame, cutoffs: LfnCutoffs, specific: DataFrame | None = None) -> DataFrame:
    """A row per count row and verdict, with filter_id; rows without an own cutoff have no verdict of that kind."""
    wide = lfn_verdicts(counts, cutoffs, specific)
    ids = [int(c[1:]) for c in wide.columns if c[0] == "f" and c[1:].isdigit()]
    entries = F.array(*[F.struct(F.lit(i).cast("int").alias("filter_id"), F.col(f"f{i}").alias("filter_delete")) for i in ids])
    return wide.select(*KEYS, "read_count", F.inline(entries)).where("filter_delete is not null")


def lfn_all(counts: DataFrame, cutoffs: LfnCutoffs, specific: DataFrame | None = None) -> DataFrame:
    return lfn_verdicts(counts, cutoffs, specific).select(*KEYS, "read_count", F.col("f8").alias("filter_delete"))


def lfn_named(long: DataFrame) -> DataFrame:
    names = long.sparkSession.createDataFrame(list(FILTER_NAMES.items()), "filter_id int, filter_name string")
    return long.join(F.broadcast(names), "filter_id")  # seven rows


def min_replicate(counts: DataFrame, least: int = 2) -> DataFrame:
    """Delete occurrences that stand in fewer than `least` replicates of their sample."""
    n = F.count("replicate").over(Window.partitionBy(*OCCURRENCE))
    return counts.withColumn("filter_delete", n < least)


def renkonen_distances(counts: DataFrame) -> DataFrame:
    """For each pair of replicates of a sample, one less the sum over variants of the smaller of their proportions.

    Proportions are of a sample-replicate's reads. Replicates are few, so a variant meets itself in few pairs.
    """
    p = counts.withColumn("p", F.col("read_count").cast("double") / total_over(N_JK)).select(*KEYS, "p")
    left = p.select(*RUN_MARKER, "sample_id", "variant_id", F.col("replicate").alias("replicate_left"), F.col("p").alias("pl"))
    right = p.select(*RUN_MARKER, "sample_id", "variant_id", F.col("replicate").alias("replicate_right"), F.col("p").alias("pr"))
    shared = left.join(right, [*RUN_MARKER, "sample_id", "variant_id"]).where("replicate_left < replicate_right")
    common = shared.groupBy(*RUN_MARKER, "sample_id", "replicate_left", "replicate_right").agg(F.sum(F.least("pl", "pr")).alias("common"))
    reps = counts.select(*N_JK).distinct()
    pairs = reps.withColumnRenamed("replicate", "replicate_left").join(reps.withColumnRenamed("replicate", "replicate_right"), [*RUN_MARKER, "sample_id"]).where("replicate_left < replicate_right")
    joined = pairs.join(common, [*RUN_MARKER, "sample_id", "replicate_left", "replicate_right"], "left")
    return joined.withColumn("renkonen_distance", F.round(1 - F.coalesce("common", F.lit(0.0)), 9)).drop("common")


def lower_quantile(df: DataFrame, by: list[str], column: str, q: float, name: str) -> DataFrame:
    """The value of rank floor(q * (n - 1)), counted from zero, within each group."""
    w = Window.partitionBy(*by)
    ranked = df.withColumn("rank_", F.row_number().over(w.orderBy(column))).withColumn("n_", F.count(F.lit(1)).over(w))
    return ranked.where(F.col("rank_") == F.floor(F.lit(q) * (F.col("n_") - 1)) + 1).select(*by, F.col(column).alias(name))


def renkonen_cutoffs(distances: DataFrame, quantile: float = 0.9) -> DataFrame:
    return lower_quantile(distances, RUN_MARKER, "renkonen_distance", quantile, "cutoff")


def renkonen(counts: DataFrame, quantile: float = 0.9) -> DataFrame:
    """Delete a replicate that is farther than the cutoff from more than half of its sample's other replicates.

    A run and marker with a single replicate passes as it is.
    """
    distances = renkonen_distances(counts)
    far = distances.join(renkonen_cutoffs(distances, quantile), RUN_MARKER).withColumn("far", (F.col("renkonen_distance") > F.col("cutoff")).cast("int"))
    each = far.withColumn("replicate", F.explode(F.array("replicate_left", "replicate_right")))
    sizes = counts.select(*N_JK).distinct().groupBy(*RUN_MARKER, "sample_id").agg(F.count(F.lit(1)).alias("n_replicates"))
    gone = each.groupBy(*N_JK).agg(F.sum("far").alias("n_far")).join(sizes, [*RUN_MARKER, "sample_id"])
    gone = gone.where(F.col("n_far") > (F.col("n_replicates") - 1) / 2).select(*N_JK, F.lit(True).alias("gone"))
    return counts.join(gone, N_JK, "left").withColumn("filter_delete", F.coalesce("gone", F.lit(False))).drop("gone")


def indel(counts: DataFrame, variants: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Delete variants whose length modulo three is not the commonest among the distinct variants; ties go to the smallest.

    The commonest is taken over all variants, or within each group of `by`.
    """
    by = by or []
    own = counts.select(*dict.fromkeys([*by, "variant_id"])).distinct().join(variants, "variant_id").withColumn("phase", F.length("sequence") % 3)
    common = own.groupBy(*by).agg(F.mode("phase", deterministic=True).alias("common"))
    judged = (own.join(common, by) if by else own.crossJoin(F.broadcast(common))).select(*by, "variant_id", (F.col("phase") != F.col("common")).alias("filter_delete"))  # one row
    return counts.join(judged, [*by, "variant_id"])


def stop_codon_counts(variants: DataFrame, code: int = 5) -> DataFrame:
    s = F.col("sequence")
    return variants.select("variant_id", *[stop_count(s, f, code).cast("long").alias(f"frame{f}") for f in (1, 2, 3)])


def codon_stop(counts: DataFrame, variants: DataFrame, code: int = 5) -> DataFrame:
    """Delete variants with a stop codon in all three reading frames."""
    s = F.col("sequence")
    flags = variants.select("variant_id", (has_stop(s, 1, code) & has_stop(s, 2, code) & has_stop(s, 3, code)).alias("filter_delete"))
    return counts.join(flags, "variant_id")
