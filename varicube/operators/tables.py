"""Variant-by-sample tables, expected-variant labels and pooling across markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varicube.operators.counts import N_I, RUN_MARKER


def variant_side(counts: DataFrame, variants: DataFrame, borderline: DataFrame) -> DataFrame:
    """run, marker, variant, reads, sequence, its length and whether it is a borderline chimera in some sample."""
    n = counts.groupBy(*N_I).agg(F.sum("read_count").alias("read_count"))
    joined = n.join(variants, "variant_id").join(borderline, "variant_id", "left")
    return joined.select(*N_I, "read_count", F.length("sequence").cast("long").alias("sequence_length"), F.coalesce("chimera_borderline", F.lit(False)).alias("chimera_borderline"), "sequence")


def sample_pivot(counts: DataFrame, samples: list, prefix: str = "sample") -> DataFrame:
    """A column of reads per listed sample, in the list's order; a sample without reads has zeros. The list comes from the sheet."""
    wide = counts.groupBy(*N_I).pivot("sample_id", samples).agg(F.sum("read_count"))
    return wide.select(*N_I, *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).alias(f"{prefix}{x}") for x in samples])


def keep_labels(known: DataFrame, samples: list, prefix: str = "keep_sample") -> DataFrame:
    """A column per sample that is 1 where the variant is expected in that mock sample."""
    expected = known.where("mock = 1 and action = 'keep'").withColumn("one", F.lit(1))
    wide = expected.groupBy(*N_I).pivot("sample_id", samples).agg(F.max("one"))
    return wide.select(*N_I, *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).alias(f"{prefix}{x}") for x in samples])


def asv_table(counts: DataFrame, variants: DataFrame, borderline: DataFrame, samples: list, clusters: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """The variant side and the sample side in the fixed order of columns; the sequence comes last."""
    joined = variant_side(counts, variants, borderline).join(sample_pivot(counts, samples), N_I)
    cols = [*N_I, "sequence_length", "read_count", *[f"sample{x}" for x in samples]]
    if labels is not None:
        names = [c for c in labels.columns if c not in N_I]
        joined = joined.join(labels, N_I, "left").fillna(0, names)
        cols += names
    if clusters is not None:
        joined = joined.join(clusters, "variant_id", "left")
        cols += ["clusterid", "clustersize"]
    return joined.select(*cols, "chimera_borderline", "sequence")


def unpivot_samples(table: DataFrame, prefix: str = "sample") -> DataFrame:
    """One row per variant and sample column."""
    columns = [c for c in table.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    long = table.unpivot(N_I, columns, "column", "read_count")
    return long.select(*N_I, F.substring("column", len(prefix) + 1, 10).cast("int").alias("sample_id"), "read_count")


def pooled(counts: DataFrame, variants: DataFrame, clusters: DataFrame) -> DataFrame:
    """Per cluster, comma lists of its variants (in order of number), runs, markers and sequences; a list holds each value once."""
    own = counts.select(*N_I).distinct().join(clusters, "variant_id").join(variants, "variant_id")
    listed = lambda c, name: F.concat_ws(",", F.array_sort(F.collect_set(c)).cast("array<string>")).alias(name)
    return own.groupBy("clusterid").agg(listed("variant_id", "pooled_variants"), listed("run_id", "runs"), listed("marker_id", "markers"), listed("sequence", "pooled_sequences"))


def pooled_cells(counts: DataFrame, clusters: DataFrame, columns: list[tuple[int, int]], presence: bool = True) -> DataFrame:
    """A column per existing pair of run and sample: whether the cluster has reads there, or how many."""
    cell = F.concat_ws("-", "run_id", "sample_id")
    names = [f"{r}-{x}" for r, x in columns]
    value = F.max((F.col("read_count") > 0).cast("int")) if presence else F.sum("read_count")
    wide = counts.join(clusters, "variant_id").withColumn("cell", cell).groupBy("clusterid").pivot("cell", names)
    return wide.agg(value).select("clusterid", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias("run" + n.replace("-", "_sample")) for n in names])


def chosen_samples(sheet: DataFrame, run_markers: DataFrame) -> DataFrame:
    """Distinct samples of the chosen pairs of run and marker."""
    return sheet.join(run_markers.select(*RUN_MARKER), RUN_MARKER, "left_semi").select("run_id", "sample_id").distinct()


def looked_up(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Inner join with a name table; a key without a name is an error, raised by the row that has it."""
    joined = df.join(names.withColumn("known_", F.lit(True)), key, "left")
    return joined.where(F.when(F.col("known_"), True).otherwise(F.raise_error(F.concat(F.lit(f"no name for {key} "), F.col(key).cast("string"))).cast("boolean"))).drop("known_")
