"""Readers of tab-separated sheets: explicit columns, lower-cased headers, checks on the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns that each kind of sheet must have.
REQUIRED = {
    "fastq": ("marker", "sample", "replicate", "run", "fastqfwd", "fastqrev"),
    "merged": ("tagfwd", "primerfwd", "tagrev", "primerrev", "marker", "sample", "replicate", "run", "mergedfasta"),
    "sorted": ("marker", "sample", "replicate", "run", "sortedfasta"),
    "known": ("marker", "run", "sample", "mock", "action", "sequence"),
    "run_marker": ("run", "marker"),
    "sample_types": ("run", "sample", "sample_type", "habitat"),
    "mock": ("marker", "run", "sample", "sequence"),
}
TYPES = {"real", "negative", "mock"}
ACTIONS = {"keep", "delete", "tolerate"}


def read_sheet(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A sheet with lower-cased column names, all text; missing columns are an error. NA and empty cells are null."""
    df = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    missing = [c for c in REQUIRED[kind] if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return df


def read_samples(spark: SparkSession, path: str, kind: str = "sorted") -> DataFrame:
    """A sample sheet; each run, marker, sample and replicate may stand in it once."""
    df = read_sheet(spark, path, kind)
    twice = df.groupBy("run", "marker", "sample", "replicate").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError("repeated sample-replicates: " + "; ".join("-".join(map(str, r[:4])) for r in twice))
    return df


def read_known(spark: SparkSession, path: str, variants: DataFrame) -> DataFrame:
    """Known occurrences; the variant is found by its sequence, whatever number the sheet gives. Rows without an action are to keep."""
    df = read_sheet(spark, path, "known").drop("variant", "variant_id")
    df = df.withColumn("sequence", F.upper("sequence")).withColumn("mock", F.col("mock").cast("int")).withColumn("action", F.coalesce(F.lower("action"), F.lit("keep")))
    return df.join(variants, "sequence", "left")


def read_specific_cutoffs(spark: SparkSession, path: str, variants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cutoffs, mismatches). Cutoffs of single variants, or variants and replicates, in the column cutoff; the sequence decides the
    variant. Rows whose own number differs from that of the sequence are returned as well, for a warning."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    own = next((c for c in ("lfn_variant_cutoff", "lfn_variant_replicate_cutoff", "cutoff") if c in df.columns), None)
    if own is None or "sequence" not in df.columns:
        raise ValueError(f"{path} lacks a column of cutoffs or of sequences")
    df = df.withColumnRenamed(own, "cutoff").withColumn("cutoff", F.col("cutoff").cast("double")).withColumn("sequence", F.upper("sequence"))
    number = "variant" if "variant" in df.columns else None
    joined = df.join(variants, "sequence")
    wrong = joined.where(F.col(number).cast("long") != F.col("variant_id")) if number else joined.limit(0)
    keys = [c for c in ("run", "marker", "variant_id", "replicate") if c in joined.columns]
    return joined.select(*keys, "cutoff"), wrong


def restrict_to_run_markers(df: DataFrame, run_markers: DataFrame) -> DataFrame:
    return df.join(run_markers.select("run", "marker").distinct(), ["run", "marker"], "left_semi")


def read_sample_types(spark: SparkSession, path: str) -> DataFrame:
    df = read_sheet(spark, path, "sample_types").withColumn("sample_type", F.lower("sample_type"))
    odd = df.where(~F.col("sample_type").isin(*TYPES) | F.col("sample_type").isNull()).limit(1).collect()
    if odd:
        raise ValueError(f"unknown sample type {odd[0]['sample_type']}")
    return df


def read_mock(spark: SparkSession, path: str) -> DataFrame:
    """A mock composition; the action is keep where there is none."""
    df = read_sheet(spark, path, "mock")
    action = F.coalesce(F.lower("action"), F.lit("keep")) if "action" in df.columns else F.lit("keep")
    df = df.withColumn("action", action).withColumn("sequence", F.upper("sequence"))
    odd = df.where(~F.col("action").isin(*ACTIONS)).limit(1).collect()
    if odd:
        raise ValueError(f"unknown action {odd[0]['action']}")
    return df


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    schema = "tax_id long, parent_tax_id long, rank string, name_txt string, old_tax_id double"
    df = spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)
    return df.withColumn("old_tax_id", F.col("old_tax_id").cast("long")).distinct()


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Similarity hits in six columns without a header; see taxonomy.clean_hits for the taxa."""
    schema = "variant_id string, target_id string, identity double, evalue double, coverage double, target_tax_ids string"
    return spark.read.option("sep", "\t").option("nullValue", "N/A").schema(schema).csv(path)
