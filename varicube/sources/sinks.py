"""Writers: stage tables, the variant dictionary, TSV and FASTA, demultiplexed reads, the cache of assigned taxa."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varicube.operators.counts import SAMPLE_REPLICATE


def write_stage(state: DataFrame, sheet: DataFrame, stage: str, path: str) -> None:
    """Replace the stage's rows of the sheet's sample-replicates; rows of others stay.

    A Parquet table by stage, run and marker. Only partitions of the sheet's runs and markers are rewritten: their other rows are
    read, set aside in the shared folder and written back with the new ones.
    """
    from varicube.functions.storage import stored

    spark = state.sparkSession
    keys = sheet.select(*SAMPLE_REPLICATE).distinct()
    new = state.join(keys, SAMPLE_REPLICATE, "left_semi").withColumn("stage", F.lit(stage))
    if table_exists(spark, path):
        old = spark.read.parquet(path).where(F.col("stage") == stage).join(keys.select("run_id", "marker_id").distinct(), ["run_id", "marker_id"], "left_semi")
        new = new.unionByName(old.join(keys, SAMPLE_REPLICATE, "left_anti").select(*new.columns))
    rows = stored(new, "stage")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage", "run_id", "marker_id").parquet(path)


def table_exists(spark, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def extend_dictionary(known: DataFrame, sequences: DataFrame) -> DataFrame:
    """Known variants, and unseen sequences with the next numbers in order of sequence."""
    fresh = sequences.select(F.upper("sequence").alias("sequence")).distinct().join(known.select("sequence"), "sequence", "left_anti")
    largest = known.agg(F.coalesce(F.max("variant_id"), F.lit(0)).alias("largest"))
    return known.select("variant_id", "sequence").unionByName(numbered(fresh, largest))


def numbered(sequences: DataFrame, largest: DataFrame) -> DataFrame:
    """variant_id, sequence: the numbers after the one of `largest` (a row) in order of sequence.

    Numbers are dense without a single sorting task: ranges of sequences are sorted apart and offset by the sizes of those before.
    """
    from varicube.functions.storage import stored

    # stored, so that the parts are the same for the sizes and for the numbers
    parts = stored(sequences.repartitionByRange("sequence").withColumn("part", F.spark_partition_id()), "sequences")
    before = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each part
    before = before.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("part").orderBy("sequence"))
    told = parts.withColumn("place", place).join(before, "part").crossJoin(F.broadcast(largest))  # one row
    return told.select((F.col("largest") + F.col("offset") + F.col("place")).cast("long").alias("variant_id"), "sequence")


def digest(sequence: str = "sequence"):
    """128 bits of a sequence, by which the stored dictionary is dealt into buckets."""
    return F.md5(F.col(sequence))


def store_dictionary(known: DataFrame, table: str, buckets: int = 64) -> None:
    """Begin a stored dictionary: a table in buckets of the sequences' digests, sorted by them. It must not exist yet."""
    rows = known.select("variant_id", "sequence", digest().alias("digest"))
    rows.write.mode("error").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(table)


def unseen_sequences(sequences: DataFrame, table: str) -> DataFrame:
    """Distinct upper-case sequences that the stored dictionary lacks.

    Only the new sequences are shuffled, to the dictionary's buckets; what earlier runs have stored stays where it is.
    """
    fresh = sequences.select(F.upper("sequence").alias("sequence")).where("sequence is not null").distinct().withColumn("digest", digest())
    return fresh.join(sequences.sparkSession.table(table).select("digest"), "digest", "left_anti").select("sequence")


def extend_stored_dictionary(table: str, sequences: DataFrame) -> DataFrame:
    """Add the unseen sequences to the stored dictionary, with the next numbers in their order, and return it: variant_id, sequence."""
    from varicube.functions.storage import stored

    spark = sequences.sparkSession
    known = spark.table(table)
    largest = known.agg(F.coalesce(F.max("variant_id"), F.lit(0)).alias("largest"))
    new = stored(numbered(unseen_sequences(sequences, table), largest), "numbered")
    buckets = spark.sql(f"describe extended {table}").where("col_name = 'Num Buckets'").first()["data_type"]
    new.withColumn("digest", digest()).write.mode("append").bucketBy(int(buckets), "digest").sortBy("digest").saveAsTable(table)
    return spark.table(table).select("variant_id", "sequence")


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None, decimals: dict[str, int] | None = None, compression: str | None = None) -> None:
    """Tab-separated text with a header, in order if one is given, floats with a fixed number of decimals where named."""
    for name, n in (decimals or {}).items():
        df = df.withColumn(name, F.format_string(f"%.{n}f", F.col(name)))
    out = df.orderBy(*order) if order else df
    writer = out.write.mode("overwrite").option("sep", "\t").option("header", True)
    (writer.option("compression", compression) if compression else writer).csv(path)


def write_fasta(variants: DataFrame, path: str, id_col: str = "variant_id", size_col: str | None = None, compression: str | None = None) -> None:
    """Records of two lines; ;size= follows the id where a size is given."""
    head = F.concat(F.lit(">"), F.col(id_col).cast("string"))
    if size_col:
        head = F.concat(head, F.lit(";size="), F.col(size_col).cast("string"))
    writer = variants.select(F.concat_ws("\n", head, "sequence").alias("value")).write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).text(path)


def write_demultiplexed(reads: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Reads in a folder for each run, marker, sample and replicate; returns the sheet of these folders."""
    record = F.format_string(">%s\n%s", F.col("read_id").cast("string"), F.col("sequence")).alias("value")
    keyed = reads.select(*SAMPLE_REPLICATE, record)
    writer = keyed.write.mode("overwrite").partitionBy(*SAMPLE_REPLICATE)
    (writer.option("compression", compression) if compression else writer).text(path)
    folder = F.concat_ws("/", F.lit(path), *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in SAMPLE_REPLICATE])
    return reads.select(*SAMPLE_REPLICATE).distinct().withColumn("folder", folder)


def store_assignments(found: DataFrame, store: DataFrame) -> DataFrame:
    """The cache after an assignment: rows by variant, new ones in place of old ones."""
    return store.join(found.select("variant_id"), "variant_id", "left_anti").unionByName(found.select(*store.columns))
