"""Readers of FASTA and FASTQ files, plain, gzip or bzip2."""

from __future__ import annotations

import re
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varicube.functions.storage import stored
from varicube.sources.sinks import table_exists


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist; others are named in a warning and skipped."""
    found = [p for p in paths if table_exists(spark, p)]
    for p in set(paths) - set(found):
        warnings.warn(f"no such file: {p}", stacklevel=2)
    return found


def read_fasta(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, read_id, sequence), upper-cased; wrapped lines are joined. Files that are missing are skipped."""
    found = existing(spark, paths)
    if not found:
        return spark.createDataFrame([], "source_file string, read_id string, sequence string")
    # a record begins at a line with >, so records are the reader's lines
    text = spark.read.option("lineSep", "\n>").text(found).withColumn("source_file", F.col("_metadata.file_path"))
    value = F.regexp_replace("value", r"^>", "")
    head = F.regexp_extract(value, r"^([^\r\n]*)", 1)
    body = F.upper(F.regexp_replace(F.regexp_replace(value, r"^[^\r\n]*", ""), r"\s", ""))
    return text.select("source_file", F.regexp_extract(head, r"^(\S*)", 1).alias("read_id"), body.alias("sequence")).where("read_id <> '' or sequence <> ''")


RECORDS = "start long, place int, kind int, read_id string, sequence string, quality string"


def whole_records(lines: list[str]) -> tuple[list[tuple[int, str, str, str]], int, int]:
    """(records, first, last): the four-line records among consecutive lines, each with its place among them, and the lines that they take.

    The first record begins at the first line with @ whose second next begins with +. A quality line may begin with @ as well, but what stands two lines behind it is a
    sequence. What is before the first and behind the last whole record belongs to records that go on elsewhere.
    """
    first = next((i for i in range(len(lines) - 2) if lines[i].startswith("@") and lines[i + 2].startswith("+")), None)
    if first is None:
        return [], 0, 0
    last = first + (len(lines) - first) // 4 * 4
    return [(i, lines[i][1:].split(None, 1)[0] if lines[i][1:].strip() else "", lines[i + 1].upper(), lines[i + 3]) for i in range(first, last, 4)], first, last


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(source_file, ordinal, read_id, sequence, quality) of files' four-line records; ordinal counts from 0 within each file, in its order.

    Files are read in splits, whose lines come in order. Each split finds its first whole record by itself; the few lines over at its borders are put together by file, and the records' numbers follow
    from the numbers of records by split. Neither lines nor records are shuffled. An incomplete record at the end of a file is left out, as are files that are missing.
    """
    found = existing(spark, [paths] if isinstance(paths, str) else paths)
    if not found:
        return spark.createDataFrame([], "source_file string, ordinal long, read_id string, sequence string, quality string")
    lines = spark.read.text(found).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"), "value")

    def run(batches):
        at, held, done = None, [], 0  # the split, its lines that are not yet part of a record, and how many records it had

        def cut(last: bool):
            """Records of the lines held, and at the split's end the lines over."""
            nonlocal held, done
            records, first, end = whole_records(held)
            if not records and not last:
                return []
            out = [(*at, done + k, 1, *r[1:]) for k, r in enumerate(records)]
            if done == 0:  # what stands before the first record goes on from the split before
                out += [(*at, k - first, 0, x, None, None) for k, x in enumerate(held[:first])]
            done += len(records)
            held = held[end:]
            if last:
                out += [(*at, k, 2, x, None, None) for k, x in enumerate(held)]
            return out

        columns = ["source_file", "start", "place", "kind", "read_id", "sequence", "quality"]
        for pdf in batches:
            files, starts, values = pdf["source_file"], pdf["start"], pdf["value"].tolist()
            new = ((files != files.shift()) | (starts != starts.shift())).to_numpy()
            borders = [*np.flatnonzero(new), len(pdf)]
            for i, j in zip(borders, borders[1:]):
                here = (files.iloc[i], int(starts.iloc[i]))
                if here != at:
                    if at is not None:
                        yield pd.DataFrame(cut(True), columns=columns)
                    at, held, done = here, [], 0
                held += values[i:j]
                yield pd.DataFrame(cut(False), columns=columns)
        if at is not None:
            yield pd.DataFrame(cut(True), columns=columns)

    # stored, so that a file is read once and the splits are the same for the records and for their numbers
    parts = stored(lines.mapInPandas(run, f"source_file string, {RECORDS}"), "fastq")
    whole = parts.where("kind = 1")

    def put_together(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "kind", "place"])
        records, _, _ = whole_records(pdf["read_id"].tolist())
        starts = pdf["start"].to_numpy(np.int64)
        return pd.DataFrame([(pdf["source_file"].iloc[0], starts[i], *r) for i, *r in records], columns=["source_file", "start", "read_id", "sequence", "quality"])

    over = stored(parts.where("kind <> 1").groupBy("source_file").applyInPandas(put_together, "source_file string, start long, read_id string, sequence string, quality string"), "fastq-borders")
    # a record over a border comes last in the split where it begins
    sizes = whole.groupBy("source_file", "start").agg(F.max("place").alias("n")).withColumn("n", F.col("n") + 1)
    later = over.withColumn("nth", F.row_number().over(Window.partitionBy("source_file", "start").orderBy("read_id")) - 1)
    both = sizes.unionByName(over.groupBy("source_file", "start").agg(F.count(F.lit(1)).alias("n"))).groupBy("source_file", "start").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(both.withColumn("offset", before).drop("n").join(sizes.withColumnRenamed("n", "within"), ["source_file", "start"], "left"), "fastq-offsets")
    offsets = F.broadcast(offsets.withColumn("within", F.coalesce("within", F.lit(0))))  # a row for each split of some 128 MB
    numbered = whole.join(offsets, ["source_file", "start"]).withColumn("ordinal", F.col("offset") + F.col("place"))
    added = later.join(offsets, ["source_file", "start"]).withColumn("ordinal", F.col("offset") + F.col("within") + F.col("nth"))
    told = ["source_file", F.col("ordinal").cast("long").alias("ordinal"), "read_id", "sequence", "quality"]
    return numbered.select(*told).unionByName(added.select(*told))


def read_pairs(spark: SparkSession, forward: str | list[str], reverse: str | list[str]) -> DataFrame:
    """Mates of two files by their order: source_file (of the forward reads), read_id, fwd_seq, fwd_qual, rev_seq, rev_qual.

    Of lists, the files at the same place belong together. A read without a mate is left out.
    """
    pairs = [(forward, reverse)] if isinstance(forward, str) else list(zip(forward, reverse, strict=True))
    f, r = (read_fastq(spark, sorted({p[side] for p in pairs})) for side in (0, 1))
    names = spark.createDataFrame([(plain(a), plain(b)) for a, b in pairs], "forward string, reverse string")
    f = f.select("source_file", plain_path("source_file").alias("forward"), "ordinal", "read_id", F.col("sequence").alias("fwd_seq"), F.col("quality").alias("fwd_qual"))
    r = r.select(plain_path("source_file").alias("reverse"), "ordinal", F.col("sequence").alias("rev_seq"), F.col("quality").alias("rev_qual"))
    return f.join(F.broadcast(names), "forward").join(r, ["reverse", "ordinal"]).drop("forward", "reverse", "ordinal")  # a row for each pair of files


def plain(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def plain_path(path) -> Column:
    """A local path without its scheme, so that the sheet's and the reader's forms are equal; others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")
