"""From sheets and files to tables: filtering, tuning, assignment and pooling as a user runs them.

Runs, markers and samples go by their names: `run_id`, `marker_id` and `sample_id` hold the sheet's text. Counts, variants and
stages are Spark tables all the way; only the sheet's samples, which are columns of the result, reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varicube.functions.storage import stored
from varicube.operators import counts as cube
from varicube.operators import alignment, pairs, tables, taxonomy, tuning
from varicube.operators import reads as reads_
from varicube.operators.counts import KEYS, N_IJ, RUN_MARKER, SAMPLE_REPLICATE
from varicube.params import Params, chain_options, resolve
from varicube.sources import sequences, sheets, sinks

NAMES = {"run": "run_id", "marker": "marker_id", "sample": "sample_id"}


def merged_reads(spark: SparkSession, sheet: DataFrame, folder: str, params: Params | None = None) -> tuple[DataFrame, DataFrame]:
    """(reads, statistics) of the sheet's pairs of FASTQ files: mergedfasta, read_id, sequence; and forward, reverse and merged reads of each pair.

    mergedfasta is the forward file's name with fasta for fastq, by which sorted_reads() finds a read's tags. Missing files are named in a warning and skipped.
    """
    p = params or resolve()
    pairs_ = sorted({(r[0], r[1]) for r in sheet.select("fastqfwd", "fastqrev").distinct().collect()})
    paths = [tuple(f"{folder.rstrip('/')}/{x}" for x in pair) for pair in pairs_]
    there = set(sequences.existing(spark, sorted({x for pair in paths for x in pair})))
    paths = [pair for pair in paths if set(pair) <= there]
    if not paths:
        raise FileNotFoundError(f"no pair of the sheet's FASTQ files is in {folder}")
    forward, reverse = zip(*paths)
    mates = stored(sequences.read_pairs(spark, list(forward), list(reverse)), "mates")
    merged = stored(reads_.merge_pairs(
        mates, least_overlap=p.fastq_minovlen, most_errors=p.fastq_maxee, least_length=p.fastq_minmergelen, most_length=p.fastq_maxmergelen, most_ns=p.fastq_maxns,
        truncate_quality=p.fastq_truncqual, least_read=p.fastq_minlen, offset=p.fastq_ascii, keep=("source_file",),
    ), "merged")
    statistics = reads_.merge_stats(mates, mates, merged)
    return merged.select(merged_name("source_file").alias("mergedfasta"), "read_id", "sequence"), statistics


def merged_name(path) -> Column:
    """The name of a FASTQ file with fasta for fastq."""
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"\.fastq", ".fasta")


def merged_sheet(sheet: DataFrame) -> DataFrame:
    """The sheet of merged files for one of pairs of FASTQ files."""
    return sheet.withColumn("mergedfasta", merged_name("fastqfwd")).drop("fastqfwd", "fastqrev")


def sorted_reads(reads: DataFrame, sheet: DataFrame, params: Params | None = None, both_strands: bool = True, anchored_tags: bool = True, anchored_primers: bool = True) -> DataFrame:
    """Reads by run, marker, sample and replicate from merged ones (mergedfasta, read_id, sequence), by the sheet's tags and without its primers.

    Tags of a file that stand for several sample-replicates are an error. A reversed read is turned round. A read that several rows of the sheet fit is there for each of them.
    """
    p = params or resolve()
    rows = sheet.select(*[F.col(k).alias(v) for k, v in NAMES.items()], F.col("replicate").cast("int").alias("replicate"), F.col("mergedfasta").alias("file"), *[F.upper(c).alias(c) for c in ("tagfwd", "tagrev", "primerfwd", "primerrev")]).distinct()
    twice = reads_.tag_conflicts(rows, "file").limit(5).collect()
    if twice:
        raise ValueError("tags of several sample-replicates: " + "; ".join(f"{r.file} {r.tagfwd} {r.tagrev}" for r in twice))
    raw = reads.select("mergedfasta", "read_id", F.upper("sequence").alias("raw"))
    raw = reads_.both_strands(raw).drop("strand") if both_strands else raw
    found = reads_.demux_anchored(raw, rows) if anchored_tags else reads_.demux_floating(raw, rows, keep=("mergedfasta",))
    own = found.where("mergedfasta = file")
    trimmed = reads_.primer_trim(own, F.col("primerfwd"), F.col("primerrev"), p.cutadapt_error_rate, anchored=anchored_primers)
    return reads_.length_window(trimmed, p.cutadapt_minimum_length, p.cutadapt_maximum_length).select(*SAMPLE_REPLICATE, "read_id", "sequence")


def sampled_reads(reads: DataFrame, sheet: DataFrame, n: int, seed: int = 1, file_col: str = "mergedfasta") -> tuple[DataFrame, DataFrame]:
    """(reads, sheet) of exactly n reads of each file, under new file names; a file with fewer is an error."""
    fewest = reads_.smallest_file(reads, file_col)
    if fewest < n:
        raise ValueError(f"the smallest file has {fewest} reads, fewer than {n}")
    return reads_.sampled_sheet(reads_.random_reads(reads, n, seed, file_col), file_col), reads_.sampled_sheet(sheet, file_col)


def read_reads(spark: SparkSession, sheet: DataFrame, folder: str) -> DataFrame:
    """Reads of the sheet's sorted FASTA files with their run, marker, sample and replicate. A missing file is named in a warning and skipped."""
    placed = sheet.select(*[F.col(k).alias(v) for k, v in NAMES.items()], F.col("replicate").cast("int").alias("replicate"), F.concat(F.lit(folder.rstrip("/") + "/"), "sortedfasta").alias("path"))
    paths = sorted({r["path"] for r in placed.select("path").distinct().collect()})
    reads = sequences.read_fasta(spark, paths)
    keyed = placed.withColumn("file", sequences.plain_path("path"))
    return reads.withColumn("file", sequences.plain_path("source_file")).join(keyed, "file").select(*SAMPLE_REPLICATE, "read_id", "sequence")


def count_cube(reads: DataFrame, known: DataFrame | None = None, cutoff: int = 2) -> tuple[DataFrame, DataFrame]:
    """(counts, variants): reads by variant and sample-replicate, of variants with `cutoff` reads or more in a run and marker.

    known: variant_id, sequence of earlier runs, whose numbers stay. Sequences with other letters than A, C, G and T are left out.
    """
    seen = stored(cube.dereplicate(reads.where("sequence rlike '^[ACGT]+$'")), "dereplicated")
    known = known if known is not None else reads.sparkSession.createDataFrame([], "variant_id long, sequence string")
    frequent = seen.groupBy(*RUN_MARKER, "sequence").agg(F.sum("read_count").alias("n")).where(F.col("n") >= cutoff)
    variants = stored(sinks.extend_dictionary(known, frequent.select("sequence")), "variants")
    kept = seen.join(frequent.drop("n"), [*RUN_MARKER, "sequence"], "left_semi")
    return stored(kept.join(variants, "sequence").select(*KEYS, "read_count"), "counts"), variants


def sample_names(sheet: DataFrame) -> list[str]:
    """The sheet's samples in order of name; they are the columns of the table."""
    return sorted(r["sample"] for r in sheet.select("sample").distinct().collect())


def filtered(counts: DataFrame, variants: DataFrame, sheet: DataFrame, params: Params | None = None, specific: DataFrame | None = None, store: str | None = None, since: str | None = None, until: str | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """(stages, asv_table) of the counts. The table is None if the chain is told to end before its last stage.

    store: a folder in which each stage's rows are kept by run and marker; with it, `since` takes up what the stage before has
    stored, restricted to the sheet's sample-replicates. Without it, `since` takes `counts` for what the stage before has kept. Clusters are greedy ones over the variants that are left, by their reads.
    """
    p, spark = params or resolve(), counts.sparkSession
    keys = sheet.select(*[F.col(k).alias(v) for k, v in NAMES.items()], F.col("replicate").cast("int").alias("replicate")).distinct()
    earlier = {}
    if since and store:
        rows = spark.read.parquet(store).where("not filter_delete")
        rows = rows.select("stage", *[F.col(c).cast(counts.schema[c].dataType).alias(c) for c in counts.columns]).join(keys, SAMPLE_REPLICATE, "left_semi")
        earlier = {s: rows.where(F.col("stage") == s).drop("stage") for s in pairs.STAGES}
        before = pairs.STAGES.index(since) - 1
        counts = earlier[pairs.STAGES[before]] if before >= 0 else counts
    else:
        counts = counts.join(keys, SAMPLE_REPLICATE, "left_semi")
    stages = pairs.filter_chain(counts, variants, **chain_options(p), specific=specific, since=since, until=until)
    if store:
        for name, rows in stages.items():
            if name != "average":
                sinks.write_stage(rows.select(*KEYS, "read_count", "filter_delete"), keys, name, store)
    if "average" not in stages:
        return stages, None

    def kept(name: str) -> DataFrame:
        """What a stage of this call or of an earlier one has kept."""
        return stages[name].where("not filter_delete").drop("filter_delete") if name in stages else earlier.get(name, counts)

    left = kept("codon_stop")
    borderline = pairs.borderline_any(pairs.chimera_borderline(kept("pcr_error"), variants, p.uchime3_denovo_abskew))
    sizes = cube.totals(left, ["variant_id"], "size")
    clusters = pairs.cluster_sizes(pairs.greedy_clusters(sizes, pairs.close_pairs(variants.join(sizes, "variant_id", "left_semi"), p.cluster_identity)))
    return stages, tables.asv_table(left, variants, borderline, sample_names(sheet), clusters)


def of_run_markers(counts: DataFrame, run_markers: DataFrame | None) -> DataFrame:
    """The counts of the listed pairs of run and marker (columns run, marker); all without a list."""
    return counts if run_markers is None else sheets.restrict_to_run_markers(counts.withColumnsRenamed({"run_id": "run", "marker_id": "marker"}), run_markers).withColumnsRenamed({"run": "run_id", "marker": "marker_id"}).select(*counts.columns)


def tuned(counts: DataFrame, variants: DataFrame, known: DataFrame, params: Params | None = None, by_replicate: bool = False, run_markers: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four reports from known occurrences as sheets.read_known gives them, for the listed runs and markers if there is a list."""
    p, counts = params or resolve(), of_run_markers(counts, run_markers)
    named = of_run_markers(known.select(*[F.col(k).alias(v) for k, v in NAMES.items()], "variant_id", "mock", "action", "sequence"), run_markers)
    grid = tuning.optimize_grid(counts, named, p.lfn_sample_replicate_cutoff, p.min_replicate_number, by_replicate)
    return {
        "sample_replicate": tuning.sample_replicate_report(counts, named),
        "pcr_error": tuning.pcr_error_report(counts, variants, named),
        "read_count_and_variant": tuning.grid_report(grid),
        "specific": tuning.specific_cutoffs(counts, named, by_replicate),
    }


def made_known_occurrences(table: DataFrame, types: DataFrame, mock: DataFrame, samples: list[str], proportion: float = 0.5, prefix: str = "sample") -> tuple[DataFrame, DataFrame]:
    """(known, missing): occurrences to keep and to delete by a table of variants and samples, and expected ones that it lacks.

    table: run_id, marker_id, variant_id, sequence and a column of reads for each of `samples` (its name after the prefix), as filtered() gives it; types and mock as sheets.read_sample_types and
    sheets.read_mock give them. known has run, marker, sample, mock, variant_id, action and sequence: a sheet that read_known reads. Without a variant of
    an expected sequence its number is 0.
    """
    columns = [f"{prefix}{x}" for x in samples]
    long = table.unpivot(["run_id", "marker_id", "variant_id", "sequence"], columns, "sample_id", "read_count").withColumn("sample_id", F.expr(f"substr(sample_id, {len(prefix) + 1})"))
    long = stored(long.withColumn("sequence", F.upper("sequence")), "variant-table")
    kinds = types.select(F.col("sample").alias("sample_id"), "sample_type", "habitat").distinct()
    listed = mock.select(*[F.col(k).alias(v) for k, v in NAMES.items()], "sequence", "action")
    keep = tuning.known_keep(listed, long)
    gone = tuning.delete_negative(long, kinds).withColumn("mock", F.lit(0)).unionByName(tuning.delete_mock(long, kinds, listed).withColumn("mock", F.lit(1)))
    gone = gone.unionByName(tuning.delete_habitat(long, kinds, proportion).withColumn("mock", F.lit(0))).distinct().join(long.select("run_id", "marker_id", "variant_id", "sequence").distinct(), ["run_id", "marker_id", "variant_id"])
    told = [*[F.col(v).alias(k) for k, v in NAMES.items()], "mock", "variant_id", "action", "sequence"]
    known = keep.withColumn("mock", F.lit(1)).select(*told).unionByName(gone.select(*told))
    return known.distinct(), tuning.missing_occurrences(keep, long).select(*[F.col(v).alias(k) for k, v in NAMES.items()], "sequence").distinct()


def similar_hits(variants: DataFrame, references: DataFrame, params: Params | None = None, identity: float = 70) -> DataFrame:
    """Hits for assigned() by a search of our own: references are target_id, sequence, target_tax_ids (numbers joined by ;), a target once each."""
    p = params or resolve()
    found = alignment.similar_targets(variants, references, identity, p.qcov_hsp_perc)
    return found.join(references.select("target_id", "target_tax_ids"), "target_id").select("variant_id", "target_id", "identity", "coverage", "target_tax_ids")


def assigned(variants: DataFrame, hits: DataFrame, taxa: DataFrame, params: Params | None = None, cache: DataFrame | None = None, reset: bool = False) -> tuple[DataFrame, DataFrame]:
    """(table, cache): variants with their lowest groups, and the groups of all variants assigned so far.

    hits: similarity hits as sheets.read_hits gives them, their variants' numbers cast to the variants'. Only variants that the cache (variant_id, identity, ltg_rank, ltg_tax_id) has
    no group for are assigned, all on reset; others keep the cache's group.
    """
    p = params or resolve()
    kind = variants.schema["variant_id"].dataType
    good = taxonomy.clean_hits(hits.where(F.col("coverage") >= p.qcov_hsp_perc)).withColumn("variant_id", F.col("variant_id").cast(kind))
    if cache is not None:
        good = good.join(taxonomy.unassigned(variants, cache, reset).select("variant_id"), "variant_id", "left_semi")
    lineage = taxonomy.lineages(good.select(F.col("target_tax_id").alias("tax_id")).distinct(), taxa)
    groups = taxonomy.ltg(good, lineage, p.include_prop, p.ltg_rule_threshold, p.min_number_of_taxa)
    if cache is not None:
        groups = sinks.store_assignments(groups, cache.select(F.col("variant_id").cast(kind).alias("variant_id"), "identity", "ltg_rank", "ltg_tax_id"))
    groups = stored(groups, "groups")
    return taxonomy.annotate(variants, groups, taxa), groups


def pooled_markers(counts: DataFrame, variants: DataFrame, sheet: DataFrame, presence: bool = True, run_markers: DataFrame | None = None) -> DataFrame:
    """Variants that agree wherever they overlap, pooled over the markers (of the list, if there is one): their lists, and presence or reads by run and sample."""
    counts = of_run_markers(counts, run_markers)
    sheet = sheet if run_markers is None else sheets.restrict_to_run_markers(sheet, run_markers)
    sizes = cube.totals(counts, ["variant_id"], "size")
    own = variants.join(sizes, "variant_id", "left_semi")
    clusters = stored(pairs.greedy_clusters(sizes, pairs.overlapping_pairs(own)), "pools")
    cells = sorted(tuple(r) for r in sheet.select("run", "sample").distinct().collect())
    listed = tables.pooled(counts, variants, clusters)
    return listed.join(tables.pooled_cells(counts, clusters, cells, presence), "clusterid")
