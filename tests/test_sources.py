"""Readers, writers and parameters on small files."""

import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from varicube.functions.sequences import reverse_complement
from varicube.operators import reads, tables, taxonomy
from varicube.params import chain_options, resolve
from varicube.sources import sequences, sheets, sinks


def write(path, text, how=open):
    with how(path, "wt") as f:
        f.write(text)
    return str(path)


FASTA = ">a one\nacgt\nACGT\n>b\nGGG\n"


def test_fasta_wrapped_and_compressed(spark, tmp_path, rows):
    paths = [write(tmp_path / "x.fasta", FASTA), write(tmp_path / "y.fasta.gz", FASTA, gzip.open), write(tmp_path / "z.fasta.bz2", FASTA, bz2.open)]
    with pytest.warns(UserWarning):
        df = sequences.read_fasta(spark, [*paths, str(tmp_path / "none.fasta")])
    assert rows(df.select("read_id", "sequence")) == sorted([("a", "ACGTACGT"), ("b", "GGG")] * 3)


def test_fastq_pairs_by_order(spark, tmp_path):
    f = write(tmp_path / "f.fastq", "@r1 x\nACGT\n+\nIIII\n@r2\nGGGG\n+\n@III\n")
    r = write(tmp_path / "r.fastq", "@r1 y\nTTTT\n+\nIIII\n@r2\nCCCC\n+\nIIII\n")
    got = {x.read_id: (x.fwd_seq, x.fwd_qual, x.rev_seq) for x in sequences.read_pairs(spark, f, r).collect()}
    assert got == {"r1": ("ACGT", "IIII", "TTTT"), "r2": ("GGGG", "@III", "CCCC")}


def test_sheet_checks(spark, tmp_path):
    good = write(tmp_path / "s.tsv", "Run\tMarker\tSample\tReplicate\tSortedFasta\nr\tm\ts\t1\ta.fasta\n")
    assert sheets.read_samples(spark, good).columns == ["run", "marker", "sample", "replicate", "sortedfasta"]
    twice = write(tmp_path / "t.tsv", "Run\tMarker\tSample\tReplicate\tSortedFasta\nr\tm\ts\t1\ta.fasta\nr\tm\ts\t1\tb.fasta\n")
    with pytest.raises(ValueError):
        sheets.read_samples(spark, twice)
    with pytest.raises(ValueError):
        sheets.read_sheet(spark, write(tmp_path / "u.tsv", "run\tmarker\nr\tm\n"), "sorted")


def test_sequence_decides_the_variant(spark, tmp_path, rows):
    variants = spark.createDataFrame([(7, "ACGT")], "variant_id long, sequence string")
    path = write(tmp_path / "k.tsv", "Marker\tRun\tSample\tMock\tVariant\tAction\tSequence\nm\tr\ts\t1\t99\tkeep\tacgt\nm\tr\ts\t0\t\tdelete\tTTTT\n")
    assert rows(sheets.read_known(spark, path, variants).select("sequence", "variant_id", "action")) == [("ACGT", 7, "keep"), ("TTTT", None, "delete")]
    cut, wrong = sheets.read_specific_cutoffs(spark, write(tmp_path / "c.tsv", "run\tmarker\tvariant\tlfn_variant_cutoff\tsequence\nr\tm\t9\t0.05\tacgt\n"), variants)
    assert rows(cut) == [("r", "m", 7, 0.05)] and wrong.count() == 1


def test_taxonomy_and_hits(spark, tmp_path, rows):
    path = write(tmp_path / "t.tsv", "tax_id\tparent_tax_id\trank\tname_txt\told_tax_id\n1\t1\tno rank\troot\t\n5\t1\tphylum\tP\t9.0\n5\t1\tphylum\tP\t9.0\n")
    t = sheets.read_taxonomy(spark, path)
    assert rows(t) == [(1, 1, "no rank", "root", None), (5, 1, "phylum", "P", 9)]
    assert rows(taxonomy.lineages(spark.createDataFrame([(5,), (9,), (77,)], "tax_id long"), t, ["phylum"])) == [(5, 5), (9, 9)]
    h = sheets.read_hits(spark, write(tmp_path / "h.tsv", "v1\tt1\t98.5\t0.0\t100\t5;6\nv2\tt2\t90\t0.0\t100\tN/A\n"))
    assert [(r.variant_id, r.target_tax_id) for r in taxonomy.clean_hits(h).collect()] == [("v1", 5)]


def test_broken_lineage_is_partial_or_none(spark, rows):
    t = spark.createDataFrame([(1, 1, "no rank", "root", None), (5, 1, "phylum", "P", None), (6, 5, "genus", "G", None), (8, 4, "genus", "H", None)], "tax_id long, parent_tax_id long, rank string, name_txt string, old_tax_id long")
    ids = spark.createDataFrame([(6,), (8,)], "tax_id long")
    assert rows(taxonomy.lineages(ids, t, ["phylum", "genus"])) == [(6, 5, 6), (8, None, 8)]
    assert rows(taxonomy.lineage_names(ids, t, ["phylum", "genus"])) == [(6, "P", "G")]


def test_stage_table_replaces_only_its_keys(spark, tmp_path):
    path = str(tmp_path / "stages")
    cols = "run_id int, marker_id int, sample_id int, replicate int, variant_id long, read_count long, filter_delete boolean"
    first = spark.createDataFrame([(1, 1, s, 1, 1, 10 * s, False) for s in (1, 2)], cols)
    sinks.write_stage(first, first, "lfn", path)
    again = spark.createDataFrame([(1, 1, 1, 1, 1, 99, True)], cols)
    for _ in range(2):
        sinks.write_stage(again, again, "lfn", path)
    got = {(r.sample_id, r.read_count) for r in spark.read.parquet(path).collect()}
    assert got == {(1, 99), (2, 20)}


def test_dictionary_numbers(spark, rows):
    known = spark.createDataFrame([(3, "CCC")], "variant_id long, sequence string")
    new = spark.createDataFrame([("ttt",), ("CCC",), ("AAA",)], "sequence string")
    assert rows(sinks.extend_dictionary(known, new)) == [(3, "CCC"), (4, "AAA"), (5, "TTT")]


def test_text_outputs(spark, tmp_path):
    v = spark.createDataFrame([(1, "ACGT", 5, 0.5)], "variant_id long, sequence string, size long, share double")
    sinks.write_fasta(v, str(tmp_path / "f"), size_col="size", compression="gzip")
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == [">1;size=5", "ACGT"]
    sinks.write_tsv(v, str(tmp_path / "t"), ["variant_id"], {"share": 8})
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).first().share == "0.50000000"


def test_parameters():
    assert resolve({"lfn_variant_replicate_cutoff": 0.1}).lfn_variant_cutoff is None
    assert chain_options(resolve({"lfn_read_count_cutoff": 7, "genetic_code": 1}))["cutoffs"].read_count == 7
    for bad in ({"no_such": 1}, {"lfn_variant_cutoff": 0.1, "lfn_variant_replicate_cutoff": 0.1}):
        with pytest.raises(ValueError):
            resolve(bad)


def test_lookup_without_a_name_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,)], "sample_id int")
    names = spark.createDataFrame([(1, "a")], "sample_id int, name string")
    with pytest.raises(Exception, match="no name"):
        tables.looked_up(df, names, "sample_id").collect()


def test_primers_floating_and_mismatched(spark):
    df = spark.createDataFrame([(1, "TTACGTACGTACCCCCCCCTTGGTTGGTTAA"), (2, "TTACGTACGAACCCCCCCCTTGGTTGGTTAA"), (3, "TTACGAACGAACCCCCCCCTTGGTTGGTTAA")], "read_id long, inner string")
    got = {r.read_id: r.sequence for r in reads.primer_trim(df, "ACGTRCGTAC", "AACCAACCAA", 0.1, anchored=False).collect()}
    assert got == {1: "CCCCCCC", 2: "CCCCCCC"}


def test_merge_pairs_takes_the_better_base(spark):
    truth = "ACGTTGCAAGCTTAGCCATG" * 2
    back = spark.createDataFrame([(truth[10:],)], "s string").select(reverse_complement(F.col("s"))).first()[0]
    wrong = back[:2] + ("A" if back[2] != "A" else "C") + back[3:]
    df = spark.createDataFrame([(1, truth[:30], "I" * 30, wrong, "II" + "0" + "I" * 27)], "read_id long, fwd_seq string, fwd_qual string, rev_seq string, rev_qual string")
    got = reads.merge_pairs(df, least_overlap=10, least_length=20, least_read=20).collect()
    assert len(got) == 1 and len(got[0].sequence) == 40
