"""FASTQ files in splits, and the way from pairs of files to the table of variants."""

import bz2
import gzip
import random
from collections import Counter

import pytest

from varicube.functions.sequences import stop_count
from varicube.params import read_params, resolve
from varicube.plans import workflow
from varicube.sources import sequences, sheets, sinks

TURN = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s[::-1].translate(TURN)


def records(rng, n):
    out = []
    for i in range(n):
        size = rng.randrange(1, 12)
        out.append((f"r{i}", "".join(rng.choices("ACGTN", k=size)), "".join(rng.choices("@@+I#5", k=size))))
    return out


def fastq(rows, end="\n", note=""):
    return "".join(f"@{i}{note}{end}{s}{end}+{end}{q}{end}" for i, s, q in rows)


@pytest.mark.parametrize("size", [23, 64, 10_000])
def test_any_split_gives_the_same_records(spark, tmp_path, monkeypatch, size):
    rng = random.Random(size)
    one, two, three = records(rng, 22), records(rng, 9), records(rng, 3)
    (tmp_path / "one.fastq").write_text(fastq(one, note=" 1:N:0"))
    (tmp_path / "two.fastq").write_bytes(fastq(two, end="\r\n").encode() + b"@cut\nACG\n")
    with gzip.open(tmp_path / "three.fastq.gz", "wt") as f:
        f.write(fastq(three))
    with bz2.open(tmp_path / "four.fastq.bz2", "wt") as f:
        f.write(fastq(two))
    small = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 1}
    kept, stored, plans = {k: spark.conf.get(k) for k in small}, sequences.stored, []

    def stored_from_small_splits(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        for k, v in (small if label == "fastq" else {}).items():
            spark.conf.set(k, v)
        try:
            return stored(df, label)
        finally:
            for k, v in kept.items():
                spark.conf.set(k, v)

    monkeypatch.setattr(sequences, "stored", stored_from_small_splits)
    with pytest.warns(UserWarning, match="none.fastq"):
        got = sequences.read_fastq(spark, [str(tmp_path / n) for n in ("one.fastq", "two.fastq", "three.fastq.gz", "four.fastq.bz2", "none.fastq")])
    plans += [part for part in got._jdf.queryExecution().executedPlan().toString().split("Scan parquet")[:1]]
    got = got.collect()
    assert "Exchange" not in plans[0] and "Exchange hashpartitioning" not in plans[-1]  # neither lines nor records are shuffled
    for name, rows in (("one.fastq", one), ("two.fastq", two), ("three.fastq.gz", three), ("four.fastq.bz2", two)):
        own = sorted((r.ordinal, r.read_id, r.sequence, r.quality) for r in got if r.source_file.endswith(name))
        assert own == [(k, *r) for k, r in enumerate(rows)], name


def test_a_file_without_records(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("")
    (tmp_path / "b.fastq").write_text("no\nrecord\n")
    assert sequences.read_fastq(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq")]).count() == 0


TAGS = {("s1", 1): ("ACGTAC", "TTGACA"), ("s1", 2): ("GATTCA", "CCATGT"), ("s2", 1): ("TGCATG", "AGGTCC"), ("s2", 2): ("CTAGCA", "GTTAAC")}
PRIMERS = ("GGRTTYACNTCA", "CCWGATSTTGKA")
REAL = ("GGATTCACGTCA", "CCAGATGTTGGA")
FIRST = "ACGATCGATTGCAACGATCGATTGCAACGATCGATTGCAGGACCATTGACCGATTGGCAC"
SECOND = "GGCATTACGGCATTACGGCATTACGGCATTACGGCATTACGTCCGATTGCCAAGGCTTAC"


@pytest.fixture
def project(tmp_path):
    rng = random.Random(3)
    forward, reverse = [], []
    lines = ["Run\tMarker\tSample\tReplicate\tTagFwd\tPrimerFwd\tTagRev\tPrimerRev\tFastqFwd\tFastqRev"]
    for (sample, replicate), (head, tail) in TAGS.items():
        lines.append(f"r1\tm1\t{sample}\t{replicate}\t{head.lower()}\t{PRIMERS[0]}\t{tail}\t{PRIMERS[1]}\tx_fw.fastq\tx_rv.fastq")
        for text, n in ((FIRST, 60), (SECOND, 40 if sample == "s1" else 0)):
            for k in range(n):
                whole = head + REAL[0] + text + rc(REAL[1]) + rc(tail)
                whole = rc(whole) if k % 2 else whole
                mates = (whole[:80], rc(whole[-80:]))
                for out, bases in zip((forward, reverse), mates):
                    out.append((f"q{len(forward)}", bases, "I" * len(bases)))
    for out in (forward, reverse):  # of no use: no tags, and bad from the start
        out += [("x1", "A" * 80, "I" * 80), ("x2", "A" * 80, "#" * 80)]
    order = list(range(len(forward)))
    rng.shuffle(order)
    (tmp_path / "x_fw.fastq").write_text(fastq([forward[i] for i in order]))
    (tmp_path / "x_rv.fastq").write_text(fastq([reverse[i] for i in order]))
    lines.append(f"r1\tm1\ts9\t1\tAAAAAA\t{PRIMERS[0]}\tAAAAAC\t{PRIMERS[1]}\tgone_fw.fastq\tgone_rv.fastq")
    (tmp_path / "sheet.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "params.yml").write_text("fastq_minovlen: 20\nfastq_minmergelen: 60\nskip_filter_codon_stop: yes\nskip_filter_indel: 'true'\ncutadapt_error_rate: 0.1\n")
    return tmp_path


def test_from_fastq_pairs_to_the_table(spark, project):
    sheet, params = sheets.read_samples(spark, str(project / "sheet.tsv"), "fastq"), read_params(str(project / "params.yml"))
    with pytest.warns(UserWarning, match="gone_"):
        merged, statistics = workflow.merged_reads(spark, sheet, str(project), params)
    assert [tuple(r)[1:] for r in statistics.collect()] == [(322, 322, 320)]
    assert {r.mergedfasta for r in merged.select("mergedfasta").distinct().collect()} == {"x_fw.fasta"}
    tags = workflow.merged_sheet(sheet)
    for anchored in (True, False):
        found = workflow.sorted_reads(merged, tags, params, anchored_tags=anchored, anchored_primers=anchored)
        assert Counter((r.sample_id, r.replicate, r.sequence) for r in found.collect()) == Counter({(s, k, x): n for s, k in TAGS for x, n in ((FIRST, 60), (SECOND, 40)) if s == "s1" or x == FIRST})
    one = workflow.sorted_reads(merged, tags, params, both_strands=False)
    assert one.count() == 160
    assert workflow.sorted_reads(merged, tags, resolve({"cutadapt_minimum_length": 61})).count() == 0

    # in folders for each sample-replicate, and back from there
    folders = sinks.write_demultiplexed(found, str(project / "sorted"), compression="gzip").collect()
    assert len(folders) == 4
    for f in folders:
        back = sequences.read_fasta(spark, [f.folder])
        assert back.count() == (100 if f.sample_id == "s1" else 60) and {r.sequence for r in back.collect()} <= {FIRST, SECOND}

    counts, variants = workflow.count_cube(found, cutoff=params.global_read_count_cutoff)
    number = {r.sequence: r.variant_id for r in variants.collect()}
    stages, table = workflow.filtered(counts, variants, sheet, params)
    got = {r.sequence: (r.read_count, r.samples1, r.samples2) for r in table.collect()}
    assert got == {FIRST: (240, 120, 120), SECOND: (80, 80, 0)} and set(number) == set(got)

    again, small = workflow.sampled_reads(merged, tags, 50)
    assert again.count() == 50 and {r.mergedfasta for r in again.collect()} == {"x_fw_sampled.fasta"}
    assert workflow.sorted_reads(again, small, params).count() == 50
    with pytest.raises(ValueError, match="fewer"):
        workflow.sampled_reads(merged, tags, 10_000)


def test_tags_in_common_are_an_error(spark):
    rows = [("r", "m", "s1", "1", "AC", "GT", "GG", "CC", "f"), ("r", "m", "s2", "1", "ac", "GT", "GG", "CC", "f")]
    sheet = spark.createDataFrame(rows, "run string, marker string, sample string, replicate string, tagfwd string, tagrev string, primerfwd string, primerrev string, mergedfasta string")
    reads = spark.createDataFrame([("f", "1", "ACGT")], "mergedfasta string, read_id string, sequence string")
    with pytest.raises(ValueError, match="AC GT"):
        workflow.sorted_reads(reads, sheet)


def test_known_occurrences_from_a_table(spark, tmp_path):
    table = spark.createDataFrame(
        [("r", "m", 1, 500, 40, 30, 0, "ACGT"), ("r", "m", 2, 0, 9, 0, 3, "GGGG"), ("r", "m", 3, 7, 0, 90, 5, "TTTT")],
        "run_id string, marker_id string, variant_id long, sampletpos long, samplea long, sampleb long, sampleneg long, sequence string",
    )
    (tmp_path / "types.tsv").write_text("Run\tSample\tSample_type\tHabitat\nr\ttpos\tMock\t\nr\ta\treal\tlake\nr\tb\treal\tsea\nr\tneg\tnegative\t\n")
    (tmp_path / "mock.tsv").write_text("Marker\tRun\tSample\tSequence\tAction\nm\tr\ttpos\tacgt\tkeep\nm\tr\ttpos\tCCCC\t\nm\tr\ttpos\tTTTT\ttolerate\n")
    types, mock = sheets.read_sample_types(spark, str(tmp_path / "types.tsv")), sheets.read_mock(spark, str(tmp_path / "mock.tsv"))
    known, missing = workflow.made_known_occurrences(table, types, mock, ["tpos", "a", "b", "neg"])
    assert {tuple(r)[2:] for r in known.collect()} == {
        ("tpos", 1, 1, "keep", "ACGT"), ("tpos", 1, 0, "keep", "CCCC"), ("neg", 0, 2, "delete", "GGGG"), ("neg", 0, 3, "delete", "TTTT"), ("b", 0, 1, "delete", "ACGT"),
    }
    assert [tuple(r) for r in missing.collect()] == [("r", "m", "tpos", "CCCC")]
    for name, text in (("t.tsv", "run\tsample\tsample_type\thabitat\nr\ts\tother\t\n"), ("u.tsv", "run\tsample\nr\ts\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError):
            sheets.read_sample_types(spark, str(tmp_path / name))
    (tmp_path / "v.tsv").write_text("marker\trun\tsample\tsequence\taction\nm\tr\ts\tA\tother\n")
    with pytest.raises(ValueError, match="other"):
        sheets.read_mock(spark, str(tmp_path / "v.tsv"))


def test_listed_runs_and_markers_only(spark, tmp_path):
    (tmp_path / "pairs.tsv").write_text("Run\tMarker\nr1\tm2\n")
    listed = sheets.read_sheet(spark, str(tmp_path / "pairs.tsv"), "run_marker")
    rows = [(run, m, s, k, v, 100 * v) for run in ("r1", "r2") for m in ("m1", "m2") for s in ("a",) for k in (1, 2) for v in (1, 2)]
    counts = spark.createDataFrame(rows, "run_id string, marker_id string, sample_id string, replicate int, variant_id long, read_count long")
    variants = spark.createDataFrame([(1, "ACGTAC"), (2, "ACGTAG")], "variant_id long, sequence string")
    sheet = counts.selectExpr("run_id as run", "marker_id as marker", "sample_id as sample", "replicate").distinct()
    pools = workflow.pooled_markers(counts, variants, sheet, run_markers=listed).collect()
    assert {(r.runs, r.markers) for r in pools} == {("r1", "m2")} and "runr1_samplea" in pools[0].asDict() and "runr2_samplea" not in pools[0].asDict()
    known = spark.createDataFrame([("r1", m, "a", v, 1, a, x) for m in ("m1", "m2") for v, a, x in ((2, "keep", "ACGTAG"), (1, "delete", "ACGTAC"))], "run string, marker string, sample string, variant_id long, mock int, action string, sequence string")
    reports = workflow.tuned(counts, variants, known, run_markers=listed)
    assert {r.marker_id for r in reports["sample_replicate"].collect()} == {"m2"} == {r.marker_id for r in reports["specific"].collect()}


def test_groups_are_kept_in_the_cache(spark):
    variants = spark.createDataFrame([(i, "ACGT") for i in (1, 2, 3)], "variant_id long, sequence string")
    taxa = spark.createDataFrame([(1, 1, "no rank", "root", None), (5, 1, "phylum", "P", None), (7, 5, "genus", "G", None)], "tax_id long, parent_tax_id long, rank string, name_txt string, old_tax_id long")
    hits = spark.createDataFrame([(str(v), f"t{k}", 99.0, 0.0, 100.0, "7") for v in (1, 2) for k in range(3)], "variant_id string, target_id string, identity double, evalue double, coverage double, target_tax_ids string")
    cache = spark.createDataFrame([(1, 97.0, "phylum", 5), (9, 100.0, "genus", 7)], "variant_id long, identity double, ltg_rank string, ltg_tax_id long")
    for reset, first in ((False, "P"), (True, "G")):
        table, stored = workflow.assigned(variants, hits, taxa, cache=cache, reset=reset)
        assert {(r.variant_id, r.ltg_tax_name) for r in table.collect()} == {(1, first), (2, "G"), (3, None)}
        assert {r.variant_id for r in stored.collect()} == {1, 2, 9}


def test_groups_by_a_search_of_our_own(spark):
    rng = random.Random(9)
    first, second = ("".join(rng.choices("ACGT", k=150)) for _ in range(2))
    flank = lambda s: "".join(rng.choices("ACGT", k=200)) + s + "".join(rng.choices("ACGT", k=100))
    references = spark.createDataFrame([("a", flank(first), "7"), ("b", flank(first[:70] + "A" + first[71:]), "7;9"), ("c", second, None), ("d", "ACGT", "8")], "target_id string, sequence string, target_tax_ids string")
    variants = spark.createDataFrame([(1, first), (2, second), (3, "".join(rng.choices("ACGT", k=150)))], "variant_id long, sequence string")
    taxa = spark.createDataFrame([(1, 1, "no rank", "root", None), (5, 1, "phylum", "P", None), (7, 5, "genus", "G", None)], "tax_id long, parent_tax_id long, rank string, name_txt string, old_tax_id long")
    table, _ = workflow.assigned(variants, workflow.similar_hits(variants, references), taxa)
    assert {(r.variant_id, r.ltg_rank, r.ltg_tax_name, r.phylum) for r in table.collect()} == {(1, "genus", "G", "P"), (2, None, None, None), (3, None, None, None)}


def test_a_stored_dictionary_stays_in_its_buckets(spark):
    spark.sql("drop table if exists own_dictionary")
    sinks.store_dictionary(spark.createDataFrame([(1, "ACGT"), (5, "GGGG")], "variant_id long, sequence string"), "own_dictionary", 4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        more = spark.createDataFrame([("tttt",), ("ACGT",), ("CCCC",), ("CCCC",), (None,)], "sequence string")
        assert {tuple(r) for r in sinks.extend_stored_dictionary("own_dictionary", more).collect()} == {(1, "ACGT"), (5, "GGGG"), (6, "CCCC"), (7, "TTTT")}
        assert sinks.extend_stored_dictionary("own_dictionary", more).count() == 4
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = sinks.unseen_sequences(more, "own_dictionary")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.sql("drop table own_dictionary")
    right = plan[plan.index("SortMergeJoin") :]
    stored = right[right.rindex("Sort [digest") :]
    assert "own_dictionary" in stored and "Exchange" not in stored


def test_stop_codons_of_other_codes(spark):
    df = spark.createDataFrame([("TAATAGTGAAGATTATCATTT",)], "s string")
    got = df.select(*[stop_count(df.s, 1, code).alias(str(code)) for code in (1, 2, 6, 14, 22, 23)]).first()
    assert tuple(got) == (3, 3, 1, 1, 3, 4)


def test_parameter_files_name_what_is_wrong(tmp_path):
    path = tmp_path / "p.yml"
    path.write_text('lfn_read_count_cutoff: "12"\nskip_filter_indel: Yes\nskip_filter_codon_stop: 1\nlfn_variant_cutoff: ~\nlfn_variant_replicate_cutoff: 0.002\n')
    p = read_params(str(path))
    assert (p.lfn_read_count_cutoff, p.skip_filter_indel, p.skip_filter_codon_stop, p.lfn_variant_cutoff, p.lfn_variant_replicate_cutoff) == (12, True, 1, None, 0.002)
    path.write_text("fastq_maxns: 0\nlfn_read_count_cutoff: many\n")
    with pytest.raises(ValueError, match="line 2: lfn_read_count_cutoff can't be many"):
        read_params(str(path))
