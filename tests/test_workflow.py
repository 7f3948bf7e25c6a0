"""From sheet, files and parameters to the tables, with values worked out by hand."""

import pytest

from varicube.params import read_params
from varicube.plans import workflow
from varicube.sources import sheets

PARENT = "ACGATCGATTGCAACGATCGATTGCAACGATCGATTGCAGGA"
ERROR = PARENT[:9] + ("A" if PARENT[9] != "A" else "C") + PARENT[10:]
SHIFTED = "TTGCCATTGGCAACCGGTTACCTTGGCCAATTGGCCAATTG"  # one base fewer: another frame
SECOND = "GGCATTACGGCATTACGGCATTACGGCATTACGGCATTACGT"


@pytest.fixture
def project(tmp_path):
    sizes = {PARENT: 200, ERROR: 12, SHIFTED: 60, SECOND: 90, "ACGTNN": 5, "CCCC": 1}
    lines = ["Run\tMarker\tSample\tReplicate\tSortedFasta"]
    for sample in ("s1", "s2"):
        for replicate in (1, 2, 3):
            name = f"{sample}_{replicate}.fasta"
            lines.append(f"r1\tm1\t{sample}\t{replicate}\t{name}")
            reads = [x for x, n in sizes.items() if sample == "s1" or x == PARENT for _ in range(n)]
            (tmp_path / name).write_text("".join(f">{i}\n{x.lower()}\n" for i, x in enumerate(reads)))
    lines.append("r1\tm1\ts3\t1\tmissing.fasta")
    (tmp_path / "sheet.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "params.yml").write_text("---\nlfn_read_count_cutoff: 10  # reads\nskip_filter_codon_stop: true\n")
    return tmp_path


def test_from_files_to_the_table(spark, project):
    sheet = sheets.read_samples(spark, str(project / "sheet.tsv"))
    params = read_params(str(project / "params.yml"))
    with pytest.warns(UserWarning, match="missing.fasta"):
        reads = workflow.read_reads(spark, sheet, str(project))
    counts, variants = workflow.count_cube(reads, cutoff=params.global_read_count_cutoff)
    # CCCC has three reads in all, so the global cutoff keeps it; a sequence with other letters is no variant
    number = {r.sequence: r.variant_id for r in variants.collect()}
    assert number == {x: i for i, x in enumerate(sorted([PARENT, ERROR, SHIFTED, SECOND, "CCCC"]), 1)}
    store = str(project / "stages")
    stages, table = workflow.filtered(counts, variants, sheet, params, store=store)
    gone = {name: {number_of for number_of, in rows.where("filter_delete").select("variant_id").distinct().collect()} for name, rows in stages.items() if name != "average"}
    assert gone["lfn"] == {number["CCCC"]} and gone["pcr_error"] == {number[ERROR]} and gone["indel"] == {number[SHIFTED]}
    assert table.columns == ["run_id", "marker_id", "variant_id", "sequence_length", "read_count", "samples1", "samples2", "samples3", "clusterid", "clustersize", "chimera_borderline", "sequence"]
    got = {r.sequence: (r.run_id, r.marker_id, r.read_count, r.samples1, r.samples2, r.samples3, r.clustersize) for r in table.collect()}
    assert got == {PARENT: ("r1", "m1", 1200, 600, 600, 0, 1), SECOND: ("r1", "m1", 270, 270, 0, 0, 1)}

    again, same = workflow.filtered(counts.limit(0), variants, sheet, params, store=store, since="indel")
    assert list(again) == ["indel", "codon_stop", "average"]
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, table.collect()))
    assert workflow.filtered(counts, variants, sheet, params, until="lfn")[1] is None

    pooled = workflow.pooled_markers(again["codon_stop"].where("not filter_delete"), variants, sheet).collect()
    assert {(r.pooled_variants, r["runr1_samples1"], r["runr1_samples2"], r["runr1_samples3"]) for r in pooled} == {(str(number[PARENT]), 1, 1, 0), (str(number[SECOND]), 1, 0, 0)}

    known = project / "known.tsv"
    known.write_text(f"Marker\tRun\tSample\tMock\tAction\tSequence\nm1\tr1\ts1\t1\tkeep\t{PARENT}\nm1\tr1\ts1\t1\tdelete\t{ERROR}\n")
    reports = workflow.tuned(counts, variants, sheets.read_known(spark, str(known), variants), params)
    grid = reports["read_count_and_variant"].collect()
    assert grid and {r.n_keep for r in grid} == {1} and min(r.n_delete for r in grid) == 0
    assert {(r.variant_unexpected, r.variant_expected) for r in reports["pcr_error"].collect()} == {(number[ERROR], number[PARENT])}
    assert reports["sample_replicate"].count() == 3


def test_from_hits_to_groups(spark, tmp_path):
    (tmp_path / "hits.tsv").write_text("".join(f"1\tt{i}\t98.5\t0.0\t{c}\t{t}\n" for i, (t, c) in enumerate([(7, 100), (7, 95), (7, 90), (8, 20)])))
    (tmp_path / "taxa.tsv").write_text("tax_id\tparent_tax_id\trank\tname_txt\told_tax_id\n1\t1\tno rank\troot\t\n5\t1\tphylum\tP\t\n7\t5\tgenus\tG\t\n8\t5\tgenus\tH\t\n")
    variants = spark.createDataFrame([(1, "ACGT"), (2, "GGGG")], "variant_id long, sequence string")
    got, _ = workflow.assigned(variants, sheets.read_hits(spark, str(tmp_path / "hits.tsv")), sheets.read_taxonomy(spark, str(tmp_path / "taxa.tsv")))
    assert {(r.variant_id, r.ltg_rank, r.ltg_tax_name, r.phylum) for r in got.collect()} == {(1, "genus", "G", "P"), (2, None, None, None)}


def test_parameter_files(tmp_path):
    path = tmp_path / "p.yml"
    path.write_text("lfn_variant_replicate_cutoff: 0.01\ncluster_identity: 0.9\n")
    assert read_params(str(path)).lfn_variant_cutoff is None and read_params(str(path)).cluster_identity == 0.9
    for bad in ("no_such: 1\n", "lfn_read_count_cutoff 5\n"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            read_params(str(path))
