"""Tables, pooling and known occurrences on small frames."""

from varicube.operators import pairs, tables, tuning

COLS = "run_id int, marker_id int, sample_id int, replicate int, variant_id long, read_count long"


def frame(spark, rows):
    return spark.createDataFrame([(1, 1, *r) for r in rows], COLS)


def test_asv_table_with_clusters_and_labels(spark):
    counts = frame(spark, [(1, 1, 1, 5), (1, 2, 1, 6), (2, 1, 2, 7)])
    variants = spark.createDataFrame([(1, "ACGT"), (2, "ACGTA")], "variant_id long, sequence string")
    flags = spark.createDataFrame([(2, True)], "variant_id long, chimera_borderline boolean")
    known = spark.createDataFrame([(1, 1, 1, 1, 1, "keep"), (1, 1, 2, 2, 0, "delete")], "run_id int, marker_id int, variant_id long, sample_id int, mock int, action string")
    clusters = pairs.cluster_sizes(spark.createDataFrame([(1, 1), (2, 1)], "variant_id long, clusterid long"))
    table = tables.asv_table(counts, variants, flags, [1, 2, 3], clusters, tables.keep_labels(known, [1, 3]))
    assert table.columns == ["run_id", "marker_id", "variant_id", "sequence_length", "read_count", "sample1", "sample2", "sample3", "keep_sample1", "keep_sample3", "clusterid", "clustersize", "chimera_borderline", "sequence"]
    assert sorted(map(tuple, table.collect())) == [(1, 1, 1, 4, 11, 11, 0, 0, 1, 0, 1, 2, False, "ACGT"), (1, 1, 2, 5, 7, 0, 7, 0, 0, 0, 1, 2, True, "ACGTA")]


def test_pooled_lists_sort_numbers_as_numbers(spark):
    counts = frame(spark, [(1, 1, 10, 5), (1, 1, 9, 6)])
    variants = spark.createDataFrame([(9, "C"), (10, "A")], "variant_id long, sequence string")
    clusters = spark.createDataFrame([(9, 9), (10, 9)], "variant_id long, clusterid long")
    assert [tuple(r) for r in tables.pooled(counts, variants, clusters).collect()] == [(9, "9,10", "1", "1", "A,C")]


def test_known_occurrences_by_kind(spark):
    table = spark.createDataFrame([
        (1, 1, 1, 1, 5, "AAA"), (1, 1, 2, 1, 5, "CCC"), (1, 1, 3, 1, 0, "GGG"), (1, 1, 2, 2, 4, "CCC"),
        (1, 1, 2, 3, 1, "CCC"), (1, 1, 2, 4, 9, "CCC"),
    ], "run_id int, marker_id int, variant_id long, sample_id int, read_count long, sequence string")
    types = spark.createDataFrame([(1, "mock", None), (2, "negative", None), (3, "real", "sea"), (4, "real", "river")], "sample_id int, sample_type string, habitat string")
    mock = spark.createDataFrame([(1, 1, 1, "AAA", "keep"), (1, 1, 1, "TTT", None), (1, 1, 1, "GGG", "keep")], "run_id int, marker_id int, sample_id int, sequence string, action string")
    keep = tuning.known_keep(mock, table)
    assert {(r.sequence, r.variant_id) for r in keep.collect()} == {("AAA", 1), ("TTT", 0), ("GGG", 3)}
    assert {r.sequence for r in tuning.missing_occurrences(keep, table).collect()} == {"TTT", "GGG"}
    assert [(r.sample_id, r.variant_id) for r in tuning.delete_negative(table, types).collect()] == [(2, 2)]
    assert [(r.sample_id, r.variant_id) for r in tuning.delete_mock(table, types, mock).collect()] == [(1, 2)]
    assert [(r.sample_id, r.variant_id) for r in tuning.delete_habitat(table, types).collect()] == [(3, 2)]
    assert tuning.known_occurrences(table, types, mock).count() == 6


def test_grid_keeps_only_settings_that_keep_most(spark):
    counts = frame(spark, [(s, r, 1, n) for s, n in ((1, 100), (2, 30)) for r in (1, 2)] + [(2, r, 2, 1000) for r in (1, 2)])
    known = spark.createDataFrame([(1, 1, 1, 1, 1, "keep"), (1, 1, 2, 1, 0, "delete")], "run_id int, marker_id int, sample_id int, variant_id long, mock int, action string")
    grid = tuning.optimize_grid(counts, known, 0.0, 2).collect()
    assert {r.n_keep for r in grid} == {1} and max(r.read_count_cutoff for r in grid) == 100
    assert {r.n_delete for r in grid if r.read_count_cutoff > 30} == {0} and {r.n_delete for r in grid if r.read_count_cutoff <= 30} == {1}
