"""Filters on small frames: values worked out by hand, and properties."""

import pytest
from pyspark.sql import functions as F

from varicube.operators import counts, filters, pairs

COLS = "run_id int, marker_id int, sample_id int, replicate int, variant_id long, read_count long"


def frame(spark, rows):
    return spark.createDataFrame([(1, 1, *r) for r in rows], COLS)


def gone(df):
    return {(r.sample_id, r.replicate, r.variant_id) for r in df.where("filter_delete").collect()}


def test_ratio_at_the_cutoff_is_deleted(spark):
    c = frame(spark, [(1, 1, 1, 10), (1, 2, 1, 990), (1, 1, 2, 0)])
    assert gone(filters.lfn_variant(c, 0.01)) == {(1, 1, 1), (1, 1, 2)}
    assert gone(filters.lfn_variant(c, 0.009)) == {(1, 1, 2)}


def test_read_count_is_strict(spark):
    c = frame(spark, [(1, 1, 1, 10), (1, 2, 1, 9)])
    assert gone(filters.lfn_read_count(c, 10)) == {(1, 2, 1)}


def test_specific_cutoff_only_adds(spark):
    c = frame(spark, [(1, 1, 1, 100), (1, 2, 1, 900), (1, 1, 2, 100), (1, 2, 2, 900)])
    own = spark.createDataFrame([(1, 1, 1, 0.5), (1, 1, 2, 0.0)], "run_id int, marker_id int, variant_id long, cutoff double")
    cut = filters.LfnCutoffs(variant=0.1, sample_replicate=0.0, read_count=0)
    assert gone(filters.lfn_all(c, cut, own)) == {(1, 1, 1), (1, 1, 2)}


def test_both_modes_are_an_error():
    with pytest.raises(ValueError):
        filters.LfnCutoffs(variant=0.1, variant_replicate=0.1)


def test_verdicts_are_monotone(spark):
    c = spark.range(300).select(F.lit(1).alias("run_id"), F.lit(1).alias("marker_id"), (F.col("id") % 5).cast("int").alias("sample_id"), (F.col("id") % 3).cast("int").alias("replicate"), (F.col("id") % 7).alias("variant_id"), (F.col("id") * 37 % 101).alias("read_count"))
    c = c.groupBy(*counts.KEYS).agg(F.sum("read_count").alias("read_count"))
    n = [filters.lfn_variant(c, x).where("filter_delete").count() for x in (0.001, 0.01, 0.05, 0.2, 1.0)]
    assert n == sorted(n) and n[-1] == c.count()
    once = sorted(map(tuple, filters.lfn_variant(c, 0.05).collect()))
    assert once == sorted(map(tuple, filters.lfn_variant(c.repartition(7), 0.05).collect()))


def test_min_replicate(spark):
    c = frame(spark, [(1, 1, 1, 5), (1, 2, 1, 5), (1, 1, 2, 5)])
    assert gone(filters.min_replicate(c, 2)) == {(1, 1, 2)}


def test_replicate_average(spark):
    c = frame(spark, [(1, 1, 1, 100), (1, 2, 1, 201)])
    assert [tuple(r)[4:] for r in counts.replicate_average(c).collect()] == [(301, 2, 150.5)]


def test_renkonen_of_disjoint_replicates_is_one(spark):
    c = frame(spark, [(1, 1, 1, 5), (1, 2, 2, 5)])
    assert [r.renkonen_distance for r in filters.renkonen_distances(c).collect()] == [1.0]


def test_renkonen_single_replicate_passes(spark):
    c = frame(spark, [(1, 1, 1, 5), (1, 1, 2, 5)])
    assert filters.renkonen(c).where("not filter_delete").count() == 2


def test_lower_quantile_is_the_floor_rank(spark):
    df = spark.range(119).select(F.lit(1).alias("g"), "id")
    assert filters.lower_quantile(df, ["g"], "id", 0.9, "q").first().q == 106


def test_indel_and_stop_codons(spark):
    v = spark.createDataFrame([(1, "ACGACG"), (2, "ACGACC"), (3, "ACGA"), (4, "TAATAATAATAA"), (5, "TAAATAAATAA")], "variant_id long, sequence string")
    c = frame(spark, [(1, 1, i, 5) for i in range(1, 6)])
    assert gone(filters.indel(c, v)) == {(1, 1, 3), (1, 1, 5)}
    assert gone(filters.codon_stop(c, v)) == {(1, 1, 5)}
    assert [tuple(r) for r in filters.stop_codon_counts(v).where("variant_id = 4").collect()] == [(4, 4, 0, 0)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def sequences(spark, n, size, seed):
    import random

    rng = random.Random(seed)
    base = ["".join(rng.choice("ACGT") for _ in range(size)) for _ in range(max(1, n // 5))]
    out = set()
    while len(out) < n:
        s = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], ["A"], ["C", "G"]])
        out.add("".join(s))
    return list(enumerate(sorted(out), 1))


def test_one_edit_pairs_against_all_pairs(spark):
    seqs = sequences(spark, 60, 21, 3)
    df = spark.createDataFrame(seqs, "variant_id long, sequence string")
    want = {(i, j) for i, a in seqs for j, b in seqs if i < j and edits(a, b) == 1}
    assert want and {tuple(r) for r in pairs.one_edit_pairs(df).collect()} == want


def test_one_edit_pairs_of_short_repeated_and_missing_sequences(spark):
    seqs = list(enumerate(["", "A", "C", "AA", "AC", "CA", "AAA", "ACA", "ACA", None, "ACAC"], 1))
    df = spark.createDataFrame(seqs, "variant_id long, sequence string")
    want = {(i, j) for i, a in seqs for j, b in seqs if i < j and a is not None and b is not None and edits(a, b) == 1}
    assert {tuple(r) for r in pairs.one_edit_pairs(df).collect()} == want


@pytest.mark.parametrize("identity", [0.72, 0.85, 0.97])
def test_close_pairs_of_unequal_lengths(spark, identity):
    seqs = [*sequences(spark, 40, 34, 8), (101, "ACGTACGT"), (102, "ACGTACG"), (103, "ACGTACGT"), (104, ""), (105, None)]
    df = spark.createDataFrame(seqs, "variant_id long, sequence string")
    known = [(i, s) for i, s in seqs if s]
    near = {(i, j) for i, a in known for j, b in known if i != j and edits(a, b) <= int((1 - identity) * max(len(a), len(b)))}
    got = [tuple(r) for r in pairs.close_pairs(df, identity).collect()]
    assert near and sorted(got) == sorted(near)


def test_close_pairs_and_greedy_clusters_against_brute_force(spark):
    seqs = sequences(spark, 40, 40, 5)
    df = spark.createDataFrame(seqs, "variant_id long, sequence string")
    near = {(i, j) for i, a in seqs for j, b in seqs if i != j and edits(a, b) <= int((1 - 0.94) * max(len(a), len(b)) + 1e-9)}
    assert {tuple(r) for r in pairs.close_pairs(df, 0.94).collect()} == near
    size = {i: (i * 7) % 5 for i, _ in seqs}
    want = {}
    for i in sorted(size, key=lambda i: (-size[i], i)):
        centre = [c for c in sorted(size, key=lambda c: (-size[c], c)) if want.get(c) == c and (c, i) in near]
        want[i] = centre[0] if centre else i
    got = pairs.greedy_clusters(spark.createDataFrame(list(size.items()), "variant_id long, size long"), pairs.close_pairs(df, 0.94))
    assert dict(map(tuple, got.collect())) == want


def test_overlapping_pairs(spark):
    v = spark.createDataFrame([(1, "AACCGGTTACGT"), (2, "CCGGTTAC"), (3, "TTACGTGGGCCC"), (4, "TTACGAGGGCCC")], "variant_id long, sequence string")
    assert {tuple(sorted(r)) for r in pairs.overlapping_pairs(v, 6).collect()} == {(1, 2), (1, 3)}


def overlaps(a, b, least):
    """Some place of a from which a and b agree to the end of either, over min(least, len(b)) bases or more."""
    return any(a[i : i + len(b)] == b[: len(a) - i] for i in range(len(a) - min(least, len(b)) + 1)) if b else False


def test_overlapping_pairs_against_all_pairs(spark):
    import random

    rng = random.Random(4)
    genome = ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(3)]
    seqs = []
    for i in range(70):
        at, n = rng.randrange(50), rng.randrange(3, 40)
        s = rng.choice(genome)[at : at + n]
        seqs.append((i, s[:-1] + "A" if i % 5 == 0 else s))
    seqs += [(100, "AAAAAAAAAAAA"), (101, "AAAAAAAAAA"), (102, "AAA"), (103, ""), (104, None)]
    df = spark.createDataFrame(seqs, "variant_id long, sequence string")
    known = [(i, s) for i, s in seqs if s]
    one = {(i, j) for i, a in known for j, b in known if i != j and overlaps(a, b, 8)}
    assert one and {tuple(r) for r in pairs.overlapping_pairs(df, 8).collect()} == one | {(j, i) for i, j in one}


def test_chimera(spark):
    left, right = "ACGTACGTAA", "GGCCTTGGCC"
    v = spark.createDataFrame([(1, left + right), (2, "TTTTGGGGTT" + "AACCAACCAA"), (3, left + "AACCAACCAA"), (4, "CCCCCCCCCCCCCCCCCCCC")], "variant_id long, sequence string")
    c = frame(spark, [(1, 1, 1, 1600), (1, 1, 2, 1700), (1, 1, 3, 100), (1, 1, 4, 10), (2, 1, 1, 1500), (2, 1, 2, 1700), (2, 1, 3, 100)])
    found = {(r.sample_id, r.variant_id) for r in pairs.chimeras(c, v, 16).where("filter_delete").collect()}
    assert found == {(1, 3)}  # in the second sample the parents are not abundant enough


def test_filter_chain_since_until(spark):
    v = spark.createDataFrame([(1, "ACGACGACG"), (2, "ACGACGACC")], "variant_id long, sequence string")
    c = frame(spark, [(1, r, i, 100 * i) for r in (1, 2) for i in (1, 2)])
    cut = filters.LfnCutoffs(variant=0.001, sample_replicate=0.001, read_count=10)
    whole = pairs.filter_chain(c, v, cut)
    assert list(whole) == list(pairs.STAGES) and whole["average"].count() == 2
    assert list(pairs.filter_chain(c, v, cut, since="indel", until="codon_stop")) == ["indel", "codon_stop"]
