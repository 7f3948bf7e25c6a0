"""Merging of mates and the settings of the optimiser against brute force and hand-worked values."""

import random

import pytest

from varicube.operators import reads, taxonomy, tuning

TURN = str.maketrans("ACGTN", "TGCAN")


def merged_one(fs, fq, rs, rq, least_overlap, most_differences, most_errors, least_length, most_length, most_ns, least_read):
    """One pair, base by base."""
    mates = []
    for s, q in ((fs, fq), (rs, rq)):
        n = next((i for i, c in enumerate(q) if ord(c) - 33 <= 10), len(s))
        mates.append(([*s[:n]], [ord(c) - 33 for c in q[:n]]))
    (a, qa), (b, qb) = mates
    if min(len(a), len(b)) < least_read:
        return None
    b, qb = [c.translate(TURN) for c in reversed(b)], qb[::-1]
    tried = [(sum(x != y for x, y in zip(a[len(a) - n :], b)), -n) for n in range(least_overlap, min(len(a), len(b)) + 1)]
    tried = [t for t in tried if t[0] <= -t[1] * most_differences]
    if not tried:
        return None
    n = -min(tried)[1]
    both = [(x, p) if p >= q else (y, q) for x, p, y, q in zip(a[len(a) - n :], qa[len(a) - n :], b, qb)]
    out = [*zip(a[: len(a) - n], qa), *both, *zip(b[n:], qb[n:])]
    text, errors = "".join(c for c, _ in out), sum(10 ** (-q / 10) for _, q in out)
    return (text, errors) if least_length <= len(text) <= most_length and text.count("N") <= most_ns and errors <= most_errors else None


@pytest.mark.parametrize("options", [
    dict(least_overlap=10, most_differences=0.2, most_errors=1.0, least_length=40, most_length=110, most_ns=1, least_read=20),
    dict(least_overlap=25, most_differences=0.05, most_errors=0.2, least_length=60, most_length=80, most_ns=0, least_read=30),
])
def test_merge_pairs_against_brute_force(spark, options):
    rng = random.Random(6)
    rows = [(-1, None, "I", "A", "I"), (-2, "", "", "A", "I"), (-3, "A" * 80, "I" * 80, "T" * 80, "I" * 80)]
    for i in range(300):
        whole = "".join(rng.choice("ACGT") for _ in range(rng.randrange(30, 120)))
        n, m = rng.randrange(15, len(whole) + 1), rng.randrange(15, len(whole) + 1)
        pair = []
        for s in (whole[:n], whole[-m:][::-1].translate(TURN)):
            s, q = [*s], [rng.choice("IIIIIIII5:") for _ in s]
            for _ in range(rng.randrange(0, 3)):
                k = rng.randrange(len(s))
                s[k], q[k] = rng.choice("ACGTN"), rng.choice("#5I")
            pair += ["".join(s), "".join(q)]
        rows.append((i, *pair))
    got = {r.read_id: (r.sequence, round(r.errors, 9)) for r in reads.merge_pairs(spark.createDataFrame(rows, "read_id long, fwd_seq string, fwd_qual string, rev_seq string, rev_qual string"), **options).collect()}
    want = {i: (m[0], round(m[1], 9)) for i, *r in rows if all(r) and (m := merged_one(*r, **options))}
    assert got == want and len(want) > 10


def test_settings_keep_every_expected_variant_or_none_is_told(spark):
    counts = [(1, m, s, r, v, n) for m, n_weak in ((1, 60), (2, 5)) for s in (1, 2) for r in (1, 2) for v, n in ((1, 500), (2, n_weak), (3, 12))]
    cube = spark.createDataFrame(counts, "run_id long, marker_id long, sample_id long, replicate long, variant_id long, read_count long")
    known = spark.createDataFrame([(1, m, 1, v, 1, a) for m in (1, 2) for v, a in ((1, "keep"), (2, "keep"), (3, "delete"))], "run_id long, marker_id long, sample_id long, variant_id long, mock int, action string")
    got = tuning.grid_report(tuning.optimize_grid(cube, known, 0.0005, 2)).collect()
    # marker 2: the second expected variant has 5 reads, below every cutoff of the grid, so no setting is told
    assert {r.marker_id for r in got} == {1} and all(r.n_keep == 2 for r in got)
    assert {(r.read_count_cutoff, r.n_delete) for r in got} == {(10, 1), *[(c, 0) for c in range(20, 61, 10)]}
    assert (got[0].read_count_cutoff, got[0].n_delete) == (60, 0) and got[-1].n_delete == 1


def test_lowest_group_of_a_rank_between_the_six(spark):
    t = [(1, 1, "no rank", "root"), (2, 1, "order", "O"), (3, 2, "subfamily", "S"), (4, 3, "genus", "G"), (5, 3, "genus", "H")]
    taxa = spark.createDataFrame([(*x, None) for x in t], "tax_id long, parent_tax_id long, rank string, name_txt string, old_tax_id long")
    hits = spark.createDataFrame([(1, 99.0, 4), (1, 99.0, 5), (2, 100.0, 4)], "variant_id long, identity double, target_tax_id long")
    lineage = taxonomy.lineages(hits.select(hits.target_tax_id.alias("tax_id")).distinct(), taxa)
    got = {r.variant_id: (r.identity, r.ltg_rank, r.ltg_tax_id) for r in taxonomy.ltg(hits, lineage).collect()}
    assert got == {1: (99.0, "subfamily", 3), 2: (100.0, "genus", 4)}
    circle = spark.createDataFrame([(2, 3, "a", "x", None), (3, 2, "b", "y", None)], taxa.schema)
    with pytest.raises(ValueError, match="levels"):
        taxonomy.lineage_steps(spark.createDataFrame([(2,)], "tax_id long"), circle, deepest=4)
