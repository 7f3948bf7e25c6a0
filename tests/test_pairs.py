"""Pairs of sequences, chimeras, clusters, tags and primers against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from varicube.functions import graphs, storage
from varicube.operators import pairs, reads
from varicube.functions.sequences import BASES, COMPLEMENT, IUPAC


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def sequence(rng, n, letters="ACGT"):
    return "".join(rng.choices(letters, k=n))


def variants_of(spark, seqs):
    return spark.createDataFrame(seqs, "variant_id long, sequence string")


# --- one edit, with an index of earlier variants

def test_index_of_deletion_keys(spark):
    rng = random.Random(1)
    seqs = set()
    for _ in range(12):
        s = sequence(rng, 12, "AC")
        seqs |= {s, s[:3] + s[4:], s[:5] + "G" + s[5:], s[:8] + "T" + s[9:]}
    seqs = list(enumerate(sorted(seqs)))
    rng.shuffle(seqs)
    old, new = variants_of(spark, seqs[:25]), variants_of(spark, seqs[25:])
    first = {tuple(r) for r in pairs.one_edit_pairs(old).collect()}
    for keys in (None, pairs.deletion_keys(old)):
        more = {tuple(r) for r in pairs.one_edit_pairs(new, known=old, keys=keys).collect()}
        assert not first & more
        assert first | more == {tuple(r) for r in pairs.one_edit_pairs(variants_of(spark, seqs)).collect()} == {(i, j) for i, a in seqs for j, b in seqs if i < j and edits(a, b) == 1}


# --- chimeras

def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def brute_chimeras(seqs, n, skew, differences=None):
    """Children of a sample that two different strong parents make up; with differences, those near a single strong parent."""
    out = set()
    for c, s in seqs.items():
        strong = [p for p in seqs if p != c and n.get(p, 0) >= skew * n[c]] if c in n else []
        left = {p: min(shared(s, seqs[p]), len(s) - 1) for p in strong}
        right = {p: min(shared(s[::-1], seqs[p][::-1]), len(s) - 1) for p in strong}
        if any(p != q and left[p] and right[q] and left[p] + right[q] >= len(s) for p in strong for q in strong):
            if differences is None or any(edits(s, seqs[p]) <= differences for p in strong):
                out.add(c)
    return out


def test_chimeras_and_borderline_against_all_parents(spark):
    rng = random.Random(2)
    head = sequence(rng, 8)  # all begin alike
    seqs, counts = {}, {1: {}, 2: {}}
    for i in range(14):
        seqs[i] = head + sequence(rng, rng.randrange(14, 20), "ACG")
    ids = list(seqs)
    for i in range(20, 60):
        a, b = rng.sample(ids, 2)
        cut = rng.randrange(1, len(seqs[b]))
        seqs[i] = seqs[a][:-cut] + seqs[b][-cut:]
    for i in range(60, 80):  # a few bases from a parent, and its beginnings and ends
        s = list(seqs[rng.choice(ids)])
        for _ in range(rng.randrange(3)):
            s[rng.randrange(len(s))] = rng.choice("ACGT")
        seqs[i] = "".join(s)[rng.choice([0, 0, 3]) : rng.choice([None, None, -4])]
    seqs = {i: s for i, s in seqs.items() if s not in [t for j, t in seqs.items() if j < i]}
    for sample in counts:
        for i in seqs:
            if rng.random() < 0.9:
                counts[sample][i] = rng.choice([400, 900, 5000]) if i < 20 else rng.choice([3, 25, 60, 900])
    df = variants_of(spark, list(seqs.items()))
    cube = spark.createDataFrame([(1, 1, s, r, v, n // 2 + (r == 1) * (n % 2)) for s, c in counts.items() for v, n in c.items() for r in (1, 2)], "run_id long, marker_id long, sample_id long, replicate long, variant_id long, read_count long")
    flagged = pairs.chimeras(cube, df, 16).collect()
    want = {(s, c) for s in counts for c in brute_chimeras(seqs, counts[s], 16)}
    assert len(flagged) == sum(map(len, counts.values())) and 10 < len(want) < len(flagged)
    assert {(r.sample_id, r.variant_id) for r in flagged if r.filter_delete} == want
    for k in range(4):
        near = pairs.chimera_borderline(cube, df, 16, differences=k).where("filter_delete").collect()
        assert {(r.sample_id, r.variant_id) for r in near} == {(s, c) for s in counts for c in brute_chimeras(seqs, counts[s], 16, k)}


def test_chimera_rows_follow_the_branches(spark):
    rng = random.Random(3)
    seqs = [(i, sequence(rng, 150)) for i in range(60)]
    assert pairs.branches(variants_of(spark, seqs)).count() < 60 * 20  # of 18,000 beginnings and ends


# --- close pairs and clusters

def test_close_pairs_with_a_conserved_half(spark):
    rng = random.Random(4)
    half = sequence(rng, 100)
    seqs = []
    for i in range(150):
        s = half + sequence(rng, 100) if i % 3 == 0 else half + seqs[-1][1][100:]
        s = list(s)
        for _ in range(rng.randrange(7)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], ["A"], ["C", "G"]])
        seqs.append((i, "".join(s)))
    base = variants_of(spark, seqs).withColumn("len", F.length("sequence"))
    a, b = (base.toDF(f"{x}", f"s{x}", f"l{x}") for x in "ab")
    every = a.crossJoin(b).where("a <> b").where(F.levenshtein("sa", "sb") <= F.floor((1 - F.lit(0.97)) * F.greatest("la", "lb")))
    near = {(r.a, r.b) for r in every.collect()}
    assert near and {tuple(r) for r in pairs.close_pairs(base, 0.97).collect()} == near
    met = pairs.segment_candidates(base, F.floor(0.03 * F.col("len")).cast("int"), F.floor(F.col("short") / 0.97).cast("int") + 1)
    assert met.count() < 6 * len(seqs)


def sequential(size, near):
    out = {}
    by = {}
    for a, b in near:
        by.setdefault(a, []).append(b)
    for v in sorted(size, key=lambda v: (-size[v], v)):
        if out.setdefault(v, v) == v:
            for u in by.get(v, []):
                out.setdefault(u, v)
    return out


@pytest.mark.parametrize("largest", [1 << 20, 30])
def test_greedy_clusters_in_components_and_in_rounds(spark, largest):
    rng = random.Random(5)
    size = {i: rng.randrange(6) for i in range(300)}
    near = {tuple(rng.sample(range(120), 2)) for _ in range(130)} | {(i, i + 1) for i in range(200, 230)} | {(150, 151)}
    near |= {(b, a) for a, b in near}
    got = pairs.greedy_clusters(spark.createDataFrame(list(size.items()), "variant_id long, size long"), spark.createDataFrame(list(near), "a long, b long"), largest)
    rows = got.collect()
    assert len(rows) == 300 and dict(map(tuple, rows)) == sequential(size, near)


def test_a_long_chain_takes_few_jobs(spark):
    n = 10_000
    size, near = {i: n - i for i in range(n)}, [(i, i + 1) for i in range(n - 1)]
    near += [(b, a) for a, b in near]
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    sizes, close = spark.createDataFrame(list(size.items()), "variant_id long, size long"), spark.createDataFrame(near, "a long, b long")
    before = jobs()
    got = dict(map(tuple, pairs.greedy_clusters(sizes, close).collect()))
    assert got == sequential(size, near) == {i: i - i % 2 for i in range(n)}
    assert jobs() - before < 60


def test_components_by_rounds(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    want = graphs.components(df).collect()
    monkeypatch.setattr(graphs, "FEW", 0)
    rounds = graphs.components(df).collect()
    assert sorted(want) == sorted(rounds) and {r.component for r in want if r.node >= 500} == {500}
    assert graphs.components(df.limit(0)).count() == 0


def test_tables_of_rounds_are_removed(spark):
    import os

    df = storage.stored(spark.range(3).toDF("x"), "gone")
    path = df.stored_path.removeprefix("file://")
    assert os.path.isdir(path) and df.count() == 3
    storage.discard(df)
    storage.discard(df)
    assert not os.path.isdir(path)


# --- tags and primers

def rc(s):
    return s[::-1].translate(str.maketrans(IUPAC, COMPLEMENT))


def test_floating_tags_of_a_large_sheet(spark):
    rng = random.Random(7)
    tags = list({(sequence(rng, 6), sequence(rng, 7)) for _ in range(1000)}) + [("ACGTAC", None), ("", "ACG"), (None, "ACG")]
    sheet = [(i, f"s{i}", a, b) for i, (a, b) in enumerate(tags)]
    texts = [(i, sequence(rng, rng.randrange(5, 60)) + t[0] + sequence(rng, 20) + rc(t[1]) + sequence(rng, 5)) for i, t in enumerate(rng.sample(tags[:1000], 60))]
    texts += [(900, None), (901, ""), (902, tags[0][0] + rc(tags[0][1]))]
    got = reads.demux_floating(spark.createDataFrame(texts, "read_id long, raw string"), spark.createDataFrame(sheet, "sample_id int, name string, tagfwd string, tagrev string"))
    assert got.columns == ["read_id", "raw", "sample_id", "name", "tagfwd", "tagrev", "place", "inner"]
    want = set()
    for i, text in texts:
        for k, name, a, b in sheet:
            at = text.find(a) if text and a and b else -1
            end = text.find(rc(b), at + len(a)) if at >= 0 else -1
            if end >= 0:
                want.add((i, text, k, name, a, b, at + 1, text[at + len(a) : end]))
    assert len(want) >= 60 and {tuple(r) for r in got.collect()} == want
    assert reads.demux_floating(got.select("read_id", "raw"), spark.createDataFrame([], "sample_id int, tagfwd string, tagrev string")).count() == 0


@pytest.mark.parametrize("anchored", [True, False])
def test_primers_against_brute_force(spark, anchored):
    rng, fwd, rev = random.Random(8), "GGRTTYAC", "CCWGATN"
    back = rc(rev)
    wrong = lambda text, primer: sum(b not in BASES[c] for b, c in zip(text, primer))
    rows = [(0, None), (1, ""), (2, "ACG"), (3, "GGATTCAC" + "CATCTGG"), (4, "GGATTCAC" + "ü" + "CATCTGG")]
    for i in range(5, 400):
        f, b = list("GGATTCAC"), list("CATCTGG")
        for x in (f, b):
            if rng.random() < 0.6:
                x[rng.randrange(len(x))] = rng.choice("ACGTN")
        rows.append((i, sequence(rng, rng.choice([0, 0, 4])) + "".join(f) + sequence(rng, rng.randrange(30)) + "".join(b) + sequence(rng, rng.choice([0, 0, 3]))))
    want = {}
    for i, s in rows:
        if s is None:
            continue
        heads = [k for k in range(len(s) - len(fwd) + 1) if wrong(s[k : k + len(fwd)], fwd) <= 1]
        if anchored:
            if len(s) >= len(fwd) + len(rev) and 0 in heads and wrong(s[len(s) - len(rev) :], back) <= 0:
                want[i] = s[len(fwd) : len(s) - len(rev)]
        elif heads:
            tails = [k for k in range(heads[0] + len(fwd), len(s) - len(rev) + 1) if wrong(s[k : k + len(rev)], back) <= 0]
            if tails:
                want[i] = s[heads[0] + len(fwd) : tails[0]]
    df = spark.createDataFrame(rows, "read_id long, inner string").withColumn("other", F.lit(1))
    got = reads.primer_trim(df, fwd, rev, 0.125, anchored=anchored)
    assert got.columns == ["read_id", "inner", "other", "sequence"]
    assert {r.read_id: r.sequence for r in got.collect()} == want and len(want) > 30
