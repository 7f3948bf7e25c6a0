"""Local alignments and similarity search against a plain Smith-Waterman search."""

import random

import numpy as np
import pytest

from varicube.operators import alignment
from varicube.operators.alignment import EXTEND, MATCH, MISMATCH, OPEN


def best_local(q, t):
    """(score, matches, -columns, queried) of the best local alignment, cell by cell."""
    add = lambda x, y: tuple(a + b for a, b in zip(x, y))
    none, zero = (-(10**9), 0, 0, 0), (0, 0, 0, 0)
    h, down = [zero] * (len(t) + 1), [none] * (len(t) + 1)
    best = zero
    for a in q:
        new, along, diagonal = [zero], none, h[0]
        for j, b in enumerate(t, 1):
            down[j] = max(add(h[j], (OPEN + EXTEND, 0, -1, 1)), add(down[j], (EXTEND, 0, -1, 1)))
            along = max(add(new[j - 1], (OPEN + EXTEND, 0, -1, 0)), add(along, (EXTEND, 0, -1, 0)))
            new.append(max(zero, down[j], along, add(diagonal, (MATCH, 1, -1, 1) if a == b else (MISMATCH, 0, -1, 1))))
            diagonal = h[j]
            best = max(best, new[j])
        h = new
    return best


def sequence(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def mutated(rng, text, rate, gaps=0.0):
    out = []
    for b in text:
        x = rng.random()
        if x < gaps / 2:
            continue
        if x < gaps:
            out.append(rng.choice("ACGT"))
        out.append(rng.choice([c for c in "ACGT" if c != b]) if rng.random() < rate else b)
    return "".join(out)


def test_batches_of_alignments_against_single_cells():
    rng = random.Random(1)
    queries, targets = [], []
    for _ in range(120):
        q = sequence(rng, rng.randrange(1, 60))
        t = rng.choice([mutated(rng, q, 0.2, 0.1), sequence(rng, rng.randrange(1, 80)), sequence(rng, 20) + mutated(rng, q, 0.1, 0.05) + sequence(rng, 15), q[10:] + q[:10]])
        queries.append(q)
        targets.append(t or "A")
    low, high = np.array([-len(q) for q in queries]), np.array([len(t) for t in targets])
    got = zip(*alignment.unpacked(alignment.local_matches(queries, targets, low, high)))
    for (score, matches, columns, queried), q, t in zip(got, queries, targets):
        assert (score, matches, -columns, queried) == best_local(q, t), (q, t)
    assert alignment.packed(7, 5, 9, 8) < alignment.packed(7, 5, 8, 8) < alignment.packed(7, 6, 20, 9) < alignment.packed(8, 0, 30, 1)


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(2)
    queries = {i: sequence(rng, rng.randrange(80, 120)) for i in range(6)}
    targets = {}
    for i, q in queries.items():
        targets[100 + i] = mutated(rng, q, 0.12, 0.03)
        targets[200 + i] = sequence(rng, 300) + mutated(rng, q, 0.05) + sequence(rng, 200)  # inside a long reference
        targets[300 + i] = q[: len(q) // 2] + sequence(rng, 70)  # half of it only
        targets[400 + i] = sequence(rng, 100)
        targets[500 + i] = mutated(rng, q, 0.5)
    a = spark.createDataFrame([*queries.items(), (90, None), (91, ""), (92, "acgt")], "variant_id long, sequence string")
    b = spark.createDataFrame([*[(k, v.lower()) for k, v in targets.items()], (900, None), (901, "")], "target_id long, sequence string")
    return queries, targets, a, b


def test_similar_targets_against_all_pairs(found):
    queries, targets, a, b = found
    got = {(r.variant_id, r.target_id): (r.identity, r.coverage) for r in alignment.similar_targets(a, b).collect()}
    want = {}
    for i, q in queries.items():
        for j, t in targets.items():
            _, matches, columns, queried = best_local(q, t)
            if columns and matches * 100 / -columns >= 70 and queried * 100 / len(q) >= 80:
                want[i, j] = (matches * 100 / -columns, queried * 100 / len(q))
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    assert all((i, 200 + i) in got and (i, 300 + i) not in got for i in queries)


def test_recall_at_the_thresholds(spark):
    rng = random.Random(3)
    queries, targets = [], []
    for i in range(120):
        q = sequence(rng, rng.randrange(160, 200))
        cut = rng.randrange(0, len(q) // 6)
        queries.append((i, q))
        targets.append((i, mutated(rng, q[cut:], rng.uniform(0.05, 0.29), 0.01)))
    got = alignment.similar_targets(spark.createDataFrame(queries, "variant_id long, sequence string"), spark.createDataFrame(targets, "target_id long, sequence string"))
    pairs = {(r.variant_id, r.target_id) for r in got.collect()}
    good = 0
    for (i, q), (_, t) in zip(queries, targets):
        _, matches, columns, queried = best_local(q, t)
        if columns and matches * 100 / -columns >= 70 and queried * 100 / len(q) >= 80:
            good += 1
            pairs.discard((i, i)) if (i, i) in pairs else pairs.add(("missed", i))
    missed = sum(p[0] == "missed" for p in pairs)
    assert good > 60 and missed <= 0.05 * good


def test_common_seeds_bring_nothing_together(spark):
    rng = random.Random(4)
    common = sequence(rng, 100)
    rows = [(i, common + sequence(rng, 110)) for i in range(400)]
    rows += [(i + 1000, s[:100] + mutated(rng, s[100:], 0.1)) for i, s in rows[:20]]
    a = spark.createDataFrame(rows, "variant_id long, sequence string")
    b = a.withColumnRenamed("variant_id", "target_id")
    hits = alignment.seed_hits(a, b, 20, 0.5).select("variant_id", "target_id").distinct()
    assert hits.count() < 0.2 * len(rows) ** 2  # what random words share
    got = {(r.variant_id, r.target_id) for r in alignment.similar_targets(a, b, crowd=20).collect()}
    assert got >= {(i, i) for i, _ in rows} | {(i, i + 1000) for i in range(20)} | {(i + 1000, i) for i in range(20)}
