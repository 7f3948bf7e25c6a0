"""op3 and op7 as registered against plain versions over all documents in memory."""

import math
import os

import numpy as np
import pytest

from varicube.llm import mixing, quality, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def posteriors_by_document(cast, rounds=100):
    """EM document by document: the probability that each is bad, from lists of votes."""
    n, k = len(cast), len(cast[0])
    outcomes = (quality.BAD, quality.GOOD, quality.ABSTAIN)
    held = {True: (0.5, 0.02, 0.48), False: (0.02, 0.5, 0.48)}
    bad = [0.9 if quality.BAD in v else 0.03 for v in cast]
    for _ in range(rounds):
        share = {}
        for kind in (True, False):
            weight = [b if kind else 1 - b for b in bad]
            for j in range(k):
                sums = [sum(w for w, v in zip(weight, cast) if v[j] == o) + n / 50 * h + 0.5 for o, h in zip(outcomes, held[kind])]
                share[kind, j] = [s / sum(sums) for s in sums]
        prior = (sum(bad) + 1) / (n + 2)
        for i, v in enumerate(cast):
            odds = math.log(1 - prior) - math.log(prior)
            for j in range(k):
                o = outcomes.index(v[j])
                odds += math.log(share[False, j][o]) - math.log(share[True, j][o])
            bad[i] = 1 / (1 + math.exp(min(50, max(-50, odds))))
    return np.array(bad)


def test_quality_against_documents_one_by_one(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text or "" for r in rows]
    m = np.array([quality.measures(t) for t in texts])
    bad = posteriors_by_document([tuple(v) for v in quality.votes(m).tolist()])
    x = np.stack([quality.features(t, quality.buckets(r)) for t, r in zip(texts, m.tolist())])
    good = quality.posteriors(x, quality.fit_softmax(x, np.stack([bad, 1 - bad], 1)))[:, 1]
    want = {r.doc_id: 1.0 if t == "" else g for r, t, g in zip(rows, texts, good)}
    got = {r.doc_id: (r.quality, r.keep) for r in queries.op3_quality(spark, SF).collect()}
    assert got.keys() == want.keys()
    for i, (score, keep) in got.items():
        assert score == pytest.approx(want[i], abs=1e-3) and keep == (score >= 0.5)


def test_rates_against_totals_in_memory(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    domains, texts = list(mixing.TARGETS), [r.text or "" for r in rows]
    x = np.stack([mixing.features(t) for t in texts])
    y = np.array([[float(r.lang == d) for d in domains] for r in rows])
    known = y.any(1)
    weight = y[known] / np.maximum(1, y[known].sum(0)) * (known.sum() / len(domains))
    p = mixing.posteriors(x, mixing.fit_softmax(x[known], weight / weight.sum(1, keepdims=True)))
    got = {r.doc_id: r for r in queries.op7_mixing(spark, SF).collect()}
    rates = np.array([got[r.doc_id].rate for r in rows])
    tokens = np.array([len(t.split()) for t in texts])
    assert (rates >= 0).all() and [got[r.doc_id].tokens for r in rows] == tokens.tolist()
    for r, own in zip(rows, p):
        assert got[r.doc_id].posterior == pytest.approx(own.max(), abs=1e-3)
        assert own.max() - own[domains.index(got[r.doc_id].domain)] < 1e-3
        assert abs(got[r.doc_id].copies - got[r.doc_id].rate) < 1
    # the expected tokens of each domain, from posteriors of our own, have the target shares
    totals = (tokens[:, None] * p * rates[:, None]).sum(0)
    assert totals / totals.sum() == pytest.approx([mixing.TARGETS[d] for d in domains], rel=2e-3)
    assert totals.sum() >= tokens.sum()
