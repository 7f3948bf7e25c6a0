"""Queries whose work must grow with the tables and no faster."""

import pytest
from pyspark.sql import functions as F

from varicube.plans import fixtures


@pytest.fixture
def stars(spark, tmp_path):
    """A folder of small tables: suppliers of several slices of keys, with gaps, and parts."""
    keys = [0, 3, 999, 1000, 1001, 2500, 7000, 7001, 123456]
    spark.createDataFrame([(k, f"s{k}", k % 3) for k in keys], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("p"), "id").alias("p_name")).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, f"n{k}", k % 2) for k in range(3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(k, f"r{k}") for k in range(2)], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_meet_suppliers_by_an_equi_join(spark, rows, stars):
    got = fixtures.view(spark, stars, "taxonomy")
    want = spark.sql(fixtures.TABLES.sub(lambda m: f"parquet.`{stars}/{m[1]}.parquet`", fixtures.VIEWS["taxonomy"]))
    assert rows(got) == rows(want) and got.count() == 1 + 2 + 3 + 9 + 40
    assert got.schema.simpleString() == want.schema.simpleString()
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_no_suppliers_no_parts(spark, rows, stars):
    spark.createDataFrame([], "s_suppkey long, s_name string, s_nationkey int").write.mode("overwrite").parquet(f"{stars}/supplier.parquet")
    assert fixtures.view(spark, stars, "taxonomy").count() == 1 + 2 + 3



def made_of_rows(spark, tmp_path):
    """Sequences by an aggregate of a table, as the variants of a run are of its reads."""
    spark.range(100).selectExpr("id % 4 as variant_id").write.parquet(f"{tmp_path}/rows")
    return spark.read.parquet(f"{tmp_path}/rows").distinct().withColumn("sequence", F.concat(F.repeat(F.lit("ACGT"), 10), F.repeat(F.lit("G"), F.col("variant_id").cast("int"))))


def test_variants_are_made_once(spark, tmp_path):
    from varicube.operators import alignment, pairs

    variants = made_of_rows(spark, tmp_path)
    for df in (pairs.overlapping_pairs(variants, 32), alignment.similar_targets(variants, variants.withColumnRenamed("variant_id", "target_id"))):
        assert f"{tmp_path}/rows" not in plan(df) and df.count() > 0


def test_a_sheet_of_tags_goes_to_the_reads(spark, tmp_path, rows):
    from varicube.operators import reads

    spark.createDataFrame([(1, "AACC", "GGTT"), (2, "TTCC", "GGAA")] * 5, "sample_id int, tagfwd string, tagrev string").write.parquet(f"{tmp_path}/sheet")
    spark.createDataFrame([(1, "AACCxACGTAACC"), (2, "TTCCACGTTTCC"), (3, "CCCC"), (4, None)], "read_id long, raw string").write.parquet(f"{tmp_path}/reads")
    raw, tags = spark.read.parquet(f"{tmp_path}/reads"), spark.read.parquet(f"{tmp_path}/sheet").distinct()
    found = reads.demux_anchored(reads.both_strands(raw), tags)
    assert rows(found.where("strand = '+'").select("read_id", "sample_id", "inner")) == [(1, 1, "xACGT"), (2, 2, "ACGT")]
    assert "SortMergeJoin" not in plan(found) and plan(found).count(f"{tmp_path}/reads") == 1
    both = reads.both_strands(raw)
    assert both.columns == ["read_id", "raw", "strand"] and rows(both) == sorted([(1, "AACCxACGTAACC", "+"), (1, "GGTTACGTxGGTT", "-"), (2, "TTCCACGTTTCC", "+"), (2, "GGAAACGTGGAA", "-"), (3, "CCCC", "+"), (3, "GGGG", "-"), (4, None, "+"), (4, None, "-")], key=repr)


def test_raw_reads_do_not_crowd(spark):
    assert "SortMergeJoin" not in plan(fixtures.view(spark, "/root/testdata/sf0.001", "raw_reads"))


def test_ngrams_of_a_block_come_back_sorted_and_counted():
    import numpy as np

    from varicube.llm import lm

    texts = ["a b a b c", "", "b a b"]
    table, n = lm.counted([lm.gram_hashes(t.encode(), 2, lm.WordHashes()) for t in texts], 2)
    rows_ = lm.packed(table, n).sample(frac=1, random_state=1)
    grams, totals = lm.unpacked(rows_, "ns")
    assert grams.tolist() == sorted(table.tolist()) and dict(zip(grams.tolist(), totals.tolist())) == dict(zip(table.tolist(), n.tolist()))
    ones = [lm.gram_hashes(t.encode(), 1, lm.WordHashes())[0] for t in texts]
    assert lm.spread_counts(ones, np.empty(0, np.int64), np.empty(0, np.int64)).tolist() == [3, 4, 3, 4, 1, 4, 3, 4]
    assert lm.spread_counts(ones, grams, totals).tolist() == [6, 8, 6, 8, 2, 8, 6, 8]
    assert [len(x) for x in lm.unpacked(rows_.iloc[:0], "ns")] == [0, 0]


def test_a_pair_leaves_its_family_once(spark):
    """Texts that share a passage share many shingles; a pair of them has one row for all of these."""
    from varicube.llm import simhash

    members, shared, size = 45, 30, 200
    held = [(s, m, m % 40, size, s, s // 20) for m in range(members) for s in range(shared)]  # five pairs are of one component
    rows_ = spark.createDataFrame(held, "shingle long, node long, component long, n long, place long, family long")
    nodes = spark.createDataFrame([(m, [m % 2, 0, -1, 0]) for m in range(members)], "node long, parity array<long>")
    pairs = members * (members - 1) // 2 - 5
    got = [tuple(r) for r in simhash.pairs_by_family(rows_, nodes, 0.8, 16).collect()]
    assert pairs <= len(got) <= 2 * pairs  # two families, not thirty shingles
    assert sorted(map(tuple, simhash.apart_pairs(rows_, nodes, 0.8, 16).collect())) == [(a, b, shared) for a in range(members) for b in range(a + 1, members) if a % 40 != b % 40]
    spread = spark.createDataFrame([(m, [(1 << m) - 1, -1 if m % 2 else 0, 0, 0]) for m in range(members)], "node long, parity array<long>")  # 64 odd bits are over 44 of 400 members
    assert {(r.a + r.b) % 2 for r in simhash.apart_pairs(rows_, spread, 0.8, 16).collect()} == {0}


def test_unlike_sets_of_any_size_stay_in_their_task():
    """With bits by the number of members, the parities of unlike sets tell so however large the sets are."""
    import numpy as np

    from varicube.llm import simhash

    rng = np.random.default_rng(31)
    for n in (150, 400, 1_500):
        own = rng.integers(0, 1 << 64, n + n // 4, dtype=np.uint64)
        a, b, near = own[:n], own[n // 4 :], own[n // 20 :][:n]  # similarities of 0.6 and 0.9
        found = simhash.parities(a), simhash.parities(b), simhash.parities(near)
        differ = lambda x, y: int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())
        assert differ(found[0], found[2]) <= 2 * (n // 20) < 2 * n / 9 < differ(found[0], found[1])


def test_sketches_of_two_widths_meet_in_the_narrower():
    import numpy as np

    from varicube.llm import simhash

    rng = np.random.default_rng(32)
    own = rng.integers(0, 1 << 64, 2_000, dtype=np.uint64)
    sets = [own[:k] for k in (0, 60, 70, 250, 260, 1_000, 2_000)]
    sketches = [simhash.parities(x) for x in sets]
    assert len({len(x) for x in sketches}) == 4
    i, j = np.triu_indices(len(sets), 1)
    width = lambda x: 64 * len(simhash.parities(x))
    odd = lambda x, bits: np.bincount((x & np.uint64(bits - 1)).astype(int), minlength=bits) & 1
    want = [int((odd(sets[a], w := min(width(sets[a]), width(sets[b]))) ^ odd(sets[b], w)).sum()) for a, b in zip(i, j)]
    assert simhash.Parities(sketches).differ(i, j, 3).tolist() == want


def test_a_node_leaves_its_task_with_its_nearest_only(spark):
    """A group of texts of as many components has as many pairs as its square, of which the first pass lets out one a node and task."""
    from varicube.llm import simhash

    members, size = 120, 200
    held = [(s, m, m, size, s, 0) for m in range(members) for s in range(3)]
    rows_ = spark.createDataFrame(held, "shingle long, node long, component long, n long, place long, family long")
    nodes = spark.createDataFrame([(m, [(1 << (m % 40)) - 1, m // 40, 0, 0]) for m in range(members)], "node long, parity array<long>")
    opened = simhash.held_open(rows_, nodes)
    units = 4  # two blocks a node at most in each, of a group of 120 in blocks of 64
    near = simhash.pairs_in_families(opened, 0.8, 256, only_nearest=True).collect()
    assert members / 2 <= len(near) <= units * members < members * (members - 1) / 2 / 10
    bits = {r.node: r.parity for r in nodes.collect()}
    far = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(bits[a], bits[b]))
    least = {a: min(far(a, b) for b in range(members) if b != a) for a in range(members)}
    pairs = {(r.a, r.b) for r in simhash.nearest_pairs(opened, 0.8, 256).collect()}
    assert all(any(m in p and far(*p) == least[m] for p in pairs) for m in range(members)) and len(pairs) <= 2 * members
    joined = spark.createDataFrame([(m, 0) for m in range(members - 1)], "node long, component long")
    left = simhash.once_each(simhash.pairs_in_families(simhash.still_open(opened, joined), 0.8, 256)).collect()
    assert sorted(map(tuple, left)) == [(m, members - 1, 3) for m in range(members - 1)]
    assert simhash.still_open(opened, spark.createDataFrame([(m, 0) for m in range(members)], "node long, component long")).count() == 0


def test_texts_go_to_python_in_small_batches(spark):
    """However many rows a task has, few texts are on their way to Python at once; the session's own setting is back afterwards, also after an error."""
    import pandas as pd

    from varicube.llm.common import small_batches

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = spark.range(0, 1_000, 1, 1).mapInPandas(lambda batches: (pd.DataFrame({"n": [len(x)]}) for x in batches), "n long")
    with small_batches(spark):
        got = [r.n for r in sizes.collect()]
    assert sum(got) == 1_000 and max(got) <= 128 and spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError), small_batches(spark, 7):
        assert spark.conf.get(key) == "7"
        1 / 0
    assert spark.conf.get(key) == before
