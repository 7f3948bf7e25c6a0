"""Queries on tables, pooling, tuning and known occurrences."""

from __future__ import annotations

from pyspark.sql import functions as F

from varicube.operators import pairs, tables, tuning
from varicube.plans.denoising import BORDER, CHIMERA, EDIT, RATIO, nijk, variant
from varicube.plans.fixtures import ctes, view
from varicube.plans.registry import query

SAMPLES = list(range(1, 9))
RUN_SAMPLES = [(r, x) for r in (1, 2) for x in SAMPLES]  # the pairs that the sheet has


def borderline(s, d):
    return pairs.borderline_any(pairs.chimera_borderline(nijk(s, d), variant(s, d), 16))


ASV = CHIMERA + BORDER + """, anyb as (select variant_id, bool_or(filter_delete) as chimera_borderline from borderline group by variant_id),
 side as (select n.run_id, n.marker_id, n.variant_id, cast(sum(n.read_count) as bigint) as read_count, length(v.sequence) as sequence_length, coalesce(b.chimera_borderline, false) as chimera_borderline, v.sequence
   from nijk n join variant v on n.variant_id = v.variant_id left join anyb b on b.variant_id = n.variant_id group by n.run_id, n.marker_id, n.variant_id, v.sequence, b.chimera_borderline)"""


def pivot_sql(alias: str = "sample") -> str:
    return ", ".join(f"cast(sum(case when sample_id = {x} then read_count else 0 end) as bigint) as {alias}{x}" for x in SAMPLES)


@query("asv_variants", ASV + "select * from side")
def _(s, d):
    return tables.variant_side(nijk(s, d), variant(s, d), borderline(s, d))


@query("asv_pivot", ctes("nijk") + f"select run_id, marker_id, variant_id, {pivot_sql()} from nijk group by run_id, marker_id, variant_id")
def _(s, d):
    return tables.sample_pivot(nijk(s, d), SAMPLES)


@query("asv_table", ASV + f", piv as (select run_id, marker_id, variant_id, {pivot_sql()} from nijk group by run_id, marker_id, variant_id) select side.*, {', '.join(f'sample{x}' for x in SAMPLES)} from side join piv using (run_id, marker_id, variant_id)")
def _(s, d):
    return tables.asv_table(nijk(s, d), variant(s, d), borderline(s, d), SAMPLES)


@query("asv_keep_labels", ctes("known_occurrences") + "select run_id, marker_id, variant_id, " + ", ".join(f"max(case when sample_id = {x} then 1 else 0 end) as keep_sample{x}" for x in SAMPLES) + " from known_occurrences where mock = 1 and action = 'keep' group by run_id, marker_id, variant_id")
def _(s, d):
    return tables.keep_labels(view(s, d, "known_occurrences"), SAMPLES)


@query("asv_unpivot", ctes("nijk") + ", s as (select unnest(range(1, 9)) as sample_id), k as (select distinct run_id, marker_id, variant_id from nijk) select k.run_id, k.marker_id, k.variant_id, cast(s.sample_id as int) as sample_id, cast(coalesce(sum(read_count), 0) as bigint) as read_count from k cross join s left join nijk n on n.run_id = k.run_id and n.marker_id = k.marker_id and n.variant_id = k.variant_id and n.sample_id = s.sample_id group by all")
def _(s, d):
    return tables.unpivot_samples(tables.sample_pivot(nijk(s, d), SAMPLES))


def sizes(s, d):
    return nijk(s, d).groupBy("variant_id").agg(F.sum("read_count").alias("size"))


# Greedy clusters one variant after the other: the list of centroids so far goes along, and a variant joins it unless it is close to one of them.
CLUSTERS = """, size as (select variant_id, cast(sum(read_count) as bigint) as size from nijk group by variant_id),
 near as (select s.variant_id, row_number() over (order by size desc, s.variant_id) as rank, (select coalesce(list(b), []) from close where a = s.variant_id) as near from size s),
 walk as (select cast(0 as bigint) as k, []::bigint[] as centroids union all
  select k + 1, case when list_has_any(near, centroids) then centroids else list_append(centroids, variant_id) end from walk join near on rank = k + 1),
 greedy as (select variant_id, coalesce(list_filter(c.centroids, lambda x: list_contains(near.near, x) or x = near.variant_id)[1], near.variant_id) as clusterid
  from near, (select centroids from walk order by k desc limit 1) c)"""
RECURSIVE = ctes("nijk", "variant").replace("with ", "with recursive ", 1)
CLOSE = RECURSIVE + """, close as (select a.variant_id as a, b.variant_id as b from variant a join variant b on a.variant_id <> b.variant_id
  and levenshtein(a.sequence, b.sequence) <= floor((1 - cast(0.97 as double)) * greatest(length(a.sequence), length(b.sequence))))""" + CLUSTERS
# the text of one from some place on agrees with the other to the end of either, over 32 bases or the whole of the other
OVERLAP = RECURSIVE + """, one as (select a.variant_id as a, b.variant_id as b from variant a join variant b on a.variant_id <> b.variant_id
  where len(list_filter(range(1, length(a.sequence) - least(32, length(b.sequence)) + 2), lambda i: substr(a.sequence, i, length(b.sequence)) = substr(b.sequence, 1, length(a.sequence) - i + 1))) > 0),
 close as (select a, b from one union select b, a from one)""" + CLUSTERS


@query("cluster_variants", CLOSE + " select * from greedy")
def _(s, d):
    return pairs.greedy_clusters(sizes(s, d), pairs.close_pairs(variant(s, d), 0.97))


@query("cluster_size", CLOSE + " select variant_id, clusterid, count(*) over (partition by clusterid) as clustersize from greedy")
def _(s, d):
    return pairs.cluster_sizes(pairs.greedy_clusters(sizes(s, d), pairs.close_pairs(variant(s, d), 0.97)))


def pool(s, d):
    return pairs.greedy_clusters(sizes(s, d), pairs.overlapping_pairs(variant(s, d), 32))


@query("pool_clusters", OVERLAP + " select * from greedy")
def _(s, d):
    return pool(s, d)


# for the oracles of pooled tables: clusters of a variant and its parent, by number
PARENTS = ", cl as (select variant_id, variant_id - variant_id % 5 as clusterid from variant)"


def parents(s, d):
    return variant(s, d).select("variant_id", (F.col("variant_id") - F.col("variant_id") % 5).alias("clusterid"))


@query("pooled_lists", ctes("nijk", "variant") + PARENTS + """, o as (select distinct run_id, marker_id, n.variant_id, clusterid, sequence from nijk n join cl on n.variant_id = cl.variant_id join variant v on v.variant_id = n.variant_id)
 select clusterid, array_to_string(list_sort(list(distinct variant_id)), ',') as pooled_variants, array_to_string(list_sort(list(distinct run_id)), ',') as runs, array_to_string(list_sort(list(distinct marker_id)), ',') as markers, array_to_string(list_sort(list(distinct sequence)), ',') as pooled_sequences from o group by clusterid""")
def _(s, d):
    return tables.pooled(nijk(s, d), variant(s, d), parents(s, d))


def cells(value: str) -> str:
    return ", ".join(f"{value.format(c=f'run_id = {r} and sample_id = {x}')} as run{r}_sample{x}" for r, x in RUN_SAMPLES)


@query("pooled_presence", ctes("nijk", "variant") + PARENTS + "select clusterid, " + cells("max(case when {c} and read_count > 0 then 1 else 0 end)") + " from nijk join cl on nijk.variant_id = cl.variant_id group by clusterid")
def _(s, d):
    return tables.pooled_cells(nijk(s, d), parents(s, d), RUN_SAMPLES)


@query("pooled_reads", ctes("nijk", "variant") + PARENTS + "select clusterid, " + cells("cast(sum(case when {c} then read_count else 0 end) as bigint)") + " from nijk join cl on nijk.variant_id = cl.variant_id group by clusterid")
def _(s, d):
    return tables.pooled_cells(nijk(s, d), parents(s, d), RUN_SAMPLES, presence=False)


FEW = [(r, x) for r, x in RUN_SAMPLES if x <= 2 * r]


@query("pooled_run_columns", ctes("nijk", "variant") + PARENTS + "select clusterid, " + ", ".join(f"cast(sum(case when run_id = {r} and sample_id = {x} then read_count else 0 end) as bigint) as run{r}_sample{x}" for r, x in FEW) + " from nijk join cl on nijk.variant_id = cl.variant_id group by clusterid")
def _(s, d):
    return tables.pooled_cells(nijk(s, d), parents(s, d), FEW, presence=False)


@query("runmarker_samples", ctes("reads") + "select distinct run_id, sample_id from reads where (run_id, marker_id) in ((1, 1), (2, 2))")
def _(s, d):
    chosen = view(s, d, "nijk").select("run_id", "marker_id").distinct().where("run_id = marker_id")
    return tables.chosen_samples(view(s, d, "reads"), chosen)


@query("name_lookup", ctes("nijk", "sample_types") + "select run_id, marker_id, n.sample_id, replicate, variant_id, read_count, sample_type, habitat from nijk n join sample_types t on n.sample_id = t.sample_id")
def _(s, d):
    return tables.looked_up(nijk(s, d), view(s, d, "sample_types"), "sample_id")


# --- tuning

KNOWN = ctes("nijk", "known_occurrences") + """, r as (select *, cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, variant_id) as ratio_i,
 cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, variant_id, replicate) as ratio_ik,
 cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, sample_id, replicate) as ratio_jk,
 cast(sum(read_count) over (partition by run_id, marker_id, variant_id) as bigint) as n_i, cast(sum(read_count) over (partition by run_id, marker_id, variant_id, replicate) as bigint) as n_ik,
 cast(sum(read_count) over (partition by run_id, marker_id, sample_id, replicate) as bigint) as n_jk from nijk),
 acts as (select distinct run_id, marker_id, variant_id, sample_id, action from known_occurrences)"""
OCC = "run_id, marker_id, variant_id, sample_id"


def known(s, d):
    return view(s, d, "known_occurrences")


@query("known_split", ctes("known_occurrences") + f"select distinct {OCC}, action from known_occurrences")
def _(s, d):
    k = known(s, d)
    return tuning.known_split(k, "keep").withColumn("action", F.lit("keep")).unionByName(tuning.known_split(k, "delete").withColumn("action", F.lit("delete")))


@query("optimize_sample_replicate", KNOWN + f"select run_id, marker_id, sample_id, replicate, variant_id, read_count as n_ijk, n_jk, ratio_jk as ratio, floor(ratio_jk * 10000) / 10000 as round_down from r semi join acts using ({OCC}) where sample_id = 1")
def _(s, d):
    return tuning.sample_replicate_report(nijk(s, d), known(s, d))


@query("optimize_pcr_error", ctes("nijk", "variant", "known_occurrences") + EDIT + RATIO + """, keep as (select distinct run_id, marker_id, sample_id, variant_id from known_occurrences where mock = 1 and action = 'keep')
 select ratios.* from ratios join keep k on ratios.run_id = k.run_id and ratios.marker_id = k.marker_id and ratios.sample_id = k.sample_id and ratios.variant_expected = k.variant_id
 where not exists (select 1 from keep u where ratios.run_id = u.run_id and ratios.marker_id = u.marker_id and ratios.sample_id = u.sample_id and ratios.variant_unexpected = u.variant_id)""")
def _(s, d):
    return tuning.pcr_error_report(nijk(s, d), variant(s, d), known(s, d))


LEFT = f", surv as (select {OCC} from r where ratio_i > 0.005 and read_count >= 20 and ratio_jk > 0.0005 group by {OCC} having count(*) >= 2)"


@query("lfn_survivors", KNOWN + LEFT + "select * from surv")
def _(s, d):
    return tuning.survivors_of(nijk(s, d), 0.005, 20, 0.0005, 2)


@query("survivor_counts", KNOWN + LEFT + f"select run_id, marker_id, cast(sum((action = 'keep')::int) as bigint) as n_keep, cast(sum((action = 'delete')::int) as bigint) as n_delete from surv join acts using ({OCC}) group by run_id, marker_id")
def _(s, d):
    return tuning.survivor_counts(tuning.survivors_of(nijk(s, d), 0.005, 20, 0.0005, 2), known(s, d))


RATIOS = [round(0.001 + i * 0.005, 3) for i in range(10)]
GRID = f", grid as (select cast(c.c as int) as read_count_cutoff, cast(x as double) as ratio_cutoff from (select unnest(range(10, 101, 10)) as c) c cross join (select unnest({RATIOS}) as x) x)"


@query("cutoff_grid", ctes("nijk") + GRID + """, t as (select read_count, cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, variant_id) as ratio_i from nijk)
 select read_count_cutoff, ratio_cutoff, count(t.read_count) as n_rows from grid left join t on read_count >= read_count_cutoff and ratio_i > ratio_cutoff group by read_count_cutoff, ratio_cutoff""")
def _(s, d):
    return tuning.grid_rows(nijk(s, d))


def grid_sql(ratio: str) -> str:
    return KNOWN + GRID + f""", l as (select {OCC}, action, read_count_cutoff, ratio_cutoff from r join acts using ({OCC}) join grid on {ratio} > ratio_cutoff and read_count >= read_count_cutoff where ratio_jk > 0.0005 group by all having count(*) >= 2),
 t as (select run_id, marker_id, read_count_cutoff, ratio_cutoff, cast(sum((action = 'keep')::int) as bigint) as n_keep, cast(sum((action = 'delete')::int) as bigint) as n_delete from l group by all)
,
 e as (select run_id, marker_id, count(distinct variant_id) as n_expected from known_occurrences where action = 'keep' group by all)
 select t.* from t join e using (run_id, marker_id) where n_keep >= n_expected"""


@query("optimize_grid_variant", grid_sql("ratio_i"))
def _(s, d):
    return tuning.optimize_grid(nijk(s, d), known(s, d), 0.0005, 2)


@query("optimize_grid_variant_replicate", grid_sql("ratio_ik"))
def _(s, d):
    return tuning.optimize_grid(nijk(s, d), known(s, d), 0.0005, 2, by_replicate=True)


def specific_sql(ratio: str, total: str, keys: str) -> str:
    return KNOWN + f", x as (select r.*, row_number() over (partition by {keys} order by {ratio} desc, read_count desc) as rn from r semi join (select * from acts where action = 'delete') using ({OCC})) select {keys}, read_count as read_count_max, {total}, {ratio} as cutoff from x where rn = 1"


@query("optimize_specific_variant", specific_sql("ratio_i", "n_i", "run_id, marker_id, variant_id"))
def _(s, d):
    return tuning.specific_cutoffs(nijk(s, d), known(s, d))


@query("optimize_specific_variant_replicate", specific_sql("ratio_ik", "n_ik", "run_id, marker_id, variant_id, replicate"))
def _(s, d):
    return tuning.specific_cutoffs(nijk(s, d), known(s, d), by_replicate=True)


# --- known occurrences from the table: variants of the mock list by sequence, some of them to tolerate, some in no table

MOCK = """, tab as (select n.run_id, n.marker_id, n.variant_id, sample_id, cast(sum(read_count) as bigint) as read_count, sequence from nijk n join variant v on n.variant_id = v.variant_id where n.variant_id % 25 <> 0 group by all),
 mock as (select distinct k.run_id, k.marker_id, k.sample_id, sequence, case when k.variant_id % 15 = 0 then 'tolerate' when k.variant_id % 10 = 0 then null else 'keep' end as action from known_occurrences k join variant v on k.variant_id = v.variant_id where mock = 1),
 keeps as (select m.run_id, m.marker_id, m.sample_id, m.sequence, coalesce(t.variant_id, 0) as variant_id, 'keep' as action from mock m left join (select distinct run_id, marker_id, sequence, variant_id from tab) t using (run_id, marker_id, sequence) where coalesce(action, 'keep') <> 'tolerate'),
 neg as (select run_id, marker_id, sample_id, variant_id, 'delete' as action from tab where read_count > 0 and sample_id in (select sample_id from sample_types where sample_type = 'negative')),
 unexp as (select t.run_id, t.marker_id, t.sample_id, t.variant_id, 'delete' as action from tab t where read_count > 0 and sample_id in (select sample_id from sample_types where sample_type = 'mock')
   and not exists (select 1 from mock m where m.run_id = t.run_id and m.sample_id = t.sample_id and m.sequence = t.sequence)),
 placed as (select t.*, sample_type, habitat from tab t join sample_types using (sample_id) where habitat is not null),
 share as (select run_id, marker_id, variant_id, habitat, cast(sum(read_count) as double) / sum(sum(read_count)) over (partition by run_id, marker_id, variant_id) as share from placed group by run_id, marker_id, variant_id, habitat),
 hab as (select p.run_id, p.marker_id, p.sample_id, p.variant_id, 'delete' as action from placed p join share using (run_id, marker_id, variant_id, habitat) where share < 0.5 and sample_type = 'real' and read_count > 0)"""
MOCKS = ctes("nijk", "variant", "known_occurrences", "sample_types") + MOCK


def long_table(s, d):
    n = nijk(s, d).where("variant_id % 25 <> 0").groupBy("run_id", "marker_id", "variant_id", "sample_id").agg(F.sum("read_count").alias("read_count"))
    return n.join(variant(s, d), "variant_id")


def mock_list(s, d):
    action = F.when(F.col("variant_id") % 15 == 0, "tolerate").when(F.col("variant_id") % 10 == 0, F.lit(None)).otherwise("keep")
    return known(s, d).where("mock = 1").join(variant(s, d), "variant_id").select("run_id", "marker_id", "sample_id", "sequence", action.alias("action")).distinct()


def types(s, d):
    return view(s, d, "sample_types")


@query("known_keep", MOCKS + "select * from keeps")
def _(s, d):
    return tuning.known_keep(mock_list(s, d), long_table(s, d))


@query("missing_occurrences", MOCKS + "select run_id, marker_id, sample_id, sequence from keeps anti join (select * from tab where read_count > 0) t using (run_id, marker_id, sample_id, sequence)")
def _(s, d):
    t = long_table(s, d)
    return tuning.missing_occurrences(tuning.known_keep(mock_list(s, d), t), t)


@query("delete_negative", MOCKS + "select * from neg")
def _(s, d):
    return tuning.delete_negative(long_table(s, d), types(s, d))


@query("delete_mock", MOCKS + "select * from unexp")
def _(s, d):
    return tuning.delete_mock(long_table(s, d), types(s, d), mock_list(s, d))


@query("delete_habitat", MOCKS + "select * from hab")
def _(s, d):
    return tuning.delete_habitat(long_table(s, d), types(s, d))


@query("known_occurrences", MOCKS + "select run_id, marker_id, sample_id, variant_id, action from keeps union select * from neg union select * from unexp union select * from hab")
def _(s, d):
    return tuning.known_occurrences(long_table(s, d), types(s, d), mock_list(s, d))
