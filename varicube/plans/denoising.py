"""Queries on counting and denoising (counts, filters, sequence pairs)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from varicube.operators import counts, filters, pairs
from varicube.plans.fixtures import ctes, view
from varicube.plans.registry import query

CUT = filters.LfnCutoffs(variant=0.005, sample_replicate=0.0005, read_count=20)
CUT_REPLICATE = filters.LfnCutoffs(variant=None, variant_replicate=0.01, sample_replicate=0.0005, read_count=20)
KEYS = "run_id, marker_id, sample_id, replicate, variant_id"


def nijk(s, d):
    return view(s, d, "nijk")


def variant(s, d):
    return view(s, d, "variant")


# --- counting

@query("dereplicate", ctes("reads") + "select run_id, marker_id, sample_id, replicate, sequence, count(*) as read_count from reads group by all")
def _(s, d):
    return counts.dereplicate(view(s, d, "reads"))


for _name, _keys in (("n_i", counts.N_I), ("n_ij", counts.N_IJ), ("n_ik", counts.N_IK), ("n_jk", counts.N_JK)):
    query(_name, ctes("nijk") + f"select {', '.join(_keys)}, cast(sum(read_count) as bigint) as {_name} from nijk group by {', '.join(_keys)}")(
        lambda s, d, k=_keys, n=_name: counts.totals(nijk(s, d), k, n)
    )


@query("global_read_count", ctes("nijk") + f"select {KEYS}, read_count from (select *, sum(read_count) over (partition by run_id, marker_id, variant_id) as n from nijk) x where n >= 2000")
def _(s, d):
    return counts.above_global_cutoff(nijk(s, d), 2000)


@query("replicate_average", ctes("nijk") + "select run_id, marker_id, variant_id, sample_id, cast(sum(read_count) as bigint) as read_count, count(*) as replicate_count, cast(sum(read_count) as double) / count(*) as read_count_average from nijk group by run_id, marker_id, variant_id, sample_id")
def _(s, d):
    return counts.replicate_average(nijk(s, d))


@query("variant_validity", ctes("variant") + "select variant_id, regexp_matches(upper(case when variant_id % 9 = 0 then sequence || 'N' else lower(sequence) end), '^[ACGT]+$') as is_valid from variant")
def _(s, d):
    v = variant(s, d)
    marked = v.withColumn("sequence", F.when(F.col("variant_id") % 9 == 0, F.concat("sequence", F.lit("N"))).otherwise(F.lower("sequence")))
    return counts.variant_validity(marked)


# --- low-frequency noise

TOTALS = """, t as (select *, cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, variant_id) as ri,
 cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, variant_id, replicate) as rik,
 cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, sample_id, replicate) as rjk from nijk)"""
LFN = ctes("nijk", "specific", "specific_replicate") + TOTALS + """, lfn as (
 select t.*, read_count = 0 or ri <= 0.005 as f2, case when c.cutoff is not null then read_count = 0 or ri <= c.cutoff end as f4, read_count = 0 or rjk <= 0.0005 as f6, read_count < 20 as f7
 from t left join specific c on t.run_id = c.run_id and t.marker_id = c.marker_id and t.variant_id = c.variant_id),
 state as (select *, f2 or coalesce(f4, false) or f6 or f7 as filter_delete from lfn)"""


@query("lfn_variant", ctes("nijk") + TOTALS + f"select {KEYS}, read_count, read_count = 0 or ri <= 0.005 as filter_delete from t")
def _(s, d):
    return filters.lfn_variant(nijk(s, d), 0.005)


@query("lfn_variant_replicate", ctes("nijk") + TOTALS + f"select {KEYS}, read_count, read_count = 0 or rik <= 0.01 as filter_delete from t")
def _(s, d):
    return filters.lfn_variant_replicate(nijk(s, d), 0.01)


@query("lfn_variant_specific", ctes("nijk", "specific") + TOTALS + "select t.run_id, t.marker_id, t.sample_id, t.replicate, t.variant_id, read_count, read_count = 0 or ri <= cutoff as filter_delete from t join specific c on t.run_id = c.run_id and t.marker_id = c.marker_id and t.variant_id = c.variant_id")
def _(s, d):
    return filters.lfn_specific(nijk(s, d), view(s, d, "specific"))


@query("lfn_variant_replicate_specific", ctes("nijk", "specific_replicate") + TOTALS + "select t.run_id, t.marker_id, t.sample_id, t.replicate, t.variant_id, read_count, read_count = 0 or rik <= cutoff as filter_delete from t join specific_replicate c on t.run_id = c.run_id and t.marker_id = c.marker_id and t.variant_id = c.variant_id and t.replicate = c.replicate")
def _(s, d):
    return filters.lfn_specific(nijk(s, d), view(s, d, "specific_replicate"), by_replicate=True)


@query("lfn_sample_replicate", ctes("nijk") + TOTALS + f"select {KEYS}, read_count, read_count = 0 or rjk <= 0.0005 as filter_delete from t")
def _(s, d):
    return filters.lfn_sample_replicate(nijk(s, d), 0.0005)


@query("lfn_read_count", ctes("nijk") + f"select {KEYS}, read_count, read_count < 20 as filter_delete from nijk")
def _(s, d):
    return filters.lfn_read_count(nijk(s, d), 20)


@query("lfn_all", LFN + f"select {KEYS}, read_count, filter_delete from state")
def _(s, d):
    return filters.lfn_all(nijk(s, d), CUT, view(s, d, "specific"))


LONG = "".join(f" union all select {KEYS}, read_count, {i} as filter_id, {c} as filter_delete from state" + (" where f4 is not null" if i == 4 else "") for i, c in ((2, "f2"), (4, "f4"), (6, "f6"), (7, "f7"), (8, "filter_delete")))[len(" union all ") :]


@query("lfn_long", LFN + LONG)
def _(s, d):
    return filters.lfn_long(nijk(s, d), CUT, view(s, d, "specific"))


@query("lfn_named", LFN + f"select {KEYS}, read_count, filter_id, filter_delete, case filter_id when 2 then 'lfn_variant' when 4 then 'lfn_variant_specific' when 6 then 'lfn_sample_replicate' when 7 then 'lfn_read_count' else 'lfn_all' end as filter_name from ({LONG}) x")
def _(s, d):
    return filters.lfn_named(filters.lfn_long(nijk(s, d), CUT, view(s, d, "specific")))


def lfn_state(s, d):
    return filters.lfn_all(nijk(s, d), CUT, view(s, d, "specific"))


# --- audits of a stage

@query("audit_variants", LFN + "select run_id, marker_id, count(distinct variant_id) as n_variants from state where not filter_delete group by run_id, marker_id")
def _(s, d):
    return counts.audit_distinct(lfn_state(s, d), ["variant_id"], "n_variants")


@query("audit_samples", LFN + "select run_id, marker_id, count(distinct sample_id) as n_samples from state where not filter_delete group by run_id, marker_id")
def _(s, d):
    return counts.audit_distinct(lfn_state(s, d), ["sample_id"], "n_samples")


@query("audit_sample_replicates", LFN + "select run_id, marker_id, count(distinct (sample_id, replicate)) as n_sample_replicates from state where not filter_delete group by run_id, marker_id")
def _(s, d):
    return counts.audit_distinct(lfn_state(s, d), ["sample_id", "replicate"], "n_sample_replicates")


@query("audit_reads", LFN + "select run_id, marker_id, cast(sum(read_count) as bigint) as n_reads from state where not filter_delete group by run_id, marker_id")
def _(s, d):
    return counts.audit_reads(lfn_state(s, d))


@query("audit_variant_list", LFN + f", variant as ({ctes('variant')[len('with variant as ('):-1]}) select distinct s.variant_id, run_id, marker_id, sequence from state s join variant v on s.variant_id = v.variant_id where not filter_delete")
def _(s, d):
    return counts.audit_variants(lfn_state(s, d), variant(s, d))


MINREP = ", minrep as (select run_id, marker_id, sample_id, replicate, variant_id, read_count, count(replicate) over (partition by run_id, marker_id, variant_id, sample_id) < 3 as filter_delete from nijk)"


@query("stage_summary", LFN + MINREP + """, s as (select 'lfn' as stage, filter_delete from state union all select 'min_replicate', filter_delete from minrep)
 select stage, count(*) as n_rows, cast(sum(filter_delete::int) as bigint) as n_deleted, count(*) = sum(filter_delete::int) as all_deleted from s group by stage""")
def _(s, d):
    return counts.stage_summary({"lfn": lfn_state(s, d), "min_replicate": filters.min_replicate(nijk(s, d), 3)})


@query("surviving_nijk", LFN + ctes("sheet").replace("with ", ", ", 1) + f"select distinct s.run_id, s.marker_id, s.sample_id, s.replicate, s.variant_id, s.read_count from state s join sheet h on s.run_id = h.run_id and s.marker_id = h.marker_id and s.sample_id = h.sample_id and s.replicate = h.replicate where not filter_delete")
def _(s, d):
    long = filters.lfn_long(nijk(s, d), CUT, view(s, d, "specific"))
    return counts.survivors(long, view(s, d, "sheet"), filter_id=8)


# --- replicates

@query("min_replicate", ctes("nijk") + MINREP + "select * from minrep")
def _(s, d):
    return filters.min_replicate(nijk(s, d), 3)


RENK = ctes("nijk") + """, p as (select *, cast(read_count as double) / sum(read_count) over (partition by run_id, marker_id, sample_id, replicate) as p from nijk),
 reps as (select distinct run_id, marker_id, sample_id, replicate from nijk),
 pairs as (select a.run_id, a.marker_id, a.sample_id, a.replicate as replicate_left, b.replicate as replicate_right from reps a join reps b using (run_id, marker_id, sample_id) where a.replicate < b.replicate),
 common as (select a.run_id, a.marker_id, a.sample_id, a.replicate as replicate_left, b.replicate as replicate_right, sum(least(a.p, b.p)) as c from p a join p b using (run_id, marker_id, sample_id, variant_id) where a.replicate < b.replicate group by all),
 dist as (select pairs.*, round(1 - coalesce(c, 0), 9) as renkonen_distance from pairs left join common using (run_id, marker_id, sample_id, replicate_left, replicate_right)),
 ranked as (select *, row_number() over (partition by run_id, marker_id order by renkonen_distance) as r, count(*) over (partition by run_id, marker_id) as n from dist),
 cut as (select run_id, marker_id, renkonen_distance as cutoff from ranked where r = floor(0.9 * (n - 1)) + 1)"""


@query("renkonen_distance", RENK + "select * from dist")
def _(s, d):
    return filters.renkonen_distances(nijk(s, d))


@query("renkonen_cutoff", RENK + "select * from cut")
def _(s, d):
    return filters.renkonen_cutoffs(filters.renkonen_distances(nijk(s, d)))


GONE = """, each as (select run_id, marker_id, sample_id, unnest([replicate_left, replicate_right]) as replicate, (renkonen_distance > cutoff)::int as far from dist join cut using (run_id, marker_id)),
 sizes as (select run_id, marker_id, sample_id, count(*) as n from reps group by all),
 gone as (select run_id, marker_id, sample_id, replicate from each join sizes using (run_id, marker_id, sample_id) group by run_id, marker_id, sample_id, replicate, n having sum(far) > (n - 1) / 2)"""


@query("renkonen", RENK + GONE + """
 select nijk.*, gone.replicate is not null as filter_delete from nijk left join gone on nijk.run_id = gone.run_id and nijk.marker_id = gone.marker_id and nijk.sample_id = gone.sample_id and nijk.replicate = gone.replicate""")
def _(s, d):
    return filters.renkonen(nijk(s, d))


# --- frame and codons

@query("indel", ctes("nijk", "variant") + """, own as (select distinct n.variant_id, length(sequence) % 3 as phase from nijk n join variant v on n.variant_id = v.variant_id),
 common as (select phase from own group by phase order by count(*) desc, phase limit 1)
 select nijk.*, own.phase <> (select phase from common) as filter_delete from nijk join own on nijk.variant_id = own.variant_id""")
def _(s, d):
    return filters.indel(nijk(s, d), variant(s, d))


def _stops(frame: int) -> str:
    return f"cast(len(list_filter(range({frame}, length(sequence) - 1, 3), lambda i: substr(sequence, i, 3) in ('TAA', 'TAG'))) as bigint) as frame{frame}"


@query("stop_codon_count", ctes("variant") + f"select variant_id, {_stops(1)}, {_stops(2)}, {_stops(3)} from variant")
def _(s, d):
    return filters.stop_codon_counts(variant(s, d))


@query("codon_stop", ctes("nijk", "variant") + "select nijk.*, " + " and ".join(f"regexp_matches(substr(sequence, {f}), '^(?:...)*?TA[AG]')" for f in (1, 2, 3)) + " as filter_delete from nijk join variant on nijk.variant_id = variant.variant_id")
def _(s, d):
    return filters.codon_stop(nijk(s, d), variant(s, d))


# --- pairs of sequences

EDIT = ", pairs as (select a.variant_id as variant_a, b.variant_id as variant_b from variant a join variant b on a.variant_id < b.variant_id and abs(length(a.sequence) - length(b.sequence)) <= 1 where levenshtein(a.sequence, b.sequence) = 1)"
RATIO = """, nij as (select run_id, marker_id, sample_id, variant_id, cast(sum(read_count) as bigint) as n from nijk group by all),
 both_ways as (select variant_a as u, variant_b as e from pairs union all select variant_b, variant_a from pairs),
 ratios as (select x.run_id, x.marker_id, x.sample_id, x.variant_id as variant_unexpected, y.variant_id as variant_expected, x.n as n_ij_unexpected, y.n as n_ij_expected, cast(x.n as double) / y.n as ratio
  from nij x join both_ways b on x.variant_id = b.u join nij y on y.variant_id = b.e and x.run_id = y.run_id and x.marker_id = y.marker_id and x.sample_id = y.sample_id)"""


@query("one_edit_pairs", ctes("variant") + EDIT + "select * from pairs")
def _(s, d):
    return pairs.one_edit_pairs(variant(s, d))


@query("pcr_error_ratio", ctes("nijk", "variant") + EDIT + RATIO + "select * from ratios")
def _(s, d):
    return pairs.pcr_error_ratios(nijk(s, d), variant(s, d))


@query("pcr_error", ctes("nijk", "variant") + EDIT + RATIO + """, bad as (select distinct run_id, marker_id, sample_id, variant_unexpected as variant_id from ratios where ratio < 0.1)
 select nijk.*, bad.variant_id is not null as filter_delete from nijk left join bad on nijk.run_id = bad.run_id and nijk.marker_id = bad.marker_id and nijk.sample_id = bad.sample_id and nijk.variant_id = bad.variant_id""")
def _(s, d):
    return pairs.pcr_error(nijk(s, d), variant(s, d), 0.1)


CHIMERA = ctes("nijk", "variant") + """, nij as (select run_id, marker_id, sample_id, variant_id, cast(sum(read_count) as bigint) as n from nijk group by all),
 shared as (select c.variant_id as c, p.variant_id as p, length(c.sequence) as len,
   least(length(c.sequence) - 1, len(list_filter(range(1, least(length(c.sequence), length(p.sequence)) + 1), lambda k: left(c.sequence, k) = left(p.sequence, k)))) as lcp,
   least(length(c.sequence) - 1, len(list_filter(range(1, least(length(c.sequence), length(p.sequence)) + 1), lambda k: right(c.sequence, k) = right(p.sequence, k)))) as lcs
   from variant c join variant p on c.variant_id <> p.variant_id),
 cand as (select x.run_id, x.marker_id, x.sample_id, x.variant_id, s.p, s.len, s.lcp, s.lcs from nij x join nij y using (run_id, marker_id, sample_id) join shared s on s.c = x.variant_id and s.p = y.variant_id where y.n >= 16 * x.n),
 chim as (select distinct a.run_id, a.marker_id, a.sample_id, a.variant_id from cand a join cand b using (run_id, marker_id, sample_id, variant_id) where a.p <> b.p and a.lcp >= 1 and b.lcs >= 1 and a.lcp + b.lcs >= a.len),
 flagged as (select nij.run_id, nij.marker_id, nij.sample_id, nij.variant_id, nij.n as read_count, chim.variant_id is not null as filter_delete from nij left join chim using (run_id, marker_id, sample_id, variant_id))"""
BORDER = EDIT + """, close as (select distinct x.run_id, x.marker_id, x.sample_id, x.variant_id from nij x join (select variant_a as u, variant_b as e from pairs union all select variant_b, variant_a from pairs) b on x.variant_id = b.u
  join nij y on y.variant_id = b.e and x.run_id = y.run_id and x.marker_id = y.marker_id and x.sample_id = y.sample_id where y.n >= 16 * x.n),
 borderline as (select flagged.* exclude (filter_delete), filter_delete and close.variant_id is not null as filter_delete from flagged left join close using (run_id, marker_id, sample_id, variant_id))"""


@query("chimera", CHIMERA + "select * from flagged")
def _(s, d):
    return pairs.chimeras(nijk(s, d), variant(s, d), 16)




@query("chimera_borderline", CHIMERA + BORDER + "select * from borderline")
def _(s, d):
    return pairs.chimera_borderline(nijk(s, d), variant(s, d), 16)


@query("borderline_any", CHIMERA + BORDER + "select variant_id, bool_or(filter_delete) as chimera_borderline from borderline group by variant_id")
def _(s, d):
    return pairs.borderline_any(pairs.chimera_borderline(nijk(s, d), variant(s, d), 16))


def chained() -> str:
    """The SQL of all filters one after the other, each on what the one before has kept."""
    sample = "(run_id, marker_id, sample_id, variant_id)"
    body = lambda text, *views: text[len(ctes(*views)) :].removeprefix(", ") if views else text.removeprefix(", ")
    fewer = f"select {KEYS}, read_count from (select *, count(replicate) over (partition by run_id, marker_id, variant_id, sample_id) as n from nijk) x where n >= 2"
    stages = [
        f"with {body(TOTALS)} select {KEYS}, read_count from t where not (read_count = 0 or ri <= 0.005 or rjk <= 0.0005 or read_count < 20)",
        fewer,
        f"with {body(RATIO)}, bad as (select distinct run_id, marker_id, sample_id, variant_unexpected as variant_id from ratios where ratio < 0.1) select nijk.* from nijk anti join bad using {sample}",
        f"with {body(CHIMERA, 'nijk', 'variant')} select nijk.* from nijk anti join (select * from flagged where filter_delete) f using {sample}",
        fewer,
        f"with {body(RENK, 'nijk')}{GONE} select nijk.* from nijk anti join gone using (run_id, marker_id, sample_id, replicate)",
        fewer,
        """with own as (select distinct n.variant_id, length(sequence) % 3 as phase from nijk n join variant v on n.variant_id = v.variant_id)
 select nijk.* from nijk join own using (variant_id) where phase = (select phase from own group by phase order by count(*) desc, phase limit 1)""",
        "select nijk.* from nijk join variant using (variant_id) where not (" + " and ".join(f"regexp_matches(substr(sequence, {f}), '^(?:...)*?TA[AG]')" for f in (1, 2, 3)) + ")",
    ]
    text, kept = ctes("nijk", "variant") + EDIT, "nijk"
    for k, stage in enumerate(stages):
        text += f", kept{k} as (" + re.sub(r"\bnijk\b", kept, stage) + ")"
        kept = f"kept{k}"
    return text + f" select run_id, marker_id, variant_id, sample_id, cast(sum(read_count) as bigint) as read_count, count(*) as replicate_count, cast(sum(read_count) as double) / count(*) as read_count_average from {kept} group by run_id, marker_id, variant_id, sample_id"


@query("filter_chain", chained())
def _(s, d):
    return pairs.filter_chain(nijk(s, d), variant(s, d), CUT)["average"]
