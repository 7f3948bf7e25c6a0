"""Queries on taxonomy, the variant dictionary and read preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from varicube.functions.sequences import reverse_complement
from varicube.operators import alignment, reads, taxonomy
from varicube.plans.denoising import nijk, variant
from varicube.plans.fixtures import PRIMER_FWD, PRIMER_REV, ctes, rc, view
from varicube.plans.registry import query
from varicube.functions.sequences import BASES
from varicube.sources import sinks

RANKS = taxonomy.RANKS
# All ranks that a lowest group may have, from the broadest to the narrowest, written out for the SQL.
ALL_RANKS = [
    "no rank", "phylum", "superclass", "class", "subclass", "infraclass", "superorder", "order", "suborder", "infraorder", "family", "subfamily", "genus", "subgenus", "species", "subspecies",
]


def taxa(s, d):
    return view(s, d, "taxonomy")


@query("taxonomy_build", ctes("taxonomy") + "select distinct * from taxonomy")
def _(s, d):
    t = taxa(s, d)
    bar = "\t|\t"
    line = lambda *c: F.concat(F.concat_ws(bar, *[x.cast("string") for x in c]), F.lit("\t|")).alias("value")
    nodes = t.select(line(F.col("tax_id"), F.col("parent_tax_id"), F.col("rank")))
    named = t.select(line(F.col("tax_id"), F.col("name_txt"), F.lit(""), F.lit("scientific name")))
    others = t.select(line(F.col("tax_id"), F.concat(F.lit("x "), F.col("name_txt")), F.lit(""), F.lit("synonym")))
    merged = t.where("old_tax_id is not null").select(line(F.col("old_tax_id"), F.col("tax_id")))
    return taxonomy.build_taxonomy(nodes, named.unionByName(others), merged)


RAW_HITS = "case when target_tax_id % 7 = 0 then null when target_tax_id % 5 = 0 then cast(target_tax_id as varchar) || ';' || cast(target_tax_id + 1 as varchar) else cast(target_tax_id as varchar) end"


@query("hits_clean", ctes("hits") + f"select variant_id, identity, cast(split_part({RAW_HITS}, ';', 1) as bigint) as target_tax_id from hits where target_tax_id % 7 <> 0")
def _(s, d):
    raw = view(s, d, "hits").withColumn("target_tax_ids", F.expr(RAW_HITS.replace("varchar", "string"))).drop("target_tax_id")
    return taxonomy.clean_hits(raw)


# taxa that are looked up: those of hits, obsolete numbers and some that nobody knows
WANTED = """, wanted as (select distinct target_tax_id as tax_id from hits union select old_tax_id from taxonomy where old_tax_id is not null union select tax_id + 5000000 from taxonomy where tax_id < 200)"""
WALK = WANTED + """, up as (
  select w.tax_id, coalesce(t.tax_id, o.tax_id) as node, 0 as depth from wanted w left join (select distinct tax_id from taxonomy) t on t.tax_id = w.tax_id left join taxonomy o on o.old_tax_id = w.tax_id
  union all select up.tax_id, t.parent_tax_id, depth + 1 from up join taxonomy t on t.tax_id = up.node where up.node <> 1 and depth < 64),
 steps as (select distinct up.tax_id, case when depth = 0 then up.tax_id else up.node end as node, depth, t.rank, t.name_txt from up join taxonomy t on t.tax_id = up.node where up.node <> 1),
 lin as (select tax_id, """ + ", ".join(f"max(case when rank = '{r}' then node end) as \"{r}\"" for r in ALL_RANKS) + """ from steps group by tax_id),
 names as (select tax_id, """ + ", ".join(f"max(case when rank = '{r}' then name_txt end) as \"{r}\"" for r in RANKS) + """ from steps group by tax_id)"""
TAXA = ctes("taxonomy", "hits").replace("with ", "with recursive ", 1)


def wanted(s, d):
    t = taxa(s, d)
    ids = view(s, d, "hits").select(F.col("target_tax_id").alias("tax_id"))
    return ids.unionByName(t.where("old_tax_id is not null").select(F.col("old_tax_id").alias("tax_id"))).unionByName(t.where("tax_id < 200").select((F.col("tax_id") + 5000000).alias("tax_id"))).distinct()


def hit_lineages(s, d):
    return taxonomy.lineages(view(s, d, "hits").select(F.col("target_tax_id").alias("tax_id")).distinct(), taxa(s, d))


@query("old_tax_id", TAXA + WALK + "select tax_id, node as current_tax_id from up where depth = 0")
def _(s, d):
    return taxonomy.resolve_old(wanted(s, d), taxa(s, d))


@query("lineage", TAXA + WALK + "select * from lin")
def _(s, d):
    return taxonomy.lineages(wanted(s, d), taxa(s, d))


@query("lineage_names", TAXA + WALK + "select * from names")
def _(s, d):
    return taxonomy.lineage_names(wanted(s, d), taxa(s, d))


HITS = TAXA + WALK + f""", hl as (select h.variant_id, h.identity, h.target_tax_id, {', '.join(chr(34) + r + chr(34) for r in ALL_RANKS)} from hits h join lin l on l.tax_id = h.target_tax_id),
 ladder as (select hl.*, step from hl join (select cast(unnest({taxonomy.LADDER}) as double) as step) s on identity >= step),
 elig as (select variant_id, step, count(distinct target_tax_id) as n_taxa from ladder group by variant_id, step having step >= 97 or count(distinct target_tax_id) >= 3),
 n as (select variant_id, step, count(*) as n_hits from ladder group by variant_id, step),
 long as ({' union all '.join(f"select variant_id, step, '{r}' as rank, {k} as ord, \"{r}\" as tax_id from ladder" for k, r in enumerate(ALL_RANKS))}),
 cnt as (select variant_id, step, rank, ord, tax_id, count(*) as c from long where tax_id is not null group by all),
 best as (select *, row_number() over (partition by variant_id, step, rank order by c desc, tax_id) as rn from cnt),
 cons as (select variant_id, step, rank, ord, tax_id, cast(c as double) * 100 / n_hits as share from best join n using (variant_id, step) where rn = 1),
 low as (select *, row_number() over (partition by variant_id, step order by ord desc) as rn from cons where share >= 90),
 atstep as (select variant_id, step, rank as ltg_rank, tax_id as ltg_tax_id from low where rn = 1),
 found as (select a.*, row_number() over (partition by variant_id order by step desc) as rn from atstep a join elig using (variant_id, step)),
 ltg as (select variant_id, step as identity, ltg_rank, ltg_tax_id from found where rn = 1)"""


@query("hits_lineage", HITS + "select * from hl")
def _(s, d):
    return taxonomy.hits_lineage(view(s, d, "hits"), hit_lineages(s, d))


@query("identity_ladder", HITS + "select variant_id, identity, target_tax_id, step from ladder")
def _(s, d):
    return taxonomy.identity_ladder(view(s, d, "hits"))


@query("ladder_eligible", HITS + "select * from elig")
def _(s, d):
    return taxonomy.ladder_eligible(taxonomy.identity_ladder(view(s, d, "hits")))


def consensus(s, d):
    return taxonomy.rank_consensus(taxonomy.identity_ladder(taxonomy.hits_lineage(view(s, d, "hits"), hit_lineages(s, d))))


@query("rank_consensus", HITS + "select variant_id, step, rank, tax_id, share from cons")
def _(s, d):
    return consensus(s, d)


@query("ltg_at_step", HITS + "select * from atstep")
def _(s, d):
    return taxonomy.ltg_at_step(consensus(s, d))


def groups(s, d):
    return taxonomy.ltg(view(s, d, "hits"), hit_lineages(s, d))


@query("ltg", HITS + "select * from ltg")
def _(s, d):
    return groups(s, d)


V = ctes("variant")[len("with ") :]


@query("asv_taxa", HITS + ", " + V + """, up2 as (
  select distinct ltg_tax_id as tax_id, ltg_tax_id as node, 0 as depth from ltg union all select up2.tax_id, t.parent_tax_id, depth + 1 from up2 join (select distinct tax_id, parent_tax_id from taxonomy) t on t.tax_id = up2.node where up2.node <> 1),
 nm as (select up2.tax_id, """ + ", ".join(f"max(case when t.rank = '{r}' then t.name_txt end) as \"{r}\"" for r in RANKS) + """ from up2 join taxonomy t on t.tax_id = up2.node where node <> 1 group by up2.tax_id)
 select v.variant_id, l.identity, l.ltg_rank, l.ltg_tax_id, t.name_txt as ltg_tax_name, """ + ', '.join(f'nm."{r}"' for r in RANKS) + """, v.sequence
 from variant v left join ltg l on l.variant_id = v.variant_id left join (select distinct tax_id, name_txt from taxonomy) t on t.tax_id = l.ltg_tax_id left join nm on nm.tax_id = l.ltg_tax_id""")
def _(s, d):
    return taxonomy.annotate(variant(s, d), groups(s, d), taxa(s, d))


STORED = "variant_id % 3 = 0"


@query("tax_cache_todo", ctes("variant") + "select variant_id, sequence from variant where not (variant_id % 3 = 0 and variant_id % 2 = 0)")
def _(s, d):
    v = variant(s, d)
    store = v.where(STORED).select("variant_id", F.when(F.col("variant_id") % 2 == 0, F.lit(10)).alias("ltg_tax_id"))
    return taxonomy.unassigned(v, store)


@query("similar_targets")
def _(s, d):
    v = variant(s, d)
    return alignment.similar_targets(v, v.withColumnRenamed("variant_id", "target_id"))


@query("variant_dictionary", ctes("reads", "variant") + """, seqs as (select distinct sequence from reads union select sequence from variant),
 old as (select variant_id, sequence from variant where variant_id <= 100), fresh as (select sequence from seqs where sequence not in (select sequence from old))
 select variant_id, sequence from old union all select (select max(variant_id) from old) + row_number() over (order by sequence), sequence from fresh""")
def _(s, d):
    seqs = view(s, d, "reads").select("sequence").unionByName(variant(s, d).select("sequence"))
    return sinks.extend_dictionary(variant(s, d).where("variant_id <= 100"), seqs)


# --- reads


@query("reverse_complement", ctes("reads") + f"select read_id, {rc('sequence')} as reverse_complement from reads")
def _(s, d):
    return view(s, d, "reads").select("read_id", reverse_complement(F.col("sequence")).alias("reverse_complement"))


STRANDS = ctes("raw_reads", "tags") + f", both_s as (select read_id, raw, '+' as strand from raw_reads union all select read_id, {rc('raw')}, '-' from raw_reads)"
ANCHORED = STRANDS + f", anch as (select read_id, raw, strand, t.sample_id, t.replicate, tagfwd, tagrev, substr(raw, 9, length(raw) - 16) as \"inner\" from both_s join tags t on left(raw, 8) = tagfwd and right(raw, 8) = {rc('tagrev')})"


def raw(s, d):
    return view(s, d, "raw_reads").select("read_id", "raw")


def demuxed(s, d):
    return reads.demux_anchored(reads.both_strands(raw(s, d)), view(s, d, "tags"))


@query("demux_both_strands", STRANDS + "select * from both_s")
def _(s, d):
    return reads.both_strands(raw(s, d))


@query("demux_anchored", ANCHORED + "select * from anch")
def _(s, d):
    return demuxed(s, d)


@query("demux_floating", STRANDS + f", f as (select read_id, raw, t.*, instr(raw, tagfwd) as place, substr(raw, instr(raw, tagfwd) + 8) as behind from raw_reads join tags t on instr(raw, tagfwd) > 0), g as (select *, instr(behind, {rc('tagrev')}) as e from f where instr(behind, {rc('tagrev')}) > 0) select distinct read_id, raw, sample_id, replicate, tagfwd, tagrev, place, substr(behind, 1, e - 1) as \"inner\" from g")
def _(s, d):
    return reads.demux_floating(raw(s, d), view(s, d, "tags")).withColumn("place", F.col("place").cast("long"))


@query("tag_conflicts", ctes("tags") + "select 'run' as source_file, tagfwd, left(tagrev, 1) as tagrev, count(*) as n from tags group by all having count(*) > 1")
def _(s, d):
    sheet = view(s, d, "tags").withColumn("tagrev", F.substring("tagrev", 1, 1)).withColumn("source_file", F.lit("run"))
    return reads.tag_conflicts(sheet, "source_file")


def primer_sql(text: str, primer: str) -> str:
    return " + ".join(f"case when substr({text}, {i}, 1) in ({', '.join(repr(b) for b in BASES[c])}) then 0 else 1 end" for i, c in enumerate(primer, 1))


REV_RC = PRIMER_REV[::-1].translate(str.maketrans("ACGTRYKMBDHVSWN", "TGCAYRMKVHDBSWN"))
TRIM = ANCHORED + f""", trim as (select *, substr("inner", {len(PRIMER_FWD) + 1}, length("inner") - {len(PRIMER_FWD) + len(PRIMER_REV)}) as sequence from anch where length("inner") >= {len(PRIMER_FWD) + len(PRIMER_REV)}
 and ({primer_sql('"inner"', PRIMER_FWD)}) <= 1 and ({primer_sql(f'right("inner", {len(PRIMER_REV)})', REV_RC)}) <= 1)"""


@query("primer_trim", TRIM + "select * from trim")
def _(s, d):
    return reads.primer_trim(demuxed(s, d), PRIMER_FWD, PRIMER_REV, 0.1)


@query("length_window", ctes("variant") + "select variant_id, sequence from variant where length(sequence) between 64 and 66")
def _(s, d):
    return reads.length_window(variant(s, d), 64, 66)


FILE = "'run' || cast(run_id as varchar) || '_marker' || cast(marker_id as varchar) || '.fasta'"


def filed(s, d):
    name = F.concat(F.lit("run"), F.col("run_id").cast("string"), F.lit("_marker"), F.col("marker_id").cast("string"), F.lit(".fasta"))
    return view(s, d, "reads").withColumn("source_file", name)


@query("random_reads", ctes("reads") + f", f as (select *, {FILE} as source_file from reads), o as (select *, row_number() over (partition by source_file order by md5('1-' || cast(read_id as varchar)), read_id) as rn from f) select * exclude (rn) from o where rn <= 100")
def _(s, d):
    return reads.random_reads(filed(s, d), 100)


@query("reads_per_file", ctes("reads") + f"select {FILE} as source_file, count(*) as n_reads from reads group by 1")
def _(s, d):
    return reads.reads_per_file(filed(s, d))


@query("merge_stats", ctes("reads") + f", f as (select *, {FILE} as source_file from reads) select source_file, count(*) as n_forward, cast(sum((read_id % 10 <> 0)::int) as bigint) as n_reverse, cast(sum((read_id % 3 <> 0)::int) as bigint) as n_merged from f group by 1")
def _(s, d):
    f = filed(s, d)
    return reads.merge_stats(f, f.where("read_id % 10 <> 0"), f.where("read_id % 3 <> 0"))


@query("sampled_sheet", ctes("reads") + f"select distinct run_id, marker_id, sample_id, replicate, regexp_replace({FILE}, '^([^.]+)\\.', '\\1_sampled.') as source_file from reads")
def _(s, d):
    return reads.sampled_sheet(filed(s, d).select("run_id", "marker_id", "sample_id", "replicate", "source_file").distinct())


# By the number of the read: a wrong base of middling quality in the first mate, which the second one puts right; a bad base that cuts the second mate to 20
# bases; a base that cuts it too short; a mate of something else; a base that only one mate has, of middling quality. The rest are clean.
@query("merge_pairs", ctes("reads") + """select read_id, sequence,
  case when read_id % 7 = 5 then cast(0.0131 as double) else cast(0.0032 as double) end as errors
  from reads where read_id % 7 not in (3, 4)""")
def _(s, d):
    r = view(s, d, "reads")
    kind = F.col("read_id") % 7
    first, good = F.substring("sequence", 1, 24), F.repeat(F.lit("I"), 24)
    base = F.translate(F.substring("sequence", 20, 1), "ACGT", "CGTA")
    pairs = r.select(
        "read_id",
        F.when(kind == 1, F.concat(F.substring("sequence", 1, 19), base, F.substring("sequence", 21, 4))).otherwise(first).alias("fwd_seq"),
        F.when(kind == 1, F.lit("I" * 19 + "5" + "I" * 4)).when(kind == 5, F.lit("I" * 3 + "5" + "I" * 20)).otherwise(good).alias("fwd_qual"),
        F.when(kind == 4, F.repeat(F.lit("A"), 24)).otherwise(reverse_complement(F.substring("sequence", 9, 24))).alias("rev_seq"),
        F.when(kind == 2, F.lit("I" * 20 + "#III")).when(kind == 3, F.lit("I" * 12 + "#" + "I" * 11)).otherwise(good).alias("rev_qual"),
    )
    return reads.merge_pairs(pairs, least_overlap=10, most_differences=0.1, least_length=20, least_read=20).withColumn("errors", F.round("errors", 6))
