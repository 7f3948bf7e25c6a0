"""Views that express the amplicon data model on the star-schema tables.

Each view is one text for Spark and DuckDB, but those in SPARK_VIEWS, which have one of their own for Spark with the same rows. Names in braces stand for tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from varicube.functions.storage import stored

BASES = "translate({}, '0123456789abcdef', 'ACGTACGTACGTACGT')"


def letters(expr: str) -> str:
    return BASES.format(expr)


def rc(expr: str) -> str:
    return f"translate(reverse({expr}), 'ACGT', 'TGCA')"


RUN = "cast(year(l_shipdate) % 2 + 1 as int) as run_id"
MARKER = "cast(case l_linestatus when 'O' then 1 else 2 end as int) as marker_id"
SAMPLE = "cast(l_suppkey % 8 + 1 as int) as sample_id"
REPLICATE = "cast(l_orderkey % 3 + 1 as int) as replicate"

# Primers with IUPAC codes and what the reads hold; every eleventh read has one wrong base in the forward one.
PRIMER_FWD, PRIMER_REV = "GGRTTYACNTCA", "CCWGATSTTGKA"
REAL_FWD, WRONG_FWD, REAL_REV = "GGATTCACGTCA", "GGATTCACGTCG", "CCAGATGTTGGA"

VIEWS = {
    "nijk": f"""
select {RUN}, {MARKER}, {SAMPLE}, {REPLICATE},
       cast(l_partkey % 200 + 1 as bigint) as variant_id,
       cast(sum(l_quantity) * case when (l_partkey % 200 + 1) % 5 = 0 then 20 else 1 end as bigint) as read_count
from {{lineitem}}
where l_partkey % 3 > 0 or l_orderkey % 4 > 0
group by year(l_shipdate) % 2, l_linestatus, l_suppkey % 8, l_orderkey % 3, l_partkey % 200""",
    "variant": f"""
select variant_id,
  case k when 0 then s
         when 1 then substr(s, 1, 9) || translate(substr(s, 10, 1), 'ACGT', 'CGTA') || substr(s, 11)
         when 2 then substr(s, 1, 20) || substr(s, 22)
         when 3 then s || 'ACG'
         else substr(s, 1, 32) || substr(s2, 33) end as sequence
from (
  select variant_id, variant_id % 5 as k,
    {letters("md5('v' || cast(variant_id - variant_id % 5 as string)) || md5('w' || cast(variant_id - variant_id % 5 as string))")} as s,
    {letters("md5('v' || cast((variant_id - variant_id % 5 + 5) % 205 as string)) || md5('w' || cast((variant_id - variant_id % 5 + 5) % 205 as string))")} as s2
  from (select distinct cast(l_partkey % 200 + 1 as bigint) as variant_id from {{lineitem}}) d
) b""",
    "reads": f"""
select l_orderkey * 10 + l_linenumber as read_id, {RUN}, {MARKER}, {SAMPLE}, {REPLICATE},
       {letters("md5('v' || cast(l_partkey % 200 as string))")} as sequence
from {{lineitem}}""",
    "tags": f"""
select distinct {SAMPLE}, {REPLICATE},
       {letters("substr(md5('tf' || cast(l_suppkey % 8 + 1 as string)), 1, 8)")} as tagfwd,
       {letters("substr(md5('tr' || cast(l_orderkey % 3 + 1 as string)), 1, 8)")} as tagrev
from {{lineitem}}""",
    "sample_types": f"""
select distinct {SAMPLE},
       case l_suppkey % 8 when 0 then 'mock' when 1 then 'negative' else 'real' end as sample_type,
       case when l_suppkey % 8 = 1 then null when l_suppkey % 8 in (2, 3, 4) then 'freshwater' else 'marine' end as habitat
from {{lineitem}}""",
    "known_occurrences": f"""
select distinct {RUN}, {MARKER}, {SAMPLE}, cast(l_partkey % 200 + 1 as bigint) as variant_id,
       case when l_suppkey % 8 = 0 then 1 else 0 end as mock,
       case when l_suppkey % 8 = 0 then 'keep' else 'delete' end as action
from {{lineitem}}
where (l_suppkey % 8 = 0 and (l_partkey % 200 + 1) % 5 = 0 and l_partkey % 200 + 1 <= 40)
   or (l_suppkey % 8 = 1 and l_partkey % 200 + 1 <= 60)""",
    "taxonomy": """
select cast(1 as bigint) as tax_id, cast(1 as bigint) as parent_tax_id, 'no rank' as rank, 'root' as name_txt, cast(null as bigint) as old_tax_id
union all
select cast(10 + r_regionkey as bigint), cast(1 as bigint), 'phylum', r_name, cast(null as bigint) from {region}
union all
select cast(100 + n_nationkey as bigint), cast(10 + n_regionkey as bigint), case n_nationkey % 3 when 0 then 'suborder' when 1 then 'superorder' else 'order' end, n_name, cast(null as bigint) from {nation}
union all
select cast(1000 + s_suppkey as bigint), cast(100 + s_nationkey as bigint), case s_suppkey % 3 when 0 then 'subfamily' when 1 then 'subgenus' else 'genus' end, s_name, cast(null as bigint) from {supplier}
union all
select cast(100000 + p_partkey as bigint), cast(1000 + s_suppkey as bigint), case p_partkey % 4 when 0 then 'subspecies' else 'species' end, p_name,
       case when p_partkey % 10 = 0 then cast(900000 + p_partkey as bigint) end
from {part} join (select s_suppkey, row_number() over (order by s_suppkey) - 1 as pos, count(*) over () as n from {supplier}) g
  on p_partkey % n = pos""",
    "hits": """
select cast(l_orderkey % 300 as bigint) as variant_id,
       cast(70 + (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % (l_orderkey % 300 % 31 + 1) as double) as identity,
       cast(100000 + case when l_orderkey % 20 = 6 or l_partkey % 25 = 0 then l_partkey
                          else (l_orderkey % 300) % n + n * l_linenumber end as bigint) as target_tax_id
from {lineitem} cross join (select count(*) as n from {supplier}) c
where l_orderkey % 5 < 2""",
}
VIEWS["raw_reads"] = f"""
select read_id, run_id, marker_id, sample_id, replicate, case when read_id % 2 = 1 then {rc("raw")} else raw end as raw
from (
  select r.read_id, r.run_id, r.marker_id, r.sample_id, r.replicate,
         t.tagfwd || case when r.read_id % 11 = 0 then '{WRONG_FWD}' else '{REAL_FWD}' end || r.sequence || {rc(f"'{REAL_REV}'")} || {rc("t.tagrev")} as raw
  from ({VIEWS["reads"]}) r join ({VIEWS["tags"]}) t on r.sample_id = t.sample_id and r.replicate = t.replicate
) x"""
VIEWS["sheet"] = "select distinct run_id, marker_id, sample_id, replicate from (" + VIEWS["reads"] + ") r where sample_id <= 6"
VIEWS["specific"] = """
select run_id, marker_id, variant_id, cast(0.01 as double) as cutoff from (select distinct run_id, marker_id, variant_id from (""" + VIEWS["nijk"] + ") n) v where variant_id % 7 = 0"
VIEWS["specific_replicate"] = """
select run_id, marker_id, replicate, variant_id, cast(0.02 as double) as cutoff from (select distinct run_id, marker_id, replicate, variant_id from (""" + VIEWS["nijk"] + ") n) v where variant_id % 7 = 0"

# The place of each supplier in the order of keys: within slices of keys first, so that only numbers of slices are added up in one task.
PLACES = """
select s_suppkey, before + row_number() over (partition by slice order by s_suppkey nulls last) - 1 as pos
from (select s_suppkey, s_suppkey div 1000 as slice from {supplier}) s
join (select slice as of, sum(n) over (order by slice nulls last) - n as before from (select s_suppkey div 1000 as slice, count(*) as n from {supplier} group by s_suppkey div 1000) k) o
  on slice <=> of"""
# Spark would compare every part with every supplier for a condition whose side holds columns of both
SPARK_VIEWS = {
    "taxonomy": VIEWS["taxonomy"][: VIEWS["taxonomy"].index("from {part}")]
    + f"from (select p_partkey, p_name, p_partkey % nullif((select count(*) from {{supplier}}), 0) as place from {{part}}) p join ({PLACES}) g on place = pos",
    "raw_reads": VIEWS["raw_reads"].replace(f"({VIEWS['tags']})", "{tags}"),
}

TABLES = re.compile(r"\{(\w+)\}")


def ctes(*names: str) -> str:
    """with-clause of views for DuckDB, where the tables go by their own names."""
    return "with " + ", ".join(f"{n} as ({TABLES.sub(r'\1', VIEWS[n])})" for n in names)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "raw_reads":
        tags = stored(view(spark, sf_dir, "tags"), "tags")  # small, which Spark cannot know of an aggregate: few tag pairs would crowd the reads into few tasks
        return spark.sql(TABLES.sub(lambda m: f"parquet.`{tags.stored_path if m[1] == 'tags' else f'{sf_dir}/{m[1]}.parquet'}`", SPARK_VIEWS[name]))
    return spark.sql(TABLES.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", SPARK_VIEWS.get(name) or VIEWS[name]))
