"""Taxonomy: lineages, and the lowest taxonomic group on which a variant's similarity hits agree."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varicube.functions.storage import stored

# The ranks from the broadest to the narrowest, and those that an annotated table has.
HIERARCHY = [
    "no rank", "phylum", "superclass", "class", "subclass", "infraclass", "superorder", "order", "suborder", "infraorder", "family", "subfamily", "genus", "subgenus", "species", "subspecies",
]
RANKS = ["phylum", "class", "order", "family", "genus", "species"]
# The steps of the identity ladder.
LADDER = [100, 99, 97, 95, 90, 85, 80, 75, 70]


def split_taxonomy(taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Taxa once each, and the map from obsolete to current numbers."""
    taxa = taxonomy.select("tax_id", "parent_tax_id", "rank", "name_txt").dropDuplicates(["tax_id"])
    old = taxonomy.where("old_tax_id is not null").select("old_tax_id", "tax_id").dropDuplicates(["old_tax_id"])
    return taxa, old


def build_taxonomy(nodes: DataFrame, names: DataFrame, merged: DataFrame) -> DataFrame:
    """Taxonomy table from the three dump files' lines (column value, fields between tab, bar and tab): nodes with their scientific names and obsolete numbers. Lines without numbers are left out."""
    field = lambda i: F.trim(F.element_at(F.split("value", r"\t?\|\t?"), i))
    n = nodes.select(field(1).try_cast("long").alias("tax_id"), field(2).try_cast("long").alias("parent_tax_id"), field(3).alias("rank"))
    names_ = names.where(field(4) == "scientific name").select(field(1).try_cast("long").alias("tax_id"), field(2).alias("name_txt"))
    old = merged.select(field(1).try_cast("long").alias("old_tax_id"), field(2).try_cast("long").alias("tax_id"))
    return n.join(names_, "tax_id").join(old, "tax_id", "left").select("tax_id", "parent_tax_id", "rank", "name_txt", "old_tax_id").distinct()


def resolve_old(ids: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(tax_id, current_tax_id): itself where the taxonomy has it, else what an obsolete number stands for, else null."""
    taxa, old = split_taxonomy(taxonomy)
    known = taxa.select("tax_id", F.col("tax_id").alias("own"))
    joined = ids.select("tax_id").distinct().join(known, "tax_id", "left").join(old.select(F.col("old_tax_id").alias("tax_id"), F.col("tax_id").alias("now")), "tax_id", "left")
    return joined.select("tax_id", F.coalesce("own", "now").alias("current_tax_id"))


def lineage_steps(ids: DataFrame, taxonomy: DataFrame, deepest: int = 64) -> DataFrame:
    """(tax_id, depth, at, rank, name_txt, ok): a row for each taxon on the way from a taxon to the root, the root excluded.

    One recursive query walks up for the taxa that are needed only; a missing parent ends the walk. Over `deepest` levels, as in a circle of parents, raise an error. ok is false
    on the last row of a walk that ended without reaching the root. The first row keeps the number asked for, be it obsolete.
    """
    spark = ids.sparkSession
    taxa = stored(split_taxonomy(taxonomy)[0], "taxa")
    first = stored(resolve_old(ids, taxonomy).select("tax_id", F.coalesce("current_tax_id", "tax_id").alias("at")), "wanted")
    names, limits = [f"{x}_{uuid.uuid4().hex}" for x in ("taxa", "wanted")], {"spark.sql.cteRecursionRowLimit": -1, "spark.sql.cteRecursionLevelLimit": deepest + 2}
    for df, name in zip((taxa, first), names):
        df.createOrReplaceTempView(name)
    step = "t.tax_id is not null as known, t.parent_tax_id as parent, t.rank, t.name_txt"
    text = f"""
with recursive up(tax_id, depth, at, known, parent, rank, name_txt) as (
  select w.tax_id, 0, w.at, {step} from {names[1]} w left join {names[0]} t on t.tax_id = w.at where w.at <> 1
  union all
  select up.tax_id, up.depth + 1, up.parent, {step} from up left join {names[0]} t on t.tax_id = up.parent where up.parent <> 1 and up.depth < {deepest}
) select * from up"""
    kept = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        walked = stored(spark.sql(text), "lineage")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        for name in names:
            spark.catalog.dropTempView(name)
    if not walked.where(F.col("depth") >= deepest).isEmpty():
        raise ValueError(f"lineages of more than {deepest} levels")
    return walked.select("tax_id", "depth", F.when(F.col("depth") == 0, F.col("tax_id")).otherwise(F.col("at")).alias("at"), "rank", "name_txt", F.col("parent").isNotNull().alias("ok"))


def lineages(ids: DataFrame, taxonomy: DataFrame, ranks: list[str] = HIERARCHY) -> DataFrame:
    """tax_id and a column per rank with the taxon of that rank above it; of several the one nearest the root. A walk that breaks off leaves what it found."""
    steps = lineage_steps(ids, taxonomy).where("rank is not null")
    one = [F.max_by("at", F.when(F.col("rank") == r, F.col("depth"))).alias(r) for r in ranks]
    return steps.groupBy("tax_id").agg(*one)


def lineage_names(ids: DataFrame, taxonomy: DataFrame, ranks: list[str] = RANKS) -> DataFrame:
    """As lineages, but names, and only for taxa whose walk reaches the root."""
    steps = lineage_steps(ids, taxonomy)
    one = [F.max_by("name_txt", F.when(F.col("rank") == r, F.col("depth"))).alias(r) for r in ranks]
    return steps.groupBy("tax_id").agg(F.bool_and("ok").alias("whole"), *one).where("whole").drop("whole")


def clean_hits(raw: DataFrame) -> DataFrame:
    """Hits with a taxon: the first of several numbers, as a number."""
    return raw.where("target_tax_ids is not null").withColumn("target_tax_id", F.split("target_tax_ids", ";")[0].try_cast("long")).where("target_tax_id is not null").drop("target_tax_ids")


def hits_lineage(hits: DataFrame, lineage: DataFrame) -> DataFrame:
    return hits.join(lineage.withColumnRenamed("tax_id", "target_tax_id"), "target_tax_id")


def identity_ladder(hits: DataFrame, ladder: list[int] = LADDER) -> DataFrame:
    """Each hit once for every step that its identity reaches."""
    steps = F.filter(F.array(*[F.lit(float(x)) for x in ladder]), lambda x: x <= F.col("identity"))
    return hits.withColumn("step", F.explode(steps))


def ladder_eligible(laddered: DataFrame, sure: int = 97, least_taxa: int = 3) -> DataFrame:
    """Steps that may yield a group: of high identity, or with hits of enough taxa."""
    n = laddered.groupBy("variant_id", "step").agg(F.countDistinct("target_tax_id").alias("n_taxa"))
    return n.where((F.col("step") >= sure) | (F.col("n_taxa") >= least_taxa))


def rank_consensus(laddered: DataFrame, ranks: list[str] = HIERARCHY) -> DataFrame:
    """Of each variant, step and rank, the commonest taxon and its share of all hits, those without a taxon of the rank included; ties go to the smallest."""
    ids = ["variant_id", "step"]
    n = laddered.groupBy(*ids).agg(F.count(F.lit(1)).alias("n_hits"))
    long = laddered.unpivot(ids, ranks, "rank", "tax_id").where("tax_id is not null")
    counted = long.groupBy(*ids, "rank", "tax_id").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy(*ids, "rank").agg(F.max_by(F.struct("tax_id", "n"), F.struct(F.col("n"), -F.col("tax_id"))).alias("b"))
    return best.join(n, ids).select(*ids, "rank", F.col("b.tax_id").alias("tax_id"), (F.col("b.n").cast("double") * 100 / F.col("n_hits")).alias("share"))


def ltg_at_step(consensus: DataFrame, include_prop: float = 90, ranks: list[str] = HIERARCHY) -> DataFrame:
    """The lowest rank whose commonest taxon has a share of `include_prop` per cent or more."""
    order = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col("rank"))  # narrower ranks come later
    best = consensus.where(F.col("share") >= include_prop).groupBy("variant_id", "step").agg(F.max_by(F.struct("rank", "tax_id"), order).alias("b"))
    return best.select("variant_id", "step", F.col("b.rank").alias("ltg_rank"), F.col("b.tax_id").alias("ltg_tax_id"))


def ltg(hits: DataFrame, lineage: DataFrame, include_prop: float = 90, sure: int = 97, least_taxa: int = 3) -> DataFrame:
    """The group of the first step down the ladder that yields one; a variant without any has no row."""
    laddered = identity_ladder(hits_lineage(hits, lineage))
    own = laddered.join(ladder_eligible(laddered, sure, least_taxa).select("variant_id", "step"), ["variant_id", "step"], "left_semi")
    found = ltg_at_step(rank_consensus(own), include_prop)
    return found.groupBy("variant_id").agg(F.max("step").alias("identity"), F.max_by(F.struct("ltg_rank", "ltg_tax_id"), "step").alias("b")).select("variant_id", "identity", "b.ltg_rank", "b.ltg_tax_id")


def annotate(variants: DataFrame, groups: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Variants with their group, its name and the names of its lineage; the sequence last. A group without a name has null ones."""
    taxa, _ = split_taxonomy(taxonomy)
    groups = stored(groups, "groups")  # read three times
    names = taxa.select(F.col("tax_id").alias("ltg_tax_id"), F.col("name_txt").alias("ltg_tax_name"))
    lineage = lineage_names(groups.select(F.col("ltg_tax_id").alias("tax_id")), taxonomy).withColumnRenamed("tax_id", "ltg_tax_id")
    joined = variants.join(groups, "variant_id", "left").join(names, "ltg_tax_id", "left").join(lineage, "ltg_tax_id", "left")
    return joined.select("variant_id", "identity", "ltg_rank", "ltg_tax_id", "ltg_tax_name", *RANKS, "sequence")


def unassigned(variants: DataFrame, store: DataFrame, reset: bool = False) -> DataFrame:
    """Variants still to be assigned: all on reset, else those without a stored group."""
    return variants if reset else variants.join(store.where("ltg_tax_id is not null").select("variant_id"), "variant_id", "left_anti")
