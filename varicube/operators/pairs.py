"""Operators on pairs of sequences: one-edit neighbours, chimeras, clusters; and the chain of all filters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varicube.functions.graphs import components
from varicube.functions.storage import discard, stored
from varicube.operators import filters
from varicube.operators.counts import N_IJ, RUN_MARKER, replicate_average, totals

SAMPLE = [*RUN_MARKER, "sample_id"]


def deletion_keys(variants: DataFrame) -> DataFrame:
    """(variant_id, at, base, rest): a hash of each sequence without the character at each place, and of the whole one at place 0. An index for one_edit_pairs."""
    own = variants.select("variant_id", "sequence").where("sequence is not null")
    placed = own.withColumn("at", F.explode(F.sequence(F.lit(0), F.length("sequence"))))
    rest = F.expr("xxhash64(if(at = 0, sequence, concat(substr(sequence, 1, at - 1), substr(sequence, at + 1))))")
    return placed.select("variant_id", "at", F.when(F.col("at") > 0, F.expr("substr(sequence, at, 1)")).alias("base"), rest.alias("rest"))


def one_edit_pairs(variants: DataFrame, known: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """(variant_a, variant_b), a < b, of sequences that differ by one substitution, insertion or deletion.

    With one substitution, two sequences are equal without the character at that place; else the longer one without one of
    its characters is the shorter. So each sequence is keyed by hashes of itself without each of its characters, and of itself.
    Keys grow with the total length, and only sequences a step or two apart share one, however much of them is conserved.

    known: variants of earlier runs, keys: their deletion_keys() if they are stored. Then only pairs with one of `variants` at least are returned: new ones meet the index, and the
    known ones do not meet each other again.
    """
    own = stored(variants.select("variant_id", "sequence").where("sequence is not null"), "variants")
    fresh = stored(deletion_keys(own), "deletions")
    index, every = fresh, own
    if known is not None:
        earlier = known.select("variant_id", "sequence").where("sequence is not null")
        index, every = fresh.unionByName(keys if keys is not None else deletion_keys(earlier)), own.unionByName(earlier)
    a, b = [x.select("rest", *[F.col(c).alias(f"{c}_{side}") for c in ("variant_id", "at", "base")]) for x, side in ((fresh, "a"), (index, "b"))]
    swapped = "at_a > 0 and at_a = at_b and base_a <> base_b"
    shifted = "(at_a = 0) <> (at_b = 0)"
    met = a.join(b, "rest").where(f"variant_id_a <> variant_id_b and ({swapped} or {shifted})")
    met = met.select(F.least("variant_id_a", "variant_id_b").alias("variant_a"), F.greatest("variant_id_a", "variant_id_b").alias("variant_b")).distinct()
    for x in "ab":
        met = met.join(every.select(F.col("variant_id").alias(f"variant_{x}"), F.col("sequence").alias(x)), f"variant_{x}")
    return met.where(F.levenshtein("a", "b", 1) == 1).select("variant_a", "variant_b").distinct()


def pcr_error_ratios(counts: DataFrame, variants: DataFrame) -> DataFrame:
    """In each sample that holds both of a one-edit pair, reads of the one over reads of the other, both ways round."""
    pairs = stored(one_edit_pairs(variants), "pairs")
    ways = pairs.toDF("variant_unexpected", "variant_expected").unionByName(pairs.toDF("variant_expected", "variant_unexpected"))
    n_ij = totals(counts, N_IJ, "n")
    u = n_ij.withColumnsRenamed({"variant_id": "variant_unexpected", "n": "n_ij_unexpected"})
    e = n_ij.withColumnsRenamed({"variant_id": "variant_expected", "n": "n_ij_expected"})
    joined = u.join(ways, "variant_unexpected").join(e, [*SAMPLE, "variant_expected"])
    ratio = F.try_divide(F.col("n_ij_unexpected").cast("double"), F.col("n_ij_expected").cast("double"))
    return joined.select(*SAMPLE, "variant_unexpected", "variant_expected", "n_ij_unexpected", "n_ij_expected", ratio.alias("ratio"))


def pcr_error(counts: DataFrame, variants: DataFrame, most: float = 0.1) -> DataFrame:
    """Delete a variant in a sample if its reads are less than `most` of those of a variant one edit away."""
    bad = pcr_error_ratios(counts, variants).where(F.col("ratio") < most).select(*SAMPLE, F.col("variant_unexpected").alias("variant_id")).distinct().withColumn("gone", F.lit(True))
    return counts.join(bad, [*SAMPLE, "variant_id"], "left").select(*counts.columns, F.coalesce("gone", F.lit(False)).alias("filter_delete"))


def branches(variants: DataFrame) -> DataFrame:
    """(variant_id, len, side, k, part): the beginnings (side left) and ends (right) of each variant at which another one leaves it or it stops, by length and hash.

    What a variant has in common with another one ends at such a place for both, so these rows tell all longest common beginnings and ends. Most places of a
    sequence are none: there are about as many as a tree of all sequences forks along it.
    """
    own = variants.select("variant_id", "sequence", F.length("sequence").alias("len")).where("len > 0")
    placed = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len"))))
    parts = {"left": F.expr("substr(sequence, 1, k)"), "right": F.expr("right(sequence, k)")}
    sides = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.xxhash64(part).alias("part")) for side, part in parts.items()]))
    cut = stored(placed.select("variant_id", "len", "k", sides.alias("s")).select("variant_id", "len", "k", "s.side", "s.part"), "parts")
    held = cut.groupBy("side", "k", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut.join(held, ["side", "k", "part"])
    next_n = F.lead("n").over(Window.partitionBy("variant_id", "side").orderBy("k"))  # of one sequence's places
    return shared.withColumn("next_n", next_n).where("next_n is null or next_n < n").select("variant_id", "len", "side", "k", "part")


def chimeras(counts: DataFrame, variants: DataFrame, skew: float = 16) -> DataFrame:
    """run, marker, sample, variant, read_count and filter_delete: the variant is exactly a left part of one parent and a right part of another.

    Both parents have at least `skew` (over 1) times its reads in the sample, and differ. No pairs are formed: for each sample and each
    branching beginning (and end) the two most abundant holders are found by aggregation, and a child looks up its own. It is a chimera
    if its longest beginning that a strong parent has and its longest end that another one has make up its length.
    """
    n = totals(counts, N_IJ, "read_count")
    used = stored(variants.join(n.select("variant_id").distinct(), "variant_id", "left_semi"), "variants")
    whole = stored(n.join(branches(used), "variant_id"), "branches")
    node = [*SAMPLE, "side", "k", "part"]
    # the two largest by partial aggregation: the maximum, then the maximum of the rest
    top = whole.groupBy(*node).agg(F.max(F.struct("read_count", "variant_id")).alias("top"), F.count(F.lit(1)).alias("holders")).where("holders > 1")
    rest = whole.join(top, node).where("variant_id <> top.variant_id").groupBy(*node).agg(F.max(F.struct("read_count", "variant_id")).alias("second"))
    held = top.join(rest, node).select(*node, F.array("top", "second").alias("held"))
    met = whole.join(held, node).withColumn("parent", F.explode("held")).where(F.col("parent.read_count") >= F.col("read_count") * skew)
    found = F.struct(F.least("k", F.col("len") - 1).alias("k"), F.col("parent.variant_id").alias("id"))
    sides = [F.collect_list(F.when(F.col("side") == side, found)).alias(side) for side in ("left", "right")]  # two a branch of one sequence at most
    parents = met.groupBy(*SAMPLE, "variant_id", "len").agg(*sides)
    joined = F.exists("left", lambda a: F.exists("right", lambda b: (a["id"] != b["id"]) & (a["k"] > 0) & (b["k"] > 0) & (a["k"] + b["k"] >= F.col("len"))))
    found = parents.where(joined).select(*SAMPLE, "variant_id").withColumn("found", F.lit(True))
    return n.join(found, [*SAMPLE, "variant_id"], "left").select(*SAMPLE, "variant_id", "read_count", F.coalesce("found", F.lit(False)).alias("filter_delete"))


def chimera_borderline(counts: DataFrame, variants: DataFrame, skew: float = 16, differences: int = 1) -> DataFrame:
    """As chimeras, but flags only the chimeras that are at most `differences` edits from a single parent: they may as well be errors of it."""
    n = totals(counts, N_IJ, "n_parent").withColumnRenamed("variant_id", "parent_id")
    flagged = stored(chimeras(counts, variants, skew), "chimeras")
    some = stored(variants.join(n.select(F.col("parent_id").alias("variant_id")).distinct(), "variant_id", "left_semi"), "variants")
    ways = pairs_within(some, differences).toDF("variant_id", "parent_id")
    near = flagged.where("filter_delete").join(ways, "variant_id").join(n, [*SAMPLE, "parent_id"]).where(F.col("n_parent") >= F.col("read_count") * skew)
    near = near.select(*SAMPLE, "variant_id").distinct().withColumn("near", F.lit(True))
    return flagged.join(near, [*SAMPLE, "variant_id"], "left").select(*SAMPLE, "variant_id", "read_count", (F.col("filter_delete") & F.coalesce("near", F.lit(False))).alias("filter_delete"))


def borderline_any(borderline: DataFrame) -> DataFrame:
    """A variant is borderline if it is in at least one sample."""
    return borderline.groupBy("variant_id").agg(F.bool_or("filter_delete").alias("chimera_borderline"))


STAGES = ("lfn", "min_replicate", "pcr_error", "chimera", "min_replicate2", "renkonen", "min_replicate3", "indel", "codon_stop", "average")


def filter_chain(counts: DataFrame, variants: DataFrame, cutoffs: filters.LfnCutoffs, specific: DataFrame | None = None, least_replicates: int = 2, pcr_most: float = 0.1, skew: float = 16, quantile: float = 0.9, code: int = 5, skip_indel: bool = False, skip_codon_stop: bool = False, since: str | None = None, until: str | None = None) -> dict[str, DataFrame]:
    """All filters in their order. Returns each stage's rows with filter_delete; "average" has the replicate averages of what is left.

    since: the stage to begin with, `counts` being what its predecessor has kept; until: the last stage. A stage
    sees the rows that the one before it has kept. Each stage is a table, as users audit it and later ones read it more than once.
    """
    run = STAGES[STAGES.index(since) if since else 0 : STAGES.index(until) + 1 if until else None]
    steps = {
        "lfn": lambda c: filters.lfn_all(c, cutoffs, specific),
        "min_replicate": lambda c: filters.min_replicate(c, least_replicates),
        "pcr_error": lambda c: pcr_error(c, variants, pcr_most),
        "chimera": lambda c: c.join(chimeras(c, variants, skew).select(*SAMPLE, "variant_id", "filter_delete"), [*SAMPLE, "variant_id"]),
        "min_replicate2": lambda c: filters.min_replicate(c, least_replicates),
        "renkonen": lambda c: filters.renkonen(c, quantile),
        "min_replicate3": lambda c: filters.min_replicate(c, least_replicates),
        "indel": lambda c: c.withColumn("filter_delete", F.lit(False)) if skip_indel else filters.indel(c, variants),
        "codon_stop": lambda c: c.withColumn("filter_delete", F.lit(False)) if skip_codon_stop else filters.codon_stop(c, variants, code),
    }
    out, kept = {}, counts
    for name in run:
        if name == "average":
            out[name] = replicate_average(kept)
            break
        out[name] = stored(steps[name](kept), name)
        kept = out[name].where("not filter_delete").drop("filter_delete")
    return out


def close_pairs(variants: DataFrame, identity: float = 0.97) -> DataFrame:
    """(a, b), a <> b both ways, of sequences whose edit distance is at most (1 - identity) of the longer one's length. Null and empty sequences take no part."""
    if not 0 < identity <= 1:
        raise ValueError("identity has to be over 0 and 1 at most")
    edits = F.floor((1 - F.lit(identity)) * F.col("len")).cast("int")
    return segment_pairs(variants, edits, F.floor(F.col("short") / identity).cast("int") + 1)


def pairs_within(variants: DataFrame, edits: int) -> DataFrame:
    """(a, b), a <> b both ways, of sequences at most `edits` edits apart. Null and empty sequences take no part."""
    return segment_pairs(variants, F.lit(edits), F.col("short") + edits)


def segment_pairs(variants: DataFrame, edits: Column, longest: Column) -> DataFrame:
    """Pairs (a, b) both ways whose edit distance is at most `edits`, a column of the longer one's length `len`; longest, a column of a length `short`, is what a longer one may have."""
    base = stored(variants.select("variant_id", "sequence", F.length("sequence").alias("len")), "sequences").where("len > 0")
    met = segment_candidates(base, edits, longest)
    for x in "ab":
        met = met.join(base.select(F.col("variant_id").alias(x), F.col("sequence").alias(f"s{x}")), x)
    most = met.withColumn("len", F.greatest(F.length("sa"), F.length("sb"))).withColumn("most", edits.cast("int"))
    near = stored(most.where(F.levenshtein("sa", "sb") <= F.col("most")).select("a", "b"), "close")
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def segment_candidates(base: DataFrame, edits: Column, longest: Column) -> DataFrame:
    """(a, b), a < b: pairs of which one has a segment of the other, no pair of segment_pairs() missing. base: variant_id, sequence, len.

    The longer sequence is cut into m segments of some ten characters, more than e + 1. e edits leave m - e of them whole, so of any e + 1 at least one: each sequence uses
    its e + 1 rarest, by how many windows hold their text. What is conserved in up to m - e - 1 segments brings nothing together.
    If the other is d shorter and the segment lies s places further on in it, |s| edits stand before the segment and |d + s| after it, so s is between
    -(e + d) / 2 and (e - d) / 2. Each sequence gives its windows at these places for each length that a longer one may have and some sequence
    has; hashes of segments and windows meet by an equi-join.
    """
    lengths = base.select("len").distinct().withColumn("e", edits.cast("int"))
    lengths = lengths.withColumn("m", F.expr("greatest(e + 1, least(len div 10, 4 * (e + 1)))")).withColumn("w", F.expr("cast(len div m as int)"))
    lengths = stored(lengths, "lengths")
    place = F.explode(F.expr("sequence(0, cast(m - 1 as int))")).alias("j")
    segments = base.join(lengths, "len").select(F.col("variant_id").alias("b"), "len", "e", "w", "sequence", place)
    segments = stored(segments.select("b", "len", "e", "j", F.expr("xxhash64(substr(sequence, j * w + 1, w))").alias("word")), "segments")
    longer = F.explode(F.sequence("short", longest)).alias("len")
    windows = base.withColumnRenamed("len", "short").select(F.col("variant_id").alias("a"), "sequence", "short", longer)
    windows = windows.join(lengths, "len").withColumn("d", F.col("len") - F.col("short")).where("d <= e")
    shifts = F.explode(F.expr("sequence(cast(-((e + d) div 2) as int), cast((e - d) div 2 as int))")).alias("s")
    windows = windows.select("a", "sequence", "short", "len", "w", "e", "d", place).select("a", "sequence", "short", "len", "w", "j", shifts)
    windows = windows.withColumn("at", F.col("j") * F.col("w") + 1 + F.col("s")).where("at >= 1 and at + w - 1 <= short")
    windows = windows.select("a", "len", "j", F.expr("xxhash64(substr(sequence, at, w))").alias("word"))
    often = windows.groupBy("len", "j", "word").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("b").orderBy("n", "j"))  # of one sequence's segments
    rarest = segments.join(often, ["len", "j", "word"]).withColumn("r", rank).where("r <= e + 1").select("b", "len", "j", "word")
    met = windows.join(rarest, ["len", "j", "word"]).where("a <> b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def greedy_clusters(sizes: DataFrame, close: DataFrame, largest: int = 1 << 20) -> DataFrame:
    """(variant_id, clusterid): greedy clustering by (size descending, id), as if variants were taken one after the other.

    sizes: variant_id, size; close: symmetric pairs (a, b). A variant is a centroid if no earlier centroid is close to it, else a
    member of the earliest such. Variants that no pairs connect have no bearing on each other, so connected components are found first and each of up to
    `largest` pairs is worked off in order in its own task. Only larger ones go through rounds: an undecided variant all of whose earlier neighbours are
    members becomes a centroid; its later neighbours become members once nothing undecided stands before their earliest centroid.
    """
    order = F.struct((-F.col("size")).alias("neg"), F.col("variant_id").alias("id"))
    nodes = stored(sizes.select("variant_id", order.alias("ord")), "cluster-nodes")
    edges = close.join(nodes.select(F.col("variant_id").alias("a"), F.col("ord").alias("oa")), "a").join(nodes.select(F.col("variant_id").alias("b"), F.col("ord").alias("ob")), "b")
    edges = stored(edges.where("oa < ob").select("a", "oa", "b", "ob").distinct(), "cluster-edges")  # a stands before b
    placed = stored(components(edges.select("a", "b")), "cluster-components")
    known = edges.join(placed.withColumnRenamed("node", "a"), "a")
    crowded = stored(known.groupBy("component").count().where(F.col("count") > largest).select("component"), "cluster-large")
    small = known.join(crowded, "component", "left_anti")

    def in_order(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["neg", "a"])
        cluster: dict[int, int] = {}
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):  # what stands before a has been dealt with
            if cluster.setdefault(a, a) == a:
                cluster.setdefault(b, a)
        for b in pdf["b"].tolist():
            cluster.setdefault(b, b)
        return pd.DataFrame(list(cluster.items()), columns=["variant_id", "clusterid"], dtype="int64")

    # components are dealt out whole, many small ones to a task; in order of their variants they do not disturb each other
    tasks = max(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), edges.count() // 200_000 + 1)
    dealt = small.select(F.pmod(F.xxhash64("component"), F.lit(tasks)).alias("task"), "a", F.col("oa.neg").alias("neg"), "b")
    told = dealt.groupBy("task").applyInPandas(in_order, "variant_id long, clusterid long")
    alone = nodes.select("variant_id").join(placed.select(F.col("node").alias("variant_id")), "variant_id", "left_anti").withColumn("clusterid", F.col("variant_id"))
    told = alone.unionByName(told)
    if crowded.isEmpty():
        return told
    wide = known.join(crowded, "component", "left_semi").select("a", "oa", "b")
    state = nodes.join(placed.join(crowded, "component", "left_semi").select(F.col("node").alias("variant_id")), "variant_id").withColumn("clusterid", F.lit(None).cast("long"))
    return told.unionByName(in_rounds(state, stored(wide, "cluster-edges")))


def in_rounds(state: DataFrame, edges: DataFrame) -> DataFrame:
    """greedy_clusters() of variants (variant_id, ord, clusterid still null) by rounds over edges (a, oa, b), a before b. Only whether any is undecided reaches the driver."""
    last = None
    while True:
        state = stored(state, "clusters")
        if last is not None:
            discard(last)
        if state.where("clusterid is null").isEmpty():
            return state.select("variant_id", "clusterid")
        seen = edges.join(state.select(F.col("variant_id").alias("a"), F.col("clusterid").alias("ca")), "a")
        # of each variant, the first neighbour before it that is a centroid or undecided
        first = seen.where("ca is null or ca = a").groupBy("b").agg(F.min(F.struct("oa", "a", "ca")).alias("f"))
        joined = state.join(first.withColumnRenamed("b", "variant_id"), "variant_id", "left")
        new = F.coalesce("clusterid", F.when(F.col("f").isNull(), F.col("variant_id")).when(F.col("f.ca").isNotNull(), F.col("f.a")))
        last, state = state, joined.select("variant_id", "ord", new.alias("clusterid"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.withColumn("clustersize", F.count(F.lit(1)).over(Window.partitionBy("clusterid")))


def overlapping_pairs(variants: DataFrame, least: int = 32) -> DataFrame:
    """(a, b) both ways of sequences that agree wherever they overlap, over `least` bases or the whole of a shorter one.

    An end of one that is the start of another meets it by an equi-join on length and hash, so sequences that merely begin
    alike never meet. What stands wholly inside another is found by its first `least` bases (or all of it, if shorter) among
    the other's inner windows. The texts confirm both.
    """
    # variants may be an aggregate of all reads: stored, and before the condition, which Spark would ask of each row below the aggregate
    own = stored(variants.select("variant_id", "sequence", F.length("sequence").alias("len")), "sequences").where("len > 0")
    ends = own.where(F.col("len") >= least).select("variant_id", "sequence", F.explode(F.sequence(F.lit(least), F.col("len"))).alias("n"))
    tails = ends.select(F.col("variant_id").alias("a"), "n", F.expr("xxhash64(right(sequence, n))").alias("word"))
    fronts = ends.select(F.col("variant_id").alias("b"), "n", F.expr("xxhash64(substr(sequence, 1, n))").alias("word"))
    joined = tails.join(fronts, ["n", "word"]).where("a <> b").select("a", "b", F.lit(0).alias("at"), "n")

    heads = own.select(F.col("variant_id").alias("b"), F.col("len").alias("n"), F.least("len", F.lit(least)).alias("w"), F.expr(f"xxhash64(substr(sequence, 1, least(len, {least})))").alias("word"))
    widths = F.broadcast(heads.select("w").distinct())  # at most `least` of them
    windows = own.select(F.col("variant_id").alias("a"), "sequence", "len").join(widths, F.col("w") <= F.col("len"))
    windows = windows.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("len") - F.col("w") + 1))).where((F.col("at") > 1) | (F.col("w") < least))
    windows = windows.select("a", "len", "w", "at", F.expr("xxhash64(substr(sequence, at, w))").alias("word"))
    inside = windows.join(heads, ["w", "word"]).where("a <> b and at + n - 1 <= len").select("a", "b", "at", "n")

    met = joined.unionByName(inside)
    for x in "ab":
        met = met.join(own.select(F.col("variant_id").alias(x), F.col("sequence").alias(f"s{x}")), x)
    text = F.when(F.col("at") == 0, F.expr("right(sa, n)")).otherwise(F.expr("substr(sa, at, n)"))
    agree = stored(met.where(text == F.expr("substr(sb, 1, n)")).select("a", "b"), "overlaps")
    return agree.unionByName(agree.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
