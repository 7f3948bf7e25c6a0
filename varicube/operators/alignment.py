"""Local similarity search: spaced seeds, chains of seeds by diagonal, and banded local alignments of a batch of pairs at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varicube.functions.storage import stored

# Scores of a match, a mismatch, the opening of a gap and each base in it.
MATCH, MISMATCH, OPEN, EXTEND = 2, -3, -5, -2
# Places of a seed that have to agree, ten of them each. At an identity of 70 % one of the two is found in 97 of 100 gapless alignments of 160 bases and in over 99 of 240.
SEEDS = ("1100101010101100101", "100110101110000111")
FIELD = 14  # bits of a length


def packed(score: int, matches: int, columns: int, queried: int) -> int:
    """A score as one number that also counts matches, columns and bases of the query, and whose order is by score, then more matches, then fewer columns.

    All four add up along an alignment, so a search for the largest number finds the best alignment with its identity and coverage, without a way back through it.
    """
    return (score << (3 * FIELD + 3)) + (matches << (2 * FIELD + 2)) - (columns << FIELD) + queried


def unpacked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    queried = x & ((1 << FIELD) - 1)
    x = x >> FIELD
    columns = -x & ((1 << (FIELD + 1)) - 1)
    x = (x + columns) >> (FIELD + 2)
    return x >> (FIELD + 1), x & ((1 << (FIELD + 1)) - 1), columns, queried


def codes(texts: list[str], width: int, at: int = 0, fill: int = 0) -> np.ndarray:
    """Bytes of each text in a row from place `at` on."""
    out = np.full((len(texts), width), fill, np.uint8)
    for i, t in enumerate(texts):
        out[i, at : at + len(t)] = np.frombuffer(t.encode("ascii", "replace"), np.uint8)
    return out


def local_matches(queries: list[str], targets: list[str], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """packed() value of the best local alignment of each pair within its band: place in the target less place in the query from low to high.

    One step a base of the query, on all pairs and places of the band at once. A gap in the query's direction comes from the row before; one along the row is a running
    maximum, as a gap never follows itself.
    """
    n, width = max(map(len, queries)), int((high - low).max()) + 1
    if n >= 1 << FIELD or width >= 1 << FIELD:
        raise ValueError(f"sequences of {1 << FIELD} bases or more cannot be aligned in one piece")
    q = codes(queries, n, fill=255)
    t = np.zeros((len(targets), n + width), np.uint8)
    for i, text in enumerate(targets):
        first = int(low[i])  # the target's place at the query's start and the band's edge
        piece = text[max(0, first) : max(0, first + n + width)]
        t[i, max(0, -first) : max(0, -first) + len(piece)] = np.frombuffer(piece.encode("ascii", "replace"), np.uint8)[: max(0, n + width - max(0, -first))]
    hit, miss = packed(MATCH, 1, 1, 1), packed(MISMATCH, 0, 1, 1)
    down, along, opened = packed(EXTEND, 0, 1, 1), packed(EXTEND, 0, 1, 0), packed(OPEN, 0, 0, 0)
    least = -(1 << 61)
    steps = along * np.arange(width)
    outside = np.arange(width) > (high - low)[:, None]
    scores = np.zeros((len(queries), width), np.int64)
    gap = np.full((len(queries), width), least)
    best = np.zeros(len(queries), np.int64)
    for i in range(n):
        same = t[:, i : i + width] == q[:, i, None]
        gap = np.maximum(scores + opened, gap)[:, 1:] + down
        gap = np.concatenate([gap, np.full((len(gap), 1), least)], 1)
        new = np.maximum(np.maximum(scores + np.where(same, hit, miss), gap), 0)
        new[outside] = 0
        run = np.maximum.accumulate(new - steps, 1)
        new[:, 1:] = np.maximum(new[:, 1:], run[:, :-1] + steps[1:] + opened)
        new[outside] = 0
        np.maximum(best, new.max(1), out=best)
        scores = new
    return best


def seed_words(df: DataFrame, key: str, pattern: str, number: int) -> DataFrame:
    """(key, pos, word): a hash of the bases that the pattern takes at each place of a sequence."""
    runs, at = [], 0
    for piece in pattern.replace("10", "1 0").replace("01", "0 1").split():
        if piece[0] == "1":
            runs.append(f"substr(sequence, pos + {at}, {len(piece)})")
        at += len(piece)
    starts = F.when(F.length("sequence") >= len(pattern), F.sequence(F.lit(1), F.length("sequence") - len(pattern) + 1))
    placed = df.select(key, "sequence", F.explode(starts).alias("pos"))
    return placed.select(key, "pos", F.expr(f"xxhash64({number}, concat({', '.join(runs)}))").alias("word"))


def clean(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.upper("sequence").alias("sequence")).where("sequence <> ''")


def seed_hits(queries: DataFrame, targets: DataFrame, crowd: int, share: float, patterns=SEEDS) -> DataFrame:
    """(variant_id, target_id, band): pairs that share a seed, with the diagonals (in sixteens) on which they do.

    A word that over `crowd` places of the targets hold is used by a query only as far as it needs it to have `share` of its places in use, the rarer ones first.
    So what all sequences have in common brings none of them together unless a query has little else.
    """
    hits = None
    for number, pattern in enumerate(patterns):
        there = seed_words(targets, "target_id", pattern, number)
        often = there.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd)
        asked = seed_words(queries, "variant_id", pattern, number).join(often, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        own = Window.partitionBy("variant_id")
        rank = F.row_number().over(own.orderBy("n", F.xxhash64("word", "pos")))  # of one sequence's places
        asked = asked.withColumn("rank", rank).withColumn("all", F.count(F.lit(1)).over(own)).where((F.col("n") == 0) | (F.col("rank") <= F.ceil(F.col("all") * share)))
        met = asked.select("variant_id", F.col("pos").alias("at"), "word").join(there, "word")
        met = met.select("variant_id", "target_id", F.floor((F.col("pos") - F.col("at")) / 16).cast("int").alias("band")).distinct()
        hits = met if hits is None else hits.unionByName(met)
    return hits


def chains(bands: list[int], reach: int) -> list[tuple[int, int]]:
    """Ranges of diagonals around seeds; those whose reach overlaps are one."""
    out: list[list[int]] = []
    for b in sorted(bands):
        low, high = 16 * b - reach, 16 * b + 15 + reach
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def similar_targets(queries: DataFrame, targets: DataFrame, identity: float = 70, coverage: float = 80, crowd: int = 1000, share: float = 0.5, patterns=SEEDS) -> DataFrame:
    """(variant_id, target_id, identity, coverage) of the best local alignment of each query and target, if it reaches both thresholds in per cent.

    queries: variant_id, sequence; targets: target_id, sequence. Affine gaps. identity is matches by columns of the alignment, coverage the bases of the query in it by all
    of the query's; of alignments with equal scores the one of more matches, then of fewer columns, counts. Pairs are aligned within a band around the
    diagonals of the seeds (see seed_hits) that is as wide as gaps at this identity can carry an alignment, so a query that lies inside a long target is
    found and only pairs without a common seed are missed. Null and empty sequences take no part; letters are compared without case; a key that stands
    for several sequences has its best alignment.
    """
    # each is read several times and may be an aggregate: stored before the condition of clean(), which Spark would ask of each row below the aggregate
    q, t = (clean(stored(df.select(key, "sequence"), label), key) for df, key, label in ((queries, "variant_id", "queries"), (targets, "target_id", "targets")))
    hits = seed_hits(q, t, crowd, share, patterns).groupBy("variant_id", "target_id").agg(F.collect_set("band").alias("bands"))  # as many as a target has sixteens
    pairs = hits.join(q.withColumnRenamed("sequence", "query"), "variant_id").join(t.withColumnRenamed("sequence", "target"), "target_id")

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                tasks = []
                for i, (query, bands) in enumerate(zip(part["query"], part["bands"])):
                    reach = int(np.ceil(len(query) * (100 - identity) / max(identity, 1)))
                    tasks += [(len(query), high - low, i, low, high) for low, high in chains(list(bands), reach)]
                tasks.sort()  # alike in size, so that a batch wastes little
                best = np.zeros(len(part), np.int64)
                query, target = part["query"].tolist(), part["target"].tolist()
                while tasks:
                    room = max(1, (1 << 20) // (tasks[-1][1] + 1))
                    some, tasks = tasks[-room:], tasks[:-room]
                    rows = [x[2] for x in some]
                    found = local_matches([query[i] for i in rows], [target[i] for i in rows], np.array([x[3] for x in some]), np.array([x[4] for x in some]))
                    np.maximum.at(best, rows, found)
                _, matches, columns, queried = unpacked(best)
                out = part[["variant_id", "target_id"]].assign(identity=matches * 100.0 / np.maximum(columns, 1), coverage=queried * 100.0 / part["query"].str.len(), best=best)
                yield out[(out["identity"] >= identity) & (out["coverage"] >= coverage)]

    kinds = dict(queries.dtypes)["variant_id"], dict(targets.dtypes)["target_id"]
    found = pairs.select("variant_id", "target_id", "query", "target", "bands").mapInPandas(run, f"variant_id {kinds[0]}, target_id {kinds[1]}, identity double, coverage double, best long")
    best = found.groupBy("variant_id", "target_id").agg(F.max_by(F.struct("identity", "coverage"), "best").alias("b"))
    return best.select("variant_id", "target_id", "b.identity", "b.coverage")
