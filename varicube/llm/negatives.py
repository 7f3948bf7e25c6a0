"""Hard negatives: exact scores of anchors against all rows, with bounds carried along a spanning tree of the anchors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varicube.llm.common import save, shuffle_partitions, sliced
from varicube.llm.vectors import cross_polytope


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length) of a minimum spanning tree of the rows by Euclidean distance; order has parents before children, and the first row's parent is -1."""
    n = len(x)
    order, parent, near = np.empty(n, np.int64), np.full(n, -1), np.full(n, np.inf)
    if n:
        near[0] = 0
    done = np.zeros(n, bool)
    length = np.zeros(n)
    for k in range(n):
        i = int(np.argmin(np.where(done, np.inf, near)))
        order[k], length[i], done[i] = i, (near[i] if k else 0.0), True
        far = np.sqrt(((x - x[i]) ** 2).sum(1))
        closer = ~done & (far < near)
        near[closer], parent[closer] = far[closer], i
    parent[order[:1]] = -1
    return order, parent, length


def exact_kind(widest: int, largest: int) -> type:
    """float64 where all sums of products are whole numbers that it holds, else 64-bit integers; an error where these are too small."""
    bound = widest * largest * largest
    if bound >= 1 << 62:
        raise OverflowError("scores may exceed 64 bits")
    return np.float64 if bound < 1 << 52 else np.int64


def walked(anchors: np.ndarray, parent: np.ndarray, length: np.ndarray, rows: np.ndarray, sizes: np.ndarray, wanted):
    """(anchor, rows scored, their scores) for each anchor, parents first.

    An anchor's score of a row is its parent's, give or take the length of the edge times the row's norm. wanted(anchor, low, high) says which rows these bounds
    do not settle; those are scored exactly, all others pass their bounds on. The root has no bounds, so all its rows are open.
    """
    low, high, last = {}, {}, {}
    for i, p in enumerate(parent):
        if p >= 0:
            last[int(p)] = i
    for i in range(len(anchors)):
        p = int(parent[i])
        if p < 0:
            a, b = np.full(len(rows), -np.inf), np.full(len(rows), np.inf)
        else:
            reach = length[i] * sizes * (1 + 1e-12) + 1e-6 * (1 + sizes)
            a, b = low[p] - reach, high[p] + reach
        open_ = np.flatnonzero(wanted(i, a, b))
        scores = rows[open_] @ anchors[i] if 2 * len(open_) < len(rows) else (rows @ anchors[i])[open_]
        if i in last:
            a[open_], b[open_] = scores, scores
            low[i], high[i] = a, b
        if p >= 0 and last[p] == i:
            del low[p], high[p]
        yield i, open_, scores.astype(np.int64)


def first_rows(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def kth_largest(x: np.ndarray, k: int) -> float:
    return np.partition(x, len(x) - k)[len(x) - k] if len(x) >= k else -np.inf


def blocks_of(anchors: DataFrame, width: int, size: int) -> tuple[DataFrame, int]:
    """`anchors` with a block number, and the number of blocks: some `size` each, near ones together as far as one hash tells.

    The nearest vertex of a rotated cross-polytope is one of 2 * width; only the numbers of anchors by vertex come to the driver. A vertex of many anchors is cut
    by a hash of the row, small ones share a block.
    """

    def run(batches):
        for pdf in sliced(batches, 4096):
            x = np.zeros((len(pdf), width))
            for i, v in enumerate(pdf["weights"]):
                x[i, : len(v)] = v
            x /= np.maximum(np.abs(x).max(1, keepdims=True), 1)
            yield pdf.assign(vertex=cross_polytope(x, 7, 1, 1, 1)[:, 0, 0])

    hashed = save(anchors.mapInPandas(run, "anchor long, vec_id long, label long, weights array<long>, vertex long"), "anchors")
    numbers, blocks, room = [], 0, 0
    for vertex, n in sorted(map(tuple, hashed.groupBy("vertex").count().collect())):
        cuts = -(-n // size)
        if cuts > 1 or n > room:
            blocks, room = blocks + cuts, size * (cuts == 1)
        numbers.append((vertex, blocks - cuts, cuts))
        room = max(0, room - n)
    table = hashed.sparkSession.createDataFrame(numbers, "vertex long, first long, cuts long")
    cut = F.pmod(F.xxhash64("anchor"), F.col("cuts"))
    return hashed.join(F.broadcast(table), "vertex").select("anchor", "vec_id", "label", "weights", (F.col("first") + cut).alias("block")), blocks  # 2 * width rows at most


def hard_negatives(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, size: int = 1024, block: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor's positives and their hard negatives.

    rows: vec_id, label, weights (array<long>; a shorter one is padded with zeros). is_anchor: a condition on rows. A row's score is its inner product with the anchor.
    An anchor's positives are the `positives` highest other rows of its label; a positive's negatives are the `negatives` highest rows of other labels whose
    score is from `least` to `most` per cent of the positive's. Ties go to the smaller vec_id. Rows with a null id, label or weights take no part. An anchor never
    meets rows of its own vec_id. Of repeated rows each counts, and each repeated anchor has results of its own. An empty table gives an empty result; weights so large that a score might not fit raise an error.

    Each block of anchors has a minimum spanning tree. Every block of anchors meets every block of rows in one task, which walks the tree: a child's score
    lies within edge length times row norm of its parent's, so rows whose bounds miss all windows of a child are never scored for it. The first pass finds
    positives (the window is open above, and begins at the k-th best lower bound), the second their negatives. Nothing is approximate.
    """
    spark = rows.sparkSession
    clean = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "weights").where("vec_id is not null and label is not null and weights is not null and size(weights) > 0")
    clean = save(clean, "rows")
    n, width, largest = clean.agg(F.count(F.lit(1)), F.max(F.size("weights")), F.max(F.greatest(F.array_max("weights"), -F.array_min("weights")))).first()
    fields = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], fields)
    width2 = 1 << max(1, math.ceil(math.log2(max(2, width))))
    kind = exact_kind(width, largest)
    narrow = np.int16 if largest < 1 << 15 else np.int64

    def matrix(column) -> np.ndarray:
        out = np.zeros((len(column), width), np.int64)
        for i, v in enumerate(column):
            out[i, : len(v)] = v
        return out

    def planted(pdf: pd.DataFrame) -> pd.DataFrame:
        x = matrix(pdf["weights"])
        order, parent, length = spanning_tree(x.astype(float))
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        up = np.where(parent < 0, -1, place[parent])
        return pd.DataFrame({"anchor": pdf["anchor"], "vec_id": pdf["vec_id"], "label": pdf["label"], "vector": [v.tobytes() for v in x.astype(narrow)], "block": pdf["block"], "place": place, "up": up, "edge": length})

    marked = save(clean.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()).select("anchor", "vec_id", "label", "weights"), "marked")
    # a block has about `size` anchors by a hash, so no group is unbounded
    dealt, blocks = blocks_of(marked, width2, size)
    if not blocks:
        return spark.createDataFrame([], fields)
    trees = save(dealt.groupBy("block").applyInPandas(planted, "anchor long, vec_id long, label long, vector binary, block long, place long, up long, edge double"), "trees")

    def vectors(batches):
        for pdf in sliced(batches, 4096):
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "vector": [v.tobytes() for v in matrix(pdf["weights"]).astype(narrow)]})

    shares = max(1, -(-n // block))
    thin = save(clean.mapInPandas(vectors, "vec_id long, label long, vector binary").withColumn("share", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shares))), "vectors")
    # every block of anchors meets every share of the rows; -1 marks a row that is no anchor
    none, no_scores = F.lit(-1).cast("long"), F.lit(None).cast("array<long>")
    candidates = thin.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "share", none.alias("anchor"), "vec_id", "label", "vector", none.alias("place"), none.alias("up"), F.lit(0.0).alias("edge"), no_scores.alias("scores"))

    def met(anchors: DataFrame) -> DataFrame:
        dealt = anchors.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
        both = candidates.unionByName(dealt.select(*candidates.columns))
        return both.repartition(max(shuffle_partitions(spark), min(shares * blocks, 10_000)), "block", "share").groupBy("block", "share")

    def sides(pdf: pd.DataFrame):
        own = pdf["place"] >= 0
        a, c = pdf[own].sort_values("place"), pdf[~own]
        x, y = (np.frombuffer(b"".join(d["vector"]), narrow).reshape(len(d), width).astype(kind) for d in (a, c))
        return a, x, c["vec_id"].to_numpy(np.int64), c["label"].to_numpy(np.int64), y

    def in_tiles(pdf: pd.DataFrame, wanted_for, keep):
        """keep(anchor, ids, labels, scores of the rows scored, open rows' places) over the rows, some at a time, so that bounds take little memory."""
        a, x, ids, labels, y = sides(pdf)
        up, edge = a["up"].to_numpy(np.int64), a["edge"].to_numpy(float)
        for at in range(0, len(ids), 2048):
            part = slice(at, at + 2048)
            rows_ = np.ascontiguousarray(y[part])
            sizes = np.sqrt((rows_.astype(float) ** 2).sum(1))
            for i, open_, scores in walked(x, up, edge, rows_, sizes, wanted_for(a, ids[part], labels[part])):
                keep(i, ids[part][open_], scores)
        return a

    def find_positives(pdf: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, list] = {}

        def wanted_for(a, ids, labels):
            vec, label = a["vec_id"].to_numpy(np.int64), a["label"].to_numpy(np.int64)

            def wanted(i, low, high):
                same = (labels == label[i]) & (ids != vec[i])
                return same & (high >= kth_largest(low[same], positives))

            return wanted

        a = in_tiles(pdf, wanted_for, lambda i, ids, scores: found.setdefault(i, []).append((ids, scores)))
        anchor, out = a["anchor"].to_numpy(np.int64), []
        for i, parts in found.items():
            ids, scores = (np.concatenate(x) for x in zip(*parts))
            best = first_rows(ids, scores, positives)
            out.append(pd.DataFrame({"anchor": anchor[i], "vec_id": ids[best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "vec_id": [], "score": []}, dtype="int64")

    first = met(trees.withColumn("scores", no_scores)).applyInPandas(lambda pdf: find_positives(pdf), "anchor long, vec_id long, score long")
    ranked = first.withColumn("positive", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id"))).where(F.col("positive") <= positives)
    chosen = save(ranked, "positives")
    scores = chosen.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("positive", "score"))), lambda s: s["score"]).alias("scores"))  # `positives` of them

    def windows(score: int) -> tuple[int, int]:
        """Whole numbers from least to most per cent of a score."""
        return -(-least * score // 100), most * score // 100

    def find_negatives(pdf: pd.DataFrame) -> pd.DataFrame:
        found: dict[tuple[int, int], list] = {}
        spans: list[list[tuple[int, int]]] = []

        def wanted_for(a, ids, labels):
            label, vec = a["label"].to_numpy(np.int64), a["vec_id"].to_numpy(np.int64)
            if not spans:
                spans.extend([windows(int(s)) for s in scores_] if scores_ is not None else [] for scores_ in a["scores"])

            def wanted(i, low, high):
                other = (labels != label[i]) & (ids != vec[i])
                need = np.zeros(len(ids), bool)
                for lo, hi in spans[i]:
                    if lo <= hi:
                        inside = other & (low >= lo) & (high <= hi)  # rows that are surely in the window
                        need |= (low <= hi) & (high >= max(lo, kth_largest(low[inside], negatives)))
                return other & need

            return wanted

        def keep(i, ids, scores_):
            for k, (lo, hi) in enumerate(spans[i]):
                inside = np.flatnonzero((scores_ >= lo) & (scores_ <= hi))
                if len(inside):
                    best = inside[first_rows(ids[inside], scores_[inside], negatives)]
                    found.setdefault((i, k), []).append((ids[best], scores_[best]))

        a = in_tiles(pdf, wanted_for, keep)
        anchor, out = a["anchor"].to_numpy(np.int64), []
        for (i, k), parts in found.items():
            ids, s = (np.concatenate(x) for x in zip(*parts))
            best = first_rows(ids, s, negatives)
            out.append(pd.DataFrame({"anchor": anchor[i], "positive": k + 1, "negative_id": ids[best], "negative_score": s[best]}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "positive": [], "negative_id": [], "negative_score": []}, dtype="int64")

    second = met(trees.join(scores, "anchor", "left")).applyInPandas(lambda pdf: find_negatives(pdf), "anchor long, positive int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id")
    last = second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    told = last.join(chosen.select("anchor", "positive", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "positive"])
    named = told.join(trees.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
