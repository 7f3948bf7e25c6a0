"""Embeddings: near-duplicates by cross-polytope hashing, exact top-k by term-at-a-time accumulation."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varicube.llm.common import Forest, sliced, components, dealt_to, groups_for, in_blocks, pairs_within, save, shuffle_partitions


def finite(col: str = "embedding"):
    """True for a vector that is not null, not empty and has only finite components."""
    return F.coalesce((F.size(col) > 0) & F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def cross_polytope(x: np.ndarray, seed: int, tables: int, hashes: int, probes: int) -> np.ndarray:
    """(rows, tables, probes) bucket numbers; the first of each table is the row's own bucket.

    A hash rotates by three rounds of random signs and Hadamard transforms, then takes the coordinate of
    largest size with its sign: one of 2 * d vertices. The further probes swap one hash, or two, for its next best
    vertices, in order of what the swap costs in squared distance to the vertex.
    """
    n, d = x.shape
    rng = np.random.default_rng(seed)
    out = np.empty((n, tables, probes), np.int64)
    near = min(4, d)
    for t in range(tables):
        best, cost = np.empty((hashes, n, near), np.int64), np.empty((hashes, n, near))
        for h in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, :near]
            best[h] = 2 * top + (np.take_along_axis(y, top, 1) < 0)
            largest = np.take_along_axis(size, top, 1)
            cost[h] = largest[:, :1] - largest
        choices = np.stack(np.meshgrid(*[np.arange(near)] * hashes, indexing="ij"), -1).reshape(-1, hashes)
        choices = choices[(choices + 1).prod(1) <= probes]  # all others have at least `probes` choices before them
        total = sum(cost[h][:, choices[:, h]] for h in range(hashes))
        pick = np.argsort(total, axis=1, kind="stable")[:, :probes]
        code = np.zeros(pick.shape, np.int64)
        for h in range(hashes):
            code = code * (2 * d) + np.take_along_axis(best[h], choices[pick][:, :, h], 1)
        out[:, t, : pick.shape[1]] = code
        out[:, t, pick.shape[1] :] = code[:, :1]
    return out


def tables_for(width: int, hashes: int, probes: int, least: float, miss: float = 0.002, pairs: int = 2_000) -> int:
    """The tables for which a pair at cosine `least` meets in none with a probability of `miss`, by the share of random pairs that meet in one; 4 at least."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, pairs, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = least * a + math.sqrt(max(0.0, 1 - least**2)) * b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    a, b = cross_polytope(a, 5, 4, hashes, probes), cross_polytope(b, 5, 4, hashes, probes)
    meet = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).mean()
    return max(4, math.ceil(math.log(miss) / math.log(1 - min(0.999, max(1e-4, meet)))))


def padded(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def near_vectors(vectors: DataFrame, least: float = 0.9, tables: int | None = None, probes: int = 4, hashes: int | None = None, block: int = 512, seed: int = 11) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links (other rows with cosine >= least among the candidates), component_id, kept.

    Candidates are pairs of which one's own bucket is among the other's probes in some table; each is verified in double
    precision. Equal vectors are one node with a count. Vectors of different length are padded with zeros. A pair
    that meets in several buckets counts in the first only, which each task sees from the buckets in both rows. Large
    buckets are cut into pairs of blocks. Null, zero and non-finite vectors have no links and are their own component.
    A null vec_id counts as a link but never names a component. `hashes` grows with the number of distinct
    vectors, so that a bucket holds less than one unrelated one on average, and `tables` with `hashes`, so that the share of
    links at cosine `least` that is missed stays the same. A probe goes on only if its bucket is another row's own.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("embedding"))  # no -0.0
    valid = rows.where(finite()).where(F.exists("embedding", lambda x: x != 0.0))
    members = save(valid.withColumn("node", F.xxhash64("embedding")), "vectors")  # one key for equal vectors
    nodes = members.groupBy("embedding").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    nodes = save(nodes, "vector-nodes")
    n, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    width = 1 << max(1, math.ceil(math.log2(max(2, width or 2))))
    if hashes is None:
        hashes = max(1, math.ceil(math.log(8 * n) / math.log(2 * width))) if n > 32 else 1
    if tables is None:
        tables = tables_for(width, hashes, probes, least)
    code_type = np.int32 if (2 * width) ** hashes < 2**31 else np.int64
    real = np.float32 if dict(vectors.dtypes)["embedding"] == "array<float>" else np.float64  # no loss: the source's own width

    def hashed(batches):
        for pdf in sliced(batches, 5_000):
            x = padded(list(pdf["embedding"]), width)
            codes = cross_polytope(x / np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(1, keepdims=True), seed, tables, hashes, probes)
            yield pd.DataFrame({"node": pdf["node"], "copies": pdf["copies"], "vector": [v.tobytes() for v in x.astype(real)], "codes": [c.tobytes() for c in codes.astype(code_type)], "slots": list(codes.reshape(len(x), -1))})

    coded = save(nodes.select("node", "copies", "embedding").mapInPandas(hashed, "node long, copies long, vector binary, codes binary, slots array<long>"), "coded")
    light = coded.select("node", F.posexplode("slots").alias("k", "bucket")).select("node", F.floor(F.col("k") / probes).cast("int").alias("t"), "bucket", (F.col("k") % probes == 0).alias("own"))
    shared = light.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned")).where("n > 1 and owned").select("t", "bucket")
    kept = light.join(shared, ["t", "bucket"]).select("node", "t", "bucket").distinct()
    probed = kept.join(coded.drop("slots"), "node")
    met, total = in_blocks(probed, ["t", "bucket"], "node", block)
    groups = groups_for(spark, total, 20_000)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "bucket", "bi", "bj"], kind="stable")
        unit = pdf[["t", "bucket", "bi", "bj"]].to_numpy(np.int64)
        x = np.frombuffer(b"".join(pdf["vector"]), real).reshape(len(pdf), width).astype(float)
        codes = np.frombuffer(b"".join(pdf["codes"]), code_type).reshape(len(pdf), tables, probes)
        x = x / np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        node, copies, blk = pdf["node"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), pdf["blk"].to_numpy(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]).any(1)]))
        sizes = np.diff(np.append(starts, len(unit)))
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        for i, j in pairs_within(starts, sizes, 1 << 16):
            t, bucket = unit[i, 0], unit[i, 1]
            ok = (blk[i] != blk[j]) | (unit[i, 2] == unit[i, 3])
            ok &= (codes[i, t, 0] == bucket) | (codes[j, t, 0] == bucket)
            i, j, t, bucket = i[ok], j[ok], t[ok], bucket[ok]
            near = np.einsum("ij,ij->i", x[i], x[j]) >= least
            i, j, t, bucket = i[near], j[near], t[near], bucket[near]
            a, b = codes[i], codes[j]
            first = np.full((len(i), tables), np.iinfo(np.int64).max)  # the smallest bucket in which the pair meets, by table
            for s in range(tables):
                for own, other in ((a, b), (b, a)):
                    meets = (own[:, s, :1] == other[:, s]).any(1)
                    first[meets, s] = np.minimum(first[meets, s], own[meets, s, 0])
            where = (first < np.iinfo(np.int64).max).argmax(1)
            owner = (where == t) & (first[np.arange(len(i)), where] == bucket)
            i, j = i[owner], j[owner]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            forest.add(i, j)
        has = np.flatnonzero(links)
        return pd.DataFrame({"node": node[has], "n": links[has], "low": node[forest.label[has]]})

    found = save(met.groupBy(dealt_to(groups, "t", "bucket", "bi", "bj").alias("grp")).applyInPandas(lambda pdf: run(pdf), "node long, n long, low long"), "links")
    placed = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    by_node = nodes.select("node", "copies", "least_id").join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = by_node.groupBy("component").agg(F.min("least_id").alias("component_id"))
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    told = by_node.join(names, "component").join(links, "node", "left").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    good = members.select("vec_id", "node").join(told, "node").select("vec_id", "n_links", "component_id")
    bad = rows.where(~(finite() & F.exists("embedding", lambda x: x != 0.0))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def accumulated(q: np.ndarray, c: np.ndarray, tile: int = 128):
    """Scores of a block of queries against a block of candidates, some queries at a time, as (first query, (candidates, queries) array).

    Term at a time: each term's postings (the candidates with a weight) are scattered, times the queries' weights
    of the term, into a dense array of scores. 32-bit integers where no score can exceed them.
    """
    bound = (int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0))) * max(1, q.shape[1])
    if bound >= 1 << 63:
        raise OverflowError("scores may exceed 64 bits")
    kind = np.int32 if bound < 2**31 else np.int64
    q, c = q.astype(kind), c.astype(kind)
    postings = [np.flatnonzero(c[:, t]) for t in range(c.shape[1])]
    for at in range(0, len(q), tile):
        part = q[at : at + tile]
        scores, room = np.zeros((len(c), len(part)), kind), np.empty((len(c), len(part)), kind)
        for t in np.flatnonzero(part.any(0)):
            ids = postings[t]
            if len(ids) == len(c):
                np.multiply(c[:, t, None], part[None, :, t], out=room)
                scores += room
            elif len(ids):
                scores[ids] += c[ids, t, None] * part[None, :, t]
        yield at, scores


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = 4096) -> DataFrame:
    """Exhaustive search: (query_id, rank, vec_id, score) of each query's k highest inner products, ties to the smaller vec_id.

    Both frames have vec_id and weights (array<long>); a shorter array is padded with zeros. Every block of queries
    meets every block of candidates in one group, which returns k rows a query; a second selection merges them. A query
    never meets rows of its own vec_id. Null ids and null weights take no part; repeated candidate rows each count, and each repeated query row has
    its own places. Weights so large that a score might not fit in 64 bits raise an error.
    """
    spark = candidates.sparkSession
    sides = []
    for df in (queries, candidates):
        sides.append(save(df.select("vec_id", "weights").where("vec_id is not null and weights is not null").withColumn("row", F.monotonically_increasing_id()), "weights"))
    nq, nc = (-(-s.count() // block) for s in sides)
    if not nq or not nc:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dealt = []
    for side, (df, own, other) in enumerate(zip(sides, (nq, nc), (nc, nq))):
        blk = F.pmod(F.xxhash64("vec_id"), F.lit(own)).cast("int")
        df = df.select("vec_id", "weights", "row", F.lit(side).alias("side"), blk.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("other"))
        dealt.append(df.withColumns({"qb": F.col(("own", "other")[side]), "cb": F.col(("other", "own")[side])}).drop("own", "other"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        width = max(map(len, pdf["weights"]))
        parts = []
        for side in (0, 1):
            own = pdf[pdf["side"] == side]
            m = np.zeros((len(own), width), np.int64)
            for i, v in enumerate(own["weights"]):
                m[i, : len(v)] = v
            parts.append((own["vec_id"].to_numpy(np.int64), own["row"].to_numpy(np.int64), m))
        (qid, qrow, q), (cid, _, c) = parts
        out = []
        if len(qid) and len(cid):
            for at, scores in accumulated(q, c):
                ids = qid[at : at + scores.shape[1]]
                place = np.arange(len(cid))[:, None]
                own = cid[:, None] == ids[None, :]
                for col in range(scores.shape[1]):
                    s = scores[:, col].astype(np.int64)
                    pos = np.flatnonzero(~own[:, col]) if own[:, col].any() else place[:, 0]
                    s = s[pos]
                    if len(s) > k:
                        edge = np.partition(s, len(s) - k)[len(s) - k]
                        over, ties = np.flatnonzero(s > edge), np.flatnonzero(s == edge)
                        take = np.concatenate([over, ties[: k - len(over)]])  # rows stand by vec_id
                    else:
                        take = np.arange(len(s))
                    out.append(pd.DataFrame({"query_id": ids[col], "row": qrow[at + col], "vec_id": cid[pos[take]], "score": s[take]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []}, dtype="int64")

    pairs = dealt[0].unionByName(dealt[1]).repartition(max(shuffle_partitions(spark), min(nq * nc, 10_000)), "qb", "cb")
    best = pairs.groupBy("qb", "cb").applyInPandas(lambda pdf: run(pdf), "query_id long, row long, vec_id long, score long")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
