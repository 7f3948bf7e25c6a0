"""SimHash near-duplicates: a binary trie joined with itself under a Hamming error budget."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varicube.llm.common import Forest, components, dealt_to, groups_for, in_blocks, save, sliced, small_batches, unused

CHUNK = 1 << 16


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each k-word shingle of the ASCII-lower-cased text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([xxhash.xxh64_intdigest(line[s:e], 42) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """64 bits as a signed number; a bit is 1 if set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_key) per row: the SimHash and a hash of the lower-cased words.

    A text of fewer words than a shingle is one shingle; null, empty or blank text has fingerprint zero.
    """

    def run(batches):
        for pdf in sliced(batches):
            texts = pdf["text"]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "fp": np.array([simhash(shingle_hashes(t, words)) for t in texts], np.int64),
                "text_key": np.array([xxhash.xxh3_64_intdigest(b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split())) for t in texts], np.uint64).view(np.int64),
            })

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(run, "doc_id long, fp long, text_key long")


def allowed(budget: int, rings: int, depth: int) -> int:
    """The differing bits that a pair may have in its first `depth` bits.

    With one ring it is the whole budget. With more, the fingerprint is rotated by each multiple of 64 / rings
    bits: of any pair within the budget, some rotation spends at most its share in each of its prefixes of
    whole blocks (the cycle lemma), so each trie may prune by shares and together they miss nothing.
    """
    if rings == 1:
        return budget
    width = 64 // rings
    return budget * -(-depth // width) // rings


def trie_pairs(prints: np.ndarray, roots: np.ndarray, depth: int, budget: int, rings: int):
    """Pairs (i, j) of rows within the budget. prints: sorted within each root's ranges; roots: (alo, ahi, blo, bhi, diff) rows.

    Both sides walk down one bit at a time. A pair of nodes becomes up to four pairs of children, those that
    disagree in the bit add one to the difference, and a pair is dropped once it exceeds what its depth allows.
    A pair with few rows is compared directly. The frontier is cut when it grows, so memory is bounded.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, roots)]
    while stack:
        depth, front = stack.pop()
        if len(front) > 1 << 18:
            stack += [(depth, front[: len(front) // 2]), (depth, front[len(front) // 2 :])]
            continue
        alo, ahi, blo, bhi, diff = front.T
        few = ((ahi - alo) * (bhi - blo) <= 24) | (depth == 64)
        if few.any():
            yield from compared(prints, front[few], budget)
            front = front[~few]
            alo, ahi, blo, bhi, diff = front.T
        if not len(front):
            continue
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((prints >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)])
        c, most, same = ones[depth], allowed(budget, rings, depth + 1), alo == blo
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        kids = np.concatenate([
            np.stack([alo, amid, blo, bmid, diff], 1),
            np.stack([amid, ahi, bmid, bhi, diff], 1),
            np.stack([alo, amid, bmid, bhi, diff + 1], 1),
            np.stack([amid, ahi, blo, bmid, diff + 1], 1)[~same],
        ])
        kids = kids[(kids[:, 1] > kids[:, 0]) & (kids[:, 3] > kids[:, 2]) & (kids[:, 4] <= most)]
        kids = kids[(kids[:, 0] != kids[:, 2]) | (kids[:, 1] - kids[:, 0] > 1)]  # a single row with itself
        if len(kids):
            stack.append((depth + 1, kids))


def compared(prints: np.ndarray, front: np.ndarray, budget: int, most: int = 1 << 20):
    cells = (front[:, 1] - front[:, 0]) * (front[:, 3] - front[:, 2])
    cuts = np.concatenate([[0], np.cumsum(cells)])
    at = 0
    while at < len(front):
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + most, side="right")) - 1)
        alo, _, blo, bhi, _ = front[at:to].T
        n, wide = cells[at:to], bhi - blo
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w = np.repeat(wide, n)
        i, j = np.repeat(alo, n) + k // w, np.repeat(blo, n) + k % w
        near = (np.bitwise_count(prints[i] ^ prints[j]) <= budget) & ((np.repeat(alo != blo, n)) | (i < j))
        yield i[near], j[near]
        at = to


def close_fingerprints(prints: DataFrame, budget: int, rings: int = 1) -> DataFrame:
    """Edges (a, b) that connect the distinct values of `fp` just as all pairs at most `budget` bits apart do.

    Every value goes to the tasks of its own prefix and of each prefix within that depth's allowance; a task walks its pairs of subtries
    and returns a forest of the links found, at most one row a value. Prefixes have 8 bits, more with many values.
    """
    spark = prints.sparkSession
    fps = save(prints.select("fp").where("fp is not null").distinct(), "fps")
    n = fps.count()
    bits = min(16, max(8, math.ceil(math.log2(max(1, n / 50_000)))))  # subtries of some ten thousand values, whatever n
    masks = [m for m in range(1 << bits) if m.bit_count() <= allowed(budget, rings, bits)]
    groups = groups_for(spark, n * len(masks) * rings, 100_000)

    def turned(by: Column) -> Column:
        low = F.call_function("shiftrightunsigned", F.col("fp"), F.lit(64) - by)
        return F.call_function("shiftleft", F.col("fp"), by).bitwiseOR(F.when(by > 0, low).otherwise(F.lit(0).cast("long")))

    width = 64 // rings
    own = fps.withColumn("ring", F.explode(F.array(*[F.lit(r) for r in range(rings)]))).withColumn("print", turned(F.col("ring") * width))
    own = own.withColumn("p", F.shiftrightunsigned("print", 64 - bits)).withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    own = own.withColumn("q", F.col("p").bitwiseXOR(F.col("mask")))
    # the rotation, the smaller and the larger prefix: pairs of subtries are dealt out each on its own
    own = own.select(((F.col("ring") * (1 << bits) + F.least("p", "q")) * (1 << bits) + F.greatest("p", "q")).alias("pair"), "print")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        value, pair = pdf["print"].to_numpy(np.int64).view(np.uint64), pdf["pair"].to_numpy(np.int64)
        order = np.lexsort((value, pair))
        value, pair = value[order], pair[order]
        # ranges of rows with one pair and one prefix
        prefix, low, high = (value >> np.uint64(64 - bits)).astype(np.int64), (pair >> bits) & ((1 << bits) - 1), pair & ((1 << bits) - 1)
        starts = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (prefix[1:] != prefix[:-1])]))
        ends = np.append(starts[1:], len(pair))
        of, pre, low, high = pair[starts], prefix[starts], low[starts], high[starts]
        selfs = np.flatnonzero(low == high)
        other = np.flatnonzero((of[1:] == of[:-1]) & (pre[:-1] == low[:-1])) if len(of) > 1 else np.empty(0, int)
        roots = np.concatenate([
            np.stack([starts[selfs], ends[selfs], starts[selfs], ends[selfs], np.zeros(len(selfs), int)], 1),
            np.stack([starts[other], ends[other], starts[other + 1], ends[other + 1], np.bitwise_count(low[other] ^ high[other]).astype(int)], 1),
        ]).astype(np.int64)
        turn = ((pair >> (2 * bits)) * width).astype(np.uint64)
        back = np.where(turn > 0, (value >> turn) | (value << ((np.uint64(64) - turn) & np.uint64(63))), value).view(np.int64)
        own_values, place = np.unique(back, return_inverse=True)
        forest = Forest(len(own_values))
        for i, j in trie_pairs(value, roots, bits, budget, rings):
            forest.add(place[i], place[j])
        linked = np.flatnonzero(forest.label != np.arange(len(own_values)))
        return pd.DataFrame({"a": own_values[linked], "b": own_values[forest.label[linked]]})

    return own.groupBy(dealt_to(groups, "pair").alias("grp")).applyInPandas(lambda pdf: run(pdf), "a long, b long").where("a <> b")


def simhash_components(docs: DataFrame, words: int = 3, budget: int = 2, rings: int = 1) -> DataFrame:
    """One row per row of `docs`: doc_id, fp, component_id (the smallest doc_id reachable over links of at most `budget` bits).

    Copies are collapsed to distinct fingerprints first. Rows with a null doc_id have a fingerprint and belong
    to a component, but never name it; a component of null ids only has a null component_id. Repeated rows stay.
    """
    rows = save(fingerprints(docs, words).drop("text_key"), "prints")
    linked = components(close_fingerprints(rows, budget, rings)).select(F.col("node").alias("fp"), "component")
    placed = rows.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(names, "component").select("doc_id", "fp", "component_id")


def ordered(shingles: np.ndarray, late: np.ndarray) -> np.ndarray:
    """A set's shingles (63 bits of their hashes) in an order that all sets share: as signed numbers, those in `late` (sorted) after all others."""
    signed = shingles.view(np.int64)
    at = np.minimum(np.searchsorted(late, signed), max(0, len(late) - 1))
    last = late[at] == signed if len(late) else np.zeros(len(signed), bool)
    return np.sort(np.where(last, (shingles >> np.uint64(1)), (shingles >> np.uint64(1)) | np.uint64(1 << 63)).view(np.int64))


def head_size(n: int, similarity: float) -> int:
    """How many of a set's n shingles, in order, two sets of a Jaccard similarity of `similarity` cannot fail to share one of.

    Such sets share at least similarity * n of the n shingles of either, so the first n less that, and one more, cannot all be missing in the other.
    """
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def parities(shingles: np.ndarray) -> np.ndarray:
    """Bits of a set as signed numbers of 64 each: whether an odd number of its members falls on each. Four bits a member and more, as a power of two from 256 to 2,048.

    Members that two sets share cancel out, so the sets have at least as many members not in common as their bits differ. With few bits a member
    many of these cancel out too. The exclusive or of a sketch's halves is the set's sketch of half the bits.
    """
    bits = 1 << min(11, max(8, (4 * len(shingles) - 1).bit_length()))
    return np.packbits(np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).view(">i8").astype(np.int64)


class Parities:
    """The parities() of a task's sets, of any widths. A pair is compared in the narrower one's width."""

    def __init__(self, parity: list[np.ndarray]):
        self.widths = np.array([len(x) for x in parity], np.int64)
        width = int(self.widths.max(initial=1))
        rows = np.zeros((len(parity), width), np.uint64)  # bits of a negative number would be counted by its size
        for w in np.unique(self.widths):
            of = np.flatnonzero(self.widths == w)
            rows[of, :w] = np.stack([parity[k] for k in of]).astype(np.int64).view(np.uint64)
        self.at = {width: rows}
        while width > self.widths.min(initial=width):
            width //= 2
            rows = rows[:, :width] ^ rows[:, width:]  # the upper half of a narrower one is zero
            self.at[width] = rows

    def differ(self, i: np.ndarray, j: np.ndarray, rows: int = 1 << 13) -> np.ndarray:
        """In how many bits the sets of each pair differ."""
        narrow, out = np.minimum(self.widths[i], self.widths[j]), np.zeros(len(i), np.int64)
        for w in np.unique(narrow):
            of = np.flatnonzero(narrow == w)
            for k in range(0, len(of), rows):
                x = of[k : k + rows]
                out[x] = np.bitwise_count(self.at[w][i[x]] ^ self.at[w][j[x]]).sum(1, dtype=np.int64)
        return out


def nearest(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) are the nearest of one of their ends, by `far` and then by the other end."""
    ends, others, k = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((others, far[k], ends))
    return np.unique(k[order[np.diff(ends[order], prepend=-1) != 0]])


def sketches(docs: DataFrame, words: int, similarity: float, late: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, fp, text_key, n, parity, head, last) per row: a hash of the text, the SimHash over distinct shingles, a hash of the lower-cased words,
    the number of distinct shingles, their parities(), the first head_size() of them in order and the last of these."""

    def run(batches):
        for pdf in sliced(batches):
            sets = [np.unique(shingle_hashes(t, words)) for t in pdf["text"]]
            heads = [ordered(x, late)[: head_size(len(x), similarity)] for x in sets]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "text_hash": pdf["text_hash"],
                "fp": np.array([simhash(x) for x in sets], np.int64),
                "text_key": np.array([xxhash.xxh3_64_intdigest(b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split())) for t in pdf["text"]], np.uint64).view(np.int64),
                "n": np.array([len(x) for x in sets], np.int64),
                "parity": [parities(x) for x in sets],
                "head": heads,
                "last": np.array([x[-1] if len(x) else 0 for x in heads], np.int64),
            })

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").where("doc_id is not null")
    return source.mapInPandas(run, "doc_id long, text_hash long, fp long, text_key long, n long, parity array<long>, head array<long>, last long")


def common_shingles(docs: DataFrame, words: int, crowd: int) -> np.ndarray:
    """The shingles, at most 500,000, that some `crowd` texts hold by a count in a sample of the documents, sorted. They only serve to order a set's shingles."""
    one_in = max(1, crowd // 8)

    def run(batches):
        for pdf in sliced(batches):
            sets = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in pdf["text"]]
            yield pd.DataFrame({"shingle": np.concatenate([*sets, np.empty(0, np.int64)])})

    some = docs.where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(one_in)) == 0)
    counted = some.select("text").mapInPandas(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("c"))
    with small_batches(docs.sparkSession):
        most = counted.where(F.col("c") > crowd // one_in).orderBy(F.desc("c"), "shingle").limit(500_000).select("shingle").toPandas()
    return np.sort(most["shingle"].to_numpy(np.int64))


def shingle_sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the nodes in `pairs`."""

    def shingles(batches):
        for pdf in sliced(batches):
            yield pd.DataFrame({"node": pdf["node"], "shingles": [np.unique(shingle_hashes(t, words)).view(np.int64) for t in pdf["text"]]})

    wanted = save(nodes.join(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "node", "left_semi").select("node", "rep.doc_id", "rep.text_hash"), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= 10_000 else wanted  # a few nodes go to the documents, so that no text is shuffled for them
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["node"])
    with small_batches(docs.sparkSession):
        return save(texts.select("node", "text").mapInPandas(shingles, "node long, shingles array<long>"), "shingles")


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows (a, b) of `pairs` of nodes whose sets have a Jaccard similarity of `similarity` or more."""
    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = met.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))
    return both.where(F.col("both") >= F.lit(similarity) * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def held_open(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(family, node, component, n, parity, shingles, places): a node once for a family, with its shingles of that family that nodes of other components hold too.

    rows: shingle, node, component, n, place, family; nodes: node, parity.
    """
    open_ = rows.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("shingle")
    held = rows.join(open_, "shingle").groupBy("family", "node").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.collect_list(F.struct("shingle", "place")).alias("held"))
    held = held.join(nodes.select("node", "parity"), "node").select("family", "node", "component", "n", "parity", F.col("held.shingle").alias("shingles"), F.col("held.place").alias("places"))
    return save(held, "open")


def still_open(held: DataFrame, placed: DataFrame) -> DataFrame:
    """The held_open() families that have nodes of several components by `placed` (node, component), with these."""
    now = held.drop("component").join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = now.groupBy("family").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("family")
    return save(now.join(apart, "family").select(held.columns), "open")


def pairs_in_families(held: DataFrame, similarity: float, block: int, only_nearest: bool = False) -> DataFrame:
    """(a, b, c, far): pairs of nodes of different components that share c shingles of one family or more and may still be similar by size, place and parities.

    held: as by held_open(). A shingle is of one family, and a pair may have a row for each family that it meets in. A family
    should be a holder of all its shingles: then shingles with the same holders meet in one task, which counts them for a pair at once, and no node brings more
    shingles into a family than that holder's head has. A shingle whose nodes are all of one component forms no pairs. Sets of na and nb members
    are similar if at most (1 - similarity) / (1 + similarity) of na + nb are not in common, so a pair whose parities() differ in more bits never leaves its task.
    far: the share of na + nb in which they differ. With `only_nearest` a task returns for each of its nodes no pair but the nearest, so that a large group has no more
    rows than nodes; c is not the whole number then.
    """
    met, total = in_blocks(held, ["family"], "node", max(1, block // 4))  # a row brings several shingles
    groups = groups_for(held.sparkSession, total, 5_000)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, named, node = np.unique(pdf["node"].to_numpy(np.int64), return_index=True, return_inverse=True)
        comp, n, blk = (pdf[c].to_numpy(np.int64) for c in ("component", "n", "blk"))
        unit, whole = pdf.groupby(["family", "bi", "bj"]).ngroup().to_numpy(), (pdf["bi"] == pdf["bj"]).to_numpy()
        parity, sizes = Parities([pdf["parity"].iloc[k] for k in named]), n[named]
        of = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["shingles"]])
        shingle, place = (np.concatenate(list(pdf[c])).astype(np.int64) for c in ("shingles", "places"))
        order = np.lexsort((comp[of], shingle, unit[of]))
        of, shingle, place = of[order], shingle[order], place[order]
        new = np.concatenate([[True], (unit[of[1:]] != unit[of[:-1]]) | (shingle[1:] != shingle[:-1])])
        turn = np.concatenate([[True], new[1:] | (comp[of[1:]] != comp[of[:-1]])])
        ends = [np.append(np.flatnonzero(x)[1:], len(x))[np.cumsum(x) - 1] for x in (new, turn)]
        partners = ends[0] - ends[1]  # only rows of the shingle's later components
        upto, at, found, counts, fars = np.cumsum(partners), 0, [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]

        def summed():
            keys, one, back = np.unique(np.concatenate(found), return_index=True, return_inverse=True)
            c, far = np.bincount(back, np.concatenate(counts), len(keys)).astype(np.int64), np.concatenate(fars)[one]
            if only_nearest:
                least = nearest(keys // len(names), keys % len(names), far)
                keys, c, far = keys[least], c[least], far[least]
            return [keys], [c], [far]

        while at < len(of):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 18), side="right")))
            k = partners[at:to]
            i = np.repeat(np.arange(at, to), k)
            j = ends[1][i] + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
            pi, pj, i, j = place[i], place[j], of[i], of[j]
            most = np.minimum(pi, pj) + np.minimum(n[i] - pi, n[j] - pj)  # shared shingles at most
            ok = ((blk[i] != blk[j]) | whole[i]) & (node[i] != node[j])
            ok &= np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
            ok &= most >= similarity * (n[i] + n[j] - most) - 1e-9
            i, j = node[i[ok]], node[j[ok]]
            keys, c = np.unique(np.minimum(i, j) * len(names) + np.maximum(i, j), return_counts=True)
            i, j = keys // len(names), keys % len(names)
            odd, both = parity.differ(i, j), sizes[i] + sizes[j]
            ok = odd <= (1 - similarity) / (1 + similarity) * both + 1e-9
            found.append(keys[ok])
            counts.append(c[ok])
            fars.append(odd[ok] / both[ok])
            if sum(map(len, found[1:])) > max(1 << 20, len(found[0])):
                found, counts, fars = summed()
            at = to
        (keys,), (c,), (far,) = summed()
        return pd.DataFrame({"a": names[keys // len(names)], "b": names[keys % len(names)], "c": c, "far": far})

    return met.groupBy(dealt_to(groups, "family", "bi", "bj").alias("grp")).applyInPandas(lambda pdf: run(pdf), "a long, b long, c long, far double")


def pairs_by_family(rows: DataFrame, nodes: DataFrame, similarity: float, block: int) -> DataFrame:
    """pairs_in_families() of all shingles. rows: shingle, node, component, n, place, family; nodes: node, parity."""
    return pairs_in_families(held_open(rows, nodes), similarity, block)


def nearest_pairs(held: DataFrame, similarity: float, block: int) -> DataFrame:
    """(a, b): for each node of `held` the likeliest of the pairs_in_families() that it is in, as the lower or as the higher end."""
    near = save(pairs_in_families(held, similarity, block, only_nearest=True), "near")
    sides = near.groupBy("a").agg(F.min(F.struct("far", "b")).alias("x")).select("a", "x.b"), near.groupBy("b").agg(F.min(F.struct("far", "a")).alias("x")).select("x.a", "b")
    return save(sides[0].unionByName(sides[1]).distinct(), "pairs")


def once_each(pairs: DataFrame) -> DataFrame:
    """(a, b, c): the pairs of pairs_in_families(), once each, with all shingles of their heads that they share."""
    return pairs.groupBy("a", "b").agg(F.sum("c").alias("c"))


def apart_pairs(rows: DataFrame, nodes: DataFrame, similarity: float, block: int) -> DataFrame:
    """(a, b, c): the pairs of pairs_by_family(), once each."""
    return once_each(pairs_by_family(rows, nodes, similarity, block))


def may_be_similar(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The rows (a, b) of `pairs` (a, b, c) for which c shared shingles of the heads leave a similarity of `similarity` possible.

    Of the two heads take the one that ends first in the order. All that its set shares with the other up to there is shared by the
    heads too, so the sets share at most c and the rest of that set.
    """
    sides = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("last").alias(f"last_{x}")) for x in ("a", "b")]
    tail = {x: F.ceil(F.lit(similarity) * F.col(f"n{x}") - 1e-9) - 1 for x in ("a", "b")}
    most = F.col("c") + F.when(F.col("last_a") <= F.col("last_b"), tail["a"]).otherwise(tail["b"])
    sized = pairs.join(sides[0], "a").join(sides[1], "b").withColumn("most", most)
    return sized.where(F.col("most") >= F.lit(similarity) * (F.col("na") + F.col("nb") - F.col("most")) - 1e-9).select("a", "b", "c")


def near_duplicate_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, budget: int = 2, rings: int = 1, block: int = 256, crowd: int = 40, orders: int = 3) -> DataFrame:
    """(doc_id, text_hash, group_id, stays) of documents whose word shingles have a Jaccard similarity of `similarity` or more, linked transitively.

    Candidates are pairs that share a shingle of their heads (see head_size()), which no similar pair fails to do. First each text is compared with
    the first of the holders of its head's shingles by `orders` hashes, if they share many, and with those the trie join of SimHashes links to it; components of
    verified links follow. Then each text is compared with the likeliest candidate of another component, and at last all pairs of candidates whose components still differ are, so nothing is missed and a large group is not compared
    all with all. Before texts are compared, pairs go whose parities() differ too much, and those that share too few of the heads' shingles (see may_be_similar()). Shingles
    that over `crowd` texts or so hold, by a sample, are put last in every set's order beforehand; the order has no bearing on the result. Equal texts
    form one node. Texts without words are linked only with each other. Null ids take no part. Rows that share a doc_id but not the text are documents of
    their own; rows that share both stay or go together. group_id is the smallest doc_id of a group, `stays` marks its row; documents alone in their group have no row.
    """
    late = common_shingles(docs, words, crowd)
    with small_batches(docs.sparkSession):
        rows = save(sketches(docs, words, similarity, late), "prints")
    small = rows.drop("head").withColumn("node", F.xxhash64("fp", "text_key"))
    nodes = save(small.groupBy("node", "fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("last").alias("last")), "nodes")
    some = nodes.where("n > 0")

    links = close_fingerprints(some, budget, rings)
    named = some.groupBy("fp").agg(F.min("node").alias("least"))
    equal = some.join(named, "fp").select(F.col("node").alias("a"), F.col("least").alias("b"))
    across = links.join(named.select(F.col("fp").alias("a"), F.col("least").alias("na")), "a").join(named.select(F.col("fp").alias("b"), F.col("least").alias("nb")), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))

    heads = rows.select("doc_id", "text_hash", "head").join(some.select("rep.doc_id", "rep.text_hash", "node", "n"), ["doc_id", "text_hash"]).dropDuplicates(["node"])
    posted = heads.select("node", "n", F.posexplode("head").alias("place", "shingle"))
    same = Window.partitionBy("shingle")
    centers = {f"center_{k}": F.min(F.struct(F.xxhash64(F.lit(k), "node").alias("h"), "node", "n")).over(same) for k in range(orders)}
    known = posted.withColumns({**centers, "lo": F.min("node").over(same), "hi": F.max("node").over(same)})
    met = save(known.where("lo <> hi").drop("lo", "hi"), "shared")
    held = met.select("node", "n", F.explode(F.array_distinct(F.array(*[F.struct(f"{c}.node", f"{c}.n") for c in centers]))).alias("center"))
    held = held.where(F.least("n", "center.n") >= F.lit(similarity) * F.greatest("n", "center.n") - 1e-9).where("node <> center.node")
    stars = held.groupBy("node", "n", F.col("center.node").alias("b")).agg(F.count(F.lit(1)).alias("c")).where("20 * c >= n")
    first = equal.unionByName(across).unionByName(stars.select(F.col("node").alias("a"), "b")).where("a <> b")
    first = save(first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    edges = save(similar_pairs(first, shingle_sets(docs, nodes, first, words), similarity), "similar")
    placed = save(components(edges), "placed")
    labelled = met.select("shingle", "node", "n", "place", F.col("center_0.node").alias("family")).join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = held_open(labelled, nodes)
    likely = nearest_pairs(held, similarity, block)
    edges = save(edges.unionByName(similar_pairs(likely, shingle_sets(docs, nodes, likely, words), similarity)), "similar")
    held = still_open(held, components(edges))
    rest = save(may_be_similar(once_each(pairs_in_families(held, similarity, block)), nodes, similarity).select("a", "b"), "pairs")
    groups = components(edges.unionByName(similar_pairs(rest, shingle_sets(docs, nodes, rest, words), similarity)))
    named = small.select("doc_id", "text_hash", "node").join(nodes.select("node", "copies"), "node").join(groups, "node", "left").where("component is not null or copies > 1")
    named = save(named.select("doc_id", "text_hash", F.coalesce("component", "node").alias("component")), "named")
    firsts = named.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    return named.join(firsts, "component").select("doc_id", "text_hash", F.col("first.doc_id").alias("group_id"), (F.struct("doc_id", "text_hash") == F.col("first")).alias("stays"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """`docs` without the documents of a near-duplicate group but its first by doc_id. Rows with a null doc_id stay."""
    gone_id, gone_text = unused("gone_id", docs), unused("gone_text", docs)
    gone = near_duplicate_groups(docs, **options).where("not stays").select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct()
    return docs.join(save(gone, "gone"), (docs["doc_id"].cast("long") == F.col(gone_id)) & (F.xxhash64(docs["text"]) == F.col(gone_text)), "left_anti")
