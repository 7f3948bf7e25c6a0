"""The prefix trie of conversations whose beginnings are taken from other conversations, by hash products that compose."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varicube.llm.common import save, shuffle_partitions, sliced

# The largest primes below 2^31, so that products fit in 64 bits.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)
KEY = "fp"


class Products:
    """Hash products of sequences of turns: n turns with keys t1..tn stand for the maps x -> B^n x + (t1 B^(n-1) + ... + tn), one modulo each prime.

    Maps compose, so the product of a beginning and an ending follows from theirs, and that of an ending from those of the whole and of the
    beginning; no sequence has to be put together. A product is an array of one remainder a prime; as bytes it is 4 a prime.
    """

    def __init__(self, primes=PRIMES[:3], seed: int = 1):
        draw = random.Random(seed)
        self.primes, self.bases = primes, tuple(draw.randrange(2, p - 1) for p in primes)

    def powers(self, n: np.ndarray, inverse: bool = False) -> np.ndarray:
        """B^n (or B^-n) by prime, one row a prime."""
        out = []
        for p, b in zip(self.primes, self.bases):
            n_, b, x = n.copy(), pow(b, -1, p) if inverse else b, np.ones(len(n), np.int64)
            while n_.any():
                x = np.where(n_ & 1, x * b % p, x)
                b, n_ = b * b % p, n_ >> 1
            out.append(x)
        return np.array(out).reshape(len(self.primes), len(n))

    @property
    def modulus(self) -> np.ndarray:
        return np.array(self.primes, np.int64)[:, None]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Remainders of unsigned 64-bit keys."""
        return np.array([(keys % np.uint64(p)).astype(np.int64) for p in self.primes])

    def joined(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Product of a beginning with product a and an ending of n turns with product b."""
        return (a * self.powers(n) + b) % self.modulus

    def ending(self, whole: np.ndarray, beginning: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Product of the last n turns of a sequence, by its own and that of what stands before them."""
        return (whole - beginning * self.powers(n)) % self.modulus

    def without_last(self, whole: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return (whole - self.of(keys)) % self.modulus * self.powers(np.ones(whole.shape[1], np.int64), inverse=True) % self.modulus

    def scanned(self, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Products of the beginnings of consecutive sequences; place counts from 0 within each."""
        t = self.of(keys) * self.powers(place, inverse=True) % self.modulus
        total = np.cumsum(t, axis=1)
        first = np.arange(len(place)) - place
        before = np.where(first > 0, total[:, first - 1], 0)
        return (total - before) % self.modulus * self.powers(place) % self.modulus

    def bytes(self, x: np.ndarray) -> list[bytes]:
        return [r.tobytes() for r in np.ascontiguousarray(x.T).astype(">u4")]

    def array(self, column) -> np.ndarray:
        return np.frombuffer(b"".join(column), ">u4").reshape(-1, len(self.primes)).T.astype(np.int64)


def scanned(turns: DataFrame, hashing: Products) -> DataFrame:
    """(conv_id, part, place, key, proof, words, upto, fp): each turn with the product of its conversation's turns so far within a sorted part of the table.

    A digest of role and text gives the key (56 bits) that goes into products and the proof (56 others) that equal keys are equal turns. Texts are not shuffled.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    content = F.unhex(F.sha2(F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")), 256))
    number = lambda at: F.conv(F.hex(F.substring("content_", at, 7)), 16, 10).cast("long")  # noqa: E731  56 bits: they fit a long
    words = F.size(F.filter(F.split(text("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), content.alias("content_"), words.alias("words"))
    order = ["conv_id", "turn", "role", "content_"]
    ordered = rows.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches):
        part, last, n0, upto0, fp0 = TaskContext.get().partitionId(), None, 0, 0, None
        for pdf in sliced(batches, 8192):
            conv, key, words = (pdf[c].to_numpy(np.int64) for c in ("conv_id", "key", "words"))
            new = np.concatenate([[True], conv[1:] != conv[:-1]])
            starts = np.flatnonzero(new)
            first = starts[np.cumsum(new) - 1]
            place = np.arange(len(conv)) - first
            fp = hashing.scanned(key.view(np.uint64), place)
            upto = np.cumsum(words)
            upto = upto - np.where(first > 0, upto[first - 1], 0)
            place = place + 1
            if conv[0] == last:  # goes on from the batch before
                own = first == 0
                fp[:, own] = hashing.joined(np.repeat(fp0, own.sum(), 1), fp[:, own], place[own])
                place[own] += n0
                upto[own] += upto0
            last, n0, upto0, fp0 = conv[-1], place[-1], upto[-1], fp[:, -1:]
            yield pd.DataFrame({"conv_id": conv, "part": part, "place": place, "key": key, "proof": pdf["proof"], "words": words, "upto": upto, KEY: hashing.bytes(fp)})

    digests = ordered.select("conv_id", number(1).alias("key"), number(8).alias("proof"), "words")
    return save(digests.mapInPandas(run, "conv_id long, part int, place long, key long, proof long, words long, upto long, fp binary"), "turns")


def placed(turns: DataFrame, hashing: Products) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): scanned() over whole conversations, and n and words of each.

    A conversation that goes on over several parts of the sorted table, however long, has its parts' products joined in order; only those at the border of
    two parts do, so there are fewer of them than parts.
    """
    rows = scanned(turns, hashing)
    ends = save(rows.groupBy("conv_id", "part").agg(F.max("place").alias("n"), F.max_by(F.struct("upto", KEY), "place").alias("end")), "ends")
    lengths = ends.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum("end.upto").alias("words"), F.count(F.lit(1)).alias("parts"))
    lengths = save(lengths, "lengths")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        n, upto, fp, out = 0, 0, np.zeros((len(hashing.primes), 1), np.int64), []
        for r in pdf.itertuples():
            out.append((r.conv_id, r.part, n, upto, hashing.bytes(fp)[0]))
            fp = hashing.joined(fp, hashing.array([r.fp]), np.array([r.n]))
            n, upto = n + r.n, upto + r.upto
        return pd.DataFrame(out, columns=["conv_id", "part", "n0", "upto0", "fp0"])

    cut = ends.join(lengths.where("parts > 1").select("conv_id"), "conv_id").select("conv_id", "part", "n", "end.upto", f"end.{KEY}")
    before = cut.groupBy("conv_id").applyInPandas(run, "conv_id long, part int, n0 long, upto0 long, fp0 binary")
    before = save(before, "before")
    if before.isEmpty():
        return rows.drop("part"), lengths

    def carried(batches):
        for pdf in sliced(batches, 8192):
            whole = hashing.joined(hashing.array(pdf["fp0"]), hashing.array(pdf[KEY]), pdf["place"].to_numpy(np.int64))
            yield pdf.assign(place=pdf["place"] + pdf["n0"], upto=pdf["upto"] + pdf["upto0"], **{KEY: hashing.bytes(whole)}).drop(columns=["part", "n0", "upto0", "fp0"])

    long = rows.join(F.broadcast(before), ["conv_id", "part"])  # fewer than twice the parts
    short = rows.join(F.broadcast(before), ["conv_id", "part"], "left_anti").drop("part")
    return short.unionByName(long.mapInPandas(carried, short.schema)), lengths


def rebuilt(turns: DataFrame, base: Column, head: Column, hashing: Products) -> DataFrame:
    """(conv_id, depth, fp, key, proof, words, before, length, total): a row for each beginning of each rebuilt conversation, the empty one included.

    The first `head` turns come from conversation `base` (both columns of conv_id), the others are the conversation's own after its first `head`. fp is the
    beginning's product, key, proof and words are of its last turn; `before` counts the words before that turn, length and total the whole conversation's turns and words.
    """
    rows, lengths = placed(turns, hashing)
    zero = hashing.bytes(np.zeros((len(hashing.primes), 1), np.int64))[0]
    own = lengths.select("conv_id", "n", F.col("words").alias("all_words"), base.cast("long").alias("base"), head.cast("long").alias("head"))
    most = own.agg(F.max("head")).first()[0] or 0
    early = rows.where(F.col("place") <= most)  # no more than `most` of any conversation, so a long base is not copied
    heads = own.where("head > 0").select("conv_id", "base", "head").join(early.withColumnRenamed("conv_id", "base"), "base").where("place <= head").drop("base", "head")
    heads = save(heads, "heads")
    taken = heads.groupBy("conv_id").agg(F.max(F.struct("place", "upto", KEY)).alias("taken"))
    left = early.where(F.col("place") == head).select("conv_id", F.struct("upto", KEY).alias("left"))
    marks = own.join(taken, "conv_id", "left").join(left, "conv_id", "left")
    nothing = F.lit(bytearray(zero))
    depth, kept = F.coalesce("taken.place", F.lit(0)), F.greatest(F.col("n") - F.col("head"), F.lit(0))
    marks = marks.select(
        "conv_id", "head", depth.alias("taken"), F.coalesce("taken.upto", F.lit(0)).alias("taken_words"), F.coalesce(F.col(f"taken.{KEY}"), nothing).alias("taken_fp"),
        F.coalesce("left.upto", F.lit(0)).alias("left_words"), F.coalesce(F.col(f"left.{KEY}"), nothing).alias("left_fp"), (depth + kept).alias("length"),
        (F.coalesce("taken.upto", F.lit(0)) + F.when(kept > 0, F.col("all_words") - F.coalesce("left.upto", F.lit(0))).otherwise(0)).alias("total"),
    )
    marks = save(marks, "marks")

    def run(batches):
        for pdf in sliced(batches, 8192):
            n = (pdf["place"] - pdf["head"]).to_numpy(np.int64)
            ending = hashing.ending(hashing.array(pdf[KEY]), hashing.array(pdf["left_fp"]), n)
            whole = hashing.joined(hashing.array(pdf["taken_fp"]), ending, n)
            upto = pdf["taken_words"] + pdf["upto"] - pdf["left_words"]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "depth": pdf["taken"] + n, KEY: hashing.bytes(whole), "key": pdf["key"], "proof": pdf["proof"], "words": pdf["words"], "before": upto - pdf["words"], "length": pdf["length"], "total": pdf["total"]})

    fields = "conv_id long, depth long, fp binary, key long, proof long, words long, before long, length long, total long"
    # a conversation with a large share of all turns is one key on the left: Spark's adaptive joins split it
    tails = rows.where(F.col("place") > head).join(marks, "conv_id").mapInPandas(run, fields)
    columns = [c.split()[0] for c in fields.split(", ")]
    fronts = heads.join(marks.select("conv_id", "length", "total"), "conv_id").select("conv_id", F.col("place").alias("depth"), KEY, "key", "proof", "words", (F.col("upto") - F.col("words")).alias("before"), "length", "total")
    none = F.lit(0).cast("long")
    roots = marks.select("conv_id", none.alias("depth"), nothing.alias(KEY), none.alias("key"), none.alias("proof"), none.alias("words"), none.alias("before"), "length", "total")
    return save(tails.unionByName(fronts.select(*columns)).unionByName(roots.select(*columns)), "beginnings")


def digests_of_ends(rows: DataFrame, most: int = 1 << 16) -> DataFrame:
    """(depth, fp, ends_sha256) of nodes at which conversations end: SHA-256 over their numbers in order, joined by commas.

    Ids are sorted over all tasks by node and number and packed to texts of up to `most` ids, so a node where many end is shared out; a digest then takes
    these texts in order, one at a time.
    """
    ends = rows.where("depth = length").select("depth", KEY, "conv_id")
    order = ["depth", KEY, "conv_id"]
    ordered = ends.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def packed(batches):
        node, ids, out = None, [], []
        for pdf in sliced(batches, 8192):
            for depth, fp, conv in zip(pdf["depth"], pdf[KEY], pdf["conv_id"]):
                if ids and ((depth, fp) != node or len(ids) >= most):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = (depth, fp)
                ids.append(int(conv))
            if out:
                yield pd.DataFrame(out, columns=["depth", KEY, "first", "ids"])
                out = []
        if ids:
            yield pd.DataFrame([(*node, ids[0], ",".join(map(str, ids)))], columns=["depth", KEY, "first", "ids"])

    def digested(batches):
        node, state, out = None, None, []
        for pdf in sliced(batches):
            for depth, fp, ids in zip(pdf["depth"], pdf[KEY], pdf["ids"]):
                if state is not None and (depth, fp) == node:
                    state.update(b",")
                else:
                    if state is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, fp), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["depth", KEY, "ends_sha256"])
                out = []
        if state is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["depth", KEY, "ends_sha256"])

    texts = ordered.mapInPandas(packed, "depth long, fp binary, first long, ids string")
    return texts.repartition("depth", KEY).sortWithinPartitions("depth", KEY, "first").mapInPandas(digested, "depth long, fp binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, primes=PRIMES[:3], seed: int = 1) -> DataFrame:
    """One row per distinct beginning (role, text of each turn) of the rebuilt conversations, that of no turns included.

    turns: conv_id, turn, role, text; in order of turn (null first), those of one turn by role, then by a digest of role and text. base and head are columns
    of conv_id: a conversation's first `head` turns are those of conversation `base` (fewer if it has fewer, none if there is none), followed by its own after
    its first `head`. By default every conversation is as it stands. Null roles and texts are empty; rows of a null conv_id take no part; repeated rows are
    turns of their own; an empty table gives an empty result.

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, (n_convs - 1) times the words of
    the last turn's text), ends_sha256. Beginnings go by their hash product and depth. Equal products are checked by what they stand for: the last turn's
    key and proof have to be one for all members, which makes the products before it equal too, and so on up to the root. Should the check fail, another
    round takes other bases and one more prime.

    Sums over subtrees need no walk: a conversation owns the nodes whose smallest member it is, which are the deepest ones of its path. So a
    subtree's distinct words, leaves and children are sums over a node's members of what they own, and one grouping gives them all at any depth.
    """
    base, head = F.col("conv_id") if base is None else base, F.lit(0) if head is None else head
    for k in range(16):
        tried = (*primes, *[p for p in PRIMES if p not in primes][:k])
        rows = rebuilt(turns, base, head, Products(tried, seed + k))
        own = rows.groupBy("depth", KEY).agg(
            F.min("conv_id").alias("conv_id"), F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.sum((F.col("length") == F.col("depth")).cast("long")).alias("ends"),
            *[f(c).alias(f"{name}_{c}") for c in ("key", "proof") for f, name in ((F.min, "lo"), (F.max, "hi"))],
        )
        own = save(own.select("conv_id", "depth", "words", (F.col("n") == F.col("ends")).alias("leaf"), ((F.col("lo_key") == F.col("hi_key")) & (F.col("lo_proof") == F.col("hi_proof"))).alias("sound")), "owned")
        if own.where("not sound").isEmpty():
            break
    else:
        raise RuntimeError("different beginnings keep having equal products")
    hashing = Products(tried, seed + k)

    owners = own.groupBy("conv_id").agg(F.sum("words").alias("own_words"), F.min("depth").alias("own_depth"), F.sum(F.col("leaf").cast("long")).alias("own_leaves"))
    known = rows.join(owners, "conv_id", "left")
    child = (F.col("own_depth") <= F.col("depth") + 1) & (F.col("length") > F.col("depth"))
    nodes = known.groupBy("depth", KEY).agg(
        F.min(F.struct("conv_id", "own_words", "own_depth", "total")).alias("least"), F.count(F.lit(1)).alias("n_convs"), F.first("key").alias("key"), F.first("words").alias("words"), F.first("before").alias("before"),
        F.sum("total").alias("totals"), F.coalesce(F.sum("own_words"), F.lit(0)).alias("owned_words"), F.coalesce(F.sum("own_leaves"), F.lit(0)).alias("n_leaves"), F.sum(F.coalesce(child, F.lit(False)).cast("long")).alias("n_children"),
    )
    every = F.col("totals") - F.col("n_convs") * F.col("before")  # words of all members from this depth on
    once = F.col("owned_words") - F.col("least.own_words") + F.col("least.total") - F.col("before")  # of the subtree's nodes
    told = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = save(nodes.select("depth", KEY, "key", F.col("least.conv_id").alias("conv_id"), F.col("least.own_depth").alias("own_depth"), "n_convs", "n_children", "n_leaves", (every - once).alias("saved_tokens")), "nodes")

    def parents(batches):
        for pdf in sliced(batches, 8192):
            up = hashing.without_last(hashing.array(pdf[KEY]), pdf["key"].to_numpy(np.int64).view(np.uint64))
            yield pdf.assign(up=hashing.bytes(up)).drop(columns=["key"])

    # only the topmost node that a conversation owns has another one's node above it
    inner = nodes.where("depth = 0 or own_depth < depth").select("depth", KEY, "conv_id", F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"), *told)
    tops = nodes.where("depth > 0 and own_depth = depth").select("depth", KEY, "key", "conv_id", *told)
    tops = tops.mapInPandas(parents, f"depth long, {KEY} binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, up binary")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col(KEY).alias("up"), F.col("conv_id").alias("parent_conv_id"))
    whole = inner.unionByName(tops.join(above, ["depth", "up"]).drop("up"))
    ended = whole.join(digests_of_ends(rows), ["depth", KEY], "left")
    return ended.select("conv_id", "depth", "parent_conv_id", *told, F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
