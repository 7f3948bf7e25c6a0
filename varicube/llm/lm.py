"""Language-model scores: stupid backoff over n-gram counts of the whole corpus, each document left out of its own counts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varicube.llm.common import shuffle_partitions

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hashes of words met so far; begun anew when there are many, as most of a block's words are rare."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 1)
        return found


def gram_hashes(text: bytes, order: int, known: WordHashes) -> list[np.ndarray]:
    """Of each n from 1 to `order`, the 64-bit hashes of the text's n-grams of words, in order of their first words."""
    words = text.lower().split()
    ones = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = [ones]
    for n in range(2, order + 1):
        last = out[-1]
        h = (last[: max(0, len(words) - n + 1)] ^ (last[: max(0, len(words) - n + 1)] >> np.uint64(29))) * ODD + ones[n - 1 :]
        out.append((h ^ (h >> np.uint64(32))) * MIX)
    return out


def packed(grams: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """One row for each value of the hash's first 16 bits: the other 48 as arrays of 16 and 32 bits, and the numbers, equal ones side by side."""
    part = grams >> 48
    at = np.lexsort((n, part))
    grams, n, part = grams[at], n[at], part[at]
    cuts = np.flatnonzero(np.diff(part, prepend=-(1 << 20)))
    mids, lows = (grams >> 32).astype(np.int16), grams.astype(np.int32)
    return pd.DataFrame({"part": part[cuts].astype(np.int32), **{k: np.split(v, cuts[1:]) if len(cuts) else [] for k, v in (("mids", mids), ("lows", lows), ("ns", n))}})


def unpacked(rows: pd.DataFrame, numbers: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams and their numbers, of rows like those of packed(), sorted by n-gram."""
    cuts = np.concatenate([[0], np.cumsum(rows["lows"].map(len).to_numpy(np.int64))])
    grams, n = np.empty(cuts[-1], np.int64), np.empty(cuts[-1], rows[numbers].iloc[0].dtype if len(rows) else np.int64)
    at = np.argsort(rows["part"].to_numpy(np.int64) << 48, kind="stable") if len(rows) else []  # parts hold the first bits, so rows in their order need sorting within a part only
    parts, mids, lows, ns = (rows[c].to_numpy() for c in ("part", "mids", "lows", numbers))
    done = 0
    for first in range(0, len(rows), 4096):
        some = at[first : first + 4096]
        m, low, k = (np.concatenate(x[some]) for x in (mids, lows, ns))
        part = np.repeat(parts[some].astype(np.int64), cuts[some + 1] - cuts[some])
        g = (part << 48) | ((m.astype(np.int64) & 0xFFFF) << 32) | (low.astype(np.int64) & 0xFFFFFFFF)
        order = np.argsort(g)
        grams[done : done + len(g)], n[done : done + len(g)] = g[order], k[order]
        done += len(g)
    return grams, n


def spread_counts(parts: list[np.ndarray], table: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Of each n-gram of some texts in order, how often it stands in all of them, and elsewhere by the table (sorted)."""
    x = np.concatenate([np.empty(0, np.int64), *[p.view(np.int64) for p in parts]])
    order = np.argsort(x)
    x = x[order]
    cuts = np.append(np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]])), len(x))
    here, n = x[cuts[:-1]], np.diff(cuts)
    del x
    place = np.searchsorted(table, here)
    hit = place < len(table)
    hit[hit] = table[place[hit]] == here[hit]
    total = n.astype(np.int64)
    total[hit] += totals[place[hit]]
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(total, n)
    return out


def mean_log(counts: list[np.ndarray], n_words: int, others: int, alpha: float) -> float | None:
    """The mean natural log of a text's scores. counts: by n, of its n-grams in order, what other documents hold of them; others: their words."""
    if not n_words:
        return None
    order = len(counts)
    logs = np.full(n_words, np.nan)
    longest = np.minimum(np.arange(n_words) + 1, order)  # the longest n-gram that ends in each word
    for n in range(order, 1, -1):
        if n_words >= n:
            ends, c, context = np.arange(n - 1, n_words), counts[n - 1], counts[n - 2][: n_words - n + 1]
            use = np.isnan(logs[ends]) & (c > 0)
            logs[ends[use]] = np.log(c[use] / context[use]) + (longest[ends[use]] - n) * np.log(alpha)
    use = np.isnan(logs)
    logs[use] = np.log(np.maximum(counts[0][use], 1) / others) + (longest[use] - 1) * np.log(alpha)
    return float(logs.sum()) / n_words


def counted(by_text: list[list[np.ndarray]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of some texts, sorted as signed numbers, and how often each stands in them. Takes the texts' n-grams away, as a block's are large."""
    parts = []
    for n in range(order):
        flat = np.concatenate([np.empty(0, np.uint64), *[g[n] for g in by_text]])
        for g in by_text:
            g[n] = None  # not needed any more
        flat.sort()
        cuts = np.append(np.flatnonzero(np.concatenate([np.ones(min(1, len(flat)), bool), flat[1:] != flat[:-1]])), len(flat))
        parts.append((flat[cuts[:-1]], np.diff(cuts)))
        del flat, cuts
    grams, n = np.concatenate([p[0] for p in parts]).view(np.int64), np.concatenate([p[1] for p in parts])
    del parts
    at = np.argsort(grams)
    return grams[at], n[at]


def stupid_backoff(docs: DataFrame, order: int = 2, alpha: float = 0.4, block_chars: int = 22_000_000) -> DataFrame:
    """(doc_id, n_words, score): the mean over a text's words of the natural log of the stupid-backoff score.

    A word is scored by the longest n-gram ending in it, of up to `order` words, that other documents hold: its
    count over that of its first n - 1 words, times alpha for each step down. A word that no other document holds
    counts as one of as many words as the others have. Counts cover all documents less the one that is scored. Words
    are cut at ASCII spaces, A-Z lower-cased. A text without words, or null, has n_words 0 and a null score. Repeated rows are
    documents of their own; null and repeated ids keep their rows, which are dealt out by id and text.

    Documents are dealt into blocks of about `block_chars`. Each block is exploded into rows (gram, block, n), one for each n-gram that it holds,
    so a frequent n-gram has no more rows than there are blocks. Partitioned by the hash of the n-gram, these rows are summed to the count table and joined to it;
    what comes back to a block are the totals of the n-grams that other blocks hold too. There each document sums its words.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    size = docs.select(F.length("text").cast("long").alias("chars"), F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long").alias("words"))
    chars, all_words = (x or 0 for x in size.agg(F.sum("chars"), F.sum("words")).first())
    blocks = max(1, -(-chars // block_chars))
    tasks = max(shuffle_partitions(spark), 2 * blocks)
    # nothing but a scan below this exchange, so that the counts and the scores share it
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")).repartition(tasks, "block")

    def hashed(pdf: pd.DataFrame) -> list[list[np.ndarray]]:
        known = WordHashes()
        return [gram_hashes((t or "").encode("utf-8", "surrogatepass"), order, known) for t in pdf["text"]]

    def explode(pdf: pd.DataFrame) -> pd.DataFrame:
        block, by_text = pdf["block"].iloc[0], hashed(pdf)
        return packed(*counted(by_text, order)).assign(block=np.int32(block))

    rest = "part int, mids array<short>, lows array<int>"
    sent = dealt.groupBy("block").applyInPandas(explode, f"{rest}, ns array<long>, block int")
    sent = sent.repartition(2 * tasks, "part")
    rows = sent.select("part", "block", F.explode(F.arrays_zip("mids", "lows", "ns")).alias("g")).select("part", "block", "g.mids", "g.lows", "g.ns")
    same = Window.partitionBy("part", "mids", "lows")
    shared = rows.withColumn("others", (F.sum("ns").over(same) - F.col("ns")).cast("int" if all_words < 1 << 31 else "long")).where("others > 0").sortWithinPartitions("part", "block", "others")
    elsewhere = shared.groupBy("part", "block").agg(*[F.collect_list(c).alias(c) for c in ("mids", "lows", "others")])

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"doc_id": [], "n_words": [], "score": []})
        table, totals = unpacked(right, "others")
        by_text = hashed(left)
        sizes = [len(p[0]) for p in by_text]
        others = []  # by n: of each n-gram in order, its count in all other documents
        for n in range(order):
            counts, done = spread_counts([p[n] for p in by_text], table, totals), 0
            for p in by_text:
                _, back, mine = np.unique(p[n], return_inverse=True, return_counts=True)
                counts[done : done + len(p[n])] -= mine[back]
                done += len(p[n])
                p[n] = None
            others.append(counts)
        del table, totals
        found, done = [], [0] * order
        for n_words in sizes:
            c = []
            for n in range(order):
                grams = max(0, n_words - n)
                c.append(others[n][done[n] : done[n] + grams])
                done[n] += grams
            found.append(mean_log(c, n_words, max(1, all_words - n_words), alpha))
        return pd.DataFrame({"doc_id": left["doc_id"], "n_words": sizes, "score": pd.array(found, dtype="Float64")})

    return dealt.groupBy("block").cogroup(elsewhere.repartition(tasks, "block").groupBy("block")).applyInPandas(score, f"doc_id {kind}, n_words long, score double")
