"""Byte-level BPE: ranked merges over distinct words, and decoding by concatenation of byte pieces."""

from __future__ import annotations

import base64
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varicube.llm.common import sliced

REMEMBERED = 400_000  # words whose ids a task keeps; it starts anew beyond that


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a token in base64 and its rank per line. It is read on the driver; some 50,000 entries."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: of all neighbouring pieces the pair of lowest rank, leftmost first, is merged until none has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return merged_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long word: a heap of pairs, with links to the neighbours, in place of repeated scans."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = [False] * n
    while heap:
        _, i, j, to = heapq.heappop(heap)
        if gone[i] or after[i] != j or j >= n or gone[j] or end[j] != to or end[i] != j:
            continue
        gone[j], end[i], after[i] = True, to, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := ranks.get(word[a : end[b]])) is not None:
                heapq.heappush(heap, (r, a, b, end[b]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def pieces(text: Column, pattern: str) -> Column:
    """Every match of the tokenizer's pattern, in order, by the JVM's regular expressions with Unicode classes."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) per row; a null text is an empty one and has no ids. Rows keep their number and repeats.

    The JVM cuts each whole text into words; a task folds the merges once for each distinct word that it meets and
    gathers the ids of the words by array indexing. Nothing is shuffled. A text with characters that the
    JVM's Unicode tables do not know is cut by the `regex` library instead, whose tables are newer.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    text = F.coalesce(F.col(text_col), F.lit(""))
    odd = text.rlike(r"\p{Cn}")
    cut = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(odd, F.array().cast("array<string>")).otherwise(pieces(text, pattern)).alias("words"),
        F.when(odd, text).alias("odd"),
    )

    def run(batches):
        ranks, known = shared.value, {}
        split = regex.compile(pattern)
        for batch in sliced(batches, 256):
            words, odd = batch.column("words"), batch.column("odd")
            if odd.null_count < len(odd):
                words = pa.array([w if o is None else split.findall(o) for w, o in zip(words.to_pylist(), odd.to_pylist())], pa.list_(pa.string()))
            offsets = words.offsets.to_numpy()
            flat = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            if len(known) > REMEMBERED:
                known.clear()
            ids = []
            for word in flat.dictionary.to_pylist():
                found = known.get(word)
                if found is None:
                    found = known[word] = merged(word.encode("utf-8"), ranks)
                ids.append(found)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat_ids = np.fromiter((x for w in ids for x in w), np.int32, int(sizes.sum()))
            firsts = np.cumsum(sizes) - sizes
            of = flat.indices.to_numpy(zero_copy_only=False)
            n = sizes[of] if len(of) else np.empty(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(n)])
            gathered = flat_ids[np.repeat(firsts[of] - upto[:-1], n) + np.arange(upto[-1])] if len(of) else np.empty(0, np.int32)
            ends = upto[offsets - offsets[0]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(gathered))], ["doc_id", "ids"])

    kind = dict(cut.dtypes)["doc_id"]
    return cut.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids) with `decoded`, the concatenated bytes of the ids' tokens; null for null ids. An unknown id raises an error."""
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    shared = tokens.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        token_bytes = pa.array(shared.value, pa.binary())
        for batch in sliced(batches, 256):
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            flat = token_bytes.take(ids.values.slice(offsets[0], offsets[-1] - offsets[0]))
            lists = pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), flat)
            decoded = pc.binary_join(lists, b"")
            if ids.null_count:
                decoded = pc.if_else(pc.is_valid(ids), decoded, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decoded], ["doc_id", "ids", "decoded"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def folded(word: Column, ranks: dict[bytes, int], buckets: int = 8192) -> Column:
    """Ids of a word by Spark's higher-order functions alone, over a literal rank map.

    The map is an array of small maps, indexed by the hash of a pair's hex form, as a lookup in a Spark map is linear.
    A fold over the word's length merges the pair of lowest rank. Exact, but the lambdas are interpreted at some
    hundreds of microseconds a word (figures in the README), so `encode` does the fold in its tasks.
    """
    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for token, rank in ranks.items():
        h = xxhash.xxh64_intdigest(token.hex().encode(), 42)
        maps[(h if h < 2**63 else h - 2**64) % buckets][token.hex()] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    def rank(piece: Column) -> Column:
        return F.try_element_at(F.element_at(literal, F.pmod(F.xxhash64(piece), F.lit(buckets)).cast("int") + 1), piece)

    def let(value: Column, then) -> Column:
        return F.element_at(F.transform(F.array(value), then), 1)

    def step(parts: Column, _) -> Column:
        pair_ranks = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: rank(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))))

        def merge(found: Column) -> Column:
            best = F.array_min(found)
            joined = let(
                F.array_position(found, best).cast("int"),
                lambda p: F.concat(F.slice(parts, F.lit(1), p - 1), F.array(F.concat(F.element_at(parts, p), F.element_at(parts, p + 1))), F.slice(parts, p + 2, F.size(parts))),
            )
            return F.when(best.isNull(), parts).otherwise(joined)

        return F.when(F.size(parts) < 2, parts).otherwise(let(pair_ranks, merge))

    start = F.regexp_extract_all(F.lower(F.hex(F.encode(word, "utf-8"))), F.lit(".."), F.lit(0))
    return F.transform(F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(start), F.lit(1))), start, step), rank)
