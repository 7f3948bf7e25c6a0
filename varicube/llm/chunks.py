"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varicube.llm.common import save, sliced, unused

#: A random 32-bit word for each value of a character's low byte (mixed with its next byte).
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
WINDOW = 16


def boundaries(text: np.ndarray, bits: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of a text of code points.

    The gear hash of a place sums the shifted words of the last characters: h = (h << 1) + GEAR[c], of which
    the low 16 bits see 16 characters. A chunk ends where its top `bits` of those are zero, unless it
    would have fewer than `least` characters; it ends anyway after `most`. An insertion moves only the boundaries near it.
    """
    h = GEAR[(text ^ (text >> 8)) & 255].astype(np.uint16)
    span = 1
    while span < WINDOW:  # sums over 2, 4, 8 and 16 characters by doubling
        ahead = h.copy()
        ahead[span:] += h[:-span] << np.uint16(span)
        h, span = ahead, span * 2
    ends, last = [], 0
    for p in (np.flatnonzero(h >> np.uint16(16 - bits) == 0) + 1).tolist():
        while p - last > most:
            last += most
            ends.append(last)
        if p - last >= least:
            ends.append(p)
            last = p
    while len(text) - last > most:
        last += most
        ends.append(last)
    if last < len(text):
        ends.append(len(text))
    return ends


def with_text_keys(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with the column `name`: a hash of the text (never 0) where other texts have the same doc_id, else 0.

    Zeros take no room in a shuffle, where a hash in each chunk's row would nearly double it. Ids of several texts are written as a table
    first, so that Spark knows its size when it chooses the join; with few of them no text is shuffled.
    """
    shared_id, many = unused("shared_id", docs), unused("many", docs)
    hashed = docs.select(F.col("doc_id").cast("long").alias(shared_id), F.xxhash64("text").alias("h")).where(F.col(shared_id).isNotNull())
    shared = hashed.groupBy(shared_id).agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select(shared_id, F.lit(True).alias(many))
    joined = docs.join(save(shared, "shared_ids"), docs["doc_id"].cast("long") == F.col(shared_id), "left")
    return joined.withColumn(name, F.when(F.col(many), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))).drop(shared_id, many)


def chunks(docs: DataFrame, bits: int = 5, least: int = 12, most: int = 256, key: str | None = None) -> DataFrame:
    """(doc_id, text_key, start, size, d1, d2) of each chunk of each text, in code points, with its 128-bit digest.

    text_key tells texts of one id apart, see with_text_keys(); `key` names the column of `docs` that has it, if one does. Null and
    empty texts have no chunks, nor have null ids.
    """
    if key is None:
        key = unused("text_key", docs)
        docs = with_text_keys(docs, key)

    def run(batches):
        for pdf in sliced(batches):
            ids, keys, starts, sizes, digests = [], [], [], [], []
            for doc_id, key, text in zip(pdf["doc_id"], pdf["text_key"], pdf["text"]):
                if not text:
                    continue
                raw = text.encode("utf-32-le", "surrogatepass")
                ends = boundaries(np.frombuffer(raw, np.uint32), bits, least, most)
                begins = [0, *ends[:-1]]
                ids.append(np.full(len(ends), doc_id, np.int64))
                keys.append(np.full(len(ends), key, np.int64))
                starts += begins
                sizes += [e - b for b, e in zip(begins, ends)]
                digests += [xxhash.xxh3_128_digest(raw[4 * b : 4 * e]) for b, e in zip(begins, ends)]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": np.concatenate(ids), "text_key": np.concatenate(keys), "start": np.array(starts, np.int32), "size": np.array(sizes, np.int32), "d1": halves[:, 0], "d2": halves[:, 1]})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("text_key"), "text").where("doc_id is not null and length(text) > 0")
    return source.mapInPandas(run, "doc_id long, text_key long, start int, size int, d1 long, d2 long")


def repeated_spans(docs: DataFrame, run: int = 100, **options) -> DataFrame:
    """(doc_id, text_key, start, end) of passages whose chunks all stand elsewhere before: in a document of smaller id, or further up.

    Of equal chunks the first by (doc_id, text_key, start) stays. Repeats that follow one another make a span; spans of fewer
    than `run` characters are left alone, as short chunks may agree by chance. Rows that share a doc_id but not the text are
    documents of their own; rows that share both are one.
    """
    cut = chunks(docs, **options)
    place = F.struct("doc_id", "text_key", "start")
    first = cut.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    again = cut.join(first, ["d1", "d2"]).where(place > F.col("first")).select("doc_id", "text_key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    by_doc = Window.partitionBy("doc_id", "text_key").orderBy("start")
    islands = again.withColumn("opens", F.coalesce(F.lag("end").over(by_doc) != F.col("start"), F.lit(True)).cast("int")).withColumn("island", F.sum("opens").over(by_doc))
    spans = islands.groupBy("doc_id", "text_key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.where(F.col("end") - F.col("start") >= run).select("doc_id", "text_key", "start", "end")


def spans_by_document(docs: DataFrame, into: str = "spans", **options) -> DataFrame:
    """`docs` with the column `into`, array<struct<start, end>> in order, empty where nothing repeats; a column of that name is replaced."""
    span_id, span_key, found, key = (unused(c, docs) for c in ("span_id", "span_key", "found", "own_key"))
    keyed = with_text_keys(docs, key)
    by_text = repeated_spans(keyed, key=key, **options).groupBy(F.col("doc_id").alias(span_id), F.col("text_key").alias(span_key)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(found))
    empty = F.filter(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), lambda x: F.lit(False))
    same = (keyed["doc_id"].cast("long") == F.col(span_id)) & (keyed[key] == F.col(span_key))
    return keyed.join(save(by_text, "spans"), same, "left").withColumn(into, F.coalesce(found, empty)).drop(span_id, span_key, found, key)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """`docs` with the repeated passages cut out of `text`."""
    spans = unused("spans", docs)
    found = spans_by_document(docs, spans, **options)
    text, state = F.col("text"), "struct<pos:int,text:string>"
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("text")).cast(state)
    kept = F.aggregate(
        spans, zero,
        lambda acc, s: F.struct(s["end"].alias("pos"), F.concat(acc["text"], F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])).alias("text")).cast(state),
        lambda acc: F.concat(acc["text"], F.substring(text, acc["pos"] + 1, F.length(text))),
    )
    return found.withColumn("text", F.when(F.size(spans) > 0, kept).otherwise(text)).drop(spans)
