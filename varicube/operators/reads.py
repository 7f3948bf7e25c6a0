"""Read preparation: merging mates, demultiplexing by tags, trimming primers, sampling, statistics."""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varicube.functions.sequences import BASES, COMPLEMENT, IUPAC, reverse_complement
from varicube.functions.storage import stored

TO_COMPLEMENT = np.frombuffer(bytes.maketrans(b"ACGTN", b"TGCAN"), np.uint8)


def merge_pairs(pairs: DataFrame, least_overlap: int = 50, most_differences: float = 0.1, most_errors: float = 1.0, least_length: int = 100, most_length: int = 500, most_ns: int = 0, truncate_quality: int = 10, least_read: int = 50, offset: int = 33, keep: tuple[str, ...] = ()) -> DataFrame:
    """(read_id, sequence, errors) of mates that merge, with the columns named in `keep`. pairs: read_id, fwd_seq, fwd_qual, rev_seq, rev_qual.

    Each mate is cut before its first base of quality `truncate_quality` or less and needs `least_read` bases. The second is
    reverse-complemented; of all overlaps of `least_overlap` or more, with at most the given share of differences, the
    one of fewest differences, then the longest, wins. Where mates differ the better base stands. The merged read must fit the lengths, the number of N
    and the expected errors. An overlap is tried on all reads of an Arrow batch at once; nothing is shuffled.
    """

    def matrix(column) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each string from the left, zeros behind, and the lengths."""
        size = column.str.len().to_numpy(np.int64)
        flat = np.frombuffer("".join(column).encode("ascii", "replace"), np.uint8)
        at = np.arange(size.max(initial=0))
        inside = at < size[:, None]
        out = np.zeros(inside.shape, np.uint8)
        out[inside] = flat
        return out, size

    def mate(bases, qualities) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bases and qualities, and the lengths up to the first bad base."""
        (x, n), (q, m) = matrix(bases), matrix(qualities)
        width = min(x.shape[1], q.shape[1])
        x, q = x[:, :width], q[:, :width].astype(np.int16) - offset
        bad = (q <= truncate_quality) | (np.arange(width) >= np.minimum(n, m)[:, None])
        return x, q, np.where(bad.any(1), bad.argmax(1), width)

    def taken(x: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
        """Of each row the bytes from its start (which may be negative or beyond the end) on, zeros where there are none."""
        at = start[:, None] + np.arange(width)
        inside = (at >= 0) & (at < x.shape[1])
        return np.where(inside, np.take_along_axis(x, np.clip(at, 0, max(0, x.shape[1] - 1)), 1), 0)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        a, qa, na = mate(pdf["fwd_seq"], pdf["fwd_qual"])
        r, qr, nb = mate(pdf["rev_seq"], pdf["rev_qual"])
        kept = np.flatnonzero((na >= least_read) & (nb >= least_read) & (na > 0) & (nb > 0))
        a, qa, na, r, qr, nb = (v[kept] for v in (a, qa, na, r, qr, nb))
        if not len(kept):
            return pdf.iloc[:0][["read_id", *keep]].assign(sequence="", errors=0.0)
        # the second mate, reverse-complemented, from the left; the first one's end at the right edge
        turn = lambda x: taken(x[:, ::-1], x.shape[1] - nb, int(nb.max()))
        b, qb = TO_COMPLEMENT[turn(r)], turn(qr)
        ends = taken(a, na - int(na.max()), int(na.max()))
        most, fewest, overlap = np.minimum(na, nb), np.full(len(kept), np.iinfo(np.int64).max), np.zeros(len(kept), np.int64)
        for n in range(int(most.max()), max(1, least_overlap) - 1, -1):
            wrong = (ends[:, ends.shape[1] - n :] != b[:, :n]).sum(1)
            better = (n <= most) & (wrong <= most_differences * n) & (wrong < fewest)
            fewest[better], overlap[better] = wrong[better], n
        size = na + nb - overlap
        width = int(size.max())
        at = np.arange(width)
        back = lambda x: taken(x, overlap - na, width)
        in_a, in_b = at < na[:, None], (at >= (na - overlap)[:, None]) & (at < size[:, None])
        zero = np.zeros(len(kept), np.int64)
        x, qx, y, qy = taken(a, zero, width), taken(qa, zero, width), back(b), back(qb)
        first = in_a & (~in_b | (qx >= qy))
        bases, quality = np.where(first, x, y), np.where(first, qx, qy)
        inside = at < size[:, None]
        errors = np.where(inside, 10.0 ** (-quality / 10), 0.0).sum(1)
        ok = (overlap > 0) & (size >= least_length) & (size <= most_length) & (((bases == ord("N")) & inside).sum(1) <= most_ns) & (errors <= most_errors)
        text = bases[ok][inside[ok]].tobytes().decode("ascii")
        cuts = np.concatenate([[0], np.cumsum(size[ok])])
        return pdf[["read_id", *keep]].iloc[kept[ok]].assign(sequence=[text[i:j] for i, j in zip(cuts, cuts[1:])], errors=errors[ok])

    def run(batches):
        for pdf in batches:
            whole = pdf[(pdf[["fwd_seq", "fwd_qual", "rev_seq", "rev_qual"]].fillna("") != "").all(axis=1)]
            for at in range(0, len(whole), 2_000):
                yield merged(whole.iloc[at : at + 2_000])

    schema = T.StructType([*[pairs.schema[c] for c in ("read_id", *keep)], T.StructField("sequence", T.StringType()), T.StructField("errors", T.DoubleType())])
    return pairs.select("read_id", *keep, "fwd_seq", "fwd_qual", "rev_seq", "rev_qual").mapInPandas(run, schema)


def both_strands(reads: DataFrame, column: str = "raw") -> DataFrame:
    """Each read as it is and reverse-complemented, with its strand."""
    strands = F.array(F.struct(F.col(column).alias("text"), F.lit("+").alias("strand")), F.struct(reverse_complement(F.col(column)).alias("text"), F.lit("-").alias("strand")))
    both = reads.withColumn("both_", F.explode(strands))  # so that the reads are scanned once
    return both.withColumns({column: F.col("both_.text"), "strand": F.col("both_.strand")}).drop("both_")


def demux_anchored(reads: DataFrame, tags: DataFrame, column: str = "raw") -> DataFrame:
    """Reads that begin with a forward tag and end with the reverse complement of its partner, with the tag pair's columns; `inner` is what is between.

    An equi-join on the read's ends, once for each pair of tag lengths in the sheet. The sheet is stored first, so that Spark knows its size and
    a small one goes to the reads, which few pairs of tags would otherwise crowd into few tasks.
    """
    t = stored(tags, "tags").withColumns({"lf": F.length("tagfwd"), "lr": F.length("tagrev"), "head": F.col("tagfwd"), "tail": reverse_complement(F.col("tagrev"))})
    lengths = F.broadcast(t.select("lf", "lr").distinct())  # pairs of tag lengths: a few
    cut = reads.join(lengths, F.length(column) >= F.col("lf") + F.col("lr"))
    cut = cut.withColumns({"head": F.expr(f"substr({column}, 1, lf)"), "tail": F.expr(f"right({column}, lr)")})
    found = cut.join(t, ["lf", "lr", "head", "tail"])
    return found.withColumn("inner", F.expr(f"substr({column}, lf + 1, length({column}) - lf - lr)")).drop("lf", "lr", "head", "tail")


def demux_floating(reads: DataFrame, tags: DataFrame, read_key: str = "read_id", column: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Reads that hold a forward tag anywhere and the reverse complement of its partner behind it; the first place of each counts. `inner` is what is between.

    One automaton of all tags, forward ones and reversed partners, goes over each read once, whatever the number of tags. tags is a sheet that a user has written: its distinct rows
    are held by every task. Rows come out for hits only, equal ones once. Null and empty tags find nothing. keep: other columns of the reads to return.
    """
    sheet = [tuple(r) for r in tags.distinct().collect()]
    place = {c: i for i, c in enumerate(tags.columns)}
    pairs = [(r[place["tagfwd"]], r[place["tagrev"]]) for r in sheet]
    pairs = [(a, b[::-1].translate(str.maketrans(IUPAC, COMPLEMENT))) if a and b else None for a, b in pairs]
    schema = T.StructType([*[reads.schema[c] for c in (read_key, *keep, column)], *tags.schema.fields, T.StructField("place", T.IntegerType()), T.StructField("inner", T.StringType())])
    kinds = tags.schema.fields

    def run(batches):
        words = sorted({w for p in pairs if p for w in p})
        by_head: dict[str, list[int]] = {}
        for i, p in enumerate(pairs):
            if p:
                by_head.setdefault(p[0], []).append(i)
        places = word_places(words)
        for pdf in batches:
            out = []
            for *own, text in zip(*[pdf[c] for c in (read_key, *keep, column)]):
                found = places(text or "")
                for head in by_head.keys() & found.keys():
                    first = found[head][0]
                    behind = first + len(head)
                    for i in by_head[head]:
                        ends = found.get(pairs[i][1], ())
                        at = bisect_left(ends, behind)
                        if at < len(ends):
                            out.append((*own, text, *sheet[i], first + 1, text[behind : ends[at]]))
            if out:
                frame = pd.DataFrame(out, columns=schema.names)
                yield frame.astype({f.name: "Int64" for f in kinds if isinstance(f.dataType, T.IntegralType)})

    return reads.select(read_key, *keep, column).mapInPandas(run, schema).distinct() if sheet else reads.sparkSession.createDataFrame([], schema)


def word_places(words: list[str]):
    """A function that gives, for a text, the places of each word that it holds, in order: one pass over the text by an automaton of all words."""
    try:
        import ahocorasick
    except ImportError:  # a pass for each word
        def slowly(text: str) -> dict[str, list[int]]:
            found = {w: [m.start() for m in re.finditer(f"(?={re.escape(w)})", text)] for w in words}
            return {w: at for w, at in found.items() if at}

        return slowly
    automaton = ahocorasick.Automaton()
    for w in words:
        automaton.add_word(w, w)
    automaton.make_automaton()

    def places(text: str) -> dict[str, list[int]]:
        found: dict[str, list[int]] = {}
        for end, w in automaton.iter(text) if words else ():
            found.setdefault(w, []).append(end + 1 - len(w))
        return found

    return places


def tag_conflicts(sheet: DataFrame, file_col: str) -> DataFrame:
    """Tag pairs that stand for more than one sample-replicate of a file: an error in the sheet."""
    return sheet.groupBy(file_col, "tagfwd", "tagrev").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def primer_trim(reads: DataFrame, fwd: str | Column, rev: str | Column, most: float = 0.1, column: str = "inner", anchored: bool = True) -> DataFrame:
    """Reads whose start matches the forward primer and whose end the reverse-complemented reverse one, without them.

    At most that share of a primer's bases may differ, without indels; IUPAC codes match any base that they stand for. Primers may be
    columns. Floating primers may begin and end anywhere: the first place of the forward one, and the first of the reverse one behind it, count. Only the text goes to Python and back come
    two numbers: a batch's bases are one matrix of masks of four bits, in which a primer base is compared with all reads and places at once.
    """

    def trimmed(texts: pd.Series, fwd: str, rev: str) -> tuple[np.ndarray, np.ndarray]:
        """Start of each text's inner part, -1 where a primer is missing, and its length."""
        back, limits = rev[::-1].translate(str.maketrans(IUPAC, COMPLEMENT)), (int(most * len(fwd)), int(most * len(rev)))
        masks, n = base_masks(texts)
        if anchored:
            tails = aligned_right(masks, n)
            ok = (n >= len(fwd) + len(rev)) & (wrong_bases(masks, fwd, 1)[:, 0] <= limits[0]) & (wrong_bases(tails[:, max(0, tails.shape[1] - len(back)) :], back, 1)[:, 0] <= limits[1])
            first, last = np.full(len(texts), len(fwd)), n - len(rev)
        else:
            first, found = first_place(wrong_bases(masks, fwd) <= limits[0], n - len(fwd), np.zeros(len(texts), np.int64))
            first = first + len(fwd)
            last, ended = first_place(wrong_bases(masks, back) <= limits[1], n - len(rev), first)
            ok = found & ended
        return np.where(ok, first, -1), np.where(ok, last - first, 0)

    def cut(texts: pd.Series, fwds: pd.Series, revs: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"start": -1, "size": 0}, index=texts.index)
        for (f, r), some in texts.fillna("").groupby([fwds, revs]):  # a few primers; rows without one have no group
            for at in range(0, len(some), 4096):
                part = some.iloc[at : at + 4096]
                out.loc[part.index, "start"], out.loc[part.index, "size"] = trimmed(part, f, r)
        return out

    place = F.pandas_udf(cut, "start long, size long")
    cut_ = reads.withColumn("cut_", place(F.col(column), *[F.lit(p) if isinstance(p, str) else p for p in (fwd, rev)])).where("cut_.start >= 0")
    return cut_.withColumn("sequence", F.substring(F.col(column), (F.col("cut_.start") + 1).cast("int"), F.col("cut_.size").cast("int"))).drop("cut_")


# a bit for each of A, C, G and T
MASKS = {code: sum(1 << "ACGT".index(b) for b in bases) for code, bases in BASES.items()}
READ_MASKS = np.zeros(256, np.uint8)
READ_MASKS[[ord(b) for b in "ACGT"]] = [1, 2, 4, 8]


def base_masks(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """A row of masks for each text, zeros (which match nothing) behind it, and the lengths."""
    n = texts.str.len().to_numpy(np.int64)
    inside = np.arange(n.max(initial=0)) < n[:, None]
    out = np.zeros(inside.shape, np.uint8)
    out[inside] = READ_MASKS[np.frombuffer("".join(texts).encode("ascii", "replace"), np.uint8)]
    return out, n


def aligned_right(masks: np.ndarray, n: np.ndarray) -> np.ndarray:
    at = np.arange(masks.shape[1]) - (masks.shape[1] - n)[:, None]
    return np.where(at >= 0, np.take_along_axis(masks, np.maximum(at, 0), 1), 0) if masks.size else masks


def wrong_bases(masks: np.ndarray, primer: str, places: int | None = None) -> np.ndarray:
    """For each read and place, bases of the primer that do not match there; beyond a read's end none do."""
    places = masks.shape[1] if places is None else places
    wide = np.zeros((len(masks), places + len(primer)), np.uint8)
    wide[:, : min(masks.shape[1], wide.shape[1])] = masks[:, : wide.shape[1]]
    out = np.zeros((len(masks), places), np.int16)
    for j, code in enumerate(primer):
        out += (wide[:, j : j + places] & MASKS[code]) == 0
    return out


def first_place(fits: np.ndarray, last: np.ndarray, since: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each row from `since` to `last` that fits, and whether there is one."""
    at = np.arange(fits.shape[1])
    fits = fits & (at <= last[:, None]) & (at >= since[:, None])
    return (fits.argmax(1), fits.any(1)) if fits.shape[1] else (np.zeros(len(fits), np.int64), np.zeros(len(fits), bool))


def length_window(reads: DataFrame, least: int = 50, most: int = 500, column: str = "sequence") -> DataFrame:
    return reads.where(F.length(column).between(least, most))


def random_reads(reads: DataFrame, n: int, seed: int = 1, file_col: str = "source_file", read_key: str = "read_id") -> DataFrame:
    """Exactly n reads of each file, in the order of a hash of their id with the seed. A file with fewer is an error: see smallest_file.

    The n-th smallest is found in two steps, within slices of a file first, so that one large file is no single task's work.
    """
    key = F.md5(F.concat_ws("-", F.lit(seed).cast("string"), F.col(read_key).cast("string")))
    keyed = reads.withColumn("order_", key).withColumn("slice_", F.pmod(F.xxhash64(read_key), F.lit(64)))
    near = keyed.withColumn("r_", F.row_number().over(Window.partitionBy(file_col, "slice_").orderBy("order_", read_key))).where(F.col("r_") <= n)
    last = near.withColumn("r_", F.row_number().over(Window.partitionBy(file_col).orderBy("order_", read_key)))
    return last.where(F.col("r_") <= n).drop("order_", "slice_", "r_")


def smallest_file(reads: DataFrame, file_col: str = "source_file") -> int:
    return reads_per_file(reads, file_col).agg(F.min("n_reads")).first()[0] or 0


def reads_per_file(reads: DataFrame, file_col: str = "source_file") -> DataFrame:
    return reads.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_reads"))


def merge_stats(forward: DataFrame, reverse: DataFrame, merged: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Forward, reverse and merged reads of each file pair; zero where a side has none."""
    n = lambda df, name: df.groupBy(file_col).agg(F.count(F.lit(1)).alias(name))
    joined = n(forward, "n_forward").join(n(reverse, "n_reverse"), file_col, "full").join(n(merged, "n_merged"), file_col, "full")
    return joined.fillna(0)


def sampled_sheet(sheet: DataFrame, file_col: str = "source_file") -> DataFrame:
    """The sheet with _sampled in its file names, before the first dot."""
    return sheet.withColumn(file_col, F.regexp_replace(file_col, r"^([^.]+)\.", "$1_sampled."))
