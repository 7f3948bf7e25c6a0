"""Secret scans: fixed patterns, and windows of high Shannon entropy in candidate strings. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varicube.llm.common import unused

# The base patterns. Where a kind has a least length it is part of the pattern or asked of group 2.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")

# Characters of a candidate string, in the order of the count array: digits, letters, then signs.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}"

#: Candidates that are never a secret: numbers, UUIDs, dates and paths of words.
ALLOW_LIST = (
    r"[0-9_/+-]+",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[a-zA-Z]*([/_-][a-zA-Z]*)*[0-9]{0,4}",
)
#: Parts of a candidate that are never a secret; what stands before and after one of them is looked at on its own.
PLACEHOLDERS = ("0123456789", "abcdefghij", "example", "sample", "placeholder", "xxxxx", "dummy")


@dataclass(frozen=True)
class Entropy:
    """window: characters; hex_bits, mixed_bits: the least entropy of a window of hex digits, or of mixed characters, in bits a character."""

    window: int = 20
    hex_bits: float = 2.85
    mixed_bits: float = 3.55
    digits: int = 2
    letters: int = 2
    allow_list: tuple[str, ...] = ALLOW_LIST
    placeholders: tuple[str, ...] = PLACEHOLDERS


def let(value: Column, then) -> Column:
    """then(value), with the value taken once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def folded(items: Column, zero: Column, kind: str, fields: list[str], step) -> Column:
    """A fold over an array that is not empty, from the state `zero` of type `kind` with these fields, the last of which lists what the steps have found.

    An array grows by being copied, so the fold goes over blocks of about the square root of the number of items, and a block's finds join the others at once:
    work grows with the power 1.5 of the number of items, not with its square.
    """
    *carried, out = fields
    width = F.ceil(F.sqrt(F.size(items))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / width).cast("int")), lambda k: F.slice(items, k * width + 1, width))

    def state(x: Column, found: Column) -> Column:
        return F.struct(*[x[f].alias(f) for f in carried], found.alias(out)).cast(kind)

    def block(acc: Column, items: Column) -> Column:
        return let(F.aggregate(items, state(acc, zero[out]), step), lambda x: state(x, F.concat(acc[out], x[out])))

    return F.aggregate(blocks, zero, block)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, word>> of the leftmost non-overlapping matches, in code points; word is the group asked for.

    The lengths of what lies between matches (split) and of the matches themselves add up to their places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(whole, F.length).alias("size"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("word"))
    kind = "struct<pos:int,found:array<struct<start:int,end:int,word:string>>>"

    def add(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        one = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), x["word"].alias("word")))
        return F.struct(end.cast("int").alias("pos"), F.when(x["size"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], one)).alias("found")).cast(kind)

    none = F.lit(None).cast("array<struct<start:int,end:int,word:string>>")
    zero = F.struct(F.lit(0).alias("pos"), F.filter(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("word"))), lambda x: F.lit(False)).alias("found")).cast(kind)
    found = let(lengths, lambda x: folded(x, zero, kind, ["pos", "found"], add)["found"])
    return F.coalesce(F.when(text.rlike(pattern), found).otherwise(none), zero["found"])


def uncovered(spans: Column, base: Column) -> Column:
    """The spans (kind, start, end) that lie in none of `base` wholly.

    One fold over both in order of start, bases first, that keeps the furthest end of the bases so far.
    """
    mark = lambda own: lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s["kind"].alias("kind"))
    both = F.array_sort(F.concat(F.transform(base, mark(0)), F.transform(spans, mark(1))))
    kind = "struct<furthest:int,found:array<struct<kind:string,start:int,end:int>>>"
    zero = F.struct(F.lit(-1).alias("furthest"), F.filter(F.array(F.struct(F.lit("").alias("kind"), F.lit(0).alias("start"), F.lit(0).alias("end"))), lambda x: F.lit(False)).alias("found")).cast(kind)

    def step(acc: Column, s: Column) -> Column:
        one = F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        keeps = (s["own"] == 1) & (s["end"] > acc["furthest"])
        furthest = F.when(s["own"] == 0, F.greatest(acc["furthest"], s["end"])).otherwise(acc["furthest"])
        return F.struct(furthest.cast("int").alias("furthest"), F.when(keeps, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found")).cast(kind)

    return let(both, lambda x: folded(x, zero, kind, ["furthest", "found"], step)["found"])


def weight(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def entropy_spans(word: Column, start: Column, rule: Entropy) -> Column:
    """array<struct<kind, start, end>> of a candidate's windows of high entropy, overlapping ones joined.

    The window slides by one character: counts of the one that enters and of the one that leaves change, and with
    them the sum of n * log2(n), so no window is counted anew. Counts are held by character class of ALPHABET.
    """
    w, n_chars = rule.window, len(ALPHABET)
    signs = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    hex_like = word.rlike("^[0-9a-fA-F]+$")
    least = F.when(hex_like, F.lit(rule.hex_bits)).otherwise(F.lit(rule.mixed_bits))
    kind = F.when(hex_like, F.lit("entropy_hex")).otherwise(F.lit("entropy_mixed"))
    state = "struct<counts:array<int>,total:double,digits:int,letters:int,spans:array<struct<start:int,end:int>>>"
    zero = F.struct(
        F.array_repeat(F.lit(0), n_chars).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("digits"), F.lit(0).alias("letters"),
        F.filter(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), lambda x: F.lit(False)).alias("spans"),
    ).cast(state)

    def slide(codes: Column):
        def step(acc: Column, i: Column) -> Column:  # i: the place of the entering character, from 1
            enter = F.element_at(codes, i)
            leave = F.when(i > w, F.element_at(codes, F.greatest(i - w, F.lit(1)))).otherwise(F.lit(-1))

            def count(sign: Column) -> Column:
                return F.when(sign >= 0, F.element_at(acc["counts"], F.greatest(sign, F.lit(0)) + 1)).otherwise(F.lit(0))

            n_in, n_out = count(enter), count(leave)
            same = enter == leave
            total = F.when(same, acc["total"]).otherwise(acc["total"] + weight(n_in + 1) - weight(n_in) + F.when(leave >= 0, weight(n_out - 1) - weight(n_out)).otherwise(F.lit(0.0)))
            counts = F.transform(acc["counts"], lambda n, k: n + F.when(k == enter, 1).otherwise(0) - F.when(k == leave, 1).otherwise(0))
            digit, letter = (lambda c: ((c >= 0) & (c < 10)).cast("int")), (lambda c: ((c >= 10) & (c < 62)).cast("int"))
            new = F.struct(counts.alias("counts"), total.alias("total"), (acc["digits"] + digit(enter) - digit(leave)).alias("digits"), (acc["letters"] + letter(enter) - letter(leave)).alias("letters"), acc["spans"].alias("spans"))

            def judge(x: Column) -> Column:
                hot = (i >= w) & (x["digits"] >= rule.digits) & (x["letters"] >= rule.letters) & (F.lit(math.log2(w)) - x["total"] / w >= least)
                a, b = start + i - w, start + i
                last = F.try_element_at(x["spans"], F.lit(-1))
                joined = F.when(last.isNotNull() & (last["end"] >= a), F.concat(F.slice(x["spans"], F.lit(1), F.greatest(F.size(x["spans"]) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), b.alias("end")))))
                spans = F.when(hot, joined.otherwise(F.concat(x["spans"], F.array(F.struct(a.alias("start"), b.alias("end")))))).otherwise(x["spans"])
                return F.struct(x["counts"].alias("counts"), x["total"].alias("total"), x["digits"].alias("digits"), x["letters"].alias("letters"), spans.alias("spans")).cast(state)

            return let(new, judge)

        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), zero, step, lambda acc: acc["spans"])

    return F.transform(let(signs, slide), lambda s: F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def secret_spans(docs: DataFrame, rule: Entropy = Entropy(), text_col: str = "text", into: str = "spans") -> DataFrame:
    """`docs` with the column `into`, array<struct<kind, start, end>>: in code points, end exclusive, by start, then by kind as in KINDS; a column of that name is replaced.

    Base kinds: assignments with a value of 8 or more characters, access keys, long hex strings. The entropy kinds
    are windows in candidate strings that no allow-list entry fits wholly, that hold no placeholder and that no base span covers. A null text has no spans. Ids are not looked at.
    """
    base_col, candidate_col = unused("base", docs), unused("candidates", docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.filter(F.array(F.struct(F.lit("").alias("kind"), F.lit(0).alias("start"), F.lit(0).alias("end"))), lambda x: F.lit(False))

    def named(kind: str, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["word"]) >= 8)
    base = F.concat(named("assign", assign), named("access", matches(text, ACCESS)), named("hex", matches(text, HEX)))
    with_base = docs.withColumn(base_col, base)
    allowed = "^(?:" + "|".join(f"(?:{p})" for p in rule.allow_list) + ")$"
    # a candidate has to hold a digit: most long words of prose go here, before any window is looked at
    plausible = lambda m: (F.length(m["word"]) >= rule.window) & m["word"].rlike("[0-9]") & ~m["word"].rlike(allowed)
    marker = "(?i:" + "|".join(rule.placeholders) + ")"
    between = f"{marker}|(?:(?!{marker}).)+"  # a placeholder, or all up to the next one
    parts = lambda m: F.when(
        m["word"].rlike(marker),
        F.transform(matches(m["word"], between), lambda p: F.struct((m["start"] + p["start"]).alias("start"), (m["start"] + p["end"]).alias("end"), p["word"].alias("word"))),
    ).otherwise(F.array(m))
    candidates = F.flatten(F.transform(F.filter(matches(text, CANDIDATE % rule.window), plausible), parts))
    with_candidates = with_base.withColumn(candidate_col, F.filter(candidates, plausible))
    added = F.flatten(F.transform(candidate_col, lambda m: entropy_spans(m["word"], m["start"], rule)))
    added = let(added, lambda x: F.when((F.size(x) > 0) & (F.size(base_col) > 0), uncovered(x, F.col(base_col))).otherwise(x))
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.transform(F.concat(base_col, F.when(F.size(candidate_col) > 0, added).otherwise(none)), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return with_candidates.withColumn(into, spans).drop(base_col, candidate_col)


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, rule: Entropy = Entropy(), mark: str = "[SECRET]") -> DataFrame:
    """`docs` with each secret span of `text` replaced by a mark, overlapping spans by one; n_chars follows. Other rows are as they were."""
    spans = unused("spans", docs)
    found = secret_spans(docs, rule, into=spans)
    text = F.col("text")
    state = "struct<pos:int,text:string>"

    def add(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0)))
        inside = s["start"] < acc["pos"]
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(inside, acc["text"]).otherwise(F.concat(acc["text"], between, F.lit(mark))).alias("text")).cast(state)

    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("text")).cast(state)
    cleaned = F.aggregate(spans, zero, add, lambda acc: F.concat(acc["text"], F.substring(text, acc["pos"] + 1, F.length(text))))
    done = found.withColumn("text", F.when(F.size(spans) > 0, cleaned).otherwise(text)).drop(spans)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done
