"""URL filters: host and path rules, and association rules mined by FP-growth and matched by an inverted index."""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varicube.llm.common import save

#: Verdict, host and path of the fixed rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
BAD = "=bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: then up to ?, # or the end. Both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule whose host is the url's or a parent of it and whose path the url's starts with, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, the host's suffixes and first label, path words, file extension, query keys, fragment. Digits stand as 0."""
    plain = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    words = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), plain(x)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), plain(F.substring_index(x, "=", 1))))
    fragment = F.regexp_extract(url, r"#(.+)$", 1)
    some = lambda kind, c: F.when(c != "", F.array(F.concat(F.lit(kind), plain(c)))).otherwise(F.array().cast("array<string>"))
    parts = [suffixes, words, keys, some("fragment:", fragment), some("scheme:", F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))), some("first:", F.element_at(F.concat(labels, F.array(F.lit(""))), 1))]
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: x.isNotNull() & (x != "host:")))


def passages(text: Column, least: int = 40) -> Column:
    """Hashes of a text's lines of `least` characters or more, without case, each once; white space counts as one space."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"[\r\n]+"), lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " "))))
    return F.array_distinct(F.transform(F.filter(lines, lambda x: F.length(x) >= least), lambda x: F.xxhash64(x)))


# The entities that texts in HTML need.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def plain_text(html: Column) -> Column:
    """A page's text: scripts, styles and comments go, each other tag ends a line, entities are characters."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", "\n")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def page_labels(pages: DataFrame, documents: DataFrame, labels: DataFrame, least: int = 40) -> DataFrame:
    """(page_id, bad) of pages that hold passages of labelled documents; labels: doc_id, bad.

    A page's html carries documents' texts, line by line; numbers of pages and documents have nothing to do with each other. Each passage has the share of bad ones
    among the labelled documents that hold it, and a page is bad if the mean over its passages is a half or more. Passages are counted over all documents before
    pages meet them, so one that many pages and documents share makes no pairs. Null texts have no passages, null ids and labels take no part.
    """
    marked = documents.select("doc_id", passages(F.col("text"), least).alias("passages")).join(labels.where("bad is not null"), "doc_id")
    shares = marked.select(F.explode("passages").alias("passage"), "bad").groupBy("passage").agg(F.avg(F.col("bad").cast("int")).alias("share"))
    held = pages.where("page_id is not null").select("page_id", F.explode(passages(plain_text(F.col("html")), least)).alias("passage"))
    return held.join(shares, "passage").groupBy("page_id").agg((F.avg("share") >= 0.5).alias("bad"))


def mine_rules(urls: DataFrame, labels: DataFrame, least_support: float = 0.002, least_count: int = 20, least_confidence: float = 0.6, least_lift: float = 1.5) -> DataFrame:
    """(rule_id, items, confidence, support) of token combinations that imply a bad label.

    urls: key, items; labels: key, bad (boolean; null rows are left out). FP-growth mines all labelled urls; a url with several labels counts once and is
    bad if one of them is. A rule has to fit a share `least_support` of the labelled urls and `least_count` of them, be right in `least_confidence` of these, and
    `least_lift` times as often as a guess. A rule is dropped if a rule on part of its tokens has as high a confidence. No labelled url, or none that is bad, gives no rule.
    """
    spark = urls.sparkSession
    marks = labels.where("bad is not null").groupBy("key").agg(F.max("bad").alias("bad"))
    baskets = urls.join(marks, "key").select(F.concat("items", F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array(F.lit("=good")))).alias("items"))
    baskets = save(baskets, "baskets")
    n = baskets.count()
    if n < least_count:
        return spark.createDataFrame([], "rule_id long, items array<string>, confidence double, support double")
    found = FPGrowth(itemsCol="items", minSupport=max(least_support, least_count / n), minConfidence=least_confidence).fit(baskets).associationRules
    found = found.where(F.col("consequent") == F.array(F.lit(BAD))).where((F.col("lift") >= least_lift) & ~F.array_contains("antecedent", "=good"))
    rules = save(found.select(F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("items"), "confidence", "support"), "rules")
    # a part of a rule shares its items: rules meet through the part's items, and all of them have to be there
    part = rules.select(F.col("rule_id").alias("part_id"), F.col("confidence").alias("part_confidence"), F.size("items").alias("part_size"), F.explode("items").alias("item"))
    whole = rules.select("rule_id", "confidence", F.size("items").alias("size"), F.explode("items").alias("item"))
    shared = whole.join(part, "item").where("part_size < size and part_confidence >= confidence").groupBy("rule_id", "part_id", "part_size").count()
    return rules.join(shared.where(F.col("count") == F.col("part_size")).select("rule_id").distinct(), "rule_id", "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, n_rules) of the urls that hold all tokens of some rule. The index leads from each rule's least frequent token to the rule."""
    items = urls.select("key", "items")
    posted = rules.select("rule_id", "items", F.explode("items").alias("item"))
    use = items.select(F.explode("items").alias("item")).join(posted.select("item").distinct(), "item", "left_semi").groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    index = posted.join(use, "item", "left").groupBy("rule_id").agg(F.first("items").alias("rule_items"), F.min_by("item", F.struct(F.coalesce("n", F.lit(0)), "item")).alias("item"))
    index = save(index, "rule-index")
    hits = items.withColumn("item", F.explode("items")).join(index, "item").where(F.size(F.array_except("rule_items", "items")) == 0)
    return hits.groupBy("key").agg(F.countDistinct("rule_id").alias("n_rules"))


def url_verdicts(pages: DataFrame, labels: DataFrame, rules=RULES, **options) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_rules) per row of `pages`.

    The longest fixed rule that fits decides; else the url is blocked if it matches a mined rule and allowed if not. labels: page_id, bad.
    Urls are matched once each, however many pages have them; a repeated page id keeps its rows, and all its labels mark its urls. A null url has empty host and path and
    is allowed; a null page id has no label.
    """
    url = F.coalesce("url", F.lit(""))
    host, path = host_and_path(url)
    parsed = pages.select(F.col("page_id"), F.col("url").alias("key"), host.alias("host"), path.alias("path"))
    items = save(parsed.where("key is not null").select("key", "host", "path").distinct().select("key", tokens(F.col("key"), F.col("host"), F.col("path")).alias("items")), "url-items")
    marks = pages.select("page_id", F.col("url").alias("key")).join(labels.select(F.col("page_id").alias("label_id"), "bad"), F.col("page_id") == F.col("label_id")).select("key", "bad")
    found = matched(items, mine_rules(items, marks, **options))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    joined = parsed.join(found, "key", "left").withColumn("n_rules", F.coalesce("n_rules", F.lit(0)))
    return joined.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("n_rules") > 0, "block").otherwise("allow")).alias("verdict"), "n_rules")
