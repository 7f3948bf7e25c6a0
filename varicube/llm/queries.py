"""The registered query of each operator, with its production parameters, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import json

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varicube.llm import bpe, chat, chunks, lm, mixing, negatives, quality, secrets, simhash, trie, urls, vectors
from varicube.llm.common import table


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    tokens = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.decode(tokens, ranks).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"))


def op4_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm.stupid_backoff(table(spark, sf_dir, "documents"))
    return scores.withColumn("score", F.round("score", 6))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(vectors.finite())
    weights = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(64) * x.cast("double"))).alias("weights"))
    return vectors.top_k(weights.where("vec_id % 20 = 0"), weights)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixing_rates(docs, docs.select("doc_id", "text", F.col("lang").alias("domain")))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.spans_by_document(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    written = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), removed.cast("long").alias("n_removed"), written.alias("spans"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, documents = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urls.url_verdicts(pages, urls.page_labels(pages, documents, labels))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(vectors.finite())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    weights = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")))
    return negatives.hard_negatives(rows.select("vec_id", label.alias("label"), weights.alias("weights")), F.col("vec_id") % 50 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table's rows are turns; a record in the layout of message lists joins them
    rows = chat.canonical(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), ["conv_id", "turn"])
    text = "</s>[INST] ok [/INST]"
    record = json.dumps({"messages": [{"role": r, "content": text} for r in ("user", "assistant")]})
    more = chat.canonical(spark.createDataFrame([(-7, record)], "conv_id long, record string"), ["conv_id"], json="record")
    turns = chat.turns_of(rows, "turn").unionByName(chat.turns_of(more))
    return chat.read_back(chat.format_turns(turns), in_order=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_vectors, op2_byte_bpe, op3_quality, op4_backoff_scores, op5_top_k, op6_secret_scan, op7_mixing, op8_substrings, op9_simhash, op10_url_filter, op11_hard_negatives,
        op12_prefix_trie, op13_chat_format,
    )
}

VALID = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

ORACLE_SQL = {
    "op1_near_vectors": f"""
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e
  from embeddings where {VALID} and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
  where list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.9
), reach as (
  select vec_id as n, vec_id as r from embeddings
  union
  select reach.n, links.b from reach join links on reach.r = links.a
), least as (select n, min(r) as component_id from reach group by n),
degree as (select a, count(*) as n_links from links group by a)
select e.vec_id, coalesce(d.n_links, 0) as n_links, l.component_id, e.vec_id = l.component_id as kept
from embeddings e join least l on e.vec_id = l.n left join degree d on d.a = e.vec_id""",
    "op4_backoff_scores": r"""
with w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents
), t as (select sum(len(words)) as total from w),
u as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as i from w),
p as (select a.doc_id, a.i, a.word, b.word as prev from u a left join u b on a.doc_id = b.doc_id and b.i = a.i - 1),
c1 as (select word, count(*) as n from u group by word),
own1 as (select doc_id, word, count(*) as n from u group by doc_id, word),
c2 as (select prev, word, count(*) as n from p where prev is not null group by prev, word),
own2 as (select doc_id, prev, word, count(*) as n from p where prev is not null group by doc_id, prev, word),
s as (
  select p.doc_id, p.prev is not null as pair, coalesce(c2.n - own2.n, 0) as n2, cb.n - ob.n as nb, cw.n - ow.n as n1,
         greatest(1, (select total from t) - len(w.words)) as others
  from p join w on w.doc_id = p.doc_id
  join c1 cw on cw.word = p.word join own1 ow on ow.doc_id = p.doc_id and ow.word = p.word
  left join c1 cb on cb.word = p.prev left join own1 ob on ob.doc_id = p.doc_id and ob.word = p.prev
  left join c2 on c2.prev = p.prev and c2.word = p.word
  left join own2 on own2.doc_id = p.doc_id and own2.prev = p.prev and own2.word = p.word
), l as (
  select doc_id, case when n2 > 0 then ln(n2 / nb) else ln(greatest(n1, 1) / others) + case when pair then ln(0.4) else 0 end end as score from s
)
select w.doc_id, cast(len(w.words) as bigint) as n_words, (select round(sum(l.score) / len(w.words), 6) from l where l.doc_id = w.doc_id) as score from w""",
    "op5_top_k": f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as w from embeddings where {VALID}
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.w, c.w) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20""",
    "op11_hard_negatives": f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as w
  from embeddings where label is not null and {VALID}
), s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_inner_product(a.w, c.w) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as int) as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3""",
    "op12_prefix_trie": r"""
with t as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as i
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null) x
), n as (select conv_id, count(*) as n from t group by conv_id),
c as (
  select conv_id, conv_id - conv_id % 20 as base, xor(list_reduce(list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
    lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295), 4294967295) % 4 as h from n
), r as (
  select c.conv_id, i as d, role, text from c join t on t.conv_id = c.base and i <= h
  union all
  select c.conv_id, least(h, coalesce(n.n, 0)) + i - h, role, text from c join t on t.conv_id = c.conv_id and i > h left join n on n.conv_id = c.base
), p as (
  select conv_id, d, string_agg(sha256(length(role) || ':' || role || text), ',') over (partition by conv_id order by d) as path,
         len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words, max(d) over (partition by conv_id) as last
  from r
  union all
  select c.conv_id, 0, '', 0, (select coalesce(max(d), 0) from r where r.conv_id = c.conv_id) from c
), node as (
  select d, path, min(conv_id) as id, count(*) as n, any_value(words) as words, count(*) filter (last = d) as ends, string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (last = d) as ended
  from p group by d, path
), sub as (
  select p.d, p.path, sum((u.n - 1) * u.words) as saved, count(*) filter (u.n = u.ends) as leaves from node u join p on p.conv_id = u.id and p.d <= u.d group by p.d, p.path
), up as (
  select node.d, node.path, parent.id from node join p on p.conv_id = node.id and p.d = node.d - 1 join node parent on parent.d = p.d and parent.path = p.path
), kids as (select parent.d, parent.path, count(*) as n from node join p on p.conv_id = node.id and p.d = node.d - 1 join node parent on parent.d = p.d and parent.path = p.path group by parent.d, parent.path)
select node.id as conv_id, cast(node.d as bigint) as depth, up.id as parent_conv_id, node.n as n_convs, coalesce(kids.n, 0) as n_children, leaves as n_leaves, cast(saved as bigint) as saved_tokens, sha256(coalesce(ended, '')) as ends_sha256
from node join sub on sub.d = node.d and sub.path = node.path left join up on up.d = node.d and up.path = node.path left join kids on kids.d = node.d and kids.path = node.path""",
    "op13_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m as (
  select *, 32 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '\\|<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>')) as size from t
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256, cast(sum(size) as bigint) as formatted_chars
from m group by conv_id""",
}
