"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

duckdb = pytest.importorskip("duckdb")

import corpus_pipeline  # noqa: E402
from tests.llm.test_operators import ENCODING, fingerprint, five_word_sets, fixed, linked, spans  # noqa: E402
from varicube.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(queries.ORACLE_SQL[name])
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    flat = lambda v: round(v, 5) if isinstance(v, float) else v
    want = sorted((tuple(flat(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(flat(r[c]) for c in columns) for r in df.collect()), key=repr) == want


def sha(x):
    return hashlib.sha256(x.encode("utf-8")).hexdigest()


def test_registered_queries_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op2_byte_bpe(spark, SF).collect():
        ids = ENCODING.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(texts[r.doc_id]))
    for r in queries.op6_secret_scan(spark, SF).collect():
        want = spans(texts[r.doc_id])
        base = [s for s in want if s.split(":")[0] in ("assign", "access", "hex")]
        assert (r.spans, r.base_sha256) == (",".join(want), sha(",".join(base)))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
    prints = {i: fingerprint(t, 3) for i, t in texts.items()}
    groups = linked(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    got = queries.op9_simhash(spark, SF).collect()
    assert len(got) == len(texts) and all((r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", groups[r.doc_id]) for r in got)
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op10_url_filter(spark, SF).collect():
        host, path, rule, verdict = fixed(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (r.verdict == verdict if verdict else r.verdict in ("allow", "block"))


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    keep = {r.doc_id for r in queries.op3_quality(spark, SF).collect() if r.keep}
    assert {r.doc_id for r in stages["quality"](spark, docs, SF).collect()} == keep
    ids = sorted(texts)
    sets = five_word_sets([texts[i] for i in ids])
    groups = linked(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    assert {r.doc_id for r in stages["near_duplicates"](spark, docs, SF).collect()} == {ids[g] for g in groups.values()}
    for r in stages["secrets"](spark, docs, SF).collect():
        assert r.text == texts[r.doc_id] if not spans(texts[r.doc_id] or "") else "[SECRET]" in r.text
    for r in stages["tokens"](spark, docs, SF).collect():
        assert list(r.ids) == ENCODING.encode_ordinary(texts[r.doc_id] or "") and r.text == (texts[r.doc_id] or "")


def test_pipeline_on_odd_input(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    full = {f.name: None for f in schema.fields}
    rows = [full | {"doc_id": i, "text": t} for i, t in [(None, "a b"), (None, None), (1, None), (1, ""), (2, "One two three."), (2, "Four five six."), (2, "Four five six.")]]
    for given in ([], rows):
        docs = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in given], schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == [f.name for f in schema.fields], name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert {r.text for r in out.collect()} >= ({"One two three.", "Four five six.", "a b"} if given else set())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mixing", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        ids, given = [r.doc_id for r in rows], {r.doc_id for r in docs.collect()}
        assert set(ids) <= given
        if name in ("secrets", "mixing"):
            assert set(ids) == given
        docs = spark.createDataFrame(rows, docs.schema)
    last = {(r.doc_id, r.text) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert last == {(r.doc_id, r.text) for r in rows} and 0 < len({i for i, _ in last}) < len(before)
    assert {i for i, _ in last} == {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
