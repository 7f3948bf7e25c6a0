"""Long texts with many secrets, and labels of pages by the documents that they carry."""

import random

from pyspark.sql import functions as F

from tests.llm.test_operators import documents, spans
from varicube.llm import secrets, urls


def test_a_text_with_fifty_thousand_matches(spark):
    text = " ".join(f"AKIA{'BCDEFGH'[i % 7] * (12 + i % 3)}" for i in range(50_000))
    r = secrets.secret_spans(documents(spark, [text])).select(secrets.written(F.col("spans")).alias("s")).first()
    assert r.s == ",".join(spans(text)) and r.s.count("access") == 50_000


def test_many_overlapping_kinds(spark):
    rng = random.Random(2)
    bits = ["token=", "secret: ", "AKIA", "deadbeef" * 4, "0f" * 17, "Zk3", "q9Lm2Xv7Tt0Pw4Rn8Bc5", " ", " ", "/", "example", "word "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(60)]
    got = secrets.secret_spans(documents(spark, texts)).select("doc_id", secrets.written(F.col("spans")).alias("s"))
    assert {r.doc_id: r.s for r in got.collect()} == {i: ",".join(spans(t)) for i, t in enumerate(texts)}


def test_pages_have_the_labels_of_their_texts(spark):
    line = lambda k: f"This is line number {k} of a text & long enough to count."
    docs = [(1, f"{line(1)}\n{line(2)}\nshort"), (2, f"{line(3)}\n{line(4)}\n{line(5)}"), (3, line(5)), (4, line(6)), (5, None), (6, line(7))]
    labels = [(1, True), (2, False), (3, True), (4, None), (5, True), (99, True)]
    html = lambda *lines: "<html><script>var x='<p>';</script><!-- a > b --><p>short</p>" + "".join(f"<p>  {x.upper().replace('&', '&amp;')}</p>" for x in lines)
    pages = [(10, html(line(1))), (11, html(line(3), line(1))), (12, html(line(3), line(4), line(1))), (13, html(line(5))), (14, html(line(6), line(7))), (15, None), (None, html(line(1))), (16, "")]
    df = spark.createDataFrame(pages, "page_id long, html string").withColumns({c: F.lit(1) for c in ("passage", "share", "bad", "doc_id")})
    got = urls.page_labels(df, documents(spark, []).limit(0).select("doc_id", "text").unionByName(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(labels, "doc_id long, bad boolean"))
    # line 5 is in a bad and in a good document; 14 holds passages of documents without a label only
    assert {r.page_id: r.bad for r in got.collect()} == {10: True, 11: True, 12: False, 13: True}
