"""Hard negatives, the prefix trie and chat formatting against brute force, with nulls, ties, repeated and empty rows, long conversations and clashing columns."""

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from varicube.llm import chat, negatives, trie, vectors

EMPTY = hashlib.sha256(b"").hexdigest()


# --- 11: hard negatives

def brute_negatives(rows, anchor):
    out = []
    good = [r for r in rows if None not in r]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for v, label, w in good:
        if not anchor(v):
            continue
        scored = sorted(((dot(w, x), u, m) for u, m, x in good if u != v), key=lambda s: (-s[0], s[1]))
        for score, u, _ in [s for s in scored if s[2] == label][:5]:
            hard = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score][:3]
            out += [(v, u, k, h[1], score, h[0]) for k, h in enumerate(hard, 1)]
    return sorted(out)


def vectors_of(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, weights array<long>")
    return df.withColumns({c: F.lit("x") for c in ("anchor", "block", "share", "score", "place", "rank")})


@pytest.mark.parametrize("near, size, block", [(False, 1024, 8192), (False, 6, 40), (True, 8, 50)])
def test_hard_negatives_against_all_pairs(spark, near, size, block):
    rng = np.random.default_rng(size)
    centers = rng.normal(size=(6, 16)) * 60
    rows = []
    for i in range(240):
        x = centers[rng.integers(6)] + rng.normal(size=16) * (3 if near else 40)
        rows.append((i, int(rng.integers(4)), [int(v) for v in x]))
    rows += [rows[3], rows[7], (500, 1, rows[9][2]), (501, 1, rows[9][2]), (502, 2, [1, 2]), (None, 1, rows[0][2]), (503, None, rows[0][2]), (510, 1, None), (504, 3, [0] * 16), (-5, 1, rows[4][2])]
    got = negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 5 == 0, size=size, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda v: v % 5 == 0)


def test_hard_negatives_odd_input(spark):
    none = vectors_of(spark, [(1, 1, [2, 3])]).limit(0)
    assert negatives.hard_negatives(none, F.col("vec_id") % 5 == 0).count() == 0
    assert negatives.hard_negatives(vectors_of(spark, [(1, 1, [2, 3])]), F.col("vec_id") % 5 == 0).count() == 0
    # a repeated anchor has its results twice; scores beyond what floats hold are exact
    big = 2**27 + 1
    rows = [(5, 1, [big, 3]), (5, 1, [big, 3]), (6, 1, [big, 5]), (7, 2, [big // 2 + 7, 1]), (8, 2, [big, 5])]
    got = sorted(map(tuple, negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 5 == 0).collect()))
    assert got == brute_negatives(rows, lambda v: v % 5 == 0) and len(got) == 2
    with pytest.raises(OverflowError):
        negatives.hard_negatives(vectors_of(spark, [(5, 1, [2**31]), (6, 1, [2**31])]), F.col("vec_id") % 5 == 0)


def test_bounds_spare_work_and_lose_nothing():
    rng = np.random.default_rng(1)
    anchors = np.repeat(rng.normal(size=(3, 32)) * 100, 20, axis=0) + rng.normal(size=(60, 32))
    rows = rng.normal(size=(500, 32)) * 100
    order, parent, length = negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(60)) and (length[order[1:]] > 0).all()
    assert sum(length > 50) == 2  # of a minimum tree, two edges join the three clusters
    place = np.argsort(order)
    up = np.where(parent < 0, -1, place[parent])[order]
    assert (up < np.arange(60)).all()
    cut = 20_000
    scored = 0
    for i, open_, scores in negatives.walked(anchors[order], up, length[order], rows, np.linalg.norm(rows, axis=1), lambda i, low, high: high >= cut):
        exact = rows @ anchors[order][i]
        assert set(np.flatnonzero(exact >= cut)) <= set(open_.tolist())
        assert np.array_equal(scores, exact[open_].astype(np.int64))
        scored += len(open_)
    assert scored < 0.5 * 60 * 500


# --- 5: repeated queries

def test_repeated_queries_have_places_of_their_own(spark):
    rows = spark.createDataFrame([(i, [i % 7, i % 3]) for i in range(30)], "vec_id long, weights array<long>")
    one = rows.where("vec_id = 20")
    single = sorted(map(tuple, vectors.top_k(one, rows, k=5).collect()))
    assert len(single) == 5 and sorted(map(tuple, vectors.top_k(one.union(one), rows, k=5, block=8).collect())) == sorted(single * 2)


# --- 12: prefix trie

def brute_trie(rows, base, head):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {c: own.get(base(c), [])[: head(c)] + t[head(c) :] for c, t in own.items()}
    nodes = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    out = []

    def words(text):
        return len(text.encode().split())

    totals = {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves, saved = (0, 0) if kids[k] else (1, 0)
        saved += (len(nodes[k]) - 1) * words(k[-1][1]) if k else 0
        for c in kids[k]:
            leaves, saved = leaves + totals[c][0], saved + totals[c][1]
        totals[k] = leaves, saved
        ended = sorted(c for c in nodes[k] if len(rebuilt[c]) == len(k))
        out.append((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(kids[k]), leaves, saved, hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("x") for c in ("fp", "depth", "key", "words", "part", "place", "base", "head")})


def some_turns(rng, convs, longest=7):
    rows = []
    for c in convs:
        for t in range(rng.randrange(longest + 1)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "b b", "c\td\x0be  f", "", None, "ü é", "x " * 50])))
    return rows


def rule():
    """Columns of a conversation's base and of the turns that it takes from there."""
    conv = F.col("conv_id")
    return conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4


def head(c):
    return zlib.crc32(str(c).encode()) % 4


def base(c):
    return c - int(np.fmod(c, 20))


@pytest.mark.parametrize("primes", [trie.PRIMES[:3], (5,)])
def test_prefix_trie_against_brute_force(spark, primes):
    rng = random.Random(len(primes))
    rows = some_turns(rng, [*range(90), *range(200, 219), -7, -41])  # the base of 200 to 219 may be there or not, that of 201 too
    copies = [(1, t, "user", f"same {t}") for t in range(6)]
    rows += [(c, *r[1:]) for r in copies for c in range(300, 420)]  # many that end in one node
    rows += [(30, 2, "user", "twice")] * 2 + [(31, None, "user", "null turn"), (31, None, None, None), (None, 0, "user", "no id"), (32, 0, "user", "first"), (32, 1, "user", "first")]
    rng.shuffle(rows)
    got = trie.prefix_trie(conversations(spark, rows), *rule(), primes=primes)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows, base, head)


def test_prefix_trie_of_conversations_over_several_tasks(spark):
    rows = [(c, t, "user", f"t{t % 7}") for c in (0, 1, 40) for t in range(2500 - 3 * c)] + [(c, 0, "user", "t0") for c in range(2, 9)]
    got = trie.prefix_trie(conversations(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows, lambda c: c, lambda c: 0)
    # heads longer than the base
    far = trie.prefix_trie(conversations(spark, rows), F.col("conv_id") * 0, F.lit(2450))
    assert sorted(map(tuple, far.collect()), key=repr) == brute_trie(rows, lambda c: 0, lambda c: 2450)


def test_prefix_trie_of_nothing(spark):
    assert trie.prefix_trie(conversations(spark, [(None, 1, "user", "x")])).count() == 0
    assert [tuple(r)[:7] for r in trie.prefix_trie(conversations(spark, [(4, None, None, None)])).orderBy("depth").collect()] == [(4, 0, None, 1, 1, 1, 0), (4, 1, 4, 1, 0, 1, 0)]


def test_products_compose():
    h, rng = trie.Products(), np.random.default_rng(3)
    keys = rng.integers(0, 2**62, 50).astype(np.uint64)
    places = np.arange(50)
    whole = h.scanned(keys, places)
    for cut in (1, 17, 49):
        ending = h.scanned(keys[cut:], np.arange(50 - cut))[:, -1:]
        n = np.array([50 - cut])
        assert np.array_equal(h.joined(whole[:, cut - 1 : cut], ending, n), whole[:, -1:])
        assert np.array_equal(h.ending(whole[:, -1:], whole[:, cut - 1 : cut], n), ending)
    assert np.array_equal(h.without_last(whole[:, 1:], keys[1:]), whole[:, :-1])
    assert np.array_equal(h.array(h.bytes(whole)), whole)


# --- 13: chat formatting

def test_layouts_by_fingerprint(spark):
    message = lambda r, t: {"role": r, "content": t}
    cases = [
        ({"messages": [message("user", "a"), message("gpt", None)], "source": {"x": [1]}}, "messages", [("user", "a"), ("assistant", "")]),
        ({"messages": [message("user", [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}])]}, "message parts", [("user", "ab")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "tool", "value": "s"}]}, "conversations", [("user", "q"), ("assistant", "r"), ("tool", "s")]),
        ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
        ({"instruction": "do", "output": None, "system": "be"}, "instruction", [("system", "be"), ("user", "do"), ("assistant", "")]),
        ({"prompt": "p", "response": "r"}, "prompt and response", [("user", "p"), ("assistant", "r")]),
        ({"prompt": "p", "completion": 5}, "prompt and completion", [("user", "p"), ("assistant", "5")]),
        ({"question": "q", "answer": "a", "context": "c"}, "question and answer", [("user", "c\n\nq"), ("assistant", "a")]),
        ({"role": "user", "text": "t"}, "turn", [("user", "t")]),
        ({"prompt": "only"}, None, []),
        ({"messages": []}, None, []),
        ({}, None, []),
    ]
    rows = [(i, json.dumps(c[0])) for i, c in enumerate(cases)] + [(90, None), (91, "no json {"), (92, "[1, 2]")]
    df = spark.createDataFrame(rows, "conv_id long, record string").withColumns({c: F.lit(1) for c in ("layout", "turns", "fingerprint", "messages")})
    got = {r.conv_id: r for r in chat.canonical(df, ["conv_id"], json="record").collect()}
    for i, (_, layout, turns) in enumerate(cases):
        assert (got[i].layout, [tuple(t) for t in got[i].turns]) == (layout, turns), cases[i]
    assert all(got[i].layout is None and got[i].turns == [] for i in (90, 91, 92))
    typed = spark.read.schema("conv_id long, conversations array<struct<`from`:string,value:string>>, note string").json(spark.sparkContext.parallelize(['{"conv_id":1,"conversations":[{"from":"human","value":"q"}]}', '{"conv_id":2}']))
    assert {(r.conv_id, r.layout, tuple(map(tuple, r.turns))) for r in chat.canonical(typed, ["conv_id"]).collect()} == {(1, "conversations", (("user", "q"),)), (2, "conversations", ())}
    assert chat.canonical(spark.createDataFrame([(1, "x")], "conv_id long, other string"), ["conv_id"]).collect()[0].layout is None
    assert chat.paths_of_schema("OBJECT<`a: b`: ARRAY<OBJECT<c: DECIMAL(2,1), d: VOID>>, e: OBJECT<>, f: ARRAY<BIGINT>>") == ["a: b[].c", "a: b[].d", "f[]"]


def test_escapes_are_reversible():
    rng, template = random.Random(5), chat.Template()
    bits = ["\\", "<", ">", "s>", "</s>", "<s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_sep|>", "<|im_end|>", "\\s>", "|im_end|>", "<<SYS>>", "a", "\n", "😀"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(12)))
        out = chat.escaped(text, template.odd())
        assert chat.unescaped(out) == text and not any(c in out for c in template.control)


def told(turns):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    size = sum(len(chat.escaped(x, chat.Template().odd())) for t in turns for x in t) + 32 * len(turns)
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), size)


@pytest.mark.parametrize("most", [1 << 20, 60])
def test_formatting_reads_back(spark, most):
    rng = random.Random(6)
    bits = ["\\", "</s>", "<|im_end|>", "word ", "\n", "ü", "😀", "<|im_sep|>"]
    want, rows = {}, []
    for c in [None, -3, *range(40)]:
        turns = [(rng.choice(["user", "assistant", "", "odd<|im_end|>\nrole"]), "".join(rng.choices(bits, k=rng.randrange(9)))) for _ in range(rng.randrange(1, 9))]
        want[c] = told(turns)
        rows += [(c, t, 0, r or None, x or None) for t, (r, x) in enumerate(turns)]
    rows += [(50, None, None, "user", "b"), (50, 0, 0, "user", "b"), (50, 0, 0, "user", "a"), (50, 0, 0, "user", "a"), (51, 0, 0, "assistant", "long " * 50_000)]
    want |= {50: told([("user", "b"), ("user", "a"), ("user", "a"), ("user", "b")]), 51: told([("assistant", "long " * 50_000)])}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, place long, role string, text string").withColumns({c: F.lit(1) for c in ("part", "formatted", "loss")})
    out = chat.format_turns(df, most=most)
    for in_order in (True, False):
        assert {r.conv_id: tuple(r)[1:] for r in chat.read_back(out, in_order=in_order).collect()} == want
    parts = out.where("conv_id = 7").orderBy("part").collect()
    assert [p.part for p in parts] == list(range(len(parts))) and all(p.formatted[s.start : s.end] in p.formatted for p in parts for s in p.loss)
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0
