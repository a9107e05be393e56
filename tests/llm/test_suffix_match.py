import hashlib
import random
import re

import numpy as np
import pytest
from farelens.llm import suffix_match
from pyspark.sql import types as T

from .helpers import as_dicts, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, found, longest = split(text), set(), set(), 0
        for item, passage in items:
            p = split(passage)
            k = min(window, len(p))
            for a in range(len(p) - k + 1) if p else ():
                for b in range(len(w) - k + 1):
                    if w[b : b + k] == p[a : a + k]:
                        hit |= set(range(b, b + k))
                        found.add("" if item is None else str(item))
                        n = k
                        while a + n < len(p) and b + n < len(w) and p[a + n] == w[b + n]:
                            n += 1
                        longest = max(longest, n)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), longest))
    return sorted(out, key=str)


@pytest.fixture()
def made():
    rng = random.Random(3)
    vocab = ["a", "b", "Cé", "d9", "日本"]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(k, text(rng.randint(11, 30))) for k in range(12)] + [(50, "Tiny One!"), (51, "Solo"), (None, text(14)), (53, None), (54, "..."), (2, text(12))]
    whole = [t for _, t in items if t]
    docs = [(k, f"{text(rng.randint(0, 30))}. {rng.choice(whole).upper()}-x {text(5)}" if k % 2 else text(rng.randint(0, 50))) for k in range(50)]
    return docs + [(900, None), (901, ""), (902, "solo"), (902, "solo"), (None, items[0][1]), (904, "tiny,one"), (905, text(3000))], items


@pytest.mark.parametrize("most", [1 << 20, 200])
def test_same_as_brute_force(spark, made, most):
    docs, items = made
    got = suffix_match.contamination(documents(spark, docs, clash=True), spark.createDataFrame(items, ITEMS), most=most)
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, r.longest) for r in got.collect()]
    assert sorted(rows, key=str) == brute(docs, items)


def test_location_of_the_longest_match(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = [(1, "x y " + " ".join(f"w{k}" for k in range(5, 20)) + " z " + " ".join(f"w{k}" for k in range(2, 13)))]
    r = as_dicts(suffix_match.contamination(documents(spark, docs), spark.createDataFrame([(7, item)], ITEMS)))[1]
    assert (r["longest"], r["longest_item"], r["longest_item_at"], r["longest_at"], r["n_hit"]) == (15, "7", 5, 2, 26)


def test_documents_that_stay(spark):
    item = " ".join(f"w{k}" for k in range(12))
    docs = documents(spark, [(1, f"so {item} so"), (2, "clean"), (3, None), (4, item[:20])], clash=True)
    kept = suffix_match.decontaminate(docs, spark.createDataFrame([(7, item)], ITEMS))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], ITEMS), documents(spark, [(1, "a b")])
    assert [(r.n_words, r.n_hit) for r in suffix_match.contamination(docs, none).collect()] == [(2, 0)]
    assert suffix_match.contamination(documents(spark, []), none).count() == 0


def test_suffix_array_is_sorted():
    seq = np.random.default_rng(0).integers(0, 3, 400).astype("int32")
    seq = np.concatenate((seq, np.zeros(20, "int32")))
    sa = suffix_match.suffix_array(seq, 16)
    rows = [tuple(seq[i : i + 16]) for i in sa]
    assert rows == sorted(rows) and sorted(sa) == list(range(len(seq)))


def test_a_long_item_costs_memory_by_its_length():
    long = [f"w{k}".encode() for k in range(50_000)]
    items = suffix_match.compile_items([("short", b"a b c"), ("long", b" ".join(long))], 10)
    assert sum(x.nbytes for x in items.values() if isinstance(x, np.ndarray)) < 100 * len(long)
    doc = [b"x"] * 7 + long[20_000:23_000] + [b"y"]
    (n, spans, names, longest, item, item_at, at), = suffix_match.match_block([doc], items)
    assert (n, spans, names, longest, item, at) == (3_008, [{"first": 7, "after": 3_007}], ["long"], 3_000, "long", 7)
    assert long[item_at : item_at + longest] == doc[7:3_007]


def test_ties_and_longest_matches_against_all_pairs():
    rng = random.Random(8)
    word = lambda n: [rng.choice([b"a", b"b"]) for _ in range(n)]
    lead = word(6)
    items = [(f"i{k}", lead + word(rng.randint(0, 9))) for k in range(20)] + [("s", lead[:3]), ("t", lead[:3])]
    docs = [word(5) + rng.choice(items)[1] + word(5) for _ in range(25)]
    compiled = suffix_match.compile_items([(n, b" ".join(w)) for n, w in items], 6)
    for doc, got in zip(docs, suffix_match.match_block(docs, compiled), strict=True):
        best = (0, 0, None)
        for place in range(len(doc)):
            for k, (_, w) in enumerate(items):
                for at in range(len(w) - min(6, len(w)) + 1):
                    n = 0
                    while at + n < len(w) and place + n < len(doc) and w[at + n] == doc[place + n]:
                        n += 1
                    if n >= min(6, len(w)):
                        best = max(best, (n, -place, (-k, -at)), key=lambda x: (x[0], x[1], x[2] or ()))
        n, place, (k, at) = best
        assert got[3:] == (n, items[-k][0], -at, -place)


def test_shared_leads_cost_no_product():
    import time
    import tracemalloc

    lead = b"once upon a time in a land far far away "
    compiled = suffix_match.compile_items([(f"i{k:03}", lead + f"there was x{k} y{k}".encode()) for k in range(800)], 10)
    docs = [(lead + f"there was x{k % 900} so".encode()).split() for k in range(8000)]
    tracemalloc.start()
    begin = time.perf_counter()
    got = suffix_match.match_block(docs[:10], compiled)
    assert [r[3] for r in got] == [13] * 10 and [r[4] for r in got[:2]] == ["i000", "i001"]
    got = suffix_match.match_block([[w for d in docs for w in d]], compiled)
    took, most = time.perf_counter() - begin, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got[0][2]) == 800 and took < 10 and most < 200 << 20


def test_many_blocks_keep_one_broadcast(spark, monkeypatch):
    sc, alive, most = spark.sparkContext, set(), []
    real = type(sc).broadcast

    def broadcast(self, value):
        shared = real(self, value)
        if isinstance(value, dict) and "vocab" in value:
            alive.add(id(shared))
            most.append(len(alive))
            shared.destroy = lambda blocking=False, f=shared.destroy: (alive.discard(id(shared)), f(blocking))
        return shared

    monkeypatch.setattr(type(sc), "broadcast", broadcast)
    items = [(k, f"item {k} " + " ".join(f"w{k}x{i}" for i in range(12))) for k in range(12)]
    docs = [(k, items[k % 12][1]) for k in range(24)] + [(99, "clean")]
    got = as_dicts(suffix_match.contamination(documents(spark, docs), spark.createDataFrame(items, ITEMS), most=60))
    assert len(most) > 5 and max(most) == 1
    assert all(got[k]["n_hit"] == 14 and got[k]["n_items"] == 1 for k in range(24)) and not got[99]["contaminated"]
