import math
from collections import Counter

import pytest
from farelens.llm import lm_scoring
from pyspark.sql import types as T

from .helpers import documents
from .test_suffix_match import split

IDS = T.StructType([T.StructField("doc_id", T.LongType())])


def brute(rows, target, size):
    """Both losses of every row from plain counts."""
    count = Counter(w for _, t in rows for w in split(t))
    vocab = {w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0].encode()))[:size]}
    marked = [(i, [w if w in vocab else None for w in split(t)]) for i, t in rows]
    v = len(vocab) + 2

    def model(docs):
        pairs = Counter(p for w in docs if w for p in zip(["<s>", *w], w))
        before, seen = Counter(), Counter()
        for (a, b), n in pairs.items():
            before[a] += n
            seen[b] += n
        whole = sum(seen.values())

        def loss(a, b):
            u = seen[b] / max(whole, 1)
            return -math.log(lm_scoring.BIGRAM * (pairs[a, b] / before[a] if before[a] else u) + lm_scoring.UNIGRAM * u + (1 - lm_scoring.BIGRAM - lm_scoring.UNIGRAM) / v)

        return loss

    losses = model([w for i, w in marked if i in target]), model([w for _, w in marked])
    out = []
    for i, w in marked:
        x = [sum(f(a, b) for a, b in zip(["<s>", *w], w)) / len(w) if w else 0.0 for f in losses]
        out.append((i, len(w), *x, x[0] - x[1]))
    return sorted(out, key=lambda r: str(r[:2]))


ROWS = [(1, "the cat sat on the mat"), (2, "The dog sat, on the log!"), (3, "zig zag zug zag"), (4, None), (5, ""), (6, "cat cat"), (6, "cat cat"), (None, "the mat"), (7, "zag the zug " * 3000), (8, "é 日本 the")]


@pytest.mark.parametrize("size", [3, 50])
def test_same_as_plain_counts(spark, monkeypatch, size):
    monkeypatch.setattr(lm_scoring, "COUNTED_WORDS", 4)
    docs = documents(spark, ROWS, clash=True)
    target = spark.createDataFrame([(1,), (2,), (2,), (6,), (None,), (99,)], IDS)
    got = lm_scoring.scored(docs, lm_scoring.train(docs, target, size=size)).collect()
    want = brute(ROWS, {1, 2, 6}, size)
    rows = sorted(map(tuple, got), key=lambda r: str(r[:2]))
    assert [r[:2] for r in rows] == [r[:2] for r in want]
    for a, b in zip(rows, want, strict=True):
        assert a[2:] == pytest.approx(b[2:], abs=1e-5)


def test_target_like_texts_score_lower(spark):
    docs = documents(spark, [(k, "red green blue " * 9 if k % 2 else "one two three " * 9) for k in range(60)])
    target = spark.createDataFrame([(k,) for k in range(1, 30, 2)], IDS)
    score = {r.doc_id: r.score for r in lm_scoring.scored(docs, lm_scoring.train(docs, target)).collect()}
    assert max(score[k] for k in range(1, 60, 2)) < min(score[k] for k in range(0, 60, 2))


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], IDS), documents(spark, [(1, "a b"), (2, None)])
    assert [r.n_words for r in lm_scoring.scored(docs, lm_scoring.train(docs, none)).orderBy("doc_id").collect()] == [2, 0]
    empty = documents(spark, [])
    assert lm_scoring.scored(empty, lm_scoring.train(empty, none)).count() == 0


def test_all_words_count(spark, monkeypatch):
    """Rare words move a score, however many more frequent ones there are."""
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 700)
    rows = [(k, " ".join(f"w{(k * 7 + j) % 2500} w{j}" for j in range(40))) for k in range(200)]
    rows += [(500, "w1 w2 liked w3"), (501, "w1 w2 other w3"), (502, "w1 w2 liked w3"), (502, "w1 w2 liked w3")] + [(600 + k, " ".join(f"w{j}" for j in range(2500))) for k in range(2)]
    docs = documents(spark, rows, clash=True)
    target = spark.createDataFrame([(k,) for k in (1, 2, 3, 502)], IDS)
    model = lm_scoring.train(docs, target)
    want = brute(rows, {1, 2, 3, 502}, 10**9)
    for got in (lm_scoring.scored(docs, model), lm_scoring.scored(documents(spark, rows, partitions=2), model)):
        found = sorted(map(tuple, got.collect()), key=lambda r: str(r[:2]))
        assert [r[:2] for r in found] == [r[:2] for r in want]
        for a, b in zip(found, want, strict=True):
            assert a[2:] == pytest.approx(b[2:], abs=1e-9)
        score = {r[0]: r[4] for r in found}
        assert score[500] < score[501] - 0.1
