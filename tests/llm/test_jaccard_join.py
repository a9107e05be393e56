import random

import numpy as np
import pytest
from farelens.llm import jaccard_join

from .helpers import as_dicts, documents
from .test_suffix_match import split


def shingles(text, size=5):
    w = split(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    """Class and links of every row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    near = [[j for j, b in enumerate(sets) if i != j and a and b and len(a & b) * 10 >= threshold * 10 * len(a | b)] for i, a in enumerate(sets)]
    out = []
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc, min(ids, default=None) if sets[i] else doc, len(near[i])))
    return sorted(out, key=str)


def made(seed=4, groups=14):
    rng = random.Random(seed)
    text = lambda n: [rng.choice([f"w{k}" for k in range(3000)]) for _ in range(n)]
    rows, i = [], 0
    for _ in range(groups):
        base = text(rng.randint(60, 200))
        for _ in range(rng.choice([1, 2, 3, 12])):
            edited = list(base)
            for _ in range(rng.randint(0, 3)):
                edited[rng.randrange(len(edited))] = f"x{rng.random()}".replace(".", "")
            rows.append((i, rng.choice([" ", "\n", ", "]).join(edited)))
            i += 1
    same = rows[2][1]
    return rows + [(500, same), (501, same.upper()), (502, None), (503, ""), (504, "..."), (505, "two words"), (506, "Two, words"), (506, "Two, words"),
                   (None, same), (507, " ".join(text(5000))), (None, "quite other words that nobody else has written")]


def marks(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


def test_same_as_all_pairs(spark):
    rows = made()
    assert marks(jaccard_join.near_copies(documents(spark, rows, clash=True))) == brute(rows)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", 4)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(70):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([0, 1, 2, 3])):
            w[at] = f"y{rng.randint(0, 10**9)}"
        rows.append((k, " ".join(w)))
    want = brute(rows)
    assert len({n for _, _, n in want}) > 5
    assert marks(jaccard_join.near_copies(documents(spark, rows))) == want


def test_one_of_each_group_stays(spark):
    rows = [(i, t) for i, t in made(5, 6) if i != 506 or t != "Two, words"] + [(506, "two WORDS")]
    docs = documents(spark, rows, clash=True)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute(rows)
    without = sorted(i for i, t in rows if not shingles(t))
    groups = {c for i, c, _ in want if i not in without}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x in without) == without and len(ids) - len(without) == len(groups)


def test_empty_table(spark):
    assert jaccard_join.near_copies(documents(spark, [])).count() == 0
    assert as_dicts(jaccard_join.near_copies(documents(spark, [(4, "a b c d e f")])))[4] == {"doc_id": 4, "class_id": 4, "n_links": 0}


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.choose_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= jaccard_join.RECALL and 1 - (1 - 0.4**rows) ** bands <= 0.2
    rng, found = np.random.default_rng(0), 0
    for _ in range(40):
        common = rng.integers(1, 1 << 62, 1000, dtype="uint64")
        s = jaccard_join.Shingles([], jaccard_join._hasher(), 5)
        s.sets = [np.unique(np.concatenate((common, rng.integers(1, 1 << 62, 125, dtype="uint64")))) for _ in range(2)]
        s.sizes, s.flat = np.array([len(x) for x in s.sets]), np.concatenate(s.sets)
        b = s.bands(bands, rows)
        found += bool((b[0] == b[1]).any())
    assert found == 40


@pytest.mark.parametrize("k", [2, 9, 40])
def test_overlaps(k):
    rng = np.random.default_rng(k)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype("uint64")) for _ in range(k)]
    got = jaccard_join.overlaps(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(k) for j in range(k) if i != j)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(30)] + [(50, 40), (41, 50), (60, 60)]
    frame = spark.createDataFrame([(f"{a:03}", f"{b:03}") for a, b in pairs], "a string, b string")
    got = {r.node: r.root for r in jaccard_join.components(frame).collect()}
    assert got == {f"{k:03}": "000" for k in range(31)} | {"040": "040", "041": "040", "050": "040"}
