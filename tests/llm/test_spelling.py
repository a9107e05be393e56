import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from farelens.llm import spelling

from .helpers import documents


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, ratio=5):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}

    around = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, some in around.items():
        best = min(some, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (w, form[w], root(w), words[w], len(around[w]), words.get(form[w])) for w in words}


def check(spark, rows, **options):
    got = spelling.variants(documents(spark, rows, clash=True), **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = got.collect()
    want = brute(rows)
    assert len(got) == len(want) and {r.word: tuple(r) for r in got} == want
    return want


def made():
    rng = random.Random(4)
    rows = [(k, " ".join(w for w in ["kitten", "garden", "étageÿ", "planets"] for _ in range(rng.randint(0, 9)))) for k in range(300)]
    forms = ["kittens", "kittén", "mitten", "mittens", "kiten", "gardens", "gardex", "étageþz", "Étageÿ", "étageÿÿ", "planet", "plänets", "aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa"]
    rows += [(1000 + k, f" {w}, {w}\n" * rng.randint(2, 4)) for w in forms for k in range(rng.randint(1, 5))]
    return rows


@pytest.mark.parametrize("filter_bytes", [64, spelling.FILTER_BYTES])
def test_against_brute_force(spark, filter_bytes):
    want = check(spark, made(), filter_bytes=filter_bytes)
    assert sum(w[1] is not None for w in want.values()) > 5


def test_chains_of_forms(spark):
    rows = [(k, "chains " * n + "chainz " * m) for k, (n, m) in enumerate([(700, 5)] * 2)]
    rows += [(20, "chaits " * 100), (11, "chaixs " * 100), (12, "chaity " * 16), (13, "chait " * 16), (14, "chaitty " * 3 + "chaitys")]
    want = check(spark, rows)
    assert want["chaity"][1] == "chaits" and want["chaity"][2] == "chains"


def test_odd_rows(spark):
    long = "abcdefghij" * 30_000
    rows = [(1, None), (2, ""), (None, "nothing " * 6 + "nothings " * 40), (3, "nothing"), (3, "nothing"), (4, long), (4, long), (5, f"{long} {long} {long}x {long}x {long}x"), (6, f"{long}x {long}x {long}x {long}"),
            (7, "×÷×÷×÷ " * 5 + "×÷×÷×÷à " * 30)]
    want = check(spark, rows)
    assert long in want
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, "short ones only")] * 9)).count() == 0


def test_long_texts_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices(["word", "longer", "éclair", "x" * 90], k=500)) + "!"
    whole = Counter(re.findall("[a-zÀ-ÿ]{6,}", text))
    for size in (1, 7, 64, 5000):
        monkeypatch.setattr(spelling, "CHUNK", size)
        assert sum((Counter(x) for x in spelling.runs(text, 6)), Counter()) == whole


def test_edits_meet_each_pair_once():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(6, 8))) for _ in range(400)})
    sizes = defaultdict(list)
    for w in words:
        sizes[len(w)].append(w)
    shape = {n: (len(v), b"abc") for n, v in sizes.items()}
    met = Counter()
    for v in sizes.values():
        letters = np.frombuffer("".join(v).encode(), "uint8").reshape(len(v), -1)
        for k, edit in spelling.edits(letters, shape, lambda h, n: np.arange(len(h))):
            if edit.decode() in words:
                met[frozenset((v[k], edit.decode()))] += 1
    assert set(met.values()) == {1} and set(met) == {frozenset((a, b)) for a in words for b in words if near(a, b)}


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    order = lambda d: d[sorted(d.columns)].sort_values("word").reset_index(drop=True)
    got, want = order(spelling.op11_spelling_variants(spark, folder).toPandas()), order(db.execute(spelling.OP11_SQL).df())
    pd.testing.assert_frame_equal(got.fillna(-1), want.fillna(-1), check_dtype=False)
    assert len(got) > 500
