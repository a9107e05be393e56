import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from farelens.llm import common, substring_dedup
from farelens.llm.fm_index import FMIndex, Wavelet, repeated_windows

from .helpers import as_dicts, documents, sha

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    docs = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for (i, _), d in zip(rows, docs, strict=True):
        gone = {k for a in range(len(d) - window + 1) if seen[tuple(d[a : a + window])] > 1 for k in range(a, a + window)}
        out.append((i, len(d), len(gone), sha(" ".join(w for k, w in enumerate(d) if k not in gone))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def made(rng, vocab):
    text = lambda n: rng.choices(vocab, k=n)
    shared = [text(n) for n in (34, 35, 36, 50, 90, 200)]
    docs = []
    for k in range(70):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 3)
            parts += [p[a : len(p) - rng.randint(0, 5)], text(rng.randint(0, 20))]
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    same = docs[3][1]
    return docs + [(100, same), (101, same), (102, same), (103, None), (104, ""), (104, ""), (None, same), (105, "Shti " * 300), (106, "a b " * 40 + "c"),
                   (107, " ".join(text(6000))), (108, "\x1cé\xa0 " + " ".join(shared[3])), (109, " ".join(shared[0])), (110, " ".join(shared[0]))]


@pytest.mark.parametrize("vocab,options", [
    ([f"w{k}" for k in range(500)], {}), ([f"w{k}" for k in range(500)], {"hot_count": 3, "hot_share": 10**9}), (["a", "b"], {"map_bits": 16}), (["a", "b"], {"hot_count": 2, "hot_share": 10**9})])
def test_same_as_brute_force(spark, vocab, options):
    rows = made(random.Random(7), vocab)
    assert rows_of(substring_dedup.repeats_removed(documents(spark, rows, clash=True), **options)) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", 50)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 400)
    monkeypatch.setattr(substring_dedup, "COMBINE_BYTES", 1500)
    rows = made(random.Random(9), [f"w{k}" for k in range(90)])
    assert rows_of(substring_dedup.repeats_removed(documents(spark, rows))) == brute(rows)


def test_empty_table_and_nothing_repeated(spark):
    assert substring_dedup.repeats_removed(documents(spark, [])).count() == 0
    got = as_dicts(substring_dedup.repeats_removed(documents(spark, [(1, "x y  z"), (2, None)])))
    assert got[1]["kept_sha256"] == sha("x y z") and got[2]["n_words"] == 0


def test_wavelet_ranks():
    seq = np.random.default_rng(0).integers(0, 23, 1000)
    w, at = Wavelet(seq, 22), np.arange(0, 1001, 7)
    for c in range(23):
        assert w.rank(np.full(len(at), c), at).tolist() == [int((seq[:i] == c).sum()) for i in at]


def test_index_counts_patterns():
    rng = np.random.default_rng(1)
    seq = np.append(rng.integers(1, 4, 500), 0)
    index = FMIndex(seq, 8)
    for _ in range(200):
        k = int(rng.integers(1, 8))
        pattern = rng.integers(1, 4, k)
        lo, hi = np.zeros(1, "int64"), np.full(1, len(seq), "int64")
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        assert hi[0] - lo[0] == sum((seq[i : i + k] == pattern).all() for i in range(len(seq) - k + 1))


def test_search_of_windows():
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 3, n) for n in (3, 9, 40, 5, 200)]
    seq = np.concatenate([np.append(t, 0) for t in texts])
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    windows = [tuple(seq[i : i + 5]) for s, e in zip(starts, ends, strict=True) for i in range(s, e - 4)]
    count = Counter(windows)
    want = [i for s, e in zip(starts, ends, strict=True) for i in range(s, e - 4) if count[tuple(seq[i : i + 5])] > 1]
    assert np.flatnonzero(repeated_windows(seq, starts, ends, 5, 8)).tolist() == want


def test_texts_are_taken_a_slice_at_a_time():
    batches = [pa.RecordBatch.from_arrays([pa.array([f"t{i}" for i in range(n)])], ["body"]) for n in (0, 1, 600)]
    got = list(common.slices(batches, 256))
    assert [b.num_rows for b in got] == [1, 256, 256, 88]
    assert [t for b in got for t in common.texts(b.column(0))] == [b"t0", *(b"t%d" % i for i in range(600))]


def test_more_rows_than_a_slice(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} end{i}" if i % 3 == 0 else f"own{i} alone") for i in range(3 * common.SLICE_ROWS)]
    got = as_dicts(substring_dedup.repeats_removed(documents(spark, rows, partitions=1)))
    assert len(got) == len(rows)
    assert all((got[i]["n_words"], got[i]["n_removed"]) == ((62, 60) if i % 3 == 0 else (2, 0)) for i in got)
