import zlib

import numpy as np
import pytest
from farelens.llm import toxicity
from farelens.llm.common import words

from .helpers import as_dicts, documents


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype("float64") for k, v in toxicity.initial(5, 1).items()}
    x, mask, y = rng.standard_normal((6, 4, 24)), np.ones((6, 4)), np.array([1, 0, 1, 0.0])
    mask[4:, 1] = 0
    g, dx = toxicity.gradients(x, mask, y, p)

    def loss():
        z = toxicity.forward(x, mask, p)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    for name in ("f_in", "f_state", "b_state", "b_bias", "pool", "out"):
        at = tuple(int(rng.integers(0, s)) for s in p[name].shape)
        old, slope = p[name][at], []
        for e in (1e-2, -1e-2):
            p[name][at] = old + e
            slope.append(loss())
        p[name][at] = old
        assert (slope[0] - slope[1]) / 2e-2 == pytest.approx(float(g[name][at]), abs=2e-4)
    old, slope = x[2, 1, 3], []
    for e in (1e-2, -1e-2):
        x[2, 1, 3] = old + e
        slope.append(loss())
    assert (slope[0] - slope[1]) / 2e-2 == pytest.approx(float(dx[2, 1, 3]), abs=2e-4)


def test_every_word_is_in_a_window():
    for n in (0, 1, 15, 16, 17, 32, 33, 48, 49, 500):
        covered = {i for s in toxicity.window_starts(n) for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    clean = [f"w{k}" for k in range(300)]
    docs = []
    for k in range(240):
        d = rng.choice(clean, rng.integers(30, 150)).tolist()
        if k % 2:
            for at in rng.integers(0, len(d), 4):
                d[at] = rng.choice(["vilestem", "vilestemo", "grubby"])
        docs.append(words(" ".join(d).encode()))
    return toxicity.fit(docs, np.arange(240) % 2 * 1.0)


def test_unseen_texts_and_word_forms(model):
    rng, scorer = np.random.default_rng(2), toxicity.Scorer(model)
    clean = [words(" ".join(rng.choice([f"w{k}" for k in range(300)], 80)).encode()) for _ in range(40)]
    toxic = [[*d[:10], b"grubby", *d[10:30], b"vilestema", *d[30:50], b"vilestem", *d[50:]] for d in clean]
    assert (scorer.score(clean) < 0.7).mean() > 0.9 and (scorer.score(toxic) >= 0.7).mean() > 0.9


def test_score_does_not_depend_on_neighbours(model, monkeypatch):
    rng = np.random.default_rng(4)
    docs = [[f"w{x}".encode() for x in rng.integers(0, 400, n)] for n in (0, 5, 31, 64, 700, 3000)]
    together = toxicity.Scorer(model).score(docs)
    alone = [toxicity.Scorer(model).score([d])[0] for d in docs]
    assert np.allclose(together, alone, atol=1e-5)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 100)  # few words kept, long texts in pieces, small blocks
    monkeypatch.setattr(toxicity, "CHUNK", 5)
    monkeypatch.setattr(toxicity, "PIECE", 96)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 300)
    small = toxicity.Scorer(model)
    assert np.allclose(small.score(docs), alone, atol=1e-5)


def test_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "w1 w2"), (3, "w1 w2"), (None, "w1 " * 100_000), (5, "grubby vilestem w1 grubby " * 5)]
    docs = documents(spark, rows, clash=True)
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    score = as_dicts(toxicity.toxicity(docs, model))
    assert score[1]["score"] == score[2]["score"] <= score[3]["score"] < score[5]["score"]
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and 5 not in {r.doc_id for r in kept.collect()}
    assert toxicity.toxicity(documents(spark, []), model).count() == 0


def test_one_class_gives_a_constant(spark):
    assert toxicity.fit([[b"a"]], np.array([1.0]))["constant"] == 0.75
    got = toxicity.toxicity(documents(spark, [(1, "a")]), toxicity.fit([], np.array([]))).first()
    assert got.score == 0.5


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = d.select("doc_id", "text", "toxic").collect()
    learn = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    scorer = toxicity.Scorer(toxicity.fit([words(r.text.encode()) for r in learn], np.array([float(r.toxic) for r in learn])))
    score = scorer.score([words(r.text.encode()) for r in held])
    assert np.mean((score >= 0.5) == np.array([r.toxic == 1 for r in held])) > 0.85


def test_calibration_sees_texts_of_every_length(spark, monkeypatch):
    rng = np.random.default_rng(5)
    text = lambda k, n: " ".join([*(f"calm{j}" for j in rng.integers(0, 40, n)), *(["vile"] if k % 2 else []), *(f"calm{j}" for j in rng.integers(0, 40, n))])
    rows = [(k, text(k, 10 if k < 200 else 600)) for k in range(240)]
    seen = []
    monkeypatch.setattr(toxicity, "calibrate", lambda x, y, *w, f=toxicity.calibrate: seen.append((x, y)) or f(x, y, *w))
    labels = spark.createDataFrame([(k, k % 2) for k in range(240)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels)
    x, y = seen[-1]
    assert sorted(np.bincount(y[x[:, 2] > np.log1p(50)].astype(int))) == [20, 20]
    assert len(y) == 240  # every label counts, by a network that has not seen it
    score = {r.doc_id: r.score for r in toxicity.toxicity(documents(spark, rows), model).collect()}
    assert np.mean([(score[k] > 0.5) == (k % 2 == 1) for k in range(200, 240)]) > 0.9


def test_every_window_is_scored(model):
    """Against each window read with the words that its segments read."""
    rng = np.random.default_rng(7)
    doc = [f"w{x}".encode() for x in rng.integers(0, 300, 230)]
    doc[100] = doc[160] = b"vilestem"
    scorer, p, c = toxicity.Scorer(model), model["p"], toxicity.CONTEXT
    gates = np.array([scorer.computed([w])[0] for w in doc], "float32")
    states = np.zeros((len(doc), 2 * toxicity.HIDDEN), "float32")
    for s in range(0, len(doc), toxicity.SEGMENT):
        first, end = max(0, s - c), min(len(doc), s + toxicity.SEGMENT + c)
        own = slice(s, min(len(doc), s + toxicity.SEGMENT))
        one = lambda g, state: toxicity.recur(g[:, None], state, np.ones((len(g), 1), "float32"))[:, 0]
        states[own, : toxicity.HIDDEN] = one(gates[first : own.stop, : 3 * toxicity.HIDDEN], p["f_state"])[s - first :]
        states[own, toxicity.HIDDEN :] = one(gates[s:end][::-1, 3 * toxicity.HIDDEN :], p["b_state"])[::-1][: own.stop - s]
    a = np.exp(states @ p["pool"])
    raw = [float((a[s : s + 32] * (states[s : s + 32] @ p["out"])).sum() / a[s : s + 32].sum() + p["bias"][0]) for s in toxicity.window_starts(len(doc))]
    bins = [max(raw[i : i + toxicity.BIN]) for i in range(0, len(raw), toxicity.BIN)]
    want = toxicity.summary(np.array(bins), np.zeros(len(bins), "int64"), 1)
    assert np.allclose(scorer.raw([doc]), want, atol=1e-4)


def test_passage_in_a_long_clean_text(model):
    rng, scorer = np.random.default_rng(2), toxicity.Scorer(model)
    clean = rng.choice([f"w{k}".encode() for k in range(300)], 5080).tolist()
    toxic = [b"grubby", *clean[:10], b"vilestema", b"vilestem", *clean[10:20]]
    short, long = scorer.score([[*clean[:40], *toxic, *clean[40:80]], [*clean[:2500], *toxic, *clean[2500:]]])
    assert short >= 0.7 and long >= 0.7


def test_parts_and_passages():
    text = b"  ".join(f"Word{k}".encode() for k in range(20_000))
    whole = words(text)
    for size in (1, 50, 4096):
        assert [w for part in toxicity.parts(text, size) for w in part] == whole
    assert [w for p in toxicity.passages(text[:3000]) for w in p] == words(text[:3000])
    some = toxicity.passages(text)
    assert len(some) == toxicity.PASSAGES and all(p == whole[int(p[0][4:]) :][: len(p)] and len(p) == toxicity.PASSAGE for p in some)
    assert toxicity.passages(None) == toxicity.passages(b"") == []
