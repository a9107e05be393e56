"""Toxicity with a bidirectional gated recurrent network in numpy.

Every word enters as its own vector and the mean vector of its hashed character
n-grams. A forward and a backward gated recurrent layer read the text, in
segments that start CONTEXT words early and end CONTEXT words late. Attention
pools the states of every window of WINDOW words, one at each word, into a
score: with running sums of the attention weights and the weighted states, all
overlapping windows cost as much as reading the text once. A text's score is a
logistic fit on its highest window and on the mean of the highest windows of its
TOP highest bins (BIN neighbouring windows), which shows whether it happens more
than once.

Only documents are labelled, so training is multiple-instance learning. At first
the windows with the words and n-grams that set toxic documents apart count as
toxic, then those that the network itself finds so. It is fitted on the driver
on a bounded sample of labelled rows of every length: TRAIN_ROWS of each class;
a text over PASSAGES x PASSAGE words gives as many passages, evenly spread. For
the logistic fit the sample is dealt into FOLDS; the tasks score every sampled
text, whole, by a network that has not learnt from it. Both classes weigh as
much as they have labels. Scoring runs in the tasks over all windows of all texts.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_WORDS, fold, labelled, per_text, stored, table, texts

WINDOW, CONTEXT, SEGMENT, BIN = 32, 16, 96, 16
HIDDEN, WORD_DIMS, CHAR_DIMS, VOCABULARY = 8, 12, 12, 20_000
GRAMS, BUCKETS = (3, 5), 1 << 14
TRAIN_ROWS, PASSAGE, PASSAGES, FOLDS = 1000, 512, 16, 3
#: In each epoch STEPS batches are learnt from.
EPOCHS, BATCH, RATE, STEPS = 3, 256, 0.01, 50
TOP = 6
#: Standard deviations from which a word or n-gram counts as a sign at first.
SURE = 5.0
#: Raw score that a tenth of the toxic documents learnt from exceed.
LEVEL = 8.0
#: Words whose inputs a worker keeps; words scored at once; segments read at once.
CACHED_WORDS, BLOCK_WORDS, CHUNK = 100_000, 1 << 16, 512
#: Windows of a text that are scored at once (a multiple of SEGMENT).
PIECE = 96 * 128
PART_BYTES = 1 << 16
THRESHOLD = 0.7
#: Raw score of a text without words.
NOTHING = -12.0


def grams_of(word: bytes) -> list[int]:
    w = b"<" + word + b">"
    return [zlib.crc32(w[i : i + n]) % BUCKETS for n in GRAMS for i in range(max(n == GRAMS[0], len(w) - n + 1))]


def window_starts(n: int) -> range:
    """First words of all windows of a text; a short one is a window itself."""
    return range(max(1, n - WINDOW + 1)) if n else range(0)


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def initial(vocabulary: int, seed: int) -> dict[str, np.ndarray]:
    rng, h, d = np.random.default_rng(seed), HIDDEN, WORD_DIMS + CHAR_DIMS
    small = lambda *shape, s=0.1: (rng.standard_normal(shape) * s).astype("float32")
    p = {"word": small(vocabulary + 1, WORD_DIMS), "char": small(BUCKETS, CHAR_DIMS), "pool": small(2 * h), "out": small(2 * h, s=0.5), "bias": np.zeros(1, "float32")}
    for way in "fb":
        p |= {f"{way}_in": small(d, 3 * h, s=0.3), f"{way}_bias": np.zeros(3 * h, "float32"), f"{way}_state": small(h, 3 * h, s=0.3)}
    p["word"][0] = 0  # a word that isn't in the vocabulary has its characters only
    return p


def recur(gates: np.ndarray, state: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, windows, HIDDEN) of one direction; ``gates`` has the
    projected inputs as (steps, windows, 3 * HIDDEN)."""
    h, width = np.zeros((gates.shape[1], HIDDEN), "float32"), HIDDEN
    out = np.empty((*gates.shape[:2], width), "float32")
    for t in range(len(gates)):
        fed = h @ state
        zr = sigmoid(gates[t, :, : 2 * width] + fed[:, : 2 * width])
        z, r = zr[:, :width], zr[:, width:]
        n = np.tanh(gates[t, :, 2 * width :] + r * fed[:, 2 * width :])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((h, fed[:, 2 * width :], z, r, n))
        m = mask[t][:, None]
        h = new * m + h * (1 - m)
        out[t] = h
    return out


def recur_back(d_out: np.ndarray, state: np.ndarray, mask: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of the state matrix."""
    width = HIDDEN
    d_gates, d_state = np.empty((*d_out.shape[:2], 3 * width), "float32"), np.zeros_like(state)
    dh = np.zeros_like(d_out[0])
    for t in range(len(kept) - 1, -1, -1):
        h, fed_n, z, r, n = kept[t]
        dh = dh + d_out[t]
        m = mask[t][:, None]
        through, dh = dh * m, dh * (1 - m)
        dn = through * (1 - z) * (1 - n * n)
        dz = through * (h - n) * z * (1 - z)
        dr = dn * fed_n * r * (1 - r)
        d_gates[t] = np.concatenate((dz, dr, dn), 1)
        fed = np.concatenate((dz, dr, dn * r), 1)
        d_state += h.T @ fed
        dh = dh + through * z + fed @ state.T
    return d_gates, d_state


def pooled(states: np.ndarray, mask: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = states @ p["pool"]
    a = np.where(mask > 0, a, -1e9)
    a = np.exp(a - a.max(0))
    a /= a.sum(0)
    context = (a[:, :, None] * states).sum(0)
    return context @ p["out"] + p["bias"][0], a, context


def forward(x: np.ndarray, mask: np.ndarray, p: dict, keep: dict | None = None, context: int = 0) -> np.ndarray:
    """Raw scores of windows given their inputs as (steps, windows, dims), the
    first and last ``context`` of which stand around the window."""
    kf, kb = ([], []) if keep is not None else (None, None)
    end = len(x) - context
    f = recur(x[:end] @ p["f_in"] + p["f_bias"], p["f_state"], mask[:end], kf)[context:]
    b = recur((x[context:] @ p["b_in"] + p["b_bias"])[::-1], p["b_state"], mask[context:][::-1], kb)[context:][::-1]
    states = np.concatenate((f, b), 2)
    score, a, pooled_ = pooled(states, mask[context:end], p)
    if keep is not None:
        keep |= {"f": kf, "b": kb, "states": states, "a": a, "context": pooled_}
    return score


def gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, p: dict, context: int = 0) -> tuple[dict, np.ndarray]:
    """Of the mean cross-entropy: by parameter, and by input."""
    keep: dict = {}
    d = ((sigmoid(forward(x, mask, p, keep, context)) - y) / len(y)).astype("float32")
    g = {"bias": d.sum(keepdims=True), "out": keep["context"].T @ d}
    d_context = d[:, None] * p["out"]
    d_a = (keep["states"] * d_context).sum(2)
    d_logit = keep["a"] * (d_a - (keep["a"] * d_a).sum(0))
    g["pool"] = np.tensordot(d_logit, keep["states"], 2)
    d_states = keep["a"][:, :, None] * d_context + d_logit[:, :, None] * p["pool"]
    dx, end = np.zeros_like(x), len(x) - context
    for way, part, read in (("f", slice(0, HIDDEN), slice(0, end)), ("b", slice(HIDDEN, None), slice(context, None))):
        turn = (lambda v: v) if way == "f" else (lambda v: v[::-1])
        d_out = np.concatenate([np.zeros((context, *d_states.shape[1:2], HIDDEN), d_states.dtype), turn(d_states[:, :, part])])
        d_gates, g[f"{way}_state"] = recur_back(d_out, p[f"{way}_state"], turn(mask[read]), keep[way])
        d_gates = turn(d_gates)
        g[f"{way}_in"], g[f"{way}_bias"] = np.tensordot(x[read], d_gates, ((0, 1), (0, 1))), d_gates.sum((0, 1))
        dx[read] += d_gates @ p[f"{way}_in"].T
    return g, dx


def summed(size: int, index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows added up by their index, as (size, dims)."""
    return np.stack([np.bincount(index, row, size) for row in rows.T], 1).astype("float32")


class Adam:
    def __init__(self, p: dict):
        self.m, self.v, self.t = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0

    def step(self, p: dict, g: dict, rate: float) -> None:
        self.t += 1
        size = rate * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            p[k] -= size * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def lookup(sample: list[list[bytes]], vocab: dict[bytes, int]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
    """The sample's distinct words: places, vocabulary ids, and their n-grams
    as one list with the start of each word."""
    place = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for d in sample for w in d))}
    grams = [[0], *(grams_of(w) for w in place)]
    starts = np.cumsum([0] + [len(g) for g in grams[:-1]])
    return place, np.array([0, *(vocab.get(w, 0) for w in place)]), np.concatenate(grams).astype("int64"), starts


def windows_of(docs: list[list[bytes]], place: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Windows at every BIN words with their context, as word places, 0 beyond
    the text, and whose they are."""
    rows, of, width = [], [], WINDOW + 2 * CONTEXT
    for k, d in enumerate(docs):
        starts = np.arange(0, max(1, len(d) - WINDOW + BIN), BIN) if d else np.zeros(0, "int64")
        ids = np.zeros(len(d) + width + BIN, "int32")
        ids[CONTEXT : CONTEXT + len(d)] = np.fromiter((place[w] for w in d), "int32", len(d))
        rows.append(ids[starts[:, None] + np.arange(width)])
        of.append(np.full(len(starts), k))
    return np.concatenate([np.zeros((0, width), "int32"), *rows]), np.concatenate([np.zeros(0, "int64"), *of])


def inside(rows: np.ndarray) -> np.ndarray:
    """Which words of windows with context belong to the window."""
    out = rows > 0
    out[:, :CONTEXT] = out[:, CONTEXT + WINDOW :] = False
    return out


def evidence(doc: np.ndarray, word: np.ndarray, grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray, size: int, y: np.ndarray) -> np.ndarray:
    """By feature, how many standard deviations more toxic documents than clean
    ones hold it. (doc, word) are the distinct words of each document, sorted;
    word w has the features ``grams[starts[w] : starts[w] + sizes[w]]``."""
    count = np.zeros((2, size))
    edges = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    for some in np.array_split(edges, max(1, len(doc) // 20_000)):  # some documents at a time
        if not len(some):
            continue
        end = edges[np.searchsorted(edges, some[-1]) + 1] if some[-1] != edges[-1] else len(doc)
        d, w = doc[some[0] : end], word[some[0] : end]
        reps = sizes[w]
        feature = grams[np.repeat(starts[w] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())]
        held = np.unique(np.repeat(d, reps) * size + feature)
        toxic = y[held // size] > 0
        for k in (0, 1):
            count[k] += np.bincount(held[toxic == k] % size, minlength=size)
    c, t = count
    n_t, n_c = max(1.0, float((y > 0).sum())), max(1.0, float((y <= 0).sum()))
    share = (t + c + 1) / (n_t + n_c + 2)
    return (t / n_t - c / n_c) / np.sqrt(share * (1 - share) * (1 / n_t + 1 / n_c))


def summary(raw: np.ndarray, of: np.ndarray, docs: int) -> np.ndarray:
    """Per document, from its bins: the highest and the mean of the TOP highest
    (missing ones count as NOTHING), and the logarithm of their number."""
    order = np.lexsort((-raw, of))
    raw, of = raw[order], of[order]
    n = np.bincount(of, minlength=docs)
    rank = np.arange(len(of)) - (np.cumsum(n) - n)[of]
    top = rank < TOP
    out = np.full((docs, 3), NOTHING)
    out[of[rank == 0], 0] = raw[rank == 0]
    out[:, 1] = (np.bincount(of[top], np.maximum(raw[top], NOTHING), minlength=docs) + NOTHING * (TOP - np.minimum(n, TOP))) / TOP
    out[:, 2] = np.log1p(n)
    return out


def calibrate(x: np.ndarray, y: np.ndarray, clean: float = 1.0, toxic: float = 1.0) -> list[float]:
    """Weights of a logistic fit on the first two features, the shift last
    (Newton steps, small ridge); ``clean`` and ``toxic`` are what a row of each
    class weighs. The number of windows gets no weight, so a long clean text
    around a toxic passage does not hide it."""
    weight = np.where(y > 0, toxic, clean)
    a = np.hstack([x[:, :2], np.ones((len(x), 1))])
    w, ridge = np.zeros(3), np.full(3, 0.05)
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = a.T @ (a * (weight * q * (1 - q))[:, None]) + np.diag(ridge)
        w = w - np.clip(np.linalg.solve(hess, a.T @ (weight * (q - y)) + ridge * w), -2, 2)
    return [w[0], w[1], 0.0, w[2]]


def network(sample: list[list[bytes]], of_doc: np.ndarray, y: np.ndarray, seed: int) -> dict | None:
    """The network fitted on passages (as words), their documents and the
    documents' labels; None where only one class has windows."""
    count: dict[bytes, int] = {}
    for d in sample:
        for w in set(d):
            count[w] = count.get(w, 0) + 1
    vocab = {w: i + 1 for i, w in enumerate(sorted((w for w, n in count.items() if n > 1), key=lambda w: (-count[w], w))[:VOCABULARY])}
    place, ids, grams, starts = lookup(sample, vocab)
    win, of = windows_of(sample, place)
    of = of_doc[of]
    label = y[of].astype("float32")
    toxic, clean = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(toxic) or not len(clean):
        return None
    rng, p = np.random.default_rng(seed), initial(len(vocab), seed)
    adam = Adam(p)
    sizes = np.diff(np.append(starts, len(grams)))

    def inputs(rows):
        used, back = np.unique(rows, return_inverse=True)
        first = np.cumsum(sizes[used]) - sizes[used]
        flat = grams[np.repeat(starts[used] - first, sizes[used]) + np.arange(sizes[used].sum())]
        vectors = np.hstack([p["word"][ids[used]], np.add.reduceat(p["char"][flat], first) / sizes[used][:, None]]).astype("float32")
        return vectors[back.reshape(rows.shape)].transpose(1, 0, 2), used, back.reshape(rows.shape), flat

    def learn(rows, labels, rate):
        x, used, back, flat = inputs(rows)
        g, dx = gradients(x, (rows > 0).T.astype("float32"), labels, p, CONTEXT)
        d = summed(len(used), back.ravel(), dx.transpose(1, 0, 2).reshape(-1, x.shape[2]))
        d[used == 0] = 0
        g["word"] = summed(len(p["word"]), ids[used], d[:, :WORD_DIMS])
        g["word"][0] = 0
        g["char"] = summed(len(p["char"]), flat, np.repeat(d[:, WORD_DIMS:] / sizes[used][:, None].astype("float32"), sizes[used], 0))
        adam.step(p, g, rate)

    def scores(rows):
        return np.concatenate([forward(inputs(r)[0], (r > 0).T.astype("float32"), p, None, CONTEXT) for r in np.split(rows, range(CHUNK, len(rows), CHUNK))])

    # what sets toxic documents apart: their words and n-grams
    pairs = np.unique(np.concatenate([np.unique(of[i : i + 4096, None] * len(ids) + np.where(inside(win[i : i + 4096]), win[i : i + 4096], 0)) for i in range(0, len(win), 4096)]))
    pairs = pairs[pairs % len(ids) > 0]
    doc, seen = pairs // len(ids), pairs % len(ids)
    by_word = evidence(doc, seen, np.arange(len(ids)), np.arange(len(ids)), np.ones(len(ids), "int64"), len(ids), y)
    by_gram = evidence(doc, seen, grams, starts, sizes, BUCKETS, y)
    del pairs, doc, seen
    sign = np.maximum(by_word, np.maximum.reduceat(by_gram[grams], starts)) - SURE
    sign[0] = -9.0
    raw = np.concatenate([np.where(inside(win[i : i + 4096]), sign[win[i : i + 4096]], -9.0).max(1) for i in range(0, len(win), 4096)])
    # the vectors start with that as their first entry
    p["char"][:, 0] = np.tanh(by_gram / (2 * SURE))
    np.maximum.at(p["word"][:, 0], ids[1:], np.tanh(by_word[1:] / (2 * SURE)).astype("float32"))
    p["word"][0] = 0
    for epoch in range(EPOCHS):
        if epoch:
            raw = scores(win)
        best = np.full(len(y), -np.inf)
        np.maximum.at(best, of, raw)
        positive = toxic[(raw[toxic] >= best[of[toxic]] - 0.5) | (raw[toxic] > 1)]
        hard = clean[np.argsort(-raw[clean], kind="stable")[: max(1, len(positive))]]
        negative = np.concatenate([rng.choice(clean, min(len(clean), max(BATCH, 2 * len(positive))), replace=False), hard])
        rows = np.concatenate([positive, negative])
        target = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))]).astype("float32")
        passes = math.ceil(STEPS * BATCH / len(rows))  # a small sample is read more than once
        order = np.concatenate([rng.permutation(len(rows)) for _ in range(passes)])[: STEPS * BATCH]
        for i in range(0, len(order), BATCH):
            k = order[i : i + BATCH]
            learn(win[rows[k]], target[k], RATE / (1 + epoch))
    # networks of different folds meet on one scale: what toxic documents reach
    best = np.full(len(y), -np.inf)
    np.maximum.at(best, of[toxic], scores(win[toxic]))
    level = LEVEL / max(float(np.quantile(best[best > -np.inf], 0.9)), 1.0)
    p["out"] *= level
    p["bias"] *= level
    return {"words": list(vocab), "p": p}


def dealt(n: int) -> np.ndarray:
    """The fold of each sampled document."""
    return np.random.default_rng(17).permutation(n) % FOLDS


def networks(sample: list[list[bytes]], y: np.ndarray, of_doc: np.ndarray | None = None, seed: int = 3) -> tuple[dict, list[dict | None]]:
    """The network of all documents, and for each fold one of the other folds'.
    One class only, or no words: a constant score, the share of ones."""
    of_doc = np.arange(len(sample)) if of_doc is None else of_doc
    whole = network(sample, of_doc, y, seed) if any(sample) and len(set(y.tolist())) == 2 else None
    if whole is None:
        return {"constant": (float(y.sum()) + 0.5) / (len(y) + 1)}, []
    folds = dealt(len(y))
    others = []
    for k in range(FOLDS):
        keep = np.flatnonzero(folds[of_doc] != k)
        others.append(network([sample[i] for i in keep], of_doc[keep], y, seed))
    return whole, others


def fit(sample: list[list[bytes]], y: np.ndarray, seed: int = 3) -> dict:
    """The network for documents (as words) and their labels, calibrated."""
    whole, others = networks(sample, y, None, seed)
    if "constant" in whole:
        return whole
    x, folds = np.zeros((len(y), 3)), dealt(len(y))
    for k, net in enumerate(others):
        mine = np.flatnonzero(folds == k)
        x[mine] = Scorer(net or whole).raw([sample[i] for i in mine])
    return whole | {"weights": calibrate(x, y)}


def parts(text: bytes | None, size: int):
    """Words of a text as lists of about ``size`` bytes of it."""
    clean = text.translate(LOWER_WORDS) if text else b""
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + size)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def pieces(doc):
    """(words, first word that counts, number of windows) of parts of a text,
    each with the words around it that its windows need. ``doc`` yields lists."""
    held, start, more = [], 0, SEGMENT + CONTEXT  # the last windows end in the next segment
    for part in doc:
        held += part
        while len(held) - start > PIECE + more:
            yield held[max(0, start - CONTEXT) : start + PIECE + more], min(start, CONTEXT), PIECE
            held, start = held[start + PIECE - CONTEXT :], CONTEXT
    left = len(held) - start
    if left >= WINDOW or (held and not start):
        yield held[max(0, start - CONTEXT) :], min(start, CONTEXT), max(1, left - WINDOW + 1)


class Scorer:
    """Scores texts; the projected inputs of frequent words are kept."""

    def __init__(self, model: dict):
        self.model = model
        if "constant" in model:
            return
        p = self.p = model["p"]
        self.vocab = {w: i + 1 for i, w in enumerate(model["words"])}
        self.project = np.hstack([p["f_in"], p["b_in"]])
        self.shift = np.hstack([p["f_bias"], p["b_bias"]])
        self.place: dict[bytes, int] = {}
        self.gates = np.zeros((0, 6 * HIDDEN), "float32")

    def computed(self, new: list[bytes]) -> np.ndarray:
        grams = [grams_of(w) for w in new]
        sizes = np.array([len(g) for g in grams])
        chars = np.add.reduceat(self.p["char"][np.concatenate(grams)], np.cumsum(sizes) - sizes) / sizes[:, None]
        x = np.hstack([self.p["word"][[self.vocab.get(w, 0) for w in new]], chars]).astype("float32")
        return x @ self.project + self.shift

    def inputs(self, flat: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word in a table of gates, 0 being no word. The table is
        what the worker keeps and, behind that, words it has no room for."""
        new = [w for w in dict.fromkeys(flat) if w not in self.place]
        table_, place = self.gates, self.place
        if new:
            room = max(0, CACHED_WORDS - len(place))
            at = dict(zip(new, range(1 + len(place), 1 + len(place) + len(new)), strict=True))
            gates = np.concatenate([table_ if len(table_) else self.shift[None], *[self.computed(new[i : i + 4096]) for i in range(0, len(new), 4096)]]).astype("float32")
            ids = np.fromiter((at.get(w) or place[w] for w in flat), "int64", len(flat))
            self.place.update((w, at[w]) for w in new[:room])
            self.gates = gates[: 1 + len(self.place)] if room else table_
            return ids, gates
        return np.fromiter(map(place.__getitem__, flat), "int64", len(flat)), table_

    def block(self, block: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Highest window of each bin, and whose it is, of pieces of texts."""
        ids, gates = self.inputs([w for _, (held, _, _) in block for w in held])
        width, pad = SEGMENT + 2 * CONTEXT, CONTEXT + SEGMENT
        starts, at, layout, size = [], 0, [], 0
        lengths = [len(held) for _, (held, _, _) in block]
        flat = np.zeros(sum(lengths) + pad * (len(block) + 1) + width, "int64")
        for (_, (held, first, n)), m in zip(block, lengths, strict=True):
            base = size + pad
            flat[base : base + m] = ids[at : at + m]
            own = np.arange(base + first, base + min(m, first + n + WINDOW - 1), SEGMENT)
            starts.append(own), layout.append((base + first, min(m - first, n + WINDOW - 1), n))
            at, size = at + m, size + pad + m
        starts = np.concatenate(starts)
        weight, value = np.zeros(len(flat)), np.zeros(len(flat))
        for i in range(0, len(starts), CHUNK):
            some = starts[i : i + CHUNK]
            where = (some[:, None] - CONTEXT + np.arange(width)).T
            rows = flat[where]
            mask = (rows > 0).astype("float32")
            g = gates[rows]
            f = recur(g[: CONTEXT + SEGMENT, :, : 3 * HIDDEN], self.p["f_state"], mask[: CONTEXT + SEGMENT])[CONTEXT:]
            b = recur(g[: CONTEXT - 1 : -1, :, 3 * HIDDEN :], self.p["b_state"], mask[: CONTEXT - 1 : -1])[::-1][:SEGMENT]
            states, here = np.concatenate((f, b), 2), where[CONTEXT : CONTEXT + SEGMENT]
            e = np.exp(np.clip(states @ self.p["pool"], -30, 30)).astype("float64") * mask[CONTEXT : CONTEXT + SEGMENT]
            weight[here], value[here] = e, e * (states @ self.p["out"])
        highest, of = [], []
        for (k, _), (base, m, n) in zip(block, layout, strict=True):
            w, v = (np.concatenate(([0.0], np.cumsum(x[base : base + m]))) for x in (weight, value))
            last = np.minimum(np.arange(n) + WINDOW, m)
            raw = (v[last] - v[:n]) / (w[last] - w[:n]) + float(self.p["bias"][0])
            highest.append(np.maximum.reduceat(raw, np.arange(0, n, BIN))), of.append(np.full(len(highest[-1]), k))
        return np.concatenate(highest), np.concatenate(of)

    def raw(self, docs: list) -> np.ndarray:
        """The summary of every document: lists of words, or iterators over such
        lists. At most about BLOCK_WORDS words are held at once."""
        seen, block, n = [], [], 0
        for k, d in enumerate(docs):
            for piece in pieces([d] if isinstance(d, list) else d):
                block.append((k, piece))
                n += len(piece[0])
                if n >= BLOCK_WORDS:
                    seen.append(self.block(block))
                    block, n = [], 0
        if block:
            seen.append(self.block(block))
        raw, of = (np.concatenate(x) for x in zip(*seen, strict=True)) if seen else (np.zeros(0), np.zeros(0, "int64"))
        return summary(raw, of, len(docs))

    def score(self, docs: list) -> np.ndarray:
        if "constant" in self.model:
            return np.full(len(docs), self.model["constant"])
        *weights, shift = self.model["weights"]
        z = self.raw(docs) @ weights + shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def passages(text: bytes | None) -> list[list[bytes]]:
    """A text as passages of PASSAGE words: all of them, or PASSAGES evenly
    spread ones. Words are counted first, so a long text is never held as words."""
    n = sum(len(part) for part in parts(text, 1 << 20))
    total = max(1, -(-n // PASSAGE))
    keep = set(range(total)) if total <= PASSAGES else {k * total // PASSAGES for k in range(PASSAGES)}
    out: dict[int, list[bytes]] = {}
    at = 0
    for part in parts(text, 1 << 20):
        for k in range(at // PASSAGE, (at + len(part) - 1) // PASSAGE + 1) if part else ():
            if k in keep:
                out.setdefault(k, []).extend(part[max(0, k * PASSAGE - at) : max(0, (k + 1) * PASSAGE - at)])
        at += len(part)
    return [out[k] for k in sorted(out)]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", allowed=None, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """A network fitted on at most ``rows`` labelled documents of each class, of
    every length, and calibrated on their whole texts by networks that have not
    learnt from them. A class weighs as much as it has labels."""
    allowed = F.lit(True) if allowed is None else allowed
    chosen = [labelled(docs, labels, label, allowed & (F.col(label) == v), rows, id_col, text_col) for v in (1, 0)]
    known = stored(chosen[0].unionByName(chosen[1]), "toxicity-sample")

    def cut(batches):
        for b in batches:
            some = [[b" ".join(p).decode() for p in passages(t)] for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(some, pa.list_(pa.string()))], ["id", "label", "some"])

    id_type = known.schema["id"].dataType.simpleString()
    sample = sorted(((r.label, r.id, r.some) for r in known.select("id", "label", "body").mapInArrow(cut, f"id {id_type}, label int, some array<string>").collect()), key=lambda r: r[:2])
    y = np.array([x for x, _, _ in sample], "float64")
    kept: dict[bytes, bytes] = {}  # one object for each word
    flat = [(k, [kept.setdefault(w, w) for w in p.encode().split()]) for k, (_, _, some) in enumerate(sample) for p in some]
    whole, others = networks([p for _, p in flat], y, np.array([k for k, _ in flat], "int64"))
    if "constant" in whole:
        return whole
    folds = {r[1]: int(k) for r, k in zip(sample, dealt(len(y)), strict=True)}
    seen = np.array(summaries(known, [net or whole for net in others], folds).collect())
    n = {r["v"]: r["n"] for r in labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & allowed).groupBy((F.col(label) == 1).cast("int").alias("v")).agg(F.count_distinct(id_col).alias("n")).collect()}
    sampled = np.bincount(seen[:, 0].astype(int), minlength=2)
    weigh = [n.get(v, 0) / max(1, int(sampled[v])) for v in (0, 1)]
    return whole | {"weights": calibrate(seen[:, 1:], seen[:, 0], *weigh)}


def summaries(known: DataFrame, nets: list[dict], folds: dict) -> DataFrame:
    """Label and summary of the sampled documents, over all windows of their
    whole texts, by the network of their fold."""
    shared = known.sparkSession.sparkContext.broadcast((nets, folds))

    def run(batches):
        nets, folds = shared.value
        scorers = [Scorer(net) for net in nets]
        for b in batches:
            for name, label, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)), strict=True):
                x = scorers[folds[name]].raw([parts(raw, PART_BYTES)])[0]
                yield pa.RecordBatch.from_arrays([pa.array([float(label)]), *[pa.array([v]) for v in x.tolist()]], ["label", "best", "top", "windows"])

    return known.select("id", "label", "body").mapInArrow(run, "label double, best double, top double, windows double")


def scored(docs: DataFrame, model: dict, carry: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (the carried columns) and the score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})

    def make():
        kept = shared.value  # a worker keeps it, and the words with it
        if "scorer" not in kept:
            kept["scorer"] = Scorer(kept["model"])

        def read(text):  # one text at a time becomes words
            yield from parts(text.as_py(), PART_BYTES)

        return lambda column: [pa.array(kept["scorer"].score([read(t) for t in column.cast(pa.binary())]), pa.float64())]

    return per_text(docs, text_col, carry, "score double", make)


def toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score. NULL and empty texts have no window and get the
    lowest score. Texts of any length are scored whole, in pieces of bounded
    size; equal texts get equal scores. Repeated rows each give a row, NULL ids stay, other columns
    are not read, and an empty table gives an empty result."""
    return scored(docs, model, [id_col], text_col).select(F.col(f"row.`{id_col}`").alias("doc_id"), "score")


def reject(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``."""
    kept = scored(docs, model, docs.columns, text_col).where(F.col("score") < threshold)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, allowed=fold(F.col("doc_id"), 3) != 1)
    return toxicity(docs, model).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
