"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics are Spark columns. On a bounded sample of labelled rows, small trees
are grown on random halves of the rows and some of the statistics; every path
from a root is one conjunctive rule. A lasso-penalised logistic regression
weighs the rules, and those with a weight are compiled back into one Spark
column, so scoring is a projection over all documents.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, labelled, table

#: At most so many labelled rows are fitted, those with the lowest hash of their id.
SAMPLE_ROWS = 12_000
TREES, DEPTH, CUTS, LEAST = 40, 3, 24, 15
PENALTY = 0.002
THRESHOLD = 0.3


def _without(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("double") / len(what)


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text that isn't NULL; all are 0 or defined for an empty one."""
    n = F.length(text).cast("double")
    lines, spaces = _without(text, "\n") + 1, _without(text, " ")
    words = F.split(text, "[ \n]+")
    per = lambda x: x / F.greatest(n, F.lit(1.0))
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("double")
    return {
        "chars": n,
        "words": F.size(words).cast("double"),
        "chars_a_word": (n - spaces - lines + 1) / F.greatest(spaces + lines, F.lit(1.0)),
        "chars_a_line": n / lines,
        "words_a_line": (spaces + lines) / lines,
        "symbols": per(count("[#$%&*@^~|<>{}=_]")),
        "capitals": per(count("[A-Z]")),
        "digits": per(count("[0-9]")),
        "stops": per(count("[.!?]")),
        "shouts": per(_without(text, "!!")),
        "commas": per(_without(text, ",")),
        "distinct_words": F.size(F.array_distinct(words)) / F.size(words),
        "distinct_lines": F.size(F.array_distinct(F.split(text, "\n"))) / lines,
        "bytes_a_char": per(F.octet_length(text).cast("double")),
    }


def with_statistics(docs: DataFrame, keep: list[Column], text_col: str) -> DataFrame:
    rows = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    return rows.select(*[c for c in rows.columns if c != "body"], *[c.alias(f"s_{k}") for k, c in statistics(F.col("body")).items()])


def grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, depth: int, path: tuple) -> list[tuple]:
    """Paths of a Gini tree as tuples of (statistic, above, cut), inner nodes too."""
    best, total, ones = None, len(rows), y[rows].sum()
    if depth and total >= 2 * LEAST and 0 < ones < total:
        for j in columns:
            side = np.searchsorted(cuts[j], x[rows, j], "left")  # values up to a cut lie left of it
            n = np.cumsum(np.bincount(side, minlength=len(cuts[j]) + 1))[:-1]
            p = np.cumsum(np.bincount(side, y[rows], minlength=len(cuts[j]) + 1))[:-1]
            ok = (n >= LEAST) & (total - n >= LEAST)
            if ok.any():
                loss = np.where(ok, p * (1 - p / np.maximum(n, 1)) + (ones - p) * (1 - (ones - p) / np.maximum(total - n, 1)), np.inf)
                k = int(loss.argmin())
                if best is None or loss[k] < best[0]:
                    best = (loss[k], j, float(cuts[j][k]))
    if best is None or best[0] >= ones * (1 - ones / total) - 1e-9:
        return []
    _, j, cut = best
    out = []
    for above in (False, True):
        step = (*path, (int(j), above, cut))
        out.append(step)
        out += grow(x, y, cuts, rows[(x[rows, j] > cut) == above], columns, depth - 1, step)
    return out


def holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, j] > cut) == above for j, above, cut in rule])


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """L1-penalised logistic regression by accelerated proximal gradients; the
    intercept isn't penalised."""
    n = len(y)
    a = np.hstack([np.ones((n, 1)), x])
    size = 4 * n / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        z = v - size * (a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -30, 30))) - y) / n)
        new = np.sign(z) * np.maximum(np.abs(z) - size * penalty, 0)
        new[0] = z[0]
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> tuple[float, list[tuple[float, tuple]]]:
    """Intercept and weighted rules. One class only, or no rows: no rules, and
    the intercept gives the share of ones (one half without rows)."""
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        return math.log(p / (1 - p)), []
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, CUTS))) for j in range(x.shape[1])]
    rules: dict[tuple, None] = {}
    for _ in range(TREES):
        rows = rng.choice(len(y), max(2, len(y) // 2), replace=False)
        columns = rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False)
        rules |= dict.fromkeys(tuple(sorted(set(r))) for r in grow(x, y, cuts, rows, columns, DEPTH, ()))
    kept, seen, matrix = [], set(), []
    for rule in rules:  # rules that hold for the same rows, or the opposite ones, count once
        on = holds(rule, x)
        key = (on if on[0] else ~on).tobytes()
        if key not in seen and 0 < on.sum() < len(on):
            seen.add(key), kept.append(rule), matrix.append(on)
    if not kept:
        p = (y.sum() + 0.5) / (len(y) + 1)
        return math.log(p / (1 - p)), []
    b, w = lasso(np.array(matrix, float).T, y, PENALTY)
    return b, [(float(a), r) for a, r in zip(w, kept, strict=True) if abs(a) > 1e-6]


def compiled(model: tuple[float, list], names: list[str]) -> Column:
    """The score of a model as a Spark column over ``s_<statistic>`` columns."""
    score = F.lit(model[0])
    for weight, rule in model[1]:
        on = F.lit(True)
        for j, above, cut in rule:
            c = F.col(f"s_{names[j]}")
            on = on & ((c > cut) if above else (c <= cut))
        score = score + F.when(on, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-score))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None, rows: int = SAMPLE_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[float, list]:
    known = labelled(docs, labels, label, F.lit(True) if allowed is None else allowed, rows, id_col, text_col)
    sample = with_statistics(known, [F.col("id"), F.col("label")], "body").drop("id").toPandas().to_numpy(float)
    sample = sample[np.lexsort(sample.T)] if len(sample) else sample.reshape(0, 1)  # rows come in any order
    return fit(sample[:, 1:], sample[:, 0])


def score(docs: DataFrame, model: tuple[float, list], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score. NULL text counts as empty, which has a score like
    any other; texts of any length are read whole, by expressions; documents with
    equal statistics tie; repeated rows each give a row, NULL ids stay, other columns are
    not read, and an empty table gives an empty result."""
    names = list(statistics(F.lit("")))
    return with_statistics(docs, [F.col(id_col).alias("doc_id")], text_col).select("doc_id", compiled(model, names).alias("score"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, allowed=fold(F.col("doc_id"), 5) != 0)
    return score(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
