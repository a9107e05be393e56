"""License scans as an exact set-similarity join of templates and text blocks.

A block is a line; a longer line is cut into overlapping blocks of two steps,
one step apart, so that every run of a step's words lies in one. As notices are
wrapped, the whole text is cut in the same way without regard to lines, and
blocks that hold a line break are looked at, too. Templates are joined in
classes by their length: the step of a class is at least its longest template,
BLOCK_STEP doubled as often as that takes, so a template of any length lies
whole in some block wherever it starts. A template is found where a block holds
at least THRESHOLD of its distinct words. Words are
ordered by their frequency in the whole corpus, rarest first. With overlap a = ceil(threshold * |T|):

* prefix: T's first |T| - a + 1 words and the block's first |B| - a + 1 share a
  word, so only blocks that hold one of T's rarest words are looked at;
* length: the block has at least a words that any template has;
* position: the words left behind a shared one must suffice to reach a;
* what remains is verified by the exact overlap.

Words that no template has can't add to an overlap, so blocks are compared on
template words alone. Beside the join, fixed phrases are found word by word.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_WORDS, per_text, table, texts, words

#: Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Templates: what licence notices say, without the licence texts themselves.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
]
THRESHOLD = 0.85
BLOCK_WORDS, BLOCK_STEP = 64, 32
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "found array<struct<label:string,first:int,after:int,containment:double>>")
KEEP_LINES = bytes(10 if b == 10 else c for b, c in enumerate(LOWER_WORDS))


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    return sorted({w.decode() for _, t in templates for w in words(t.encode())})


def frequencies(docs: DataFrame, text_col: str, vocab: list[str]) -> dict[str, int]:
    """How often each template word stands in the corpus: counted in each task,
    then added up; as many rows as there are template words."""
    known = {w.encode(): i for i, w in enumerate(vocab)}

    def run(batches):
        n = np.zeros(len(known) + 1, "int64")
        for b in batches:
            for t in texts(b.column(0)):
                n += np.bincount(np.fromiter(map(known.get, words(t), repeat(len(known))), "int64"), minlength=len(known) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(vocab, pa.string()), pa.array(n[:-1])], ["word", "n"])

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return {r.word: r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def compile_templates(templates: list[tuple[str, str]], counts: dict[str, int], threshold: float) -> dict:
    """Words numbered from 1 in global order, templates as ordered words, and
    the prefix index: word -> (template, place in it)."""
    order = sorted(vocabulary(templates), key=lambda w: (counts.get(w, 0), w))
    ids = {w.encode(): i + 1 for i, w in enumerate(order)}
    sets = [sorted({ids[w] for w in words(t.encode())}) for _, t in templates]
    least = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    index: dict[int, list] = {}
    for k, s in enumerate(sets):
        for i, w in enumerate(s[: len(s) - least[k] + 1]):
            index.setdefault(w, []).append((k, i))
    steps = [BLOCK_STEP << max(0, math.ceil(math.log2(max(1, len(words(x.encode()))) / BLOCK_STEP))) for _, x in templates]
    classes = [(step, {w: own for w, kis in index.items() if (own := [(k, i) for k, i in kis if steps[k] == step])}) for step in sorted(set(steps))]
    return {"ids": ids, "sets": sets, "least": least, "index": index, "classes": classes, "labels": [x for x, _ in templates]}


def join_block(block: list[int], t: dict, index: dict[int, list] | None = None) -> list[tuple[int, int]]:
    """(template, overlap) of all templates of a prefix index (by default of
    all) that reach the threshold in a block of distinct template words in
    global order."""
    shared: dict[int, int] = {}
    index = t["index"] if index is None else index
    for j, w in enumerate(block):
        for k, i in index.get(w, ()):
            least = t["least"][k]
            if len(block) < least or j > len(block) - least or shared.get(k, 0) < 0:
                continue
            n = shared.get(k, 0) + 1
            shared[k] = n if n + min(len(t["sets"][k]) - i - 1, len(block) - j - 1) >= least else -1
    there = set(block)
    hits = ((k, len(there.intersection(t["sets"][k]))) for k, n in shared.items() if n > 0)
    return [(k, n) for k, n in hits if n >= t["least"][k]]


def wrapped(marks: np.ndarray, ends: np.ndarray, n: int, step: int) -> list[int]:
    """Where the blocks of a text of ``n`` words (each of two steps) start that
    hold one of the ``marks`` and words of more than one line, given where the
    lines end."""
    last = max(0, -(-(n - 2 * step) // step))
    first = np.unique(np.clip((marks // step)[:, None] - np.arange(2), 0, last)) * step
    after = np.minimum(first + 2 * step, n)
    return first[np.searchsorted(ends, first, "right") != np.searchsorted(ends, after - 1, "right")].tolist()


def scan(text: bytes | None, t: dict, phrases: list[tuple[list[int], str]], prefix: list[np.ndarray]) -> tuple:
    """Base places and template blocks of a text; ``prefix`` tells for each class
    of templates which words are in its prefix index."""
    lines = [x.split() for x in text.translate(KEEP_LINES).split(b"\n")] if text else []
    flat = [w for x in lines for w in x]
    ids = np.fromiter(map(t["all"].get, flat, repeat(0)), "int64", len(flat))
    places, labels = [], set()
    for phrase, label in phrases:
        at = np.flatnonzero(ids[: len(ids) - len(phrase) + 1] == phrase[0]) if len(ids) >= len(phrase) else ids[:0]
        for i, w in enumerate(phrase[1:], 1):
            at = at[ids[at + i] == w]
        if len(at):
            places.append(at)
            labels.add(label)
    at = np.concatenate(places) if places else ids[:0]
    found = []

    def add(a, block, index):
        for x, n in join_block([int(w) for w in np.unique(block) if 0 < w <= t["most"]], t, index):
            found.append({"label": t["labels"][x], "first": a, "after": a + len(block), "containment": n / len(t["sets"][x])})

    ends = np.cumsum([len(x) for x in lines])
    for (step, index), starts in zip(t["classes"], prefix, strict=True):
        marks = np.flatnonzero(starts[ids])
        if not len(marks):
            continue
        for k in np.unique(np.searchsorted(ends, marks, "right")).tolist():
            after, first = int(ends[k]), int(ends[k]) - len(lines[k])
            for a in range(first, max(first + 1, after - step), step):
                add(a, ids[a : min(a + 2 * step, after)], index)
        for a in wrapped(marks, ends, len(ids), step):
            add(a, ids[a : a + 2 * step], index)
    return len(flat), len(at), int(at.min()) if len(at) else None, int(at.max()) if len(at) else None, sorted(labels), found


def licenses(docs: DataFrame, carry: list[str], text_col: str = "text", templates: list[tuple[str, str]] | None = None,
             phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` and the base places and template blocks of every text: n_words,
    n_base, first_word, last_word, base_labels, found (one entry for each block
    and template). NULL and empty texts have no words and nothing found."""
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    t = compile_templates(templates, frequencies(docs, text_col, vocabulary(templates)), threshold)
    every = dict(t["ids"])
    spelled = [([every.setdefault(w, len(every) + 1) for w in words(p.encode())], label) for p, label in phrases.items()]
    t |= {"all": every, "most": len(t["ids"])}
    shared = docs.sparkSession.sparkContext.broadcast((t, spelled))
    types = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()), ("after", pa.int32()), ("containment", pa.float64())]))]

    def make():
        t, spelled = shared.value
        prefix = [np.isin(np.arange(len(t["all"]) + 1), list(index)) for _, index in t["classes"]]

        def f(column):
            rows = [scan(x, t, spelled, prefix) for x in texts(column)]
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]

        return f

    return per_text(docs, text_col, carry, RESULT, make)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels and score: 1 with a base place, else the best containment found, or 0.

    Texts may have any length: blocks have a bounded number of words. Templates
    that tie are all listed. Repeated rows each give a row, NULL ids stay, other
    columns are not read, and an empty table gives an empty result.
    """
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["containment"])), F.lit(0.0))
    every = F.array_sort(F.array_union("base_labels", F.transform("found", lambda x: x["label"])))
    return licenses(docs, [id_col], text_col, **options).select(
        F.col(f"row.`{id_col}`").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))
