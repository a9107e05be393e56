"""Benchmark decontamination over suffix arrays of the training text.

Each task turns its documents, block by block, into one sequence of word ids and
sorts its suffixes (prefix doubling, as deep as the longest window). A
position whose next words are not all benchmark words can't start a match, so it
is left out of the array: nothing that could be found is lost. The benchmark's
suffixes are sorted, too, so that those with the same window stand together, and
each distinct window is binary-searched once: the range of suffixes that begin
with it gives all occurrences. The longest verbatim match at an occurrence is
with one of the two benchmark suffixes between which the text belongs, which
another binary search finds among those of the window. So work goes with the
occurrences, however many items share a window.

The benchmark is the query set. It is cut into blocks of bounded size. One block
is matched without a shuffle. Of several only one is sent to the tasks at a time:
the documents are written with a row number, each block's matches are written,
its broadcast is released, and in the end the matches of a row are put together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_text, stored, table, texts, words

WINDOW = 10
#: Words whose suffixes are sorted at once in a task.
BLOCK_WORDS = 1_000_000
#: Occurrences whose longest matches are looked for at once.
PART = 1 << 16
#: Benchmark text that is sent to the tasks at once.
BENCHMARK_BYTES = 16 << 20
RESULT = ("n_words long, spans array<struct<first:int,after:int>>, items array<string>, longest int, longest_item string, "
          "longest_item_at int, longest_at int")


def compile_items(items: list[tuple[str, bytes]], window: int) -> dict:
    """Word ids of all items, 0 behind each, and in sorted order the start, item
    and place in the item of every suffix of at least one window; ``first`` and
    ``width`` have for each distinct window its first suffix (one more entry:
    their number) and its words."""
    vocab: dict[bytes, int] = {}
    names, flat, of, at, width, start, n = [], [np.zeros(0, "int32")], [], [], [], [], 0
    for name, text in items:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
        if ids:
            w = min(window, len(ids))
            places = np.arange(len(ids) - w + 1)
            of.append(np.full(len(places), len(names))), at.append(places), start.append(n + places), width.append(np.full(len(places), w))
            flat.append(np.array([*ids, 0], "int32"))
            names.append(name)
            n += len(ids) + 1
    flat = np.concatenate(flat)
    of, at, start, width = (np.concatenate([np.zeros(0, "int64"), *x]) for x in (of, at, start, width))
    rank = np.empty(len(flat), "int64")
    rank[suffix_array(flat, max((len(x) for x in np.split(flat, np.flatnonzero(flat == 0))), default=1) + 1)] = np.arange(len(flat))
    order = np.argsort(rank[start], kind="stable")
    of, at, start, width = of[order], at[order], start[order], width[order]
    new = np.ones(len(start), bool)
    new[1:] = width[1:] != width[:-1]
    for c in range(1, len(start), 1 << 16):
        some = np.arange(c, min(len(start), c + (1 << 16)))
        own = np.arange(window) < width[some, None]
        word = lambda k: np.where(own, flat[np.minimum(start[k][:, None] + np.arange(window), len(flat) - 1)], 0)  # noqa: E731, B023
        new[some] |= (word(some) != word(some - 1)).any(1)
    first = np.flatnonzero(new)
    return {"vocab": vocab, "names": names, "flat": flat, "of": of, "at": at, "start": start, "first": np.append(first, len(start)), "width": width[first]}


def matched(seq: np.ndarray, place: np.ndarray, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many words agree from each place of ``seq`` and start in ``flat`` on,
    up to the 0 behind the item."""
    length, open_, steps = np.zeros(len(place), "int64"), np.arange(len(place)), np.arange(16)
    while len(open_):
        there = seq[np.minimum((place + length)[open_, None] + steps, len(seq) - 1)]
        item = flat[np.minimum((start + length)[open_, None] + steps, len(flat) - 1)]
        same = (there == item) & (item > 0)
        length[open_] += np.where(same.all(1), len(steps), (~same).argmax(1))
        open_ = open_[same.all(1)]
    return length


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``seq`` in the order of their next ``depth`` entries."""
    rank, k = np.unique(seq, return_inverse=True)[1].astype("int64"), 1
    while k < depth and len(seq):
        after = np.zeros_like(rank)
        after[:-k or None] = rank[k:] + 1 if k < len(rank) else 0
        rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1]
        k *= 2
    return np.argsort(rank, kind="stable")


def first_not_below(seq: np.ndarray, sa: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """For each query the first place in ``sa`` whose suffix isn't smaller."""
    lo, hi = np.zeros(len(queries), "int64"), np.full(len(queries), len(sa), "int64")
    steps = np.arange(queries.shape[1])
    while (open_ := lo < hi).any():
        q = np.flatnonzero(open_)
        mid = (lo[q] + hi[q]) // 2
        there = seq[np.minimum(sa[mid][:, None] + steps, len(seq) - 1)]
        differs = there != queries[q]
        k = differs.argmax(1)
        r = np.arange(len(q))
        below = differs[r, k] & (there[r, k] < queries[q][r, k])
        lo[q] = np.where(below, mid + 1, lo[q])
        hi[q] = np.where(below, hi[q], mid)
    return lo


def find(seq: np.ndarray, items: dict) -> tuple[np.ndarray, np.ndarray]:
    """All places of ``seq`` (0 ends a run) where a distinct benchmark window
    starts, and which. The suffix array holds the positions of runs that are
    long enough for some window."""
    none = np.zeros(0, "int64")
    if not len(items["width"]):
        return none, none
    least, depth = int(items["width"].min()), int(items["width"].max()) + 1  # one more for the upper end of a range
    ends = np.flatnonzero(seq == 0)
    starts = np.concatenate(([0], ends[:-1] + 1))
    long = ends - starts >= least
    keep = np.zeros(len(seq) + 1, "int64")
    keep[starts[long]] += 1
    keep[ends[long] + 1] -= 1
    kept = np.flatnonzero(np.cumsum(keep[:-1]))
    if not len(kept):
        return none, none
    seq = np.concatenate((seq[kept], np.zeros(depth + 1, seq.dtype)))
    sa = suffix_array(seq, depth)
    places, which = [], []
    for c in range(0, len(items["width"]), 4096):
        start, width = items["start"][items["first"][:-1][c : c + 4096]], items["width"][c : c + 4096, None]
        q = items["flat"][np.minimum(start[:, None] + np.arange(depth), len(items["flat"]) - 1)]
        inside = np.arange(depth) < width
        lo = first_not_below(seq, sa, np.where(inside, q, 0))
        hi = first_not_below(seq, sa, np.where(inside, q, np.iinfo("int32").max))
        n = np.maximum(hi - lo, 0)
        which.append(np.repeat(np.arange(len(q)), n) + c)
        places.append(kept[sa[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]])
    return np.concatenate(places), np.concatenate(which)


def halved(lo: np.ndarray, hi: np.ndarray, goes_on) -> np.ndarray:
    """For each range the first index for which ``goes_on(rows, index)`` is
    false; it is true before and false from there on."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        on = goes_on(open_, mid)
        lo[open_] = np.where(on, mid + 1, lo[open_])
        hi[open_] = np.where(on, hi[open_], mid)
    return lo


def longest(seq: np.ndarray, place: np.ndarray, which: np.ndarray, items: dict) -> tuple[np.ndarray, np.ndarray]:
    """Words of the longest match at each occurrence of a window, and the place
    among the sorted suffixes where the text belongs."""
    flat, start = items["flat"], items["start"]
    lo, hi = items["first"][which], items["first"][which + 1]

    def smaller(rows, k):
        n = matched(seq, place[rows], flat, start[k])
        return flat[start[k] + n] < seq[np.minimum(place[rows] + n, len(seq) - 1)]

    at = halved(lo, hi, smaller)
    length = np.zeros(len(place), "int64")
    for k in (at - 1, at):
        own = np.flatnonzero((k >= lo) & (k < hi))
        length[own] = np.maximum(length[own], matched(seq, place[own], flat, start[k[own]]))
    return length, at


def first_item(seq: np.ndarray, place: np.ndarray, which: np.ndarray, length: np.ndarray, at: np.ndarray, items: dict) -> list[int]:
    """Of the suffixes that match ``length`` words, the one of the first item."""
    flat, start = items["flat"], items["start"]
    reach = lambda rows, k: matched(seq, place[rows], flat, start[k]) >= length[rows]
    low = halved(items["first"][which], at, lambda rows, k: ~reach(rows, k))
    high = halved(at, items["first"][which + 1], reach)
    key = items["of"] * (int(items["at"].max()) + 1) + items["at"]
    return [int(a + key[a:b].argmin()) for a, b in zip(low, high, strict=True)]


def match_block(docs: list[list[bytes]], items: dict) -> list[tuple]:
    """Per document: words, hit spans, names of items found, and the longest
    match with its item, place in the item and place in the document (ties: the
    first place in the document, then the first item)."""
    starts = np.cumsum([0] + [len(d) + 1 for d in docs])
    seq = np.zeros(starts[-1], "int32")
    get = items["vocab"].get
    for d, s in zip(docs, starts[:-1], strict=True):
        seq[s : s + len(d)] = np.fromiter((get(w, 0) for w in d), "int32", len(d))
    # a word that no item has ends a run, too
    place, which = find(seq, items)
    out = [(len(d), [], [], 0, None, None, None) for d in docs]
    if not len(place):
        return out
    parts = [longest(seq, place[c : c + PART], which[c : c + PART], items) for c in range(0, len(place), PART)]
    length, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc = np.searchsorted(starts, place, "right") - 1
    order = np.lexsort((place, -length, doc))
    first = order[np.unique(doc[order], return_index=True)[1]]
    cover = np.zeros(len(seq) + 1, "int64")
    np.add.at(cover, place, 1)
    np.add.at(cover, place + items["width"][which], -1)
    edge = np.diff(np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).astype("int8"), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    spans: dict[int, list] = {}
    for d, a, b in zip((np.searchsorted(starts, begin, "right") - 1).tolist(), begin.tolist(), end.tolist(), strict=True):
        spans.setdefault(d, []).append({"first": int(a - starts[d]), "after": int(b - starts[d])})
    # the items of each distinct window that a document holds
    found = np.unique(doc * len(items["width"]) + which)
    names: dict[int, set] = {}
    for x in found.tolist():
        d, w = divmod(x, len(items["width"]))
        names.setdefault(d, set()).update(items["of"][items["first"][w] : items["first"][w + 1]].tolist())
    best = first_item(seq, place[first], which[first], length[first], at[first], items)
    # an item under a window's words matches just those, so windows of several
    # widths at one place don't tie
    for k, q in zip(first.tolist(), best, strict=True):
        d = int(doc[k])
        out[d] = (len(docs[d]), spans[d], sorted({items["names"][i] for i in names[d]}), int(length[k]), items["names"][items["of"][q]], int(items["at"][q]), int(place[k] - starts[d]))
    return out


def _matcher(shared):
    types = [pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())])), pa.list_(pa.string()), pa.int32(), pa.string(), pa.int32(), pa.int32()]

    def make():
        items = shared.value

        def f(column):
            rows, block, n = [], [], 0
            for text in texts(column):
                block.append(words(text))
                n += len(block[-1])
                if n >= BLOCK_WORDS:
                    rows += match_block(block, items)
                    block, n = [], 0
            if block:
                rows += match_block(block, items)
            return [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]

        return f

    return make


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int):
    """Number of blocks, and the benchmark as lists of (item id, text), each of
    about ``most`` bytes."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / most))
    part = lambda k: items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
    return n, ([(r.item, (r.text or "").encode()) for r in part(k).orderBy("item", "text").collect()] for k in range(n))


def match(docs: DataFrame, benchmark: DataFrame, carry: list[str], text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, most: int = BENCHMARK_BYTES) -> DataFrame:
    """``row`` (the carried columns) with one struct ``match``: n_words, spans
    (word places that windows cover), items, longest and where it is."""
    sc = docs.sparkSession.sparkContext
    names = ["n_words", "spans", "items", "longest", "longest_item", "longest_item_at", "longest_at"]
    n, blocks = benchmark_blocks(benchmark, item_col, item_text_col, most)
    if n == 1:
        make = _matcher(sc.broadcast(compile_items(next(blocks), window)))
        return per_text(docs, text_col, carry, RESULT, make).select("row", F.struct(*names).alias("match"))
    body = F.col(f"`{text_col}`").cast("string").alias("body")
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), body, F.monotonically_increasing_id().alias("nth")), "match-rows")
    every = None
    for k, block in enumerate(blocks):
        shared = sc.broadcast(compile_items(block, window))
        got = per_text(rows.select("nth", "body"), "body", ["nth"], RESULT, _matcher(shared)).select(F.col("row.nth").alias("nth"), F.lit(k).alias("block"), *names)
        got = stored(got.where((F.col("block") == 0) | (F.col("longest") > 0)), "match-block")
        shared.destroy()
        every = got if every is None else every.unionByName(got)
    rank = F.struct("longest", (-F.coalesce("longest_at", F.lit(0))).alias("place"), (-F.col("block")).alias("block"))
    merged = every.groupBy("nth").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max_by(F.struct(*names[3:]), rank).alias("best"))
    best = [F.col(f"best.{c}").alias(c) for c in names[3:]]
    return rows.select("row", "nth").join(merged, "nth").select("row", F.struct("n_words", "spans", "items", *best).alias("match"))


def covered(spans):
    """Words covered by spans, which may overlap."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["after"] - F.greatest(s["first"], acc["after"]))).alias("n"), F.greatest(acc["after"], s["after"]).alias("after"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("int").alias("n"), F.lit(0).cast("int").alias("after")), step)["n"].cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    the longest verbatim match (words, item, place in item and document).

    NULL and empty texts have no words and no hits; a NULL item id is listed as
    the empty string; items without words have no window. Items of one id count
    once. Texts are matched whole; one longer than a block is a block of its own.
    Longest matches that tie: the first in the document, then the first item.
    Repeated rows each give a row, NULL ids stay, other columns are not read, and
    an empty table on either side gives no hits.
    """
    m = F.col("match")
    return match(docs, benchmark, [id_col], text_col, **options).select(
        F.col(f"row.`{id_col}`").alias("doc_id"), m["n_words"].alias("n_words"), covered(m["spans"]).alias("n_hit"),
        F.size(m["items"]).cast("long").alias("n_items"), F.sha2(F.array_join(m["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(m["spans"]) > 0).alias("contaminated"), m["longest"].alias("longest"), m["longest_item"].alias("longest_item"),
        m["longest_item_at"].alias("longest_item_at"), m["longest_at"].alias("longest_at"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold any occurrence of a window."""
    kept = match(docs, benchmark, docs.columns, text_col, **options).where(F.size("match.spans") == 0)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
