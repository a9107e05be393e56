"""Substring dedup: words covered by repeated windows go.

A window is WINDOW words of one text. It is repeated if the same words also
start anywhere else. Whole texts never meet in one place; windows do:

1. Anchors. The least hash of the GRAM-word runs in a window is its anchor, so
   equal windows have equal anchors. Anchors are counted over all texts (counts
   are added up in each task first).
2. Hot anchors, at least 1 in HOT_SHARE of all, a list whose length is bounded
   by that share, step back: a window takes one only if all its runs are hot.
   So a passage that stands in very many different surroundings makes few
   different segments.
3. Segments. Neighbouring windows with one anchor form a segment. Those whose
   anchor stands only once hold nothing repeated. A bit map of the others, of
   bounded size, leaves most of them out; a wrong bit only lets one more pass.
   Equal segments are counted together.
4. Shards. Segments meet by anchor. Each task builds compressed FM-indexes of
   its segments, block by block, never parting an anchor, and streams them
   through backward search, which gives the repeated windows.
5. The spans found go back to all texts that hold the segment, by a digest of
   the text, and the texts are cut.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored, table, texts, with_row
from .fm_index import repeated_windows
from .hashing import BETWEEN_SPACES, WordHasher, run_hashes, sliding_min

WINDOW, GRAM = 35, 8
#: Longest part that is searched for at once; a longer one is found in parts.
DEPTH = 64
HOT_COUNT, HOT_SHARE = 2000, 100_000
MAP_BITS = 28
#: Bytes of text hashed at once, and words indexed at once, in a task.
BLOCK_BYTES, BLOCK_WORDS = 2 << 20, 200_000
#: Bytes of distinct segments that a task counts before it passes them on.
COMBINE_BYTES = 32 << 20
HOT = np.uint64(1 << 63)


def blocks(rows, size=BLOCK_BYTES):
    """Lists of (item, text) of about ``size`` bytes; a longer text stands alone."""
    block, n = [], 0
    for item, text in rows:
        block.append((item, text))
        n += len(text)
        if n >= size:
            yield block
            block, n = [], 0
    if block:
        yield block


class Windows:
    """The windows of some texts and their anchors."""

    def __init__(self, docs: list[bytes], hasher: WordHasher, window: int, gram: int, hot: np.ndarray | None = None):
        self.blob, hashes, self.first, self.after, self.starts = hasher.texts(docs)
        self.grams = run_hashes(hashes, gram) >> np.uint64(1)
        anchor = sliding_min(self.grams, window - gram + 1) if len(hashes) >= window else np.zeros(0, "uint64")
        self.old = anchor
        if hot is not None and len(hot) and len(anchor):
            at = np.minimum(np.searchsorted(hot, self.grams), len(hot) - 1)
            anchor = sliding_min(np.where(hot[at] == self.grams, self.grams | HOT, self.grams), window - gram + 1)
        self.anchor = anchor
        begin, end = self.starts[:-1], self.starts[1:] - window + 1
        some = end > begin
        self.begin = begin[some]
        step = np.zeros(len(anchor) + 1, "int64")
        np.add.at(step, self.begin, 1)
        np.add.at(step, end[some], -1)
        self.whole = np.cumsum(step[:-1]) > 0  # windows that don't reach into the next text

    def anchors(self, width: int) -> np.ndarray:
        """The hashes of all places that are some window's anchor, as often as
        they are: a place is one if the greatest of the least over its windows
        is its own."""
        if not self.whole.any():
            return np.zeros(0, "uint64")
        none = np.uint64(0)
        least = np.where(self.whole, self.anchor, none)
        edge = np.zeros(width - 1, "uint64")
        top = ~sliding_min(~np.concatenate((edge, least, edge)), width)
        return self.grams[(top == self.grams) & (top > none)]

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and window after of each run of windows with one anchor."""
        if not self.whole.any():
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        new = np.ones(len(self.anchor), bool)
        new[1:] = self.anchor[1:] != self.anchor[:-1]
        new[self.begin] = True
        first = np.flatnonzero(self.whole & new)
        stops = np.append(np.flatnonzero(~self.whole | new), len(new))
        return first, stops[np.searchsorted(stops, first, "right")]


def text_key(text):
    """Two independent 64-bit digests of a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def anchor_counts(body: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, n) over all texts."""
    def run(batches):
        hasher = WordHasher(BETWEEN_SPACES, False)
        rows = ((None, t) for b in slices(batches) for t in texts(b.column(0)))
        for block in blocks(rows):
            v, n = np.unique(Windows([t for _, t in block], hasher, window, gram).anchors(window - gram + 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(v.astype("int64")), pa.array(n)], ["anchor", "n"])

    return body.select("body").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


def bit_map(repeated: DataFrame, rows: int, most: int) -> tuple[int, bytes]:
    """Bits of the anchors that stand more than once: at most 2 ** ``most``."""
    bits = max(16, min(most, math.ceil(math.log2(16 * max(rows, 1)))))
    low = min(bits, 18)

    def pack(batches):
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            at = b.column(0).to_numpy().astype("uint64") & np.uint64((1 << bits) - 1)
            for part in np.unique(at >> np.uint64(low)).tolist():
                mine = at[at >> np.uint64(low) == part]
                parts.setdefault(part, np.zeros(1 << low, bool))[(mine & np.uint64((1 << low) - 1)).astype("int64")] = True
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([np.packbits(x).tobytes() for x in parts.values()], pa.binary())], ["part", "bits"])

    own = F.shiftrightunsigned(F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1)), low)
    parts = repeated.select("anchor", own.alias("part")).repartition("part").select("anchor").mapInArrow(pack, "part long, bits binary")
    out = bytearray(1 << (bits - 3))
    for r in parts.collect():  # together as large as the map
        out[r.part << (low - 3) : (r.part + 1) << (low - 3)] = r.bits
    return bits, bytes(out)


def segment_rows(body: DataFrame, hot: list[int], bits: int, packed: bytes, window: int, gram: int) -> DataFrame:
    """(k1, k2, first, windows, anchor, segment): first word of the segment in
    its text, and the segment's words joined by one space."""
    shared = body.sparkSession.sparkContext.broadcast((np.sort(np.array(hot, "int64")).astype("uint64"), packed))

    def run(batches):
        hasher, (hot_, packed_) = WordHasher(BETWEEN_SPACES, False), shared.value
        map_ = np.frombuffer(packed_, "uint8")
        rows = (((k1, k2), t) for b in slices(batches) for k1, k2, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)), strict=True))
        for block in blocks(rows):
            w = Windows([t for _, t in block], hasher, window, gram, hot_)
            first, after = w.segments()
            if not len(first):
                continue
            anchor = w.anchor[first] & ~HOT
            at = anchor & np.uint64((1 << bits) - 1)
            keep = (map_[(at >> np.uint64(3)).astype("int64")] >> (7 - (at & np.uint64(7)))) & np.uint64(1) == 1
            if len(hot_):
                changed = np.concatenate(([0], np.cumsum(w.anchor != w.old)))
                keep |= changed[after] > changed[first]
            first, after, anchor = first[keep], after[keep], anchor[keep]
            doc = np.searchsorted(w.starts, first, "right") - 1
            words = [b" ".join(w.blob[w.first[i] : w.after[j]].split()) for i, j in zip(first.tolist(), (after + window - 2).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block[d][0][0] for d in doc.tolist()], pa.int64()), pa.array([block[d][0][1] for d in doc.tolist()], pa.int64()),
                 pa.array(first - w.starts[doc]), pa.array(anchor.astype("int64")), pa.array(words, pa.binary())], ["k1", "k2", "first", "anchor", "segment"])

    return body.mapInArrow(run, "k1 long, k2 long, first long, anchor long, segment binary")


def search_block(segments: list[list[bytes]], counts: np.ndarray, window: int, depth: int) -> list[list[dict]]:
    """For each segment the spans of words that repeated windows cover."""
    ids: dict[bytes, int] = {}
    rows = [[ids.setdefault(w, len(ids) + 1) for w in s] for s in segments]
    sizes = np.array([len(r) for r in rows])
    seq = np.zeros(int(sizes.sum()) + len(rows), "int64")
    starts = np.cumsum(sizes + 1) - sizes - 1
    for s, r in zip(starts.tolist(), rows, strict=True):
        seq[s : s + len(r)] = r
    ends = starts + sizes
    hit = repeated_windows(seq, starts, ends, window, depth)
    for k in np.flatnonzero(counts > 1).tolist():  # a segment that stands more than once
        hit[starts[k] : ends[k] - window + 1] = True
    cover = np.zeros(len(seq) + window + 1, "int64")
    cover[:-1][: len(seq)] += hit
    cover[window : window + len(seq)] -= hit
    edge = np.diff(np.concatenate(([0], (np.cumsum(cover)[: len(seq)] > 0).astype("int8"), [0])))
    out: list[list[dict]] = [[] for _ in segments]
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for k, a, b in zip((np.searchsorted(starts, begin, "right") - 1).tolist(), begin.tolist(), stop.tolist(), strict=True):
        out[k].append({"first": int(a - starts[k]), "after": int(b - starts[k])})
    return out


def combined(every: DataFrame) -> DataFrame:
    """(anchor, segment, n): equal segments of a task counted together, so that
    a text with very many copies sends one row from each task. A task holds
    COMBINE_BYTES of segments at most before it passes them on."""
    def run(batches):
        def out():
            keys = list(n)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in keys], pa.int64()), pa.array([s for _, s in keys], pa.binary()), pa.array(list(n.values()), pa.int64())],
                                              ["anchor", "segment", "n"])

        n: dict = {}
        size = 0
        for b in batches:
            for key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if key in n:
                    n[key] += 1
                    continue
                n[key] = 1
                size += len(key[1]) + 200
                if size > COMBINE_BYTES:
                    yield out()
                    n.clear()
                    size = 0
        if n:
            yield out()

    return every.select("anchor", "segment").mapInArrow(run, "anchor long, segment binary, n long")


def search(segments: DataFrame, window: int, depth: int) -> DataFrame:
    """(anchor, s1, s2, spans) of the segments with any repeated window. Rows of
    one anchor meet in one task, side by side; equal segments are added up."""
    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(5)), strict=True)

        def done(block):
            spans = search_block([r[4].split(b" ") for r in block], np.array([r[3] for r in block]), window, depth)
            found = [(r, s) for r, s in zip(block, spans, strict=True) if s]
            return pa.RecordBatch.from_arrays(
                [*(pa.array([r[i] for r, _ in found], pa.int64()) for i in range(3)),
                 pa.array([s for _, s in found], pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())])))], ["anchor", "s1", "s2", "spans"])

        block, n, at = [], 0, {}
        for anchor, s1, s2, times, segment in rows():
            if block and anchor != block[-1][0]:
                at.clear()
                if n >= BLOCK_WORDS:
                    yield done(block)
                    block, n = [], 0
            if segment in at:
                block[at[segment]][3] += times
                continue
            at[segment] = len(block)
            block.append([anchor, s1, s2, times, segment])
            n += segment.count(b" ") + 2
        if block:
            yield done(block)

    digest = [F.xxhash64("segment").alias("s1"), F.xxhash64(F.lit(7), "segment").alias("s2")]
    ordered = segments.repartition("anchor").sortWithinPartitions("anchor").select("anchor", *digest, "n", "segment")
    return ordered.mapInArrow(run, "anchor long, s1 long, s2 long, spans array<struct<first:int,after:int>>")


def repeated_spans(body: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_count: int = HOT_COUNT, hot_share: int = HOT_SHARE,
                   map_bits: int = MAP_BITS) -> DataFrame:
    """(k1, k2, spans): the word spans to remove from each text, by its digests.
    ``body`` has k1, k2 and body (bytes of a text that isn't NULL)."""
    counts = stored(anchor_counts(body, window, gram).where("n > 1"), "anchors")
    rows, whole = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = max(hot_count, whole // hot_share)
    hot = [r.anchor for r in counts.where(F.col("n") >= least).select("anchor").collect()]  # at most hot_share
    bits, packed = bit_map(counts, rows, map_bits)
    every = stored(segment_rows(body, hot, bits, packed, window, gram), "segments")
    digest = [F.xxhash64("segment").alias("s1"), F.xxhash64(F.lit(7), "segment").alias("s2")]
    found = search(combined(every), window, max(DEPTH, window + 1))
    places = every.select("k1", "k2", "first", "anchor", *digest).distinct()
    spans = places.join(found, ["anchor", "s1", "s2"]).select("k1", "k2", F.transform("spans", lambda s: F.struct(
        (F.col("first") + s["first"]).alias("first"), (F.col("first") + s["after"]).alias("after"))).alias("spans"))
    # Written, so that the join with the texts can split a text that is hot.
    return stored(spans.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")


def cut(text: bytes | None, spans) -> tuple[int, int, bytes]:
    """Words, words removed, and the kept words joined by one space."""
    words = text.split() if text else []
    if not spans:
        return len(words), 0, b" ".join(words)
    step = np.zeros(len(words) + 1, "int64")
    for s in spans:
        step[s["first"]] += 1
        step[s["after"]] -= 1
    kept = np.flatnonzero(np.cumsum(step[:-1]) == 0)
    return len(words), len(words) - len(kept), b" ".join([words[i] for i in kept.tolist()])


def without_repeats(docs: DataFrame, carry: list[str], text_col: str = "text", **options) -> DataFrame:
    """``row`` (the carried columns) and n_words, n_removed, kept (the text's
    kept words joined by one space) for every row of ``docs``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text.alias("body"))
    keyed = rows.select("row", "body", *text_key(F.col("body")))
    spans = repeated_spans(keyed.select("k1", "k2", "body"), **options)
    joined = keyed.join(spans, ["k1", "k2"], "left").select("row", "body", "spans")

    def run(batches):
        for b in slices(batches):
            out = [cut(t, s) for t, s in zip(texts(b.column(1)), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                              pa.array([x[2] for x in out], pa.binary()).cast(pa.string())], ["row", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, with_row(joined, "n_words long, n_removed long, kept string"))


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256.

    Windows are judged on the input, so of a passage that stands twice no copy
    stays, and ties between copies don't arise. NULL and empty texts have no
    words; texts shorter than a window lose none; one longer than a block is
    hashed on its own. Repeated rows each give a row and count as separate texts, NULL ids
    stay, other columns are not read, an empty table gives an empty result.
    """
    return without_repeats(docs, [id_col], text_col, **options).select(
        F.col(f"row.`{id_col}`").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(table(spark, sf_dir, "documents"))
