"""N-gram Jaccard join by MinHash banding.

1. Signatures. A text's set is that of its runs of SHINGLE words. Texts with
   equal sets form one class; from here on only classes count, so copies never
   meet one another. MinHash rows are grouped in bands whose number and length
   are chosen for a target recall at the threshold.
2. Buckets. Classes are shuffled on their band hashes. Buckets of one class
   drop out; the classes of the others fetch their full sets, once: a bit map
   of bounded size says which texts are worth another look.
3. Cells. A bucket is cut into blocks of bounded size, and every pair of blocks
   is a cell; a pair of classes meets in one cell of a bucket, and is counted
   in the first band that both share. In a cell all pairs are verified on the
   full sets, and no pair leaves it: each class gets its number of linked
   documents and the least class it is connected with.
4. Groups are the connected components of the links, by rounds of label
   propagation over written tables.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_WORDS, stored, table, texts
from .hashing import WordHasher, kept_bytes, mix, run_hashes
from .substring_dedup import bit_map, blocks, text_key

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.9995
#: Classes and shingles of a block; a cell has two blocks at most.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 400_000
MAP_BITS = 28


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, stray: float = 0.2) -> tuple[int, int]:
    """Bands and rows: the fewest hashes that find a pair at the threshold with
    the target recall, and one of half that similarity with at most ``stray``."""
    best = None
    for rows in range(1, 21):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if 1 - (1 - (threshold / 2) ** rows) ** bands <= stray and (best is None or bands * rows < best[0] * best[1]):
            best = bands, rows
    return best


class Shingles:
    """The shingle sets of some texts: one sorted array of distinct hashes for
    each. A text of fewer words is one shingle; one without words has none."""

    def __init__(self, docs: list[bytes], hasher: WordHasher, size: int):
        _, hashes, _, _, starts = hasher.texts(docs)
        runs = run_hashes(hashes, size)
        self.sets = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a >= size:
                self.sets.append(np.unique(runs[a : b - size + 1]))
            else:
                self.sets.append(run_hashes(np.concatenate((hashes[a:b], np.zeros(size - b + a, "uint64"))), size) if b > a else np.zeros(0, "uint64"))
        self.sizes = np.array([len(s) for s in self.sets])
        self.flat = np.concatenate(self.sets) if self.sets else np.zeros(0, "uint64")

    def ids(self) -> list[bytes]:
        """128-bit digest of each set: sums of two mixes of its hashes."""
        ends = np.cumsum(self.sizes)
        out = []
        for seed in (0x1234567, 0x7654321):
            sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(self.flat ^ np.uint64(seed)))))
            out.append(mix(sums[ends] - sums[ends - self.sizes] + self.sizes.astype("uint64")))
        return [a.tobytes() + b.tobytes() for a, b in zip(*out, strict=True)]

    def bands(self, bands: int, rows: int, seed: int = 17) -> np.ndarray:
        """Band hashes (texts, bands); those of texts without words are void."""
        rng = np.random.default_rng(seed)
        some = self.sizes > 0
        starts = (np.cumsum(self.sizes) - self.sizes)[some]
        out = np.zeros((len(self.sizes), bands), "uint64")
        if some.any():
            for k in range(bands):
                key = np.full(int(some.sum()), k + 1, "uint64")
                for _ in range(rows):
                    a, b = rng.integers(1, 1 << 63, 2, dtype="uint64")
                    least = np.minimum.reduceat((self.flat * (a * np.uint64(2) + np.uint64(1))) ^ b, starts)
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
                out[some, k] = key
        return out


def _hasher() -> WordHasher:
    return WordHasher(kept_bytes(LOWER_WORDS), True)


def signatures(body: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, k1, k2, set_id, set_key, n, bands) of every text; the key is the
    first half of the set's id."""
    kind = body.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hasher = _hasher()
        for b in batches:
            at = 0
            for block in blocks(((None, t) for t in texts(b.column(3))), 1 << 20):
                s = Shingles([t for _, t in block], hasher, size)
                n, ids = len(block), s.ids()
                keys = [int.from_bytes(i[:8], "little", signed=True) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(at, n) for i in range(3)), pa.array(ids, pa.binary()), pa.array(keys, pa.int64()), pa.array(s.sizes, pa.int64()),
                     pa.array(list(s.bands(bands, rows).astype("int64")), pa.list_(pa.int64()))], ["doc_id", "k1", "k2", "set_id", "set_key", "n", "bands"])
                at += n

    return body.select("doc_id", "k1", "k2", "body").mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, set_id binary, set_key long, n long, bands array<long>")


def full_sets(body: DataFrame, bits: int, packed: bytes, size: int) -> DataFrame:
    """(set_id, shingles) of the texts whose set the map has, once in a task
    block; wrong bits bring in a few more."""
    shared = body.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        hasher, map_ = _hasher(), np.frombuffer(shared.value, "uint8")
        for b in batches:
            for block in blocks(((None, t) for t in texts(b.column(0))), 1 << 20):
                s = Shingles([t for _, t in block], hasher, size)
                ids = dict(zip(s.ids(), s.sets, strict=True))
                at = np.array([int.from_bytes(i[:8], "little") & ((1 << bits) - 1) for i in ids], "int64")
                keep = (map_[at >> 3] >> (7 - (at & 7))) & 1 == 1
                found = [(i, x) for (i, x), k in zip(ids.items(), keep.tolist(), strict=True) if k]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary())], ["set_id", "shingles"])

    return body.select("body").mapInArrow(run, "set_id binary, shingles binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    of, column = of[keep], place[column[keep]]
    out = np.zeros((len(sets), len(sets)), "float32")
    step = max(1, min(int(shared.sum()), (1 << 22) // len(sets)))
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for a in range(0, int(shared.sum()), step):
        i, j = np.searchsorted(column, (a, a + step))
        m = np.zeros((len(sets), step), "float32")
        m[of[i:j], column[i:j] - a] = 1
        out += m @ m.T
    return out


def cell_links(members: list[tuple], threshold: float) -> list[tuple[bytes, int, bytes]]:
    """(class, linked documents, least class connected) of a cell's members:
    (set_id, copies, bands, band, block, crossing, set)."""
    ids, copies, signature, band, block, crossing, sets = zip(*members, strict=True)
    sizes = np.array([len(s) for s in sets], "float32")
    both = overlaps(list(sets))
    # in whole numbers: both / (a + b - both) >= threshold
    linked = both * (1 + threshold) >= threshold * (sizes[:, None] + sizes) - 1e-3
    np.fill_diagonal(linked, False)
    side = np.array(block)
    if crossing[0]:
        linked &= side[:, None] != side
    a, b = np.nonzero(linked)
    if not len(a):
        return []
    signature = np.array(signature)
    first = (signature[a] == signature[b]).argmax(1) == band[0]
    links = np.bincount(a[first], np.array(copies, float)[b[first]], minlength=len(ids))
    root = np.arange(len(ids))
    while True:  # least member reached, by name
        low = root.copy()
        np.minimum.at(low, a, root[b])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return [(ids[k], int(links[k]), ids[root[k]]) for k in np.unique(a).tolist()]


def linked_classes(cells: DataFrame, threshold: float) -> DataFrame:
    """(set_id, links, low), a row for each linked member of a cell."""
    names = ["bucket", "lo", "hi", "set_id", "copies", "bands", "band", "block", "crossing", "shingles"]

    def run(batches):
        def done(members):
            return cell_links(sorted(members, key=lambda m: m[0]), threshold) if len(members) > 1 else []

        here, members, out = None, [], []
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(len(names))), strict=True):
                cell, m = row[:3], row[3:]
                if cell != here:
                    out += done(members)
                    here, members = cell, []
                members.append((*m[:-1], np.frombuffer(m[-1], "uint64")))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], ["set_id", "links", "low"])
                out = []
        out += done(members)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], ["set_id", "links", "low"])

    ordered = cells.select(*names).repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    return ordered.mapInArrow(run, "set_id binary, links long, low binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the least node of each connected component. In a round
    every node takes the least label among its neighbours, then its label's
    label; rounds go on until nothing changes, each over written tables."""
    both = stored(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        taken = labels.join(near, labels["node"] == near["a"]).select("node", F.least("root", "near").alias("next"), F.col("root").alias("old"))
        taken = stored(taken, "labels")
        jump = taken.select(F.col("node").alias("via"), F.col("next").alias("further"))
        jumped = taken.join(jump, taken["next"] == jump["via"]).select("node", F.least("next", "further").alias("root"), (F.least("next", "further") != F.col("old")).alias("changed"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "root")
        if not jumped.where("changed").limit(1).count():
            return labels


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD,
            recall: float = RECALL, map_bits: int = MAP_BITS) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and (set_id, links, root) of the linked classes."""
    bands, rows = choose_bands(threshold, recall)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    body = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("body")).select("doc_id", *text_key(F.col("body")), "body")
    every = stored(signatures(body, size, bands, rows), "signatures")
    one = stored(every.where("n > 0").groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"), F.first("set_key").alias("set_key"), F.first("bands").alias("bands"), F.first("n").alias("n")), "classes")
    rowed = one.select("set_id", "n", F.posexplode("bands").alias("band", "bucket"))
    sizes = rowed.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles")).where("classes > 1")
    met = rowed.join(sizes, "bucket").drop("n").join(one.drop("n"), "set_id")
    met = stored(met.select("bucket", "set_id", "set_key", "copies", "bands", "band", "classes", "shingles"), "buckets")
    wanted = stored(met.select("set_id", "set_key").distinct(), "wanted")
    bits, packed = bit_map(wanted.select(F.col("set_key").alias("anchor")), wanted.count(), map_bits)
    sets = full_sets(body, bits, packed, size).groupBy("set_id").agg(F.first("shingles").alias("shingles"))
    n_blocks = F.greatest(F.ceil(F.col("classes") / BLOCK_CLASSES), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("set_id", F.lit(3)), F.col("blocks")).cast("int")
    spread = met.withColumn("blocks", n_blocks).withColumn("block", own).drop("shingles")
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = spread.join(sets, "set_id").select(
        "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "set_id", "copies", "bands", "band", "block",
        (F.col("block") != F.col("other")).alias("crossing"), "shingles")
    linked = stored(linked_classes(cells, threshold), "links")
    links = linked.groupBy("set_id").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("set_id").alias("a"), F.col("low").alias("b")))
    return every, links.join(roots, links["set_id"] == roots["node"]).select("set_id", "links", "root")


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, k1, k2 (digests of the text), class_id, n_links, and
    stays: whether the row is its group's first by (doc_id, k1, k2)."""
    every, linked = classes(docs, id_col, text_col, **options)
    rows = every.select("doc_id", "k1", "k2", "set_id", "n").join(linked, "set_id", "left")
    group = F.when(F.col("n") > 0, F.coalesce("root", "set_id"))
    rows = stored(rows.select("doc_id", "k1", "k2", "set_id", "n", F.coalesce("links", F.lit(0)).alias("links"), group.alias("root")), "groups")
    row = F.struct("doc_id", "k1", "k2")
    groups = rows.where("n > 0").groupBy("root").agg(F.min(row).alias("winner"), F.min("doc_id").alias("class_id"))
    copies = rows.where("n > 0").groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"))
    joined = rows.join(groups, "root", "left").join(copies, "set_id", "left")
    return joined.select("doc_id", "k1", "k2", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                         (F.col("links") + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
                         ((F.col("n") == 0) | row.eqNullSafe(F.col("winner"))).alias("stays"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, class_id (the least id of its group) and n_links, the
    number of other rows whose sets are similar enough, copies included.

    Groups are the connected components of the links. NULL, empty and other
    texts without words have no set, no link and their own id as class. Texts
    are read whole; the set of one has to fit in a task. Of ids that tie for a
    class the value is the same. Repeated rows each give a row and count as copies. A NULL id is no candidate for the
    class id. Other columns are not read; an empty table gives an empty result.
    """
    return marked(docs, id_col, text_col, **options).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group, that of the least id (NULL first),
    then of the least text digest. Rows repeated in full stay together; run
    exact dedup first. Texts without words all stay."""
    gone = marked(docs, id_col, text_col, **options).where(~F.col("stays")).select(
        F.col("doc_id").alias("gone_id"), F.col("k1").alias("gone_1"), F.col("k2").alias("gone_2")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), *text_key(text))
    kept = keyed.join(gone, keyed["id"].eqNullSafe(gone["gone_id"]) & (keyed["k1"] == gone["gone_1"]) & (keyed["k2"] == gone["gone_2"]), "left_anti")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
