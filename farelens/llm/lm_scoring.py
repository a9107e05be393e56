"""Language-model scoring by cross-entropy difference.

Two bigram models, one of a target corpus and one of the whole corpus, share
one vocabulary: all words of all documents (``size`` keeps only the most
frequent ones, any other word then counts as unknown). Both are smoothed alike,
by interpolation with their unigrams and the uniform distribution. A document's
score is the mean over its words of the target's loss less the background's:
the lower, the more it is like the target.

Counts are exact, over all documents, words and word pairs, so the models grow
with the corpus and are never sent to a task as a whole. Documents are written
once as blocks of word numbers. A block sends each of its different n-grams once,
with its counts, to the part that the n-gram's hash names; the part adds up and
answers every block with the sums for just these n-grams. So an n-gram that
stands everywhere costs one entry a block, and nothing is joined by a hot key.
Words are told apart by 64-bit hashes, n-grams by 62 bits of a hash of both words
and, as hashes are compared inside a part alone, by the bits of the part (8 at least).
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table, texts, words, with_row

BIGRAM, UNIGRAM = 0.7, 0.25  # what is left goes to the uniform distribution
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 300_000
#: Words of a block; a longer text is a block of its own.
BLOCK_WORDS = 1 << 21
#: Parts that add up n-grams: one for so many words of the corpus, LEAST_PARTS at least.
PART_WORDS, LEAST_PARTS = 1 << 20, 256
#: What may stand in an n-gram in a word's place: an unknown word, a text's
#: start, and the other place of a single word (as second or as first word).
UNKNOWN, START, AS_NEXT, AS_BEFORE, RESERVED = range(5)
#: The last two bits of an n-gram's key: a known word as a second word, an
#: unknown one, or anything else.
WORD, OTHER_WORD, ELSE = range(3)
RESULT = "n_words long, target_loss double, background_loss double, score double"


def vocabulary(docs: DataFrame, text_col: str, size: int) -> list[bytes]:
    """The most frequent words, ties in byte order."""
    def run(batches):
        def rows(n):
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["word", "n"])

        n: Counter = Counter()
        for b in batches:
            for t in texts(b.column(0)):
                n.update(words(t))
                if len(n) > COUNTED_WORDS:
                    yield rows(n)
                    n.clear()
        yield rows(n)

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [bytes(r.word) for r in top.collect()]


def word_hash(word: bytes) -> int:
    h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h if h >= RESERVED else h + RESERVED


class Numbers(dict):
    """Numbers of words in the order in which they are first met."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def blocks(docs: DataFrame, id_col: str, text_col: str, known: list[bytes] | None) -> DataFrame:
    """(block, rows, lengths, tokens, hashes), written: the ids and word counts
    of a block's texts, all their words as places in ``hashes``, and the hash of
    every word. A word that isn't ``known`` is UNKNOWN."""
    shared = None if known is None else docs.sparkSession.sparkContext.broadcast(frozenset(known))
    frame = docs.select(F.struct(F.col(f"`{id_col}`").alias("id")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    row = frame.schema["row"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(row)), *[T.StructField(c, T.BinaryType()) for c in ("lengths", "tokens", "hashes")]])

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        ids, rows, lengths, tokens, n = Numbers(), [], [], [], 0

        def block():
            hashes = np.fromiter((word_hash(w) if shared is None or w in shared.value else UNKNOWN for w in ids), "uint64", len(ids))
            whole = pa.concat_arrays(rows)
            data = [packed(x) for x in (np.array(lengths, "int64"), np.concatenate(tokens), hashes)]
            return pa.RecordBatch.from_arrays([pa.array([task << 32 | made], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole), *[pa.array([x], pa.binary()) for x in data]], schema.names)

        for b in batches:
            taken = 0
            for k, t in enumerate(texts(b.column(1))):
                found = words(t)
                tokens.append(np.fromiter(map(ids.__getitem__, found), "int32", len(found)))
                lengths.append(len(found))
                n += len(found)
                if n >= BLOCK_WORDS:
                    rows.append(b.column(0).slice(taken, k + 1 - taken))
                    yield block()
                    made, taken, n = made + 1, k + 1, 0
                    ids, rows, lengths, tokens = Numbers(), [], [], []
            if taken < b.num_rows:
                rows.append(b.column(0).slice(taken))
        if lengths:
            yield block()

    return stored(frame.mapInArrow(run, schema), "lm-blocks")


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as bytes: bytes an entry, entries, then all first bytes, all
    second bytes, and so on, compressed."""
    wide = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(np.ascontiguousarray(x, "<u8").view("u1").reshape(-1, 8)[:, :wide].T)
    return bytes([wide]) + len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(x: bytes, kind: str = "int64") -> np.ndarray:
    wide, n = x[0], int.from_bytes(x[1:9], "little")
    out = np.zeros((n, 8), "u1")
    out[:, :wide] = np.frombuffer(pa.decompress(x[9:], n * wide, "zstd"), "u1").reshape(wide, n).T
    return out.reshape(-1).view("<u8").astype(kind)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(block: dict, parts: int) -> dict:
    """The different n-grams of a block, in the order of their parts: word pairs,
    then every word as a second and as a first word."""
    lengths, w = unpacked(block["lengths"]), unpacked(block["tokens"])
    # Unknown words have one hash and may have many numbers: numbers become those of hashes.
    hashes, number = np.unique(np.append(unpacked(block["hashes"], "uint64"), np.uint64(START)), return_inverse=True)
    start, w, size = number[-1], number[w], len(hashes)
    before = np.concatenate(([start], w[:-1])) if len(w) else w
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = start
    pair, at = np.unique(before * size + w, return_inverse=True)
    a = np.concatenate((hashes[pair // size], np.full(size, AS_NEXT, "uint64"), hashes))
    b = np.concatenate((hashes[pair % size], hashes, np.full(size, AS_BEFORE, "uint64")))
    key = mixed(mixed(a) + b * np.uint64(0x9E3779B97F4A7C15))
    part = mixed(key ^ mixed(b + mixed(a ^ np.uint64(0xC2B2AE3D27D4EB4F)))) % np.uint64(parts)
    kind = np.full(len(key), ELSE, "uint64")
    kind[len(pair) : len(pair) + size] = np.where(hashes == UNKNOWN, OTHER_WORD, WORD)
    key = key & ~np.uint64(3) | kind
    order = np.argsort(key)
    order = order[np.argsort(part[order].astype("uint16" if parts <= 1 << 16 else "uint64"), kind="stable")]
    return {"key": key[order], "part": part[order].astype("int64"), "order": order, "lengths": lengths,
            "pair": at, "next": len(pair) + w, "before": len(pair) + size + before}


SENT = "block long, part long, counted boolean, key binary, n binary, mine binary"
ANSWER = "block long, part long, n binary, mine binary"


def sent(made: DataFrame, flags: DataFrame, parts: int, counted: bool) -> DataFrame:
    """Each block's n-grams and their counts in all and in the target's texts
    (``flags``: block, as ``of``, and place), one row for a block and part."""
    def run(left, right):
        out = {k: [] for k in ("block", "part", "counted", "key", "n", "mine")}
        for x in left.to_pylist():
            g = ngrams(x, parts)
            mine = np.zeros(len(g["lengths"]))
            mine[right.column("at").to_numpy()] = 1
            mine = np.repeat(mine, g["lengths"])
            at, all_ = (g["pair"], g["next"], g["before"]), len(g["order"])
            n = sum(np.bincount(k, minlength=all_) for k in at)[g["order"]]
            m = sum(np.bincount(k, weights=mine, minlength=all_) for k in at).astype("int64")[g["order"]]
            edges = np.flatnonzero(np.diff(g["part"], prepend=-1, append=-1)).tolist() if all_ else [0]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                row = (x["block"], int(g["part"][i]), counted, packed(np.diff(g["key"][i:j], prepend=np.uint64(0))), packed(n[i:j]), packed(m[i:j]))
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
        return pa.table([pa.array(out["block"], pa.int64()), pa.array(out["part"], pa.int64()), pa.array(out["counted"], pa.bool_()), *[pa.array(out[c], pa.binary()) for c in ("key", "n", "mine")]], names=list(out))

    cut = made.select("block", "lengths", "tokens", "hashes")
    return cut.groupBy("block").cogroup(flags.groupBy("of")).applyInArrow(run, SENT)


def answered(rows: pa.Table) -> pa.Table:
    """One part: the sums for every n-gram, in the order in which a block sent
    them, and a row without a block: how many words and how often."""
    got = {c: rows.column(c).to_pylist() for c in rows.column_names}
    keys = [np.cumsum(unpacked(x, "uint64"), dtype="uint64") for x in got["key"]]
    ends = np.cumsum([len(x) for x in keys])
    use = np.repeat(got["counted"], np.diff(ends, prepend=0))
    keys, group = np.unique(np.concatenate(keys), return_inverse=True)
    sums = []
    for c in ("n", "mine"):
        sums.append(np.zeros(len(keys), "int64"))
        np.add.at(sums[-1], group, np.where(use, np.concatenate([unpacked(x) for x in got[c]]), 0))
    kind = keys & np.uint64(3)
    words_, single = int(np.count_nonzero((kind == WORD) & (sums[0] > 0))), (kind == WORD) | (kind == OTHER_WORD)
    out = [(None, words_, packed(np.array([sums[0][single].sum()])), packed(np.array([sums[1][single].sum()])))]
    for block, part, i, j in zip(got["block"], got["part"], np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        out.append((block, part, *[packed(s[group[i:j]]) for s in sums]))
    return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "part", "n", "mine"])


def train(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None) -> dict:
    """What both models are counted on. ``target`` has the ids of the target's
    documents; ``size`` keeps that many words of the vocabulary, None all."""
    known = None if size is None else vocabulary(docs, text_col, size)
    made = blocks(docs, id_col, text_col, known)
    ids = target.select(F.col(id_col).alias("target_id")).where("target_id IS NOT NULL").distinct()
    each = made.select("block", F.posexplode(F.transform("rows", lambda r: r["id"])).alias("at", "id"))
    # The target grows with the corpus, so it is never broadcast.
    flags = each.join(ids.hint("merge"), F.col("id") == F.col("target_id")).select(F.col("block").alias("of"), F.col("at").cast("long").alias("at"))
    return {"docs": docs, "columns": (id_col, text_col), "known": known, "blocks": made, "flags": flags}


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, target_loss, background_loss (means a word) and
    score, their difference.

    NULL and empty texts have no words, and 0 for all three. Texts are read
    whole; one longer than a block is a block of its own, so its words have to
    fit in a task. Documents that tie have equal scores. Repeated rows each give
    a row, NULL ids stay, other columns are not read, and an empty table
    gives an empty result.
    """
    own = docs is model["docs"] and (id_col, text_col) == model["columns"]
    made = model["blocks"]
    n = made.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-n // 4 // PART_WORDS))
    rows = sent(made, model["flags"], parts, True)
    if not own:
        made = blocks(docs, id_col, text_col, model["known"]).withColumn("block", -1 - F.col("block"))
        rows = rows.unionByName(sent(made, model["flags"].where("false"), parts, False))
    answers = rows.groupBy("part").applyInArrow(answered, ANSWER)
    answers = stored(answers if own else answers.where("block IS NULL OR block < 0"), "lm-counts")
    size, whole, mine = 2, 0, 0
    for r in answers.where("block IS NULL").collect():  # one row for each part
        size, whole, mine = size + r.part, whole + int(unpacked(r.n)[0]), mine + int(unpacked(r.mine)[0])

    frame = made.select(F.col("rows")[0].alias("row"))
    schema = with_row(frame, RESULT)

    def loss(g, count, total):
        seen = count[g["next"]] / max(total, 1)
        first = count[g["before"]]
        after = np.divide(count[g["pair"]], first, out=seen.copy(), where=first > 0)
        return -np.log(BIGRAM * after + UNIGRAM * seen + (1 - BIGRAM - UNIGRAM) / size)

    def run(left, right):
        tables = []
        right = right.sort_by("part")
        for k, x in enumerate(left.select(["lengths", "tokens", "hashes"]).to_pylist()):
            g = ngrams(x, parts)
            n = g["lengths"]
            of, per = np.repeat(np.arange(len(n)), n), np.maximum(n, 1)
            means = []
            for c, total in (("mine", mine), ("n", whole)):
                count = np.zeros(len(g["order"]), "int64")
                count[g["order"]] = np.concatenate([unpacked(v) for v in right.column(c).to_pylist()])
                means.append(np.bincount(of, weights=loss(g, count, total), minlength=len(n)) / per)
            tables.append(pa.table([left.column("rows").combine_chunks().slice(k, 1).flatten(), pa.array(n), *map(pa.array, (*means, means[0] - means[1]))], names=schema.names))
        return pa.concat_tables(tables)

    out = made.groupBy("block").cogroup(answers.where("block IS NOT NULL").groupBy("block")).applyInArrow(run, schema)
    return out.select(F.col("row.id").alias("doc_id"), "n_words", "target_loss", "background_loss", "score")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents that ``labels`` marks as of good quality."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels").where("quality = 1")))
