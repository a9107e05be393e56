"""Spelling variants by Bloom-guided neighbourhoods.

1. Letter runs are counted over whole texts, added up in each task first; the
   frequent ones of some length are the words.
2. A blocked Bloom filter holds all words, with a shard of blocks for each word
   length, so that an edit is looked for among words of its own length only. The
   shards together are cut into pieces of at most FILTER_BYTES. Pieces are
   broadcast one after another, so what is sent at once doesn't grow with the
   vocabulary.
3. Every word generates edits: all deletions, and replacements by greater
   letters that words of its length have. That meets each pair of near words
   once, as an insertion is the other word's deletion. Edits are hashed without
   being spelt out: a word's hash is a sum over its letters and their places.
4. Only edits that the filter holds are spelt out and shuffled to an exact join
   with the vocabulary, which removes what the filter took wrongly.
5. A word's form is the most frequent near word, if it is RATIO times as frequent
   as the word; roots come by pointer jumping along the forms.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, texts
from .hashing import mix

#: Letters of a run, least length and count of a word, the fold
#: of runs that lose a letter.
LETTERS = r"a-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, FOLD, RATIO = 6, 5, 199, 5
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BREAK = re.compile(f"[^{LETTERS}]")
#: Characters of a text read at once; words a task counts before it passes them on.
CHUNK, COMBINE = 1 << 20, 400_000
#: A block has 512 bits; each word sets PROBES of them, at BITS a word on average.
BLOCK, BITS, PROBES = 512, 16, 6
FILTER_BYTES = 32 << 20
#: Blocks of the filter that are put together in one row.
ROW_BLOCKS = 1024
#: Edits hashed at once in a task.
EDITS = 1 << 18
SEED = np.uint64(0x5851F42D4C957F2D)


def runs(text: str, least: int):
    """Lists of the letter runs of at least ``least`` letters, for a text in parts."""
    found, at = re.compile(f"[{LETTERS}]{{{least},}}").findall, 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            stop = BREAK.search(text, end)
            end = stop.start() if stop else len(text)
        yield found(text[at:end] if at or end < len(text) else text)
        at = end


def word_counts(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST_LENGTH, fold: int = FOLD) -> DataFrame:
    """(word, n) over all texts; a run loses a letter where the CRC-32 of its
    document's id and itself says so."""
    def count(batches):
        total: Counter = Counter()
        done = lambda: pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                if not raw:
                    continue
                start = zlib.crc32(f"{name or ''}:".encode())
                for found in runs(raw.translate(ASCII_LOWER).decode(), least):
                    for run, n in Counter(found).items():
                        h = zlib.crc32(run.encode(), start)
                        if h % fold == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least:
                                continue
                        total[run] += n
                    if len(total) > COMBINE:
                        yield done()
                        total.clear()
        if total:
            yield done()

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("name"), F.col(f"`{text_col}`").cast("string").alias("body"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def share(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What letters at their places add to the hash of a word."""
    return mix(places.astype("uint64") * np.uint64(256) + letters + SEED)


def spread(total: np.ndarray, length: int) -> np.ndarray:
    """The hash of words of one length from the sums of their letters' shares."""
    return mix(total ^ np.uint64(length * 0x9E3779B1))


def block_of(hashes: np.ndarray, shard: tuple[int, int]) -> np.ndarray:
    first, n = shard
    return first + (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype("int64")


def bit_in_block(hashes: np.ndarray, k: int) -> np.ndarray:
    return ((mix(hashes + SEED) >> np.uint64(9 * k)) & np.uint64(BLOCK - 1)).astype("int64")


def by_length(words: list[str]):
    """(length, places, letters as bytes) of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield n, at, np.frombuffer("".join([words[i] for i in at]).encode("latin-1"), "uint8").reshape(-1, n)


def shape(vocabulary: DataFrame) -> dict[int, tuple[int, bytes]]:
    """For each word length the number of words and their letters."""
    def count(batches):
        for b in batches:
            out = []
            for n, at, letters in by_length(b.column(0).to_pylist()):
                out.append((n, -1, len(at)))
                out += [(n, int(x), 0) for x in np.unique(letters)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["size", "letter", "n"])

    rows = vocabulary.select("word").mapInArrow(count, "size long, letter long, n long").groupBy("size", "letter").agg(F.sum("n").alias("n")).collect()
    count_of = {r["size"]: r.n for r in rows if r.letter < 0}
    letters: dict[int, list[int]] = {n: [] for n in count_of}
    for r in rows:
        if r.letter >= 0:
            letters[r["size"]].append(r.letter)
    return {n: (count_of[n], bytes(sorted(letters[n]))) for n in sorted(count_of)}


def shards(shape_: dict[int, tuple[int, bytes]]) -> tuple[dict[int, tuple[int, int]], int]:
    """First block and number of blocks for each word length, and all blocks."""
    out, at = {}, 0
    for size, (n, _) in shape_.items():
        out[size] = (at, -(-n * BITS // BLOCK))
        at += out[size][1]
    return out, at


def filter_piece(vocabulary: DataFrame, shard: dict[int, tuple[int, int]], low: int, high: int) -> np.ndarray:
    """The blocks ``low`` to ``high`` of the filter, as bytes."""
    def hashed(batches):
        for b in batches:
            for n, _, letters in by_length(b.column(0).to_pylist()):
                h = spread(share(np.arange(n), letters).sum(1, dtype="uint64"), n)
                block = block_of(h, shard[n])
                mine = (block >= low) & (block < high)
                block, h = block[mine] - low, h[mine]
                for k in range(PROBES):
                    at = block * BLOCK + bit_in_block(h, k)
                    yield pa.RecordBatch.from_arrays([pa.array(at // (BLOCK * ROW_BLOCKS)), pa.array(at)], ["row", "at"])

    def packed(batches):
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            row, at = b.column(0).to_numpy(), b.column(1).to_numpy()
            for r in np.unique(row).tolist():
                rows.setdefault(r, np.zeros(BLOCK * ROW_BLOCKS, bool))[at[row == r] - r * BLOCK * ROW_BLOCKS] = True
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array([np.packbits(x).tobytes() for x in rows.values()], pa.binary())], ["row", "bits"])

    parts = vocabulary.select("word").mapInArrow(hashed, "row long, at long").repartition("row").mapInArrow(packed, "row long, bits binary")
    width = BLOCK * ROW_BLOCKS // 8
    out = np.zeros(-(-(high - low) // ROW_BLOCKS) * width, "uint8")
    for r in parts.collect():  # at most FILTER_BYTES in all
        out[r.row * width : (r.row + 1) * width] = np.frombuffer(r.bits, "uint8")
    return out


def held(hashes: np.ndarray, shard: tuple[int, int], bits: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places of the hashes that a piece of the filter may hold."""
    block = block_of(hashes, shard)
    at = np.flatnonzero((block >= low) & (block < high))
    for k in range(PROBES):
        x = (block[at] - low) * BLOCK + bit_in_block(hashes[at], k)
        at = at[(bits[x >> 3] >> (7 - (x & 7)).astype("uint8")) & 1 == 1]
    return at


def edits(letters: np.ndarray, shape_: dict, probe) -> list[tuple[int, bytes]]:
    """(word, edit) of the edits that ``probe(hashes, length)`` lets through;
    ``letters`` has words of one length as rows."""
    n, size = letters.shape
    shares = share(np.arange(size), letters)
    total = shares.sum(1, dtype="uint64")
    out = []
    if size - 1 in shape_:
        before = np.cumsum(shares, axis=1, dtype="uint64") - shares
        moved = np.zeros_like(shares)
        moved[:, 1:] = share(np.arange(size - 1), letters[:, 1:])  # each letter one place earlier
        behind = moved.sum(1, dtype="uint64")[:, None] - np.cumsum(moved, axis=1, dtype="uint64")
        once = np.ones(letters.shape, bool)
        once[:, 1:] = letters[:, 1:] != letters[:, :-1]  # of equal neighbours the first goes
        w, i = np.nonzero(once)
        for k in probe(spread((before + behind)[w, i], size - 1), size - 1).tolist():
            word = letters[w[k]].tobytes()
            out.append((int(w[k]), word[: i[k]] + word[i[k] + 1 :]))
    if shape_[size][0] > 1:
        for x in shape_[size][1]:
            w, i = np.nonzero(letters < x)
            hashes = spread(total[w] - shares[w, i] + share(i, np.uint64(x)), size)
            for k in probe(hashes, size).tolist():
                word = letters[w[k]].tobytes()
                out.append((int(w[k]), word[: i[k]] + bytes([x]) + word[i[k] + 1 :]))
    return out


def candidates(vocabulary: DataFrame, shape_: dict, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, edit): edits of all words that the filter may hold."""
    shard, blocks = shards(shape_)
    step = max(1, filter_bytes * 8 // BLOCK)
    rows, sc = None, vocabulary.sparkSession.sparkContext
    for low in range(0, blocks, step):
        high = min(blocks, low + step)
        shared = sc.broadcast(filter_piece(vocabulary, shard, low, high))

        def probe_all(batches, low=low, high=high, shared=shared):
            probe = lambda h, n: held(h, shard[n], shared.value, low, high)
            for b in batches:
                for n, at, letters in by_length(b.column(0).to_pylist()):
                    step = max(1, EDITS // n)
                    for s in range(0, len(at), step):
                        found = edits(letters[s : s + step], shape_, probe)
                        if found:
                            own = b.take(pa.array(at[s : s + step][[w for w, _ in found]]))
                            yield pa.RecordBatch.from_arrays([*own.columns, pa.array([e.decode("latin-1") for _, e in found])], ["word", "n", "edit"])

        # written, so that a piece need not be kept while the next is probed
        piece = stored(vocabulary.select("word", "n").mapInArrow(probe_all, "word string, n long, edit string"), "spelling-edits")
        shared.unpersist()
        rows = piece if rows is None else rows.unionByName(piece)
    return rows


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame | None:
    """(word, n, near, near_n), both ways; None where there are no words."""
    shape_ = shape(vocabulary)
    if not shape_:
        return None
    met = candidates(vocabulary, shape_, filter_bytes).join(vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    side = lambda a, an, b, bn: F.struct(F.col(a).alias("word"), F.col(an).alias("n"), F.col(b).alias("near"), F.col(bn).alias("near_n"))
    return met.select(F.explode(F.array(side("word", "n", "edit", "edit_n"), side("edit", "edit_n", "word", "n"))).alias("x")).select("x.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's forms. ``forms``: (word, form) of
    words that have one; each is more frequent than its word, so there is no
    cycle, and pointers double their reach in each round."""
    state = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = stored(state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, fold: int = FOLD,
             filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    NULL and empty texts have no words; a NULL id counts as empty text in the
    CRC-32. Repeated rows all count. Texts and words may have any length. Of near
    words that are equally frequent the first in code-point order is the form.
    Other columns are not read; an empty table gives an empty result.
    """
    vocabulary = stored(word_counts(docs, id_col, text_col, least, fold).where(F.col("n") >= count), "spelling-words")
    near = near_words(vocabulary, filter_bytes)
    if near is None:
        return vocabulary.select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"))
    best = near.groupBy("word").agg(F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best"), F.count(F.lit(1)).alias("n_near"))
    is_form = -F.col("best.rank") >= ratio * F.col("n")
    judged = stored(vocabulary.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, -F.col("best.rank")).alias("form_n")), "spelling-forms")
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH RECURSIVE
     crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, bit: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS t),
     runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
     counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
     hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
                    flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c) - 64] END))),
                    lambda x, byte: xor(x >> 8, t[(xor(x, byte) & 255) + 1])), 4294967295::BIGINT) AS h FROM counted, crc),
     words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
               FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
     cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
     gaps AS (SELECT word, n, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS gap FROM cut),
     shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS part FROM cut),
     pairs AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word
               UNION ALL SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.part = b.word
               UNION ALL SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.part = b.word),
     best AS (SELECT word, count(*) AS n_near, min({'rank': -near_n, 'near': near}) AS b FROM pairs GROUP BY word),
     forms AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.rank >= 5 * words.n THEN b.near END AS form, CASE WHEN -b.rank >= 5 * words.n THEN -b.rank END AS form_n
               FROM words LEFT JOIN best ON best.word = words.word),
     chain AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
