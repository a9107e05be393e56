"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns; it is known by the running hash of
its turns, and named by its smallest member and its depth, which no other node
shares.

1. Turns get their places, and the hashes of all prefixes, as running sums over
   a sorted table (``scans.running``): no conversation has to fit in a task.
2. Nodes are groups of equal prefixes. Children, ordered by their names, get
   their place among their siblings the same way, as one node may have most of
   all nodes as children.
3. Every node gives an enter arc and an exit arc, each with its successor in the
   tour: the first child, the next sibling or the parent's exit.
4. The tour is list-ranked. Arcs sorted by name mostly have their successor
   beside them, so each task first contracts the lists inside blocks of at most
   BLOCK_ARCS arcs; what is left, one element for each piece, is ranked by
   pointer jumping, a join for each doubling.
5. Leaves and savings are running sums over the tour; a subtree's is the sum at
   its exit less that before its enter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .scans import column, group_starts, running

#: Conversations take their first turns from the one at the start of their STEP
#: ids, at most MOST turns.
STEP, MOST = 20, 3
BLOCK_ARCS = 1 << 20
NOTHING = hashlib.sha256(b"").hexdigest()
HASH = ("h1", "h2")


def digests(role, text):
    """Two 60-bit numbers of a turn, from the SHA-256 of role and text."""
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return [F.conv(F.substring(sha, at, 15), 16, 10).cast("long") for at in (1, 16)]


def turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, a, b, words) of every turn, a and b being digests."""
    clean = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                                 *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    a, b = digests(F.col("role"), F.col("text"))
    return clean.where("conv IS NOT NULL").select("conv", "turn", a.alias("a"), b.alias("b"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def taken(conv):
    """How many first turns a conversation takes from another."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(MOST + 1))


def rebuilt(turn_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv) of all conversations, and (conv, depth, a, b, words) of their
    turns after the first ones have been taken from another."""
    placed = stored(running(turn_rows, ["conv"], ["turn", "a", "b"], [], "trie-turns").drop("turn"), "trie-placed")
    convs = placed.where("nth = 1").select("conv", taken(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % STEP).alias("base"))
    heads = placed.where((F.col("conv") % STEP == 0) & (F.col("nth") <= MOST)).select(F.col("conv").alias("base"), F.col("nth").alias("depth"), "a", "b", "words")
    lent = convs.join(heads, "base").where("depth <= h").select("conv", "depth", "a", "b", "words")  # at most STEP x MOST rows for each base
    n_lent = lent.groupBy("conv").agg(F.count(F.lit(1)).alias("lent"))
    own = placed.where(F.col("nth") > taken(F.col("conv"))).join(n_lent, "conv", "left")
    own = own.select("conv", (F.col("nth") - taken(F.col("conv")) + F.coalesce("lent", F.lit(0))).alias("depth"), "a", "b", "words")
    return convs.select("conv"), lent.unionByName(own)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, words, h1, h2, p1, p2): the hash of each prefix and of the one before it."""
    hashed = rows.select("conv", "depth", "words", F.xxhash64("a", "b", "depth").alias("x1"), F.xxhash64("depth", "b", "a", F.lit(1)).alias("x2"))
    run = running(hashed, ["conv"], ["depth"], ["x1", "x2"], "trie-prefixes")
    return run.select("conv", "depth", "words", *[F.col(f"{w}_x{i}").alias(f"{n}{i}") for w, n in (("sum", "h"), ("pre", "p")) for i in (1, 2)])


def tree(convs: DataFrame, prefix_rows: DataFrame) -> DataFrame:
    """All nodes: conv, depth, h1, h2, n_convs, words, n_children, first_child,
    parent, next (the conv of first child, parent and next sibling)."""
    inner = prefix_rows.groupBy("depth", *HASH).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("conv IS NOT NULL")
    root = root.select(zero.alias("depth"), *[zero.alias(h) for h in HASH], "conv", "n_convs", zero.alias("words"), zero.alias("p1"), zero.alias("p2"))
    nodes = stored(inner.unionByName(root), "trie-nodes")
    family = ["depth", "p1", "p2"]
    kids = stored(running(nodes.where("depth > 0").select("conv", *family, *HASH), family, ["conv"], [], "trie-siblings"), "trie-kids")
    later = kids.select(*family, (F.col("nth") - 1).alias("nth"), F.col("conv").alias("next"))
    families = kids.groupBy(*family).agg(F.min("conv").alias("first_child"), F.count(F.lit(1)).alias("n_children"))
    families = families.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"), "first_child", "n_children")
    named = nodes.select(F.col("conv").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"))
    around = kids.join(later, [*family, "nth"], "left").join(named, family).select("depth", *HASH, "next", "parent")
    whole = nodes.select("conv", "depth", *HASH, "n_convs", "words").join(families, ["depth", *HASH], "left").join(around, ["depth", *HASH], "left")
    return stored(whole.withColumn("n_children", F.coalesce("n_children", zero)), "trie-tree")


def arcs(nodes: DataFrame) -> DataFrame:
    """(conv, arc, next_conv, next_arc, leaf, saved): 2 * depth is the enter arc
    of a node, 2 * depth + 1 its exit. The last exit has no successor."""
    depth, childless = F.col("depth"), F.col("n_children") == 0
    arc = lambda arc, conv, after, leaf, saved: F.struct(arc.alias("arc"), conv.alias("next_conv"), after.alias("next_arc"), leaf.alias("leaf"), saved.alias("saved"))
    none = F.lit(0).cast("long")
    enter = arc(2 * depth, F.when(childless, F.col("conv")).otherwise(F.col("first_child")), F.when(childless, 2 * depth + 1).otherwise(2 * depth + 2),
                childless.cast("long"), (F.col("n_convs") - 1) * F.col("words"))
    sibling = F.col("next").isNotNull()
    leave = arc(2 * depth + 1, F.when(sibling, F.col("next")).otherwise(F.col("parent")), F.when(sibling, 2 * depth).when(depth > 0, 2 * depth - 1), none, none)
    return nodes.select("conv", F.explode(F.array(enter, leave)).alias("x")).select("conv", "x.*")


def pieces(conv: np.ndarray, arc: np.ndarray, next_conv: np.ndarray, next_arc: np.ndarray, some: np.ndarray) -> tuple:
    """Lists inside a block of arcs, sorted by (conv, arc): for each arc the
    place of the first of its piece, how far behind that it is, the piece's
    length and the place of its last arc. ``some``: which have a successor."""
    n, span = len(conv), int(arc.max()) + 1
    names, at = np.unique(conv, return_inverse=True)
    key = at * span + arc
    to = np.minimum(np.searchsorted(names, next_conv), len(names) - 1)
    there = np.minimum(np.searchsorted(key, to * span + next_arc), n - 1)
    inside = some & (names[to] == next_conv) & (next_arc < span) & (key[there] == to * span + next_arc)
    last, ahead = np.where(inside, there, np.arange(n)), inside.astype("int64")
    while not np.array_equal(further := last[last], last):
        ahead, last = ahead + ahead[last], further
    first = np.ones(n, bool)
    first[there[inside]] = False
    of_last = np.zeros(n, "int64")
    of_last[last[first]] = np.flatnonzero(first)
    head = of_last[last]
    return head, ahead[head] - ahead, ahead[head] + 1, last


def contracted(arc_rows: DataFrame, block: int) -> DataFrame:
    """Arcs with their piece (head_conv, head_arc) and place in it (off); the
    first arc of a piece also has its size and the piece's successor."""
    def run(batches):
        gathered, n = [], 0

        def flush():
            nonlocal gathered, n
            t = pa.Table.from_batches(gathered).combine_chunks()
            gathered, n = [], 0
            get = lambda name: t.column(name).to_numpy()
            conv, arc = get("conv"), get("arc")
            some = ~np.asarray(t.column("next_conv").is_null())
            next_conv, next_arc = (np.asarray(t.column(c).fill_null(0)) for c in ("next_conv", "next_arc"))
            head, off, size, last = pieces(conv, arc, next_conv, next_arc, some)
            first = off == 0
            out = [conv, arc, get("leaf"), get("saved"), conv[head], arc[head], off]
            behind = [pa.array(x, mask=~keep) for x, keep in ((next_conv[last], first & some[last]), (next_arc[last], first & some[last]), (size, first))]
            return pa.RecordBatch.from_arrays([*map(pa.array, out), *behind], [x.split()[0] for x in schema.split(", ")])

        for b in batches:
            for s in range(0, b.num_rows, block):
                gathered.append(b.slice(s, block))
                n += gathered[-1].num_rows
                if n >= block:
                    yield flush()
        if n:
            yield flush()

    schema = "conv long, arc long, leaf long, saved long, head_conv long, head_arc long, off long, next_conv long, next_arc long, size long"
    sorted_ = arc_rows.repartitionByRange("conv", "arc").sortWithinPartitions("conv", "arc")
    return stored(sorted_.mapInArrow(run, schema), "trie-arcs")


def to_end(heads: DataFrame) -> DataFrame:
    """(conv, arc, left): arcs from the first of each piece to the end of the
    tour, by pointer jumping. ``heads``: conv, arc, next_conv, next_arc, left."""
    state = stored(heads, "trie-jump")
    while not (open_ := state.where("next_conv IS NOT NULL")).isEmpty():
        target = state.select(F.col("conv").alias("next_conv"), F.col("arc").alias("next_arc"), F.col("next_conv").alias("c2"), F.col("next_arc").alias("a2"), F.col("left").alias("l2"))
        moved = open_.join(target, ["next_conv", "next_arc"]).select("conv", "arc", F.col("c2").alias("next_conv"), F.col("a2").alias("next_arc"), (F.col("left") + F.col("l2")).alias("left"))
        state = stored(state.where("next_conv IS NULL").unionByName(moved), "trie-jump")
    return state.select("conv", "arc", "left")


def ranked(arc_rows: DataFrame, block: int = BLOCK_ARCS) -> DataFrame:
    """Arcs with ``place``, their place in the tour from 0."""
    each = contracted(arc_rows, block)
    left = to_end(each.where("off = 0").select("conv", "arc", "next_conv", "next_arc", F.col("size").alias("left")))
    left = left.select(F.col("conv").alias("head_conv"), F.col("arc").alias("head_arc"), "left")
    total = each.count()
    return each.join(left, ["head_conv", "head_arc"]).select("conv", "arc", "leaf", "saved", (F.lit(total) - F.col("left") + F.col("off")).alias("place"))


def subtrees(tour: DataFrame) -> DataFrame:
    """(conv, depth, n_leaves, saved_tokens) from running sums over the tour."""
    run = running(tour, [], ["place"], ["leaf", "saved"], "trie-tour")
    enter = F.col("arc") % 2 == 0
    at = lambda x: (F.max(F.when(~enter, F.col(f"sum_{x}"))) - F.max(F.when(enter, F.col(f"pre_{x}"))))
    return run.groupBy("conv", F.floor(F.col("arc") / 2).alias("depth")).agg(at("leaf").alias("n_leaves"), at("saved").alias("saved_tokens"))


def end_digests(convs: DataFrame, prefix_rows: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of the nodes where conversations end.

    A digest of a list has to be read in order, and one node may hold a third of
    all conversations. So ids are sorted and joined in many tasks, a chunk for
    each batch, and only chunks of text stream through the digest."""
    zero = F.lit(0).cast("long")
    last = convs.select("conv", zero.alias("depth"), *[zero.alias(h) for h in HASH]).unionByName(prefix_rows.select("conv", "depth", *HASH))
    last = last.groupBy("conv").agg(F.max(F.struct("depth", *HASH)).alias("at")).select("conv", "at.*")
    node = ["depth", *HASH]

    def chunk(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys, ids = [column(b, k) for k in node], column(b, "conv")
            new = group_starts(keys, b.num_rows)
            new[0] = True
            begin = np.flatnonzero(new)
            parts = [",".join(map(str, p.tolist())) for p in np.split(ids, begin[1:])]
            yield pa.RecordBatch.from_arrays([*[pa.array(k[begin]) for k in keys], pa.array(ids[begin]), pa.array(parts)], [*node, "conv", "ids"])

    def digest(batches):
        now, sha = None, None
        done: list[tuple] = []
        row = lambda: pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.int64()) for k in range(3)] + [pa.array([d[3] for d in done], pa.string())], [*node, "ends_sha256"])
        for b in batches:
            for *key, ids in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in [*node, "ids"]], strict=True):
                if key != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield row()
            done.clear()
        if now is not None:
            done.append((*now, sha.hexdigest()))
            yield row()

    chunks = last.repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv").mapInArrow(chunk, "depth long, h1 long, h2 long, conv long, ids string")
    return chunks.repartition(*node).sortWithinPartitions(*node, "conv").mapInArrow(digest, "depth long, h1 long, h2 long, ends_sha256 string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK_ARCS) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conversation id are left out. Turns come by their number,
    NULL first; equal numbers, and repeated rows, by a digest of role and text,
    and all count as turns. NULL role or text is empty. Texts and conversations
    may have any length. Other columns are not read; an empty table has no node,
    not even a root.
    """
    convs, rows = rebuilt(turns(conversations, conv_col, turn_col, role_col, text_col))
    prefix_rows = stored(prefixes(rows), "trie-hashed")
    nodes = tree(convs, prefix_rows)
    sums = subtrees(ranked(arcs(nodes), block))
    ends = end_digests(convs, prefix_rows)
    whole = nodes.join(sums, ["conv", "depth"]).join(ends, ["depth", *HASH], "left")
    return whole.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: The CRC-32 of ASCII digits, byte by byte and bit by bit.
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), "
        "lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, bit: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)")

OP12_SQL = rf"""
WITH t AS (SELECT conv_id AS c, sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS turn_key,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
           FROM conversations WHERE conv_id IS NOT NULL),
     ids AS (SELECT DISTINCT c FROM t),
     convs AS (SELECT c, {_CRC.format(id="c")} % 4 AS h, c - c % 20 AS base FROM ids),
     lent AS (SELECT convs.c, nth AS depth, turn_key, words FROM convs JOIN t ON t.c = base AND nth <= h),
     n_lent AS (SELECT c, count(*) AS k FROM lent GROUP BY c),
     rows_ AS (SELECT * FROM lent UNION ALL
               SELECT t.c, nth - h + coalesce(k, 0), turn_key, words FROM t JOIN convs USING (c) LEFT JOIN n_lent USING (c) WHERE nth > h),
     chain AS (SELECT c, depth, words, sha256(string_agg(turn_key, '') OVER (PARTITION BY c ORDER BY depth)) AS node,
                      sha256(string_agg(turn_key, '') OVER (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS above FROM rows_
               UNION ALL SELECT c, 0, 0, 'root', NULL FROM convs),
     nodes AS (SELECT node, min(c) AS conv_id, min(depth) AS depth, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved, min(CASE WHEN depth = 1 THEN 'root' ELSE above END) AS above FROM chain GROUP BY node),
     kids AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY 1),
     below AS (SELECT chain.node, sum(nodes.saved) AS saved_tokens, count(*) FILTER (WHERE kids.n_children IS NULL) AS n_leaves
               FROM nodes JOIN chain ON chain.c = nodes.conv_id AND chain.depth <= nodes.depth LEFT JOIN kids ON kids.node = nodes.node GROUP BY chain.node),
     ends AS (SELECT node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
              FROM chain JOIN (SELECT c, max(depth) AS depth FROM chain GROUP BY c) USING (c, depth) GROUP BY node)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node) LEFT JOIN nodes AS up ON up.node = nodes.above
"""
