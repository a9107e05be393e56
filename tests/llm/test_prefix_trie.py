import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from farelens.llm import prefix_trie
from farelens.llm.scans import running
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("conv", "depth", "arc", "a", "h1", "nth", "place", "a b: c")]])


def conversations(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], SCHEMA).repartition(partitions)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * n + sum(saved[k] for k in children[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def same(got, rows):
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def made(seed, n, few):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(rng.randint(1, 7)):
            rows.append((c, k, rng.choice(["user", "assistant"]), " ".join(rng.choices(few, k=rng.randint(0, 2)))))
    return rows


@pytest.mark.parametrize("block", [7, prefix_trie.BLOCK_ARCS])
def test_against_brute_force(spark, block):
    rows = made(1, 130, ["a", "b"]) + [(200, k, "user", "long " * 3000) for k in range(3)]
    got = prefix_trie.trie(conversations(spark, rows), block=block)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    same(got, rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (40, None, "user", "first"), (40, 1, None, "b"), (40, 1, "", "b"), (40, 1, "user", None), (40, 2, "user", "c c\tc\x0bc\xa0c"),
            (41, 5, "user", "x"), (43, 1, "user", "y"), (-7, 1, "user", "z"), (-7, 1, "user", "z"), (-20, 1, "user", "z"), (39, 1, "user", "only")]
    rows += [(60 + k, t, "user", "same") for k in range(20) for t in range(6)]
    same(prefix_trie.trie(conversations(spark, rows)), rows)
    assert prefix_trie.trie(conversations(spark, [])).count() == 0
    assert prefix_trie.trie(conversations(spark, [(None, 1, "user", "x")])).count() == 0


def test_one_conversation_over_many_tasks(spark):
    rows = [(100, k, "user", f"turn {k % 5}") for k in range(3000)] + [(101, k, "user", f"turn {k % 5}") for k in range(40)] + [(102, 0, "user", "x")]
    same(prefix_trie.trie(conversations(spark, rows, 8), block=64), rows)


def test_running_sums_over_partitions(spark):
    rng = random.Random(3)
    rows = [(0 if k % 3 else k % 7, k, rng.randint(-(2**62), 2**62)) for k in range(2000)]
    df = spark.createDataFrame(rows, "g long, o long, x long").repartition(5)
    got = {r.o: r for r in running(df, ["g"], ["o"], ["x"], "t").collect()}
    nth, total = defaultdict(int), defaultdict(int)
    wrap = lambda x: (x + 2**63) % 2**64 - 2**63
    for g, o, x in sorted(rows):
        nth[g] += 1
        assert got[o].nth == nth[g] and got[o].pre_x == wrap(total[g])
        total[g] += x
        assert got[o].sum_x == wrap(total[g])
    assert running(df.where("g > 99"), ["g"], ["o"], ["x"], "t").count() == 0


def test_pieces_of_a_list():
    rng = np.random.default_rng(0)
    order = rng.permutation(300)  # a list through 300 arcs of 30 names
    conv, arc = order // 10, order % 10
    after = np.append(order[1:], 0)
    some = np.arange(300) < 299
    sort = np.lexsort((arc, conv))[:200]
    cut = sort[np.lexsort((arc[sort], conv[sort]))]
    head, off, size, last = prefix_trie.pieces(conv[cut], arc[cut], after[cut] // 10, after[cut] % 10, some[cut])
    at = {int(order[c]): i for i, c in enumerate(cut)}
    for i, c in enumerate(cut):
        k = 0
        while c - k - 1 >= 0 and int(order[c - k - 1]) in at:
            k += 1
        assert off[i] == k and head[i] == at[int(order[c - k])]
        assert cut[last[i]] == c - k + size[i] - 1


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = db.execute(prefix_trie.OP12_SQL).df()
    order = lambda d: d[sorted(d.columns)].sort_values(["conv_id", "depth"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(prefix_trie.op12_prefix_trie(spark, folder).toPandas()), order(want), check_dtype=False)
    same(prefix_trie.op12_prefix_trie(spark, folder), list(db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()))
