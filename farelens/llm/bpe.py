"""Byte-pair encoding and decoding with a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens whose paths
are exactly the token sequences that the merges produce. It starts as one state
with a loop for every byte. Each merge (u, v), in order, applies one gadget:

* the state that u leads to is copied without its v arc, and u now leads to the
  copy, so u can no longer be followed by v;
* every state with a u arc gets a uv arc, which leads where v led.

All arcs with one label lead to one state, so a state is stored as its parent,
the arc taken away and the merge that made it; a later arc exists where its left
part does. A text is pre-split, and each word is run through the table: a
prefix table gives the tokens that start at a byte position, the position's state
tells which of them it has an arc for, and the longest is tried first. One path
spells the word. Decoding emits the arc labels.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The byte-level pre-split pattern (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same rule spelled out for texts of these letters and ASCII only.
PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ˁ"
PLAIN_SPLIT = (rf" ?[{PLAIN_LETTERS}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\t-\r 0-9{PLAIN_LETTERS}]+"
               r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: No further bytes in the prefix table.
NO_STEPS: dict = {}
#: Words kept with their tokens in one worker, twice at most: beyond it a new
#: generation starts and the one before the last goes.
CACHED_WORDS = 100_000
#: Arcs known to be there or not; beyond it the memory is started anew.
CACHED_ARCS = 250_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte: itself if visible, else 256 and up."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


def compile_automaton(spec: dict) -> dict:
    """Plain tables of the automaton for a tokenizer file's content."""
    model, alphabet = spec["model"], byte_alphabet()
    vocab = model["vocab"]
    for a in spec.get("added_tokens") or []:
        if a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]:
            raise ValueError(f"unsupported added token {a['content']!r}")
    specials = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
    size = max([*vocab.values(), *specials.values()]) + 1
    left, made, alive, leads = [-1] * size, [-1] * size, [False] * size, [0] * size
    for c in alphabet:
        alive[vocab[c]] = True
    parent, gone, born = [-1], [-1], [-1]
    tables = {"left": left, "made": made, "alive": alive, "leads": leads, "parent": parent, "gone": gone, "born": born}
    for k, merge in enumerate(model["merges"]):
        u, v = (vocab[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
        uv = vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)]
        if made[uv] >= 0:
            raise ValueError("two merges make one token")
        made[uv], left[uv] = k, u
        before = leads[u]
        if not (alive[u] and has_arc(tables, before, v)):
            continue  # u and v never meet
        alive[uv], leads[uv] = True, leads[v]
        parent.append(before), gone.append(v), born.append(k)
        leads[u] = len(parent) - 1
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = bytes(alphabet[c] for c in token)
    known = {label: i for i, label in enumerate(labels) if alive[i]}
    prefixes = {label[:k] for label in known for k in range(1, len(label))}
    shorter = [-1] * size
    for label, i in known.items():
        shorter[i] = next((known[label[:k]] for k in range(len(label) - 1, 0, -1) if label[:k] in known), -1)
    steps: dict = {}  # byte -> (token that ends here or -1, the next bytes)
    for label in sorted(known.keys() | prefixes):
        node = steps
        for b in label[:-1]:
            node = node[b][1]
        node[label[-1]] = (known.get(label, -1), {} if label in prefixes else NO_STEPS)
    for content, i in specials.items():
        labels[i] = content.encode()
    place, without = copy_intervals(parent, gone)
    return {"left": left, "made": made, "leads": leads, "born": born, "place": place, "without": without, "labels": labels, "steps": steps, "shorter": shorter, "specials": specials}


def has_arc(t: dict, state: int, token: int) -> bool:
    """Whether ``state`` has an arc labelled ``token``, while the automaton is built."""
    left, made, parent, gone, born = t["left"], t["made"], t["parent"], t["gone"], t["born"]
    if not t["alive"][token]:
        return False
    while state:
        if made[token] >= born[state]:
            token = left[token]
        elif gone[state] == token:
            return False
        else:
            state = parent[state]
    return True


def copy_intervals(parent: list[int], gone: list[int]) -> tuple[list[int], dict]:
    """For the finished automaton: the place of each state in a walk of the
    copy tree and, by token, the copies without its arc as intervals of that
    walk (first place, last place, state), in order. Along one line of copies
    an arc is taken away once, so the intervals of a token don't overlap."""
    below = [1] * len(parent)
    for s in range(len(parent) - 1, 0, -1):
        below[parent[s]] += below[s]
    place, free = [0] * len(parent), [1] * len(parent)
    for s in range(1, len(parent)):
        p = parent[s]
        place[s] = place[p] + free[p]
        free[p] += below[s]
    without: dict[int, list] = {}
    for s in range(1, len(parent)):
        without.setdefault(gone[s], []).append((place[s], place[s] + below[s] - 1, s))
    return place, {v: tuple(zip(*sorted(x))) for v, x in without.items()}


def arc(t: dict, state: int, token: int) -> bool:
    """``has_arc`` on the finished automaton, by one search for each left part."""
    left, made, born, without, at = t["left"], t["made"], t["born"], t["without"], t["place"][state]
    until = len(made)
    while token >= 0:
        if token in without:
            first, last, states = without[token]
            k = bisect_right(first, at) - 1
            if k >= 0 and last[k] >= at and made[token] < born[states[k]] <= until:
                return False
        until, token = made[token], left[token]
    return True


def encode_word(t: dict, word: bytes) -> list[int]:
    """The one path of the automaton that spells ``word``: longest arcs first,
    going back from positions that turn out to lead nowhere. A position can be
    reached by one path only, so what was found dead stays dead."""
    steps, leads, labels, shorter, seen = t["steps"], t["leads"], t["labels"], t["shorter"], t.setdefault("arcs", {})
    n, i, state = len(word), 0, 0
    path: list[int] = []
    came: list[tuple[int, int]] = []
    dead = set()
    token = -2  # to be looked up
    while i < n:
        if token == -2:
            node = steps
            for b in word[i:] if n - i <= 32 else map(word.__getitem__, range(i, n)):
                found = node.get(b)
                if found is None:
                    break
                end, node = found
                if end >= 0:
                    token = end
        while token >= 0:
            if not dead or i + len(labels[token]) not in dead:
                key = state << 20 | token
                ok = seen.get(key)
                if ok is None:
                    if len(seen) >= CACHED_ARCS:
                        seen.clear()
                    ok = seen[key] = arc(t, state, token)
                if ok:
                    break
            token = shorter[token]
        if token >= 0:
            path.append(token)
            came.append((i, state))
            i, state, token = i + len(labels[token]), leads[token], -2
        else:
            dead.add(i)
            token = shorter[path.pop()]
            i, state = came.pop()
    return path


class _Words(dict):
    """Little-endian ids of each pre-split word, filled by the automaton. The
    words of the last generation are kept beside those of this one."""

    def __init__(self, t):
        self.t, self.last = t, {}

    def __missing__(self, word):
        packed = self.last.get(word)
        if packed is None:
            ids = encode_word(self.t, word.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.last = dict(self)
                self.clear()
            self[word] = packed
        return packed


class Codec:
    """Encoder and decoder over compiled tables."""

    def __init__(self, tables: dict):
        import regex

        self.t = tables
        self.full = regex.compile(SPLIT).findall
        self.plain = re.compile(PLAIN_SPLIT).findall
        self.odd = re.compile(rf"[^\x00-\x7f{PLAIN_LETTERS}]").search
        self.words = _Words(tables)
        self.specials = tables["specials"]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None

    def find(self, text: str) -> list[str]:
        return self.full(text) if self.odd(text) else self.plain(text)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(s in text for s in self.specials):
            return b"".join(map(self.words.__getitem__, self.find(text)))
        return b"".join(self.specials[part].to_bytes(4, "little") if part in self.specials
                        else b"".join(map(self.words.__getitem__, self.find(part))) for part in self.cut.split(text))

    def decode(self, ids: bytes) -> str:
        import numpy as np

        return b"".join(map(self.t["labels"].__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def load_automaton(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return compile_automaton(json.load(f))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _codec(shared) -> Codec:
    tables = shared.value  # kept by the worker from task to task, and the words with it
    if "codec" not in tables:
        # Over a copy: a codec that held the tables that hold it would outlive its broadcast.
        tables["codec"] = Codec(dict(tables))
    return tables["codec"]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Token ids and the decoded text of every row: doc_id, ids (array<int>),
    decoded. NULL text counts as empty and has no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(load_automaton(path or default_path()))

    def run(batches):
        import numpy as np

        codec = _codec(shared)
        for b in batches:
            ids = [codec.encode(x or "") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([np.frombuffer(x, "<u4").astype("int32") for x in ids], pa.list_(pa.int32())),
                 pa.array([codec.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    NULL and empty texts have no tokens (digests of nothing). Repeated rows each
    give a row, a NULL id stays NULL, other columns are not read, an empty table
    gives an empty result, and a text of any length is encoded whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_automaton(path or default_path()))

    def run(batches):
        codec = _codec(shared)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for x in b.column(1):
                ids = codec.encode(x.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return digest(table(spark, sf_dir, "documents"))
