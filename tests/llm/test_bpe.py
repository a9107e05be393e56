import gc
import hashlib
import random
import weakref
from types import SimpleNamespace

import numpy as np
import public_tokenizers
from farelens.llm import bpe
from tokenizers import Tokenizer

from .helpers import as_dicts, documents

PIECES = [*"aaabcdeth  \n\t'´sSéßñ中文😀́!!!$$#0129०１‍\x00\x1c\x85", " ", "<|endoftext|>", "'s", "'LL", " the", "ing", "''", "ⅷ"]


def theirs():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_automaton_spells_what_the_library_does():
    codec, library, rng = bpe.Codec(bpe.load_automaton(bpe.default_path())), theirs(), random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 3000 + "x", "'" * 999, "ab" * 2000, "\n" * 500]
    for text in texts:
        ids, want = codec.encode(text), library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_small_merges_leftmost_and_in_order():
    alphabet = {c: i for i, c in enumerate(bpe.byte_alphabet())}
    merges = [["a", "a"], ["a", "b"], ["aa", "ab"], ["b", "c"]]
    vocab = alphabet | {"".join(m): 256 + i for i, m in enumerate(merges)}
    t = bpe.compile_automaton({"model": {"vocab": vocab, "merges": merges}})
    spell = lambda w: [t["labels"][i].decode() for i in bpe.encode_word(t, w.encode())]
    assert spell("aaa") == ["aa", "a"] and spell("aab") == ["aa", "b"] and spell("aaab") == ["aaab"]
    assert spell("abc") == ["ab", "c"] and spell("bbc") == ["b", "bc"] and spell("aaaab") == ["aa", "aa", "b"]


def test_rows(spark):
    rows = [(1, "the thing's 12 <|endoftext|>"), (2, None), (3, ""), (3, ""), (None, "é😀"), (4, "lorem ipsum " * 20_000)]
    got = bpe.digest(documents(spark, rows, clash=True)).collect()
    library = theirs()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    whole = as_dicts(bpe.encode(documents(spark, rows[:2])))
    assert whole[1]["ids"] == library.encode(rows[0][1], add_special_tokens=False).ids and whole[1]["decoded"] == rows[0][1]
    assert whole[2]["ids"] == [] and bpe.digest(documents(spark, [])).count() == 0


def test_tables_go_with_their_broadcast():
    shared = SimpleNamespace(value=bpe.load_automaton(bpe.default_path()))
    codec = bpe._codec(shared)
    assert bpe._codec(shared) is codec and codec.encode("the thing")
    kept = weakref.ref(codec)
    gc.disable()
    try:
        del codec, shared
        assert kept() is None
    finally:
        gc.enable()


def test_words_and_arcs_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    monkeypatch.setattr(bpe, "CACHED_ARCS", 20)
    codec, library = bpe.Codec(bpe.load_automaton(bpe.default_path())), theirs()
    for i in range(400):
        text = f"word{i} {i * 37}abc thing's"
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(codec.words) <= 50 and len(codec.words.last) <= 50 and len(codec.t["arcs"]) <= 20
