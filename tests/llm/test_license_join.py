import math
import random
import re

from farelens.llm import license_join

from .helpers import as_dicts, documents
from .test_suffix_match import split


def brute_blocks(text):
    for line in (text or "").split("\n"):
        w = split(line)
        for a in range(0, max(1, len(w) - license_join.BLOCK_WORDS + license_join.BLOCK_STEP), license_join.BLOCK_STEP):
            yield w[a : a + license_join.BLOCK_WORDS]


def brute(text):
    w, places, base = split(text), [], set()
    for phrase, label in license_join.PHRASES.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                places.append(k), base.add(label)
    labels, best = set(base), 0.0
    for block in brute_blocks(text):
        for label, t in license_join.TEMPLATES:
            t = set(t.split())
            n = len(t & set(block))
            if n >= math.ceil(license_join.THRESHOLD * len(t) - 1e-9):
                labels.add(label)
                best = max(best, n / len(t))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else best)


def test_same_as_brute_force(spark):
    rng = random.Random(1)
    vocab = sorted({w for _, t in license_join.TEMPLATES for w in t.split()}) + ["foo", "Été", "x1"]
    docs = [(k, " ".join(rng.choices(vocab, k=rng.randint(0, 90)))) for k in range(60)]
    for k in range(60, 160):
        words = rng.choice(license_join.TEMPLATES)[1].split()
        words = [w for w in words if rng.random() > 0.06]
        rng.random() < 0.5 and rng.shuffle(words)
        filler = " ".join(rng.choices(["foo", "bar", "the", "of"], k=rng.randint(0, 80)))
        docs.append((k, f"{filler}{rng.choice([' ', chr(10)])}{' '.join(words).title()}, {filler}"))
    docs += [(200, None), (201, ""), (202, "MIT License, mit-license\nApache\nLicense GNU General Public License"), (202, "x"), (None, "Released under the MIT License."),
             (203, "Licensed under CC BY-NC 4.0."), (204, "mit mit license license " * 9000), (205, "mit")]
    got = license_join.scanned(documents(spark, docs, clash=True)).collect()
    rows = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in got), key=str)
    want = sorted(((i, *(x if not isinstance(x, float) else round(x, 9) for x in brute(t))) for i, t in docs), key=str)
    assert rows == want
    assert len({r[6] for r in want}) > 5


def test_one_line_notices(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "Licensed under CC BY-NC 4.0."), (3, "mit the of"), (4, "Licensed under the Apache License, Version 2.0.")]
    got = as_dicts(license_join.scanned(documents(spark, rows)))
    assert [got[k]["labels"] for k in range(1, 5)] == ["gpl", "cc-by-nc", "", "apache"]
    assert [got[k]["score"] for k in range(1, 5)] == [1.0, 1.0, 0.0, 1.0]


def test_order_of_words_does_not_change_the_result():
    for counts in ({}, {w: len(w) for w in license_join.vocabulary(license_join.TEMPLATES)}):
        t = license_join.compile_templates(license_join.TEMPLATES, counts, 0.85)
        ids = lambda text: sorted({t["ids"][w.encode()] for w in re.findall(r"\w+", text) if w.encode() in t["ids"]})
        assert [(t["labels"][k], n) for k, n in license_join.join_block(ids("it is released under the mit license"), t)] == [("mit", 5)]


def test_empty_table(spark):
    assert license_join.scanned(documents(spark, [])).count() == 0


def test_wrapped_notices(spark):
    mit = ["Permission is hereby granted, free of charge, to any person obtaining a copy", 'of this software and associated documentation files (the "Software"), to deal']
    bsd = ["# Redistribution and use in source and binary forms, with or without", "# modification, are permitted provided that the following conditions", "# are met:"]
    mpl = ["This Source Code Form is subject to", "the terms of the Mozilla", "Public License, v. 2.0."]
    rows = [(1, "\n".join(mit)), (2, "\r\n".join(["foo bar"] * 40 + bsd + ["foo"] * 90)), (3, "x " * 75 + "\n\n" + "\n".join(mpl) + " y" * 75), (4, "\n".join(mit[:1] + ["foo " * 70] + mit[1:]))]
    rows += [(10 + k, "foo\n" * k + "\n".join(mit + ["bar"] * 100)) for k in range(64)]
    got = as_dicts(license_join.scanned(documents(spark, rows)))
    assert [got[k]["labels"] for k in (1, 2, 3, 4)] == ["mit", "bsd", "mpl", ""]
    assert [got[k]["score"] for k in (1, 2, 3, 4)] == [1.0, 1.0, 1.0, 0.0]
    assert {got[10 + k]["labels"] for k in range(64)} == {"mit"}


def test_wrapped_template_longer_than_a_block(spark):
    long = [f"w{k}" for k in range(90)]
    rows = [(k, "x " * k + "\n".join(" ".join(long[i : i + 10]) for i in range(0, 90, 10)) + "\nfoo" * 50) for k in range(0, 200, 13)]
    got = license_join.scanned(documents(spark, rows), templates=[("long", " ".join(long))]).collect()
    assert {(r.labels, r.score) for r in got} == {("long", 1.0)}


def test_templates_of_every_length_at_every_offset():
    """On one long line, and wrapped, a template lies whole in some block."""
    sizes = (10, 31, 32, 33, 47, 48, 56, 64, 65, 96, 128)
    templates = [(f"t{n}", " ".join(f"q{n}x{k}" for k in range(n))) for n in sizes]
    t = license_join.compile_templates(templates, {}, 0.95)
    t |= {"all": t["ids"], "most": len(t["ids"])}
    prefix = [license_join.np.isin(license_join.np.arange(t["most"] + 1), list(index)) for _, index in t["classes"]]
    for label, body in templates:
        for offset in range(140):
            for gap in (" ", "\n"):
                text = "foo " * offset + body.replace(" ", gap) + " bar" * 150
                found = license_join.scan(text.encode(), t, [], prefix)[5]
                assert max((f["containment"] for f in found if f["label"] == label), default=0) == 1.0, (label, offset, gap)
