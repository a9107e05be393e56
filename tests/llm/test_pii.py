import hashlib
import random
import re

import pytest
from farelens.llm import pii
from pyspark.sql import functions as F

from .helpers import as_dicts, documents, sha

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes_luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and passes_luhn(digits(m))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


PIECES = ["a.b@c.de", "x@y", "@", "joe%1+2@ex-1.co.uk_z@q.r.s", "1.2.3.4", "256.1.1.1", "0000255.01.2.3", "1.2.3.4.5.6.7.8", "99999999999999999999.1.1.1", "4111 1111 1111 1111",
          "4111-1111-1111-1112", "4111111111111111", "5 5 5", "+1 (415) 555-2671", "+49 30 1234567", "+1(", "+12", "+1-----9", "+123456789012345678", "000000000000", "0" * 40, " ", ".", "-", "é😀", "\n",
          "call me", "(017) 555-7713", "123-45-6789", 'token = "04dbebab91ab85687d33ee"', "DE89370400440532013000", "joe (at) mail (dot) com", "order no ", "card ", "7", "12", "+", "+7+8 999 111 22 33"]


def test_base_spans_are_those_of_the_patterns(spark):
    rng = random.Random(11)
    rows = [(k, "".join(rng.choices(PIECES, k=rng.randint(0, 14)))) for k in range(900)]
    rows += [(1000, None), (1001, ""), (1002, "1.2.3.4 " * 2000), (1002, "x"), (None, "a@b.cd"), (1003, "9" * 30_000), (1004, "a" * 50_000 + "@"), (1005, "1 " * 20_000), (1006, "+1" + "(" * 30_000)]
    docs = documents(spark, rows, clash=True)
    got = pii.personal_data(docs).collect()
    want = {}
    for i, t in rows:
        spans = brute(t)
        want.setdefault(i, []).append((*[sum(s[0] == k for s in spans) for k in pii.KINDS[:4]], hashlib.sha256(written(spans).encode()).hexdigest()))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(","))] if r.spans else []
        assert spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))
        base = next((brute(t) for i, t in rows if i == r.doc_id and len(brute(t)) + r.n_added == len(spans)), None)
        assert base is not None and set(base) <= set(spans)
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert sum(r.n_added for r in got) > 0


def test_no_python_on_the_executors(spark):
    plan = pii.found(pii.candidates(documents(spark, [(1, "a@b.cd")])), None)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("number,valid", [("4111111111111111", True), ("4111111111111112", False), ("79927398713", True), ("0", True)])
def test_luhn(spark, number, valid):
    assert spark.range(1).select(pii.luhn(F.lit(number)).alias("x")).first().x is valid


def test_expectation_maximisation_tells_good_labelers(spark):
    rng, rows = random.Random(2), {}
    for _ in range(4000):
        y = rng.random() < 0.3
        vote = lambda right: (1 if y else -1) if rng.random() < right else (-1 if y else 1)  # noqa: E731, B023
        key = ("email", vote(0.95), vote(0.9), vote(0.8), vote(0.5))
        rows[key] = rows.get(key, 0) + 1
    votes = spark.createDataFrame([(*k, float(n)) for k, n in rows.items()], "kind string, format int, gazetteer int, context int, boundary int, n double")
    m = pii.reliabilities(votes)
    assert m["prior", "email"] == pytest.approx(0.3, abs=0.04)
    assert m["format", 1, 1] > 0.9 and m["gazetteer", 1, 1] > 0.84 and m["context", 1, 1] > 0.74 and abs(m["boundary", 1, 1] - 0.5) < 0.1


def test_candidates_that_are_added(spark):
    rows = [(k, f"some words here {k} call tel (212) 555-{1000 + k} now") for k in range(60)] + [(100 + k, f"mail joe{k}@mail.com please") for k in range(60)]
    rows += [(300 + k, f'key token = "04dbebab91ab85687d33ee{k}" x') for k in range(60)] + [(500 + k, f"order no 4111-1111-1111-11{k:02d}x") for k in range(30)]
    got = as_dicts(pii.personal_data(documents(spark, rows)))
    assert sum(got[k]["spans"].startswith("phone:") for k in range(60)) > 50
    assert sum(got[300 + k]["spans"].startswith("secret:") for k in range(60)) > 50
    assert all(got[500 + k]["n_added"] == 0 for k in range(30))
    assert all(got[100 + k]["n_email"] == 1 for k in range(60))


def test_empty_table(spark):
    assert pii.personal_data(documents(spark, [])).count() == 0


def test_many_numbers_in_one_text(spark):
    import time

    numbers = ", ".join(str(100_000 + k) for k in range(125_000))  # 1 MB
    cards = " ; ".join(["4111 1111 1111 1111", "1.2.3.4", "a@b.cd", "+49 30 1234567"] * 9000)
    begin = time.perf_counter()
    got = as_dicts(pii.personal_data(documents(spark, [(1, numbers), (2, cards)], partitions=2)))
    assert time.perf_counter() - begin < 60
    assert [got[1][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [0, 0, 0, 0]
    assert [got[2][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [9000] * 4
    spans, at = [], 0
    for k in range(9000):
        for kind, value in (("card", "4111 1111 1111 1111"), ("ip", "1.2.3.4"), ("email", "a@b.cd"), ("phone", "+49 30 1234567")):
            spans.append(f"{kind}:{at}:{at + len(value)}")
            at += len(value) + 3
    assert got[2]["base_sha256"] == sha(",".join(spans))


def test_sums_before(spark):
    rng = random.Random(3)
    rows = [[rng.randint(0, 9) for _ in range(n)] for n in (1, 2, 63, 64, 65, 128, 4096, 4097, 9000)]
    df = spark.createDataFrame([(r,) for r in rows], "a array<int>")
    for r in df.select("a", pii.sums_before(F.col("a")).alias("s")).collect():
        total, want = 0, []
        for n in r.a:
            want.append(total)
            total += n
        assert r.s == want
