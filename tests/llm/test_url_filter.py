import random

import duckdb
import pandas as pd
import pytest
from farelens.llm import url_filter
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict", "key", "salt", "pos", "digest", "n", "best", "a b: c")]])


def pages(spark, urls, partitions=3):
    return spark.createDataFrame([(i, u, "<p>", *["x"] * 11) for i, u in urls], SCHEMA).repartition(partitions)


def rule_frame(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    stops = [tail.find(c) for c in "?#" if c in tail]
    path = tail[: min(stops)] if stops else tail
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, default)))


URLS = [None, "", "no scheme", "http://", "://org/", "http://ORG/", "http://example.org", "http://example.org/es", "http://example.org/es/", "https://a.EXAMPLE.org/es/x?y#z",
        "http://notexample.org/es/", "http://example.org?/es/", "http://example.org/en/1", "http://m.example.org/en/17.html", "http://example.org/en/2", "http://x.com/fr/1",
        "http://x.com/de/1", "http://com/de/", "http://x.com.net/de/", "http://é.com/fr/ü", "http://ÀB.org/", "ftp://user@x.org:80/a://b", "http://.org/", "http://org./",
        "http://x.com/fr/de/\n", "http://x.net/" + "long" * 50_000, "http://" + "a." * 5_000 + "org/"]


@pytest.mark.parametrize("most", [url_filter.BROADCAST_BYTES, -1])
def test_against_brute_force(spark, most):
    urls = list(enumerate(URLS)) + [(3, "http://x.com/de/1")] * 3 + [(None, "http://x.com/de/1"), (None, None)]
    got = url_filter.filtered(pages(spark, urls), rule_frame(spark, list(url_filter.RULES)), broadcast_bytes=most)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((i, *brute(u, url_filter.RULES)) for i, u in urls), key=key)


def test_many_rules(spark):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "cc", "d-e"])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: rng.choice(["", "/", *["/" + "/".join(label() for _ in range(rng.randint(1, 3)))] * 3])
    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(150)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [(k, f"http://{host()}{path()}") for k in range(400)]
    more = [("a", "x", "block"), ("a/b", "", "block"), (None, "/", "block"), ("", "/", "block"), ("b", "/", None), ("cc", "/", "odd"), ("A", "/zz", "allow"), ("a", "/zz", "block")]
    urls.append((900, "http://a/zzz"))
    got = url_filter.filtered(pages(spark, urls), rule_frame(spark, rules + more))
    assert {r.page_id: tuple(r)[1:] for r in got.collect()} == {i: brute(u, [*rules, ("a", "/zz", "block")]) for i, u in urls}


def test_empty_tables_and_copies(spark):
    rules = rule_frame(spark, list(url_filter.RULES))
    assert url_filter.filtered(pages(spark, []), rules).count() == 0
    got = url_filter.filtered(pages(spark, [(1, "http://x.org/")]), rule_frame(spark, []), default="block").collect()
    assert [tuple(r) for r in got] == [(1, "x.org", "/", None, "block")]
    assert url_filter.filtered(pages(spark, [(1, "http://x.org/")] * 2500, 2), rules).count() == 2500


def test_plan_has_no_python_and_one_shuffle(spark):
    got = url_filter.op13_url_filter(spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    order = lambda d: d[sorted(d.columns)].sort_values("page_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(url_filter.op13_url_filter(spark, folder).toPandas()), order(db.execute(url_filter.OP13_SQL).df()), check_dtype=False)
