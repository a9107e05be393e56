"""URL filters by hashed expressions, in DataFrame functions only.

A rule is a host and the start of a path. It fits its host and all subdomains
where the URL's path starts with the rule's; of several the longest wins.

1. Every URL is expanded into its expressions: each suffix of the host, cut at
   the dots, with each start of the path, of the lengths that rules have.
2. Expressions and rules meet by a 32-bit prefix of their SHA-256 digest. Rules
   are broadcast only when their counted bytes are under BROADCAST_BYTES; else
   both sides are shuffled, expressions dealt over SALTS copies of the rules, as
   an expression such as ``com/`` may stand in most URLs.
3. The full digest confirms what the prefix proposed, and the longest rule is
   kept for each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The rules of the registered query (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
BROADCAST_BYTES = 32 << 20
SALTS = 16
#: Copies of one row that are written out at once.
COPIES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and path of a URL; both empty where it is NULL
    or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, host_sizes: list[int], path_sizes: list[int]) -> Column:
    """Digests of all pairs of a host suffix and a path start whose lengths are
    among those given, each once."""
    whole, way = F.length(host), F.length(path)
    sizes = lambda x: F.array(*[F.lit(n) for n in x]).cast("array<int>")
    border = lambda n: (n == whole) | ((n < whole) & (F.substring(host, whole - n, F.lit(1)) == "."))
    hosts = F.transform(F.filter(sizes(host_sizes), border), lambda n: F.right(host, n))
    starts = F.transform(F.filter(sizes(path_sizes), lambda n: n <= way), lambda n: F.left(path, n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda p: F.sha2(F.concat(h, p).cast("binary"), 256))))


def prefix(digest: Column) -> Column:
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")


def rule_table(rules: DataFrame) -> DataFrame:
    """(host, path, verdict), one row for each host and path. Rules that can't
    fit any URL are left out: without a host, with a verdict other than allow or
    block, or with characters that end a host or path. Of two verdicts for the
    same host and path ``block`` counts. A NULL path is empty."""
    host, path = F.translate(F.col("host"), UPPER, LOWER).alias("host"), F.coalesce(F.col("path"), F.lit("")).alias("path")
    sound = (F.col("host") != "") & ~F.col("host").rlike("[/?#]") & F.col("path").rlike(r"\A(/[^?#]*)?\z") & F.col("verdict").isin("allow", "block")
    return rules.select(host, path, "verdict").where(sound).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def filtered(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row: page_id, host, path, rule (host and path of the longest rule that
    fits, else NULL), verdict (the rule's, else ``default``).

    ``rules`` has host, path and verdict. Rules of equal length: the one with the
    longer host. NULL and empty URLs and URLs without ``://`` have an empty host
    and path, which no rule fits. URLs may have any length: only starts as long
    as some rule are hashed. Repeated rows each give a row, NULL ids stay, other
    columns are not read; an empty table of pages gives an empty result, one of
    rules the default verdict everywhere.
    """
    known = rule_table(rules)
    whole = F.concat("host", "path")
    facts = known.agg(F.collect_set(F.length("host")).alias("hosts"), F.collect_set(F.length("path")).alias("paths"), F.sum(F.octet_length(whole) + 150).alias("bytes")).first()
    digest = F.sha2(whole.cast("binary"), 256)
    rows = known.select(prefix(digest).alias("key"), F.struct(digest.alias("digest"), F.struct(
        F.length(whole).alias("size"), F.length("host").alias("host_size"), whole.alias("rule"), F.col("verdict").alias("verdict")).alias("found")).alias("r"))
    by_key = rows.groupBy("key").agg(F.collect_list("r").alias("rules"))

    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"), F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    hashed = urls.select("*", F.posexplode_outer(expressions(F.col("host"), F.col("path"), sorted(facts.hosts), sorted(facts.paths))).alias("pos", "digest"))
    hashed = hashed.withColumn("key", prefix(F.col("digest")))
    if (facts.bytes or 0) <= broadcast_bytes:
        met = hashed.join(F.broadcast(by_key), "key", "left")
    else:
        deal = F.pmod(F.xxhash64("page_id", "path", "salt"), F.lit(SALTS)).cast("int")
        copies = by_key.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = hashed.withColumn("deal", deal).join(copies, ["key", "deal"], "left")
    same = F.filter("rules", lambda r: r["digest"] == F.col("digest"))
    found = F.get(same, F.lit(0))["found"]
    # one row for each page again; equal rows of a page table are counted, not merged
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    best = met.groupBy("page_id", "host", "path", "salt").agg(F.max(found).alias("best"), F.sum(first.cast("long")).alias("n"))
    blocks = best.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    each = blocks.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("block") * COPIES))))
    return each.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES])))
    return filtered(table(spark, sf_dir, "pages"), rules)


OP13_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
     rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
     parts AS (SELECT page_id, row_number() OVER () AS k,
                      translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
     best AS (SELECT k, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
                     arg_max(verdict, length(rules.host || rules.path)) AS verdict
              FROM parts JOIN rules ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host)) AND starts_with(parts.path, rules.path)
              GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (k)
"""
