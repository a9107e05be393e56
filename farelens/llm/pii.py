"""Personal data by weak supervision, in DataFrame functions only.

1. Candidates. The base patterns give spans that always stay; what they match
   but their checks reject, and what wider patterns match, are candidates.
2. Labelers. A format labeler (regex checks), a gazetteer labeler (known
   prefixes, domains and country codes), a context labeler (the words just
   before) and a boundary labeler vote 1, -1 or 0 (no opinion) on each.
3. Expectation-maximisation over the table of vote patterns, whose size is
   bounded by kinds x 3^labelers, estimates what each vote says about a span
   and gives every pattern a probability.
4. A logistic regression on the span's features, trained on these soft labels
   over the bounded table of feature patterns, decides which candidates are
   added.

The text is read once: candidates are written to the shared folder, and the
later steps read that small table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Base patterns. They start where a run of their characters starts, or where
#: the last match ended, and don't give back: the same matches in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A run of digits that single blanks or hyphens may part, of 12 digits or more.
CARD = r"(?=(?:[0-9][\x20-]?){11}[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Wider patterns of the method, all in one pass.
WIDER = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++"
         r"|(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
         r"|(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
         r"|(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![0-9A-Za-z])"
         r"|(?i:\b(?:token|secret|password|passwd|api_?key)\b)\x20{0,2}[=:]\x20{0,2}\"?[A-Za-z0-9_/+-]{12,}+")
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "secret")
#: Gazetteers (fixed values): domain ends, card and IBAN prefixes, calling codes.
DOMAIN_ENDS = "com|org|net|edu|gov|io|de|fr|es|it|uk|nl|eu|info|biz|ch|at|be|pl|us|ca"
IBAN_COUNTRIES = "DE|FR|ES|IT|GB|NL|BE|AT|CH|PL|PT|IE|SE|NO|DK|FI|LU|CZ|GR"
CARD_PREFIX = "(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
CALLING = r"\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
#: Words before a span that speak for each kind, and words against any.
CONTEXT = {"email": "mail|contact|write to|reach|adresse", "ip": r"\bip\b|host|server|address|login|client", "card": "card|visa|master|amex|credit|payment|karte|tarjeta|carte",
           "phone": r"phone|call|\btel|fax|mobile|cell|dial|anruf|llam", "ssn": "ssn|social|security", "iban": "iban|account|bank|konto|cuenta|compte", "secret": "."}
AGAINST = r"(?:order|invoice|isbn|issn|version|chapter|section|page|item|ticket|serial|sku)[ .:#no]*$"
LABELERS = ("format", "gazetteer", "context", "boundary")
BEFORE = 40
ROUNDS = 12
#: Matches whose places are summed up at once.
CHUNK = 64
ADD = 0.9

SPAN = ("array<struct<kind:string,first:int,after:int,base:boolean,format:int,gazetteer:int,context:int,boundary:int,size:int>>")


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of 1 to 19 digits has a valid check digit."""
    def worth(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(number), ""), worth), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(sizes: Column, levels: int = 2) -> Column:
    """For each entry of a non-empty array the sum of those before it.

    An array can only grow by being copied, so sums are taken in chunks, and
    the chunks' totals in the same way: work stays close to the array's length.
    """
    if not levels:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        grown = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(sizes, none, grown)["out"]
    whole = lambda x: F.aggregate(x, F.lit(0), lambda acc, n: acc + n)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")), lambda k: F.slice(sizes, k * CHUNK + 1, F.lit(CHUNK)))
    shifted = lambda x, start: F.transform(sums_before(x, 0), lambda n: n + start)
    return let(chunks, lambda c: F.flatten(F.zip_with(c, sums_before(F.transform(c, whole), levels - 1), shifted)))


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern as structs of value, first, after, the text
    before (since the last match) and after it."""
    none = F.array().cast("array<struct<value:string,first:int,after:int,before:string,behind:string>>")

    def placed(x: Column) -> Column:
        steps = F.sequence(F.lit(0), F.size(x["found"]) - 1)
        size = lambda i: F.length(F.get(x["gaps"], i)) + F.length(F.get(x["found"], i))

        def match(i: Column, start: Column) -> Column:
            value, before = F.get(x["found"], i), F.get(x["gaps"], i)
            first = start + F.length(before)
            return F.struct(value.alias("value"), first.alias("first"), (first + F.length(value)).alias("after"),
                            F.right(before, F.lit(BEFORE)).alias("before"), F.left(F.get(x["gaps"], i + 1), F.lit(1)).alias("behind"))

        return let(F.transform(steps, size), lambda sizes: F.zip_with(steps, sums_before(sizes), match))

    # the text is split only where there is a match
    both = lambda found: F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, let(both(found), placed)).otherwise(none))


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def judged(m: Column, kind: Column | str, base: Column) -> Column:
    """A candidate span with the votes of the labelers."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    value, number, before = m["value"], digits(m["value"]), F.lower(m["before"])
    n = F.length(number)
    is_ = lambda k: kind == k
    by_kind = lambda cases: reduce(lambda c, k: c.when(is_(k), cases[k]), cases, F.when(F.lit(False), F.lit(False)))
    formed = by_kind({"email": base | value.rlike(r"(?i)(\(at\)|\[at\])"), "ip": base & ~value.rlike(r"^(0|22[4-9]|2[3-5][0-9])\."), "card": base,
                      "phone": n.between(9, 15), "ssn": ~value.rlike("^(000|666|9)") & ~value.rlike("0000$"), "iban": F.length(value).between(15, 34), "secret": value.rlike("[0-9]")})
    known = by_kind({"email": value.rlike(rf"(?i)(?:\.|dot[\)\]]\x20?)({DOMAIN_ENDS})$"), "ip": ~value.rlike(r"^(0|10|127|255)\."), "card": number.rlike("^" + CARD_PREFIX),
                     "phone": value.rlike("^" + CALLING) | value.rlike(r"^\(?[2-9]"), "ssn": value.rlike("^[0-8]"), "iban": value.rlike(f"^({IBAN_COUNTRIES})"), "secret": value.rlike("(?i)^(token|secret|password|api)")})
    spoken = reduce(lambda c, k: c.when(is_(k), before.rlike(CONTEXT[k])), CONTEXT, F.when(F.lit(False), F.lit(False)))
    glued = before.rlike(r"[\p{L}0-9]$") | m["behind"].rlike(r"^[\p{L}0-9]")
    free = (before.rlike(r"(^|[\s(\[\"':;,<])$")) & (m["behind"].rlike(r"^($|[\s)\]\"';:,.>!?])"))
    return F.struct(kind.alias("kind"), m["first"].alias("first"), m["after"].alias("after"), base.alias("base"),
                    vote(formed, ~formed).alias("format"), vote(known, ~known).alias("gazetteer"), vote(spoken, before.rlike(AGAINST)).alias("context"),
                    vote(free, glued).alias("boundary"), F.least(F.length(value) / 8, F.lit(4)).cast("int").alias("size"))


def base_spans(text: Column) -> dict[str, Column]:
    """Matches of each base pattern with the base check, as candidates."""
    has = lambda c, pattern: F.when(F.instr(text, c) > 0, located(text, pattern)).otherwise(located(F.lit(""), pattern))
    small = lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), part), F.lit(3)).cast("int") <= 255)
    number = lambda m: digits(m["value"])
    return {
        "email": F.transform(has("@", EMAIL), lambda m: judged(m, "email", F.lit(True))),
        "ip": F.transform(has(".", IP), lambda m: judged(m, "ip", F.forall(F.split(m["value"], r"\."), small))),
        "card": F.transform(F.filter(located(text, CARD), lambda m: F.length(number(m)) >= 12),
                            lambda m: judged(m, "card", F.length(number(m)).between(12, 19) & luhn(F.left(number(m), F.lit(19))))),
        "phone": F.transform(has("+", PHONE), lambda m: judged(m, "phone", F.length(number(m)).between(9, 15))),
    }


def wider_kind(value: Column) -> Column:
    return (F.when(value.rlike(r"(?i)\(at\)|\[at\]"), "email").when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(value.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]+$"), "iban").when(value.rlike("^[(0-9]"), "phone").otherwise("secret"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, spans (all candidates with votes). NULL text is empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    text = F.col("body")
    wider = F.transform(located(text, WIDER), lambda m: judged(m, wider_kind(m["value"]), F.lit(False)))
    return rows.select("doc_id", F.concat(*[x.cast(SPAN) for x in base_spans(text).values()], wider.cast(SPAN)).alias("spans"))


def reliabilities(votes: DataFrame, rounds: int = ROUNDS) -> dict:
    """What the labelers' votes say, by expectation-maximisation.

    ``votes``: kind, one column for each labeler, n; one row for each pattern.
    Every round is one aggregate of that small table: the expected number of
    spans of each class by kind, and by labeler and vote. Returns P(class), and
    P(vote | class) for each labeler, smoothed by one span.
    """
    model = {("prior", k): 0.5 for k in KINDS}
    for name in LABELERS:
        model |= {(name, v, y): {1: 0.6, 0: 0.3, -1: 0.1}[v if y else -v] for v in (1, 0, -1) for y in (1, 0)}
    for _ in range(rounds):
        p = probability(model)
        scored = votes.select("kind", *LABELERS, (F.col("n") * p).alias("yes"), (F.col("n") * (1 - p)).alias("no"))
        sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col(s))), F.lit(0.0)).alias(f"{k}_{s}") for k in KINDS for s in ("yes", "no")]
        sums += [F.coalesce(F.sum(F.when(F.col(a) == v, F.col(s))), F.lit(0.0)).alias(f"{a}_{v}_{s}") for a in LABELERS for v in (1, 0, -1) for s in ("yes", "no")]
        got = scored.agg(*sums).first().asDict()
        model = {("prior", k): (got[f"{k}_yes"] + 1) / (got[f"{k}_yes"] + got[f"{k}_no"] + 2) for k in KINDS}
        for a in LABELERS:
            for y, s in ((1, "yes"), (0, "no")):
                whole = sum(got[f"{a}_{v}_{s}"] for v in (1, 0, -1)) + 3
                model |= {(a, v, y): (got[f"{a}_{v}_{s}"] + 1) / whole for v in (1, 0, -1)}
    return model


def probability(model: dict) -> Column:
    """P(personal data | votes) under a model, as a column."""
    odds = reduce(lambda c, k: c.when(F.col("kind") == k, math.log(model["prior", k] / (1 - model["prior", k]))), KINDS, F.when(F.lit(False), F.lit(0.0)))
    for a in LABELERS:
        odds = odds + reduce(lambda c, v, a=a: c.when(F.col(a) == v, math.log(model[a, v, 1] / model[a, v, 0])), (1, 0, -1), F.when(F.lit(False), F.lit(0.0)))
    return 1 / (1 + F.exp(-odds))


def features(span=None) -> dict[str, Column]:
    """0/1 features of a span: its kind, size and every vote."""
    c = (lambda x: F.col(x)) if span is None else (lambda x: span[x])
    out = {f"kind_{k}": c("kind") == k for k in KINDS} | {f"size_{i}": c("size") == i for i in range(5)}
    out |= {f"{a}_{v}": c(a) == v for a in LABELERS for v in (1, -1)}
    return {k: x.cast("double") for k, x in out.items()}


def train(spans: DataFrame, rounds: int = ROUNDS) -> tuple[float, dict[str, float]] | None:
    """Weights of the span classifier from a table of candidates (``spans``);
    None where there is no candidate or they all say the same."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    each = spans.select(F.explode("spans").alias("s")).select("s.*")
    patterns = stored(each.groupBy("kind", *LABELERS, "size").agg(F.count(F.lit(1)).cast("double").alias("n")), "pii-patterns")
    model = reliabilities(patterns, rounds)
    p = probability(model)
    named = features()
    soft = patterns.select(*[c.alias(f"f_{k}") for k, c in named.items()], F.explode(F.array(
        F.struct(F.lit(1.0).alias("y"), (F.col("n") * p).alias("weight")), F.struct(F.lit(0.0).alias("y"), (F.col("n") * (1 - p)).alias("weight")))).alias("t"))
    soft = soft.select(*[f"f_{k}" for k in named], "t.*").where("weight > 1e-6")
    if soft.select("y").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=[f"f_{k}" for k in named], outputCol="features").transform(soft)
    fitted = LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", regParam=0.001, maxIter=40).fit(rows)
    return fitted.intercept, dict(zip(named, fitted.coefficients.toArray().tolist(), strict=True))


def found(spans: DataFrame, weights: tuple[float, dict[str, float]] | None) -> DataFrame:
    """Per row: doc_id and the spans that stay, in order: the base spans, and
    candidates that the classifier takes and that overlap no base span."""
    def taken(s: Column) -> Column:
        if weights is None:
            return F.lit(False)
        z = reduce(lambda a, b: a + b, [F.lit(w) * x for (_, x), w in zip(features(s).items(), weights[1].values(), strict=True)], F.lit(weights[0]))
        return z >= math.log(ADD / (1 - ADD))

    base = F.filter("spans", lambda s: s["base"])
    both = spans.select("doc_id", base.alias("base"), F.filter("spans", lambda s: ~s["base"] & taken(s)).alias("more"))
    free = F.filter("more", lambda s: ~F.exists("base", lambda b: (b["first"] < s["after"]) & (s["first"] < b["after"])))
    order = lambda x: F.array_sort(F.transform(x, lambda s: F.struct(
        s["first"].alias("first"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("place"), s["after"].alias("after"), s["kind"].alias("kind"))))
    return both.select("doc_id", order("base").alias("base"), order(F.concat("base", free)).alias("every"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["after"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (all, as kind:first:after), n_added.

    NULL and empty texts have no spans. Texts may have any length and number of
    matches: places are found in time close to their number. Repeated rows each
    give a row, NULL ids stay, other columns are not read, and an empty table gives an empty result.
    """
    spans = stored(candidates(docs, id_col, text_col), "pii-candidates")
    kept = found(spans, train(spans))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return kept.select("doc_id", *[n(k) for k in KINDS[:4]], F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       written(F.col("every")).alias("spans"), (F.size("every") - F.size("base")).cast("long").alias("n_added"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
