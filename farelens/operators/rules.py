"""Row-level data-quality rules.

Validation labels rows and never drops them. Each rule is one native boolean
``Column``; a row's ``validation_errors`` is the ';'-joined list of the rules
it fails, in rule order, or NULL when it fails none. A NULL predicate counts as
"did not fire", except in ``fare_mismatch``, which fires whenever the fares
cannot be shown to agree.

Everything is a projection over the input, so labelling is one narrow stage
(no shuffle), and the quality report is one aggregate over the same scan.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions.exprs import clean_column, require_schema_columns, strip, to_double, upper_code, with_columns_once
from farelens.model import (
    AIRPORT_CODE_PATTERN,
    CODE_COLUMNS,
    FARE_COLUMNS,
    FARE_RECONCILIATION_TOLERANCE,
    FARE_UPLIFT_ABSOLUTE_TOLERANCE,
    FARE_UPLIFT_RELATIVE_TOLERANCE,
    KNOWN_FARE_UPLIFT_FACTOR,
    MIN_VALID_ROW_RATIO,
    NON_EMPTY_STRING_COLUMNS,
    NOT_NULL_COLUMNS,
    NUMERIC_COLUMNS,
    REQUIRED_COLUMNS,
    STAGED_TYPES,
    QualityGateError,
    SchemaValidationError,
)
from farelens.sources.staging import conform, raw_column_name

# Tolerance of the uplift test: |ratio - f| <= atol + rtol * |f|.
UPLIFT_TOLERANCE = FARE_UPLIFT_ABSOLUTE_TOLERANCE + FARE_UPLIFT_RELATIVE_TOLERANCE * abs(KNOWN_FARE_UPLIFT_FACTOR)

LABEL_PAIR = ("is_valid", "validation_errors")
LABEL_COLUMNS = ("is_valid", "validation_errors", "reconciles_exactly", "has_known_uplift")


@dataclass(frozen=True)
class Rule:
    label: str
    family: str
    predicate: Column


def fare_components() -> Column:
    return F.col("base_fare_bdt") + F.col("tax_surcharge_bdt")


def reconciles_exactly(df: DataFrame) -> Column:
    """|total - (base + tax)| <= 0.01, in exact decimal arithmetic."""
    diff = F.abs(F.col("total_fare_bdt") - fare_components())
    return F.coalesce(diff <= F.lit(FARE_RECONCILIATION_TOLERANCE).cast("decimal(3,2)"), F.lit(False))


def has_known_uplift(df: DataFrame) -> Column:
    """total / (base + tax) is the known factor within the isclose tolerance.

    The ratio is taken in double precision; a zero denominator never matches.
    """
    comp = to_double(fare_components())
    ratio = F.try_divide(to_double(F.col("total_fare_bdt")), F.nullif(comp, F.lit(0.0)))
    return F.coalesce(
        F.abs(ratio - F.lit(KNOWN_FARE_UPLIFT_FACTOR)) <= F.lit(UPLIFT_TOLERANCE), F.lit(False)
    )


def classify_fare_consistency(df: DataFrame) -> DataFrame:
    """Adds ``reconciles_exactly`` and ``has_known_uplift`` (never NULL)."""
    df = _typed(df)
    return df.withColumns({
        "reconciles_exactly": reconciles_exactly(df),
        "has_known_uplift": has_known_uplift(df),
    })


def _typed(df: DataFrame) -> DataFrame:
    """Conform input of any other type once; typed staging passes through."""
    known = {f.name: f.dataType for f in df.schema.fields if f.name in STAGED_TYPES}
    return conform(df) if any(t != STAGED_TYPES[c] for c, t in known.items()) else df


def rules(df: DataFrame) -> list[Rule]:
    """Every rule that applies to ``df``'s columns, in label order."""
    cols = set(df.columns)
    out: list[Rule] = []
    for c in NOT_NULL_COLUMNS:
        # A value that arrived as unparseable text is present, not missing.
        raw = raw_column_name(c)
        value = F.col(clean_column(c)) if clean_column(c) in cols else F.col(c)
        missing = value.isNull() & F.col(raw).isNull() if raw in cols else value.isNull()
        out.append(Rule(f"null_{c}", "null", missing))
    for c in NUMERIC_COLUMNS:
        raw = raw_column_name(c)
        if c in cols and raw in cols:
            out.append(Rule(f"non_numeric_{c}", "non_numeric", F.col(raw).isNotNull()))
    for c in FARE_COLUMNS:
        out.append(Rule(f"negative_{c}", "negative", F.col(c) < 0))
    for c in NON_EMPTY_STRING_COLUMNS:
        stripped = F.col(clean_column(c)) if clean_column(c) in cols else strip(c)
        out.append(Rule(f"blank_{c}", "blank", stripped.isNull() | (stripped == "")))
    # ``label`` has each fare test, code and stripped airline in a column of its own,
    # the texts worked out once a row; these are NULL or blank where their column is.
    codes = {c: F.col(clean_column(c)) if clean_column(c) in cols else upper_code(c) for c in CODE_COLUMNS}
    for c, code in codes.items():
        out.append(Rule(f"malformed_{c}_code", "malformed_code",
                        code.isNotNull() & ~code.rlike(AIRPORT_CODE_PATTERN)))
    out.append(Rule("source_equals_destination", "same_endpoints",
                    codes["source"] == codes["destination"]))
    if {"reconciles_exactly", "has_known_uplift"} <= cols:
        agree = F.col("reconciles_exactly") | F.col("has_known_uplift")
    else:
        agree = reconciles_exactly(df) | has_known_uplift(df)
    out.append(Rule("fare_mismatch", "fare_mismatch", ~agree))
    if {"departure_datetime", "arrival_datetime"} <= cols:
        out.append(Rule("arrival_before_departure", "arrival_order",
                        F.col("arrival_datetime") < F.col("departure_datetime")))
    if "duration_hrs" in cols:
        out.append(Rule("non_positive_duration", "duration", F.col("duration_hrs") <= 0))
    if "days_before_departure" in cols:
        out.append(Rule("negative_days_before_departure", "lead_time",
                        F.col("days_before_departure") < 0))
    return out


def all_rule_labels() -> list[str]:
    """The 23 labels of a full staging frame with raw text kept, in order."""
    labels = [f"null_{c}" for c in NOT_NULL_COLUMNS]
    labels += [f"non_numeric_{c}" for c in NUMERIC_COLUMNS]
    labels += [f"negative_{c}" for c in FARE_COLUMNS]
    labels += [f"blank_{c}" for c in NON_EMPTY_STRING_COLUMNS]
    labels += [f"malformed_{c}_code" for c in CODE_COLUMNS]
    labels += ["source_equals_destination", "fare_mismatch", "arrival_before_departure",
               "non_positive_duration", "negative_days_before_departure"]
    return labels


def fired(rule: Rule) -> Column:
    """The rule's predicate with NULL read as "did not fire"."""
    return F.coalesce(rule.predicate, F.lit(False))


def validate_required_columns(df: DataFrame) -> None:
    require_schema_columns(df, REQUIRED_COLUMNS, "Staged data")


RULE_BITS = "_rule_bits"


def _bit(i: int) -> Column:
    return F.lit(1 << i).cast("long")


def rule_bits(rs: list[Rule]) -> Column:
    """Every fired rule as one bit of a long (rule i -> bit i), 0 for a clean row.

    The predicates are evaluated once per row into this column; labels, the
    validity flag and the per-rule counts are cheap bit tests on it.
    """
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rs):
        bits = bits + F.when(fired(r), _bit(i)).otherwise(F.lit(0).cast("long"))
    return bits


def passes_all(rs: list[Rule]) -> Column:
    """Whether no rule fires, as a conjunction of the rules: a filter on it is
    split by Catalyst, and rules over one table's columns go below the joins."""
    return functools.reduce(lambda a, b: a & b, [~fired(r) for r in rs])


def has_bit(i: int) -> Column:
    return (F.col(RULE_BITS).bitwiseAND(_bit(i))) != 0


def label(df: DataFrame, keep_bits: bool = False, keep_clean: bool = False) -> DataFrame:
    """Adds ``is_valid``, ``validation_errors``, ``reconciles_exactly`` and
    ``has_known_uplift`` to every row. Lazy: checks only the schema.

    ``keep_bits`` keeps the ``_rule_bits`` column for ``report_columns``,
    ``keep_clean`` the stripped airline and codes for ``enrich.clean``; these are
    a generator's output and ``is_valid`` a conjunction, for rows that are filtered
    on the labels. Without it they are projected, as a generator is interpreted in
    stages with too much code to compile whole, and the rules are evaluated once.
    """
    validate_required_columns(df)
    add = with_columns_once if keep_clean else DataFrame.withColumns
    df = add(_typed(df), {clean_column(c): upper_code(c) if c in CODE_COLUMNS else strip(c) for c in NON_EMPTY_STRING_COLUMNS})
    df = df.withColumns({
        "reconciles_exactly": reconciles_exactly(df),
        "has_known_uplift": has_known_uplift(df),
    })
    rs = rules(df)
    if len(rs) > 62:
        raise ValueError("too many rules for one bit mask")
    errors = F.when(F.col(RULE_BITS) != 0, F.concat_ws(";", *[F.when(has_bit(i), F.lit(r.label)) for i, r in enumerate(rs)]))
    out = (
        df.withColumn(RULE_BITS, rule_bits(rs))
        .withColumns({
            "validation_errors": errors,
            "is_valid": passes_all(rs) if keep_clean and not keep_bits else F.col(RULE_BITS) == 0,
        })
        .drop(*[clean_column(c) for c in NON_EMPTY_STRING_COLUMNS if not keep_clean])
    )
    first = [c for c in out.columns if c not in LABEL_COLUMNS]
    return out.select(*first, *LABEL_COLUMNS) if keep_bits else out.select(*[c for c in first if c != RULE_BITS], *LABEL_COLUMNS)


def rule_hits(df: DataFrame, family: str | None = None) -> DataFrame:
    """One row per (input row, fired rule), optionally for one rule family.

    ``explode`` of the fired labels; rows that fire nothing produce no output.
    """
    validate_required_columns(df)
    df = _typed(df)
    rs = [r for r in rules(df) if family is None or r.family == family]
    hits = F.array_compact(F.array(*[F.when(fired(r), F.lit(r.label)) for r in rs]))
    keep = [c for c in df.columns if not c.startswith("_raw_")]
    return df.select(*keep, F.explode(hits).alias("rule"))


def report_columns(df: DataFrame, with_total: bool = True) -> list[Column]:
    """Aggregate expressions of the quality report (one pass over ``df``).

    Uses the ``_rule_bits`` column when ``df`` carries it (``label(keep_bits=
    True)``), else evaluates the predicates.
    """
    rs = rules(df)
    if RULE_BITS in df.columns:
        per_rule = [F.count_if(has_bit(i)).alias(r.label) for i, r in enumerate(rs)]
    else:
        per_rule = [F.count_if(fired(r)).alias(r.label) for r in rs]
    total = [F.count(F.lit(1)).alias("total_rows")] if with_total else []
    return [
        *total,
        F.count_if(F.col("is_valid")).alias("valid_rows"),
        F.count_if(F.col("has_known_uplift")).alias("rows_with_known_fare_uplift"),
        *per_rule,
    ]


def rule_counts(labelled_input: DataFrame) -> DataFrame:
    """(rule_order, rule, rows) for every rule that applies, zeros included."""
    df = _typed(labelled_input)
    rs = rules(df)
    agg = df.agg(*[F.count_if(fired(r)).alias(r.label) for r in rs])
    pairs = [F.struct(F.lit(i + 1).alias("rule_order"), F.lit(r.label).alias("rule"),
                      F.col(r.label).alias("rows")) for i, r in enumerate(rs)]
    return agg.select(F.inline(F.array(*pairs)))


def quality_report(labelled: DataFrame) -> DataFrame:
    """The one-row quality report of a labelled frame.

    ``failed_checks`` is a JSON object of the non-zero rule counts, in rule
    order; ``valid_ratio`` is rounded half-to-even at six decimals.
    """
    rs = rules(labelled)
    agg = labelled.agg(*report_columns(labelled))
    checks = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(r.label) for r in rs]),
                          F.array(*[F.col(r.label) for r in rs])),
        lambda k, v: v > 0,
    )
    ratio = F.try_divide(F.col("valid_rows").cast("double"), F.col("total_rows"))
    return agg.select(
        "total_rows",
        "valid_rows",
        (F.col("total_rows") - F.col("valid_rows")).alias("invalid_rows"),
        (F.rint(ratio * F.lit(1e6)) / F.lit(1e6)).alias("valid_ratio"),
        F.to_json(checks).alias("failed_checks"),
        "rows_with_known_fare_uplift",
        F.lit(KNOWN_FARE_UPLIFT_FACTOR).alias("fare_uplift_factor"),
        F.lit(MIN_VALID_ROW_RATIO).alias("min_valid_ratio_required"),
    )


def report_dict(report_row) -> dict:
    """The collected one-row report as a plain dict (``failed_checks`` a dict)."""
    import json

    d = report_row.asDict()
    d["failed_checks"] = json.loads(d["failed_checks"]) if d["failed_checks"] else {}
    return d


def check_not_empty(report: dict) -> None:
    if not report["total_rows"]:
        raise SchemaValidationError("The source has no data rows, so there is nothing to label.")


def enforce_quality_threshold(report: dict, minimum: float = MIN_VALID_ROW_RATIO) -> None:
    """Raise when the valid share is below ``minimum``; equal passes."""
    ratio = float(report["valid_ratio"])
    if ratio < minimum:
        raise QualityGateError(
            f"Only {ratio:.2%} of the rows passed every rule; the run needs {minimum:.2%}. "
            f"Rows by rule: {report.get('failed_checks')}"
        )


def apply_labels(staging: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Attach externally computed labels to staging rows by key.

    The pipeline computes labels as columns of the staging frame itself, so it
    never needs this join; it is here for labels that arrive as a separate
    table. A row without a new label keeps what it had; two labels for one key
    are refused (one grouped count of the labels), as they would double rows.
    ``label_updates`` counts the rows that a label reaches.
    """
    require_schema_columns(labels, (key, *LABEL_PAIR), "Label table")
    twice = labels.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"More than one label for {key} {twice[0][key]!r}")
    new = labels.select(key, F.struct(*LABEL_PAIR).alias("_label"))
    old = F.struct(*[F.col(c) if c in staging.columns else F.lit(None).cast(t).alias(c)
                     for c, t in zip(LABEL_PAIR, ("boolean", "string"), strict=True)])
    keep = [c for c in staging.columns if c not in LABEL_PAIR]
    joined = staging.join(new, on=key, how="left").withColumn("_label", F.coalesce("_label", old))
    return joined.select(*keep, *[F.col(f"_label.{c}").alias(c) for c in LABEL_PAIR])


def label_updates(staging: DataFrame, labels: DataFrame, key: str = "id") -> int:
    """How many staging rows have a label in ``labels``."""
    return staging.join(labels.select(key), on=key, how="left_semi").count()
