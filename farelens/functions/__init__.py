"""Column-expression helpers shared by every operator."""

from farelens.functions.exprs import (  # noqa: F401
    WHITESPACE,
    as_column,
    exact_mean,
    missing_columns,
    parse_decimal,
    parse_double,
    parse_int,
    parse_timestamp,
    require_columns,
    round_half_even,
    round_half_up,
    strip,
    to_double,
    upper_code,
)
