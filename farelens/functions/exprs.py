"""Native column expressions for the semantics the fare model depends on.

Everything returns a ``Column`` built from built-in Spark functions, so it runs
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.model import FARE_TYPE, SchemaValidationError

# Python's ``str.strip()`` removes every character for which ``str.isspace()``
# holds (tabs, no-break and ideographic spaces, the \x1c-\x1f separators ...).
# Spark's ``trim`` removes only the blank, so the set is derived from the same
# rule and handed to ``btrim``. All such characters lie below U+3001.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# A trailing type suffix ("1.0d", "2f") is accepted by Spark's string -> double
# cast but is not a number to a CSV reader, and NaN is missing to it; both are
# rejected before casting. The cast trims everything up to the blank.
_NO_DOUBLE = r"(?i)([df]\s*|nan[\x00-\x20]*)\z"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading and trailing whitespace, as Python's ``str.strip``.

    Text that begins and ends with a printable ASCII character is left alone:
    looking up the two in the long set is most of ``btrim``'s time. Text compares
    by its bytes, so a character past ASCII is above "~".
    """
    col = as_column(c)
    plain = (col >= "!") & (col < "\x7f") & F.right(col, F.lit(1)).between("!", "~")
    return F.when(plain, col).otherwise(F.btrim(col, F.lit(WHITESPACE)))


def upper_code(c: str | Column) -> Column:
    """Normalised location code: stripped and upper-cased."""
    return F.upper(strip(c))


def clean_column(c: str) -> str:
    """Where labelled rows may have the stripped text, or code, of a column."""
    return f"_clean_{c}"


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are worked out once for each row, however often they
    are used: a plain projected column is written out again by the optimiser in
    every condition on it that it moves below the projection, the output of a
    generator isn't. They are worked out even where nothing reads them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_decimal(c: str | Column, dtype: T.DecimalType = FARE_TYPE) -> Column:
    """Text -> exact decimal; unparseable, NaN, infinite or overflowing -> NULL."""
    return as_column(c).try_cast(dtype)


def parse_double(c: str | Column) -> Column:
    """Text -> double the way a CSV reader sees numbers.

    A d/f suffix is rejected and NaN becomes NULL (Spark orders NaN above every
    number, which would poison comparisons, means and maxima). Infinity stays.
    Text that ends with a digit, as nearly all does, is cast and nothing else.
    """
    col = as_column(c)
    word = F.lower(strip(col))
    number = F.right(col, F.lit(1)).between("0", "9") | ~col.rlike(_NO_DOUBLE)
    return F.coalesce(
        F.when(number, col.try_cast(T.DoubleType())),
        F.when(word.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
        .when(word.isin("-inf", "-infinity"), F.lit(float("-inf"))),
    )


def parse_int(c: str | Column) -> Column:
    """Text -> whole number; "14.0", "-3.0" and "1e2" are whole, 14.7 is NULL."""
    number = as_column(c).try_cast(T.DecimalType(20, 6))
    return F.when(number == F.floor(number), number.try_cast(T.IntegerType()))


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Text -> timestamp without zone; unparseable -> NULL.

    ISO text is always read; ``fmt`` names one more pattern (``MM/dd/yyyy HH:mm``).
    """
    iso = as_column(c).try_cast(T.TimestampNTZType())
    if fmt is None:
        return iso
    return F.coalesce(iso, F.try_to_timestamp(as_column(c), F.lit(fmt)).cast(T.TimestampNTZType()))


def to_double(c: str | Column) -> Column:
    return as_column(c).cast(T.DoubleType())


def exact_mean(c: str | Column) -> Column:
    """Mean over non-NULL values as a double.

    For decimal input the sum is exact, so the result does not depend on the
    order in which partitions are combined. ``count`` skips NULL, as a mean does.
    """
    col = as_column(c)
    return F.try_divide(F.sum(col).cast(T.DoubleType()), F.count(col))


def round_half_even(c: str | Column, digits: int) -> Column:
    """Round a double half-to-even at ``digits`` decimals (pandas ``round``)."""
    scale = float(10 ** digits)
    return F.rint(as_column(c) * F.lit(scale)) / F.lit(scale)


def round_half_up(c: str | Column, digits: int, dtype: T.DataType | None = None) -> Column:
    """Round half away from zero at ``digits`` decimals (SQL numeric ``ROUND``).

    Exact decimals use ``round``; doubles use ``floor(|x| * 10^d + 0.5)``, sign
    restored, and the result is a double.
    """
    col = as_column(c)
    if isinstance(dtype, T.DecimalType):
        return F.round(col, digits).cast(T.DoubleType())
    scale = float(10 ** digits)
    magnitude = F.floor(F.abs(col) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(col < 0, -magnitude).otherwise(magnitude)


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in columns if c not in present]


def require_columns(df: DataFrame, columns: Iterable[str], what: str,
                    error: type[Exception] = ValueError) -> None:
    """Raise naming every missing column; ``what`` names the caller."""
    missing = missing_columns(df, columns)
    if missing:
        raise error(f"{what} requires missing column(s): {missing}. Present: {sorted(df.columns)}")


def require_schema_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    require_columns(df, columns, what, SchemaValidationError)
