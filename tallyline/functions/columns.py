"""Column helpers shared by all operators. Everything stays in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = "decimal(12,2)"
_CENTS = "decimal(20,2)"

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnLike) -> Column:
    """Exact two-digit amount; sums of it do not depend on the order of the rows."""
    return col(c).cast(MONEY)


def cents(c: str) -> str:
    """SQL text: whole cents of a double that holds at most two decimal places.

    Much cheaper than casting a double to a decimal, which goes through its text form.
    """
    return f"CAST(RINT({c} * 100) AS BIGINT)"


def from_cents(c: str) -> str:
    """SQL text: exact two-digit amount from whole cents."""
    return f"CAST(CAST({c} AS DECIMAL(14,0)) * 0.01BD AS {MONEY})"


def total(c: ColumnLike) -> Column:
    """Sum that counts an empty group as zero."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def ratio(numerator: ColumnLike, denominator: ColumnLike, scale: int = 1,
          digits: int | None = None) -> Column:
    """`scale * numerator / denominator`, null when the denominator is zero.

    With `digits` the division is decimal and rounds half up, for amounts with at
    most two decimal places and for counts. Without it the result is a double.
    """
    if digits is None:
        return F.try_divide(col(numerator).cast("double") * F.lit(float(scale)),
                            col(denominator).cast("double"))
    quotient = F.try_divide(col(numerator).cast(_CENTS) * F.lit(scale),
                            col(denominator).cast(_CENTS))
    return F.round(quotient, digits)


def mean(numerator: ColumnLike, digits: int | None = None) -> Column:
    """Aggregate mean over the non-null values of an integer or amount column."""
    return ratio(F.sum(col(numerator)), F.count(col(numerator)), digits=digits)


def share_true(predicate: Column) -> Column:
    """Aggregate: fraction of rows for which a non-null predicate holds, as double."""
    return ratio(F.count_if(predicate), F.count(predicate))


def month_of(c: ColumnLike) -> Column:
    return F.trunc(col(c), "MM")


def month_index(c: ColumnLike) -> Column:
    """Months since year 0: differences of it are whole calendar months."""
    return F.year(col(c)) * 12 + F.month(col(c))


def status_filter(status: ColumnLike, status_in=None, status_not_in=None) -> Column:
    """Order filter; a null status never passes a filter and passes when there is none."""
    keep = F.lit(True)
    if status_in is not None:
        keep = keep & col(status).isin(*status_in)
    if status_not_in is not None:
        keep = keep & ~col(status).isin(*status_not_in)
    return keep


def report_edge(df: DataFrame) -> DataFrame:
    """Plain report types: ISO dates, doubles for amounts, 64-bit integers, no NaN."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, T.DoubleType):
            c = F.when(~F.isnan(c), c)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)
