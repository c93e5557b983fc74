"""Scalar column expressions shared by the operators.

Everything here builds a ``Column`` from built-in functions, so it stays
inside whole-stage codegen. Catalyst prunes and pushes such expressions, and
where one is used several times it may write it out as often; ``once`` is the
barrier for those that should not be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df.select(*columns)`` whose columns are evaluated once for each row,
    however often they are used. The row is generated from an array of one
    struct: neither are expressions merged across a generator, nor filters on
    what it generates pushed below it (a plain projection would be written out
    again for every use in a filter above it)."""
    return (df.select(F.explode_outer(F.array(F.struct(*columns))).alias("_once"))
            .select("_once.*"))


def comma_tokens(text: Column, drop_trailing_empty: bool = True) -> Column:
    """Split a line on commas.

    With ``drop_trailing_empty`` the result follows the JVM ``String.split``
    rule: empty tokens at the end of the line are removed, empty tokens in
    the middle stay (Spark's ``split`` alone keeps both).
    """
    if drop_trailing_empty:
        text = F.rtrim(text, F.lit(","))
    return F.split(text, ",")


def token(tokens: Column, k: int) -> Column:
    """k-th token (0-based), NULL when the line is shorter (never raises)."""
    return F.get(tokens, k)


def long_or_null(tok: Column) -> Column:
    """A token as LONG when it is an optional sign and digits that fit in 64
    bits, else NULL (whatever the session's ANSI setting). The cast alone
    would also take blanks around the number: the first character must be a
    sign or digit, the last a digit."""
    first, last = F.ascii(tok), F.ascii(F.substring(tok, -1, 1))
    plain = ((first.between(ord("0"), ord("9")) | first.isin(ord("+"), ord("-")))
             & last.between(ord("0"), ord("9")))
    return F.when(plain, tok.try_cast("long"))


def not_long(tok: Column, what: str = "token") -> tuple[Column, Column]:
    """(condition, message) of a token that is not an integer."""
    return long_or_null(tok).isNull(), F.concat(
        F.lit(f"not an integer {what}: '"), F.coalesce(tok, F.lit("<missing>")), F.lit("'"))


def strict_long(tok: Column, what: str = "token") -> Column:
    """Parse a token as LONG; anything else fails the job."""
    bad, message = not_long(tok, what)
    return F.when(bad, F.raise_error(message)).otherwise(long_or_null(tok))


INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1


def trunc_to_int(x: Column) -> Column:
    """Double -> INT as a Java ``(int)`` cast: truncated toward zero, values
    beyond the range saturate, NaN gives 0."""
    return (F.when(F.isnan(x), 0).when(x >= INT_MAX, INT_MAX).when(x <= INT_MIN, INT_MIN)
            .otherwise(x.try_cast("int")))


def block_index(name: str, size: int) -> Column:
    """Block coordinate of an index column: integral (truncating) division,
    exact for all LONG values (no detour through DOUBLE)."""
    return F.expr(f"`{name}` div {int(size)}")


def block_offset(name: str, size: int) -> Column:
    """Offset of an index column inside its block (remainder)."""
    return (F.col(name) % F.lit(int(size))).cast("long")


def fixed3(v: Column) -> Column:
    """Render a double with three decimals (JVM ``%.3f``, HALF_UP)."""
    return F.format_string("%.3f", v)


def check_rows(df: DataFrame, *checks: tuple[Column, Column],
               where: Column | None = None) -> DataFrame:
    """Fail the job when a row meets a condition; ``checks`` are (condition,
    message), ``where`` (a place in the input) is added to every message. The
    check is a row filter, so no projection or count over the result can do
    without it."""
    ok = F.lit(True)
    for bad, message in reversed(checks):
        if where is not None:
            message = F.concat(message, F.coalesce(where, F.lit("")))
        ok = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(ok)
    return df.where(ok)
