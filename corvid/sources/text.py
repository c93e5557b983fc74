"""Text sources: comma-separated cells, adjacency lines and rating lines.

Every reader is ``spark.read.text`` (a splittable, column-pruned scan with
filter pushdown) followed by a parser that takes a one-column DataFrame of
lines (column ``value``). The parsers work on any DataFrame of lines, so
the same code reads files, streams, or lines that Spark derives from a
table. A line is split once and its tokens are parsed once (``once``),
whatever the checks and the projections above read of them.

The strict readers name the file and the line in the message of a failing
check: the file is a metadata column of the scan, read only where a line is bad.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvid.functions.columns import (check_rows, comma_tokens, long_or_null, not_long, once,
                                      token)

# ---------------------------------------------------------------- lines

FILE = "_corvid_file"  # name of the file column of ``read_lines(with_file=True)``


def read_lines(spark: SparkSession, path: str | list[str], with_file: bool = False) -> DataFrame:
    """Lines of one or more text files as column ``value``, with their file as
    a second column on request."""
    lines = spark.read.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias(FILE)) if with_file else lines


EXCERPT = 80  # characters of a bad line that its message shows


def _split_once(lines: DataFrame, col: str) -> DataFrame:
    """``_t``, the tokens of every line, with the beginning of the line and its
    file (if known) for messages."""
    file = F.col(FILE) if FILE in lines.columns else F.lit(None).cast("string")
    return lines.select(F.substring(F.col(col), 1, EXCERPT).alias("_line"), file.alias("_file"),
                        F.explode_outer(F.array(comma_tokens(F.col(col)))).alias("_t"))


def _place() -> Column:
    """Where a bad line comes from; evaluated for bad lines only."""
    return F.concat(F.lit(" in line '"), F.coalesce("_line", F.lit("")), F.lit("'"),
                    F.coalesce(F.concat(F.lit(" of "), F.col("_file")), F.lit("")))


def strip_headers(lines: DataFrame, col: str = "value") -> DataFrame:
    """Drop header lines (lines ending in ``:``).

    ``endswith`` on a text scan is pushed into the scan as a
    ``Not(StringEndsWith)`` filter."""
    return lines.where(~F.col(col).endswith(":"))


# ---------------------------------------------------------------- cells


def parse_cells(lines: DataFrame, col: str = "value") -> DataFrame:
    """``i,j,v`` lines -> ``(i LONG, j LONG, v DOUBLE)``.

    A line with a missing or non-numeric field fails the job (the reference
    readers throw on such input); negative indices are rejected too, since
    they have no block position.
    """
    t = F.col("_t")
    i, j, v = (F.trim(token(t, k)) for k in range(3))
    parsed = once(_split_once(lines, col), i.alias("_i"), j.alias("_j"), v.alias("_v"),
                  "_line", "_file", long_or_null(i).alias("i"), long_or_null(j).alias("j"),
                  v.try_cast("double").alias("v"))
    # a row filter, so the checks hold whatever columns are read
    good = check_rows(
        parsed, _unparsed("i", "_i", "row index"), _unparsed("j", "_j", "column index"),
        (F.col("v").isNull(), F.concat(F.lit("cell line without a numeric value: '"),
                                       F.coalesce("_v", F.lit("<missing>")), F.lit("'"))),
        ((F.col("i") < 0) | (F.col("j") < 0), F.concat(
            F.lit("negative cell index ("), F.col("_i"), F.lit(","), F.col("_j"), F.lit(")"))),
        where=_place())
    return good.select("i", "j", "v")


def _unparsed(value: str, raw: str, what: str) -> tuple[Column, Column]:
    """(condition, message) of a token that did not parse into column ``value``."""
    return F.col(value).isNull(), not_long(F.col(raw), what)[1]


def read_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_cells(read_lines(spark, path, with_file=True))


# ---------------------------------------------------------------- adjacency


def _neighbours(lines: DataFrame, mode: str, col: str) -> DataFrame:
    """``(id LONG, adj ARRAY<LONG>)`` of checked lines: the tokens parsed once,
    in ``prefix`` mode cut before the first that is not an integer."""
    if mode not in ("strict", "prefix"):
        raise ValueError(f"mode must be 'strict' or 'prefix', not {mode!r}")
    t = F.col("_t")
    tail = F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))
    parsed = once(_split_once(lines, col), token(t, 0).alias("_s"), tail.alias("_n"), "_line", "_file",
                  long_or_null(token(t, 0)).alias("id"), F.transform(tail, long_or_null).alias("adj"))
    bad = F.array_position(F.transform("adj", lambda x: x.isNull()), True)
    parsed = once(parsed, "id", "_s", "_n", "_line", "_file", "adj",
                  F.coalesce(bad, F.lit(0)).cast("int").alias("_bad"))
    checks = [_unparsed("id", "_s", "vertex id")]
    if mode == "strict":
        checks.append((F.col("_bad") > 0, F.concat(
            F.lit("not an integer neighbour: '"), F.get("_n", F.col("_bad") - 1), F.lit("'"))))
    good = check_rows(parsed, *checks, where=_place())
    if mode == "strict":
        return good.select("id", "adj")
    return good.select("id", F.when(F.col("_bad") == 0, F.col("adj")).otherwise(
        F.slice("adj", 1, F.greatest(F.col("_bad") - 1, F.lit(0)))).alias("adj"))


def parse_adjacency(lines: DataFrame, mode: str = "strict",
                    col: str = "value") -> DataFrame:
    """``id,n1,n2,...`` lines -> ``(id LONG, adj ARRAY<LONG>)``.

    ``strict``: empty tokens at the end of a line are dropped (JVM split),
    any other token that is not an integer fails the job.
    ``prefix``: neighbours are read up to the first token that is not an
    integer; the rest of the line is ignored (scanner-style reading).
    The id token must be an integer in both modes.

    For callers that want a line's neighbours together; ``parse_links`` gives
    them one to a row, which is all the graph operators need.
    """
    return _neighbours(lines, mode, col)


def parse_links(lines: DataFrame, mode: str = "strict", col: str = "value") -> DataFrame:
    """``id,n1,n2,...`` lines -> ``(id LONG, dst LONG)``, a row per neighbour,
    and one with a null ``dst`` for a line without any. Modes as in
    ``parse_adjacency``. Strict lines are exploded before they are parsed, so
    every token is a scalar of generated code; prefix lines need the place of
    their first bad token and are cut as arrays."""
    if mode != "strict":
        return _neighbours(lines, mode, col).select("id", F.explode_outer("adj").alias("dst"))
    t = F.col("_t")
    tail = F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))
    toks = _split_once(lines, col).select("_line", "_file", token(t, 0).alias("_s"),
                                          F.explode_outer(tail).alias("_d"))
    parsed = once(toks, "_s", "_d", "_line", "_file", long_or_null(F.col("_s")).alias("id"),
                  long_or_null(F.col("_d")).alias("dst"))
    bad, message = _unparsed("dst", "_d", "neighbour")
    return check_rows(parsed, _unparsed("id", "_s", "vertex id"),
                      (F.col("_d").isNotNull() & bad, message),
                      where=_place()).select("id", "dst")


def parse_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id,n1,n2,...`` lines (strict) -> ``(src LONG, dst LONG)``, a row per
    neighbour. A bare id gives no edge but is checked as well."""
    return (parse_links(lines, "strict", col).where("dst is not null")
            .select(F.col("id").alias("src"), "dst"))


def read_adjacency(spark: SparkSession, path: str | list[str],
                   mode: str = "strict") -> DataFrame:
    return parse_adjacency(read_lines(spark, path, with_file=True), mode=mode)


def read_links(spark: SparkSession, path: str | list[str], mode: str = "strict") -> DataFrame:
    return parse_links(read_lines(spark, path, with_file=True), mode=mode)


# ---------------------------------------------------------------- ratings

USER_TYPES = ("int", "bigint", "string")


def parse_ratings(lines: DataFrame, mode: str = "typed", user_type: str = "int",
                  col: str = "value") -> DataFrame:
    """Rating lines ``user,rating,date`` (with ``movie:`` header lines).

    ``typed``: delimited load with a typed prefix schema -> ``(user <user_type>,
    rating DOUBLE)``; fields that do not parse (header lines, junk) become
    NULL, extra fields are ignored. Header lines survive here and are removed
    by the ``rating > 0`` filter of the histogram.
    ``raw``: header lines removed by suffix, both fields kept as strings ->
    ``(user STRING, rating STRING)``.
    """
    if mode == "typed":
        if user_type not in USER_TYPES:
            raise ValueError(f"user_type must be one of {USER_TYPES}, not {user_type!r}")
        t = lines.select(F.split(F.col(col), ",").alias("_t"))
        return t.select(
            F.expr(f"try_cast(get(_t, 0) as {user_type})").alias("user"),
            F.expr("try_cast(get(_t, 1) as double)").alias("rating"))
    if mode == "raw":
        t = strip_headers(lines, col).select(F.split(F.col(col), ",").alias("_t"))
        return t.select(token(F.col("_t"), 0).alias("user"),
                        token(F.col("_t"), 1).alias("rating"))
    raise ValueError(f"mode must be 'typed' or 'raw', not {mode!r}")


def read_ratings(spark: SparkSession, path: str | list[str], mode: str = "typed",
                 user_type: str = "int") -> DataFrame:
    return parse_ratings(read_lines(spark, path), mode=mode, user_type=user_type)


REJECTS = ("header", "no_rating", "bad_rating", "bad_user", "not_positive")


def observe_rejects(lines: DataFrame, observation: Observation, user_type: str = "int",
                    col: str = "value") -> DataFrame:
    """``lines`` unchanged, counted on their way by the cause for which the
    typed histogram leaves them out, the first that holds: ``header`` (ends in
    ``:``), ``no_rating`` (no second field), ``bad_rating`` (not a number),
    ``not_positive`` (zero, negative; NaN counts as positive, as in the
    histogram), and ``bad_user`` (kept, in the NULL user group). ``lines`` is
    the number of all. The counts are metrics of the pass that reads the lines,
    whichever action that is, and cost no scan of their own:
    ``observation.get`` after it. A map task that must run again because its
    output was lost is counted again.
    """
    if user_type not in USER_TYPES:
        raise ValueError(f"user_type must be one of {USER_TYPES}, not {user_type!r}")
    tokens = F.split(F.col(col), ",")
    user = F.get(tokens, 0).try_cast(user_type)
    rating = F.get(tokens, 1)
    number = rating.try_cast("double")
    cause = (F.when(F.col(col).isNull() | F.col(col).endswith(":"), "header")
             .when(rating.isNull(), "no_rating").when(number.isNull(), "bad_rating")
             .when(~(number > 0), "not_positive").when(user.isNull(), "bad_user"))
    # evaluated once for all counts
    marked = lines.select(F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias("_line"),
                          F.explode_outer(F.array(cause)).alias("_cause"))
    counted = marked.observe(observation, F.count(F.lit(1)).alias("lines"),
                             *[F.count_if(F.col("_cause") == c).alias(c) for c in REJECTS])
    return counted.select("_line.*")
