"""Block addition of sparse matrices.

A matrix is a DataFrame of cells ``(i, j, v)``. A block matrix is the same
cells keyed by block coordinate and in-block offset ``(bi, bj, oi, oj, v)``.
Addition of sparse blocks is one union and one aggregate keyed by cell, so it
costs a single shuffle with map-side partial aggregation. Full blocks are
added as positional arrays (``block_arrays``, ``add_block_arrays``): one row
and one array addition for ``rows * cols`` cells; ``matrix_add_blocks`` picks
the form by the share of stored cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.columns import block_index, block_offset, check_rows, fixed3

ROWS = 100  # fixed value: block height
COLS = 100  # fixed value: block width

DUPLICATE_POLICIES = ("error", "sum", "max")


def block_coords(cells: DataFrame, rows: int = ROWS, cols: int = COLS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(i, j, v)`` -> ``(bi, bj, oi, oj, v)`` (plus the ``keep`` columns)."""
    return cells.select(
        block_index("i", rows).alias("bi"), block_index("j", cols).alias("bj"),
        block_offset("i", rows).alias("oi"), block_offset("j", cols).alias("oj"),
        F.col("v"), *keep)


def _cell_text() -> F.Column:
    return F.concat(F.lit("("), F.col("i").cast("string"), F.lit(","),
                    F.col("j").cast("string"), F.lit(")"))


def _duplicate(count_col: str, which: str) -> tuple[F.Column, F.Column]:
    return F.col(count_col) > 1, F.concat(
        F.lit(f"duplicate cell in {which}: "), _cell_text(), F.lit(" appears "),
        F.col(count_col).cast("string"), F.lit(" times"))


def _negative() -> tuple[F.Column, F.Column]:
    return ((F.col("i") < 0) | (F.col("j") < 0),
            F.concat(F.lit("negative cell index "), _cell_text()))


def resolve_duplicates(cells: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """One row per ``(i, j)``: ``error`` fails the job on a repeated cell,
    ``sum`` adds the copies, ``max`` keeps the largest."""
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    agg = F.max("v") if on_duplicate == "max" else F.sum("v")
    g = cells.groupBy("i", "j").agg(agg.alias("v"), F.count(F.lit(1)).alias("c"))
    if on_duplicate == "error":
        g = check_rows(g, _duplicate("c", "matrix"))
    return g.select("i", "j", "v")


def block_assemble(cells: DataFrame, rows: int = ROWS, cols: int = COLS,
                   on_duplicate: str = "error") -> DataFrame:
    """Summary of the blocks a matrix falls into: ``(bi, bj, nnz, total)``
    with ``nnz`` the stored cells of the block and ``total`` their sum."""
    c = cells if on_duplicate is None else resolve_duplicates(cells, on_duplicate)
    return (block_coords(c, rows, cols).groupBy("bi", "bj")
            .agg(F.count(F.lit(1)).alias("nnz"), F.sum("v").alias("total")))


def matrix_add(m: DataFrame, n: DataFrame, how: str = "outer",
               on_duplicate: str = "error", rows: int = ROWS,
               cols: int = COLS) -> DataFrame:
    """``R = M + N`` in block form ``(bi, bj, oi, oj, v)``.

    ``outer``: every block present in either input is kept (a cell present
    in one input only keeps its value).
    ``inner``: only blocks present in both inputs are kept; inside such a
    block every cell of either input is kept.
    Repeated cells inside one input are resolved by ``on_duplicate`` before
    the addition; all of it happens in the one cell-keyed aggregate. In both
    forms every cell of both inputs is checked (repeats under ``error``,
    negative indices always), also those of blocks that ``inner`` drops.
    """
    if how not in ("outer", "inner"):
        raise ValueError(f"how must be 'outer' or 'inner', not {how!r}")
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    tagged = (m.select("i", "j", "v", F.lit(True).alias("in_m"))
              .unionByName(n.select("i", "j", "v", F.lit(False).alias("in_m"))))
    in_m, in_n = F.col("in_m"), ~F.col("in_m")
    if on_duplicate == "max":
        vm, vn = F.max(F.when(in_m, F.col("v"))), F.max(F.when(in_n, F.col("v")))
        value = F.coalesce(vm, F.lit(0.0)) + F.coalesce(vn, F.lit(0.0))
    else:
        value = F.sum("v")
    cells = tagged.groupBy("i", "j").agg(
        value.alias("v"),
        F.count_if(in_m).alias("cm"), F.count_if(in_n).alias("cn"))
    checks = [_negative()]
    if on_duplicate == "error":
        checks += [_duplicate("cm", "M"), _duplicate("cn", "N")]
    result = block_coords(check_rows(cells, *checks), rows, cols, ("cm", "cn"))
    if how == "inner":
        # a block survives when both inputs own one of its cells; it holds at
        # most rows * cols cells, so the window over a block is bounded
        block = Window.partitionBy("bi", "bj")
        result = (result.withColumn("_m", F.max("cm").over(block))
                  .withColumn("_n", F.max("cn").over(block))
                  .where((F.col("_m") > 0) & (F.col("_n") > 0)))
    return result.select("bi", "bj", "oi", "oj", "v")


def render_dense(blocks: DataFrame, rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """Text rows of every dense block: ``(bi, bj, oi, line)``, ``line`` being
    the ``cols`` values of block row ``oi`` as ``%.3f`` joined by tabs, zeros
    where no cell is stored. Input: unique cells in block form; an offset
    outside the block fails the job.

    Two bounded groupings, no join: the stored cells of a block row (at most
    ``cols``) become its line; the lines of a block (at most ``rows``) are
    gathered, and the block's ``rows`` row numbers are generated in place,
    rows without stored cells taking the constant zero line.
    """
    zero = fixed3(F.lit(0.0))
    inside = F.col("oi").between(0, rows - 1) & F.col("oj").between(0, cols - 1)
    blocks = check_rows(blocks, (~F.coalesce(inside, F.lit(False)), F.concat(
        F.lit("offset outside the block: ("), F.coalesce(F.col("oi").cast("string"), F.lit("null")),
        F.lit(","), F.coalesce(F.col("oj").cast("string"), F.lit("null")), F.lit(")"))))
    # one exchange on the block serves both groupings (collecting gains
    # nothing from map-side partial aggregation; a block holds at most
    # rows * cols cells). Stored cells are formatted before they are
    # collected (inside codegen).
    per_row = (blocks.repartition("bi", "bj").groupBy("bi", "bj", "oi")
               .agg(F.map_from_entries(F.collect_list(F.struct("oj", fixed3(F.col("v")))))
                    .alias("m")))
    line = F.array_join(F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long")),
        lambda c: F.coalesce(F.try_element_at(F.col("m"), c), zero)), "\t")
    per_block = (per_row.select("bi", "bj", F.struct("oi", line.alias("line")).alias("r"))
                 .groupBy("bi", "bj").agg(F.map_from_entries(F.collect_list("r")).alias("lines")))
    zero_line = F.array_join(F.array_repeat(zero, cols), "\t")
    return (per_block
            .select("bi", "bj", "lines", F.explode(F.sequence(
                F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))).alias("oi"))
            .select("bi", "bj", "oi",
                    F.coalesce(F.try_element_at(F.col("lines"), F.col("oi")), zero_line)
                    .alias("line")))


def _inside(rows: int, cols: int) -> F.Column:
    return F.coalesce(F.col("oi").between(0, rows - 1) & F.col("oj").between(0, cols - 1), F.lit(False))


def block_arrays(blocks: DataFrame, rows: int = ROWS, cols: int = COLS,
                 on_duplicate: str = "error") -> DataFrame:
    """Blocks as positional arrays ``(bi, bj, values ARRAY<DOUBLE>)``, row by
    row, NULL where no cell is stored. Input: block form ``(bi, bj, oi, oj,
    v)``; an offset outside the block fails the job, repeated cells are
    resolved by ``on_duplicate``, a NULL value counts as no cell.

    One exchange, on the block: its cells (at most ``rows * cols`` different
    ones) are sorted by position, and the gaps between neighbours are filled
    in one pass over them. The partitioning by block stays, so an addition of
    two such tables moves nothing more.
    """
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    checked = check_rows(blocks, (~_inside(rows, cols), F.lit("offset outside the block")))
    at = (F.col("oi") * cols + F.col("oj")).cast("int").alias("at")
    placed = (checked.where("v is not null").repartition("bi", "bj")
              .groupBy("bi", "bj", at)
              .agg((F.max if on_duplicate == "max" else F.sum)("v").alias("v"),
                   F.count(F.lit(1)).alias("c")))
    if on_duplicate == "error":
        placed = check_rows(placed, (F.col("c") > 1, F.concat(
            F.lit("duplicate cell at position "), F.col("at").cast("string"), F.lit(" of block ("),
            F.col("bi").cast("string"), F.lit(","), F.col("bj").cast("string"), F.lit(")"))))
    stored = (placed.groupBy("bi", "bj")
              .agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("e")))
    before = F.concat(F.array(F.lit(-1)), F.slice(F.transform("e", lambda x: x["at"]), 1,
                                                  F.size("e") - 1))
    none = F.lit(None).cast("double")
    filled = F.flatten(F.zip_with("e", before, lambda x, p: F.concat(
        F.array_repeat(none, x["at"] - p - 1), F.array(x["v"]))))
    rest = F.array_repeat(none, F.lit(rows * cols - 1) - F.element_at("e", -1)["at"])
    return stored.select("bi", "bj", F.concat(filled, rest).alias("values"))


def dense_blocks(blocks: DataFrame, rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """Numeric dense blocks ``(bi, bj, values ARRAY<DOUBLE>)``, row by row,
    zeros where no cell is stored (``rows * cols`` values a block)."""
    arrays = block_arrays(blocks, rows, cols)
    return arrays.select("bi", "bj", F.transform(
        "values", lambda v: F.coalesce(v, F.lit(0.0))).alias("values"))


def add_block_arrays(m: DataFrame, n: DataFrame, how: str = "outer") -> DataFrame:
    """Element-wise sum of two tables of ``block_arrays``: block meets block
    (one row each), array is added to array. A position stored in neither
    input stays NULL. ``inner`` keeps the blocks of both inputs only."""
    if how not in ("outer", "inner"):
        raise ValueError(f"how must be 'outer' or 'inner', not {how!r}")
    both = (m.withColumnRenamed("values", "_m").hint("merge")
            .join(n.withColumnRenamed("values", "_n"), ["bi", "bj"],
                  "full" if how == "outer" else "inner"))
    added = F.zip_with("_m", "_n", lambda x, y: F.when(x.isNull() & y.isNull(), None).otherwise(
        F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))))
    return both.select("bi", "bj", F.when(F.col("_m").isNull(), F.col("_n"))
                       .when(F.col("_n").isNull(), F.col("_m")).otherwise(added).alias("values"))


def cells_from_arrays(arrays: DataFrame, cols: int = COLS) -> DataFrame:
    """Positional arrays back to block form ``(bi, bj, oi, oj, v)``."""
    return (arrays.select("bi", "bj", F.posexplode_outer("values").alias("_at", "v"))
            .where("v is not null")
            .select("bi", "bj", F.expr(f"_at div {int(cols)}").alias("oi"),
                    (F.col("_at") % cols).cast("long").alias("oj"), "v"))


FULL = 0.5  # share of stored cells from which blocks are added as arrays


def fill(cells: DataFrame, rows: int = ROWS, cols: int = COLS) -> float:
    """Mean share of the positions of a block that hold a cell, over the
    blocks that hold any: one aggregate of per-block counts."""
    per_block = (block_coords(cells, rows, cols).groupBy("bi", "bj")
                 .agg(F.count(F.lit(1)).alias("c")))
    cells_, blocks = per_block.agg(F.sum("c"), F.count(F.lit(1))).first()
    return (cells_ or 0) / (blocks * rows * cols) if blocks else 0.0


def matrix_add_blocks(m: DataFrame, n: DataFrame, how: str = "outer", on_duplicate: str = "error",
                      rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """``matrix_add`` in the form that fits the inputs: where the blocks of
    both are full (``FULL``) as arrays, one row and one addition per block
    instead of one per cell, otherwise cell by cell. Same result."""
    if min(fill(m, rows, cols), fill(n, rows, cols)) < FULL:
        return matrix_add(m, n, how, on_duplicate, rows, cols)
    arrays = [block_arrays(block_coords(check_rows(x, _negative()), rows, cols), rows, cols,
                           on_duplicate) for x in (m, n)]
    return cells_from_arrays(add_block_arrays(*arrays, how=how), cols)


def cells_from_blocks(blocks: DataFrame, rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """Block form back to ``(i, j, v)``."""
    return blocks.select((F.col("bi") * rows + F.col("oi")).alias("i"),
                         (F.col("bj") * cols + F.col("oj")).alias("j"), "v")
