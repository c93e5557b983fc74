"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from corvid.functions.columns import (  # noqa: F401
    block_index,
    block_offset,
    check_rows,
    comma_tokens,
    fixed3,
    long_or_null,
    strict_long,
    token,
    trunc_to_int,
)
