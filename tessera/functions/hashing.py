"""Hash columns shared by sketches, LSH and slice assignment.

All hashes are md5 slices of the value's string form, so the same number can
be computed in SQL by any engine with ``md5`` (the oracle uses DuckDB):

* ``h60(x)``: 15 hex digits = 60-bit non-negative BIGINT.
* ``h32(x)``: 8 hex digits = unsigned 32-bit value in a BIGINT.
* salts are prefixed as ``salt|...|x``.

``hash_fn="xxhash64"`` gives a faster JVM hash for production runs where no
SQL oracle is needed (63 bits kept, non-negative).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _salted(col: Column, salts) -> Column:
    parts = [F.lit(str(s)) for s in salts] + [col.cast("string")]
    return F.concat_ws("|", *parts) if salts else col.cast("string")


def h60(col: Column, *salts, hash_fn: str = "md5") -> Column:
    """60-bit non-negative hash of ``col`` (optionally salted)."""
    if hash_fn == "xxhash64":
        return F.xxhash64(*[F.lit(str(s)) for s in salts], col).bitwiseAND(F.lit((1 << 60) - 1))
    return F.conv(F.substring(F.md5(_salted(col, salts)), 1, 15), 16, 10).cast(
        "bigint"
    )


def h32(col: Column, *salts, offset: int = 0) -> Column:
    """Unsigned 32-bit hash; ``offset`` picks which 8 hex digits of the md5."""
    return F.conv(
        F.substring(F.md5(_salted(col, salts)), 1 + 8 * offset, 8), 16, 10
    ).cast("bigint")


def md5_hex(col: Column, *salts) -> Column:
    return F.md5(_salted(col, salts))


# ---- SQL twins (DuckDB dialect) used by the oracle strings -----------------


def _salted_sql(expr: str, salts) -> str:
    if not salts:
        return f"CAST({expr} AS VARCHAR)"
    prefix = "|".join(str(s) for s in salts) + "|"
    return f"('{prefix}' || CAST({expr} AS VARCHAR))"


def h60_sql(expr: str, *salts) -> str:
    return f"('0x' || substr(md5({_salted_sql(expr, salts)}), 1, 15))::BIGINT"


def h32_sql(expr: str, *salts, offset: int = 0) -> str:
    return (
        f"('0x' || substr(md5({_salted_sql(expr, salts)}), {1 + 8 * offset}, 8))"
        "::BIGINT"
    )
