"""Replayable pseudo-random draws keyed on a row's identity.

``rand(seed)`` depends on how rows are spread over partitions, so a retried
or re-planned job can draw different numbers. These draws are a pure
function of ``(key, seed)``: the same row gets the same number on any
cluster size, after any executor loss, and in the DuckDB oracle, which
evaluates the identical integer arithmetic (``sql_draw``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col_of

# Modulus 2^31 - 1 and the MINSTD multiplier. All products stay
# below 2^63, so ANSI overflow checks never fire.
P = 2147483647
A = 48271
B = 69621
C = 12345


def draw_int(key, seed: int = 46) -> Column:
    """Integer in [0, P) mixed from ``key`` (an integral column) and ``seed``."""
    key = col_of(key).cast("long")
    # both halves of the key: keys that agree modulo P draw apart (a shift by 31)
    k, high = F.pmod(key, F.lit(P)), F.pmod(F.shiftright(key, 31), F.lit(P))
    h1 = F.pmod(k * F.lit(A) + high * F.lit(B) + F.lit(int(seed) % P), F.lit(P))
    h2 = F.pmod(h1 * h1 + F.lit(C), F.lit(P))
    return F.pmod(h2 * F.lit(A) + h1, F.lit(P))


def draw_uniform(key, seed: int = 46) -> Column:
    """Uniform double in [0, 1)."""
    return draw_int(key, seed).cast("double") / F.lit(float(P))


def sql_draw_int(key_sql: str, seed: int = 46) -> str:
    """The same draw as DuckDB SQL text (for oracles)."""
    k = f"((({key_sql}) % {P} + {P}) % {P})"
    high = f"(((CAST({key_sql} AS BIGINT) >> 31) % {P} + {P}) % {P})"
    h1 = f"(({k} * {A} + {high} * {B} + {int(seed) % P}) % {P})"
    h2 = f"(({h1} * {h1} + {C}) % {P})"
    return f"(({h2} * {A} + {h1}) % {P})"


def sql_draw_uniform(key_sql: str, seed: int = 46) -> str:
    return f"(CAST({sql_draw_int(key_sql, seed)} AS DOUBLE) / {float(P)})"
