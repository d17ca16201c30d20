"""Deterministic hash used by every split, shuffle and resample.

The first 60 bits of the MD5 digest of "key:seed". Any SQL engine has MD5, so
oracle texts can repeat it; key and seed both enter the digest, so two seeds
give unrelated orders and draws, and indexes up to 2**60 can be reached. Keys are any BIGINT; the few
equal hashes (about n**2 / 2**61 pairs) are ordered by the id itself by every caller.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 1 << 60
_UNIT = 1 << 52  # uniform numbers have 52 bits, so they are exact and below 1


def _as_col(v) -> Column:
    if isinstance(v, Column):
        return v.cast("long")
    if isinstance(v, str):
        return F.col(v).cast("long")
    return F.lit(int(v)).cast("long")


def portable_hash(key, seed=42) -> Column:
    """Integer in [0, 2**60); null for a null key."""
    text = F.concat(_as_col(key).cast("string"), F.lit(":"), _as_col(seed).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def portable_uniform(key, seed=42) -> Column:
    return F.shiftright(portable_hash(key, seed), 8) / F.lit(float(_UNIT))


def hash_sql(key: str, seed="42") -> str:
    """The same hash as a SQL expression (used by the oracle texts)."""
    return f"CAST('0x' || substr(md5(CAST({key} AS BIGINT) || ':' || CAST({seed} AS BIGINT)), 1, 15) AS BIGINT)"


def uniform_sql(key: str, seed="42") -> str:
    return f"(({hash_sql(key, seed)} >> 8) / {float(_UNIT)}::DOUBLE)"
