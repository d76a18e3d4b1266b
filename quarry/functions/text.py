"""String functions (C1-C4, C15): all JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squash(text: Column | str) -> Column:
    """Lower-case and delete plain spaces (U+0020 only; tabs/newlines stay)."""
    return F.replace(F.lower(F.col(text) if isinstance(text, str) else text), F.lit(" "), F.lit(""))


def shingle_array(text: Column | str, k: int = 5) -> Column:
    """Distinct k-character substrings of ``squash(text)``; empty when shorter than k."""
    # One linear regex pass: a zero-width lookahead captures the k code points
    # starting at every position ('(?s)' lets '.' match newlines).  substring()
    # per position would rescan the UTF-8 prefix each time (quadratic per text).
    subs = F.regexp_extract_all(squash(text), F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))
    return F.array_distinct(subs)


def md5_32(s: Column | str) -> Column:
    """Stable 32-bit hash: the first 8 hex digits of md5, as a BIGINT in [0, 2^32)."""
    c = F.col(s) if isinstance(s, str) else s
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def md5_bucket(*cols: Column | str, modulus: int = 10, seed: str = "") -> Column:
    """Deterministic bucket in [0, modulus) from md5 of the '|'-joined key (same in DuckDB)."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    key = F.concat_ws("|", *parts) if not seed else F.concat_ws("|", F.lit(seed), *parts)
    return F.pmod(md5_32(key), F.lit(modulus))


def split_ws(text: Column | str) -> Column:
    """Split a trimmed line on runs of whitespace."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(F.trim(c), r"\s+")
