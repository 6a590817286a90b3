"""Row hashes for change detection and for hash keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def text(value: Column | str) -> Column:
    """The text form that a hash reads; cast numbers to a decimal first."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def diff_hash(
    cols: Iterable[Column | str],
    algo: str = "md5",
    sep: str = "",
    null_token: str | None = None,
    upper: bool = False,
    trim: bool = False,
) -> Column:
    """Hash of several columns.

    With `null_token=None` a NULL in any column makes the hash NULL, and a NULL hash compares
    as unknown. With a token each NULL is replaced by it, so every row has a hash. Without a
    separator, neighbouring values can run together.
    """
    parts = [text(c) for c in cols]
    if trim:
        parts = [F.trim(p) for p in parts]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    pieces = [p for part in parts for p in (F.lit(sep), part)][1:] if sep else parts
    joined = F.concat(*pieces)
    if upper:
        joined = F.upper(joined)
    if algo == "md5":
        return F.md5(joined)
    if algo == "sha1":
        return F.sha1(joined)
    raise ValueError(f"unknown hash algorithm: {algo}")


def vault_hash(*cols: Column | str) -> Column:
    """Binary SHA-1 over trimmed, upper-cased values, `x` for NULL, `^` between values."""
    return F.unhex(diff_hash(cols, algo="sha1", sep="^", null_token="x", upper=True, trim=True))
