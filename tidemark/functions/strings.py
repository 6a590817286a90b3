"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strtok_to_array(text: Column | str, delimiters: str = " ") -> Column:
    """The tokens between any of the delimiter characters; delimiters side by side give no empty token."""
    column = F.col(text) if isinstance(text, str) else text
    one = F.translate(column, delimiters, delimiters[0] * len(delimiters))
    return F.filter(F.split(one, "\\Q" + delimiters[0] + "\\E"), lambda token: token != "")


def strtok(text: Column | str, delimiters: str = " ", n: int = 1) -> Column:
    """Token `n`, from 1; NULL where there are fewer."""
    return F.get(strtok_to_array(text, delimiters), F.lit(n - 1))
