"""Draws that depend on a tag and a key alone, so that any engine gives the same ones."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(tag: str, key: Column, below: int) -> Column:
    """A whole number in [0, below)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{tag}|"), key.cast("string")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % below


def weighted(tag: str, key: Column, weights: dict[str, int]) -> Column:
    """One of the names, by weights that add up to 100."""
    d, upto, out = draw(tag, key, 100), 0, None
    for name, w in weights.items():
        upto += w
        out = F.when(d < upto, name) if out is None else out.when(d < upto, name)
    return out
