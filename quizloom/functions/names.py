"""Column names of a step's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str, also: list[str] | None = None) -> list[str]:
    """Names like those given that no column of df, and none of also, has, whatever their case."""
    taken, out = {c.lower() for c in [*df.columns, *(also or [])]}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out
