"""Multi-grain marts: several record types in one wide, typed table."""

from __future__ import annotations

from functools import reduce
from typing import Sequence, Tuple

from pyspark.sql import DataFrame

Spec = Sequence[Tuple[str, str]]


def conform(df: DataFrame, spec: Spec, **exprs: str) -> DataFrame:
    """Project ``df`` onto the mart contract ``spec`` [(name, type), ...].

    A column comes from the SQL expression ``exprs[name]`` if given, else from
    ``df`` when present, else is a typed null.  Every output column is cast to
    its contract type.  One projection, built from SQL text in a single call.
    """
    have = set(df.columns)
    cols = []
    for name, dtype in spec:
        if name in exprs:
            src = exprs[name]
        elif name in have:
            src = f"`{name}`"
        else:
            src = "NULL"
        cols.append(f"CAST({src} AS {dtype}) AS `{name}`")
    return df.selectExpr(*cols)


def union_records(parts: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` of conformed parts (same columns, same order)."""
    return reduce(lambda a, b: a.unionByName(b), parts)
