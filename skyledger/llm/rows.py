"""Helper columns beside whatever columns a table already has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` has them."""
    taken, spare = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        spare.append(name)
    return spare


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever signs their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
