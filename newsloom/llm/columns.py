"""Building blocks for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once; in a lambda a column would be computed anew for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """A column name that a table does not have, whatever the case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
