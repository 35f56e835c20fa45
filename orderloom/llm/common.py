"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
UNIT = 2.0**-53


def words(text: Column | str) -> Column:
    """Maximal runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    return F.array_remove(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), GAP), "")


def uniform(*parts: Column | int | str) -> Column:
    """A number in [0, 1) that depends on nothing but ``parts``."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(UNIT)


def same(left: Column, right: Column) -> Column:
    """Equality under which NULL equals NULL."""
    return left.eqNullSafe(right)


def keep_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` with ``new`` columns; a column of the same name, in any case, is replaced."""
    taken = {n.lower() for n in new}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[c.alias(n) for n, c in new.items()])


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
