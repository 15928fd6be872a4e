"""Expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value evaluated once a row, however often f names it and in whatever lambda."""
    return F.transform(F.array(value), f)[0]
