"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    Inside a CASE or a lambda Spark evaluates a repeated sub-expression at each
    of its uses; the element of a one-element array is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_and_kept(value: Column, keep: Callable[[Column], Column]) -> Column:
    """A generator of the value for the rows where ``keep(value)`` holds.

    A filter over a computed column is pushed below it and computes it again; a
    generated column is computed once.
    """
    return F.explode(F.filter(F.array(value), keep))
