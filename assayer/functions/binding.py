"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value`` as a lambda variable: written and evaluated once.

    Plain substitution would copy ``value`` to every place ``body`` uses it.
    """
    return F.get(F.transform(F.array(value), lambda named: body(named)), 0)
