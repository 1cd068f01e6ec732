"""Rounding of averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_round(c: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the order in which an average was summed.

    Noise in the last bits is rounded away first, so a mean that is a tie on paper is one here.
    """
    return F.round(F.round(c, 9), digits)
