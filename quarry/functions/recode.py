"""Respondent recodes and activity sums (built-in `when`, not UDFs, so the
filter on `telfs` still reaches the scan)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.fixed import (
    ACTIVE, ACTIVE_MAX_AGE, ELDER, FEMALE, MALE, MALE_CODE, MINUTES_PER_HOUR, NOT_WORKING, WORKING,
    WORKING_MAX_STATUS, WORKING_MIN_STATUS, YOUNG, YOUNG_MAX_AGE,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def working_status(telfs: Column | str = "telfs") -> Column:
    """"working" when 1 <= telfs < 3, else "not working"."""
    t = _col(telfs)
    return (F.when((t >= WORKING_MIN_STATUS) & (t < WORKING_MAX_STATUS), F.lit(WORKING))
            .otherwise(F.lit(NOT_WORKING)))


def sex_label(tesex: Column | str = "tesex") -> Column:
    """"male" when tesex = 1, else "female"."""
    return F.when(_col(tesex) == MALE_CODE, F.lit(MALE)).otherwise(F.lit(FEMALE))


def age_group(teage: Column | str = "teage") -> Column:
    """"young" up to 22, "active" up to 55, else "elder" (no lower bound)."""
    a = _col(teage)
    return (F.when(a <= YOUNG_MAX_AGE, F.lit(YOUNG))
            .when(a <= ACTIVE_MAX_AGE, F.lit(ACTIVE))
            .otherwise(F.lit(ELDER)))


def hours_sum(columns: Sequence[str], group: str) -> Column:
    """Sum of the columns in hours: each divided by 60 first, then added left
    to right (so every row's value is the same double as the reference's)."""
    if not columns:
        raise ValueError(f"column group '{group}' is empty")
    return reduce(add, [F.col(c) / F.lit(MINUTES_PER_HOUR) for c in columns])
