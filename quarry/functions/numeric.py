"""Integer arithmetic with the reference's rounding rules, in bigint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_div(a: Column | str, b: Column | str) -> Column:
    """Integer division truncating toward zero (SQL `div`)."""
    return F.call_function("div", _col(a), _col(b))


def sq_distance(x1: Column | str, y1: Column | str, x2: Column | str, y2: Column | str) -> Column:
    """Squared distance of two integer points (no square root), exact in bigint."""
    dx = _col(x1) - _col(x2)
    dy = _col(y1) - _col(y2)
    return dx * dx + dy * dy


def exact_mean_sql(name: str) -> str:
    """SQL text of the mean of a column of doubles, the same whatever order they
    are added in.

    Every value is cut in two whole numbers, its 2**-20ths and the rest in
    2**-80ths; those are summed as decimals, which is exact, and the mean is taken
    from the two sums once. (`avg` adds doubles as they come, so a mean near a
    rounding boundary depends on how rows were dealt to tasks.) Values from
    2**42 on, infinities and NaN are left to `avg`."""
    c = "`" + name.replace("`", "``") + "`"
    plain = f"(abs({c}) < {2 ** 42}D)"               # not for NaN: it is above all numbers
    scaled = f"(CASE WHEN {plain} THEN {c} END * {2 ** 20}D)"
    upper = f"floor({scaled})"
    lower = f"floor(({scaled} - CAST({upper} AS DOUBLE)) * {2 ** 60}D)"
    sums = [f"CAST(sum(CAST({part} AS DECIMAL(20,0))) AS DOUBLE)" for part in (upper, lower)]
    mean = f"({sums[0]} + {sums[1]} / {2 ** 60}D) / {2 ** 20}D / nullif(count({c}), 0)"
    return f"CASE WHEN bool_and(coalesce({plain}, true)) THEN {mean} ELSE avg({c}) END"


def exact_mean(name: str) -> Column:
    return F.expr(exact_mean_sql(name))
