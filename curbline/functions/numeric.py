"""Numeric expressions: decimal rounding, order-independent sums, safe ratios.

Every helper returns a Spark SQL expression as text, for ``F.expr``,
``selectExpr`` or ``where``.

Adding doubles in a different order changes the last bits, so two runs of one
job can disagree. Sums here are taken in a wide decimal, which gives the same
answer however Spark splits the work; nothing is rounded to output places on
the way in.
"""

from __future__ import annotations

# The accumulator: 26 digits before the point, and 12 behind it, far finer than any output.
ACCUMULATOR = "decimal(38, 12)"
# Beyond this, a double times a power of ten no longer fits a long.
PRIMITIVE_LIMIT = "1e13D"


def round_to(x: str, places: int) -> str:
    """Round a double half away from zero.

    ``round`` on doubles goes through BigDecimal for every row; it is left for
    values too large for primitive arithmetic.
    """
    near = f"signum({x}) * cast(floor(abs({x}) * 1e{places}D + 0.5D) as double) / 1e{places}D"
    return f"case when abs({x}) < {PRIMITIVE_LIMIT} then {near} else round(cast({x} as double), {places}) end"


def exact_sum(x: str, over: str = "") -> str:
    """Sum that does not depend on task order; NULL for an all-NULL group.

    A group with a value or total that the accumulator cannot hold (NaN,
    infinities, 1e26 and more) gets the plain double sum. ``over`` is the text
    of a window clause, for a window sum.
    """
    window = f" over ({over})" if over else ""
    held = f"try_cast({x} as {ACCUMULATOR})"
    plain = f"sum(cast({x} as double)){window}"
    # max() of a flag costs less than the two counts that would tell the same; it is NULL for an all-NULL group.
    odd = f"max({x} is not null and {held} is null){window}"
    return f"case when {odd} then {plain} else coalesce(cast(try_sum({held}){window} as double), {plain}) end"


def exact_avg(x: str, over: str = "") -> str:
    """Mean of the non-NULL values, built on :func:`exact_sum`."""
    window = f" over ({over})" if over else ""
    return f"({exact_sum(x, over)}) / nullif(count({x}){window}, 0)"


def exact_avg_of_two(x: str, over_x: str, y: str, over_y: str) -> tuple[list[str], str]:
    """Mean of the non-NULL values of two window sums that share no row: the columns to select, and the mean of them.

    The values are those of :func:`exact_avg` over all rows at once. Totals are added with a digit to spare;
    from 1e25 on, the last of the twelve decimal places may be rounded.
    """
    columns = []
    for part, value, over in (("1", x, over_x), ("2", y, over_y)):
        held = f"try_cast({value} as {ACCUMULATOR})"
        columns += [
            f"count({value}) over ({over}) as _n{part}",
            f"coalesce(max({value} is not null and {held} is null) over ({over}), false) as _odd{part}",
            f"coalesce(sum(cast({value} as double)) over ({over}), 0D) as _plain{part}",
            f"try_sum({held}) over ({over}) as _held{part}",
        ]
    one, two = (f"case when _n{i} = 0 then cast(0 as {ACCUMULATOR}) else _held{i} end" for i in "12")
    spare = "decimal(37, 12)"
    total = (f"coalesce(cast(try_cast({one} as {spare}) + try_cast({two} as {spare}) as double), "
             f"cast(try_add({one}, {two}) as double), _plain1 + _plain2)")
    return columns, f"(case when _odd1 or _odd2 then _plain1 + _plain2 else {total} end) / nullif(_n1 + _n2, 0)"


def ratio_if_positive(num: str, den: str) -> str:
    """num / den where den > 0, else NULL."""
    return f"case when {den} > 0 then {num} / {den} end"
