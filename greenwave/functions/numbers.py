"""Exact decimal arithmetic on integers, so results do not depend on row order.

A sum of doubles changes in its last bit with the order in which partitions
arrive, which flips rounding ties. Readings are therefore carried as integers
(ten-thousandths) and averaged with integer half-up rounding; what does not fit, further
decimals and huge values, is carried beside them as a double.
"""

FIXED_UNIT = 10_000
LIMIT = 1_000_000


def to_fixed(value: str) -> str:
    """Double to a bigint count of ten-thousandths; 0 from a million on, infinite or NaN."""
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN abs({value}) < {LIMIT}D "
        f"THEN CAST(round({value} * {FIXED_UNIT}D) AS BIGINT) ELSE 0L END"
    )


def beyond_fixed(value: str) -> str:
    """What ``to_fixed`` leaves of a double: further decimals, or all of it from a million on, infinite or NaN.

    It is exactly 0 for values of up to four decimals. Both parts together are the value, so a mean has
    the digits that ``avg`` has, and the large part of its sum does not depend on row order.
    """
    left = f"{value} - CAST(round({value} * {FIXED_UNIT}D) AS BIGINT) / {FIXED_UNIT}D"
    return f"CASE WHEN {value} IS NULL THEN 0D WHEN abs({value}) < {LIMIT}D THEN {left} ELSE {value} END"


def ratio_half_up(numerator: str, denominator: str) -> str:
    """Bigint ratio rounded half up to a bigint; NULL for a zero denominator."""
    shifted = f"(2 * ({numerator}) + ({denominator}))"
    twice = f"(2 * nullif({denominator}, 0))"
    return f"(({shifted} - pmod({shifted}, {twice})) div {twice})"


def hundredths(units: str) -> str:
    """A count of hundredths as a double with two decimals."""
    return f"(({units}) / 100D)"


def plain_decimal(value: str) -> str:
    """A two-decimal double as text with at least one decimal and never an exponent."""
    return f"regexp_replace(CAST(CAST({value} AS DECIMAL(30, 2)) AS STRING), '([.][0-9])0$', '$1')"
