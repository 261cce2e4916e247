"""SQL text helpers for the DuckDB oracle.

DuckDB divides decimals in floating point; Spark divides them exactly (HALF_UP to the result
scale its type rules give). To compare exactly, the oracle redoes Spark's division chain in
128-bit integers: operands are taken in units of 1e-8, each rounding step is a HALF_UP integer
quotient, and only the final 6-decimal value becomes a double.
"""

from __future__ import annotations


def units(x: str, scale: int = 8) -> str:
    return f"CAST(CAST(({x}) AS DECIMAL(38,{scale})) * {10 ** scale} AS HUGEINT)"


def rdiv(a: str, b: str) -> str:
    """HALF_UP (away from zero) integer quotient a / b of HUGEINT expressions."""
    return (f"(CAST(sign({a}) * sign({b}) AS HUGEINT) * ((2 * abs({a}) + abs({b})) "
            f"// (2 * abs({b}))))")


def to6(q: str, scale: int) -> str:
    """Integer q at ``scale`` -> HALF_UP 6-place double."""
    return f"(CAST({rdiv(q, str(10 ** (scale - 6)))} AS DOUBLE) / 1000000.0)"


def ratio(num: str, den: str, scale: int) -> str:
    """Spark decimal division num/den (result scale ``scale``), then round 6 -> double; NULL if den is 0/NULL."""
    n, d = units(num), units(den)
    q = rdiv(f"({n} * CAST({10 ** scale} AS HUGEINT))", d)
    return f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL OR ({num}) IS NULL THEN NULL ELSE {to6(q, scale)} END)"


def pct(num: str, den: str) -> str:
    """Spark's ``num / den * 100`` on decimal(19,8)/decimal(18,8): quotient at scale 19, product
    rounded to scale 15, then round 6 -> double."""
    n, d = units(num), units(den)
    q19 = rdiv(f"({n} * CAST({10 ** 19} AS HUGEINT))", d)
    p15 = rdiv(f"({q19} * 100)", str(10 ** 4))
    return f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL OR ({num}) IS NULL THEN NULL ELSE {to6(p15, 15)} END)"


def ratio_q(num: str, den: str, scale: int) -> str:
    """Spark's exact quotient num/den at ``scale`` as a HUGEINT (for ordering by the exact value)."""
    n, d = units(num), units(den)
    return (f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL OR ({num}) IS NULL THEN NULL ELSE "
            f"{rdiv(f'({n} * CAST({10 ** scale} AS HUGEINT))', d)} END)")
