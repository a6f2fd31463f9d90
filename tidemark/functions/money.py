"""Exact money arithmetic.

Prices are ``decimal(10,2)``. Sums run over whole cents held in a long, which Spark
adds in generated code; a wide decimal sum would build an object per row. ANSI
mode raises on overflow rather than wrapping.

The functions take and give SQL text: a query built from few long expressions is
put together much faster from Python than one built call by call.
"""

from __future__ import annotations

from tidemark.schemas import MONEY, TOTAL


def cents(amount: str) -> str:
    """A decimal amount as whole cents."""
    return f"CAST({amount} * 100 AS BIGINT)"


def _decimal(whole_cents: str, kind) -> str:
    return f"CAST(CAST({whole_cents} AS DECIMAL(20, 0)) * 0.01BD AS {kind.simpleString()})"


def as_money(whole_cents: str) -> str:
    """Whole cents as a ``decimal(10,2)`` price."""
    return _decimal(whole_cents, MONEY)


def as_total(whole_cents: str) -> str:
    """Whole cents as a ``decimal(18,2)`` total."""
    return _decimal(whole_cents, TOTAL)


def average_cents(total: str, count: str) -> str:
    """Cents per unit, cut toward zero; 0 when there is nothing to divide by."""
    return f"CASE WHEN {count} > 0 THEN {total} DIV {count} ELSE 0L END"
