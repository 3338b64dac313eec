"""Vector distances as Column expressions, summed in double precision.

The expressions suit row-wise use (one pair per row). Searches use the block
kernel in `operators.nearest`, which never materialises query-row pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docweave.schema import distance_name


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def l2_distance(a: Column | str, b: Column | str) -> Column:
    def square(x, y):
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(F.aggregate(F.zip_with(_col(a), _col(b), square), F.lit(0.0), lambda s, x: s + x))


def inner_product(a: Column | str, b: Column | str) -> Column:
    return _dot(_col(a), _col(b))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 - cos; NULL when either vector is all zeros."""
    a, b = _col(a), _col(b)
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.lit(1.0) - _dot(a, b) / F.when(norms > 0, norms)


def distance(name: str, a: Column | str, b: Column | str) -> Column:
    return {
        "l2": l2_distance, "cosine": cosine_distance, "inner_product": inner_product,
    }[distance_name(name)](a, b)
