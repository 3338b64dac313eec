"""Predicates over JSON metadata and ids, as Column expressions.

Every predicate is three-valued: a missing key gives NULL, so the row is dropped
by the predicate and by its negation alike. A key that exists but holds another
type of value (text against number, JSON null, ...) is simply not equal and not
in any range. The parts are plain conjunctions of `try_variant_get`, which Spark
pushes into the Parquet scan so that only the touched paths of the VARIANT are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from docweave.errors import InvalidInputError
from docweave.schema import ID, METADATA

_EXACT_DOUBLE = 2**53
_STEP = re.compile(r"\[(\d+)\]|([^.\[\]]+)")


def variant_path(field: str) -> str:
    """`a.b[0]` as a VARIANT path; keys are quoted, so no key can break out of it."""
    if not re.fullmatch(r"[^.\[\]]+(\.[^.\[\]]+|\[\d+\])*", field or ""):
        raise InvalidInputError(f"not a metadata field: {field!r}")
    path = "$"
    for index, key in _STEP.findall(field):
        if index:
            path += f"[{index}]"
        elif re.fullmatch(r"[A-Za-z_]\w*", key, re.ASCII):
            path += f".{key}"
        elif '"' not in key:
            path += f'["{key}"]'
        elif "'" not in key:
            path += f"['{key}']"
        else:
            raise InvalidInputError(f"metadata key holds both kinds of quotes: {key!r}")
    return path


def _get(metadata: str, field: str, kind: str) -> Column:
    return F.try_variant_get(metadata, variant_path(field), kind)


def _kind(metadata: str, field: str) -> Column:
    """Type of the stored value as text; NULL when the key is missing."""
    return F.schema_of_variant(_get(metadata, field, "variant"))


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _check(value):
    if isinstance(value, (bool, str)) or value is None:
        return value
    if isinstance(value, int):
        if not -(2**63) <= value < 2**63:
            raise InvalidInputError(f"integer outside 64 bits: {value}")
        return value
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            raise InvalidInputError(f"not a JSON number: {value}")
        return value
    raise InvalidInputError(f"cannot compare metadata with {type(value).__name__}: {value!r}")


def _compare(field: str, value, test, metadata: str) -> Column:
    """`test(stored value, value)` where both are of the same kind."""
    value = _check(value)
    kind = _kind(metadata, field)
    if value is None:
        return F.lit(None).cast("boolean")
    if isinstance(value, bool):
        return (kind == "BOOLEAN") & test(_get(metadata, field, "boolean"), F.lit(value))
    if isinstance(value, str):
        return (kind == "STRING") & test(_get(metadata, field, "string"), F.lit(value))
    number = test(_get(metadata, field, "double"), F.lit(float(value)))
    if isinstance(value, int) and abs(value) >= _EXACT_DOUBLE:
        # Beyond 2**53 doubles skip integers, so whole numbers compare as such.
        whole = test(_get(metadata, field, "bigint"), F.lit(value).cast("bigint"))
        return ((kind == "BIGINT") & whole) | (_is_number(kind) & (kind != "BIGINT") & number)
    return _is_number(kind) & number


def eq(field: str, value, metadata: str = METADATA) -> Column:
    return _compare(field, value, lambda a, b: a == b, metadata)


def ne(field: str, value, metadata: str = METADATA) -> Column:
    return ~eq(field, value, metadata)


def gt(field: str, value, metadata: str = METADATA) -> Column:
    return _compare(field, value, lambda a, b: a > b, metadata)


def gte(field: str, value, metadata: str = METADATA) -> Column:
    return _compare(field, value, lambda a, b: a >= b, metadata)


def lt(field: str, value, metadata: str = METADATA) -> Column:
    return _compare(field, value, lambda a, b: a < b, metadata)


def lte(field: str, value, metadata: str = METADATA) -> Column:
    return _compare(field, value, lambda a, b: a <= b, metadata)


def is_in(field: str, values: Iterable, metadata: str = METADATA) -> Column:
    """Any of a literal list. An empty list matches nothing; a None in the list makes
    every non-match unknown, as in SQL. For long lists use `operators.reads.field_in`."""
    values = [_check(v) for v in values]
    kind = _kind(metadata, field)
    texts = [v for v in values if isinstance(v, str)]
    flags = [v for v in values if isinstance(v, bool)]
    small = [float(v) for v in values if isinstance(v, float)
             or (isinstance(v, int) and not isinstance(v, bool) and abs(v) < _EXACT_DOUBLE)]
    large = [v for v in values if isinstance(v, int) and not isinstance(v, bool)
             and abs(v) >= _EXACT_DOUBLE]
    parts = []
    if texts:
        parts.append((kind == "STRING") & _get(metadata, field, "string").isin(texts))
    if flags:
        parts.append((kind == "BOOLEAN") & _get(metadata, field, "boolean").isin(flags))
    if small:
        parts.append(_is_number(kind) & _get(metadata, field, "double").isin(small))
    parts += [eq(field, v, metadata) for v in large]
    if None in values:
        parts.append(F.lit(None).cast("boolean"))
    if not parts:
        return F.when(kind.isNotNull(), F.lit(False))
    return reduce(lambda a, b: a | b, parts)


def not_in(field: str, values: Iterable, metadata: str = METADATA) -> Column:
    return ~is_in(field, values, metadata)


KEY_KINDS = ("string", "number", "boolean")


def key_value(field: str, kind: str, metadata: str = METADATA) -> Column:
    """A metadata field as a plain column: its value if it is of that kind, else NULL. Numbers come as doubles."""
    if kind not in KEY_KINDS:
        raise InvalidInputError(f"a key is one of {KEY_KINDS}, not {kind!r}")
    found = _kind(metadata, field)
    if kind == "number":
        return F.when(_is_number(found), _get(metadata, field, "double"))
    return F.when(found == kind.upper(), _get(metadata, field, kind))


class Keyed:
    """The predicates of this module for rows that also hold some fields as plain columns.

    `columns` gives the column and kind of each such field. A predicate on one of them is the usual one AND a
    comparison of the plain column that holds wherever the usual one does, so results are the same, also under
    negation, while Parquet statistics and Bloom filters of the plain column skip row groups. Doubles
    round large whole numbers, so comparisons of numbers let the limit itself through."""

    def __init__(self, columns: dict[str, tuple[str, str]]):
        self.columns = columns

    def _plain(self, field: str, value, test) -> Column | None:
        column, kind = self.columns.get(field, (None, None))
        of = {"string": str, "boolean": bool}.get(kind, (int, float))
        if column is None or value is None or not isinstance(value, of) or (kind == "number" and isinstance(value, bool)):
            return None
        return test(F.col(column), F.lit(float(value) if kind == "number" else value))

    def _both(self, predicate: Column, field: str, value, test) -> Column:
        plain = self._plain(field, value, test)
        return predicate if plain is None else plain & predicate

    def eq(self, field: str, value) -> Column:
        return self._both(eq(field, value), field, value, lambda a, b: a == b)

    def ne(self, field: str, value) -> Column:
        return ne(field, value)

    def gt(self, field: str, value) -> Column:
        return self._both(gt(field, value), field, value, lambda a, b: a >= b)

    def gte(self, field: str, value) -> Column:
        return self._both(gte(field, value), field, value, lambda a, b: a >= b)

    def lt(self, field: str, value) -> Column:
        return self._both(lt(field, value), field, value, lambda a, b: a <= b)

    def lte(self, field: str, value) -> Column:
        return self._both(lte(field, value), field, value, lambda a, b: a <= b)

    def is_in(self, field: str, values: Iterable) -> Column:
        values = list(values)
        column, kind = self.columns.get(field, (None, None))
        of = {"string": str, "boolean": bool}.get(kind, (int, float))
        if column is None or not values or not all(
                isinstance(v, of) and not (kind == "number" and isinstance(v, bool)) for v in values):
            return is_in(field, values)
        return F.col(column).isin([float(v) if kind == "number" else v for v in values]) & is_in(field, values)

    def not_in(self, field: str, values: Iterable) -> Column:
        return not_in(field, values)


def all_of(*predicates: Column) -> Column:
    if not predicates:
        raise InvalidInputError("all_of needs at least one predicate")
    return reduce(lambda a, b: a & b, predicates)


def any_of(*predicates: Column) -> Column:
    if not predicates:
        raise InvalidInputError("any_of needs at least one predicate")
    return reduce(lambda a, b: a | b, predicates)


def negate(predicate: Column) -> Column:
    return ~predicate


def id_in(ids: Iterable[str]) -> Column:
    """`_id` in a literal list; an empty list matches nothing."""
    ids = list(ids)
    return F.col(ID).isin(ids) if ids else F.lit(False)


def conjunction(*predicates: Column | None) -> Column | None:
    """AND of those given; None when none is."""
    given = [p for p in predicates if p is not None]
    return reduce(lambda a, b: a & b, given) if given else None
