"""Text forms of vectors, metadata and ids, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the spellings of a number that count as a vector element.
_FLOAT = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def _plain_number(x: Column) -> Column:
    """A float as the shortest decimal text, without exponent or trailing `.0`."""
    text = x.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_extract(text, r"^-?([\d.]+)E", 1)
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    expanded = F.when(
        power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    ).otherwise(F.rpad(digits, power + 1, "0"))
    return (
        F.when(F.isnan(x), F.lit("NaN"))
        .when(text.contains("Infinity"), F.concat(sign, F.lit("inf")))
        .when(power.isNotNull(), F.concat(sign, expanded))
        .otherwise(F.regexp_replace(text, r"\.0$", ""))
    )


def vector_to_text(vector: Column | str) -> Column:
    """`[1.0, 2.5]` as the text `[1,2.5]`."""
    col = F.col(vector) if isinstance(vector, str) else vector
    return F.concat(F.lit("["), F.array_join(F.transform(col, _plain_number), ","), F.lit("]"))


def text_to_vector(text: Column | str) -> Column:
    """`[1,2.5]` as a float array; elements that are no numbers are dropped."""
    col = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(F.btrim(col, F.lit("[]")), ","), lambda p: F.trim(p))
    return F.transform(F.filter(parts, lambda p: p.rlike(_FLOAT)), lambda p: p.cast("float"))


def text_to_metadata(text: Column | str) -> Column:
    """JSON text as VARIANT; NULL when it does not parse."""
    return F.try_parse_json(text)


def metadata_to_text(metadata: Column | str) -> Column:
    """VARIANT as JSON text."""
    return F.to_json(metadata)


def bytes_to_id(raw: Column | str) -> Column:
    """Id bytes as text, invalid UTF-8 replaced."""
    col = F.col(raw) if isinstance(raw, str) else raw
    return F.make_valid_utf8(col)
