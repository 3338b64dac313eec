"""The one schema every collection has, and the rules for names and settings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docweave.errors import ConfigError, InvalidInputError

ID, DOCUMENT, EMBEDDING, METADATA = "_id", "document", "embedding", "metadata"
COLUMNS = (ID, DOCUMENT, EMBEDDING, METADATA)

SCHEMA = T.StructType([
    T.StructField(ID, T.StringType(), False),
    T.StructField(DOCUMENT, T.StringType()),
    T.StructField(EMBEDDING, T.ArrayType(T.FloatType())),
    T.StructField(METADATA, T.VariantType()),
])

# The name rules and the spellings of the distances.
TABLE_PREFIX = "c_v1_"
MAX_TABLE_NAME = 64
DISTANCES = ("l2", "cosine", "inner_product")
DISTANCE_ALIASES = {"ip": "inner_product"}
DEFAULT_DISTANCE = "l2"


def table_name(name: str) -> str:
    """Physical table of a collection; raises on a name that breaks the rules."""
    if not re.fullmatch(r"[a-zA-Z0-9_]+", name or ""):
        raise InvalidInputError(f"collection name must match [a-zA-Z0-9_]+, got {name!r}")
    physical = TABLE_PREFIX + name
    if len(physical) > MAX_TABLE_NAME:
        raise InvalidInputError(
            f"collection name too long: {physical!r} has more than {MAX_TABLE_NAME} characters")
    return physical


def distance_name(distance: str) -> str:
    """Canonical spelling of a distance."""
    low = (distance or "").lower()
    low = DISTANCE_ALIASES.get(low, low)
    if low not in DISTANCES:
        raise ConfigError(f"distance must be one of {DISTANCES}, got {distance!r}")
    return low


def as_metadata(df: DataFrame) -> Column:
    """The metadata column as VARIANT, parsed when it is JSON text."""
    if isinstance(df.schema[METADATA].dataType, T.VariantType):
        return F.col(METADATA)
    return F.parse_json(METADATA)


def conform(df: DataFrame, *more: str) -> DataFrame:
    """Bring a frame to the collection schema, with `more` of its columns behind; absent columns become NULL."""
    have = set(df.columns)
    casts = {
        ID: F.col(ID).cast("string"),
        DOCUMENT: F.col(DOCUMENT).cast("string") if DOCUMENT in have else F.lit(None).cast("string"),
        EMBEDDING: (F.col(EMBEDDING).cast("array<float>") if EMBEDDING in have
                    else F.lit(None).cast("array<float>")),
        METADATA: as_metadata(df) if METADATA in have else F.parse_json(F.lit(None).cast("string")),
    }
    return df.select(*[casts[c].alias(c) for c in COLUMNS], *more)
