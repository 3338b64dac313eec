"""Get, peek and count, and filters against tables of ids or values."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docweave.errors import InvalidInputError
from docweave.functions.filters import id_in, variant_path
from docweave.functions.text import DocFilter
from docweave.operators.nearest import filtered, include_columns
from docweave.plans.sizing import broadcast_if_small
from docweave.schema import ID, METADATA

LITERAL_IDS = 1000         # longer id lists become a join
DIRECT_PAGE = 1000         # ids that may be sorted in one task; deeper pages find their ends by a sketch


def with_ids(df: DataFrame, ids: Iterable[str] | DataFrame | None) -> DataFrame:
    """Rows whose id is listed; an empty list or frame gives no rows."""
    if ids is None:
        return df
    if not isinstance(ids, DataFrame):
        ids = list(ids)
        if len(ids) <= LITERAL_IDS:
            return df.where(id_in(ids))
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], f"{ID} string")
    return df.join(broadcast_if_small(ids.select(F.col(ID).cast("string")).distinct()), ID, "left_semi")


def field_in(df: DataFrame, field: str, values: DataFrame, metadata: str = METADATA) -> DataFrame:
    """Rows whose metadata field is in the one-column table `values` of text, numbers or booleans."""
    keyed, listed = _keyed(df, field, values, metadata)
    return keyed.join(listed, "_key", "left_semi").drop("_key")


def field_not_in(df: DataFrame, field: str, values: DataFrame,
                 metadata: str = METADATA) -> DataFrame:
    """Rows whose metadata field exists and is not in the one-column table `values`.

    As in SQL, a NULL among the values makes every row unknown, so none is returned."""
    keyed, listed = _keyed(df, field, values, metadata)
    has_null = values.select(F.coalesce(F.bool_or(F.col(values.columns[0]).isNull()),
                                        F.lit(False))).scalar()
    path = F.try_variant_get(metadata, variant_path(field), "variant")
    kept = keyed.where(path.isNotNull()).join(listed, "_key", "left_anti").drop("_key")
    return kept.where(~has_null)


def _keyed(df: DataFrame, field: str, values: DataFrame, metadata: str):
    """Both sides with a key of kind and value, so that text never equals a number or a boolean,
    and whole numbers compare as such at any size of BIGINT."""
    name = values.columns[0]
    path = variant_path(field)
    kind = F.schema_of_variant(F.try_variant_get(metadata, path, "variant"))
    value = lambda of: F.try_variant_get(metadata, path, of)
    key = (F.when(kind == "STRING", _key("s", value("string")))
           .when(kind == "BOOLEAN", _key("b", value("boolean")))
           .when(kind == "BIGINT", _key("n", value("bigint")))
           .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), _number_key(value("double"))))
    of = values.schema[name].dataType
    asked = F.col(name)
    if isinstance(of, T.StringType):
        asked = _key("s", asked)
    elif isinstance(of, T.BooleanType):
        asked = _key("b", asked)
    elif isinstance(of, T.IntegralType):
        asked = _key("n", asked)
    elif isinstance(of, (T.DoubleType, T.FloatType, T.DecimalType)):
        asked = _number_key(asked.cast("double"))
    else:
        raise InvalidInputError(f"values of a metadata field are text, numbers or booleans, not {of.simpleString()}")
    listed = values.select(asked.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return df.withColumn("_key", key), broadcast_if_small(listed)


def _key(kind: str, value: Column) -> Column:
    return F.concat(F.lit(kind), value.cast("string"))


def _number_key(value: Column) -> Column:
    """A double with a whole value in the range of BIGINT has the key of that whole number."""
    whole = (F.floor(value) == value) & (F.abs(value) < 2.0 ** 63)
    return F.when(whole, _key("n", value.cast("bigint"))).otherwise(_key("d", value))


def get(collection: DataFrame, ids: Iterable[str] | DataFrame | None = None,
        where: Column | None = None, where_document: DocFilter | Column | None = None,
        limit: int | None = None, offset: int | None = None, include=None) -> DataFrame:
    """Rows by id and/or filters. Paged results are ordered by `_id`; without a limit
    or offset nothing is sorted."""
    rows = with_ids(filtered(collection, where, where_document), ids)
    return page(rows, limit, offset).select(ID, *include_columns(include))


def page(rows: DataFrame, limit: int | None, offset: int | None, direct: int = DIRECT_PAGE) -> DataFrame:
    """Rows of a page in order of id. Up to `direct` ids may be sorted to find its ends."""
    for name, n in (("limit", limit), ("offset", offset)):
        if n is not None and n < 0:
            raise InvalidInputError(f"{name} must not be negative, got {n}")
    if limit is None and not offset:
        return rows
    if limit == 0:
        return rows.where(F.lit(False))
    # Both ends are found on the ids alone, then the page is a range read: no task sorts or
    # holds documents and vectors of rows outside the page.
    ids, offset = rows.select(ID), offset or 0
    if limit is not None and offset + limit <= direct:
        ends = ids.orderBy(ID).offset(offset).limit(limit).agg(F.min(ID), F.max(ID)).first()
        if ends[0] is None:
            return rows.where(F.lit(False))
        return rows.where(F.col(ID).between(ends[0], ends[1])).orderBy(ID)
    wanted = ([offset] if offset else []) + ([offset + limit] if limit is not None else [])
    found = dict(zip(wanted, nth_ids(ids, wanted, direct)))
    if offset:
        first = found[offset]
        rows = rows.where(F.col(ID) >= first) if first is not None else rows.where(F.lit(False))
    if limit is not None:
        beyond = found[offset + limit]
        rows = rows.where(F.col(ID) < beyond) if beyond is not None else rows
    return rows.orderBy(ID)


@dataclass
class _Place:
    """A rank looked for among the ids that hold `inside`, which all begin with `prefix` bytes in common."""

    rank: int
    inside: Column
    prefix: int = 0
    found: str | None = None
    done: bool = False


def nth_ids(ids: DataFrame, ranks: list[int], direct: int = DIRECT_PAGE) -> list[str | None]:
    """For each rank the id with that many smaller ones; None when there are not so many.

    Each round takes two passes over the ids for all ranks together: a quantile sketch, which merges before the
    shuffle, gives an interval around each rank, and counts tell where in it the rank falls. What is left
    shrinks about a thousandfold; `direct` ids at most are fetched and sorted in the end."""
    places = [_Place(n, F.lit(True)) for n in ranks]
    while open_places := [p for p in places if not p.done]:
        sizes = ids.agg(*[x.alias(f"{name}{n}") for n, p in enumerate(open_places) for name, x in (
            ("n", F.count_if(p.inside)), ("low", F.min(F.when(p.inside, F.col(ID)))), ("high", F.max(F.when(p.inside, F.col(ID)))),
            ("cuts", F.percentile_approx(F.when(p.inside, _number(p.prefix)), list(map(float, CUTS)), SKETCH)))]).first()
        rest = []
        for n, p in enumerate(open_places):
            size, low, high = (sizes[f"{x}{n}"] for x in ("n", "low", "high"))
            if p.rank >= size:
                p.done = True
            elif low == high:
                p.found, p.done = low, True
            elif size <= direct:
                listed = sorted((r[0] for r in ids.where(p.inside).collect()), key=str.encode)
                p.found, p.done = listed[p.rank], True
            elif (common := _common_bytes(low, high)) > p.prefix:
                p.prefix = common  # the next round's numbers begin where the ids differ
            else:
                rest.append((p, _around(sizes[f"cuts{n}"], p.rank / size)))
        if rest:
            _narrow(ids, rest)
    return [p.found for p in places]


# Cut points of the sketch, and its accuracy: ranks are right within 1 / SKETCH of all ids.
SKETCH = 10_000
CUTS = [n / 1000 for n in range(1001)]


def _number(prefix: int) -> Column:
    """Six bytes of the id from byte `prefix` on and how many follow (up to 255): numbers in the order of ids."""
    after = F.substr(F.col(ID).cast("binary"), F.lit(prefix + 1), F.lit(6))
    left = F.least(F.octet_length(ID) - prefix, F.lit(255))
    return F.conv(F.concat(F.rpad(F.hex(after), 12, "0"), F.lpad(F.hex(left.cast("bigint")), 2, "0")), 16, 10).cast("bigint")


def _common_bytes(a: str, b: str) -> int:
    pair = a.encode(), b.encode()
    return next((n for n, (x, y) in enumerate(zip(*pair)) if x != y), min(map(len, pair)))


def _around(cuts: list[int], share: float) -> tuple[int, int]:
    """Numbers of the sketch with the rank between them, errors allowed for."""
    at = int(share * (len(cuts) - 1))
    return cuts[max(0, at - 1)], cuts[min(len(cuts) - 1, at + 2)]


def _narrow(ids: DataFrame, places: list[tuple[_Place, tuple[int, int]]]) -> None:
    """Move each place into the part of its interval that holds the rank: below, at or above each of two numbers."""
    parts = []
    for p, (low, high) in places:
        x = _number(p.prefix)
        parts.append([p.inside & c for c in (x < low, x == low, (x > low) & (x < high), (x == high) & (x != F.lit(low)), x > high)])
    counts = ids.agg(*[F.count_if(c).alias(f"c{n}_{m}") for n, listed in enumerate(parts) for m, c in enumerate(listed)]).first()
    for n, (p, _) in enumerate(places):
        for m, part in enumerate(parts[n]):
            held = counts[f"c{n}_{m}"]
            if p.rank < held:
                p.inside = part
                break
            p.rank -= held


def peek(collection: DataFrame, limit: int = 10) -> DataFrame:
    """The first rows by id, with every column."""
    return get(collection, limit=limit, offset=0, include=("document", "metadata", "embedding"))


def count(collection: DataFrame) -> DataFrame:
    return collection.agg(F.count("*").alias("count"))
