"""Add, update, upsert and delete: a collection and a table of changes in, the new
collection out.

Changes are `(_id, document?, embedding?, metadata?, seq?)`. A column that is absent
leaves that field alone; a NULL cell in a present column keeps the old value of that
row. Metadata given replaces the old object whole. Several changes of one id apply
in `seq` order. Each call checks its changes in one aggregation, which also measures
them: small batches are broadcast to the collection, so a huge collection is not
shuffled for them, and large ones meet it in a shuffled join.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from docweave.errors import DuplicateIdError, InvalidInputError
from docweave.functions.filters import conjunction, id_in
from docweave.functions.text import DocFilter, document_predicate
from docweave.operators.reads import LITERAL_IDS
from docweave.plans import sizing
from docweave.schema import COLUMNS, DOCUMENT, EMBEDDING, ID, METADATA, as_metadata, conform
from docweave.sources.storage import stored

FIELDS = (DOCUMENT, EMBEDDING, METADATA)


@dataclass(frozen=True)
class BatchReport:
    rows: int
    null_ids: int
    null_vectors: int
    wrong_vectors: int
    bytes: int


@dataclass(frozen=True)
class DealtBy:
    """A column of a base whose ids are unique: what its rows are stored by, and how it follows from an id."""

    column: str
    of_id: Column


def batch_report(dimension: int | None):
    """The aggregates of `measure`, as named columns; `wrong_vectors` counts vectors whose
    length is not `dimension`."""
    size = F.array_size(EMBEDDING)
    wrong = F.lit(False) if dimension is None else size != dimension
    return [
        F.count("*").alias("rows"),
        F.count_if(F.col(ID).isNull()).alias("null_ids"),
        F.count_if(F.col(EMBEDDING).isNull()).alias("null_vectors"),
        F.count_if(F.col(EMBEDDING).isNotNull() & wrong).alias("wrong_vectors"),
    ]


def measure(changes: DataFrame, dimension: int | None) -> BatchReport:
    """Size of a batch and the number of rows that break the rules, in one pass."""
    width = (F.coalesce(F.octet_length(ID), F.lit(0))
             + F.coalesce(F.octet_length(DOCUMENT), F.lit(0))
             + F.coalesce(F.when(F.col(EMBEDDING).isNotNull(), 4 * F.array_size(EMBEDDING)), F.lit(0))
             + F.coalesce(F.octet_length(F.to_json(METADATA)), F.lit(0)))
    row = conform(changes).agg(*batch_report(dimension),
                               F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return BatchReport(**row.asDict())


def check(changes: DataFrame, dimension: int | None, need_vectors: bool = False) -> BatchReport:
    """`measure`, raising with sample ids when a row breaks the rules."""
    found = measure(changes, dimension)
    if found.null_ids:
        raise InvalidInputError(f"{found.null_ids} rows have no id")
    if found.wrong_vectors:
        bad = F.col(EMBEDDING).isNotNull() & (F.array_size(EMBEDDING) != dimension)
        sample = changes.where(bad).select(ID, F.array_size(EMBEDDING).alias("n")).limit(5).collect()
        raise InvalidInputError(
            f"{found.wrong_vectors} rows hold vectors of another length than {dimension} (for example "
            f"{sample[0]['n']}), among them {[r[ID] for r in sample]}")
    if need_vectors and found.null_vectors:
        raise InvalidInputError(f"{found.null_vectors} rows have no embedding")
    return found


def _given(changes: DataFrame) -> list[str]:
    given = [c for c in FIELDS if c in changes.columns]
    if not given:
        raise InvalidInputError("none of document, embedding, metadata is given")
    return given


def embed_documents(changes: DataFrame, embedder) -> DataFrame:
    """Changes with vectors made from their documents, where no vector column is given.
    A row without a document gets no vector. They are stored, since a batch is checked before it is applied."""
    return stored(changes.withColumn(
        EMBEDDING, F.when(F.col(DOCUMENT).isNotNull(), embedder.embed(F.col(DOCUMENT)))), "embedded")


def fold(changes: DataFrame) -> DataFrame:
    """One change per id: per field, the value with the greatest `seq`.

    An aggregate rather than a window: it combines before the shuffle, so an id with very
    many changes is no burden. Without `seq` the ids must be unique, and with it the pairs
    of id and `seq`."""
    given = _given(changes)
    values = changes
    if METADATA in given:
        values = values.withColumn(METADATA, as_metadata(changes))
    order = [c for c in (ID, "seq") if c in changes.columns]
    unclear = F.col("count") > 1
    if "seq" in order:
        unclear = unclear | F.col("seq").isNull()
    bad = changes.groupBy(order).count().where(unclear).limit(5).collect()
    if bad:
        raise InvalidInputError(
            f"the order of changes is unclear, give each a seq of its own: {[r[ID] for r in bad]}")
    if "seq" not in order:
        return values.select(ID, *given)
    return values.groupBy(ID).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in given])


def add(base: DataFrame, changes: DataFrame, dimension: int | None = None,
        embedder=None) -> DataFrame:
    """Insert new rows; nothing is inserted when any id exists already."""
    return base.select(*COLUMNS).unionByName(new_rows(base, changes, dimension, embedder))


def new_rows(base: DataFrame, changes: DataFrame, dimension: int | None = None,
             embedder=None) -> DataFrame:
    """The checked rows `add` inserts. A row without a document gets an empty one."""
    if EMBEDDING not in changes.columns:
        if DOCUMENT not in changes.columns or embedder is None:
            raise InvalidInputError(
                "give embeddings, or documents together with an embedding function")
        changes = embed_documents(changes, embedder)
    rows = conform(changes).withColumn(DOCUMENT, F.coalesce(DOCUMENT, F.lit("")))
    found = check(rows, dimension, need_vectors=True)
    if not found.rows:
        raise InvalidInputError("the batch holds no rows")
    ids = rows.select(ID)
    inside = ids.groupBy(ID).count().where("count > 1").limit(5).collect()
    if inside:
        raise DuplicateIdError(f"ids occur twice in one batch: {[r[ID] for r in inside]}")
    taken = base.select(ID).join(_small(ids, found), ID, "left_semi").limit(5).collect()
    if taken:
        raise DuplicateIdError(f"ids exist already: {[r[ID] for r in taken]}")
    return rows


def update(base: DataFrame, changes: DataFrame, dimension: int | None = None,
           embedder=None, dealt_by: DealtBy | None = None) -> DataFrame:
    """Change the given fields of existing rows; unknown ids are ignored.

    Documents without vectors need an embedding function. With `dealt_by` the rows carry that column."""
    given = _given(changes)
    if DOCUMENT in given and EMBEDDING not in given:
        if embedder is None:
            raise InvalidInputError(
                "documents without embeddings need an embedding function to update")
        changes = embed_documents(changes, embedder)
    found = check(changes, dimension)
    folded = fold(changes)
    small = _small(folded, found)
    if dealt_by is None or small is not folded:
        return _overwrite(base, small, dealt_by)
    merged, was_there = _put_together(base, folded, dealt_by)
    return merged.where(was_there).select(*COLUMNS, dealt_by.column)


def _small(changes: DataFrame, found: BatchReport) -> DataFrame:
    """Broadcast hint, if the measured batch allows it."""
    fits = (found.bytes <= sizing.MAX_BROADCAST_BYTES
            and found.rows <= sizing.MAX_BROADCAST_ROWS)
    return F.broadcast(changes) if fits else changes


def _renamed(changes: DataFrame) -> DataFrame:
    given = [c for c in FIELDS if c in changes.columns]
    return changes.select(F.col(ID).cast("string").alias(ID), F.lit(True).alias("_changed"),
                          *[F.col(c).alias(f"_new_{c}") for c in given])


def _merged(base: DataFrame, columns: list[str]) -> list[Column]:
    """New value if there is one, else the old."""
    types = dict(base.dtypes)
    return [F.coalesce(F.col(f"_new_{c}").cast(types[c]), F.col(c)).alias(c)
            if f"_new_{c}" in columns else F.col(c) for c in FIELDS]


def _overwrite(base: DataFrame, changes: DataFrame, dealt_by: DealtBy | None = None) -> DataFrame:
    more = [] if dealt_by is None else [dealt_by.column]
    new = _renamed(changes)
    hinted = base.select(*COLUMNS, *more).join(new, ID, "left")
    return hinted.select(ID, *_merged(base, hinted.columns), *more)


def _put_together(base: DataFrame, changes: DataFrame, dealt_by: DealtBy) -> tuple[DataFrame, Column]:
    """The rows of both by id, a new value before an old one, and whether the base held the id.

    One shuffle of each side, by the column they are to be written by: a join would need another, by id, before it.
    Old and new rows of an id then lie side by side and are put together in sorted order."""
    by, types, given = dealt_by.column, dict(base.dtypes), set(changes.columns)
    new = changes.select(
        F.col(ID).cast("string").alias(ID),
        *[(F.col(c) if c in given else F.lit(None)).cast(types[c]).alias(c) for c in FIELDS],
        F.lit(1).alias("_new"))
    new = new.withColumn(by, dealt_by.of_id)
    both = base.select(*COLUMNS, F.lit(0).alias("_new"), by).unionByName(new).repartition(by)
    merged = both.groupBy(by, ID).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_new"))).alias(c) for c in FIELDS],
        F.min("_new").alias("_new"))
    return merged, F.col("_new") == 0


def upsert(base: DataFrame, changes: DataFrame, dimension: int | None = None,
           embedder=None, dealt_by: DealtBy | None = None) -> DataFrame:
    """Change the given fields of existing rows and insert the others.

    Documents without vectors are embedded if there is an embedding function, else the
    old vector stays. Inserted rows without a document get an empty one, without
    metadata JSON null, and without a vector none. With `dealt_by`, rows of a large batch carry that column."""
    given = _given(changes)
    if DOCUMENT in given and EMBEDDING not in given and embedder is not None:
        changes = embed_documents(changes, embedder)
    found = check(changes, dimension)
    if not found.rows:
        raise InvalidInputError("the batch holds no rows")
    folded = fold(changes)
    small = _small(folded, found)
    if small is not folded:
        # Broadcast both ways: the collection is scanned twice (once for ids only), never
        # shuffled.
        known = base.select(ID).join(F.broadcast(folded.select(ID)), ID, "left_semi")
        fresh = folded.join(known, ID, "left_anti")
        return _overwrite(base, small).unionByName(_inserted(fresh))
    if dealt_by is not None:
        merged, was_there = _put_together(base, folded, dealt_by)
        return merged.select(
            ID, F.when(was_there, F.col(DOCUMENT)).otherwise(F.coalesce(DOCUMENT, F.lit(""))).alias(DOCUMENT),
            EMBEDDING,
            F.when(was_there, F.col(METADATA)).otherwise(F.coalesce(F.col(METADATA), _json_null())).alias(METADATA),
            dealt_by.column)
    joined = base.select(*COLUMNS, F.lit(True).alias("_old")).join(_renamed(folded), ID, "full_outer")
    old = _merged(base, joined.columns)
    filled = dict(zip(FIELDS, old))
    fresh = F.col("_old").isNull()
    return joined.select(
        ID,
        F.when(fresh, F.coalesce(filled[DOCUMENT], F.lit(""))).otherwise(filled[DOCUMENT]).alias(DOCUMENT),
        filled[EMBEDDING],
        F.when(fresh, F.coalesce(filled[METADATA], _json_null())).otherwise(filled[METADATA]).alias(METADATA))


def _json_null() -> Column:
    return F.parse_json(F.lit("null"))


def _inserted(changes: DataFrame) -> DataFrame:
    return conform(changes).select(
        ID, F.coalesce(DOCUMENT, F.lit("")).alias(DOCUMENT), EMBEDDING,
        F.coalesce(F.col(METADATA), _json_null()).alias(METADATA))


def delete(base: DataFrame, ids: Iterable[str] | DataFrame | None = None,
           where: Column | None = None,
           where_document: DocFilter | Column | None = None) -> DataFrame:
    """The rows that stay. Given conditions are combined by AND; a row for which they
    are unknown stays. An empty id list is an error, an empty id frame deletes nothing."""
    predicate = conjunction(where, document_predicate(where_document))
    if ids is None and predicate is None:
        raise InvalidInputError("give at least one of ids, where, where_document")
    if ids is not None and not isinstance(ids, DataFrame):
        ids = list(ids)
        if not ids:
            raise InvalidInputError("ids must not be an empty list")
        if len(ids) <= LITERAL_IDS:
            predicate, ids = conjunction(id_in(ids), predicate), None
        else:
            ids = base.sparkSession.createDataFrame([(i,) for i in ids], f"{ID} string")
    if ids is None:
        return base.where(~F.coalesce(predicate, F.lit(False)))
    listed = sizing.broadcast_if_small(ids.select(F.col(ID).cast("string")).distinct())
    if predicate is None:
        return base.join(listed, ID, "left_anti")
    marked = base.join(listed.withColumn("_listed", F.lit(True)), ID, "left")
    hit = F.coalesce(F.col("_listed") & predicate, F.lit(False))
    return marked.where(~hit).select(*base.columns)
