"""Document collections on Spark: filter, write, vector, text and hybrid search."""

import sys

from pyspark import cloudpickle

from docweave.errors import (
    ConfigError,
    ConflictError,
    DocweaveError,
    DuplicateIdError,
    EmbeddingError,
    InvalidInputError,
    NotFoundError,
)
from docweave.functions.embedding import BatchEmbedding, HashEmbedding, OnnxEmbedding
from docweave.functions.text import AllOf, AnyOf, Contains, Regex
from docweave.operators.hybrid import KnnBranch, Rrf, TextBranch
from docweave.sources.collection import Collection, create_collection, drop_collection, open_collection

__all__ = [
    "AllOf", "AnyOf", "BatchEmbedding", "Collection", "ConfigError", "ConflictError", "Contains",
    "DocweaveError", "DuplicateIdError", "EmbeddingError", "HashEmbedding",
    "InvalidInputError", "KnnBranch", "NotFoundError", "OnnxEmbedding", "Regex",
    "Rrf", "TextBranch", "create_collection", "drop_collection", "open_collection",
]

# Functions that run in tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
