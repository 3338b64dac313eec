class DocweaveError(Exception):
    """Base of every error raised by this package."""


class InvalidInputError(DocweaveError, ValueError):
    """Arguments or rows that break the rules of a collection."""


class DuplicateIdError(InvalidInputError):
    """An added id already exists, or occurs twice in one batch."""


class ConfigError(DocweaveError):
    """A collection lacks its dimension or distance."""


class ConflictError(DocweaveError):
    """Another writer changed the collection since it was read."""


class NotFoundError(DocweaveError):
    """No collection of that name."""


class EmbeddingError(DocweaveError):
    """Text was given where vectors are needed and no embedder can make them."""
