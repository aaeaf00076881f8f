"""Errors that the engine raises by itself; all else is Spark's own."""


class PointframeError(Exception):
    """Base of all errors raised here."""


class CollectionNotFound(PointframeError):
    """No collection, or no readable description of one, at a path."""


class CollectionParamsMissing(PointframeError):
    """A collection's description lacks its vector parameters."""


class SnapshotConflict(PointframeError):
    """Another writer has published a snapshot since this one was opened."""


class InvalidSchema(PointframeError):
    """Vector names or sizes that can't make up a table."""


class MalformedVector(PointframeError):
    """A vector that can't be brought into the form that its column asks for."""


class DimensionMismatch(PointframeError):
    """A query vector whose length differs from that of its column."""


class DialectError(PointframeError):
    """A statement that can't be bound to a collection."""
