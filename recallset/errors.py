"""Errors a job can raise, one class per cause."""


class RecallError(Exception):
    """Base class of every error raised on purpose."""


class ConfigurationError(RecallError):
    """An option of a store, an index or the session is unusable."""


class ValidationError(RecallError):
    """An id, a vector, a limit, a threshold or a distance is out of range."""


class UnsupportedFilterError(RecallError):
    """A filter names an undeclared field or compares with a non-scalar value."""


class CollisionError(RecallError):
    """A key is held by a row this store does not own."""
