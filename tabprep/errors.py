"""Errors raised by the package; every one is a ValueError so callers can catch broadly."""


class SchemaMismatchError(ValueError):
    """Two tables that must carry the same columns do not."""

    def __init__(self, missing, extra):
        self.missing = list(missing)
        self.extra = list(extra)
        super().__init__(f"columns differ: missing {self.missing}, extra {self.extra}")


class ColumnConflictError(ValueError):
    """A new column would hide an existing one."""


class KeyColumnError(ValueError):
    """A key column holds missing or repeated values where it must be unique."""


class CardinalityError(ValueError):
    """A column has more distinct values than the caller allowed."""
