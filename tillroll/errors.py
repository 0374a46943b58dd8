"""Typed errors raised by the engine."""


class TillrollError(Exception):
    """Base class."""


class NoInputError(TillrollError):
    """No file, no CSV file, or no file that passed the contract."""


class DuplicateKeyError(TillrollError):
    """A dimension table has more than one row for a join key."""


class SinkError(TillrollError):
    """A sink write failed; the run must not be closed in the ledger."""


class ConfigError(TillrollError):
    """The session lacks a setting that a cluster run needs."""


class RunClosedError(TillrollError):
    """A run id that has closed its files is used again for other files."""
