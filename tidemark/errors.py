"""Errors that callers can tell apart without knowing the storage or the source."""


class TidemarkError(Exception):
    """Any failed request, observation or store."""


class UnsupportedRequest(TidemarkError):
    """Product, date or location is outside the contract."""


class SourceFailed(TidemarkError):
    """The source failed or gave no rows."""


class SchemaError(TidemarkError):
    """Rows don't have the expected columns or types."""


class ValidationError(TidemarkError):
    """An observation breaks a rule of its product."""


class StoreError(TidemarkError):
    """Configuration, persistence or recovery failed."""


class CommitUnconfirmed(StoreError):
    """A commit may have happened; resume its run rather than guess."""


class DispatchError(TidemarkError):
    """No dispatch was found, or one failed its check."""


class Transient(TidemarkError):
    """A failure of the surroundings that may pass: safe to try again with the same run."""
