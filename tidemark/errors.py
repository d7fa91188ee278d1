"""Failures carry counts and column names, never row values."""


class ContractError(ValueError):
    """A table or argument breaks its contract."""


class EventContractError(ContractError):
    """The session, request or page-event tables cannot be read safely."""
