"""The three groups of failures: bad request, no data, bad configuration.

Rows that fail go to a reject table; only configuration mistakes, and a whole
read without any data, raise.
"""


class InvalidRequest(ValueError):
    """The request cannot be answered as it is written."""


class NoData(LookupError):
    """The request is valid but nothing matches it."""


class ConfigurationError(ValueError):
    """A dataset is set up wrongly."""
