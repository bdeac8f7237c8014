"""DataFrame-in, DataFrame-out operators for field-trial and portfolio analytics."""

__version__ = "0.1.0"
