"""Errors raised before any data are read."""

from __future__ import annotations


class JobError(ValueError):
    """A query, a table declaration or a job that cannot be run as written."""


class UnknownTableError(JobError, LookupError):
    """A query names a keyspace or a table that the catalog does not hold."""
