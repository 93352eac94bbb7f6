"""All registered queries, by module."""

from tideline.queries import io, joining, ordering, relational, sets, streams, time_windows, warehouse  # noqa: F401
from tideline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
