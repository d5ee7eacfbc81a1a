"""One query per operator on the shared test tables, each with plain SQL to check it by."""

from tablewright.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "load_all"]


def load_all() -> None:
    """Import every module that registers queries."""
    from tablewright.queries import (  # noqa: F401
        cells,
        edges,
        export,
        filters,
        indexes,
        order,
        quality,
        rowsets,
        scalars,
        shapes,
    )
