"""Queries over the given tables, one or more per operator, each beside its oracle."""


def load():
    """(queries, oracles) of all check modules."""
    from checks import grouping, layouts, moving, running, selection, storing, texts  # noqa: F401
    from checks.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
