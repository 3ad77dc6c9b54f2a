"""The operators bound to the given tables, each with the SQL that checks it."""


def load():
    """All registered queries and oracles, by name."""
    from bindings import queries_base, queries_models, queries_reports, queries_tables  # noqa: F401
    from bindings.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
