"""All queries of the reference's operators, and their SQL. The modules of this package fill them."""

from __future__ import annotations

from .fixtures import oracle

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None, *tables: str):
    """Register a query and, with its derived tables before it, the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = oracle(sql, *tables)
        return f

    return add


from . import queries_align, queries_files, queries_gaps, queries_repair, queries_telomere  # noqa: E402, F401
