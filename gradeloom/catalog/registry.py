"""Queries by name, each with the SQL that must give the same rows."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
