"""Queries and SQL of the subpackage, collected by name."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
